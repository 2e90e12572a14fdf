"""Stages of the pipeline one by one."""

import corpus_pipeline


def test_near_copies_from_80_percent_on_go(spark):
    words = lambda i, n, tail: " ".join([f"w{i}x{k}" for k in range(n)] + [f"{tail}{i}x{k}" for k in range(104 - n)])
    # of 100 runs each 90 are in common (82 % of 110), then 89 (80.2 % of 111), then 88 (78.6 % of 112)
    pairs = {1: 94, 2: 93, 3: 92}
    docs = spark.createDataFrame([(10 * i + k, words(i, n, "ab"[k])) for i, n in pairs.items() for k in range(2)], "doc_id long, text string")
    left = corpus_pipeline.dedup_documents(spark, docs, "")
    assert sorted(r.doc_id for r in left.collect()) == [10, 20, 30, 31]
