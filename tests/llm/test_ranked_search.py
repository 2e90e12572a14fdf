"""Ranked search against scoring every document for every item."""

import math
import re
from collections import Counter

import pytest

from arrearlens.llm import queries as registered
from arrearlens.llm import ranked_search as rs

LOWER = {i: i + 32 for i in range(65, 91)}
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute(docs, items, best):
    held = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n_docs, n_words = len(held), sum(c.total() for _, c in held)
    df = Counter(term for _, c in held for term in c)
    out = []
    for item, text in items:
        terms = {t for t in TERM.findall((text or "").translate(LOWER)) if t in df}
        weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in terms}
        scored = []
        for i, c in held:
            m = 50 + (50 * c.total() * n_docs) // n_words
            score = sum(weight[t] * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m)) for t in terms if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -score) for rank, (score, _, _, i) in enumerate(sorted(scored, key=lambda r: r[:3])[:best], 1)]
    return sorted(out, key=str)


def found(spark, docs, items, best=50):
    docs = spark.createDataFrame([(i, t, "c", 1) for i, t in docs], "doc_id long, text string, term string, block int").repartition(3)
    items = spark.createDataFrame([(i, t, "c", 1) for i, t in items], "item_id long, text string, slice string, idx int")
    return sorted((tuple(r) for r in rs.search(docs, items, best).collect()), key=str)


def test_made_rows(spark):
    docs = [(i, " ".join(f"w{i % k}" for k in range(1, 9))) for i in range(300)]
    docs += [(None, "w0 w1 w2"), (7, "w0 w0 w0 w0"), (7, "w0 w0 w0 w0"), (1000, None), (1001, ""), (1002, " .,;"), (1003, "W0-w1 Ä ä é9" * 5000), (1004, "rare W1")]
    items = [(1, "w0 w1 w2 w3 rare"), (1, "w0 w1 w2 w3 rare"), (2, None), (3, ""), (None, "W5 w5 w6 nowhere"), (4, "nowhere"), (5, "w0"), (6, " ".join(f"w{k}" for k in range(9)))]
    for best in (50, 5, 1, 1000):
        assert found(spark, docs, items, best) == brute(docs, items, best)


def test_blocks_and_slices_of_any_size(spark, monkeypatch):
    docs = [(i, " ".join(f"w{i * i % k} v{i % 5}" for k in range(1, 12))) for i in range(200)]
    items = [(k, f"w{k} w{k + 1} v{k % 5} w0") for k in range(40)]
    want = brute(docs, items, 4)
    for name, value in (("BLOCK_DOCS", 3), ("BLOCK_WORDS", 50), ("SLICE", 7), ("MOST_BROADCAST", 0), ("FIELD_BITS", 64)):
        monkeypatch.setattr(rs, name, value)
        assert found(spark, docs, items, 4) == want


@pytest.mark.parametrize("owners", [(1.0,), (0.5, 1.0), (0.01, 0.1, 0.3, 0.6, 1.0)])
def test_any_number_of_owners(spark, monkeypatch, owners):
    monkeypatch.setattr(rs, "OWNERS", owners)
    docs = [(i, " ".join(f"w{i % k}" for k in range(1, 30))) for i in range(150)]
    items = [(k, " ".join(f"w{j}" for j in range(k, k + 9))) for k in range(12)]
    assert found(spark, docs, items, 3) == brute(docs, items, 3)


def test_query(spark, corpus):
    folder, docs = corpus
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    got = sorted((tuple(r) for r in registered.queries()["op12_ranked_search"](spark, folder).collect()), key=str)
    assert got == brute(docs, items, 50)
