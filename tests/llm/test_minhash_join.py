"""The signature bound of op5 at thresholds other than its own."""

import math

import pytest
from pyspark.sql import functions as F

from arrearlens.llm import minhash_join
from arrearlens.llm.common import cut


def missed(similar, least):
    n, p = minhash_join.COORDINATES, similar / 100
    return sum(math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(least))


@pytest.mark.parametrize("similar", [30, 50, 60, 70, 80, 85, 95, 99])
def test_the_error_is_the_same_at_every_threshold(similar):
    least = minhash_join.least_matches(similar)
    assert missed(similar, least) <= minhash_join.MISSED < missed(similar, least + 1)


def test_known_bounds():
    assert minhash_join.least_matches(85) == 36
    assert minhash_join.least_matches(100) == minhash_join.COORDINATES
    for similar in (0, 20, 101):
        with pytest.raises(ValueError, match="similarity"):
            minhash_join.least_matches(similar)


def test_pairs_at_a_low_threshold_are_found(spark):
    # 50 words each, the first 36 in common: 32 of 60 runs, 53 %
    rows = []
    for i in range(60):
        common = [f"w{i}x{k}" for k in range(36)]
        rows += [(2 * i, " ".join(common + [f"a{i}x{k}" for k in range(14)])), (2 * i + 1, " ".join(common + [f"b{i}x{k}" for k in range(14)]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in minhash_join.near_duplicates(docs, 50).collect()}
    assert found == {i: i // 2 * 2 for i, _ in rows}
    assert len({r.component_id for r in minhash_join.near_duplicates(docs, 54).collect()}) == 120


def test_long_prefixes_meet_once(spark, monkeypatch):
    # two families of 12 texts of 1,200 words: texts of one share 900 to 1,000 of their words, so their prefixes
    # are far longer than what travels whole; some of them are close enough for a link
    rows = []
    for f in range(2):
        for i in range(12):
            words = [f"f{f}w{k}" for k in range(1000)]
            own = [f"f{f}i{i if i else 1}x{k}" for k in range(200 + (i == 0))]
            rows.append((100 * f + i, " ".join(words[: 500 - 4 * i] + own + words[500 + 4 * i :])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    met = []
    meeting = minhash_join._meeting

    def kept(*args):
        met.append(cut(meeting(*args)))
        return met[0]

    # without hubs that link them first, all pairs are left to the last join
    monkeypatch.setattr(minhash_join, "_meeting", kept)
    monkeypatch.setattr(minhash_join, "_with_hubs", lambda postings: postings.select(F.col("cls").alias("a"), F.col("cls").alias("b")).limit(0))
    found = {r.doc_id: r.component_id for r in minhash_join.near_duplicates(docs).collect()}
    assert found == expected(rows)
    assert len(set(found.values())) < len(rows)
    assert met[0].count() <= 1.1 * met[0].distinct().count()


def expected(rows, similar=85):
    """Components by brute force."""
    sets = {i: set(minhash_join.shingle_set(t).tolist()) for i, t in rows}
    label = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                common = len(sets[a] & sets[b])
                if 100 * common >= similar * (len(sets[a]) + len(sets[b]) - common) and label[b] < label[a]:
                    label[a], changed = label[b], True
    return label
