"""Collocations against counting every phrase, with all thresholds at which rounds end early or late."""

import re
from collections import Counter

import pytest

from arrearlens.llm import collocations as co
from arrearlens.llm import queries as registered
from arrearlens.llm.sketch import key_hash

LOWER = {i: i + 32 for i in range(65, 91)}
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(docs, least, keep):
    counts, totals = {}, Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            of = counts.setdefault(lang, Counter())
            for k in range(1, 6):
                of.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, of in counts.items():
        found = {p: a for p, a in of.items() if a >= least}
        covered = set()
        for p, a in found.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    if a >= found[p[i : i + k]]:
                        covered.add(p[i : i + k])
        scored = []
        for p, a in found.items():
            if len(p) > 1 and p not in covered:
                n = totals[lang]
                score, k = min((1000 * a * n // (of[p[:k]] * of[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), a, of[p[:k]], of[p[k:]], n, score))
        for rank, (_, _, phrase, a, left, right, n, score) in enumerate(sorted(scored)[:keep], 1):
            out.append((lang, rank, phrase.decode(), a, left, right, n, score))
    return sorted(out)


def same(spark, docs, least, keep):
    frame = spark.createDataFrame([(lang, text, "x", 1) for lang, text in docs], "lang string, text string, phrase string, a int").repartition(3)
    got = sorted(tuple(r) for r in co.collocations(frame, least, keep).select(COLUMNS).collect())
    want = brute(docs, least, keep)
    assert got == want
    return want


def test_hash_is_the_engines(spark):
    row = spark.sql("select xxhash64('de', 'größe') as two, xxhash64('a') as one, xxhash64(repeat('ab', 50)) as long").first()
    assert [row.two % 2**64, row.one % 2**64, row.long % 2**64] == [key_hash(b"de", "größe".encode()), key_hash(b"a"), key_hash(b"ab" * 50)]


@pytest.fixture(scope="module")
def texts(corpus):
    import pyarrow.parquet as pq

    rows = pq.read_table(f"{corpus[0]}/documents.parquet", columns=["lang", "text"]).to_pylist()
    return [(r["lang"], r["text"]) for r in rows]


@pytest.mark.parametrize(("least", "keep"), [(100, 2000), (8, 2000), (5, 15), (5, 3)])
def test_against_all_phrases(spark, texts, least, keep):
    assert same(spark, texts, least, keep)


@pytest.mark.parametrize("keep", [2000, 12])
def test_bands_and_buckets_of_any_size(spark, texts, monkeypatch, keep):
    monkeypatch.setattr(co, "FIRST_WORDS", 1)
    monkeypatch.setattr(co, "AT_ONCE", 500)
    monkeypatch.setattr(co, "BUCKETS", co.CHUNK)
    assert same(spark, texts, 6, keep)


def test_made_rows(spark):
    docs = [(None, "Ab cd, ab cd; AB CD. ab\tcd ab")] * 3 + [("x", "a a a a a a a\x0ba a a"), ("x", None), (None, ""), ("x", "ä Ä ä Ä\x85 q")] * 2
    docs += [("y", "new york city is big"), ("y", "new york city is old")] * 4 + [("y", "york new is " * 3)]
    for least, keep in ((2, 2000), (3, 1), (3, 2), (1, 2000), (50, 10)):
        same(spark, docs, least, keep)


def test_ties_stay_whole_where_rounds_end(spark, monkeypatch):
    monkeypatch.setattr(co, "FIRST_WORDS", 1)
    docs = [("t", " ".join(f"p{i} q{i}." for i in range(30)))] * 3 + [("t", "the of the of and the of ")] * 40 + [("t", "and zu")] * 9
    for keep in (1, 7, 29, 30, 31, 32):
        same(spark, docs, 3, keep)


def test_rounds_stop_when_settled(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(co, "FIRST_WORDS", 1)
    real = co.phrase_counts
    monkeypatch.setattr(co, "phrase_counts", lambda texts, k, *rest: seen.append(k) or real(texts, k, *rest))
    docs = [("t", " ".join(f"p{i} q{i}." for i in range(30)))] * 3 + [("t", "the of the of and the of " * 50)] * 4
    same(spark, docs, 3, 10)
    assert max(seen) < co.N_BANDS - 1


def test_query(spark, corpus, texts):
    got = sorted(tuple(r[c] for c in COLUMNS) for r in registered.queries()["op11_collocations"](spark, corpus[0]).collect())
    assert got == brute(texts, 100, 2000)
