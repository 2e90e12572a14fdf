"""Parts of operators that their queries don't reach, against brute force."""

import itertools
import random
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from arrearlens.llm import compression_language, decontaminate, line_dedup, minhash_join, pieces, prefix_counts, repetition, reshard
from arrearlens.llm.common import forget_others, release, unused

public_tokenizers = pytest.importorskip("public_tokenizers")
MODEL = "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def codec():
    return pieces.codec(public_tokenizers.path(MODEL))


# -- tokens -------------------------------------------------------------------------------------------

TEXTS = [None, "", " ", "   ", "a b", "The quick  brown\nfox\t", "  two before", "▁ marks ▁▁", "ﬁ é 中文 😀\x00", "x" * 3000, "  " + "base64run" * 40, "trailing   ", "a\n\n  b"]


def test_ids_and_texts_of_ids(spark, codec):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id int, text string")
    ids = pieces.piece_ids(docs, public_tokenizers.path(MODEL))
    got = {r.doc_id: r.ids for r in ids.collect()}
    for i, text in enumerate(TEXTS):
        assert got[i] == codec.library.encode(text or "")
    back = {r.doc_id: r.text for r in pieces.piece_texts(ids, public_tokenizers.path(MODEL)).collect()}
    for i in got:
        assert back[i] == codec.library.decode(got[i])


def test_every_stretch_is_checked(codec):
    # "ab" is first met as a part of a longer stretch, then as a stretch of its own
    codec.seen.clear()
    codec.encoded(["ab中ab"])
    checked = []
    real = codec.library_ids
    codec.library_ids = lambda s: checked.extend(s) or real(s)
    try:
        codec.encoded(["ab中", "ab中ab"])
        assert any(s.endswith("ab中") for s in checked)
    finally:
        codec.library_ids = real


def test_a_difference_is_counted_and_not_hidden(codec):
    codec.seen.clear()
    real = codec.library_ids
    codec.library_ids = lambda s: [(1, 2, 3)] * len(s)
    try:
        found = codec.encode_batch(["hello there"])
        assert codec.differing == 2 and found[0] == codec.library.encode("hello there")
    finally:
        codec.library_ids = real
        codec.seen.clear()


def test_counts_of_every_prefix(spark, codec):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id int, text string")
    got = {r.doc_id: r.counts for r in prefix_counts.prefix_counts(docs, public_tokenizers.path(MODEL)).collect()}
    for i, text in enumerate(TEXTS):
        text = text or ""
        step = max(1, len(text) // 60)
        assert len(got[i]) == len(text)
        for n in range(0, len(text), step):
            assert got[i][n] == len(codec.library.encode(text[: n + 1])), (text[:20], n)


def test_prefixes_behind_runs_of_spaces(codec):
    counter, rng = prefix_counts.PrefixCounter(codec), random.Random(5)
    for _ in range(150):
        word = "".join(rng.choice("abetions中.1") for _ in range(rng.randrange(1, 25)))
        text = rng.choice(["", "x", "\n"]) + " " * rng.randrange(1, 41) + word + " " * rng.randrange(0, 5)
        want = [len(codec.library.encode(text[:n])) for n in range(1, len(text) + 1)]
        assert counter.prefixes(text).tolist() == want, repr(text)


@pytest.mark.parametrize("spaces", [1, 2, 40])
def test_long_words_take_time_in_proportion(codec, spaces):
    counter = prefix_counts.PrefixCounter(codec)
    rng = random.Random(1)
    text = " " * spaces + "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGH0123456789+/") for _ in range(300_000))
    began = time.time()
    counts = counter.prefixes(text)
    assert time.time() - began < 30
    assert counts[-1] == len(codec.library.encode(text))
    assert all(len(s) <= prefix_counts.SHORT for s in counter.seen)


# -- shards -------------------------------------------------------------------------------------------


def moved(flow):
    return sum(n for (i, j), n in flow.items() if i != j)


def test_the_fewest_bytes_move():
    rng = random.Random(3)
    for _ in range(60):
        n = rng.randrange(1, 6)
        sizes = [rng.randrange(0, 50) for _ in range(n)]
        capacities = reshard.equal_capacities(sum(sizes) + rng.randrange(0, 10), n)
        flow = reshard.solve_transfers(sizes, capacities)
        for i in range(n):
            assert sum(v for (a, _), v in flow.items() if a == i) == sizes[i]
            assert sum(v for (_, b), v in flow.items() if b == i) <= capacities[i]
        assert moved(flow) == sum(max(0, s - c) for s, c in zip(sizes, capacities, strict=True))
    with pytest.raises(ValueError, match="too small"):
        reshard.solve_transfers([5], [4])


def test_the_cheapest_flow_against_all_flows():
    rng = random.Random(4)
    for _ in range(40):
        sizes, capacities = [rng.randrange(0, 4) for _ in range(2)], [rng.randrange(2, 6) for _ in range(2)]
        if sum(sizes) > sum(capacities):
            continue
        cost = {(i, j): rng.randrange(0, 5) for i in range(2) for j in range(2)}
        flow = reshard.solve_transfers(sizes, capacities, cost)
        best = min(
            a * cost[0, 0] + (sizes[0] - a) * cost[0, 1] + b * cost[1, 0] + (sizes[1] - b) * cost[1, 1]
            for a, b in itertools.product(range(sizes[0] + 1), range(sizes[1] + 1))
            if a + b <= capacities[0] and sum(sizes) - a - b <= capacities[1]
        )
        assert sum(n * cost[e] for e, n in flow.items()) == best


def test_files_are_rewritten_and_the_rest_stays(spark, tmp_path):
    rng = random.Random(6)
    rows = [(i, "w" * rng.randrange(0, 200), 0 if i % 10 < 5 else 1 + i % 3) for i in range(400)] + [(None, None, 1), (7, "w", 0), (7, "w", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int")
    root = str(tmp_path / "old")
    docs.write.partitionBy("shard").parquet(root)
    manifest = {r.shard: r.folder for r in reshard.rewrite(spark, root, str(tmp_path / "new"), 4).collect()}
    assert manifest == {r.shard: r.folder for r in spark.read.parquet(str(tmp_path / "new/manifest")).collect()}
    sizes, back = {}, []
    for shard, folder in manifest.items():
        held = spark.read.schema("doc_id long, text string").parquet(folder).collect()
        back += [(r.doc_id, r.text) for r in held]
        sizes[shard] = sum(len(r.text or "") + 1 for r in held)
    assert sorted(back, key=str) == sorted([(i, t) for i, t, _ in rows], key=str)
    assert max(sizes.values()) - min(sizes.values()) <= 2 * 201
    # from equal sizes nothing moves and nothing is written
    even = spark.createDataFrame([(i, "abc", i % 4) for i in range(40)], "doc_id long, text string, shard int")
    even.write.partitionBy("shard").parquet(str(tmp_path / "even"))
    folders = {r.shard: r.folder for r in reshard.rewrite(spark, str(tmp_path / "even"), str(tmp_path / "same"), 4).collect()}
    assert all(f.startswith(str(tmp_path / "even")) for f in folders.values()) and not (tmp_path / "same/data").exists()


# -- language -----------------------------------------------------------------------------------------


def test_a_language_of_long_texts_only_is_learned(spark):
    german = "der schnelle braune fuchs springt über den faulen hund und läuft davon "
    rows = [(i, german * 400 + f"nummer {'x' * i}", "de") for i in range(5)] + [(100 + i, f"the quick brown fox number {'i' * i} jumps over a lazy dog", "en") for i in range(20)]
    known = spark.createDataFrame([*rows, (200, None, "fr"), (201, "...", "es"), (202, "mots", None)], "doc_id long, text string, lang string")
    found = compression_language.fit(known)
    assert set(found) == {"de", "en"} and b"fuchs" in found["de"]
    texts = spark.createDataFrame([(1, german * 3), (2, "the quick dog jumps over the brown fox")], "doc_id long, text string")
    assert {r.doc_id: r.lang_pred for r in compression_language.identify(texts, found).collect()} == {1: "de", 2: "en"}


def test_copies_don_t_fill_a_dictionary(spark):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(3000)]
    distinct = [" ".join(rng.choice(words) for _ in range(40)) for _ in range(400)]
    rows = [(i, distinct[0], "en") for i in range(5000)] + [(9000 + i, t, "en") for i, t in enumerate(distinct)]
    found = compression_language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))["en"]
    assert len(found) == compression_language.DICTIONARY_BYTES
    assert found.count(distinct[0].encode()) <= 1


def test_line_ends_do_not_part_what_the_library_checks_together():
    c = pieces.PieceCodec(public_tokenizers.path(MODEL))
    real, calls = c.library, []

    class Counting:
        def encode(self, text):
            calls.append(text)
            return real.encode(text)

    c.library = Counting()
    texts = ["\n".join(f"line {k} of {t}\twith words{k * t}" for k in range(40)) for t in range(20)]
    assert c.encode_batch(texts) == [real.encode(t) for t in texts]
    assert c.differing == 0 and len(calls) <= 4


def test_both_agendas_join_alike(codec, monkeypatch):
    rng = random.Random(5)
    symbols = sorted({x for p in codec.ids for x in p})[:80] + list("abcdefghi▁aaaee") * 8
    some = ["".join(rng.choices(symbols, k=rng.randrange(1, pieces.SHORT + 1))) for _ in range(3000)]
    short = [codec.merged(s) for s in some]
    monkeypatch.setattr(pieces, "SHORT", 0)
    assert short == [codec.merged(s) for s in some]


def test_the_next_operator_gives_a_workers_memory_back(spark, monkeypatch):
    # Spark's Python workers serve one stage after another: what `pieces` remembers is of no use to the quality rules
    path, found = public_tokenizers.path(MODEL), []
    monkeypatch.setattr(repetition.F, "pandas_udf", lambda schema: lambda run: found.append(run) or (lambda col: col))
    repetition.judged(F.lit(""))
    pieces.codec.cache_clear()
    kept = pieces.codec(path)
    kept.encode("some words")
    assert pieces.codec(path) is kept and kept.seen
    forget_others("pieces")
    assert pieces.codec(path) is kept  # its own tasks find it again
    rows = [r for batch in found[0](iter([pd.Series(["one two", None])])) for r in batch["n_words"]]
    assert rows == [2, 0]
    assert pieces.codec.cache_info().currsize == 0
    assert pieces.codec(path).encode("some words") == kept.encode("some words")
    forget_others("repetition")
    assert pieces.codec.cache_info().currsize == 0  # noted anew with each codec


# -- lines, documents, windows --------------------------------------------------------------------------


def test_the_order_of_tokens_is_one_order(spark):
    shared = " ".join(f"s{k}" for k in range(30))
    rows = [(i, f"{shared} " + " ".join(f"own{i}x{k}" for k in range(12))) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    common = line_dedup.levels(docs)
    lines = docs.select("doc_id", line_dedup.tokens(F.col("text"), common).alias("t")).collect()
    whole = set(lines[0].t)
    for r in lines[1:]:
        whole &= set(r.t)
    assert len(whole) == 26
    assert all(r.t == sorted(r.t) for r in lines)
    # the passage comes last, but where a word of a line's own falls into a cell of the passage
    assert sum(set(r.t[-26:]) != whole for r in lines) <= 60
    # and so no two of these lines meet: a prefix is a fifth of a line
    seen = line_dedup._occurrences(docs, 80, common)
    assert line_dedup._met(seen).isEmpty()


def test_levels_count_every_line(spark):
    # twenty passages of one run of words, each in 64 lines: 64 is four times the unit, whichever lines hold it
    rows = [(64 * p + k, f"a{p} b{p} c{p} d{p} e{p}\nown{p}x{k}") for p in range(20) for k in range(64)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    common = line_dedup.levels(docs)
    first = docs.where("doc_id % 64 = 0").select(line_dedup.tokens(F.split("text", "\n")[0], common)[0].alias("t"))
    assert [r.t >> (63 - line_dedup._LEVEL_BITS) for r in first.collect()] == [2] * 20


def test_runs_are_counted_before_the_shuffle(spark):
    # runs of all lines, as often as they occur; a line of fewer words is one run, a line without words none
    texts = [" ".join(f"w{i % 7}x{k}" for k in range(i)) + "\n \t\n" + "same words\there" for i in range(200)]
    docs = spark.createDataFrame([*enumerate(texts), (None, "x y"), (900, None)], "doc_id long, text string")
    counts = line_dedup.run_counts(docs)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan  # these run uncompiled, row by row
    assert f"& {line_dedup.COUNTERS - 1})" in plan.split("Exchange")[1]  # the partial count lies below it
    n = sum(max(len(line.split()) - 4, 1) for t in texts for line in t.split("\n") if line.split())
    assert counts.agg(F.sum("n")).first()[0] == n


def test_words_are_parted_by_any_space(spark):
    rows = [(0, "a b c d e f  g"), (1, "a\tb c\x0bd e\x0c f\r g "), (2, " a b c d e f g"), (3, "a b c d e f\u00a0g")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r.t) for r in docs.select("doc_id", line_dedup.tokens(F.col("text"), line_dedup.levels(docs)).alias("t")).orderBy("doc_id").collect()]
    assert got[0] == got[1] == got[2] != got[3]
    assert [len(t) for t in got] == [3, 3, 3, 2]


def test_finished_steps_leave_the_disk(spark, monkeypatch):
    disk = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    docs = spark.createDataFrame([(i, f"{i} a b c d e f\n{i} g h i j k l") for i in range(50)], "doc_id long, text string")
    release(spark)
    time.sleep(2)
    before, freed = disk.getAllFiles().size(), []

    def released(session):
        # Spark's own events may hold a frame a little longer on a busy machine
        until = time.time() + 20
        while (left := disk.getAllFiles().size()) > before and time.time() < until:
            release(session)
            time.sleep(0.2)
        freed.append(left <= before)

    monkeypatch.setattr(line_dedup, "release", released)
    line_dedup.levels(docs)
    assert freed == [True]


def test_lines_with_a_common_passage(spark):
    from tests.llm.test_queries import kept_lines

    rng = random.Random(2)
    shared = " ".join(f"s{k}" for k in range(40))
    rows = [(i, f"{shared} " + " ".join(f"o{rng.randrange(60 if i % 2 else 9000)}" for _ in range(rng.randrange(0, 14)))) for i in range(250)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_lines, r.n_removed) for r in line_dedup.line_counts(docs).collect()}
    assert got == {i: (n, k) for (i, _), (n, k, _) in zip(rows, kept_lines(rows), strict=True)}
    assert 0 < sum(k for _, k in got.values()) < len(rows)


def test_bits_of_a_signature(spark):
    import numpy as np

    sig = np.random.default_rng(1).integers(0, 2**32, 64, dtype=np.uint64).astype(np.uint32).view(np.int32)
    bits = minhash_join.leading_bits(sig)
    assert bits.dtype == np.int64 and len(bits) == minhash_join.BITS
    for b, word in enumerate(bits):
        assert bin(int(word) & (2**64 - 1)).count("1") == int(((sig.view(np.uint32) >> b) & 1).sum())


def test_windows_in_several_slices(spark, corpus):
    folder, _ = corpus
    docs, items = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet")
    names = ["doc_id", "n_words", "n_hit", "items", "contaminated"]
    whole = decontaminate.contamination(docs, items).select(names)
    slices = decontaminate.contamination(docs, items, index_bytes=2000).select(names)
    key = lambda r: (str(r.doc_id), r.n_words, r.n_hit, sorted(r["items"]), r.contaminated)
    assert sorted(map(key, slices.collect())) == sorted(map(key, whole.collect()))


def test_spare_names(spark):
    df = spark.range(1).selectExpr("id as _A", "id as _a1")
    assert unused(df, "_a", "_b") == ["_a2", "_b"]
