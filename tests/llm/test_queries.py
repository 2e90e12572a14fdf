"""Every registered query against brute force, on the small corpus and on empty tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from arrearlens.llm import queries as registered

public_tokenizers = pytest.importorskip("public_tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")

QUERIES = registered.queries()
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def rows(spark, name, folder):
    return [r.asDict() for r in QUERIES[name](spark, folder).collect()]


def same(got, want, columns):
    """Rows agree as multisets in the given columns."""
    key = lambda r: tuple(map(str, r))
    a = sorted((tuple(r[c] for c in columns) for r in got), key=key)
    b = sorted((tuple(r[c] for c in columns) for r in want), key=key)
    assert len(a) == len(b)
    assert [(x, y) for x, y in zip(a, b, strict=True) if x != y][:3] == []


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def part(doc_id, n):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % n


@pytest.fixture(scope="session")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


@pytest.mark.parametrize("name", QUERIES)
def test_empty_tables_give_no_rows(spark, nothing, name):
    if name == "op13_chat_format":  # its own conversation is always there
        assert [r["conv_id"] for r in rows(spark, name, nothing)] == [-1]
    else:
        assert rows(spark, name, nothing) == []


def test_op1(spark, corpus, library):
    folder, docs = corpus
    want = []
    for i, text in docs:
        ids = library.encode(text or "")
        want.append({"doc_id": i, "n_tokens": len(ids), "ids_sha256": sha(",".join(map(str, ids))), "decoded_sha256": sha(library.decode(ids)), "n_differing": 0})
    same(rows(spark, "op1_pieces", folder), want, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_differing"])


def test_op2(spark, corpus):
    folder, docs = corpus
    got = rows(spark, "op2_min_cost_flow", folder)
    want = [{"doc_id": i, "size": len((t or "").encode()) + 1, "text_crc32": zlib.crc32((t or "").encode())} for i, t in docs]
    same(got, want, ["doc_id", "size", "text_crc32"])
    shards = defaultdict(list)
    for r in got:
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < 16
        shards[r["shard"]].append(r)
    for held in shards.values():
        assert sorted(r["slot"] for r in held) == list(range(len(held)))


def test_op3(spark, corpus):
    folder, docs = corpus
    got = rows(spark, "op3_kneser_ney", folder)
    same(got, [{"doc_id": i, "held_out": None if i is None else part(i, 5) == 0} for i, _ in docs], ["doc_id", "held_out"])
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)


def test_op4(spark, corpus):
    folder, docs = corpus
    tokens = [[*(w.decode() for w in (t or "").encode().lower().split()), ""] for _, t in docs]
    counts = Counter()
    for (i, _), words in zip(docs, tokens, strict=True):
        if i is not None and part(i, 5) != 1:
            counts.update(words)
    total, distinct = sum(counts.values()), len(counts)
    want = []
    for (i, _), words in zip(docs, tokens, strict=True):
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in words)
        want.append({"doc_id": i, "n_tokens": len(words), "n_known": sum(w in counts for w in words), "train_tokens": total, "base_score": round(base, 3)})
    got = rows(spark, "op4_recurrent_lm", folder)
    for r in got:
        r["base_score"] = round(r["base_score"], 3)
        assert math.isfinite(r["score"]) and r["score"] < 0
    same(got, want, ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score"])
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got)


def shingles(text, fold=True):
    words = WORD.findall((text or "").translate(LOWER) if fold else text)
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def jaccard_classes(sets, percent):
    """For each of the sets (by id) the smallest id that links lead to."""
    found = {i: i for i in sets}

    def top(i):
        while found[i] != i:
            i = found[i]
        return i

    ids = sorted(i for i in sets if sets[i])
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            a, b = sets[i], sets[j]
            if min(len(a), len(b)) * 100 >= percent * max(len(a), len(b)) and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((top(i), top(j)))
                found[y] = x
    return {i: top(i) for i in sets}


def test_op5(spark, corpus):
    folder, docs = corpus
    sets = {i: shingles(t) for i, t in docs if i is not None}
    of = jaccard_classes(sets, 85)
    want = [{"doc_id": i, "n_shingles": len(shingles(t)), "component_id": of.get(i), "kept": of.get(i) == i} for i, t in docs]
    same(rows(spark, "op5_minhash_join", folder), want, ["doc_id", "n_shingles", "component_id", "kept"])


def test_op6(spark, corpus, library):
    folder, docs = corpus
    want = []
    for i, text in docs:
        n = len(library.encode(text or ""))
        want.append({"doc_id": i, "n_bytes": len((text or "").encode()), "n_tokens": n, "over_limit": n > 4096})
    got = rows(spark, "op6_prefix_counts", folder)
    same(got, want, ["doc_id", "n_bytes", "n_tokens", "over_limit"])
    texts = {i: t or "" for i, t in docs if i is not None}
    for r in got:
        if r["over_limit"]:
            cut = texts[r["doc_id"]][: r["fitting_chars"]]
            assert len(library.encode(cut)) <= 4096 < len(library.encode(texts[r["doc_id"]][: r["fitting_chars"] + 1]))


def test_op7(spark, corpus):
    folder, docs = corpus
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = defaultdict(set)
    for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect():
        words = word.findall((r.text or "").translate(LOWER))
        for k in range(max(1, len(words) - 12) if words else 0):
            windows[tuple(words[k : k + 13])].add(str(r.item_id) if r.item_id is not None else "")
    want = []
    for i, text in docs:
        words, hit, items = word.findall((text or "").translate(LOWER)), set(), set()
        for n in {len(w) for w in windows}:
            for k in range(len(words) - n + 1):
                if (w := tuple(words[k : k + n])) in windows:
                    hit |= set(range(k, k + n))
                    items |= windows[w]
        want.append({"doc_id": i, "n_words": len(words), "n_hit": len(hit), "n_items": len(items), "items_sha256": sha(",".join(sorted(items))), "contaminated": bool(hit) and 20 * len(hit) >= len(words)})
    same(rows(spark, "op7_window_join", folder), want, list(want[0]))
    assert any(r["contaminated"] for r in want)


def kept_lines(docs):
    """Texts without lines that match an earlier one; rows without an id as they are."""
    first = {}
    for i, text in sorted((d for d in docs if d[0] is not None), key=lambda d: d[0]):
        for p, line in enumerate((text or "").split("\n")):
            if WORD.search(line):
                first[line] = min(first.get(line, (i, p)), (i, p))
    tokens = {line: shingles(line, fold=False) for line in first}
    held = defaultdict(list)
    for line, found in tokens.items():
        for t in found:
            held[t].append(line)
    gone = set()
    for line, found in tokens.items():
        for other in {x for t in found for x in held[t]}:
            if first[other] < first[line] and 100 * len(found & tokens[other]) >= 80 * len(found | tokens[other]):
                gone.add(line)
    out = []
    for i, text in docs:
        lines = (text or "").split("\n")
        left = [x for p, x in enumerate(lines) if i is None or not WORD.search(x) or x not in gone and first[x] == (i, p)]
        out.append((0 if text is None else len(lines), len(lines) - len(left), "\n".join(left)))
    return out


def test_op8(spark, corpus):
    folder, docs = corpus
    want = [{"doc_id": i, "n_lines": n, "n_removed": k, "kept_sha256": sha(t)} for (i, _), (n, k, t) in zip(docs, kept_lines(docs), strict=True)]
    same(rows(spark, "op8_line_dedup", folder), want, ["doc_id", "n_lines", "n_removed", "kept_sha256"])


def repeats(words, n):
    places = defaultdict(list)
    for k in range(len(words) - n + 1):
        places[tuple(words[k : k + n])].append(k)
    return {j for at in places.values() if len(at) > 1 for k in at for j in range(k, k + n)}


def quality(text):
    words = WORD.findall(text or "")
    chars = sum(map(len, words))
    seen, again, again_chars = set(), 0, 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            if line in seen:
                again, again_chars = again + 1, again_chars + sum(map(len, WORD.findall(line)))
            seen.add(line)
    n_repeat = len(repeats(words, 8))
    failed = len(words) < 20 or 100 * n_repeat > 30 * len(words)
    kept = not failed and again_chars <= 0.30 * chars
    for n, limit in {5: 0.40, 8: 0.35, 12: 0.30, 20: 0.30}.items():
        kept = kept and sum(len(words[k]) for k in repeats(words, n)) <= limit * chars
    return {"n_words": len(words), "word_chars": chars, "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")), "n_dup_lines": again, "n_repeat_words": n_repeat, "base_failed": failed, "kept": kept}


def test_op9(spark, corpus):
    folder, docs = corpus
    want = [{"doc_id": i} | quality(t) for i, t in docs]
    same(rows(spark, "op9_repetition", folder), want, list(want[0]))


def test_op10(spark, corpus):
    folder, docs = corpus
    got = rows(spark, "op10_compression_language", folder)
    same(got, [{"doc_id": i, "held_out": None if i is None else part(i, 3) == 1} for i, _ in docs], ["doc_id", "held_out"])
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in got:
        assert 0 <= r["score"] <= 1 and r["lang_pred"] in {"und", "de", "en", "es", "fr"}
    assert {r["lang_pred"] for r in got if r["doc_id"] in (100_000, 100_001, 100_002)} == {"und"}
    held = [r for r in got if r["held_out"] and truth[r["doc_id"]]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.9 * len(held)


def test_pipeline(spark, corpus, library):
    folder, docs = corpus
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "minhash_near_dedup", "benchmark_decontamination", "sentencepiece"]
    left = [d for d in docs if quality(d[1])["kept"]]
    lines = kept_lines(left)
    left = [(i, t) for (i, _), (_, k, t) in zip(left, lines, strict=True) if not (k and not WORD.search(t))]
    of = jaccard_classes({i: shingles(t) for i, t in left if i is not None}, corpus_pipeline.SIMILAR)
    once = {(i, t) if i is not None else (k, i, t): (i, t) for k, (i, t) in enumerate(left)}
    left = [(i, t) for i, t in once.values() if i is None or of[i] == i]
    clean = {r["doc_id"] for r in rows_of(spark, folder, left) if not r["contaminated"]}
    want = []
    for i, text in left:
        if i in clean:
            ids = library.encode(text or "")
            want.append({"doc_id": i, "n_tokens": len(ids), "ids_sha256": sha(",".join(map(str, ids)))})
    got = [r.asDict() for r in corpus_pipeline.run(spark, folder).collect()]
    same(got, want, ["doc_id", "n_tokens", "ids_sha256"])
    assert 0 < len(got) < len(docs)


def rows_of(spark, folder, docs):
    from arrearlens.llm.decontaminate import contamination

    frame = spark.createDataFrame(docs, "doc_id long, text string")
    return [r.asDict() for r in contamination(frame, spark.read.parquet(f"{folder}/benchmark.parquet")).collect()]


def test_pipeline_on_empty_tables(spark, nothing):
    assert corpus_pipeline.run(spark, nothing).collect() == []
