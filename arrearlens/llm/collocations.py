"""Phrase collocations by best-first branch-and-bound growth.

Phrases of 2 to `LONGEST` words with a = f(phrase) of at least `least` are scored by their weakest cut:
floor(1000 * a * n / (l * r)), l and r the counts of the two parts. As r >= a, no phrase scores above
1000 * n / f(first words) for any of its beginnings, nor, by symmetry, above 1000 * n / f(last words). So the
counts of single words bound whole branches, and the rarest words head the frontier.

Words below `least` can't belong to a phrase. The others form bands by count, rarest first. A round takes in
the next band: it grows phrases that begin or end in the words taken in so far. A first scan counts their pairs
by hashes alone, a second one adds up longer phrases along frequent pairs in a field of counters, and a third one
counts phrases word by word, as far as these say that they may be frequent enough. A phrase both of whose ends are taken in has all its parts counted, so its score
is exact; all others lie under the bound of the next band. A language is settled once `keep` surviving scores
lie above that bound (equal ones don't count, so ties stay whole) or no band is left; settled languages leave
the frontier, and the rounds end when all have.

A phrase that a longer one covers at the same count has the same neighbour on one side at every occurrence, so
each count carries the least and greatest 64-bit hash of the words to the left and to the right. Counting is by
the phrase itself, not by hashes; bands, frequent pairs and buckets reach the tasks as bit fields of fixed size
(see `sketch`), which can let too much pass but lose nothing. Tasks count in parts of bounded size before the shuffle.

Defined results: null and empty texts hold no words; a null language is `und`. Repeated rows count each time.
Ties go by score, a, then the phrase's bytes. Empty tables, and languages without candidates, give no rows.
Other columns are left out. Memory follows the longest text.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import _BLOCK, _blocks, cut, mix, ship, utf8
from .sketch import BITS, field, held, key_hash, remainder

LONGEST = 5
#: The first band holds about so many words, the second up to this share of the frequent words' occurrences, the
#: third the rest.
FIRST_WORDS, SECOND_SHARE, N_BANDS = 1 << 16, 1 / 16, 3
#: Counters of phrases of three words and more, and how many travel in one row.
BUCKETS, CHUNK = 1 << 24, 1 << 14
#: Cells of the field of words, four bits each: one for each band.
CELLS = 1 << 24
#: Words that are counted at a time; entries of a task's memory of words.
AT_ONCE, REMEMBERED = 1 << 22, 1 << 20
#: Slices of a language in the first selection.
SLICES = 32

# A-Z become a-z, ends of pieces a byte that UTF-8 does not have; words stand between spaces and tabs.
BREAK = b"\xff"
_FOLD = bytes(b + 32 if 65 <= b <= 90 else BREAK[0] if b in b".,;:!?\n\x0b\x0c\r" else b for b in range(256))
_MIX = np.uint64(0x9FB21C651E98DF25)


def tokens(text: str | None) -> Iterator[list[bytes]]:
    """Words, and a break between pieces, in lists that follow one another."""
    data = utf8(text).translate(_FOLD).replace(BREAK, b" \xff ")
    for part in _blocks(data) if len(data) > _BLOCK else (data,):
        yield part.split()


def _texts(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text"))


# -- words --------------------------------------------------------------------------------------------


def word_counts(texts: DataFrame) -> DataFrame:
    """(lang, word, f); the row without a word counts all of the language's."""

    def out(counts: dict[str, Counter]) -> pa.RecordBatch:
        langs, words, numbers = [], [], []
        for lang, of in counts.items():
            of.pop(BREAK, None)
            langs += [lang] * (len(of) + 1)
            words += [None, *[w.decode("utf-8", "replace") for w in of]]
            numbers += [sum(of.values()), *of.values()]
        return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(words, pa.string()), pa.array(numbers, pa.int64())], ["lang", "word", "f"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                for part in tokens(text.as_py()):
                    counts.setdefault(lang, Counter()).update(part)
                if sum(map(len, counts.values())) > REMEMBERED:
                    yield out(counts)
                    counts = {}
        yield out(counts)

    return texts.mapInArrow(run, "lang string, word string, f long").groupBy("lang", "word").agg(F.sum("f").alias("f"))


def banded(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((lang, word, f, band), (lang, band, lowest count)): bands of words by powers of two of their counts."""
    level = F.length(F.bin("f"))
    # at most 64 rows for each language
    steps = words.groupBy("lang", level.alias("level")).agg(F.sum("f").alias("mass"), F.count(F.lit(1)).alias("words"), F.min("f").alias("lowest"))
    upwards = Window.partitionBy("lang").orderBy("level")
    total = F.sum("mass").over(Window.partitionBy("lang"))
    first = (F.row_number().over(upwards) == 1) | (F.sum("words").over(upwards) <= FIRST_WORDS)
    band = F.when(first, 0).when(F.sum("mass").over(upwards) <= F.lit(SECOND_SHARE) * total, 1).otherwise(2)
    steps = cut(steps.select("lang", "level", "lowest", band.alias("band")))
    return words.join(steps.select("lang", "level", "band").withColumnRenamed("level", "of"), (F.col("of") == level) & (words["lang"] == steps["lang"])).select(
        words["lang"], "word", "f", "band"
    ), steps.groupBy("lang", "band").agg(F.min("lowest").alias("lowest"))


class Codes(dict):
    """Codes of a language's words, 0 for words that no phrase can hold, with bands and hashes by code."""

    def __init__(self, lang: str, cells: np.ndarray):
        super().__init__()
        self.seed = key_hash(lang.encode("utf-8", "replace"))
        self.cells = cells
        self.words, self.bands, self.hashes = [BREAK], [N_BANDS], [0]
        self[BREAK] = 0

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word, self.seed)
        at = h % CELLS
        bits = int(self.cells[at >> 4]) >> (4 * (at & 15)) & 15
        code = 0
        if bits:
            code = len(self.words)
            self.words.append(word)
            self.bands.append((bits & -bits).bit_length() - 1)
            self.hashes.append(h)
        self[word] = code
        return code


# -- phrases ------------------------------------------------------------------------------------------

PHRASE = "lang string, phrase string, size int, reach int, a long, left_low long, left_high long, right_low long, right_high long"
_PHRASE = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("size", pa.int32()), ("reach", pa.int32()), *[(c, pa.int64()) for c in ("a", "left_low", "left_high", "right_low", "right_high")]])


def _together(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal keys together, and where each begins."""
    order = np.argsort(key, kind="stable")
    return order, np.flatnonzero(np.diff(key[order], prepend=key[order[0]] - 1)) if len(key) else np.zeros(0, np.int64)


class Growth:
    """Grows the phrases of one language's stretch of text in a round."""

    def __init__(self, codes: Codes, row: np.ndarray, round_: int, buckets: int):
        self.codes, self.round, self.n_buckets = codes, round_, buckets
        self.row = np.concatenate(([0], row, [0]))  # a break at both ends
        self.band = np.array(codes.bands, np.int8)[self.row]
        self.hash_of = np.array(codes.hashes, np.uint64)

    def pairs(self) -> np.ndarray:
        """Places of two words that may stand together in a phrase."""
        return np.flatnonzero((self.row[:-1] > 0) & (self.row[1:] > 0))

    def pair_hash(self, at: np.ndarray) -> np.ndarray:
        return mix(self.hash_of[self.row[at]] * _MIX + self.hash_of[self.row[at + 1]])

    def due(self, at: np.ndarray, size: int) -> np.ndarray:
        """Phrases whose rarer end was taken in this round; the others were counted before or come later."""
        return np.minimum(self.band[at], self.band[at + size - 1]) == self.round

    def hashed_pairs(self) -> pa.RecordBatch:
        """(hash, n) of the round's pairs."""
        at = self.pairs()
        at = at[self.due(at, 2)]
        key, n = np.unique(self.row[at] * len(self.codes.words) + self.row[at + 1], return_counts=True)
        first, second = np.divmod(key, len(self.codes.words))
        hashed = mix(self.hash_of[first] * _MIX + self.hash_of[second])
        return pa.RecordBatch.from_arrays([pa.array(hashed.view(np.int64)), pa.array(n.astype(np.int64))], ["hash", "n"])

    def counted(self, lang: str, key: np.ndarray, at: np.ndarray, size: int) -> pa.RecordBatch:
        order, begin = _together(key)
        at = at[order]
        left, right = (self.hash_of[self.row[x]].view(np.int64) for x in (at - 1, at + size))
        first = at[begin]
        words = self.codes.words
        phrases = [b" ".join([words[c] for c in self.row[f : f + size]]).decode("utf-8", "replace") for f in first]
        ends = [f.reduceat(x, begin) if len(begin) else np.zeros(0, np.int64) for x in (left, right) for f in (np.minimum, np.maximum)]
        reach = np.maximum(self.band[first], self.band[first + size - 1]).astype(np.int32)
        columns = [[lang] * len(first), phrases, np.full(len(first), size, np.int32), reach, np.diff(np.append(begin, len(at))), *ends]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _PHRASE.types, strict=True)], schema=_PHRASE)

    def alive_pairs(self, pairs: np.ndarray) -> np.ndarray:
        """For each place whether a pair begins there that may be frequent enough."""
        at = self.pairs()
        known = np.minimum(self.band[at], self.band[at + 1]) <= self.round
        alive = np.zeros(len(self.row), bool)
        alive[at] = ~known | held(pairs, self.pair_hash(at) % np.uint64(BITS))
        return alive

    def longer(self, alive: np.ndarray, at: np.ndarray, hashed: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Which of the places of phrases of size - 1 words go on along such pairs, and the longer ones' hashes."""
        goes_on = alive[at + size - 2]
        return goes_on, mix(hashed[goes_on] * _MIX + self.hash_of[self.row[at[goes_on] + size - 1]])

    def bucket(self, hashed: np.ndarray) -> np.ndarray:
        return (hashed % np.uint64(self.n_buckets)).astype(np.int64)

    def buckets(self, pairs: np.ndarray) -> np.ndarray:
        """Buckets of the round's phrases of three words and more."""
        alive = self.alive_pairs(pairs)
        at = np.flatnonzero(alive)
        hashed, found = self.pair_hash(at), []
        for size in range(3, LONGEST + 1):
            goes_on, hashed = self.longer(alive, at, hashed, size)
            at = at[goes_on]
            found.append(self.bucket(hashed[self.due(at, size)]))
        return np.concatenate(found)

    def phrases(self, lang: str, pairs: np.ndarray, longer: np.ndarray) -> Iterator[pa.RecordBatch]:
        """The round's phrases, grown from their beginnings word by word as long as they may be frequent enough."""
        alive = self.alive_pairs(pairs)
        at = np.flatnonzero(alive)
        hashed = self.pair_hash(at)
        key = self.row[at] * len(self.codes.words) + self.row[at + 1]
        for size in range(2, LONGEST + 1):
            if size > 2:
                goes_on, hashed = self.longer(alive, at, hashed, size)
                at, key = at[goes_on], key[goes_on]
                # what is counted in a later round is not known yet
                known = np.minimum(self.band[at], self.band[at + size - 1]) <= self.round
                stays = ~known | held(longer, self.bucket(hashed))
                at, key, hashed = at[stays], key[stays], hashed[stays]
                prefix = np.unique(key, return_inverse=True)[1]
                key = prefix * len(self.codes.words) + self.row[at + size - 1]
            due = self.due(at, size)
            yield self.counted(lang, key[due], at[due], size)


def _grown(texts: DataFrame, round_: int, cells: Broadcast, schema: str, worker) -> DataFrame:
    """What a task's worker yields for stretches of text, each of one language and of about AT_ONCE words.

    `worker()` makes a pair of functions for a task: one of (growth, lang), and one for its end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_growth, at_end = worker()
        known: dict[str, Codes] = {}
        rows: dict[str, list[np.ndarray]] = {}
        n = 0

        def grown() -> Iterator[pa.RecordBatch]:
            for lang, parts in rows.items():
                yield from of_growth(Growth(known[lang], np.concatenate(parts), round_, BUCKETS), lang)
            rows.clear()
            if sum(map(len, known.values())) > REMEMBERED:
                known.clear()

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                if lang not in known:
                    known[lang] = Codes(lang, cells.value)
                codes = known[lang]
                for part in tokens(text.as_py()):
                    rows.setdefault(lang, []).append(np.fromiter(map(codes.__getitem__, part), np.int64, len(part)))
                    n += len(part)
                rows.setdefault(lang, []).append(np.zeros(1, np.int64))
                if n > AT_ONCE:
                    yield from grown()
                    n = 0
        yield from grown()
        yield from at_end()

    return texts.mapInArrow(run, schema)


def frequent_pairs(texts: DataFrame, round_: int, cells: Broadcast, least: int) -> DataFrame:
    """(hash) of the round's pairs with a count of `least` or more; pairs of equal hash count together."""
    hashed = _grown(texts, round_, cells, "hash long, n long", lambda: (lambda growth, lang: [growth.hashed_pairs()], list))
    return hashed.groupBy("hash").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("hash")


def frequent_buckets(texts: DataFrame, round_: int, cells: Broadcast, pairs: Broadcast, least: int) -> DataFrame:
    """(at) of the buckets to which the round's phrases of three words and more come `least` times or more.

    A task counts up to `least` in each bucket and sends chunks of counters; chunks are added up as they come
    in, so that memory stays with the chunks of a task whatever the number of tasks.
    """
    kind = np.uint8 if least <= 255 else np.uint32

    def worker():
        counts = np.zeros(BUCKETS, kind)

        def add(growth: Growth, lang: str) -> list:
            bucket, n = np.unique(growth.buckets(pairs.value), return_counts=True)
            counts[bucket] = np.minimum(counts[bucket] + n, least)
            return []

        def send() -> Iterator[pa.RecordBatch]:
            parts = counts.reshape(-1, CHUNK)
            used = np.flatnonzero(parts.any(axis=1))
            for some in np.array_split(used, max(1, len(used) // 256)):
                yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array([parts[k].tobytes() for k in some], pa.binary())], ["chunk", "counts"])

        return add, send

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, counts in zip(batch.column("chunk").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                held_ = sums.setdefault(chunk, np.zeros(CHUNK, np.int64))
                held_ += np.frombuffer(counts, kind)
        for chunk, counts in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(counts >= least) + chunk * CHUNK, pa.int64())], ["at"])

    chunks = _grown(texts, round_, cells, "chunk int, counts binary", worker)
    return chunks.repartition("chunk").mapInArrow(total, "at long")


def phrase_counts(texts: DataFrame, round_: int, cells: Broadcast, pairs: Broadcast, longer: Broadcast, least: int) -> DataFrame:
    """The round's phrases with a >= `least`."""
    found = _grown(texts, round_, cells, PHRASE, lambda: (lambda growth, lang: growth.phrases(lang, pairs.value, longer.value), list))
    sides = [f(c).alias(c) for s in ("left", "right") for f, c in ((F.min, f"{s}_low"), (F.max, f"{s}_high"))]
    return found.groupBy("lang", "phrase", "size", "reach").agg(F.sum("a").alias("a"), *sides).where(F.col("a") >= least)


# -- scores -------------------------------------------------------------------------------------------


def survivors(candidates: DataFrame, counts: DataFrame, totals: DataFrame) -> DataFrame:
    """Candidates that no longer phrase covers, with their weakest cut: (lang, phrase, a, l, r, n, score).

    `counts` (lang, part, f) holds every part; `totals` (lang, n)."""
    alone = [(F.col(f"{side}_low") != F.col(f"{side}_high")) | (F.col(f"{side}_low") == 0) for side in ("left", "right")]
    left = candidates.where((F.col("size") == LONGEST) | alone[0] & alone[1])
    cuts = left.select("lang", "phrase", "a", F.split("phrase", " ").alias("words"), F.explode(F.expr("sequence(1, size - 1)")).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.expr("array_join(slice(words, 1, k), ' ')").alias("first"), F.expr("array_join(slice(words, k + 1, size(words)), ' ')").alias("rest"))
    for name, count in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(counts.select("lang", F.col("part").alias(name), F.col("f").alias(count)), ["lang", name])
    wide = "decimal(38,0)"
    score = F.expr(f"cast(1000 as {wide}) * a * n div (cast(l as {wide}) * r)")
    scored = cuts.join(totals, "lang").withColumn("score", score)
    weakest = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("w"))
    return weakest.select("lang", "phrase", "a", "w.l", "w.r", "n", "w.score")


def _first(rows: DataFrame, keep: int) -> DataFrame:
    """Each language's first `keep` rows: of every slice, then of what is left, SLICES * keep rows at most."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(SLICES))
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", part).orderBy(*order))).where(F.col("rank") <= keep)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= keep)
    return rows.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocations(docs: DataFrame, least: int = 100, keep: int = 2000, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first `keep` collocations."""
    ship(docs.sparkSession)
    texts = _texts(docs, lang_col, text_col)
    words = cut(word_counts(texts).where(F.col("word").isNull() | (F.col("f") >= least)))
    totals = words.where("word is null").select("lang", F.col("f").alias("n"))
    frequent, lowest = banded(words.where("word is not null"))
    frequent = open_words = cut(frequent)
    lowest = cut(lowest)
    counts = frequent.select("lang", F.col("word").alias("part"), "f")
    phrases = pairs = longer = found = None
    for k in range(N_BANDS):
        place = remainder(F.xxhash64("lang", "word"), CELLS) * 4 + F.col("band")
        cells = field(open_words, place, 4 * CELLS)
        hashes = cut(frequent_pairs(texts, k, cells, least))
        pairs = hashes if pairs is None else pairs.unionByName(hashes)
        pair_field = field(pairs, remainder(F.col("hash"), BITS))
        buckets = cut(frequent_buckets(texts, k, cells, pair_field, least))
        longer = buckets if longer is None else longer.unionByName(buckets)
        new = cut(phrase_counts(texts, k, cells, pair_field, field(longer, F.col("at"), BUCKETS), least))
        phrases = new if phrases is None else phrases.unionByName(new)
        counts = counts.unionByName(new.select("lang", F.col("phrase").alias("part"), F.col("a").alias("f")))
        more = cut(survivors(phrases.where(F.col("reach") == k), counts, totals))
        found = more if found is None else found.unionByName(more)
        if k + 1 == N_BANDS:
            break
        ahead = lowest.where(F.col("band") > k).groupBy("lang").agg(F.min("lowest").alias("lowest")).join(totals, "lang")
        bound = ahead.select("lang", F.expr("cast(1000 as decimal(38,0)) * n div lowest").alias("bound"))
        above = found.join(bound, "lang").where("score > bound").groupBy("lang").agg(F.count(F.lit(1)).alias("settled"))
        unsettled = bound.join(above, "lang", "left").where(F.coalesce("settled", F.lit(0)) < keep).select("lang")
        if unsettled.isEmpty():
            break
        open_words = cut(open_words.join(unsettled, "lang", "left_semi"))
    return _first(found, keep)
