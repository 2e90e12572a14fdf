"""Benchmark decontamination as a prefix-filtered set join with exact windows.

A window is a run of `WINDOW` words of a benchmark item; an item with fewer words is one window. To
contain a window a text must contain its rarest word, so this one word is the window's necessary
prefix (the prefix of a containment of 1). Words are ordered by how often all documents hold them.
Each occurrence of a prefix word meets the windows posted under it; its place must leave room for the
window inside the text (position and length bounds), and then the words are compared one by one, so
that results are exact.

The index of the items goes to the executors whole while its texts are within `index_bytes`; larger
sets of items are split into slices of that size, which pass over the documents in turn, each pass
written to the shared checkpoint folder before the next.

Defined results: null and empty texts have no words, no hits and are not contaminated. Null items
have no windows; repeated items count once, a null item_id as the empty id. Without items nothing is
hit. Repeated documents give repeated results. Memory follows the longest text and the index bound.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, id_and_text, ship, unused, utf8

WINDOW = 13
#: Bytes of item texts that one index may hold.
INDEX_BYTES = 32 << 20
#: Pairs of a prefix word's place and a window that are compared at a time.
AT_ONCE = 1 << 20
#: Texts of this many words together are looked at in one go.
WORDS_AT_ONCE = 1 << 19

# Letters and digits of ASCII and all that is beyond it belong to words; A-Z become a-z.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return utf8(text).translate(_FOLD).split()


class WindowIndex:
    """Windows of items, posted under their rarest words."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.ids: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[str]] = {}
        for item, words in items:
            row = [self.ids.setdefault(w, len(self.ids)) for w in words]
            for at in range(max(1, len(row) - window + 1) if row else 0):
                found.setdefault(tuple(row[at : at + window]), set()).add(item)
        self.windows = list(found)
        self.items = [sorted(found[w]) for w in self.windows]

    def post(self, count: dict[int, int]) -> None:
        """Order words by rarity and post every window under its rarest one."""
        n, size = len(self.windows), self.window
        rarity = np.array([count.get(i, 0) for i in range(len(self.ids))] or [0], np.int64)
        self.length = np.array([len(w) for w in self.windows], np.int64)
        self.words = np.full((n, size), -2, np.int32)
        for k, w in enumerate(self.windows):
            self.words[k, : len(w)] = w
        prefix = np.array([min(w, key=lambda i: (rarity[i], i)) for w in self.windows], np.int64)
        self.offset = np.array([w.index(p) for w, p in zip(self.windows, prefix, strict=True)], np.int64)
        self.posted = np.argsort(prefix, kind="stable")
        bounds = np.searchsorted(prefix[self.posted], np.arange(len(self.ids) + 1))
        # one more entry, of no windows, for words that no item has (they get the number -1)
        self.first = np.append(bounds[:-1], 0)
        self.n_posted = np.append(np.diff(bounds), 0)
        del self.windows

    def numbers(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.ids.get, words, repeat(-1)), np.int32, len(words))

    def occurrences(self, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(starts, windows) of all windows in a row of word numbers."""
        places = np.flatnonzero(self.n_posted[row])
        starts, windows = [], []
        ends = np.cumsum(self.n_posted[row[places]])
        at = 0
        while at < len(places):
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + AT_ONCE, side="right")))
            part = places[at:to]
            n = self.n_posted[row[part]]
            nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            w = self.posted[np.repeat(self.first[row[part]], n) + nth]
            start = np.repeat(part, n) - self.offset[w]
            keep = (start >= 0) & (start + self.length[w] <= len(row))
            start, w = start[keep], w[keep]
            for j in range(self.window):
                inside = j < self.length[w]
                same = ~inside
                same[inside] = row[start[inside] + j] == self.words[w[inside], j]
                start, w = start[same], w[same]
            starts.append(start)
            windows.append(w)
            at = to
        if not starts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(starts), np.concatenate(windows)

    def hits(self, many: list[list[bytes]]) -> list[tuple[list[list[int]], list[str]]]:
        """For each text the spans of hit words (from, to) and the items whose windows occur."""
        size = self.window
        lengths = np.array([len(w) for w in many], np.int64)
        begins = np.cumsum(lengths + size) - lengths - size
        row = np.full(int((lengths + size).sum()), -1, np.int32)
        for begin, words in zip(begins, many, strict=True):
            row[begin : begin + len(words)] = self.numbers(words)
        out: list[tuple[list[list[int]], list[str]]] = [([], []) for _ in many]
        starts, windows = self.occurrences(row)
        if not len(starts):
            return out
        change = np.zeros(len(row) + 1, np.int64)
        np.add.at(change, starts, 1)
        np.subtract.at(change, starts + self.length[windows], 1)
        edges = np.diff(np.concatenate(([0], (np.cumsum(change[:-1]) > 0).astype(np.int8), [0])))
        text_of = lambda at: np.searchsorted(begins, at, side="right") - 1
        for a, b in zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1), strict=True):
            k = text_of(a)
            out[k][0].append([int(a - begins[k]), int(b - begins[k])])
        for k, w in np.unique(np.stack([text_of(starts), windows]), axis=1).T:
            out[k][1].extend(self.items[w])
        return [(spans, sorted(set(items))) for spans, items in out]


def _slices(benchmark: DataFrame, index_bytes: int) -> list[DataFrame]:
    """The items, in parts whose texts are within the bound."""
    total = benchmark.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    n = -(-total // index_bytes) if total > index_bytes else 1
    if n == 1:
        return [benchmark]
    n *= 2  # room for uneven slices
    return [benchmark.where(F.pmod(F.xxhash64("item"), F.lit(n)) == k) for k in range(n)]


def _index(docs: DataFrame, items: DataFrame, window: int) -> Broadcast:
    """The posted index of one slice; the words' counts come from all documents."""
    spark = docs.sparkSession
    index = WindowIndex([(r.item, words_of(r.text)) for r in items.toLocalIterator()], window)
    sent = spark.sparkContext.broadcast(index.ids)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        get, n = sent.value.get, len(sent.value)
        total = np.zeros(n + 1, np.int64)
        for batch in batches:
            for text in batch["text"]:
                words = words_of(text if isinstance(text, str) else None)
                total += np.bincount(np.fromiter(map(get, words, repeat(n)), np.int64, len(words)), minlength=n + 1)
        some = np.flatnonzero(total[:n])
        yield pd.DataFrame({"word": some, "n": total[some]})

    counted = docs.select("text").mapInPandas(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    index.post({r.word: r.n for r in counted.toLocalIterator()} if index.ids else {})
    return spark.sparkContext.broadcast(index)


def _found(index: Broadcast):
    @F.pandas_udf("n_words long, spans array<array<long>>, items array<string>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows, part, n = [], [], 0
            for text in [*texts, None]:
                part.append(words_of(text if isinstance(text, str) else None))
                n += len(part[-1])
                if n >= WORDS_AT_ONCE or len(rows) + len(part) > len(texts):
                    rows += [(len(w), *hit) for w, hit in zip(part, index.value.hits(part), strict=True)]
                    part, n = [], 0
            yield pd.DataFrame(rows[: len(texts)], columns=["n_words", "spans", "items"])

    return run


def _merged():
    """What two slices found in the same texts, together."""

    @F.pandas_udf("n_words long, spans array<array<long>>, items array<string>")
    def run(n_words: pd.Series, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for n, s, t, i, j in zip(n_words, a["spans"], b["spans"], a["items"], b["items"], strict=True):
            spans: list[list[int]] = []
            for x, y in sorted((int(x), int(y)) for x, y in [*s, *t]):
                if spans and x <= spans[-1][1]:
                    spans[-1][1] = max(y, spans[-1][1])
                else:
                    spans.append([x, y])
            rows.append((n, spans, sorted({*i, *j})))
        return pd.DataFrame(rows, columns=["n_words", "spans", "items"])

    return run


def with_hits(docs: DataFrame, benchmark: DataFrame, into: str, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """All columns of `docs` and a struct `into` of n_words, spans of hit words and items found."""
    ship(docs.sparkSession)
    items = benchmark.select(F.coalesce(F.col(f"`{item_col}`").cast("string"), F.lit("")).alias("item"), F.col(f"`{item_text_col}`").cast("string").alias("text")).where(F.col("text").isNotNull())
    text = F.col(f"`{text_col}`").cast("string")
    out = None
    for part in _slices(items, index_bytes):
        found = _found(_index(docs.select(text.alias("text")), part, window))
        if out is None:
            out = docs.withColumn(into, found(text))
        else:
            (spare,) = unused(out, "_more")
            more = cut(out).withColumn(spare, found(text))
            out = more.withColumn(into, _merged()(F.col(f"`{into}`.n_words"), F.col(f"`{into}`"), F.col(spare))).drop(spare)
    return out


def hit_words(found: str) -> F.Column:
    return F.aggregate(f"{found}.spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])


def contaminated(found: str) -> F.Column:
    """At least one word in twenty is hit."""
    return (hit_words(found) > 0) & (20 * hit_words(found) >= F.col(f"{found}.n_words"))


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per row: doc_id, n_words, n_hit, items found, spans of hit words, contaminated."""
    rows = with_hits(id_and_text(docs, id_col, text_col), benchmark, "found", **options)
    return rows.select("doc_id", "found.n_words", hit_words("found").alias("n_hit"), F.col("found.items").alias("items"), F.col("found.spans").alias("spans"), contaminated("found").alias("contaminated"))


def items_digest(items: F.Column) -> F.Column:
    return F.sha2(F.array_join(F.array_sort(items), ",").cast("binary"), 256)
