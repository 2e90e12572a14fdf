"""Ranked lexical search with term partitioning, pipelined.

Documents are posted in blocks of bounded size. The terms of the queries are dealt to owners: the rarest
to the first, the most frequent to the last. A bundle belongs to a block and a slice of up to `SLICE` items;
it carries the items' sparse accumulators (item, document, score so far) and visits one owner after the
other. At each stop a cogroup brings the bundle together with that owner's postings of the block, and
integer contributions are added. Documents that can't reach their item's best even with all that the
remaining owners could add leave the bundle; this loses no result. After the last owner each block names
its best, and a final selection ranks those.

The documents' scan looks only for words that some item may hold, told by a bit field of fixed size; words
that pass by chance find no owner. Blocks are written to the shared checkpoint folder once; totals,
weights and all stages read them there.

Defined results: documents and items without a term (null, empty, only separators) match nothing. Equal
scores go by ascending doc_id, null ids last; repeated documents are ranked one by one. Repeated items
are answered one by one. Empty tables give no rows. Other columns are left out. Memory follows the longest
text, and blocks and slices of fixed bounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, id_and_text, ship
from .decontaminate import words_of
from .sketch import field, key_hash, remainder

#: Documents, and words, at which a block ends; items of a slice.
BLOCK_DOCS, BLOCK_WORDS, SLICE = 4096, 1 << 21, 256
#: Share of all postings that the owners up to each one hold, from the rarest terms on.
OWNERS = (1 / 16, 1 / 4, 1.0)
#: Bits of the field of query words (512 KB).
FIELD_BITS = 1 << 22
#: Rows of the query terms that are broadcast; more are joined by a shuffle.
MOST_BROADCAST = 200_000
#: No contribution reaches its weight times this.
CEILING = 1_000_000
REMEMBERED = 1 << 19


class QueryWords(dict):
    """Code of a word that some item may hold, else -1; the codes stand for `words`."""

    def __init__(self, bits: np.ndarray):
        super().__init__()
        self.bits = bits
        self.words: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        at = key_hash(word) % (64 * len(self.bits))
        code = -1
        if int(self.bits[at >> 6]) >> (at & 63) & 1:
            code = len(self.words)
            self.words.append(word)
        self[word] = code
        return code

    def forget(self) -> None:
        if len(self) > REMEMBERED:
            self.clear()
            self.words = []


# -- items ----------------------------------------------------------------------------------------

ITEM = "slice long, idx int, item_id {kind}, terms array<binary>"


def sliced_items(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(slice, idx, item_id, terms): each row of the items with its different terms, up to SLICE a slice."""
    kind = items.schema[id_col].dataType.simpleString()
    rows = items.select(F.col(f"`{id_col}`").alias("item_id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, n = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            terms = [sorted(set(words_of(t))) for t in batch.column("text").to_pylist()]
            at = range(n, n + len(terms))
            n += len(terms)
            yield pa.RecordBatch.from_arrays(
                [pa.array([base + k // SLICE for k in at], pa.int64()), pa.array([k % SLICE for k in at], pa.int32()), batch.column("item_id"), pa.array(terms, pa.list_(pa.binary()))],
                ["slice", "idx", "item_id", "terms"],
            )

    return rows.mapInArrow(run, ITEM.format(kind=kind))


# -- blocks of postings -----------------------------------------------------------------------------

#: A block has one row without term (its documents' ids, whether they are null, and lengths) and one for each
#: term (places in the block, occurrences); all packed as little-endian integers.
BLOCK = "block long, term binary, n_docs long, n_words long, docs binary, tfs binary, absent binary"
_BLOCK = pa.schema([("block", pa.int64()), ("term", pa.binary()), ("n_docs", pa.int64()), ("n_words", pa.int64()), ("docs", pa.binary()), ("tfs", pa.binary()), ("absent", pa.binary())])


class Block:
    """Documents gathered until the block is full."""

    def __init__(self, known: QueryWords, most_docs: int, most_words: int):
        self.known, self.most_docs, self.most_words = known, most_docs, most_words
        self.ids: list[int | None] = []
        self.lengths: list[int] = []
        self.codes: list[np.ndarray] = []
        self.n_words = 0

    def add(self, doc_id: int | None, words: list[bytes]) -> None:
        codes = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        self.codes.append(codes[codes >= 0])
        self.ids.append(doc_id)
        self.lengths.append(len(words))
        self.n_words += len(words)

    def full(self) -> bool:
        return len(self.ids) >= self.most_docs or self.n_words >= self.most_words

    def rows(self, block: int) -> pa.RecordBatch:
        n = len(self.ids)
        at = np.repeat(np.arange(n), [len(c) for c in self.codes])
        key, tf = np.unique(np.concatenate([*self.codes, np.zeros(0, np.int64)]) * n + at, return_counts=True)
        code, doc = np.divmod(key, n)
        begin = np.flatnonzero(np.diff(code, prepend=-1))
        end = np.append(begin[1:], len(code))
        doc, tf = doc.astype("<i4"), tf.astype("<i4")
        ids = np.array([i or 0 for i in self.ids], "<i8")
        rows = [(block, None, n, self.n_words, ids.tobytes(), np.array(self.lengths, "<i8").tobytes(), np.array([i is None for i in self.ids], bool).tobytes())]
        rows += [(block, self.known.words[code[b]], int(e - b), None, doc[b:e].tobytes(), tf[b:e].tobytes(), None) for b, e in zip(begin, end, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _BLOCK.types, strict=True)], schema=_BLOCK)


def posted(docs: DataFrame, words: Broadcast) -> DataFrame:
    """Blocks of the documents that have a term, with postings of the words that may be asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = QueryWords(words.value)
        block, n = Block(known, BLOCK_DOCS, BLOCK_WORDS), TaskContext.get().partitionId() << 32
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                found = words_of(text.as_py())
                if not found:
                    continue
                block.add(doc_id, found)
                if block.full():
                    yield block.rows(n)
                    known.forget()
                    block, n = Block(known, BLOCK_DOCS, BLOCK_WORDS), n + 1
        if block.ids:
            yield block.rows(n)

    return docs.mapInArrow(run, BLOCK)


# -- owners -----------------------------------------------------------------------------------------


def owned_terms(index: DataFrame, items: DataFrame, n_docs: int) -> DataFrame:
    """(term, slice, w, owner, asked): `asked` holds for each item its place in the slice and the most that
    later owners can add to its scores."""
    asked = items.select("slice", "idx", F.explode("terms").alias("term"))
    df = index.where("term is not null").groupBy("term").agg(F.sum("n_docs").alias("df"))
    weighed = asked.select("term").distinct().join(df, "term").select("term", "df", F.floor(1000 * F.log((2.0 * n_docs + 2) / (2.0 * F.col("df") + 1))).cast("long").alias("w"))
    weighed = cut(weighed)
    # weights are below 1000 * ln(2**64): a histogram of bounded size says where each owner ends
    steps = weighed.groupBy(F.expr("w div 100").alias("step")).agg(F.sum("df").alias("postings")).orderBy(F.desc("step")).collect()
    total, done, owner = sum(r.postings for r in steps), 0, F.lit(len(OWNERS) - 1)
    ends = []
    for r in steps:
        done += r.postings
        ends.append((r.step, next(k for k, share in enumerate(OWNERS) if done <= share * total or k == len(OWNERS) - 1)))
    for k in reversed(range(len(OWNERS) - 1)):
        if own := [step for step, o in ends if o == k]:
            owner = F.when(F.expr("w div 100") >= min(own), k).otherwise(owner)
    rows = asked.join(weighed.select("term", "w", owner.alias("owner")), "term")
    of_item = Window.partitionBy("slice", "idx").orderBy(F.desc("owner")).rangeBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("later", F.coalesce(F.sum("w").over(of_item), F.lit(0)) * CEILING)
    return rows.groupBy("term", "slice", "w", "owner").agg(F.collect_list(F.struct("idx", "later")).alias("asked"))


# -- the pipeline -----------------------------------------------------------------------------------

#: docs: ids, lengths as m, absent; accumulators: item, document in the block, score.
BUNDLE = "slice long, block long, docs binary, ms binary, absent binary, item binary, doc binary, score binary"
COLUMNS = ["slice", "block", "docs", "ms", "absent", "item", "doc", "score"]


def _contributions(postings: pd.DataFrame, ms: np.ndarray) -> dict[int, tuple[int, list[tuple[np.ndarray, np.ndarray]]]]:
    """For each item: the most that later owners can add, and documents with what each of its terms adds."""
    out: dict[int, tuple[int, list]] = {}
    for docs, tfs, w, asked in zip(postings["docs"], postings["tfs"], postings["w"], postings["asked"], strict=True):
        at, tf = np.frombuffer(docs, "<i4"), np.frombuffer(tfs, "<i4").astype(np.int64)
        add = int(w) * ((1_000_000_000 * tf) // (1000 * tf + 20 * ms[at]))
        for item in asked:
            out.setdefault(item["idx"], (item["later"], []))[1].append((at, add))
    return out


def _stop(best: int):
    """One stop of a bundle at an owner."""

    def add(key: tuple, postings: pd.DataFrame, bundle: pd.DataFrame) -> pd.DataFrame:
        if bundle.empty:
            return pd.DataFrame([], columns=COLUMNS)
        row = bundle.iloc[0]
        ms = np.frombuffer(row["ms"], "<i8")
        item, doc, score = np.frombuffer(row["item"], "<i4"), np.frombuffer(row["doc"], "<i4"), np.frombuffer(row["score"], "<i8")
        begin = dict(zip(*np.unique(item, return_index=True), strict=True))
        end = {i: b + np.count_nonzero(item == i) for i, b in begin.items()}
        new = _contributions(postings, ms)
        kept = []
        for i in sorted({*begin, *new}):
            if i not in new:  # nothing changes here
                at = slice(begin[i], end[i])
                kept.append((i, doc[at], score[at]))
                continue
            later, adds = new[i]
            sums = np.zeros(len(ms), np.int64)
            if i in begin:
                sums[doc[begin[i] : end[i]]] = score[begin[i] : end[i]]
            for at, more in adds:
                sums[at] += more
            at = np.flatnonzero(sums)
            if len(at) > best:
                least = np.partition(sums[at], -best)[-best]
                at = at[sums[at] + later >= least]
            kept.append((i, at.astype("<i4"), sums[at]))
        none = np.zeros(0, "<i4")
        packed = [np.concatenate([np.full(len(d), i, "<i4") for i, d, _ in kept] or [none]), np.concatenate([d for _, d, _ in kept] or [none]), np.concatenate([s for _, _, s in kept] or [none])]
        out = [*key, row["docs"], row["ms"], row["absent"], *[x.astype(t).tobytes() for x, t in zip(packed, ("<i4", "<i4", "<i8"), strict=True)]]
        return pd.DataFrame([out], columns=COLUMNS)

    return add


def _best_of_block(best: int):
    """The items' best documents of each bundle, equal scores by id, null ids last."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                ids, absent = np.frombuffer(row.docs, "<i8"), np.frombuffer(row.absent, bool)
                item, doc, score = np.frombuffer(row.item, "<i4"), np.frombuffer(row.doc, "<i4"), np.frombuffer(row.score, "<i8")
                order = np.lexsort((ids[doc], absent[doc], -score, item))
                item, doc, score = item[order], doc[order], score[order]
                first = np.flatnonzero(np.diff(item, prepend=-1))
                top = np.arange(len(item)) - np.repeat(first, np.diff(np.append(first, len(item)))) < best
                found = pd.Series(ids[doc[top]], dtype="Int64").mask(absent[doc[top]])
                yield pd.DataFrame({"slice": row.slice, "idx": item[top], "doc_id": found, "score": score[top]})

    return run


def search(docs: DataFrame, items: DataFrame, best: int = 50, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """(item_id, rank, doc_id, score): each item's `best` documents with a score above 0."""
    spark = docs.sparkSession
    ship(spark)
    items = cut(sliced_items(items, item_col))
    words = field(items.select(F.explode("terms").alias("term")), remainder(F.xxhash64("term"), FIELD_BITS), FIELD_BITS)
    index = cut(posted(id_and_text(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long")), words))
    blocks = index.where("term is null")
    totals = blocks.agg(F.coalesce(F.sum("n_docs"), F.lit(0)).alias("n"), F.coalesce(F.sum("n_words"), F.lit(0)).alias("l")).first()
    terms = cut(owned_terms(index, items, totals.n))
    small = terms.count() <= MOST_BROADCAST
    n_docs, n_words = totals.n, max(totals.l, 1)

    @F.pandas_udf("binary")
    def length_norm(lengths: pd.Series) -> pd.Series:
        return lengths.map(lambda x: (50 + (50 * np.frombuffer(x, "<i8") * n_docs) // n_words).tobytes())

    def postings(owner: int | None) -> DataFrame:
        own = terms if owner is None else terms.where(F.col("owner") == owner)
        return index.where("term is not null").join(F.broadcast(own) if small else own, "term")

    nothing = F.lit(b"").cast("binary")
    bundles = postings(None).select("slice", "block").distinct().join(blocks.select("block", "docs", length_norm("tfs").alias("ms"), "absent"), "block")
    # names of their own: both sides of the first cogroup come from the same postings
    bundles = bundles.select(*[F.col(c).alias(c) for c in COLUMNS[:5]], *[nothing.alias(c) for c in COLUMNS[5:]])
    key = ["slice", "block"]
    for owner in range(len(OWNERS)):
        own = postings(owner).select(*key, "docs", "tfs", "w", "asked")
        bundles = own.groupBy(*key).cogroup(bundles.groupBy(*key)).applyInPandas(_stop(best), BUNDLE)
    rows = bundles.mapInPandas(_best_of_block(best), "slice long, idx int, doc_id long, score long")
    ranked = Window.partitionBy("slice", "idx").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    rows = rows.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= best)
    return rows.join(items.select("slice", "idx", "item_id"), ["slice", "idx"]).select("item_id", "rank", "doc_id", "score")
