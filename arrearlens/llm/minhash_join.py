"""Near-duplicates by an inverted join on signature coordinates.

A text's set is its distinct runs of five words, hashed to 64 bits; fewer words make one run. Texts of
equal sets form a class, and only classes go on. A class has a signature of `COORDINATES` minima, and
is posted under each pair of a coordinate and its value. Two classes at the similarity threshold share
at least `least_matches` pairs (all but about one in a hundred million times, at every threshold), so
they share one among the `COORDINATES - least_matches + 1` rarest pairs of each: only this prefix is
posted, and a pair that no other class has is skipped.

In a posting every class is first compared with a few hubs of that posting, not with all others: the
class that shares most, and some by chance. Classes whose postings still hold several components are
then joined among themselves on the rarest shingles of their full sets, under length and positional
bounds; a few bits of every coordinate travel along, and pairs that differ in too many coordinates don't
leave the join. Of every pair of classes that either step finds the collisions are counted, coordinate by
coordinate; pairs with fewer than `least_matches` go, and the others are confirmed on the full sets. So a
group of thousands of copies costs a few comparisons a member, and no link between different components
is left out.

Defined results: texts without words have an empty set and are linked with nothing, as are rows without
an id (whose component is null and which are kept). Repeated rows are one class. An empty table gives
no rows. The component of a document is the smallest id it reaches.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, mix, ship, shingle_hashes, unused, utf8, word_hashes

SHINGLE = 5
#: Links: 100 * intersection >= PERCENT * union.
PERCENT = 85
COORDINATES = 64
#: Chance that a pair at the threshold has fewer matches than are asked for.
MISSED = 1e-8
HUBS = 3
#: Ids of this many classes (16 bytes each) may be broadcast; more are joined by a shuffle.
BROADCAST_IDS = 500_000
#: Prefixes of so many shingles are carried whole in the last join; of longer ones so many shingles before each.
SHORT_PREFIX, BEFORE = 32, 16
#: Bits of each coordinate that travel along there.
BITS = 4
_BIT_COLUMNS = [f"bits{k}" for k in range(BITS)]
_AT_ONCE = 2048

_SEEDS = mix(np.arange(1, 2 * COORDINATES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_A, _B = _SEEDS[:COORDINATES, None] | np.uint64(1), _SEEDS[COORDINATES:, None]


def least_matches(similar: int) -> int:
    """The coordinates in which two sets at the threshold agree, but for `MISSED` of them, by the binomial tail."""
    p, tail, least = similar / 100, 0.0, 0
    while least < COORDINATES and (tail := tail + math.comb(COORDINATES, least) * p**least * (1 - p) ** (COORDINATES - least)) <= MISSED:
        least += 1
    if not 0 < p <= 1 or not least:
        raise ValueError(f"signatures of {COORDINATES} coordinates don't find pairs at a similarity of {similar} %")
    return least


def shingle_set(text: str | None) -> np.ndarray:
    """The sorted distinct hashes of a text's runs of words; A-Z count as a-z."""
    data = utf8(text).lower()
    return np.unique(shingle_hashes(word_hashes(data)[0], SHINGLE)) if data else np.zeros(0, np.uint64)


def class_of(found: np.ndarray) -> bytes:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


def signature(found: np.ndarray) -> np.ndarray:
    least = np.full(COORDINATES, 2**32 - 1, np.uint64)
    for at in range(0, len(found), _AT_ONCE):
        least = np.minimum(least, ((found[None, at : at + _AT_ONCE] * _A + _B) >> np.uint64(32)).min(axis=1))
    return least.astype(np.uint32).view(np.int32)


def leading_bits(sig: np.ndarray) -> np.ndarray:
    """BITS numbers, the b-th of the b-th bit of every coordinate."""
    bits = (sig.view(np.uint32)[None, :] >> np.arange(BITS, dtype=np.uint32)[:, None]) & np.uint32(1)
    return np.packbits(bits.astype(np.uint8), axis=1).view(np.int64)[:, 0]


def described(text: Column) -> Column:
    """A struct of a text's set size, class, signature and the signature's leading bits."""

    @F.pandas_udf("n_shingles long, cls binary, sig array<int>, bits array<long>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            sets = [shingle_set(t if isinstance(t, str) else None) for t in texts]
            sigs = [signature(s) for s in sets]
            yield pd.DataFrame({"n_shingles": [len(s) for s in sets], "cls": [class_of(s) for s in sets], "sig": sigs, "bits": [leading_bits(s) for s in sigs]})

    return run(text)


def _postings(classes: DataFrame, least: int) -> DataFrame:
    """(cls, key, weight) of the prefix: the rarest pairs of coordinate and value that another class has too.

    A class's weight is how many classes hold its pairs, all added up: high in the middle of a group.
    """
    every = classes.select("cls", F.posexplode("sig").alias("i", "v")).select("cls", (F.col("i") * F.lit(2**32) + F.col("v")).alias("key"))
    shared = every.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    own = Window.partitionBy("cls")
    ranked = every.join(shared, "key").withColumns({"nth": F.row_number().over(own.orderBy("n", "key")), "held": F.count("*").over(own), "weight": F.sum("n").over(own)})
    # a class's pairs that nobody shares are its rarest: they fill the prefix first
    return ranked.where(F.col("nth") + COORDINATES - F.col("held") <= COORDINATES - least + 1).select("cls", "key", "weight")


def _with_hubs(postings: DataFrame) -> DataFrame:
    """Pairs of each class and the hubs of its postings: the class in the middle, and some by chance."""
    found = None
    for seed in range(HUBS):
        order = F.xxhash64("cls", F.lit(seed)) if seed else -F.col("weight")
        hubs = postings.groupBy("key").agg(F.min(F.struct(order.alias("draw"), "cls")).alias("hub")).select("key", F.col("hub.cls").alias("hub"))
        part = postings.join(hubs, "key").where("cls <> hub").select(F.least("cls", "hub").alias("a"), F.greatest("cls", "hub").alias("b")).distinct()
        found = part if found is None else found.unionAll(part)
    return found.distinct()


def _colliding(pairs: DataFrame, classes: DataFrame, least: int) -> DataFrame:
    """The pairs whose signatures agree in `least` coordinates or more."""
    of = lambda s: classes.select(F.col("cls").alias(s), F.col("sig").alias(f"sig_{s}"))
    both = pairs.join(of("a"), "a").join(of("b"), "b")
    matches = F.size(F.filter(F.zip_with("sig_a", "sig_b", lambda x, y: x == y), lambda same: same))
    return both.where(matches >= least).select("a", "b")


def _across(postings: DataFrame, labels: DataFrame, sets: DataFrame, classes: DataFrame, similar: int, least: int) -> DataFrame:
    """Pairs of different components that may still be linked, from classes whose postings hold several.

    These few classes are joined on the rarest of their shingles: shingles that no other of them has come
    first and only use up the prefix, and what is left of a class bounds what it can share with another.
    """
    labelled = postings.select("cls", "key").join(labels.select("cls", "label"), "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    mixed = labelled.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("key")
    open_ = cut(labelled.join(mixed, "key", "left_semi").select("cls", "label").distinct())
    every = sets.join(open_.select("cls"), "cls", "left_semi").select("cls", F.size("shingles").alias("n"), F.explode("shingles").alias("token"))
    shared = every.groupBy("token").agg(F.count("*").alias("held")).where("held > 1")
    own = Window.partitionBy("cls")
    ranked = every.join(shared, "token").withColumns({"at": F.row_number().over(own.orderBy("held", "token")), "s": F.count("*").over(own)})
    prefix = F.col("n") - F.ceil(F.col("n") * similar / 100) + 1
    posted = ranked.where(F.col("n") - F.col("s") + F.col("at") <= prefix).groupBy("cls", "n", "s").agg(F.sort_array(F.collect_list(F.struct("at", "token"))).alias("rows"))
    bits = [F.get("bits", F.lit(k)).alias(b) for k, b in enumerate(_BIT_COLUMNS)]
    posts = posted.join(open_, "cls").join(classes.select("cls", *bits), "cls").withColumns({"p": F.size("rows"), "tokens": F.col("rows.token")})
    first = lambda i: F.greatest(i - BEFORE, F.lit(0))
    known = lambda i: F.when(F.col("p") <= SHORT_PREFIX, F.col("tokens")).otherwise(F.slice("tokens", first(i) + 1, i - first(i)))
    rows = F.transform("rows", lambda x, i: F.struct(x["token"].alias("token"), x["at"].alias("at"), known(i).alias("known")))
    posts = cut(posts.select("cls", "label", "n", "s", *_BIT_COLUMNS, "p", F.inline(rows)))
    return _meeting(posts, similar, least).distinct()


def _meeting(posts: DataFrame, similar: int, least: int) -> DataFrame:
    """Pairs (a, b) of different components from postings under one shingle, hardly any of them twice.

    A short prefix travels along whole, so that its pairs are counted out and named once, at their least common
    shingle. With a longer one go the `BEFORE` shingles that come before each: two classes that share one of
    these have met there. All prefixes stand in the same order, so a pair is named where it first shares one.
    """
    side = lambda x: posts.select(*[F.col(c).alias(f"{c}_{x}") for c in ("token", "cls", "label", "n", "at", "s", "p", "known", *_BIT_COLUMNS)])
    # coordinates that agree have all their bits in common
    differing = reduce(lambda x, y: x.bitwiseOR(y), [F.col(f"{b}_a").bitwiseXOR(F.col(f"{b}_b")) for b in _BIT_COLUMNS])
    collide = F.bit_count(differing) <= COORDINATES - least
    n, m, i, j, s, t = (F.col(c) for c in ("n_a", "n_b", "at_a", "at_b", "s_a", "s_b"))
    wanted = F.ceil((n + m) * similar / (100 + similar))
    sizes = F.least(n, m) * 100 >= F.greatest(n, m) * similar
    room = (F.least(s, t) >= wanted) & (F.least(i, j) + F.least(s - i, t - j) >= wanted)
    common = F.array_intersect("known_a", "known_b")
    # behind the shorter prefix there are at most as many shared shingles as one of both has left
    enough = F.size(common) + F.greatest(s - F.col("p_a"), t - F.col("p_b")) >= wanted
    short = F.greatest("p_a", "p_b") <= SHORT_PREFIX
    once = F.when(short, enough & (F.array_min(common) == F.col("token_a"))).otherwise(~F.arrays_overlap("known_a", "known_b"))
    meet = (F.col("token_a") == F.col("token_b")) & (F.col("label_a") < F.col("label_b")) & sizes & room & collide & once
    return side("a").join(side("b"), meet).select(F.least("cls_a", "cls_b").alias("a"), F.greatest("cls_a", "cls_b").alias("b"))


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cls, shingles) of the wanted classes, computed again from one document of each."""
    few = wanted.count() <= BROADCAST_IDS
    ids = wanted.select(F.col("rep").alias("doc_id"), F.col("cls").alias("want"))
    rows = docs.select("doc_id", "text").join(F.broadcast(ids) if few else ids, "doc_id").select("want", "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for want, text in zip(batch["want"], batch["text"], strict=True):
                found = shingle_set(text if isinstance(text, str) else None)
                if class_of(found) == bytes(want):  # an id may have several texts
                    out.append((bytes(want), found.view(np.int64)))
            yield pd.DataFrame(out, columns=["cls", "shingles"])

    return rows.mapInPandas(run, "cls binary, shingles array<long>").groupBy("cls").agg(F.first("shingles").alias("shingles"))


def _confirmed(pairs: DataFrame, sets: DataFrame, similar: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    of = lambda s: sets.select(F.col("cls").alias(s), F.col("shingles").alias(f"of_{s}"))
    both = pairs.join(of("a"), "a").join(of("b"), "b")
    common = F.size(F.array_intersect("of_a", "of_b"))
    either = F.size("of_a") + F.size("of_b") - common
    return both.where(common * 100 >= either * similar).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """(cls, label) of linked classes: the smallest class each can reach.

    Labels spread to neighbours and then jump to the label of their label, so that the rounds grow with
    the logarithm of a component's width. Each round is cut at the checkpoint folder.
    """
    both = cut(links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    labels = cut(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("cls"), F.least("a", "b").alias("label")))
    while True:
        reached = both.join(labels, both["b"] == labels["cls"]).groupBy("a").agg(F.min("label").alias("reached"))
        wider = labels.join(reached, F.col("cls") == F.col("a")).select("cls", F.least("label", "reached").alias("next"), "label")
        far = labels.select(F.col("cls").alias("via"), F.col("label").alias("beyond"))
        jumped = cut(wider.join(far, F.col("next") == F.col("via")).select("cls", F.least("next", "beyond").alias("label"), (F.least("next", "beyond") != F.col("label")).alias("moved")))
        labels = jumped.select("cls", "label")
        if jumped.where("moved").isEmpty():
            return labels


def near_duplicates(docs: DataFrame, similar: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, text_key (a hash of the text), n_shingles, component (its key, null if empty), component_id, kept."""
    least = least_matches(similar)
    ship(docs.sparkSession)
    docs = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    rows = cut(docs.select("doc_id", F.xxhash64("text").alias("text_key"), described(F.col("text")).alias("d")).select("doc_id", "text_key", "d.*"))
    matched = rows.where("n_shingles > 0 and doc_id is not null")
    classes = cut(matched.groupBy("cls").agg(F.min(F.struct("doc_id", "n_shingles", "sig", "bits")).alias("m")).select("cls", F.col("m.doc_id").alias("rep"), "m.n_shingles", "m.sig", "m.bits"))
    postings = cut(_postings(classes, least))
    pairs = cut(_with_hubs(postings))
    held = classes.select("cls", "rep").join(postings.select("cls").distinct(), "cls", "left_semi")
    sets = cut(_sets(docs, held))
    links = cut(_confirmed(_colliding(pairs, classes, least), sets, similar))
    labels = components(links)
    further = _across(postings, labels, sets, classes, similar, least).join(pairs, ["a", "b"], "left_anti")
    more = cut(_confirmed(cut(_colliding(further, classes, least)), sets, similar))
    if not more.isEmpty():
        labels = components(links.unionAll(more))
    named = classes.select("cls", "rep").join(labels, "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    smallest = named.groupBy("label").agg(F.min("rep").alias("component_id"))
    component = named.join(smallest, "label").select("cls", F.col("label").alias("component"), "component_id")
    # only matched rows are joined; a class may hold a third of them, and then its side is split at run time
    joined = matched.select("doc_id", "text_key", "n_shingles", "cls").join(component, "cls").select("doc_id", "text_key", "n_shingles", "component", "component_id")
    alone = rows.where("not (n_shingles > 0 and doc_id is not null)").select("doc_id", "text_key", "n_shingles", F.lit(None).cast("binary").alias("component"), F.col("doc_id").alias("component_id"))
    return joined.unionAll(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicated(docs: DataFrame, similar: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stay, one of each component, with all their columns.

    The document with the component's id stays; where several rows have this id, one text of them and
    one row of that text. Empty texts and rows without an id stay all.
    """
    found = cut(near_duplicates(docs, similar, id_col, text_col))
    kept = found.where("kept and component is not null")
    chosen = kept.groupBy("component").agg(F.min("text_key").alias("chosen"))
    spare = kept.join(chosen, "component").where("text_key <> chosen")
    gone = cut(found.where("not kept").select("doc_id", "text_key").unionAll(spare.select("doc_id", "text_key")).distinct())
    repeated = cut(kept.groupBy("doc_id", "text_key").agg(F.count("*").alias("n")).where("n > 1").select("doc_id", "text_key"))
    marks = gone.withColumn("gone", F.lit(True)).unionAll(repeated.withColumn("gone", F.lit(False)))
    of_id, of_key, dropped = unused(docs, "_of_id", "_of_key", "_gone")
    marks = marks.select(F.col("doc_id").alias(of_id), F.col("text_key").alias(of_key), F.col("gone").alias(dropped))
    if gone.count() + repeated.count() <= BROADCAST_IDS:
        marks = F.broadcast(marks)
    key = F.xxhash64(F.col(f"`{text_col}`").cast("string"))
    marked = docs.join(marks, (docs[id_col] == F.col(of_id)) & (key == F.col(of_key)), "left").where(F.col(dropped).isNull() | ~F.col(dropped))
    once = marked.where(~F.col(dropped)).dropDuplicates([of_id, of_key])
    return marked.where(F.col(dropped).isNull()).unionAll(once).drop(of_id, of_key, dropped)
