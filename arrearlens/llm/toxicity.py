"""Toxicity by class-conditional Kneser-Ney models.

Labelled texts of either class give a word-pair model: pairs are discounted and back off to how many
different words a word follows in its class, and these counts, discounted too, back off to counts that
both classes share. So an expression that the labels hardly show is judged alike by both models, and
its ratio is that of the classes' backoff weights alone.

The discount is taken from a few by how well it separates labelled texts that the counts have not seen.
A text is compared under both models by its length-normalised log-likelihood ratio: over the whole
text, over its most toxic stretch of eight words, and over its most toxic word. A logistic curve,
fitted on those same texts, turns the three into a score.

The models are fitted on a bounded sample of labelled rows: of each class about `per_class` rows, by a
hash of their ids, copies counted once. All rows are scored over their whole text.

Defined results: null and empty texts score as an average ordinary text does. Without labels of both
classes every score is the share of toxic labels (0 without labels). A document with several labels
counts as toxic if any says so. Repeated rows give repeated results. Memory follows the longest text
and the sample bound.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship
from .decontaminate import words_of

#: Labelled rows of each class at most.
PER_CLASS = 10_000
#: Pairs seen less often in either class are left to the backoff, as are words after fewer different words.
LEAST_PAIRS, LEAST_WORDS = 3, 2
STRETCH = 8
#: Discounts tried; the one that separates the calibration rows best is taken.
DISCOUNTS = (0.75, 2.0, 4.0, 8.0, 16.0)
#: Of the labelled rows this share (by id) calibrates the score and is not counted.
CALIBRATION = 4


@dataclass
class Ratios:
    """Log-likelihood ratios (toxic over ordinary) of words, of backing off from them, and of pairs."""

    word_ids: dict[bytes, int] = field(default_factory=dict)
    words: np.ndarray = field(default_factory=lambda: np.zeros(1))
    backoffs: np.ndarray = field(default_factory=lambda: np.zeros(1))
    pairs: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    pair_ratios: np.ndarray = field(default_factory=lambda: np.zeros(0))
    weights: np.ndarray | None = None
    constant: float = 0.0

    def measures(self, text: str | None) -> np.ndarray | None:
        """Ratios of the whole text, its most toxic stretch and its most toxic word, each a word's mean."""
        words = words_of(text)
        if not words:
            return None
        ids = np.fromiter(map(self.word_ids.get, words, repeat(-1)), np.int64, len(words))
        alone = self.words[ids]
        full = alone.copy()
        full[1:] += self.backoffs[ids[:-1]]
        if len(self.pairs) and len(ids) > 1:
            keys = np.where((ids[:-1] >= 0) & (ids[1:] >= 0), ids[:-1] * len(self.words) + ids[1:], -1)
            at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
            seen = self.pairs[at] == keys
            full[1:][seen] = self.pair_ratios[at[seen]]
        sums = np.concatenate(([0.0], np.cumsum(full)))
        n = min(STRETCH, len(full))
        return np.array([full.mean(), (sums[n:] - sums[:-n]).max() / n, alone.max()])

    def score(self, text: str | None) -> float:
        if self.weights is None:
            return self.constant
        found = self.measures(text)
        z = self.constant if found is None else float(self.weights[0] + found @ self.weights[1:])
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def sample(docs: DataFrame, labels: DataFrame, per_class: int) -> DataFrame:
    """(text, toxic, calibrates) of a bounded number of labelled documents: a range of a hash of their ids."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    held = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    chosen = [(F.col("toxic") == c) & (draw < int(min(1.0, per_class / n) * (1 << 30))) for c, n in held.items()]
    drawn = known.where(reduce(lambda a, b: a | b, chosen, F.lit(False))).select(F.col("doc_id").alias("_id"), "toxic")
    rows = docs.join(F.broadcast(drawn), docs["doc_id"] == F.col("_id"))  # about 2 * per_class ids
    calibrates = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == CALIBRATION
    rows = rows.where(F.col("text").isNotNull()).select("text", "toxic", calibrates.alias("calibrates"))
    return rows.withColumn("copy", F.xxhash64("text")).dropDuplicates(["copy", "toxic", "calibrates"]).drop("copy")


def _pairs(rows: DataFrame) -> DataFrame:
    """How often each pair of neighbours is in each class; the first word of a text follows ''."""

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
                words = [w.decode("utf-8", "replace") for w in words_of(text)]
                yield pd.DataFrame({"before": ["", *words[:-1]] if words else [], "word": words, "toxic": np.full(len(words), toxic)})

    seen = rows.select("text", "toxic").mapInPandas(pairs, "before string, word string, toxic int")
    return seen.groupBy("before", "word").agg(F.sum(F.col("toxic").cast("long")).alias("t"), F.sum((1 - F.col("toxic")).cast("long")).alias("o"))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Ratios:
    """Models from (doc_id, text) and (doc_id, toxic)."""
    spark = docs.sparkSession
    ship(spark)
    rows = sample(docs, labels, per_class).persist()  # used thrice; lost parts are computed again
    try:
        n = {r.toxic: (r.counted, r.calibrating) for r in rows.groupBy("toxic").agg(F.sum((~F.col("calibrates")).cast("int")).alias("counted"), F.sum(F.col("calibrates").cast("int")).alias("calibrating")).collect()}
        if any(0 in n.get(c, (0, 0)) for c in (0, 1)):
            total = sum(map(sum, n.values()))
            return Ratios(constant=sum(n.get(1, (0, 0))) / total if total else 0.0)
        statistics = _count(_pairs(rows.where("not calibrates")))
        tried = [_ratios(statistics, d) for d in DISCOUNTS]
        sent = spark.sparkContext.broadcast(tried)

        def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
                    if words_of(text):
                        yield pd.DataFrame([(k, *r.measures(text), toxic) for k, r in enumerate(sent.value)], columns=["model", "a", "b", "c", "toxic"])

        measured = rows.where("calibrates").mapInPandas(measure, "model int, a double, b double, c double, toxic int").toPandas()
    finally:
        rows.unpersist()
    if measured["toxic"].nunique() < 2:
        return Ratios(constant=float(measured["toxic"].mean()) if len(measured) else 0.0)
    best, least = None, np.inf
    for k, part in measured.sort_values(["model", "a", "b", "c", "toxic"]).groupby("model"):
        x, y = part[["a", "b", "c"]].to_numpy(), part["toxic"].to_numpy()
        weights = _logistic(x, y)
        z = np.clip(weights[0] + x @ weights[1:], -30, 30)
        if (loss := float(np.mean(np.logaddexp(0, z) - y * z))) < least:
            best, least = tried[int(k)], loss
            best.weights = weights
            best.constant = float(weights[0] + x[y == 0].mean(axis=0) @ weights[1:])
    return best


def _count(pairs: DataFrame) -> dict:
    """Counts of words, of pairs and of counts; rare entries stay in Spark."""
    pairs = pairs.persist()
    try:
        words = pairs.groupBy("word").agg(F.sum((F.col("t") > 0).cast("long")).alias("t"), F.sum((F.col("o") > 0).cast("long")).alias("o"), F.count("*").alias("shared")).persist()
        totals = words.agg(*[F.sum(c).alias(c) for c in ("t", "o", "shared")]).first()
        # words by their count, for the mass that a discount takes away
        of_counts = {c: words.where(F.col(c) > 0).groupBy(F.least(c, F.lit(int(max(DISCOUNTS)) + 1)).alias("n")).agg(F.count("*").alias("words")).toPandas() for c in "to"}
        # what is below the bounds gets the backoff's ratio, so it need not leave the executors
        kept_words = words.where(F.greatest("t", "o") >= LEAST_WORDS).toPandas()
        kept_pairs = pairs.where(F.greatest("t", "o") >= LEAST_PAIRS).toPandas()
        before = pairs.groupBy("before").agg(F.sum("t").alias("t"), F.sum("o").alias("o")).where(F.greatest("t", "o") >= LEAST_PAIRS).toPandas()
        words.unpersist()
    finally:
        pairs.unpersist()
    return {"words": kept_words.sort_values("word", ignore_index=True), "pairs": kept_pairs, "before": before, "totals": totals, "of_counts": of_counts}


def _ratios(found: dict, discount: float) -> Ratios:
    """Discounted chances and backoff weights of both classes, as ratios."""
    words, pairs, before = found["words"], found["pairs"], found["before"]
    ids = {w.encode(): i for i, w in enumerate(words["word"])}
    shared = words["shared"].to_numpy() / max(found["totals"].shared or 0, 1)
    chance, weight = {}, {}
    for c in "to":
        total, of_counts = max(found["totals"][c] or 0, 1), found["of_counts"][c]
        weight[c] = max(float((np.minimum(of_counts["n"], discount) * of_counts["words"]).sum()) / total, 1e-9)
        chance[c] = np.maximum(words[c].to_numpy() - discount, 0) / total + weight[c] * shared
    # the last entry is for words without one
    word_ratios = np.append(np.log(chance["t"] / chance["o"]), np.log(weight["t"] / weight["o"]))
    number = lambda column: np.array([ids.get(w.encode(), -1) for w in column], np.int64)
    h, w = number(pairs["before"]), number(pairs["word"])
    inside = (h >= 0) & (w >= 0)
    h, w, pairs = h[inside], w[inside], pairs[inside]
    totals, parts, left = {}, {}, {}
    b = number(before["before"])
    for c in "to":
        totals[c] = np.ones(len(ids) + 1)
        totals[c][b[b >= 0]] = np.maximum(before[c].to_numpy()[b >= 0], 1)
        parts[c] = np.where(pairs[c].to_numpy() >= LEAST_PAIRS, np.maximum(pairs[c].to_numpy() - discount, 0), 0.0)
        left[c] = np.clip(1 - np.bincount(h, parts[c], len(ids) + 1) / totals[c], 1e-6, 1)
    both = {c: parts[c] / totals[c][h] + left[c][h] * chance[c][w] for c in "to"}
    keys = h * (len(ids) + 1) + w
    order = np.argsort(keys)
    return Ratios(ids, word_ratios, np.log(left["t"] / left["o"]), keys[order], np.log(both["t"] / both["o"])[order])


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights (the constant first) of a logistic curve, by Newton steps on standardised columns."""
    mean, spread = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    a = np.column_stack([np.ones(len(x)), (x - mean) / spread])
    w = np.zeros(a.shape[1])
    penalty = ridge * len(x) / 100 * np.diag([1e-6, *np.ones(x.shape[1])])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        slope = a.T @ (p - y) + penalty @ w
        step = np.linalg.solve(a.T @ (a * (p * (1 - p) + 1e-9)[:, None]) + penalty, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return np.concatenate(([w[0] - (w[1:] * mean / spread).sum()], w[1:] / spread))


def scored(docs: DataFrame, ratios: Ratios, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Per row: doc_id, the columns to keep, score and predicted."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(ratios)

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([sent.value.score(t if isinstance(t, str) else None) for t in texts], dtype=float)

    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), *[F.col(f"`{c}`") for c in keep], run(F.col(f"`{text_col}`").cast("string")).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
