"""Quality rules on repetition: characters inside duplicated n-grams and lines.

Rolling hashes of several n-gram lengths, computed in numpy over a whole text, find the runs of words
that occur more than once in it. A text's coverage at a length is the share of its word characters
inside such runs, the first occurrence included; the share inside lines equal to an earlier line is
measured too. A text is rejected where a share is above its limit.

Defined results: null and empty texts have 0 in every count and fail the base rule (under 20 words).
Repeated rows give repeated results. Memory follows the longest text (8 bytes a word and column).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget_others, id_and_text, ship, shingle_hashes, utf8, word_hashes

#: Window of the base rule, and its limits.
BASE_WINDOW, LEAST_WORDS, MOST_REPEATED_PERCENT = 8, 20, 30
#: Highest share of word characters in duplicated runs of n words, and in repeated lines. Ordinary prose of
#: any length stays far below: five words in a row hardly ever come twice by chance.
COVERAGE = {5: 0.40, 8: 0.35, 12: 0.30, 20: 0.30}
LINE_COVERAGE = 0.30
SYMBOLS = b"#*$%&|<>"

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True


def in_duplicates(words: np.ndarray, n: int) -> np.ndarray:
    """Which words lie in a run of n words that occurs twice or more."""
    inside = np.zeros(len(words) + 1, np.int64)
    if len(words) <= n:
        return inside[:-1].astype(bool)
    grams = shingle_hashes(words, n)
    order = np.argsort(grams, kind="stable")
    ranked = grams[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(len(grams), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    starts = np.flatnonzero(twice)
    inside[starts] += 1
    np.subtract.at(inside, starts + n, 1)
    return np.cumsum(inside[:-1]) > 0


def measures(text: str | None) -> dict[str, float | int]:
    """All counts and shares of one text."""
    data = utf8(text)
    words, points = word_hashes(data) if data else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    chars = int(points.sum())
    lines = [x for x in data.split(b"\n") if x.strip(b" \t\x0b\x0c\r")]
    seen: set[bytes] = set()
    again = 0
    again_chars = 0
    for line in lines:
        if line in seen:
            again += 1
            again_chars += len(b"".join(line.split()).decode("utf-8"))
        seen.add(line)
    out: dict[str, float | int] = {
        "n_words": len(words),
        "word_chars": chars,
        "n_symbols": int(_IS_SYMBOL[np.frombuffer(data, np.uint8)].sum()),
        "n_dup_lines": again,
        "n_repeat_words": int(in_duplicates(words, BASE_WINDOW).sum()),
        "line_coverage": again_chars / max(chars, 1),
    }
    for n in COVERAGE:
        out[f"coverage_{n}"] = int(points[in_duplicates(words, n)].sum()) / max(chars, 1)
    out["base_failed"] = len(words) < LEAST_WORDS or 100 * out["n_repeat_words"] > MOST_REPEATED_PERCENT * len(words)
    return out


FIELDS = {"n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long", "line_coverage": "double"} | {f"coverage_{n}": "double" for n in COVERAGE} | {"base_failed": "boolean", "kept": "boolean"}


def judged(text_col: F.Column, coverage: dict[int, float] | None = None, line_coverage: float = LINE_COVERAGE) -> F.Column:
    """A struct of a text's measures, `base_failed` and `kept`."""
    limits = COVERAGE if coverage is None else coverage
    if set(limits) - set(COVERAGE):
        raise ValueError(f"measured are runs of {sorted(COVERAGE)} words")

    @F.pandas_udf(", ".join(f"{k} {v}" for k, v in FIELDS.items()))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        forget_others("repetition")
        for texts in batches:
            rows = [measures(t if isinstance(t, str) else None) for t in texts]
            for r in rows:
                r["kept"] = not r["base_failed"] and r["line_coverage"] <= line_coverage and all(r[f"coverage_{n}"] <= x for n, x in limits.items())
            yield pd.DataFrame(rows, columns=list(FIELDS))

    return run(text_col)


def repetition_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """Per row: doc_id, the counts, the shares, base_failed and kept."""
    ship(docs.sparkSession)
    return id_and_text(docs, id_col, text_col).select("doc_id", judged(F.col("text"), **limits).alias("r")).select("doc_id", "r.*")
