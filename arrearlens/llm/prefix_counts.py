"""Token counts of every prefix by dynamic programming over the last token.

Encodings of a merge-type vocabulary have one last token at every prefix, and a prefix's encoding is
that of the prefix before this token plus the token. A token fits behind another if the two, encoded
together, stay as they are; exactly one piece that ends a prefix fits behind the last token of the
prefix before it. So one pass over a text finds the exact token count at every prefix, and how much
of a text fits a budget, or what a cut costs, is read off without encoding again.

Joins can't span a word boundary (see `pieces`), so the pass runs on stretches; the counts inside
stretches seen before are remembered, within a bound. Runs of boundaries hold pieces of equal score,
for which the rule above doesn't hold: short runs are counted by the agenda, and each longest piece at
the left of a long run adds one.

Defined results: a null or empty text has 0 bytes, 0 tokens and no prefix. Repeated rows give repeated
results. Any length works, in time and memory that follow the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, ship
from .pieces import BOUNDARY, REMEMBERED, PieceCodec, codec


#: Characters of a stretch whose counts are remembered.
SHORT = 256


class PrefixCounter:
    """Exact token counts of all prefixes of texts."""

    def __init__(self, pieces: PieceCodec):
        self.pieces = pieces
        self.seen: dict[str, tuple[int, ...]] = {}
        self.fits: dict[tuple[str, str], bool] = {}
        #: The pieces from their last character backwards; None leads to the piece that is complete there.
        self.backwards: dict = {}
        for piece in pieces.ids:
            node = self.backwards
            for c in reversed(piece):
                node = node.setdefault(c, {})
            node[None] = piece
        #: The longest run of boundaries that is a piece, and the counts of runs up to twice its length.
        self.longest = max((len(p) for p in pieces.ids if not p.strip(BOUNDARY)), default=1)
        self.runs = [sum(map(self.weight, pieces.merged(BOUNDARY * n))) for n in range(2 * self.longest + 1)]

    def after(self, last: str, piece: str) -> bool:
        """Whether `piece` can follow the token `last` in an encoding, or begin one if there is none."""
        if len(self.fits) > 4 * REMEMBERED:
            self.fits.clear()
        known = self.fits[last, piece] = self.pieces.merged(last + piece) == ([last, piece] if last else [piece])
        return known

    def weight(self, symbol: str) -> int:
        return len(self.pieces.fallback(symbol))

    def run(self, n: int) -> int:
        """Tokens of n boundaries: the leftmost pairs join first, so a long run begins with longest pieces."""
        whole = max(0, -(-(n - 2 * self.longest) // self.longest))
        return whole + self.runs[n - whole * self.longest]

    def inside(self, stretch: str) -> tuple[int, ...]:
        """Token counts of the prefixes of one stretch, the shortest first."""
        known = self.seen.get(stretch)
        if known is None:
            known = self.counted(stretch)
            if len(stretch) <= SHORT:
                if len(self.seen) > REMEMBERED:
                    self.seen.clear()
                self.seen[stretch] = known
        return known

    def counted(self, stretch: str) -> tuple[int, ...]:
        lead = len(stretch) - len(stretch.lstrip(BOUNDARY))
        if lead > 1:
            return self.behind_run(stretch, lead)
        counts: list[int] = []
        for part in self.pieces.apart(stretch):
            known = self.seen.get(part)
            if known is None:
                known = self.pass_over(part)[0]
                if len(part) <= SHORT:
                    self.seen[part] = known
            base = counts[-1] if counts else 0
            counts += [base + n for n in known]
        return tuple(counts)

    def pass_over(self, part: str) -> tuple[tuple[int, ...], list[bool]]:
        """The dynamic program: for each prefix its last token and its count, and whether the part's first
        character is a token of its own there."""
        counts, lasts, alone, backwards, fits = [0], [""], [False], self.backwards, self.fits
        for at in range(1, len(part) + 1):
            node, start, ending = backwards, at, []
            while start and (node := node.get(part[start - 1])) is not None:
                start -= 1
                if None in node:
                    ending.append((start, node[None]))
            for start, piece in reversed(ending):
                last = lasts[start]
                if (fit := fits.get((last, piece))) is None:
                    fit = self.after(last, piece)
                if fit:
                    counts.append(counts[start] + 1)
                    lasts.append(piece)
                    alone.append(alone[start] if start else at == 1)
                    break
            else:  # a character that is no piece stands for its bytes
                counts.append(counts[-1] + self.weight(part[at - 1]))
                lasts.append(part[at - 1])
                alone.append(alone[at - 1] if at > 1 else True)
        return tuple(counts[1:]), alone[1:]

    def behind_run(self, stretch: str, lead: int) -> tuple[int, ...]:
        """Behind a run of boundaries: its last one starts the word where it joins it, else it stays in the run."""
        of_run = [self.run(n) for n in range(lead + 1)]
        word = stretch[lead:]
        counts = of_run[1:]
        if word:
            joined = self.inside(BOUNDARY + word)
            # Only the first part reaches back to the boundary; behind it nothing changes any more.
            alone = self.pass_over(next(self.pieces.apart(BOUNDARY + word)))[1]
            for n in range(1, len(word) + 1):
                counts.append(of_run[lead] + joined[n] - 1 if alone[min(n, len(alone) - 1)] else of_run[lead - 1] + joined[n])
        return tuple(counts)

    def stretches(self, text: str | None) -> list[str]:
        return self.pieces.stretches(self.pieces.escaped(text))

    def total(self, text: str | None) -> int:
        return sum(self.inside(s)[-1] for s in self.stretches(text))

    def prefixes(self, text: str | None) -> np.ndarray:
        """Token counts of text[:1], text[:2] ... text[:len(text)]."""
        out, base = [], 0
        for s in self.stretches(text):
            counts = self.inside(s)
            out.extend([base + n for n in counts])
            base += counts[-1]
        return np.array(out[len(self.pieces.prefix) :], np.int64)

    def fitting(self, text: str | None, budget: int) -> int:
        """Characters of the longest prefix whose tokens are within the budget."""
        base, at, best = 0, -len(self.pieces.prefix), 0
        for s in self.stretches(text):
            counts = self.inside(s)
            if base + min(counts) > budget:
                break
            if base + max(counts) <= budget:
                best = at + len(s)
            else:
                best = max(best, at + max(n for n, c in enumerate(counts, 1) if base + c <= budget))
            base, at = base + counts[-1], at + len(s)
        return max(best, 0)


@lru_cache(maxsize=4)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(codec(path))


def counted(text_col: F.Column, model_path: str, limit: int) -> F.Column:
    """A struct of a text's bytes, tokens, whether they pass the limit, and the characters that fit it."""

    @F.pandas_udf("n_bytes long, n_tokens long, over_limit boolean, fitting_chars long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        c = counter(model_path)
        for texts in batches:
            rows = []
            for text in texts:
                text = text if isinstance(text, str) else ""
                n = c.total(text)
                rows.append((len(text.encode()), n, n > limit, len(text) if n <= limit else c.fitting(text, limit)))
            yield pd.DataFrame(rows, columns=["n_bytes", "n_tokens", "over_limit", "fitting_chars"])

    return run(text_col)


def token_counts(docs: DataFrame, model_path: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_bytes, n_tokens, over_limit, fitting_chars."""
    ship(docs.sparkSession)
    rows = id_and_text(docs, id_col, text_col).select("doc_id", counted(F.col("text"), model_path, limit).alias("c"))
    return rows.select("doc_id", "c.n_bytes", "c.n_tokens", "c.over_limit", "c.fitting_chars")


def prefix_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, counts): the token count of every prefix of every text."""

    @F.pandas_udf("array<long>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = counter(model_path)
        for texts in batches:
            yield pd.Series([c.prefixes(t if isinstance(t, str) else None) for t in texts], dtype=object)

    ship(docs.sparkSession)
    return id_and_text(docs, id_col, text_col).select("doc_id", run("text").alias("counts"))
