"""SentencePiece encoding and decoding for merge-type vocabularies.

A text becomes symbols, one per character. An agenda holds every pair of neighbours whose joined
string is a piece, best score first and leftmost among equals; taking a pair joins it and puts its
two new neighbour pairs on the agenda. What is no piece in the end falls back to its UTF-8 bytes.

No piece has a word boundary behind another character, and many characters are neighbours in no piece.
Joins can't span such places, so the agenda runs on the stretches between them, and stretches seen
before come from a bounded memory, with the number of their ids, these in decimals, and the bytes they stand for. Each new
stretch is also encoded by the sentencepiece library, and stretches on which it differs are counted; the ids
stay the agenda's.

Defined results: a null or empty text has no ids and decodes to the empty text. Repeated rows give
repeated results. Any length works; memory follows the longest text.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, remember, ship

BOUNDARY = "▁"
#: Stretches, and parts of stretches, remembered by each Python worker (about 350 and 240 bytes each); a memory
#: starts anew when full.
REMEMBERED = 600_000
#: Symbols of a stretch whose agenda is a plain list; score of what is no piece.
SHORT, NEVER = 24, -math.inf


class PieceCodec:
    """Encoder and decoder of one model file."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as schema

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        with open(path, "rb") as f:
            model = schema.ModelProto.FromString(f.read())
        norm, kinds = model.normalizer_spec, schema.ModelProto.SentencePiece
        if model.trainer_spec.model_type != schema.TrainerSpec.BPE:
            raise ValueError("the vocabulary is not of the merge type")
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only texts that are taken as they stand are supported")
        if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces):
            raise ValueError("user-defined and unused pieces are not supported")
        self.prefix = BOUNDARY if norm.add_dummy_prefix else ""
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL}
        self.scores = {p.piece: p.score for p in model.pieces if p.type == kinds.NORMAL}
        self.neighbours = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.byte_ids = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == kinds.BYTE}
        self.unknown = self.library.unk_id()
        self.longest = max(map(len, self.ids))
        if any(BOUNDARY in p.lstrip(BOUNDARY) for p in self.ids):
            raise ValueError("a piece crosses a word boundary")
        #: Bytes that each id stands for.
        self.bytes = [p.piece.replace(BOUNDARY, " ").encode() if p.type == kinds.NORMAL else bytes([int(p.piece[3:5], 16)]) if p.type == kinds.BYTE else " ⁇ ".encode() if p.type == kinds.UNKNOWN else b"" for p in model.pieces]
        alone = "".join(c for c in "\n\t" if not any(c in p for p in self.ids))
        #: Whether a line's end always is one id of its own: then the library may encode many lines at once.
        self.lines = "\n" in alone and 10 in self.byte_ids
        apart = f"|[{re.escape(alone)}]" if alone else ""
        self.stretches = re.compile(f"{BOUNDARY}+[^{BOUNDARY}{re.escape(alone)}]*|[^{BOUNDARY}{re.escape(alone)}]+{apart}").findall
        self.decimals = [str(i) for i in range(len(self.bytes))]
        self.parts: dict[str, tuple[int, ...]] = {}
        #: Number of a stretch's ids, these in decimals, and its bytes.
        self.seen: dict[str, tuple[int, str, bytes]] = {}
        self.differing = 0

    def escaped(self, text: str | None) -> str:
        return self.prefix + text.replace(" ", BOUNDARY) if text else ""

    def fallback(self, piece: str) -> tuple[int, ...]:
        """The ids of a final symbol."""
        if (i := self.ids.get(piece)) is not None:
            return (i,)
        return tuple(self.byte_ids[b] for b in piece.encode()) if self.byte_ids else (self.unknown,)

    def apart(self, stretch: str) -> Iterator[str]:
        """Cuts a stretch between characters that are neighbours in no piece: no join spans them."""
        start = 0
        for at in range(1, len(stretch)):
            if stretch[at - 1 : at + 1] not in self.neighbours:
                yield stretch[start:at]
                start = at
        yield stretch[start:]

    def ids_of(self, stretch: str) -> tuple[int, ...]:
        ids: list[int] = []
        for part in self.apart(stretch):
            known = self.parts.get(part)
            if known is None:
                if len(self.parts) > REMEMBERED // 2:
                    self.parts.clear()
                known = self.parts[part] = tuple(i for s in self.merged(part) for i in self.fallback(s))
            ids += known
        return tuple(ids)

    def merged(self, stretch: str) -> list[str]:
        """Final symbols of a stretch by the score-ordered agenda."""
        scores, symbols = self.scores, list(stretch)
        n = len(symbols)
        if n <= SHORT:
            return self.merged_short(symbols)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        agenda: list[tuple[float, int, int, str]] = []
        for left in range(n - 1):
            joined = symbols[left] + symbols[left + 1]
            if (s := scores.get(joined)) is not None:
                agenda.append((-s, left, left + 1, joined))
        heapq.heapify(agenda)
        while agenda:
            _, left, right, joined = heapq.heappop(agenda)
            if not symbols[left] or not symbols[right] or len(symbols[left]) + len(symbols[right]) != len(joined):
                continue  # one of the two has been joined with another since
            symbols[left], symbols[right] = joined, ""
            far = after[left] = after[right]
            if far >= 0:
                before[far] = left
                wider = joined + symbols[far]
                if (s := scores.get(wider)) is not None:
                    heapq.heappush(agenda, (-s, left, far, wider))
            if (near := before[left]) >= 0:
                wider = symbols[near] + joined
                if (s := scores.get(wider)) is not None:
                    heapq.heappush(agenda, (-s, near, left, wider))
        return [s for s in symbols if s]

    def merged_short(self, symbols: list[str]) -> list[str]:
        """The same with an agenda by place: in a short stretch the best pair is soon looked up."""
        score = self.scores.get
        agenda = [score(a + b, NEVER) for a, b in pairwise(symbols)]
        while agenda and (best := max(agenda)) != NEVER:
            k = agenda.index(best)
            joined = symbols[k] = symbols[k] + symbols.pop(k + 1)
            del agenda[k]
            if k < len(agenda):
                agenda[k] = score(joined + symbols[k + 1], NEVER)
            if k:
                agenda[k - 1] = score(symbols[k - 1] + joined, NEVER)
        return symbols

    def encoded(self, texts: Iterable[str | None]) -> list[list[tuple[int, str, bytes]]]:
        """The stretches of whole texts as (number of ids, decimals, bytes); the library checks what the batch has new."""
        if len(self.seen) > REMEMBERED:
            self.seen.clear()
        seen, cuts = self.seen, [self.stretches(self.escaped(t)) for t in texts]
        fresh = list({s for c in cuts for s in c if s not in seen})
        self.differing = 0
        for stretch, want in zip(fresh, self.library_ids(fresh), strict=True):
            ids = self.ids_of(stretch)
            self.differing += ids != want
            seen[stretch] = len(ids), ",".join([self.decimals[i] for i in ids]), b"".join([self.bytes[i] for i in ids])
        return [[seen[s] for s in c] for c in cuts]

    def encode_batch(self, texts: Iterable[str | None]) -> list[list[int]]:
        """Ids of whole texts, without begin and end."""
        return [[int(i) for _, decimals, _ in found for i in decimals.split(",")] for found in self.encoded(texts)]

    def library_ids(self, stretches: list[str]) -> list[tuple[int, ...]]:
        """The library's ids of stretches, encoded as lines of one text; those that hold a line's end one by one."""
        lead = self.library.encode("\n")
        line = lead[-1:] if self.lines else []
        found = {s: tuple(self.library.encode("\n" + s.replace(BOUNDARY, " "))[len(lead) :]) for s in stretches if not line or "\n" in s}
        together = [s for s in stretches if s not in found]
        if together:
            got = np.array(self.library.encode("\n" + "\n".join(together).replace(BOUNDARY, " ")))
            ends = np.flatnonzero(got == line[0])
            many = got.tolist()
            found |= {s: tuple(many[a + 1 : b]) for s, a, b in zip(together, ends, [*ends[1:], len(many)], strict=True)}
        return [found[s] for s in stretches]

    def encode(self, text: str | None) -> list[int]:
        return self.encode_batch([text])[0]

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids; bytes that are no UTF-8 become U+FFFD."""
        table = self.bytes
        return self.text_of(b"".join([table[i] for i in ids]))

    def text_of(self, data: bytes) -> str:
        """The text of ids' bytes, without the blank that encoding put before it."""
        text = data.decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


@lru_cache(maxsize=4)
def codec(path: str) -> PieceCodec:
    remember("pieces", codec.cache_clear)
    return PieceCodec(path)


def coded(text_col: F.Column, model_path: str) -> F.Column:
    """A struct of a text's number of ids, digests of the ids and of the text they decode to, and differences."""

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string, n_differing long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        c = codec(model_path)
        for texts in batches:
            rows = []
            for start in range(0, len(texts), 256):
                part = [t if isinstance(t, str) else None for t in texts.iloc[start : start + 256]]
                many, differing = c.encoded(part), c.differing
                for found in many:
                    numbers, decimals, data = zip(*found, strict=True) if found else ((), (), ())
                    decoded = c.text_of(b"".join(data))
                    rows.append((sum(numbers), hashlib.sha256(",".join(decimals).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest(), differing))
                    differing = 0
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256", "n_differing"])

    return run(text_col)


def piece_ids(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): the ids themselves, for writing training tokens."""

    @F.pandas_udf("array<int>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = codec(model_path)
        for texts in batches:
            texts = [t if isinstance(t, str) else None for t in texts]
            yield pd.Series(c.encode_batch(texts), dtype=object)

    ship(docs.sparkSession)
    return id_and_text(docs, id_col, text_col).select("doc_id", run("text").alias("ids"))


def piece_texts(rows: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text): ids decoded; null ids decode to the empty text."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = codec(model_path)
        for many in batches:
            yield pd.Series([c.decode([] if ids is None else ids) for ids in many], dtype=object)

    ship(rows.sparkSession)
    return rows.select(F.col(f"`{id_col}`").alias("doc_id"), run(F.col(f"`{ids_col}`")).alias("text"))


def round_trip(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256, decoded_sha256, n_differing (new stretches on which the library differed)."""
    ship(docs.sparkSession)
    rows = id_and_text(docs, id_col, text_col).select("doc_id", coded(F.col("text"), model_path).alias("c"))
    return rows.select("doc_id", "c.n_tokens", "c.ids_sha256", "c.decoded_sha256", "c.n_differing")
