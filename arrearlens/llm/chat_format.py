"""Chat formatting with typed content parts.

A turn's content is a list of parts: text, image, audio or document. A visitor walks over them in order.
Text is written with its control strings escaped; every other part becomes a placeholder, and its
reference, its place and the tokens it expands to are recorded beside the text.

A turn reads `<|im_start|>role`, a line break, the parts, `<|im_end|>` and a line break; neighbouring texts
are parted by `<|part|>`. Escaping puts one more backslash between `<` and `|` wherever only backslashes
are between them, so a control string never stands inside a text and reading back takes one backslash away.

Turns are formatted where they lie, one row a turn; only reading back brings a conversation together, as a
sorted stream, so that memory follows the longest turn and never a whole conversation.

Defined results: a null text is empty, a null role too; a part of an unknown type is an error. Turns of
equal number go by role, then by text; rows without a number come first. Rows without conv_id are one
conversation of that id, as in a grouping. Repeated rows are turns of their own. An empty table gives no
rows. Other columns are left out.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship

PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
ATTACHMENT = "struct<place:int,type:string,ref:string,offset:int,n_tokens:long>"
SEGMENT = f"formatted string, loss array<struct<start:int,end:int>>, attachments array<{ATTACHMENT}>, expanded_tokens long"

START, END, BETWEEN, BREAK = "<|im_start|>", "<|im_end|>\n", "<|part|>", "<|nl|>"
#: Side of an image patch in pixels, audio tokens a second, tokens of a document's page.
PATCH, PER_SECOND, PER_PAGE = 28, 25, 256

_CONTROL, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")


def escaped(text: str) -> str:
    return _CONTROL.sub(r"<\\\1|", text)


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


class Flattener:
    """Visits the parts of one turn and gathers its text, the places of its texts, and its attachments."""

    def __init__(self, role: str | None):
        head = escaped(role or "").replace("\n", BREAK)
        self.out = [START, head, "\n"]
        self.at = len(START) + len(head) + 1
        self.texts: list[tuple[int, int]] = []
        self.attachments: list[dict] = []
        self.before = None

    def put(self, piece: str) -> None:
        self.out.append(piece)
        self.at += len(piece)

    def visit(self, part: dict) -> None:
        kind = part["type"]
        if kind not in ("text", "image", "audio", "document"):
            raise ValueError(f"no such type of content: {kind}")
        getattr(self, f"visit_{kind}")(part)
        self.before = kind

    def visit_text(self, part: dict) -> None:
        if self.before == "text":
            self.put(BETWEEN)
        start = self.at
        self.put(escaped(part["text"] or ""))
        self.texts.append((start, self.at))

    def visit_image(self, part: dict) -> None:
        sides = [max(1, -(-(part.get(side) or 0) // PATCH)) for side in ("width", "height")]
        self.attach(part, math.prod(sides))

    def visit_audio(self, part: dict) -> None:
        self.attach(part, max(1, math.ceil((part.get("seconds") or 0) * PER_SECOND)))

    def visit_document(self, part: dict) -> None:
        self.attach(part, max(1, part.get("pages") or 0) * PER_PAGE)

    def attach(self, part: dict, n_tokens: int) -> None:
        place = len(self.attachments)
        self.attachments.append({"place": place, "type": part["type"], "ref": part.get("ref"), "offset": self.at, "n_tokens": n_tokens})
        self.put(f"<|{part['type']}|>")

    def done(self) -> str:
        return "".join([*self.out, END])


def flattened(role: str | None, parts: list[dict]) -> tuple[str, list[dict], list[dict], int]:
    """A turn's text, the places under the loss mask, its attachments, and the tokens these expand to."""
    visitor = Flattener(role)
    for part in parts:
        visitor.visit(part)
    loss = [{"start": a, "end": b} for a, b in visitor.texts] if role == "assistant" else []
    return visitor.done(), loss, visitor.attachments, sum(a["n_tokens"] for a in visitor.attachments)


def text_part(text: Column) -> Column:
    """Content that is one text."""
    part = F.struct(F.lit("text").alias("type"), text.cast("string").alias("text"), *[F.lit(None).alias(c) for c in ("ref", "width", "height", "seconds", "pages")])
    return F.array(part.cast(PART))


def segment(role: Column, parts: Column) -> Column:
    """A turn's SEGMENT."""

    @F.pandas_udf(SEGMENT)
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for roles, contents in batches:
            rows = [flattened(role if isinstance(role, str) else None, [] if parts is None else list(parts)) for role, parts in zip(roles, contents, strict=True)]
            yield pd.DataFrame(rows, columns=["formatted", "loss", "attachments", "expanded_tokens"])

    return run(role, parts)


def format_turns(turns: DataFrame, parts: Column | None = None) -> DataFrame:
    """(conv_id, turn, role, text) or, instead of text, `parts`, an array of PART -> a row for each turn:
    conv_id, turn, role, sort_text, and the SEGMENT columns. Offsets count characters of the turn."""
    ship(turns.sparkSession)
    text = F.col("text").cast("string") if "text" in turns.columns else F.lit(None).cast("string")
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"),
        text.alias("sort_text"),
        (text_part(text) if parts is None else parts.cast(f"array<{PART}>")).alias("parts"),
    )
    return rows.withColumn("s", segment(F.col("role"), F.col("parts"))).select("conv_id", "turn", "role", "sort_text", "s.*")


def in_order(formatted: DataFrame) -> DataFrame:
    """Conversations one behind the other, each with its turns in order, none over two tasks."""
    return formatted.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), F.asc_nulls_first("role"), F.asc_nulls_first("sort_text"), "formatted")


class Reader:
    """Reads one conversation's formatted text back, turn by turn, as it comes in."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.rest = ""
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted_chars = 0

    def take(self, piece: str, loss: list[dict]) -> None:
        for span in loss:
            text = unescaped(piece[span["start"] : span["end"]])
            self.loss_chars += len(text)
            self.loss.update(text.encode("utf-8", "replace"))
        self.formatted_chars += len(piece)
        self.rest += piece
        while (end := self.rest.find(END)) >= 0:
            self.turn(self.rest[:end])
            self.rest = self.rest[end + len(END) :]

    def turn(self, body: str) -> None:
        if not body.startswith(START):
            raise ValueError("a turn does not begin with its mark")
        role, _, content = body[len(START) :].partition("\n")
        role = unescaped(role.replace(BREAK, "\n"))
        texts = re.split(r"<\|(?:part|image|audio|document)\|>", content)
        self.n_turns += 1
        self.turns.update(f"{role}\n{''.join(map(unescaped, texts))}\n".encode("utf-8", "replace"))

    def row(self) -> tuple:
        if self.rest:
            raise ValueError("a turn does not end")
        return self.conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted_chars


READ = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
_READ = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _READ.types, strict=True)], schema=_READ)

    reader = None
    for batch in batches:
        rows = []
        for conv_id, piece, loss in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss")], strict=True):
            if reader is None or reader.conv_id != conv_id:
                if reader is not None:
                    rows.append(reader.row())
                reader = Reader(conv_id)
            reader.take(piece, loss)
        if rows:
            yield out(rows)
    if reader is not None:
        yield out([reader.row()])


def read_back(formatted: DataFrame) -> DataFrame:
    """What the formatted conversations say, read from their text and loss masks: the READ columns.

    Digests are of role, line break, text, line break for each turn, and of all text under the mask."""
    ship(formatted.sparkSession)
    return in_order(formatted).select("conv_id", "formatted", "loss").mapInArrow(_read, READ)


def attachments(formatted: DataFrame) -> DataFrame:
    """(conv_id, turn, place, type, ref, offset, n_tokens) for each placeholder."""
    return formatted.select("conv_id", "turn", F.inline("attachments"))
