"""Language identification by compression.

For each language a zstandard raw-content dictionary is filled with text of that language. A text, in
lower case and without digits and signs, is compressed with each of them, block by block to its end; the dictionary that makes it smallest names
its language. Where the runner-up is nearly as good, the answer is marked as rejected.

The dictionaries are fitted on a bounded sample: of each language different texts in the order of a hash
of the text, from each at most `SAMPLE_CHARS` characters, up to `dictionary_bytes`. Every language that has a
text with a letter gets one. Everything else covers all rows.

Defined results: null texts and texts without a letter are `und` with score 0, as are all texts where
nothing was learned. Ties between languages go to the first by name. Repeated rows give repeated
results. Memory does not grow with a text beyond the text itself.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship, utf8

#: Sample bounds: bytes of dictionary for each language, characters taken from one text.
DICTIONARY_BYTES, SAMPLE_CHARS = 48 * 1024, 4096
#: Steps of the hash by which texts are drawn: the first 2**-k of all texts, for k from this down to 0.
DEEPEST = 40
#: Texts are compressed in blocks of so many bytes, so that a dictionary helps to the very end.
BLOCK_BYTES = 4096
LEVEL = 12
#: Answers whose runner-up is less than this share larger are marked as rejected.
LEAST_MARGIN = 0.01

UNKNOWN = "und"


_NO_LETTERS = re.compile(r"[\W\d_]+")


def letters(text: str) -> bytes:
    """What is compressed: the text's words in lower case, without digits and signs."""
    return utf8(_NO_LETTERS.sub(" ", text.lower()))


def fit(known: DataFrame, dictionary_bytes: int = DICTIONARY_BYTES) -> dict[str, bytes]:
    """Dictionaries by language from (doc_id, text, lang), with one pass that counts and one that draws.

    Texts are drawn by a hash of the text, so copies are drawn together and count once. For each language a
    count of letters by the depth of the hash says how deep the draw must go to fill the dictionary; a
    few times more is drawn than needed, the rest is cut off here. Languages are listed before any draw, and a
    language with few or only long texts is drawn whole.
    """
    draw = F.xxhash64("text")
    taken = F.substring("text", 1, SAMPLE_CHARS)
    rows = known.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("lang", "text", draw.alias("draw"), F.octet_length(taken).alias("bytes"))
    # Depth k: the hash lies in the first 2**-k of its range.
    depth = F.least(F.length(F.regexp_extract(F.lpad(F.bin("draw"), 64, "0"), "^0*", 0)), F.lit(DEEPEST))
    rows = rows.withColumn("depth", depth)
    # Copies share a draw: each counts once. Two numbers for each language and depth reach the driver.
    once = rows.groupBy("lang", "draw").agg(F.max("bytes").alias("bytes"), F.max("depth").alias("depth"))
    held: dict[str, dict[int, int]] = {}
    for r in once.groupBy("lang", "depth").agg(F.sum("bytes").alias("bytes")).collect():
        held.setdefault(r.lang, {})[r.depth] = r.bytes
    if not held:
        return {}
    need = {}
    for lang, of in held.items():
        so_far = 0
        for k in range(DEEPEST, -1, -1):
            so_far += of.get(k, 0)
            need[lang] = k
            if so_far >= 2 * dictionary_bytes:
                break
    spark = known.sparkSession
    depths = spark.createDataFrame(sorted(need.items()), "of string, least int")
    drawn = rows.join(F.broadcast(depths), F.col("lang") == F.col("of")).where(F.col("depth") >= F.col("least"))
    drawn = drawn.groupBy("lang", "draw").agg(F.min(F.substring("text", 1, SAMPLE_CHARS)).alias("text"))
    out = dict.fromkeys(sorted(need), b"")
    for r in drawn.orderBy("lang", F.desc(F.length(F.regexp_extract(F.lpad(F.bin("draw"), 64, "0"), "^0*", 0))), "draw").toLocalIterator():
        if len(out[r.lang]) < dictionary_bytes:
            out[r.lang] += letters(r.text) + b"\n"
    return {lang: content[:dictionary_bytes] for lang, content in out.items()}


def compressors(dictionaries: dict[str, bytes], level: int = LEVEL) -> dict:
    import zstandard

    out = {}
    for lang, content in sorted(dictionaries.items()):
        known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        known.precompute_compress(level=level)
        out[lang] = zstandard.ZstdCompressor(level=level, dict_data=known, write_content_size=False, write_checksum=False, write_dict_id=False)
    return out


def sizes(data: bytes, by_lang: dict) -> dict[str, int]:
    """Compressed bytes of a whole text under each dictionary."""
    view = memoryview(data)
    return {lang: sum(len(c.compress(view[at : at + BLOCK_BYTES])) for at in range(0, len(data), BLOCK_BYTES)) for lang, c in by_lang.items()}


def decide(text: str | None, by_lang: dict) -> tuple[str, float, bool]:
    """(language, score from 0 to 1, whether the margin is too narrow)."""
    if not by_lang or text is None or not any(map(str.isalpha, text)):
        return UNKNOWN, 0.0, True
    found = sorted((n, lang) for lang, n in sizes(letters(text), by_lang).items())
    if len(found) == 1:
        return found[0][1], 1.0, False
    margin = (found[1][0] - found[0][0]) / found[1][0]
    return found[0][1], min(1.0, 0.5 + 5 * margin), margin < LEAST_MARGIN


def identified(text_col: Column, dictionaries: dict[str, bytes]) -> Column:
    """A struct of lang_pred, score and rejected."""

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        by_lang = _ready(dictionaries)
        for texts in batches:
            yield pd.DataFrame([decide(t if isinstance(t, str) else None, by_lang) for t in texts], columns=["lang_pred", "score", "rejected"])

    return run(text_col)


_made: dict[str, dict] = {}


def _ready(dictionaries: dict[str, bytes]) -> dict:
    key = hashlib.sha256(repr(sorted((k, hashlib.sha256(v).hexdigest()) for k, v in dictionaries.items())).encode()).hexdigest()
    if key not in _made:
        _made.clear()
        _made[key] = compressors(dictionaries)
    return _made[key]


def identify(docs: DataFrame, dictionaries: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Per row: doc_id, the columns to keep, lang_pred, score, rejected."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), *[F.col(f"`{c}`") for c in keep], identified(F.col(f"`{text_col}`").cast("string"), dictionaries).alias("_found"))
    return rows.select("doc_id", *keep, "_found.*")
