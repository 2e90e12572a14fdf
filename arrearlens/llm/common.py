"""What the operators share: reading tables, shipping code, word hashes and durable cuts."""

from __future__ import annotations

import ctypes
import gc
import hashlib
import os
import re
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space between words; everything else belongs to a word.
WORD = r"[^\x20\x09-\x0D]+"

_ROOT = Path(__file__).resolve().parents[2]
_BLOCK = 1 << 22
_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_P_INV = np.uint64(pow(int(_P), -1, 1 << 64))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator needs, so that further columns can't clash with its own."""
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def unused(df: DataFrame, *names: str) -> list[str]:
    """Column names made from `names` that the frame does not have."""
    held = {c.lower() for c in df.columns}
    return [next(x for k in range(len(held) + 1) if (x := f"{n}{k or ''}").lower() not in held) for n in names]


def ship(spark: SparkSession) -> None:
    """Let executors import this package where it is not on their PYTHONPATH already."""
    if str(_ROOT) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    context = spark.sparkContext
    if getattr(context, "_arrearlens_shipped", False):
        return
    package = _ROOT / "arrearlens"
    folder = tempfile.mkdtemp(prefix="arrearlens-code-")
    with zipfile.ZipFile(archive := f"{folder}/arrearlens.zip", "w") as z:
        for path in package.rglob("*.py"):
            z.write(path, path.relative_to(_ROOT))
    context.addPyFile(archive)
    context._arrearlens_shipped = True


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; only under a local master (tests) a folder of this machine will do."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if named is None:
        named = context.getCheckpointDir()
    if named is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="arrearlens-checkpoint-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """Write `df` to the shared checkpoint folder and go on from those files."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Let Spark delete now what lies on disk for frames that nobody holds any more: shuffles of finished steps, and
    checkpoints where the cluster cleans them. By itself it does so when the driver's JVM next collects garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


#: What this Python worker remembers from task to task, by operator: how to forget it.
_remembered: dict[str, Callable[[], object]] = {}


def remember(operator: str, forget: Callable[[], object]) -> None:
    """Note in a worker that the operator left something there for its next task."""
    _remembered[operator] = forget


def forget_others(operator: str) -> None:
    """Give back the memory that other operators left in this worker, which Spark uses for one stage after another."""
    others = [_remembered.pop(name) for name in list(_remembered) if name != operator]
    for forget in others:
        forget()
    if others:
        gc.collect()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not in every C library
        if trim is not None:
            trim(0)


# -- words and their hashes -------------------------------------------------------------------

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse modulo 2**64."""
    if len(_powers["up"]) < n:
        for key, base in (("up", _P), ("down", _P_INV)):
            row = np.full(max(n, 1 << 16), base, np.uint64)
            row[0] = 1
            _powers[key] = np.multiply.accumulate(row)
    return _powers["up"][:n], _powers["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _blocks(data: bytes):
    """Cuts at white space, of about four megabytes; a longer word is a block of its own."""
    at = 0
    while at < len(data):
        end = at + _BLOCK
        if end < len(data):
            space = re.compile(rb"[\x20\x09-\x0D]").search(data, end)
            end = space.start() if space else len(data)
        yield data[at:end]
        at = end


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word of `data`, and its number of code points."""
    if len(data) > _BLOCK:
        parts = [word_hashes_of_block(b) for b in _blocks(data)]
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    return word_hashes_of_block(data)


def word_hashes_of_block(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    if len(data) > 2 * _BLOCK:  # holds a giant word: hash word by word instead of in whole columns
        words = data.split()
        h = [word_hashes_of_block(w)[0][0] if len(w) <= 2 * _BLOCK else int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little") for w in words]
        return np.array(h, np.uint64), np.array([len(w.decode("utf-8", "replace")) for w in words], np.int64)
    b = np.frombuffer(data, np.uint8)
    space = _SPACE[b]
    edge = np.diff(np.concatenate(([True], space, [True])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    up, down = _power(len(b) + 1)
    sums = np.zeros(len(b) + 1, np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[: len(b)], out=sums[1:])
    h = (sums[ends] - sums[starts]) * down[starts]
    points = np.zeros(len(b) + 1, np.int64)
    np.cumsum((b & 0xC0) != 0x80, out=points[1:])
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), points[ends] - points[starts]


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash for each run of n words; for fewer words, one for them all; none without words."""
    n = min(n, len(words))
    if n == 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(words) - n + 1, np.uint64)
    for i in range(n):
        out = mix(out * np.uint64(0x9FB21C651E98DF25) + words[i : len(words) - n + 1 + i])
    return out


def utf8(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "replace")
