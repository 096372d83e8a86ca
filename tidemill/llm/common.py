"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, ``[\x20\x09-\x0D]``. bytes.split() and bytes.translate() use the same six values.
SPACES = b"\t\n\x0b\x0c\r "


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def worker_state(key: str, build: Callable):
    """What a Python worker keeps from task to task. Values must depend on ``key`` alone."""
    store = sys.modules.setdefault("_tidemill_worker", types.ModuleType("_tidemill_worker")).__dict__
    if key not in store:
        store[key] = build()
    return store[key]


def worker_model(key: str, build: Callable):
    """A large thing that a Python worker keeps from task to task: one at a time, whatever operators it serves."""
    held = worker_state("model", dict)
    if key not in held:
        held.clear()
        held[key] = build()
    return held[key]


def release_model() -> None:
    """Drop what an earlier stage left in this worker, before a stage that needs the memory itself."""
    worker_state("model", dict).clear()


def text_of(column: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def count_words(column: str) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+``; the text must not be null."""

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: len(utf8(t).split())).astype("int64")

    return count(F.col(column))


def utf8(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def mix64(x: np.ndarray) -> np.ndarray:
    """SplitMix64's finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BASE = 0x9E3779B97F4A7C15 | 1
_LETTERS = mix64(np.arange(1, 257, dtype=np.uint64))
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[list(SPACES)] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, grown by doubling and kept by the worker."""
    held = worker_state("powers", lambda: [np.ones(1, np.uint64), np.ones(1, np.uint64)])
    if len(held[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        for at, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            out = np.ones(size, np.uint64)
            filled = 1
            while filled < size:
                step = np.uint64(pow(base, filled, 1 << 64))
                out[filled : 2 * filled] = out[:filled] * step
                filled *= 2
            held[at] = out
    return held[0][:n], held[1][:n]


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word ``[^\\x20\\x09-\\x0D]+`` of UTF-8 bytes."""
    inside = _IS_WORD[data]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
    return edges[0::2], edges[1::2]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each word: differences of prefix sums of a polynomial modulo 2**64, mixed."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    power, inverse = _powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_LETTERS[_LOWER[data] if lower else data] * power, out=sums[1:])
    value = (sums[ends] - sums[starts]) * inverse[starts]
    return mix64(value + np.uint64(0x632BE59BD9B4E019) * (ends - starts).astype(np.uint64))


def rolling_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """A hash of every run of ``length`` word hashes; empty if there are fewer words."""
    n = len(words)
    if n < length:
        return np.zeros(0, np.uint64)
    power, inverse = _powers(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(words * power, out=sums[1:])
    return mix64((sums[length:] - sums[:-length]) * inverse[: n - length + 1])
