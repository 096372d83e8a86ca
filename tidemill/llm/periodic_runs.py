"""Periodic runs of words by seeds on diagonals.

A run of period q repeats itself q words further on, so two of its k-grams lie on the diagonal of lag q.
Lags are taken in bands; a band's k is the overlap that every run with such a lag is sure to have, and the
band ends where 2q - 1 would pass k. By the theorem of Fine and Wilf a run's first k-gram then comes back for
the first time exactly q words later, so neighbouring occurrences are enough and no k-gram's occurrences are
paired with all others. A pair is extended along its diagonal to both sides; a table of the furthest place
that was covered on each lag keeps it from being extended again.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import mix64, read_table, rolling_hashes, text_of

MIN_LENGTH = 6
MIN_EXPONENT = 4
#: Words whose k-grams are sorted together. Longer documents are taken alone, as a whole.
SLICE_WORDS = 250_000
#: Documents of one output batch.
BATCH_ROWS = 2000

RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def lag_bands(longest: int, min_length: int, min_exponent: int) -> Iterator[tuple[int, int, int]]:
    """(first lag, last lag, k) of every band that a text of ``longest`` words needs."""
    lag = 1
    while max(min_length, min_exponent * lag) <= longest:
        first, k = lag, max(min_length, min_exponent * lag) - lag
        while 2 * (lag + 1) - 1 <= min(k, max(min_length, min_exponent * (lag + 1)) - lag - 1):
            lag += 1
            k = min(k, max(min_length, min_exponent * lag) - lag)
        yield first, lag, k
        lag += 1


def _same_ahead(words: np.ndarray, at: int, lag: int, end: int) -> int:
    """The first place from ``at`` on whose word differs from the one ``lag`` further, ``end - lag`` at most."""
    step = 64
    while at + lag < end:
        upto = min(at + step, end - lag)
        differs = np.flatnonzero(words[at:upto] != words[at + lag : upto + lag])
        if len(differs):
            return at + int(differs[0])
        at, step = upto, 2 * step
    return at


def _same_behind(words: np.ndarray, at: int, lag: int, begin: int) -> int:
    """The first place of the stretch before ``at`` whose words equal those ``lag`` further."""
    step = 64
    while at > begin:
        low = max(begin, at - step)
        differs = np.flatnonzero(words[low:at] != words[low + lag : at + lag])
        if len(differs):
            return low + int(differs[-1]) + 1
        at, step = low, 2 * step
    return at


def find_runs(words: np.ndarray, sizes: np.ndarray, min_length: int, min_exponent: int) -> list[tuple]:
    """(document, start, length, period) of every run; ``words`` are the numbered words of all documents."""
    if not len(words):
        return []
    ends = np.cumsum(sizes)
    begins = ends - sizes
    owner = np.repeat(np.arange(len(sizes)), sizes)
    mixed = mix64(words.astype(np.uint64) + np.uint64(1))
    salt = mix64(owner.astype(np.uint64))
    found: list[tuple] = []
    stretch_end, base = None, 0
    for first, last, k in lag_bands(int(sizes.max()), min_length, min_exponent):
        grams = rolling_hashes(mixed, k)
        inside = owner[: len(grams)] == owner[k - 1 :]
        if stretch_end is not None:  # all places of a run hold a base gram that comes back in its document
            inside &= stretch_end[: len(grams)] - np.arange(len(grams)) > k - base
        places = np.flatnonzero(inside)
        keys = grams[places] ^ salt[places]
        order = np.argsort(keys, kind="stable")
        again = np.flatnonzero(keys[order[1:]] == keys[order[:-1]])
        here, there = places[order[again]], places[order[again + 1]]
        if stretch_end is None:
            seed = np.zeros(len(words) + 1, bool)
            seed[here] = seed[there] = True
            gaps = np.where(seed, len(words), np.arange(len(seed)))
            stretch_end, base = np.minimum.accumulate(gaps[::-1])[::-1], k
        lags = there - here
        near = (lags >= first) & (lags <= last) & (owner[here] == owner[there])
        here, lags = here[near], lags[near]
        order = np.lexsort((lags, here))
        covered: dict[int, int] = {}
        for at, lag in zip(here[order].tolist(), lags[order].tolist()):
            if at < covered.get(lag, -1):
                continue
            document = owner[at]
            left = _same_behind(words, at, lag, int(begins[document]))
            right = _same_ahead(words, at, lag, int(ends[document]))
            covered[lag] = right
            length = right - left + lag
            if right > at and length >= max(min_length, min_exponent * lag):
                found.append((int(document), left - int(begins[document]), length, lag))
        if not len(places):
            break
    return sorted(found, key=lambda r: (r[0], r[1], r[3]))


def collapse(words: list[bytes], runs: list[tuple]) -> list[bytes]:
    """The words that stay: those in no run, and of each run its first period unless another run drops it."""
    if not runs:
        return words
    stays = np.ones(len(words), bool)
    for start, length, period in runs:
        stays[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(stays).tolist()]


def _slices(texts: list[bytes]) -> Iterator[list[list[bytes]]]:
    held, size = [], 0
    for text in texts:
        words = text.split()
        if held and size + len(words) > SLICE_WORDS:
            yield held
            held, size = [], 0
        held.append(words)
        size += len(words)
    if held:
        yield held


def _runs_of(min_length: int, min_exponent: int):
    def run(batches):
        for whole in batches:
            for low in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(low, BATCH_ROWS)
                n_words, runs, collapsed = [], [], []
                for documents in _slices(batch.column(1).cast(pa.binary()).to_pylist()):
                    table: dict[bytes, int] = defaultdict()
                    table.default_factory = table.__len__
                    sizes = np.fromiter(map(len, documents), np.int64, len(documents))
                    numbers = map(table.__getitem__, chain.from_iterable(documents))
                    numbered = np.fromiter(numbers, np.int64, int(sizes.sum()))
                    of: dict[int, list[tuple]] = defaultdict(list)
                    for document, *found in find_runs(numbered, sizes, min_length, min_exponent):
                        of[document].append(tuple(found))
                    n_words += sizes.tolist()
                    for i, words in enumerate(documents):
                        own = of.get(i, [])
                        runs.append([{"start": s, "length": n, "period": q} for s, n, q in own])
                        collapsed.append(b" ".join(collapse(words, own)))
                columns = [batch.column(0), pa.array(n_words, pa.int64()), pa.array(runs, RUNS)]
                columns.append(pa.array(collapsed, pa.binary()).cast(pa.string()))
                yield pa.RecordBatch.from_arrays(columns, ["id", "n_words", "runs", "collapsed"])

    return run


def periodic_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = MIN_LENGTH,
    min_exponent: int = MIN_EXPONENT,
) -> DataFrame:
    """One row per input row: id, ``n_words``, ``runs`` (start, length, period) and the ``collapsed`` text.

    A run is a stretch of consecutive words with smallest period q that has at least ``min_length`` words and
    ``min_exponent`` (3 or more) periods, and that no neighbouring word extends. Runs are sorted by start, then
    period. The collapsed text holds, joined by one space, the words that no run holds after its first period.
    Words are runs without ASCII white space; a null or empty text has none and no run. Null and repeated ids
    are kept as they are; other columns are ignored. The plan is one scan without a shuffle; a task holds the
    k-grams of some documents, or of one longer document. Occurrences are found by 64-bit hashes of k-grams
    and compared word by word.
    """
    if min_exponent < 3 or min_length < 2:
        raise ValueError("runs need three periods and two words at least")
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return rows.mapInArrow(_runs_of(min_length, min_exponent), schema).withColumnRenamed("id", id_col)


def digest_runs(found: DataFrame) -> DataFrame:
    """The runs of each row as digests, with the run of greatest exact exponent (ties: start, then period)."""

    def sharper(best: Column, run: Column) -> Column:
        better = best["length"].isNull() | (run["length"] * best["period"] > best["length"] * run["period"])
        return F.when(better, run).otherwise(best)

    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), "")
    kept = [c for c in found.columns if c not in ("runs", "collapsed", "n_words")]
    best = found.withColumn("best", F.reduce("runs", none, sharper))
    return best.select(
        *kept,
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def repeated_tail(key, words: list[bytes]) -> list[bytes]:
    """Words of a tenth of all ids, with a tail that repeats a stretch of itself."""
    h = zlib.crc32(str(key).encode())
    n, g = len(words), h // 10
    if key is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def rewrite_words(docs: DataFrame, rewrite: Callable, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text) with the words that ``rewrite(id, words)`` makes of a text's words, joined by one space."""

    def run(batches):
        for whole in batches:
            for low in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(low, BATCH_ROWS)
                keys, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()
                made = [b" ".join(rewrite(key, text.split())) for key, text in zip(keys, texts)]
                columns = [batch.column(0), pa.array(made, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["id", "text"])

    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    made = rows.mapInArrow(run, rows.schema)
    return made.withColumnsRenamed({"id": id_col, "text": text_col})


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = rewrite_words(read_table(spark, sf_dir, "documents"), repeated_tail)
    return digest_runs(periodic_runs(documents))


QUERIES = {"op11_periodic_runs": op11_periodic_runs}
#: The contract's crc32 of ids and the search for maximal runs have no SQL form of bearable cost.
ORACLE = {}
