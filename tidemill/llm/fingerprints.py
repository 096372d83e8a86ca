"""Document fingerprints from prefix polynomial hashes.

A document's prefix arrays hold the polynomial hash of every prefix modulo two primes. The hash
of any span is a difference of two entries, so any two spans of two documents are compared in
constant time, and the longest common extension of two places is found by binary search.

The likeness of two documents is the share of their characters in common passages: fixed blocks of
one are looked up among all spans of the other, and each hit is extended both ways as far as the
documents agree.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import read_table, shuffle_partitions, text_of, utf8, worker_state

#: Fixed primes below 2**31, so that a product of two residues fits 64 bits, and a base for each.
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)
BASES = (911382323, 972663749, 1000003579, 805306457)
#: Primes with prefix arrays; the others only tell whole texts apart in the fingerprint.
SPAN_PRIMES = 2
BLOCK = 32
SLICE_BYTES = 8_000_000


def powers(which: int, n: int) -> np.ndarray:
    """Powers of a base modulo its prime, grown by doubling and kept by the worker."""
    held = worker_state(f"prime powers {which}", lambda: [np.ones(1, np.uint64)])
    if len(held[0]) < n:
        prime, base, size = PRIMES[which], BASES[which], 1 << max(16, (n - 1).bit_length())
        out, filled = np.ones(size, np.uint64), 1
        while filled < size:
            step = np.uint64(pow(base, filled, prime))
            out[filled : 2 * filled] = out[:filled] * step % np.uint64(prime)
            filled *= 2
        held[0] = out
    return held[0][:n]


class Prefixes:
    """Prefix arrays of a sequence of code points; ``total`` is the hash of all of it for each prime."""

    def __init__(self, points: np.ndarray):
        self.points, self.n = points, len(points)
        self.sums, totals = [], []
        value = points.astype(np.uint64) + np.uint64(1)
        for which, prime in enumerate(PRIMES):
            p = np.uint64(prime)
            term = value * powers(which, self.n) % p
            if which < SPAN_PRIMES:
                sums = np.zeros(self.n + 1, np.uint64)
                np.cumsum(term, out=sums[1:])
                sums %= p
                self.sums.append(sums)
                totals.append(int(sums[-1]))
            else:
                totals.append(int(term.sum() % p))
        self.total = tuple(totals)

    @classmethod
    def joined(cls, a: Prefixes, b: Prefixes, keep: int, take: int) -> Prefixes:
        """Of the first ``keep`` of a followed by the first ``take`` of b, from their prefix arrays."""
        out = cls.__new__(cls)
        out.points, out.n = np.concatenate([a.points[:keep], b.points[:take]]), keep + take
        out.sums = []
        for which in range(SPAN_PRIMES):
            p = np.uint64(PRIMES[which])
            shift = np.uint64(pow(BASES[which], keep, PRIMES[which]))
            moved = (b.sums[which][1 : take + 1] * shift + a.sums[which][keep]) % p
            out.sums.append(np.concatenate([a.sums[which][: keep + 1], moved]))
        value = out.points.astype(np.uint64) + np.uint64(1)
        rest = [
            int((value * powers(w, out.n) % np.uint64(PRIMES[w])).sum() % np.uint64(PRIMES[w]))
            for w in range(SPAN_PRIMES, len(PRIMES))
        ]
        out.total = tuple([int(s[-1]) for s in out.sums] + rest)
        return out

    def same(self, i: int, other: Prefixes, j: int, length: int) -> bool:
        """Whether the spans of ``length`` from i here and from j there are equal."""
        for which in range(SPAN_PRIMES):
            p, a, b = PRIMES[which], self.sums[which], other.sums[which]
            here, there = int(a[i + length]) - int(a[i]), int(b[j + length]) - int(b[j])
            if i >= j:
                there *= pow(BASES[which], i - j, p)
            else:
                here *= pow(BASES[which], j - i, p)
            if (here - there) % p:
                return False
        return True

    def forward(self, i: int, other: Prefixes, j: int) -> int:
        """Longest common extension to the right of the places i and j."""
        low, high = 0, min(self.n - i, other.n - j)
        while low < high:
            middle = (low + high + 1) // 2
            if self.same(i, other, j, middle):
                low = middle
            else:
                high = middle - 1
        return low

    def backward(self, i: int, other: Prefixes, j: int) -> int:
        """Longest common extension to the left of the places i and j."""
        low, high = 0, min(i, j)
        while low < high:
            middle = (low + high + 1) // 2
            if self.same(i - middle, other, j - middle, middle):
                low = middle
            else:
                high = middle - 1
        return low

    def spans(self, length: int, places: np.ndarray | None = None) -> np.ndarray:
        """A comparable hash of the spans of ``length`` at all places or the given ones, as if at the end.

        Every difference is brought to one power of the base, so that equal spans have equal values.
        """
        out = np.zeros(0, np.uint64)
        at = np.arange(self.n - length + 1) if places is None else places
        if not len(at) or self.n < length:
            return out
        for which in range(SPAN_PRIMES):
            p = np.uint64(PRIMES[which])
            sums = self.sums[which]
            value = (sums[at + length] + p - sums[at]) % p * inverse_powers(which, self.n)[at] % p
            out = value if not which else out << np.uint64(31) | value
        return out

    def fingerprint(self) -> str:
        """Length and hashes of the whole text; equal texts, and in practice only those, share it."""
        return f"{self.n:x}-" + "".join(f"{t:08x}" for t in self.total)


def inverse_powers(which: int, n: int) -> np.ndarray:
    held = worker_state(f"inverse powers {which}", lambda: [np.ones(1, np.uint64)])
    if len(held[0]) < n:
        prime, size = PRIMES[which], 1 << max(16, (n - 1).bit_length())
        base = pow(BASES[which], -1, prime)
        out, filled = np.ones(size, np.uint64), 1
        while filled < size:
            out[filled : 2 * filled] = out[:filled] * np.uint64(pow(base, filled, prime)) % np.uint64(prime)
            filled *= 2
        held[0] = out
    return held[0][:n]


def likeness(a: Prefixes, b: Prefixes, block: int = BLOCK) -> float:
    """Share of the characters of both that lie in common passages, 0 to 1; 1 if equal, as two empty texts are.

    The common start and end are found at once. Between them, each block of ``a`` that occurs in
    ``b`` and is not covered yet is extended to the longest common passage. A passage of ``b``
    counts once.
    """
    if a.n == b.n and a.total == b.total:
        return 1.0
    if not a.n or not b.n:
        return 0.0
    head = a.forward(0, b, 0)
    most = min(a.n, b.n) - head
    tail = min(a.backward(a.n, b, b.n), most)
    covered, used = head + tail, head + tail
    begin, end = head, a.n - tail
    if end - begin >= block and b.n - head - tail >= block:
        places = np.arange(begin, end - block + 1, block)
        own, theirs = a.spans(block, places), b.spans(block, np.arange(head, b.n - tail - block + 1))
        order = np.argsort(theirs, kind="stable")
        at = np.searchsorted(theirs[order], own)
        found = np.flatnonzero((at < len(order)) & (theirs[order[np.minimum(at, len(order) - 1)]] == own))
        taken, done = np.zeros(b.n, bool), begin
        for k in found.tolist():
            i, j = int(places[k]), int(order[at[k]]) + head
            if i < done:
                continue
            left = min(a.backward(i, b, j), i - done, j - head)
            right = min(a.forward(i, b, j), end - i, b.n - tail - j)
            covered += left + right
            done = i + right
            taken[j - left : j + right] = True
        used += int(taken.sum())
    return (min(covered, a.n) + min(used, b.n)) / (a.n + b.n)


def code_points(data: bytes) -> np.ndarray:
    return np.frombuffer(data.decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)


DEALT = "bucket int, guest int, key long, tie long, id long, text binary"
RESULT = (
    "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
TYPES = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string(), "double": pa.float64()}


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split() for c in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, TYPES[k]) for c, (_, k) in zip(columns, names)], [n for n, _ in names])


def deal(bounds: np.ndarray):
    """Rows to the range of ids they are in, and the first id of a range also, as a guest, to the range before.

    Bucket i begins at ``bounds[i]``; the first one is before the last, so that the last document
    finds the first.
    """

    def run(batches):
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            rows, size = [], 0
            for key, tie, own, text in zip(*(c.to_pylist() for c in batch.columns)):
                at = max(0, int(np.searchsorted(bounds, key, "right")) - 1)
                packed = packer.compress(utf8(text))
                rows.append((at, 0, key, tie, own, packed))
                if key == bounds[at]:
                    rows.append(((at - 1) % len(bounds), 1, key, tie, own, packed))
                size += len(packed)
                if size > SLICE_BYTES:
                    yield _batch(DEALT, rows)
                    rows, size = [], 0
            yield _batch(DEALT, rows)

    return run


def fingerprints_of(batches):
    """From the rows of whole ranges in order, guests last: the result for every row but the guests.

    Of a range's guests only the first is the next document of its last one.
    """
    unpack = zstandard.ZstdDecompressor()
    bucket, before, last = None, None, False

    def result(row, following) -> tuple:
        own, a = row
        b = following[1]
        half = a.n // 2
        take = min(half, b.n)
        edited = Prefixes.joined(a, b, a.n - half, take)
        text = edited.points.tobytes().decode("utf-32-le", "surrogatepass")
        digest = hashlib.sha256(utf8(text)).hexdigest()
        return own, a.n, digest, a.fingerprint(), edited.fingerprint(), likeness(a, edited), likeness(a, b)

    for batch in batches:
        rows = []
        for at, guest, _, _, own, packed in zip(*(c.to_pylist() for c in batch.columns)):
            if at != bucket:
                bucket, before, last = at, None, False
            if last:
                continue
            here = (own, Prefixes(code_points(unpack.decompress(packed))))
            if before is not None:
                rows.append(result(before, here))
            before, last = here, bool(guest)
        yield _batch(RESULT, rows)


def fingerprint_table(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranges: int | None = None
) -> DataFrame:
    """One row per input row: id, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``,
    ``near_edited``, ``near_next``.

    The next document is the following row by id, a null id first, rows with the same id by a hash of
    their text; after the last comes the first. A null text is empty. A single row is its own next
    document. Equal texts have equal fingerprints and likeness 1. Other columns are ignored. No
    rows in, no rows out.
    """
    spark = docs.sparkSession
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))
    rows = docs.select(
        key.alias("key"), F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text")
    ).select("key", F.xxhash64("text").alias("tie"), "id", "text")
    ranges = ranges or max(8, 2 * shuffle_partitions(spark))
    steps = [i / ranges for i in range(ranges)]
    # ids that occur, at about equal distances: their number is the number of ranges
    found = docs.select(key.alias("key")).agg(F.min("key"), F.percentile_approx("key", steps, 20 * ranges)).first()
    if found[0] is None:
        return spark.createDataFrame([], RESULT).withColumnRenamed("id", id_col)
    bounds = np.unique(np.array([found[0], *found[1]], np.int64))
    dealt = rows.mapInArrow(deal(bounds), DEALT)
    dealt = dealt.repartition("bucket").sortWithinPartitions("bucket", "guest", "key", "tie")
    return dealt.mapInArrow(fingerprints_of, RESULT).withColumnRenamed("id", id_col)


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_table(read_table(spark, sf_dir, "documents"))


QUERIES = {"op5_fingerprints": op5_fingerprints}
ORACLE = {}
