"""A table that grows batch by batch, with an index of its keys.

Rows lie in folders, one for a load, and in these by a hash of the key. Each folder has an index: for every bucket of
keys a Bloom filter in segments of 32,768 bits, built by Spark's bitmap aggregate. A batch looks its keys up in the
index and opens only the buckets of folders that may hold one of them. The list of folders is one small file, and a
new list takes its place; when folders are many, the smaller ones are joined.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.storage import CODEC, data_files, filesystem, materialize, read_text, write_text

BUCKET = "key_bucket"
#: Buckets of a table: one for so many rows of its first load, within these bounds.
BUCKET_ROWS = 1 << 20
BUCKETS = (16, 4096)
#: Keys of a segment and bits of a key: one in some 25,000 unknown keys seems known.
SEGMENT_KEYS = 1365
BITS = 8
#: Folders from which on all but the largest are joined.
MAX_FOLDERS = 8


def _hashes(keys: list[str]) -> tuple[Column, Column]:
    return F.xxhash64(*keys), F.xxhash64(F.lit("second"), *keys)


def _positions(keys: list[str]) -> Column:
    """The bits of a key in its segment."""
    first, second = _hashes(keys)
    low, step = F.shiftrightunsigned(first, 20), F.shiftrightunsigned(second, 20)
    return F.array(*[F.pmod(low + i * step, F.lit(32768)) for i in range(BITS)])


def _segment(keys: list[str]) -> Column:
    return F.pmod(F.shiftrightunsigned(_hashes(keys)[1], 3), F.col("segments")).cast("int")


def _bit(bits: Column, position: Column) -> Column:
    byte = F.substring(bits, (F.floor(position / 8) + 1).cast("int"), F.lit(1))
    mask = F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), (position % 8 + 1).cast("int"))
    return F.conv(F.hex(byte), 16, 10).cast("int").bitwiseAND(mask)


class KeyedTable:
    """Rows of ``schema`` below ``root``, in which a key is stored once. ``keys`` identify a row; NULL is a key."""

    LIVE = "_live"

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, keys: list[str]):
        self.spark, self.root, self.schema, self.keys = spark, root.rstrip("/"), schema, keys

    def _lists(self) -> list[int]:
        fs, folder = filesystem(self.spark, f"{self.root}/{self.LIVE}")
        if not fs.exists(folder):
            return []
        return sorted(int(n) for n in (s.getPath().getName() for s in fs.listStatus(folder)) if n.isdigit())

    def _state(self) -> dict:
        numbers = self._lists()
        if not numbers:
            return {"buckets": BUCKETS[0], "folders": []}
        return json.loads(read_text(self.spark, f"{self.root}/{self.LIVE}/{numbers[-1]}"))

    def folders(self) -> list[str]:
        return self._state()["folders"]

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(_hashes(self.keys)[0], F.lit(buckets)).cast("int")

    def _publish(self, folders: list[str], buckets: int) -> None:
        """The next list of folders: written hidden and renamed to its number. Lists before the last are dropped."""
        numbers = self._lists()
        number, hidden = max(numbers, default=0) + 1, f"{self.root}/{self.LIVE}/_{uuid.uuid4().hex}"
        write_text(self.spark, hidden, json.dumps({"buckets": buckets, "folders": folders}))
        fs, source = filesystem(self.spark, hidden)
        if not fs.rename(source, filesystem(self.spark, f"{self.root}/{self.LIVE}/{number}")[1]):
            raise RuntimeError(f"another load was published as number {number}")
        for old in numbers[:-1]:
            fs.delete(filesystem(self.spark, f"{self.root}/{self.LIVE}/{old}")[1], False)

    def _read(self, folders: list[str]) -> DataFrame:
        stored = T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())])
        if not folders:
            return self.spark.createDataFrame([], stored)
        frames = [self.spark.read.schema(stored).parquet(f"{self.root}/{f}") for f in folders]
        out = frames[0]
        for frame in frames[1:]:
            out = out.unionByName(frame)
        return out

    def read(self) -> DataFrame:
        """All rows."""
        return self._read(self.folders()).drop(BUCKET)

    def write(self, folder: str, rows: DataFrame, buckets: int) -> None:
        """Write a folder anew, with its index; it is not part of the table before it is listed."""
        laid = rows.select(*self.schema.names).withColumn(BUCKET, self._bucket(buckets)).hint("rebalance", BUCKET)
        laid.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.root}/{folder}", compression=CODEC)
        stored = self._read([folder])
        sizes = stored.groupBy(BUCKET).agg(F.ceil(F.count(F.lit(1)) / SEGMENT_KEYS).cast("int").alias("segments"))
        # one row for a bucket
        placed = stored.select(BUCKET, *self.keys).join(F.broadcast(sizes), BUCKET)
        placed = placed.select(BUCKET, "segments", _segment(self.keys).alias("segment"), F.explode(_positions(self.keys)).alias("bit"))
        index = placed.groupBy(BUCKET, "segments", "segment").agg(F.bitmap_construct_agg("bit").alias("bits"))
        index.write.mode("overwrite").parquet(f"{self.root}/_index/{folder}")

    def backfill(self, rows: DataFrame, folder: str = "history") -> None:
        """The first load: the table is these rows, of which each has its own key."""
        needed = 1 << max(0, (rows.count() // BUCKET_ROWS).bit_length())
        buckets = min(max(needed, BUCKETS[0]), BUCKETS[1])
        self.write(folder, rows, buckets)
        self._publish([folder], buckets)

    def places(self, batch: DataFrame, folders: list[str], buckets: int) -> list[tuple[str, int]]:
        """(folder, bucket) that may hold a key of the batch."""
        if not folders:
            return []
        index = None
        for folder in folders:
            one = self.spark.read.schema(INDEX).parquet(f"{self.root}/_index/{folder}").withColumn("folder", F.lit(folder))
            index = one if index is None else index.unionByName(one)
        sizes = F.broadcast(index.select("folder", BUCKET, "segments").distinct())  # a row for each folder and bucket
        looked = batch.select(*self.keys).withColumn(BUCKET, self._bucket(buckets)).join(sizes, BUCKET)
        looked = looked.select("folder", BUCKET, _segment(self.keys).alias("segment"), _positions(self.keys).alias("at"))
        hits = looked.join(index, ["folder", BUCKET, "segment"]).filter(F.forall("at", lambda p: _bit(F.col("bits"), p) != 0))
        return sorted((r["folder"], r[BUCKET]) for r in hits.select("folder", BUCKET).distinct().collect())

    def load(self, batch: DataFrame, folder: str) -> list[tuple[str, int]]:
        """Add the rows whose key is new; returns the (folder, bucket) pairs that were opened.

        The batch has a key once. A repeated call with the same folder gives the same table: a folder that is listed is
        compared with the others and written anew, one that was joined to others meanwhile finds its rows there.
        """
        batch = materialize(batch.select(*self.schema.names), "keyed-batch", CODEC)
        state = self._state()
        others, buckets = [f for f in state["folders"] if f != folder], state["buckets"]
        opened = self.places(batch, others, buckets)
        paths = [f"{self.root}/{f}/{BUCKET}={bucket}" for f, bucket in opened]
        new = batch
        if paths:
            known = self.spark.read.schema(self.schema).parquet(*paths).select(*self.keys).alias("k")
            same = F.lit(True)
            for key in self.keys:
                same = same & F.col(f"n.{key}").eqNullSafe(F.col(f"k.{key}"))
            # of what was opened only the batch's own keys are compared with it
            wanted = known.join(batch.select(*self.keys).alias("n"), same, "left_semi")
            new = batch.alias("n").join(materialize(wanted, "known-keys").alias("k"), same, "left_anti")
        self.write(folder, new, buckets)
        self._publish([*others, folder], buckets)
        self.compact()
        return opened

    def compact(self) -> None:
        """Join all folders but the largest when there are more than ``MAX_FOLDERS``; old files go after the new list."""
        state = self._state()
        folders, buckets = state["folders"], state["buckets"]
        if len(folders) <= MAX_FOLDERS:
            return
        fs, _ = filesystem(self.spark, self.root)
        size = {f: fs.getContentSummary(filesystem(self.spark, f"{self.root}/{f}")[1]).getLength() for f in folders}
        largest = max(folders, key=lambda f: (size[f], f))
        joined = f"joined-{uuid.uuid4().hex[:12]}"
        rest = [f for f in folders if f != largest]
        self.write(joined, self._read(rest).drop(BUCKET), buckets)
        self._publish([largest, joined], buckets)
        for folder in rest:
            for path in (folder, f"_index/{folder}"):
                fs.delete(filesystem(self.spark, f"{self.root}/{path}")[1], True)

    def n_files(self) -> int:
        return sum(len(data_files(self.spark, f"{self.root}/{f}")) for f in self.folders())


INDEX = f"{BUCKET} int, segments int, segment int, bits binary"
