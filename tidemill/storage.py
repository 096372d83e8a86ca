"""Where intermediate and target tables live, and how a target is replaced safely.

Everything is written to the folder the session names in ``spark.checkpoint.dir`` so
that a lost executor never takes an intermediate result with it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce
from threading import Lock
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can read: ``spark.checkpoint.dir``, else the warehouse."""
    return (spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def filesystem(spark: SparkSession, path: str):
    """Hadoop file system and path object, valid for any scheme Spark can write to."""
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark._jsc.hadoopConfiguration()), hpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = filesystem(spark, path)
    return fs.exists(hpath)


def path_matches(spark: SparkSession, pattern: str) -> bool:
    """Whether a path, possibly with wildcards, leads to anything."""
    fs, hpath = filesystem(spark, pattern)
    found = fs.globStatus(hpath)
    return found is not None and len(found) > 0


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder, dropped when the application ends."""
    mine = f"{shared_dir(spark)}/tidemill/{spark.sparkContext.applicationId}"
    path = f"{mine}/{label}-{uuid.uuid4().hex[:12]}"
    fs, hpath = filesystem(spark, path)
    fs.mkdirs(hpath)
    fs.deleteOnExit(filesystem(spark, mine)[1])
    return path


#: Codec of stored tables: smaller than the default, and they are most of what a build writes.
CODEC = "zstd"

_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_DROPPING: dict[int, tuple[int, str | None]] = {}
_DROPPING_LOCK = Lock()


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes inside go as soon as a write ends, not when the driver collects its garbage.

    A written table never needs them again. Writes of several threads may overlap; the last restores the setting.
    """
    with _DROPPING_LOCK:
        writers, before = _DROPPING.get(id(spark), (0, spark.conf.get(_DROP_SHUFFLES, None)))
        _DROPPING[id(spark)] = writers + 1, before
        spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        with _DROPPING_LOCK:
            writers, before = _DROPPING.pop(id(spark))
            if writers > 1:
                _DROPPING[id(spark)] = writers - 1, before
            elif before is None:
                spark.conf.unset(_DROP_SHUFFLES)
            else:
                spark.conf.set(_DROP_SHUFFLES, before)


def materialize(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """Cut the lineage by writing ``df`` once and reading the written table back; the session's codec unless one is named."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with shuffles_dropped(spark):
        df.write.mode("overwrite").parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


BROADCAST_BYTES = 64 << 20
_ROW_BYTES = 16
_VALUE_BYTES = 8


def byte_size(df: DataFrame, columns: list[str] | None = None) -> Column:
    """Aggregate that estimates the bytes of the chosen columns in memory, from the data itself.

    Text and binary values count with their real length. Nested columns have no bound, so they
    are not accepted.
    """
    per_row = F.lit(_ROW_BYTES)
    for field in df.select(*(columns or df.columns)).schema.fields:
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            raise TypeError(f"no size bound for nested column {field.name}")
        per_row = per_row + _VALUE_BYTES
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            per_row = per_row + F.coalesce(F.octet_length(field.name), F.lit(0))
    return F.coalesce(F.sum(per_row.cast("long")), F.lit(0))


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only after measuring the frame; a larger one stays with the shuffle join.

    ``df`` should be a written table (see :func:`materialize`), so that measuring it is cheap.
    """
    return F.broadcast(df) if df.agg(byte_size(df)).first()[0] <= max_bytes else df


#: What one side of a join that runs beside others may take, with what a row takes in a hash table besides its bytes.
SIDE_BYTES = BROADCAST_BYTES // 2
_HASHED_ROW_BYTES = 64


def broadcasts_on(spark: SparkSession) -> bool:
    return not spark.conf.get("spark.sql.autoBroadcastJoinThreshold").startswith("-")


def join_side(df: DataFrame, max_bytes: int = SIDE_BYTES) -> DataFrame:
    """One side of a join, broadcast or shuffled by its measured bytes.

    Without a hint the size of the files decides, and a well compressed file is a small part of its rows in memory:
    the driver would hold many times the limit. ``df`` should be read from files.
    """
    taken = byte_size(df) + F.count(F.lit(1)) * _HASHED_ROW_BYTES
    small = broadcasts_on(df.sparkSession) and df.agg(taken).first()[0] <= max_bytes
    return F.broadcast(df) if small else df.hint("merge")


def read_text(spark: SparkSession, path: str) -> str:
    """A small file, read by the Hadoop file system without a Spark job."""
    fs, hpath = filesystem(spark, path)
    stream = fs.open(hpath)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, hpath = filesystem(spark, path)
    stream = fs.create(hpath, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def data_files(spark: SparkSession, folder: str) -> list[str]:
    """Names of a folder's Parquet files, relative to it."""
    fs, hpath = filesystem(spark, folder)
    base, found, files = fs.resolvePath(hpath).toString().rstrip("/") + "/", [], fs.listFiles(hpath, True)
    while files.hasNext():
        path = files.next().getPath().toString()
        name = path[len(base) :] if path.startswith(base) else path.split(folder.rstrip("/") + "/", 1)[-1]
        if name.endswith(".parquet") and not any(part.startswith(("_", ".")) for part in name.split("/")):
            found.append(name)
    return sorted(found)


#: Folders and the files of them that make up a version; None stands for all files.
Parts = dict[str, list[str] | None]


class VersionedTables:
    """Tables under ``root/<name>/v<number>``; the newest published version is the current one.

    Parquet has no UPDATE / DELETE / MERGE, and overwriting a path that is being read destroys it. A replacement is
    therefore written beside the old version and becomes visible through one marker file, after its gate has passed.
    A version may take over files of older ones, which a list in its folder names; its own folder then holds only what
    is new. Tables that belong together are published by one file that names the version of each.
    """

    MARKER = "_PUBLISHED"
    BUILDS = "_builds"
    PARTS = "_PARTS"
    SCHEMA = "_SCHEMA"

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _versions(self, name: str, published: bool, builds: int = 1) -> list[int]:
        fs, hpath = filesystem(self.spark, f"{self.root}/{name}")
        if not fs.exists(hpath):
            return []
        found, built = [], {build[name] for build in self._builds(builds) if name in build} if published else set()
        for status in fs.listStatus(hpath):
            label = status.getPath().getName()
            if label.startswith("v") and label[1:].isdigit():
                marker = f"{self.root}/{name}/{label}/{self.MARKER}"
                if not published or int(label[1:]) in built or path_exists(self.spark, marker):
                    found.append(int(label[1:]))
        return sorted(found)

    def _build_numbers(self) -> list[int]:
        fs, folder = filesystem(self.spark, f"{self.root}/{self.BUILDS}")
        if not fs.exists(folder):
            return []
        return sorted(int(n) for n in (s.getPath().getName() for s in fs.listStatus(folder)) if n.isdigit())

    def _builds(self, last: int = 1) -> list[dict[str, int]]:
        """Versions by table of the newest builds, oldest first. A build names all tables ever built."""
        numbers = self._build_numbers()[-last:] if last else []
        return [json.loads(read_text(self.spark, f"{self.root}/{self.BUILDS}/{n}")) for n in numbers]

    def publish(self, versions: dict[str, int]) -> None:
        """Make written versions current, all at the same moment: by the renaming of one file."""
        number = max(self._build_numbers(), default=0) + 1
        before = self._builds()[0] if number > 1 else {}
        hidden = f"{self.root}/{self.BUILDS}/_{uuid.uuid4().hex}"
        write_text(self.spark, hidden, json.dumps(before | versions))
        fs, source = filesystem(self.spark, hidden)
        if not fs.rename(source, filesystem(self.spark, f"{self.root}/{self.BUILDS}/{number}")[1]):
            raise RuntimeError(f"another build was published as number {number}")

    def read_together(self, names: list[str]) -> dict[str, DataFrame]:
        """Tables of one build, also while another is published: the builds are listed once."""
        builds = self._builds()
        if not builds or any(n not in builds[0] for n in names):
            raise ValueError(f"no build holds {', '.join(names)}")
        return {n: self.read_version(n, builds[0][n]) for n in names}

    def holds_build(self, names: list[str]) -> bool:
        builds = self._builds()
        return bool(builds) and all(n in builds[0] for n in names)

    def exists(self, name: str) -> bool:
        return bool(self._versions(name, published=True))

    def current(self, name: str) -> int:
        versions = self._versions(name, published=True)
        if not versions:
            raise ValueError(f"table {name} has no published version under {self.root}")
        return versions[-1]

    def path(self, name: str) -> str:
        """The folder of the current version."""
        return f"{self.root}/{name}/v{self.current(name)}"

    def parts(self, name: str, version: int) -> Parts:
        """The files of a version by folder (v1, v2, ...)."""
        listed = f"{self.root}/{name}/v{version}/{self.PARTS}"
        taken = json.loads(read_text(self.spark, listed)) if path_exists(self.spark, listed) else {}
        return taken | {f"v{version}": None}

    def read_version(self, name: str, version: int, parts: Parts | None = None) -> DataFrame:
        """The rows of a version, folder by folder; ``parts`` are some of its files."""
        frames = []
        for folder, files in (parts or self.parts(name, version)).items():
            base = f"{self.root}/{name}/{folder}"
            schema = T.StructType.fromJson(json.loads(read_text(self.spark, f"{base}/{self.SCHEMA}")))
            if files is None:
                frames.append(self.spark.read.schema(schema).parquet(base))
            elif files:
                paths = [f"{base}/{file}" for file in files]
                frames.append(self.spark.read.schema(schema).option("basePath", base).parquet(*paths))
        return reduce(DataFrame.unionByName, frames)

    def read(self, name: str) -> DataFrame:
        return self.read_version(name, self.current(name))

    def replace(self, name: str, df: DataFrame, gate=None, partition_by: list[str] | None = None) -> DataFrame:
        """Write version n+1, run ``gate`` on the written rows, then publish it."""
        version, written = self.write_version(name, df, partition_by)
        if gate is not None:
            gate(written)
        self._mark(name, version)
        return written

    def _mark(self, name: str, version: int) -> None:
        fs, marker = filesystem(self.spark, f"{self.root}/{name}/v{version}/{self.MARKER}")
        fs.create(marker, True).close()

    def write_version(
        self, name: str, df: DataFrame, partition_by: list[str] | None = None, taken: Parts | None = None
    ) -> tuple[int, DataFrame]:
        """Write version n+1 without publishing it: the rows of ``df`` and the files that are taken over."""
        version = max(self._versions(name, published=False), default=0) + 1
        target = f"{self.root}/{name}/v{version}"
        writer = df.write.mode("errorifexists")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        with shuffles_dropped(self.spark):
            writer.parquet(target, compression=CODEC)
        # a table by partitions has no file that would tell the columns of no rows
        write_text(self.spark, f"{target}/{self.SCHEMA}", df.schema.json())
        if taken:
            write_text(self.spark, f"{target}/{self.PARTS}", json.dumps(taken))
        return version, self.read_version(name, version)

    def vacuum(self, name: str, keep: int = 2) -> list[int]:
        """Drop all but the newest ``keep`` published versions, and builds that name others; returns the dropped numbers.

        Folders from which a kept version takes files stay. Call it when no reader of an old version and no writer
        is active.
        """
        numbers = self._build_numbers()
        newest = self._versions(name, published=True, builds=len(numbers))[-max(keep, 1) :]
        kept = {int(folder[1:]) for version in newest for folder in self.parts(name, version)}
        dropped = [v for v in self._versions(name, published=False) if v not in kept]
        builds = zip(numbers, self._builds(len(numbers)))
        old = [f"{self.BUILDS}/{n}" for n, build in builds if build.get(name) in dropped]
        for folder in [*(f"{name}/v{version}" for version in dropped), *old]:
            fs, hpath = filesystem(self.spark, f"{self.root}/{folder}")
            fs.delete(hpath, True)
        return dropped

    def create_if_absent(self, name: str, df: DataFrame) -> DataFrame:
        """Keep the current version when there is one, otherwise write the first."""
        return self.read(name) if self.exists(name) else self.replace(name, df)

    def append_version(
        self, name: str, df: DataFrame, partition_by: list[str] | None = None
    ) -> tuple[int, DataFrame]:
        """Write a version of the current rows and those of ``df``, of which only the latter are written."""
        return self.write_version(name, df, partition_by, self.parts(name, self.current(name)))

    def append(self, name: str, df: DataFrame, gate=None) -> DataFrame:
        """Add rows as a new version that takes over all files of the current one.

        The rows become visible at once, after the gate. A repeated call adds them again unless the caller leaves out
        known keys. :meth:`compact` joins the folders of many appends.
        """
        if not self.exists(name):
            return self.replace(name, df, gate)
        version, written = self.append_version(name, df)
        if gate is not None:
            gate(written)
        self._mark(name, version)
        return written

    def compact(self, name: str, partition_by: list[str] | None = None, folders: int = 1) -> DataFrame:
        """One folder again, if the current version is spread over more than ``folders``."""
        version = self.current(name)
        if len(self.parts(name, version)) <= folders:
            return self.read_version(name, version)
        return self.replace(name, self.read_version(name, version), partition_by=partition_by)

    def update(self, name: str, condition: Column, values: dict[str, Column]) -> DataFrame:
        from tidemill.operators.load import update_rows

        return self.rewrite(name, condition, lambda df: update_rows(df, condition, values))

    def delete(self, name: str, condition: Column) -> DataFrame:
        from tidemill.operators.load import delete_rows

        return self.rewrite(name, condition, lambda df: delete_rows(df, condition))

    def rewrite(self, name: str, condition: Column, change: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Copy on write: ``change`` the files that hold rows of the condition, and take over all others.

        The files hit are found by their rows' ``_metadata.file_path``, so the first pass reads the condition's columns
        only. Without a row hit the current version stays.
        """
        version = self.current(name)
        hit: Parts = {}
        rest: Parts = {}
        for folder, files in self.parts(name, version).items():
            base = f"{self.root}/{name}/{folder}"
            rows = self.read_version(name, version, {folder: files}) if files != [] else None
            paths = rows.filter(condition).select("_metadata.file_path").distinct().collect() if rows is not None else []
            listed = data_files(self.spark, base) if files is None else files
            # Spark escapes paths as URIs; the relative names are compared without that
            changed = {unquote(row[0]).split(f"/{name}/{folder}/", 1)[-1] for row in paths}
            hit[folder] = [f for f in listed if unquote(f) in changed]
            rest[folder] = [f for f in listed if unquote(f) not in changed]
        if not any(hit.values()):
            return self.read_version(name, version)
        changed = change(self.read_version(name, version, {f: files for f, files in hit.items() if files}))
        version, written = self.write_version(name, changed, taken={f: files for f, files in rest.items() if files})
        self._mark(name, version)
        return written
