"""WARC archives: a writer with one gzip member per record, and a splittable reader.

The reader's tasks scan byte ranges of the archives for gzip's magic number. A hit is a candidate:
it counts only if its header decodes and what it holds begins as a WARC record. A task owns the
records that start inside its range and reads the last of them beyond its end, so every record is
read once, wherever ranges are cut.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import read_table, text_of, utf8
from tidemill.storage import filesystem, materialize, scratch_path

#: Bytes of archive that a reading task scans, and that it holds at once.
RANGE_BYTES = 32 << 20
CHUNK = 1 << 20
#: Payloads of fewer bytes are stored again each time.
LEAST_BYTES = 100
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Records have no date of their own; a fixed one keeps archives the same on every run.
DATE = "1970-01-01T00:00:00Z"


# ---------------------------------------------------------------- writing


def record_id(page_id) -> str:
    name = hashlib.sha256(f"page {page_id}".encode()).hexdigest()
    return f"<urn:uuid:{name[:8]}-{name[8:12]}-{name[12:16]}-{name[16:20]}-{name[20:32]}>"


def header_value(text: str) -> str:
    """A header field holds one line."""
    return " ".join(text.split())


def record(page_id, url: str | None, payload: bytes | None, size: int, digest: str, refers_to) -> bytes:
    """One uncompressed record; a revisit has no block, but the size and digest of the full payload."""
    kind = "response" if refers_to is None else "revisit"
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("X-Payload-Length", str(size)),
    ]
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if url is not None:
        fields.append(("WARC-Target-URI", header_value(url)))
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to)), ("X-Refers-To-Page", str(refers_to))]
    block = payload if refers_to is None else b""
    fields += [("Content-Type", "text/html"), ("Content-Length", str(len(block)))]
    head = b"\r\n".join([VERSION, *(utf8(f"{k}: {v}") for k, v in fields)])
    return head + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """``data`` as gzip that ends with a zero byte.

    The last byte is the top one of the size, which is zero below 16 MiB. A longer record is
    followed by an empty member, whose size is zero; readers of gzip skip it.
    """
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    out = packer.compress(data) + packer.flush()
    if out[-1]:
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        out += packer.flush()
    return out


def _members(batches):
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
        done = []
        for page_id, url, html, size, digest, refers_to in zip(*columns):
            payload = utf8(html) if refers_to is None else None
            # the writer of text files ends every row with a zero byte: the member's last one
            done.append(member(record(page_id, url, payload, size, digest, refers_to))[:-1])
        yield pa.RecordBatch.from_arrays([pa.array(done, pa.binary())], ["member"])


def write_warc(pages: DataFrame, path: str) -> None:
    """Write (page_id, url, html, payload_bytes, payload_digest, refers_to) as archives below ``path``.

    Spark's writer for text files puts out rows of bytes and a separator as they are. So the files are
    written by tasks to any file system Spark knows, and its commit keeps retried tasks from
    leaving anything behind.
    """
    rows = pages.select("page_id", "url", "html", "payload_bytes", "payload_digest", "refers_to")
    members = rows.mapInArrow(_members, "member binary")
    members.select(F.col("member").cast("string").alias("value")).write.option("lineSep", "\0").text(path)
    fs, folder = filesystem(pages.sparkSession, path)
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if name.endswith(".txt"):
            fs.rename(status.getPath(), filesystem(pages.sparkSession, f"{path}/{name[:-4]}.warc.gz")[1])


# ---------------------------------------------------------------- reading


class Source:
    """An archive of which a task holds the bytes around its place only."""

    def __init__(self, file, begin: int):
        self.file, self.at, self.data = file, begin, b""
        self.ended = False

    def more(self) -> bool:
        """Read on; False at the end of the file."""
        self.file.seek(self.at + len(self.data))
        new = self.file.read(CHUNK)
        self.data += new
        self.ended = not new
        return bool(new)

    def drop(self, to: int) -> None:
        """Forget the bytes before ``to``."""
        while self.at + len(self.data) < to:
            self.at += len(self.data)
            self.data = b""
            if not self.more():
                return
        self.data = self.data[to - self.at :]
        self.at = to


def next_magic(source: Source, begin: int, end: int) -> int | None:
    """Place of the next magic number that starts in [begin, end)."""
    source.drop(begin)
    while source.at < end:
        found = source.data.find(MAGIC)
        if found >= 0:
            return source.at + found if source.at + found < end else None
        source.drop(source.at + max(0, len(source.data) - len(MAGIC) + 1))
        if not source.more():
            return None
    return None


def decode(source: Source, begin: int, wanted: int | None = None) -> tuple[bytes, int] | None:
    """The content of the member that starts at ``begin`` and its end; None if there is none.

    With ``wanted``, only the first bytes are decoded.
    """
    unpack, out, at, size = zlib.decompressobj(31), [], begin, 0
    try:
        while not unpack.eof:
            source.drop(at) if wanted is None else None
            piece = source.data[at - source.at :]
            if not piece:
                if not source.more():
                    return None
                continue
            out.append(unpack.decompress(piece, wanted - size if wanted else 0))
            size += len(out[-1])
            at += len(piece) - len(unpack.unused_data)
            if wanted is not None and size >= wanted:
                break
    except zlib.error:
        return None
    return b"".join(out), at


def starts_record(source: Source, begin: int) -> bool:
    """Whether the candidate at ``begin`` has a gzip header and holds the beginning of a WARC record."""
    found = decode(source, begin, len(VERSION) - 3)
    return found is not None and found[0] == VERSION[:-3]


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")[1:]
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    length = int(fields["content-length"])
    if len(rest) < length:
        raise ValueError(f"a record of {length} bytes has {len(rest)}")
    return fields, rest[:length]


def records(file, begin: int, end: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, header fields, block) of the records whose member starts in [begin, end)."""
    source, at = Source(file, begin), begin
    while (found := next_magic(source, at, end)) is not None:
        if not starts_record(source, found):
            at = found + 1
            continue
        whole = decode(source, found)
        if whole is None:
            raise ValueError(f"the record at {found} is cut off or broken")
        yield found, *parse_record(whole[0])
        at = whole[1]


def read_ranges(batches):
    """From (path, begin, end): the records that start there, as (path, offset, fields, block)."""
    from pyarrow import fs

    kind = pa.map_(pa.string(), pa.string())
    names = ["path", "offset", "fields", "block"]
    for batch in batches:
        for path, begin, end in zip(*(c.to_pylist() for c in batch.columns)):
            store, inner = fs.FileSystem.from_uri(path)
            rows, size = [], 0
            with store.open_input_file(inner) as file:
                for offset, fields, block in records(file, begin, end):
                    rows.append((path, offset, list(fields.items()), block))
                    size += len(block)
                    if size > 8 << 20:
                        yield _record_batch(rows, kind, names)
                        rows, size = [], 0
            yield _record_batch(rows, kind, names)


def _record_batch(rows, kind, names):
    columns = list(zip(*rows)) if rows else [[]] * 4
    types = [pa.string(), pa.int64(), kind, pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


RECORD = "path string, offset long, fields map<string,string>, block binary"


def read_warc(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(path, offset, fields, block) of every record of the gzip archives directly below ``path``.

    Field names are in lower case. An empty folder gives no rows. Archives must be in a store that
    pyarrow opens by its address, such as file, hdfs or s3. A broken record is an error.
    """
    fs, folder = filesystem(spark, path)
    ranges = []
    for status in fs.listStatus(folder):
        name, length = status.getPath().getName(), status.getLen()
        if name[0] not in "._" and status.isFile():
            full = str(status.getPath().toUri().toString())
            full = full.replace("file:/", "file:///", 1) if not full.startswith("file://") else full
            ranges += [(full, b, min(b + range_bytes, length)) for b in range(0, length, range_bytes)]
    if not ranges:
        return spark.createDataFrame([], RECORD)
    rows = spark.createDataFrame(ranges, "path string, begin long, end long")
    # one task per range
    return rows.repartition(len(ranges), "path", "begin").mapInArrow(read_ranges, RECORD)


# ---------------------------------------------------------------- the archive of a table of pages


def with_revisits(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """(page_id, url, html, payload_bytes, payload_digest, refers_to) of (page_id, url, html).

    Of equal payloads of at least ``least_bytes`` bytes, the row with the smallest page_id is the
    response and the others refer to it. A null html is an empty payload. Rows with the same page_id
    as the response, or without one, are responses as well.
    """
    rows = pages.select("page_id", "url", text_of("html").alias("html"))
    facts = rows.select(
        "page_id",
        F.octet_length("html").cast("long").alias("payload_bytes"),
        F.sha2(F.col("html").cast("binary"), 256).alias("payload_digest"),
    )
    shared = facts.filter((F.col("payload_bytes") >= least_bytes) & F.col("page_id").isNotNull())
    groups = shared.groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    groups = materialize(groups.filter("n > 1"), "warc-groups")
    total = groups.agg(F.sum("n")).first()[0] or 0
    # at most a thousand groups hold over a thousandth of the repeated rows each
    hot = groups.filter(F.col("n") * 1000 > total).select("payload_digest", F.col("first").alias("hot"))
    cold = groups.filter(F.col("n") * 1000 <= total).select("payload_digest", F.col("first").alias("cold"))
    some = shared.select("page_id", "payload_digest").join(F.broadcast(hot), "payload_digest", "left")
    often = some.filter("hot IS NOT NULL").select("page_id", "payload_digest", F.col("hot").alias("first"))
    rare = some.filter("hot IS NULL").join(cold, "payload_digest").select("page_id", "payload_digest", F.col("cold").alias("first"))
    revisits = often.union(rare).filter("page_id <> first").distinct().withColumnRenamed("page_id", "_page")
    digest = F.sha2(F.col("html").cast("binary"), 256)
    both = rows.withColumn("payload_digest", digest).join(
        revisits.withColumnRenamed("payload_digest", "_digest"),
        (F.col("page_id") == F.col("_page")) & (F.col("payload_digest") == F.col("_digest")),
        "left",
    )
    return both.select(
        "page_id",
        "url",
        "html",
        F.octet_length("html").cast("long").alias("payload_bytes"),
        "payload_digest",
        F.col("first").alias("refers_to"),
    )


def archive(pages: DataFrame, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Write a record per page below ``path`` and read the archives back.

    One row per page: page_id, ``url``, ``payload_bytes``, ``payload_digest``, ``record_type``,
    ``refers_to``, ``path`` and ``offset`` of the record, and the ``payload``, null for revisits.
    Digest and size are of the full payload; those of a response are taken from what was read.
    """
    write_warc(with_revisits(pages), path)
    rows = read_warc(pages.sparkSession, path, range_bytes)
    revisit = F.col("fields")["warc-type"] == "revisit"
    kind = pages.schema["page_id"].dataType.simpleString()
    return rows.select(
        F.col("fields")["x-page-id"].cast(kind).alias("page_id"),
        F.col("fields")["warc-target-uri"].alias("url"),
        F.when(revisit, F.col("fields")["x-payload-length"].cast("long"))
        .otherwise(F.octet_length("block").cast("long"))
        .alias("payload_bytes"),
        F.when(revisit, F.substring_index(F.col("fields")["warc-payload-digest"], ":", -1))
        .otherwise(F.sha2("block", 256))
        .alias("payload_digest"),
        F.col("fields")["warc-type"].alias("record_type"),
        F.col("fields")["x-refers-to-page"].cast(kind).alias("refers_to"),
        "path",
        "offset",
        F.when(~revisit, F.col("block")).alias("payload"),
    )


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = archive(read_table(spark, sf_dir, "pages"), f"{scratch_path(spark, 'warc')}/archive")
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


QUERIES = {"op4_warc": op4_warc}

ORACLE = {
    "op4_warc": """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND first <> page_id THEN first END AS refers_to
FROM f
"""
}
