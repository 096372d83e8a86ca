"""Removal of repeated passages by fixed-block anchors.

A window of W words that occurs in two documents covers one of the blocks of B = W // 2 words
that tile the earlier document. So the index holds the non-overlapping blocks of all documents,
and every rolling run of B words of every document probes it. Only the windows around a hit can be
repeated. They are extended word by word: each window over a hit is looked up by its own hash, and
those that also start in a document with a smaller id make up the maximal repeats, which are cut.

Hashes travel as packed arrays, dealt by their leading bits. In a slice of a batch, runs that
several documents share are hits at once and one of them stands for all, so that a passage that
a third of the table shares reaches its partition once per slice.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import (
    mix64, read_table, rolling_hashes, shuffle_partitions, text_of, utf8, word_bounds, word_hashes,
)
from tidemill.storage import materialize

WINDOW = 50
#: Text of a slice; its documents are numbered with 15 bits.
SLICE_BYTES = 8_000_000
SLICE_DOCS = 30_000

ENTRIES, DOCUMENTS, FOUND = 0, 1, 2
PACKED = "part long, kind int, slice long, docs binary, hashes binary"
HITS = "id long, hashes binary"


def words_of(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts and ends of the words of a text."""
    array = np.frombuffer(data, np.uint8)
    starts, ends = word_bounds(array)
    return word_hashes(array, starts, ends), starts, ends


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split() for c in schema.split(", ")]
    types = [{"long": pa.int64(), "binary": pa.binary(), "int": pa.int32(), "string": pa.string()}[k] for _, k in names]
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], [n for n, _ in names])


def _runs(*columns: np.ndarray) -> np.ndarray:
    n = len(columns[0])
    if not n:
        return np.zeros(0, np.int64)
    new = np.ones(n, bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(new)


def _by_document(number: np.ndarray, hashes: np.ndarray, ids: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(id, hashes) for each document that occurs."""
    order = np.argsort(number, kind="stable")
    number, hashes = number[order], hashes[order]
    starts = _runs(number)
    return [(int(ids[n]), h) for n, h in zip(number[starts], np.split(hashes, starts[1:]))]


def _slices(batches, read):
    """Slices of documents [(id, item)], sorted by id; rows without id are left out."""
    rows, size = [], 0
    for batch in batches:
        for values in zip(*(c.to_pylist() for c in batch.columns)):
            item, length = read(values)
            if item is not None:
                rows.append((values[0], item))
                size += length
            if size > SLICE_BYTES or len(rows) >= SLICE_DOCS:
                yield sorted(rows, key=lambda r: r[0])
                rows, size = [], 0
    if rows:
        yield sorted(rows, key=lambda r: r[0])


def _deal(part_bits: int, slice_id: int, ids: np.ndarray, hashes: np.ndarray, tagged: np.ndarray, whole: bool):
    """Rows for the entries of a slice, sorted by hash: one per leading bits. Whole hashes, or 32 bits more."""
    parts = (hashes >> np.uint64(64 - part_bits)).astype(np.int64)
    starts = _runs(parts)
    low = hashes if whole else (hashes >> np.uint64(32 - part_bits)).astype(np.uint32)
    for begin, end in zip(starts, np.append(starts[1:], len(parts))):
        kept = ids[tagged[begin:end] >> 1] if whole else tagged[begin:end].astype(np.uint16)
        yield int(parts[begin]), ENTRIES, slice_id, kept.tobytes(), low[begin:end].tobytes()


def _slice_id(number: int) -> int:
    return (TaskContext.get().partitionId() << 24) + number


def send_anchors(block: int, window: int, part_bits: int):
    """From (id, text): the rolling runs of ``block`` words, each marked if it is a block itself.

    Rows: entries by leading bits, the ids of a slice's documents, and the hits inside a slice.
    """

    def read(values):
        key, text = values
        if key is None:
            return None, 0
        data = utf8(text)
        hashes, _, _ = words_of(data)
        return (rolling_hashes(hashes, block) if len(hashes) >= window else None), len(data)

    def run(batches):
        for number, rows in enumerate(_slices(batches, read)):
            slice_id = _slice_id(number)
            ids = np.unique(np.array([key for key, _ in rows], np.int64))
            at = np.searchsorted(ids, [key for key, _ in rows])
            own = np.concatenate([np.full(len(h), n, np.int64) for n, (_, h) in zip(at, rows)])
            marked = np.concatenate([np.arange(len(h)) % block == 0 for _, h in rows])
            hashes = np.concatenate([h for _, h in rows])
            order = np.lexsort((own, hashes))
            hashes, own, marked = hashes[order], own[order], marked[order]
            # one entry of each run of words in a document, marked if any of its places is a block
            starts = _runs(hashes, own)
            hashes, own = hashes[starts], own[starts]
            marked = np.logical_or.reduceat(marked, starts)
            starts = _runs(hashes)
            lengths = np.diff(np.append(starts, len(hashes)))
            several = np.repeat(lengths > 1, lengths)
            found = _by_document(own[several], hashes[several] >> np.uint64(32 - part_bits), ids)
            yield _batch(PACKED, [(mix(i), FOUND, i, b"", h.tobytes()) for i, h in found])
            tagged = own[starts] << 1 | np.logical_or.reduceat(marked, starts)
            out = [(mix(slice_id), DOCUMENTS, slice_id, ids.tobytes(), b"")]
            out += _deal(part_bits, slice_id, ids, hashes[starts], tagged, False)
            yield _batch(PACKED, out)

    def mix(number: int) -> int:
        return int(mix64(np.array([number], np.int64).view(np.uint64))[0] >> np.uint64(64 - part_bits))

    return run


def _parts(batches, pick):
    """Rows of one part after the other: (part, the rows of entries); others go to ``pick``."""
    part, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[1] != ENTRIES:
                pick(row)
                continue
            if row[0] != part and rows:
                yield part, rows
                rows = []
            part = row[0]
            rows.append(row)
    if rows:
        yield part, rows


def match_anchors(part_bits: int):
    """Entries of a part: those whose run of words is a block of one document and occurs in another slice."""

    def run(batches):
        passed: list[tuple] = []
        for part, rows in _parts(batches, passed.append):
            slices = np.array([r[2] for r in rows], np.int64)
            tagged = np.concatenate([np.frombuffer(r[3], np.uint16) for r in rows])
            low = np.concatenate([np.frombuffer(r[4], np.uint32) for r in rows])
            place = np.repeat(np.arange(len(rows)), [len(r[4]) // 4 for r in rows])
            order = np.argsort(low, kind="stable")
            low, tagged, place = low[order], tagged[order], place[order]
            starts = _runs(low)
            lengths = np.diff(np.append(starts, len(low)))
            hit = np.repeat((lengths > 1) & (np.add.reduceat(tagged & 1, starts, dtype=np.int64) > 0), lengths)
            hashes = np.uint64(part << 32) + low[hit].astype(np.uint64)
            for at, own in zip(*_grouped(place[hit], np.stack([hashes, (tagged[hit] >> 1).astype(np.uint64)]))):
                passed.append((0, ENTRIES, int(slices[at]), own[1].astype(np.uint16).tobytes(), own[0].tobytes()))
            yield _batch(PACKED, passed)
            passed.clear()
        yield _batch(PACKED, passed)

    return run


def _grouped(key: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    order = np.argsort(key, kind="stable")
    key, values = key[order], values[:, order]
    starts = _runs(key)
    return key[starts], np.split(values, starts[1:], axis=1) if len(starts) else []


def name_documents(batches):
    """From rows sorted by slice, the ids of its documents first: (id, hashes) of every hit."""
    slice_id, ids = None, None
    for batch in batches:
        out = []
        for _, kind, at, docs, hashes in zip(*(c.to_pylist() for c in batch.columns)):
            if kind == FOUND:
                out.append((at, hashes))
            elif kind == DOCUMENTS:
                slice_id, ids = at, np.frombuffer(docs, np.int64)
            else:
                if at != slice_id:
                    raise ValueError("a slice's documents are missing")
                numbers = np.frombuffer(docs, np.uint16)
                out += [(i, h.tobytes()) for i, h in _by_document(numbers, np.frombuffer(hashes, np.uint64), ids)]
        yield _batch(HITS, out)


DOCUMENT = "id long, kind int, data binary"
TEXT, HASHES = 1, 0
MARKED = "id long, n_words long, n_removed long, kept_sha256 string, text binary, starts binary"


def _documents(batches):
    """Documents of rows sorted by id and kind: (id, the hashes sent to it, its texts); texts one by one."""
    key, hashes, begun = None, [], False
    for batch in batches:
        for at, kind, data in zip(*(c.to_pylist() for c in batch.columns)):
            if at != key or not begun:
                key, hashes, begun = at, [], True
            if kind == HASHES:
                hashes.append(np.frombuffer(data, np.uint64))
            else:
                yield at, np.unique(np.concatenate(hashes)) if hashes and at is not None else None, data


def _kept(data: bytes, hit: np.ndarray | None, window: int) -> tuple[int, int, str]:
    """Words, words removed and hash of the words that stay, given the starts of repeated windows."""
    words = data.split()
    if hit is None or not len(hit):
        return len(words), 0, hashlib.sha256(b" ".join(words)).hexdigest()
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + window, -1)
    covered = np.cumsum(edge)[:-1] > 0
    left = [w for w, c in zip(words, covered.tolist()) if not c]
    return len(words), len(words) - len(left), hashlib.sha256(b" ".join(left)).hexdigest()


def mark_windows(block: int, window: int, part_bits: int):
    """From a document's hits and text: the starts of windows over a hit, or the result if there is none."""

    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        rows, size = [], 0
        for key, hits, packed in _documents(batches):
            data = unpack.decompress(packed)
            starts = None
            if hits is not None:
                hashes, _, _ = words_of(data)
                runs = rolling_hashes(hashes, block) >> np.uint64(32 - part_bits)
                at = np.flatnonzero(np.isin(runs, hits))
                if len(hashes) >= window and len(at):
                    # a window covers the hit at p if it starts in p - (window - block) .. p
                    edge = np.zeros(len(hashes) + window, np.int64)
                    np.add.at(edge, np.maximum(at - (window - block), 0), 1)
                    np.add.at(edge, at + 1, -1)
                    starts = np.flatnonzero(np.cumsum(edge)[: len(hashes) - window + 1] > 0).astype(np.int32)
            if starts is None or not len(starts):
                rows.append((key, *_kept(data, None, window), None, None))
            else:
                rows.append((key, None, None, None, packed, starts.tobytes()))
                size += len(packed) + starts.nbytes
            if len(rows) >= 5000 or size > SLICE_BYTES:
                yield _batch(MARKED, rows)
                rows, size = [], 0
        yield _batch(MARKED, rows)

    return run


def send_windows(window: int, part_bits: int):
    """From (id, text, starts): the marked windows; those that an earlier document of the slice has are found."""
    unpack = zstandard.ZstdDecompressor

    def read(values):
        key, packed, starts = values
        data = unpack().decompress(packed)
        return np.unique(rolling_hashes(words_of(data)[0], window)[np.frombuffer(starts, np.int32)]), len(data)

    def run(batches):
        for number, rows in enumerate(_slices(batches, read)):
            ids = np.unique(np.array([key for key, _ in rows], np.int64))
            at = np.searchsorted(ids, [key for key, _ in rows])
            own = np.concatenate([np.full(len(h), n, np.int64) for n, (_, h) in zip(at, rows)])
            hashes = np.concatenate([h for _, h in rows])
            order = np.lexsort((own, hashes))
            hashes, own = hashes[order], own[order]
            starts = _runs(hashes)
            first = np.repeat(own[starts], np.diff(np.append(starts, len(hashes))))
            later = own != first
            found = _by_document(own[later], hashes[later], ids)
            yield _batch(PACKED, [(int(i) & ((1 << part_bits) - 1), FOUND, i, b"", h.tobytes()) for i, h in found])
            yield _batch(PACKED, list(_deal(part_bits, _slice_id(number), ids, hashes[starts], own[starts] << 1, True)))

    return run


def match_windows(batches):
    """Entries of a part: (id, hashes) of the windows that a document with a smaller id has."""
    passed: list[tuple] = []
    for _, rows in _parts(batches, lambda r: passed.append((r[2], r[4]))):
        ids = np.concatenate([np.frombuffer(r[3], np.int64) for r in rows])
        hashes = np.concatenate([np.frombuffer(r[4], np.uint64) for r in rows])
        order = np.lexsort((ids, hashes))
        hashes, ids = hashes[order], ids[order]
        starts = _runs(hashes)
        first = np.repeat(ids[starts], np.diff(np.append(starts, len(hashes))))
        later = ids != first
        names, numbers = np.unique(ids[later], return_inverse=True)
        passed += [(i, h.tobytes()) for i, h in _by_document(numbers, hashes[later], names)]
        yield _batch(HITS, passed)
        passed.clear()
    yield _batch(HITS, passed)


def cut_windows(window: int):
    """From a document's repeated windows and text: its result."""

    def run(batches):
        unpack, rows = zstandard.ZstdDecompressor(), []
        for key, repeated, packed in _documents(batches):
            data, hit = unpack.decompress(packed), None
            if repeated is not None:
                hit = np.flatnonzero(np.isin(rolling_hashes(words_of(data)[0], window), repeated))
            rows.append((key, *_kept(data, hit, window)))
            if len(rows) >= 5000:
                yield _batch(RESULT, rows)
                rows = []
        yield _batch(RESULT, rows)

    return run


RESULT = "id long, n_words long, n_removed long, kept_sha256 string"


def pack_texts(batches):
    packer = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        rows, size = [], 0
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            rows.append((key, TEXT, packer.compress(utf8(text))))
            size += len(rows[-1][2])
            if size > SLICE_BYTES:
                yield _batch(DOCUMENT, rows)
                rows, size = [], 0
        yield _batch(DOCUMENT, rows)


def _together(texts: DataFrame, hits: DataFrame) -> DataFrame:
    """Texts and hashes of each document side by side, hashes first. Rows without id are spread out."""
    rows = hits.select("id", F.lit(HASHES).alias("kind"), F.col("hashes").alias("data")).union(texts)
    spread = F.coalesce(F.xxhash64("id"), F.xxhash64("data"))
    spread = F.when(F.col("id").isNull(), F.xxhash64("data")).otherwise(F.xxhash64("id"))
    return rows.repartition(spread).sortWithinPartitions("id", "kind")


def substring_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW
) -> DataFrame:
    """One row per input row: id, ``n_words``, ``n_removed``, ``kept_sha256`` of the words that stay.

    Words are runs without ASCII white space; a null text has none. A word goes if it is in a window
    of ``window`` words whose sequence also starts in a document with a smaller id, in the input as it
    is. Rows that share an id are one document in this: they do not cut each other. A row without id
    is neither smaller nor larger than any, so it stays whole and cuts nothing. Windows are compared
    by 64-bit hashes. Other columns are ignored.
    """
    spark = docs.sparkSession
    block = window // 2
    # enough parts for every task; with few leading bits the 32 that follow tell anchors apart
    part_bits = max(7, min(20, math.ceil(math.log2(2 * shuffle_partitions(spark)))))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    anchors = rows.mapInArrow(send_anchors(block, window, part_bits), PACKED)
    anchors = anchors.repartition("part").sortWithinPartitions("part", "kind")
    matched = anchors.mapInArrow(match_anchors(part_bits), PACKED)
    matched = matched.repartition("slice").sortWithinPartitions("slice", F.col("kind").desc())
    hits = matched.mapInArrow(name_documents, HITS)
    texts = rows.mapInArrow(pack_texts, DOCUMENT)
    marked = _together(texts, hits).mapInArrow(mark_windows(block, window, part_bits), MARKED)
    marked = materialize(marked, "substring-marked")
    open_rows = marked.filter("text IS NOT NULL")
    windows = open_rows.select("id", "text", "starts").mapInArrow(send_windows(window, part_bits), PACKED)
    windows = windows.repartition("part").sortWithinPartitions("part", "kind")
    repeated = windows.mapInArrow(match_windows, HITS)
    kept_texts = open_rows.select("id", F.lit(TEXT).alias("kind"), F.col("text").alias("data"))
    cut = _together(kept_texts, repeated).mapInArrow(cut_windows(window), RESULT)
    whole = marked.filter("text IS NULL").select("id", "n_words", "n_removed", "kept_sha256")
    return whole.union(cut).withColumnRenamed("id", id_col)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(read_table(spark, sf_dir, "documents"))


QUERIES = {"op2_substring_dedup": op2_substring_dedup}

ORACLE = {
    "op2_substring_dedup": r"""
WITH w AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS words
  FROM documents
), starts AS (
  SELECT doc_id, unnest(range(1, len(words) - 48)) AS i FROM w WHERE len(words) >= 50
), windows AS MATERIALIZED (
  SELECT doc_id, i, sha256(array_to_string(words[i : i + 49], ' ')) AS h FROM starts JOIN w USING (doc_id)
), smallest AS (
  SELECT h, min(doc_id) AS first FROM windows GROUP BY h
), hit AS (
  SELECT doc_id, i FROM windows JOIN smallest USING (h) WHERE first < doc_id
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS k FROM hit
), each AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS k FROM w
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY k) AS text, count(*) AS n
  FROM each ANTI JOIN gone USING (doc_id, k) GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""
}
