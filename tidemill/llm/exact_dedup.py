"""Exact deduplication: radix tries of whole texts, one set of tries per length-and-hash partition.

Texts are compared without ASCII white space. Each scan task sends a text once and adds up its
further copies, so that a text that fills a third of the table reaches its trie as one row per
task. The trie's terminal nodes hold the owner, the row with the most characters and then the
smallest identifier. When the tries of a task pass their memory budget, the largest subtree is
spilled and built later by itself.
"""

from __future__ import annotations

import hashlib
import os
import pickle
import tempfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import SPACES, read_table, release_model, text_of
from tidemill.storage import materialize

#: Bytes of tries in a task before subtrees are spilled, and what a node counts besides its label.
TRIE_BYTES = 96 << 20
NODE_BYTES = 300
#: Distinct texts a scan task remembers for adding up copies. A forgotten text is sent again.
REMEMBERED = 200_000


class Node:
    """An edge label with what hangs below it. ``entry`` is set where a text ends."""

    __slots__ = ("label", "children", "entry")

    def __init__(self, label: bytes, entry: list | None = None):
        self.label, self.children, self.entry = label, {}, entry


def shared_length(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def merge(entry: list, owner: tuple, copies: int) -> None:
    """``entry`` is [content hash, owner, copies]; the smallest owner stays."""
    if owner < entry[1]:
        entry[1] = owner
    entry[2] += copies


def insert(root: Node, text: bytes, content: bytes, owner: tuple, copies: int, at: int = 0) -> int:
    """Put ``text[at:]`` below ``root``; returns the bytes of memory that it took."""
    node = root
    while at < len(text):
        child = node.children.get(text[at])
        if child is None:
            node.children[text[at]] = Node(text[at:], [content, owner, copies])
            return len(text) - at + NODE_BYTES
        label = child.label
        if text.startswith(label, at):
            node, at = child, at + len(label)
            continue
        k = shared_length(label, text[at : at + len(label)])
        fork = Node(label[:k])
        child.label = label[k:]
        fork.children[child.label[0]] = child
        node.children[text[at]] = fork
        node, at = fork, at + k
    if node.entry is None:
        node.entry = [content, owner, copies]
        return NODE_BYTES
    merge(node.entry, owner, copies)
    return 0


def entries(node: Node) -> Iterator[list]:
    waiting = [node]
    while waiting:
        node = waiting.pop()
        if node.entry is not None:
            yield node.entry
        waiting.extend(node.children.values())


def texts_below(node: Node, prefix: bytes) -> Iterator[tuple]:
    waiting = [(node, prefix)]
    while waiting:
        node, path = waiting.pop()
        path += node.label
        if node.entry is not None:
            yield path, *node.entry
        waiting.extend((child, path) for child in node.children.values())


def owners(items: Iterable[tuple], folder: str, budget: int, depth: int = 0) -> Iterator[list]:
    """[content hash, owner, copies] of every distinct text of (text, content hash, owner, copies).

    All texts share their first ``depth`` bytes. Subtrees are told apart by the byte after them.
    """
    branches: dict[int, Node] = {}
    sizes: dict[int, int] = {}
    spilled: dict[int, list] = {}  # byte: [file, length of the common prefix, a text]

    def put(key: int, item: tuple) -> None:
        held = spilled[key]
        held[1] = shared_length(held[2][: held[1]], item[0])
        pickle.dump(item, held[0], protocol=5)

    for item in items:
        text = item[0]
        key = text[depth] if len(text) > depth else -1
        if key in spilled:
            put(key, item)
            continue
        root = branches.setdefault(key, Node(b""))
        sizes[key] = sizes.get(key, 0) + insert(root, *item, at=min(depth, len(text)))
        while sum(sizes.values()) > budget and max(sizes) >= 0:
            largest = max((k for k in sizes if k >= 0), key=sizes.get)
            handle, _ = tempfile.mkstemp(dir=folder)
            first = None
            for below in texts_below(branches.pop(largest), text[:0] if not depth else text[:depth]):
                if first is None:
                    first = below
                    spilled[largest] = [os.fdopen(handle, "w+b"), len(below[0]), below[0]]
                put(largest, below)
            del sizes[largest]
    for root in branches.values():
        yield from entries(root)
    branches.clear()
    for file, common, _ in spilled.values():
        file.seek(0)
        yield from owners(_read(file), folder, budget, max(depth + 1, common))
        file.close()


def _read(file) -> Iterator[tuple]:
    while True:
        try:
            yield pickle.load(file)
        except EOFError:
            return


def _normal(text: str) -> tuple[bytes, bytes]:
    data = text.encode("utf-8", "surrogatepass").translate(None, SPACES)
    return data, hashlib.sha256(data).digest()


def _owner(chars: int, key, row: int) -> tuple:
    """Order of owners: most characters, then the smallest identifier, null last."""
    return (-chars, key is None, key or 0, row)


DIGEST = "id long, row long, chars long, content binary"
SENT = "length long, content binary, text binary, chars long, id long, row long, copies long"
GROUP = "content binary, keep_chars long, keep_id long, keep_row long, group_size long"


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split() for c in schema.split(", ")]
    types = [{"long": pa.int64(), "binary": pa.binary()}[kind] for _, kind in names]
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], [n for n, _ in names])


def digests(batches):
    release_model()
    for batch in batches:
        rows = []
        for key, row, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
            rows.append((key, row, len(text), _normal(text)[1]))
        yield _batch(DIGEST, rows)


def senders(batches):
    """Every distinct text of a task once, and later one row without text for its further copies."""
    release_model()
    seen: dict[bytes, list] = {}

    def further() -> list[tuple]:
        out = []
        for content, (length, best, copies) in seen.items():
            if copies:
                chars, missing, key, row = best
                out.append((length, content, None, -chars, None if missing else key, row, copies))
        seen.clear()
        return out

    for batch in batches:
        rows, size = [], 0
        for key, row, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
            data, content = _normal(text)
            owner = _owner(len(text), key, row)
            held = seen.get(content)
            if held is None:
                seen[content] = [len(data), owner, 0]
                rows.append((len(data), content, data, len(text), key, row, 1))
                size += len(data)
            else:
                held[1] = min(held[1], owner)
                held[2] += 1
            if len(seen) >= REMEMBERED:
                rows += further()
            if size > 8 << 20:
                yield _batch(SENT, rows)
                rows, size = [], 0
        yield _batch(SENT, rows)
    yield _batch(SENT, further())


def build_tries(budget: int):
    def run(batches):
        release_model()
        more: dict[bytes, list] = {}

        def items():
            for batch in batches:
                for _, content, text, chars, key, row, copies in zip(*(c.to_pylist() for c in batch.columns)):
                    owner = _owner(chars, key, row)
                    if text is not None:
                        yield text, content, owner, copies
                    elif content in more:
                        merge(more[content], owner, copies)
                    else:
                        more[content] = [content, owner, copies]

        with tempfile.TemporaryDirectory() as folder:  # a task's spill, gone with the task
            rows = []
            for entry in owners(items(), folder, budget):
                if entry[0] in more:
                    merge(entry, *more[entry[0]][1:])
                content, (chars, missing, key, row), copies = entry
                rows.append((content, -chars, None if missing else key, row, copies))
                if len(rows) >= 50_000:
                    yield _batch(GROUP, rows)
                    rows = []
            yield _batch(GROUP, rows)

    return run


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    row_col: str | None = None,
    trie_bytes: int = TRIE_BYTES,
) -> DataFrame:
    """One row per input row: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when they are the same bytes without ASCII white space; null is empty and
    all empty texts are one group. The row with the most code points stays, then the smallest
    id (null last), then the smallest ``row_col`` if given. Without ``row_col``, of rows that
    agree in id, text and length one is kept. Other columns are ignored. ``row_col`` is
    returned if given. No rows in, no rows out.
    """
    spark = docs.sparkSession
    row = F.col(row_col).cast("long") if row_col else F.lit(0).cast("long")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), row.alias("row"), text_of(text_col).alias("text"))
    sent = rows.mapInArrow(senders, SENT).repartition("length", "content")
    groups = materialize(sent.mapInArrow(build_tries(trie_bytes), GROUP), "exact-groups")
    own = rows.mapInArrow(digests, DIGEST).groupBy("id", "row", "chars", "content").agg(F.count("*").alias("times"))
    # at most a thousand groups hold over a thousandth of the rows each: these may be broadcast
    total = groups.agg(F.sum("group_size")).first()[0] or 0
    hot = groups.filter(F.col("group_size") * 1000 > total)
    cold = groups.filter(F.col("group_size") * 1000 <= total)
    names = ["keep_chars", "keep_id", "keep_row", "group_size"]
    some = own.join(
        F.broadcast(hot.select(F.col("content").alias("hot"), *(F.col(c).alias(f"hot_{c}") for c in names))),
        F.col("content") == F.col("hot"),
        "left",
    )
    key = F.when(F.col("hot").isNull(), F.col("content")).otherwise(F.encode(F.xxhash64("id", "row").cast("string"), "utf-8"))
    full = some.withColumn("key", key).join(cold.withColumnRenamed("content", "key"), "key", "left")
    for c in names:
        full = full.withColumn(c, F.when(F.col("hot").isNull(), F.col(c)).otherwise(F.col(f"hot_{c}")))
    owner = (
        F.col("id").eqNullSafe(F.col("keep_id"))
        & (F.col("row") == F.col("keep_row"))
        & (F.col("chars") == F.col("keep_chars"))
    )
    copies = full.select("*", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("nth"))
    return copies.select(
        F.col("id").alias(id_col),
        *([F.col("row").alias(row_col)] if row_col else []),
        "keep_id",
        "group_size",
        (owner & (F.col("nth") == 1)).alias("kept"),
        F.lower(F.hex("content")).alias("text_sha256"),
    )


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read_table(spark, sf_dir, "documents"))


QUERIES = {"op7_exact_dedup": op7_exact_dedup}

ORACLE = {
    "op7_exact_dedup": r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY norm ORDER BY chars DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER (PARTITION BY norm ORDER BY chars DESC, doc_id) = 1 AS kept,
       sha256(norm) AS text_sha256
FROM t
"""
}
