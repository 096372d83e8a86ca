"""Benchmark passages in documents, found by one Aho-Corasick automaton over normalised test items.

The automaton's letters are words: every word of a test item has a number, every window of ten consecutive
words of an item is a pattern, an item of fewer words is one pattern as a whole. A document is normalised in
the same way and scanned once; each pattern's end marks its words, and the marked words are led back to the
places of the original text.
"""

from __future__ import annotations

import math
import uuid

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import read_table, text_of, utf8, worker_state
from tidemill.storage import byte_size, materialize

WINDOW = 10
#: Bytes of item texts in one automaton: some 200,000 patterns. A larger benchmark is dealt to several automata.
AUTOMATON_BYTES = 1 << 20
BATCH_ROWS = 2000

#: Letters A-Z as lower case, every other character up to 0x7F that is no letter or digit as a space.
NORMAL = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)

#: A stretch of hit words: its first and last word's numbers, and its code points [start, end) in the original text.
STRETCHES = "array<struct<first:long,last:long,start:long,end:long>>"
ARROW_STRETCHES = pa.list_(pa.struct([(name, pa.int64()) for name in ("first", "last", "start", "end")]))


def normal_words(text: bytes) -> list[bytes]:
    return text.translate(NORMAL).split()


def build_automaton(items: list[tuple], window: int) -> tuple[dict, ahocorasick.Automaton | None]:
    """Numbers of the items' words, and the automaton of their windows; a value is (length, names of its items)."""
    number: dict[bytes, int] = {}
    patterns: dict[tuple, set] = {}
    for name, text in items:
        words = [number.setdefault(w, len(number) + 1) for w in normal_words(utf8(text))]
        size = min(window, len(words))
        for i in range(len(words) - size + 1 if words else 0):
            patterns.setdefault(tuple(words[i : i + size]), set()).add(name)
    if not patterns:
        return number, None
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for pattern, names in patterns.items():
        automaton.add_word(pattern, (len(pattern), tuple(sorted(n for n in names if n is not None))))
    automaton.make_automaton()
    return number, automaton


def scan(words: list[bytes], number: dict[bytes, int], automaton) -> tuple[np.ndarray, list[str]] | None:
    """Which words are in an occurrence of a pattern, and the names of those items; None if there is none."""
    get = number.get
    edges, values = None, set()
    for end, value in automaton.iter(tuple([get(w, 0) for w in words])):
        if edges is None:
            edges = np.zeros(len(words) + 1, np.int64)
        edges[end + 1 - value[0]] += 1
        edges[end + 1] -= 1
        values.add(value)
    if edges is None:
        return None
    return np.cumsum(edges[:-1]) > 0, sorted(set().union(*(names for _, names in values)))


def stretches(text: bytes, hit: np.ndarray) -> list[dict]:
    """The stretches of hit words with their places in the original text."""
    inside = np.concatenate(([0], (np.frombuffer(text.translate(NORMAL), np.uint8) != 32).view(np.int8), [0]))
    starts, ends = np.flatnonzero(np.diff(inside) == 1), np.flatnonzero(np.diff(inside) == -1)
    chars = np.concatenate(([0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)))
    turns = np.diff(np.concatenate(([0], hit.view(np.int8), [0])))
    first, last = np.flatnonzero(turns == 1), np.flatnonzero(turns == -1) - 1
    columns = (first, last, chars[starts[first]], chars[ends[last]])
    return [dict(zip(("first", "last", "start", "end"), x)) for x in zip(*(c.tolist() for c in columns))]


def union_stretches(found: list[dict]) -> list[dict]:
    """Stretches of several scans as one list: those that overlap or touch become one."""
    out: list[dict] = []
    for one in sorted(found, key=lambda s: (s["first"], s["last"])):
        if out and one["first"] <= out[-1]["last"] + 1:
            if one["last"] > out[-1]["last"]:
                out[-1] |= {"last": one["last"], "end": one["end"]}
        else:
            out.append(dict(one))
    return out


def _scanner(sent, window: int, only_hits: bool):
    """Rows (key, n_words, stretches, items), for every text or only for those with a hit."""
    token = uuid.uuid4().hex

    def run(batches):
        held = worker_state("decontamination", dict)
        if token not in held:  # a worker holds one automaton at a time
            held.clear()
            held[token] = build_automaton(sent.value, window)
        number, automaton = held[token]
        for whole in batches:
            for low in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(low, BATCH_ROWS)
                places, n_words, spans, items = [], [], [], []
                for i, text in enumerate(batch.column(1).cast(pa.binary()).to_pylist()):
                    words = normal_words(text)
                    found = scan(words, number, automaton) if automaton is not None and words else None
                    if found is None and only_hits:
                        continue
                    places.append(i)
                    n_words.append(len(words))
                    spans.append(stretches(text, found[0]) if found else [])
                    items.append(found[1] if found else [])
                columns = [batch.column(0).take(pa.array(places, pa.int64())), pa.array(n_words, pa.int64())]
                columns += [pa.array(spans, ARROW_STRETCHES), pa.array(items, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(columns, ["id", "n_words", "spans", "items"])

    return run


def _union_rows(batches):
    for batch in batches:
        at = batch.schema.get_field_index("spans")
        joined = [union_stretches(own) for own in batch.column(at).to_pylist()]
        yield batch.set_column(at, "spans", pa.array(joined, ARROW_STRETCHES))


def _scan_parts(rows: DataFrame, items: DataFrame, parts: int, window: int) -> DataFrame:
    """A scan for each part of the items; what they find is put together by row number, without the texts."""
    spark = rows.sparkSession
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "contamination-rows")
    dealt = F.pmod(F.xxhash64("name", "text"), F.lit(parts))
    found = None
    for part in range(parts):
        sent = spark.sparkContext.broadcast([tuple(r) for r in items.filter(dealt == part).collect()])
        run = _scanner(sent, window, only_hits=part > 0)
        schema = f"row long, n_words long, spans {STRETCHES}, items array<string>"
        one = materialize(rows.select("row", "text").mapInArrow(run, schema), "contamination-part")
        sent.unpersist()
        found = one if found is None else found.union(one)
    one_row = found.groupBy("row").agg(
        F.max("n_words").alias("n_words"),
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    one_row = one_row.mapInArrow(_union_rows, one_row.schema)
    return rows.select("row", "id").join(one_row, "row").select("id", "n_words", "spans", "items")


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """One row per input row: id, ``n_words``, ``n_hit``, ``spans`` of hit words and ``items``.

    Words are runs of ASCII letters and digits and of all characters beyond ASCII, with A-Z in lower case. A
    document's word is hit if it is in an occurrence of ``window`` consecutive words of an item, or of all words
    of a shorter item. A span has the numbers of its first and last word and its code points [start, end) in the
    original text; items are the ids, as sorted strings, of the items with an occurrence. Null and empty texts
    have no words, and an item without words is never found. Items that share an id count once; what an item
    without id hits is hit, but not listed. Null and repeated document ids are kept; other columns are ignored.

    Item texts of up to ``AUTOMATON_BYTES`` are one automaton, whose items are broadcast to a single scan without
    a shuffle. A larger benchmark is dealt to several automata of that size, one scan of the documents for each.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_col).cast("string").alias("name"), text_of(item_text_col).alias("text"))
    items = materialize(items.filter("text <> ''").distinct(), "benchmark-items")
    parts = math.ceil(items.agg(byte_size(items)).first()[0] / AUTOMATON_BYTES)
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    if parts <= 1:
        sent = spark.sparkContext.broadcast([tuple(r) for r in items.collect()])
        kind = rows.schema["id"].dataType.simpleString()
        schema = f"id {kind}, n_words long, spans {STRETCHES}, items array<string>"
        found = rows.mapInArrow(_scanner(sent, window, only_hits=False), schema)
    else:
        found = _scan_parts(rows, items, parts, window)
    n_hit = F.reduce("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)
    return found.select(F.col("id").alias(id_col), "n_words", n_hit.alias("n_hit"), "spans", "items")


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


QUERIES = {"op13_decontamination": op13_decontamination}

_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

ORACLE = {
    "op13_decontamination": f"""
WITH d AS (
  SELECT doc_id, {_WORDS} AS w FROM documents
), i AS (
  SELECT item_id, w, least(10, len(w)) AS m FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0
), item_starts AS (
  SELECT item_id, w, m, unnest(range(1, len(w) - m + 2)) AS k FROM i
), patterns AS (
  SELECT DISTINCT m, item_id, array_to_string(w[k : k + m - 1], ' ') AS s FROM item_starts
), starts AS (
  SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS k
  FROM d CROSS JOIN (SELECT DISTINCT m FROM patterns) WHERE len(w) >= m
), grams AS (
  SELECT doc_id, m, k, array_to_string(w[k : k + m - 1], ' ') AS s FROM starts
), found AS (
  SELECT doc_id, m, k, item_id FROM grams JOIN patterns USING (m, s)
), hit AS (
  SELECT doc_id, count(DISTINCT place) AS n
  FROM (SELECT doc_id, unnest(range(k, k + m)) AS place FROM (SELECT DISTINCT doc_id, k, m FROM found)) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""
}
