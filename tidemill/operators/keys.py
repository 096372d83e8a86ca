"""Row order made explicit: source positions, dense surrogate keys, first rows, key lookups."""

from __future__ import annotations

from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.storage import BROADCAST_BYTES, broadcasts_on, byte_size, join_side, materialize

#: Two long columns and a row's overhead in a broadcast table.
_OFFSET_BYTES = 32


def _order(order_by) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order_by]


def _offsets(sizes: DataFrame, group: list[str]) -> tuple[DataFrame, list[tuple]]:
    """Rows before each group, and for each range of groups (part, groups, first and last group).

    Prefix sums on two levels: the groups are dealt to sorted ranges, each range is added up by itself, and only the
    totals of the ranges, one number for a shuffle partition, are added up on the driver.
    """
    n_ranges = int(sizes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = sizes.repartitionByRange(n_ranges, *group).withColumn("_part", F.spark_partition_id())
    ranged = materialize(ranged, "row-ranges")
    name = F.struct(*group)
    totals = ranged.groupBy("_part").agg(F.sum("_rows"), F.count(F.lit(1)), F.min(name), F.max(name)).collect()
    totals.sort(key=lambda r: r["_part"])
    starts = accumulate((r[1] for r in totals), initial=0)
    rows = [(r["_part"], start) for r, start in zip(totals, starts)]
    ahead = sizes.sparkSession.createDataFrame(rows, "_part int, _ahead long")
    inside = Window.partitionBy("_part").orderBy(*group).rowsBetween(Window.unboundedPreceding, -1)
    # one row for a range, of which there are as many as shuffle partitions
    before = F.coalesce(F.sum("_rows").over(inside), F.lit(0)) + F.col("_ahead")
    offsets = ranged.join(F.broadcast(ahead), "_part").withColumn("_before", before)
    return materialize(offsets, "row-offsets"), [(r["_part"], r[2], r[3], r[4]) for r in totals]


def _number(df: DataFrame, group: list[str], position: str, key: str) -> DataFrame:
    """Keys 1..n: groups in their order, and rows by their consecutive position in the group.

    Only one row per group (a file or a file split) is aggregated and joined back, on a hash of the group, which is
    checked to be unique. The rows are neither sorted nor shuffled: as many consecutive groups as make one bounded
    broadcast, over a million, are joined with their rows at a time. For files, each such step reads its own files only.
    """
    sizes = df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("_rows"), F.min(position).alias("_first"), F.max(position).alias("_last")
    )
    offsets, ranges = _offsets(sizes, group)
    if not offsets.filter("_last - _first + 1 <> _rows").isEmpty():
        raise ValueError("row positions have gaps: number the rows before filtering them")
    shift = (F.col("_before") - F.col("_first") + 1).alias("_shift")
    shifts = offsets.select(F.xxhash64(*group).alias("_group"), shift, "_part")
    if not shifts.groupBy("_group").count().filter("count > 1").isEmpty():
        raise ValueError("two groups share a hash: read one of them under another name")
    kept = [c for c in df.columns if c not in group and c != position]
    hashed = df.withColumn("_group", F.xxhash64(*group))
    steps: list[list[tuple]] = [[]]
    for one in ranges:
        if steps[-1] and sum(r[1] for r in [*steps[-1], one]) * _OFFSET_BYTES > BROADCAST_BYTES:
            steps.append([])
        steps[-1].append(one)
    numbered = []
    for step in steps:
        rows, own = hashed, shifts
        if len(steps) > 1:
            low, high = step[0][2], step[-1][3]
            rows = rows.filter(F.col(group[0]).between(F.lit(low[0]), F.lit(high[0])))
            own = own.filter(F.col("_part").between(step[0][0], step[-1][0]))
        joined = rows.join(F.broadcast(own.drop("_part")), "_group")
        numbered.append(joined.select((F.col(position) + F.col("_shift")).alias(key), *kept))
    return reduce(DataFrame.union, numbered)


def read_with_row_id(spark: SparkSession, path: str, key: str = "row_id") -> DataFrame:
    """Parquet rows numbered 1..n in file order. The position in a file comes from the reader."""
    rows = spark.read.parquet(path).select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_index")
    )
    return _number(rows, ["_file"], "_index", key)


SOURCE_POSITION = ["src_file", "src_block", "src_seq"]


def with_source_position(df: DataFrame) -> DataFrame:
    """Add ``src_file, src_block, src_seq``, whose order is the order of rows in the files.

    For row formats such as CSV. Call it on the frame a file reader returned, before any filter.
    """
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("src_file"),
        F.col("_metadata.file_block_start").alias("src_block"),
        F.monotonically_increasing_id().alias("src_seq"),
    )


def number_by_position(df: DataFrame, key: str = "row_id") -> DataFrame:
    """Keys 1..n in file order, in place of the columns of :func:`with_source_position`.

    ``df`` must be a written table that holds those columns: another scan of the source could
    be split differently.
    """
    return _number(df, SOURCE_POSITION[:2], SOURCE_POSITION[2], key)


def dense_key(df: DataFrame, key: str, order_by) -> DataFrame:
    """Keys 1..n in the order of ``order_by``, equal to ``row_number()`` over the whole frame.

    A window without PARTITION BY would run in one task. Instead the rows are range sorted,
    written once with the sort partition and the position in it, and each partition's offset
    (one row per partition) is joined back. Rows that tie on ``order_by`` are numbered in any
    order, so it should identify a row.
    """
    stored = materialize(
        df.orderBy(*_order(order_by)).select(
            "*",
            F.spark_partition_id().alias("_part"),
            F.monotonically_increasing_id().alias("_seq"),
        ),
        f"sorted-{key}",
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        stored.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    position = F.col("_seq") - F.shiftleft(F.col("_part").cast("long"), 33)
    # One row per sort partition: the broadcast is bounded by spark.sql.shuffle.partitions.
    return stored.join(F.broadcast(offsets), "_part").select(
        (F.col("_offset") + position + 1).alias(key), *df.columns
    )


def dedupe_keep_first(df: DataFrame, keys: list[str], order_by) -> DataFrame:
    """One row per key: the first one in the order of ``order_by``.

    ``min_by`` of a row is a sort aggregate: every task sorts its rows by key, which is its cost. It is
    combined on the map side, so a key that holds a large share of all rows leaves each task as one row.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    ranked = F.struct(*_order(order_by))
    kept = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), ranked).alias("_row"))
    return kept.select(*keys, "_row.*").select(*df.columns)


def first_versions(df: DataFrame, keys: list[str], attributes: list[str], position: str) -> DataFrame:
    """First attribute version per key, by ``position``; also returns ``first_row``.

    The large pass groups by all columns and keeps the smallest position, which is a hash
    aggregate with map-side combine. Choosing among the few versions of a key comes second.
    """
    versions = df.groupBy(*keys, *attributes).agg(F.min(position).alias("first_row"))
    if not attributes:
        return versions
    picked = versions.groupBy(*keys).agg(
        F.min_by(F.struct(*attributes, "first_row"), "first_row").alias("_row")
    )
    return picked.select(*keys, "_row.*")


def lookup_key(df: DataFrame, dimension: DataFrame, natural: dict[str, str], surrogate: str) -> DataFrame:
    """Add the dimension's surrogate key; a row without a partner gets NULL.

    ``natural`` maps columns of ``df`` to columns of the dimension. Keys match null-safely: a NULL
    finds the dimension row whose key is NULL. The dimension should be a written table: its file size then decides
    between a broadcast and a shuffle join.
    """
    side = dimension.select(
        F.col(surrogate), *[F.col(d).alias(f"_nk_{d}") for d in natural.values()]
    )
    condition = reduce(
        lambda a, b: a & b,
        [F.col(left).eqNullSafe(F.col(f"_nk_{right}")) for left, right in natural.items()],
    )
    joined = df.join(side, condition, "left")
    return joined.drop(*[f"_nk_{d}" for d in natural.values()])


#: A packed row has this many words of as many bits.
_WORD = 64
#: Bytes of a packed row besides its surrogates: words, counts and overhead.
_PACKED_BYTES = _WORD * 12 + 128
#: A dimension up to this size is broadcast row by row.
_PLAIN_BYTES = 4 << 20


def _slot(number: Column) -> Column:
    return F.shiftright(number, 6).bitwiseAND(_WORD - 1).cast("int")


def _position(number: Column) -> Column:
    return number.bitwiseAND(_WORD - 1).cast("int")


def _pack(pairs: DataFrame, natural: str, surrogate: str) -> DataFrame:
    """``_block, _words, _ahead, _values``: which of 4,096 neighbouring numbers there are, and their surrogates in order.

    A surrogate is found by counting the bits before its number: ``_ahead`` has the count before each word. ``_twice``
    tells whether a number comes more than once.
    """
    number = F.col(natural).cast("long")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), _position(number))
    pair = F.struct(number.alias("number"), F.col(surrogate).cast("int").alias("value"))
    slots = pairs.filter(F.col(natural).isNotNull()).groupBy(
        F.shiftright(number, 12).alias("_block"), _slot(number).alias("slot")
    )
    slots = slots.agg(F.bit_or(bit).alias("word"), F.sort_array(F.collect_list(pair)).alias("pairs"))
    blocks = slots.groupBy("_block").agg(F.sort_array(F.collect_list(F.struct("slot", "word", "pairs"))).alias("_slots"))
    every = F.sequence(F.lit(0), F.lit(_WORD - 1))
    none = F.lit(0).cast("long")

    def added(chosen: Column, value) -> Column:
        return F.aggregate(chosen, none, lambda total, s: total + value(s))

    def in_slot(i: Column) -> Column:
        return F.filter("_slots", lambda s: s["slot"] == i)

    def before(i: Column) -> Column:
        return F.filter("_slots", lambda s: s["slot"] < i)

    return blocks.select(
        "_block",
        F.transform(every, lambda i: added(in_slot(i), lambda s: s["word"])).alias("_words"),
        F.transform(every, lambda i: added(before(i), lambda s: F.size(s["pairs"])).cast("int")).alias("_ahead"),
        F.flatten(F.transform("_slots", lambda s: s["pairs"]["value"])).alias("_values"),
        F.exists("_slots", lambda s: F.size(s["pairs"]) > F.bit_count(s["word"])).alias("_twice"),
    )


def lookup_number(
    df: DataFrame, dimension: DataFrame, natural: str, surrogate: str, plain_bytes: int = _PLAIN_BYTES,
    packed_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """:func:`lookup_key` by one key of whole numbers, which a dimension of millions answers without moving a row.

    Rows of a broadcast table take some hundred bytes each. Packed by ranges of 4,096 numbers, a member takes a bit and
    the four bytes of its surrogate. The packed table is measured: with more members, scattered numbers or wider
    surrogates both sides are shuffled.
    """
    side = dimension.select(F.col(natural), F.col(surrogate))
    whole = all(isinstance(f.dataType, T.IntegralType) for f in [df.schema[natural], *side.schema.fields])
    if not (whole and broadcasts_on(df.sparkSession)):
        return lookup_key(df, join_side(side), {natural: natural}, surrogate)
    size, low, high = side.agg(byte_size(side), F.min(surrogate), F.max(surrogate)).first()
    if size <= plain_bytes:
        return lookup_key(df, F.broadcast(side), {natural: natural}, surrogate)
    fits = -(1 << 31) <= low and high < 1 << 31
    if not fits or side.select(F.count_distinct(F.shiftright(F.col(natural).cast("long"), 12))).first()[0] * _PACKED_BYTES > packed_bytes:
        return lookup_key(df, side.hint("merge"), {natural: natural}, surrogate)
    packed = materialize(_pack(side, natural, surrogate), f"packed-{surrogate}")
    taken, twice = packed.agg(F.sum(F.size("_values") * 4 + _PACKED_BYTES), F.max("_twice")).first()
    unknown = side.filter(F.col(natural).isNull()).select(surrogate).take(2)
    if (taken or 0) > packed_bytes or twice or len(unknown) > 1:
        return lookup_key(df, side.hint("merge"), {natural: natural}, surrogate)
    number = F.col(natural).cast("long")
    joined = df.join(F.broadcast(packed.drop("_twice")), F.shiftright(number, 12) == F.col("_block"), "left")
    word, position = F.get("_words", _slot(number)), _position(number)
    lower = F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("long"), position))
    value = F.get("_values", F.get("_ahead", _slot(number)) + F.bit_count(word.bitwiseAND(lower)))
    found = F.when(F.getbit(word, position) == 1, value).cast(side.schema[surrogate].dataType)
    if unknown:
        found = F.when(F.col(natural).isNull(), F.lit(unknown[0][0])).otherwise(found)
    return joined.select(*df.columns, found.alias(surrogate))
