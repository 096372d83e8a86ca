"""Loading: unseen keys, insert-or-ignore, update and delete as DataFrame rewrites."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.operators.keys import dedupe_keep_first
from tidemill.storage import BROADCAST_BYTES, byte_size, materialize

_RANGE_TYPES = (T.IntegralType, T.StringType, T.DateType)


def anti_join_new(
    new: DataFrame, existing: DataFrame, keys: list[str], small_batch_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Rows of ``new`` whose key is not in ``existing``.

    The usual case is a small batch against a huge target. The keys of the batch are measured.
    Small ones are broadcast to the target scan, with their range as a pushed-down filter, so
    that the target is neither shuffled nor read in full. A larger batch takes the shuffled anti
    join, where AQE splits skewed partitions. ``new`` is evaluated more than once, so it should
    be read from files or be a written table.
    """
    known = existing.select(*keys)
    leading = keys[0]
    size, low, high = new.agg(byte_size(new, keys), F.min(leading), F.max(leading)).first()
    if size > small_batch_bytes:
        return new.join(known.distinct(), keys, "left_anti")
    if isinstance(new.schema[leading].dataType, _RANGE_TYPES) and low is not None:
        known = known.filter(F.col(leading).between(F.lit(low), F.lit(high)))
    batch_keys = new.select(*keys).distinct()
    matched = known.join(F.broadcast(batch_keys), keys, "left_semi").distinct()
    return new.join(F.broadcast(matched), keys, "left_anti")


def has_bit(bits: Column, position: Column) -> Column:
    """Whether a bitmap holds the position."""
    byte = F.conv(F.hex(F.substring(bits, (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    mask = F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), (position % 8 + 1).cast("int"))
    return byte.bitwiseAND(mask) != 0


def anti_join_numbers(new: DataFrame, existing: DataFrame, key: str, small_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Rows of ``new`` whose number is not in ``existing``, for keys that are dense whole numbers.

    The known numbers become bitmaps, one of 4 kB for 32,768 numbers, and their written table is measured. A small one is
    broadcast: neither side moves a row, so the result may be evaluated by several jobs. With more, or with scattered
    numbers, the rows left are written once behind :func:`anti_join_new`.
    """
    bucket = F.bitmap_bucket_number(key).alias("_bucket")
    known = existing.filter(F.col(key).isNotNull()).groupBy(bucket)
    known = materialize(known.agg(F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("_known")), "known-numbers")
    if known.agg(byte_size(known)).first()[0] > small_bytes:
        return materialize(anti_join_new(new, existing, [key]), "new-rows")
    joined = new.withColumn("_bucket", bucket).join(F.broadcast(known), "_bucket", "left")
    unseen = F.col("_known").isNull() | ~has_bit(F.col("_known"), F.bitmap_bit_position(key))
    return joined.filter(unseen).select(*new.columns)


def insert_or_ignore(
    target: DataFrame, batch: DataFrame, keys: list[str], required: list[str], order_by
) -> DataFrame:
    """Target plus the batch rows that would not violate a key or a NOT NULL column.

    An existing row wins over the batch, and the first row wins inside the batch.
    """
    return target.unionByName(new_rows(target, batch, keys, required, order_by).select(*target.columns))


def new_rows(target: DataFrame, batch: DataFrame, keys: list[str], required: list[str], order_by) -> DataFrame:
    """The part of ``batch`` that insert-or-ignore would add."""
    filled = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*required, *keys]])
    first = materialize(dedupe_keep_first(batch.filter(filled), keys, order_by), "batch")
    return anti_join_new(first, target, keys)


def update_rows(df: DataFrame, condition: Column, values: dict[str, Column]) -> DataFrame:
    return df.withColumns(
        {name: F.when(condition, value).otherwise(F.col(name)) for name, value in values.items()}
    )


def delete_rows(df: DataFrame, condition: Column) -> DataFrame:
    """Rows for which the predicate is unknown stay, as with SQL DELETE."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def historical_split(df: DataFrame, date_column: str, cutoff: str) -> tuple[DataFrame, DataFrame]:
    """Rows before the ISO date ``cutoff``, and the others."""
    before = F.col(date_column) < F.to_date(F.lit(cutoff))
    return df.filter(before), df.filter(~F.coalesce(before, F.lit(False)))
