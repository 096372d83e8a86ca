"""Exact quantiles by radix selection over the bits of the values.

A double becomes a whole number of 64 bits in the same order. A scan counts, for every column, how many values begin
with which 16 bits; the wanted ranks fall into few of these buckets, and the next scan counts the next 16 bits inside
them. A rank is settled as soon as its bucket holds one distinct value, or when it is the first or last of its bucket,
so two scans are usual and four are the most. Only bucket counts are shuffled: at most 65,536 for a column and an open
bucket, whatever the number of rows.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The counting function is sent to the workers by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

DIGIT_BITS = 16
#: Buckets a task holds before equal ones are added up.
HELD_BUCKETS = 1 << 18
BUCKETS = "col int, slot long, n long, low long, high long"


def order_key(values: np.ndarray) -> np.ndarray:
    """Doubles as 64-bit integers in the same order; -0.0 counts as 0.0."""
    bits = (values + 0.0).view(np.int64)
    return np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits)


def from_order_key(key: int) -> float:
    bits = np.array([key], np.int64)
    return float(np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits).view(np.float64)[0])


def _add_up(parts: list[np.ndarray]) -> np.ndarray:
    """Rows (slot, n, low, high), one for each slot, sorted."""
    rows = np.concatenate(parts, axis=1)
    rows = rows[:, np.argsort(rows[0], kind="stable")]
    new = np.flatnonzero(np.append(True, rows[0, 1:] != rows[0, :-1]))
    merged = [rows[0, new], np.add.reduceat(rows[1], new)]
    return np.stack([*merged, np.minimum.reduceat(rows[2], new), np.maximum.reduceat(rows[3], new)])


def _counter(open_slots: list[np.ndarray | None], shift: int):
    """Counts of the buckets of ``shift`` dropped bits; with open slots, only of those that begin with one of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = [[] for _ in open_slots]
        for batch in batches:
            for i, slots in enumerate(open_slots):
                values = batch.column(i).drop_null().to_numpy(zero_copy_only=False)
                keys = order_key(values[~np.isnan(values)])
                if slots is not None:
                    prefix = keys >> np.int64(shift + DIGIT_BITS)
                    keys = keys[slots[np.minimum(np.searchsorted(slots, prefix), len(slots) - 1)] == prefix]
                if len(keys):
                    keys.sort()
                    slot = keys >> np.int64(shift)
                    new = np.flatnonzero(np.append(True, slot[1:] != slot[:-1]))
                    end = np.append(new[1:], len(keys))
                    held[i].append(np.stack([slot[new], end - new, keys[new], keys[end - 1]]))
                    if sum(part.shape[1] for part in held[i]) > HELD_BUCKETS:
                        held[i] = [_add_up(held[i])]
        for i, parts in enumerate(held):
            if parts:
                slot, n, low, high = _add_up(parts)
                column = np.full(len(slot), i, np.int32)
                arrays = [pa.array(x) for x in (column, slot, n, low, high)]
                yield pa.RecordBatch.from_arrays(arrays, ["col", "slot", "n", "low", "high"])

    return run


def _places(df: DataFrame, values: list[Column], open_slots: list[np.ndarray | None], shift: int) -> DataFrame:
    """Buckets with the number of values ``before`` them in their column and, if these are open, in their prefix."""
    numbers = df.select(*[v.cast("double").alias(f"c{i}") for i, v in enumerate(values)])
    counts = numbers.mapInArrow(_counter(open_slots, shift), BUCKETS)
    counts = counts.groupBy("col", "slot").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
    prefix = F.shiftright("slot", DIGIT_BITS) if open_slots[0] is not None else F.lit(0).cast("long")
    counts = counts.withColumn("prefix", prefix)
    group = Window.partitionBy("col", "prefix")
    upto = F.sum("n").over(group.orderBy("slot").rowsBetween(Window.unboundedPreceding, 0))
    return counts.withColumns({"before": upto - F.col("n"), "total": F.sum("n").over(group)})


def select_ranks(
    df: DataFrame, values: list[Column], probabilities: list[float]
) -> list[tuple[int, dict[int, float]]]:
    """For every column the number of its values (neither null nor NaN), and its value at each rank that a quantile needs."""
    if not values or not probabilities:
        return [(0, {}) for _ in values]
    spark = df.sparkSession
    shift = 64 - DIGIT_BITS
    places = _places(df, values, [None] * len(values), shift)
    ends = [f((F.col("total") - 1) * F.lit(float(p))).cast("long") for p in probabilities for f in (F.floor, F.ceil)]
    wanted = places.select("*", F.explode(F.array_distinct(F.array(*ends))).alias("rank"))
    wanted = wanted.withColumn("place", F.col("rank"))
    sizes, found = [0] * len(values), [{} for _ in values]
    while True:
        pending: dict[int, list[tuple[int, int, int]]] = {}
        for hit in wanted.filter("before <= rank AND rank < before + n").collect():
            column, inside = hit["col"], hit["rank"] - hit["before"]
            if shift == 64 - DIGIT_BITS:
                sizes[column] = hit["total"]
            if hit["low"] == hit["high"] or inside in (0, hit["n"] - 1):
                found[column][hit["place"]] = from_order_key(hit["low"] if inside == 0 else hit["high"])
            else:
                pending.setdefault(column, []).append((hit["slot"], inside, hit["place"]))
        if not pending:
            return list(zip(sizes, found))
        shift -= DIGIT_BITS
        columns = sorted(pending)
        slots = [np.unique([slot for slot, _, _ in pending[c]]) for c in columns]
        places = _places(df, [values[c] for c in columns], slots, shift)
        rows = [(i, c, *open_rank) for i, c in enumerate(columns) for open_rank in pending[c]]
        # one row for each open rank
        ranks = F.broadcast(spark.createDataFrame(rows, "col int, column int, prefix long, rank long, place long"))
        wanted = places.join(ranks, ["col", "prefix"]).drop("col").withColumnRenamed("column", "col")


def exact_quantiles(df: DataFrame, typed: dict[str, Column], probabilities: list[float]) -> dict[str, dict[float, float]]:
    """Exact quantiles with linear interpolation of all columns together; NULL and NaN do not count.

    A column without values has None for every probability.
    """
    result: dict[str, dict[float, float]] = {}
    for name, (size, at) in zip(typed, select_ranks(df, list(typed.values()), probabilities)):
        result[name] = dict.fromkeys(probabilities)
        for p in probabilities if size else []:
            place = (size - 1) * p
            low, high = at[math.floor(place)], at[math.ceil(place)]
            result[name][p] = low + (high - low) * (place - math.floor(place)) if low != high else low
    return result
