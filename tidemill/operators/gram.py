"""Pairwise-complete moments of many columns by blocked matrix products.

Every task multiplies the batches of its rows: for all pairs of columns at once, the number of rows that have both, and
the sums, squares and products over these rows. One row for a cell leaves a task; cells are added up by Spark. Values are
taken relative to a point near each column's mean, so that little is lost in the differences.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The product function is sent to the workers by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SUMS = ["n", "x", "y", "xx", "yy", "xy"]
CELL = "i int, j int, n double, x double, y double, xx double, yy double, xy double, low double, high double"


def _products(centre: np.ndarray, gaps: list[int]):
    """Cells (i, j) with i <= j. ``low`` and ``high`` are i's range over the rows that have j; they are kept for both
    orders of a pair, and only where j has gaps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(centre)
        n, x, xx, xy = (np.zeros((k, k)) for _ in range(4))
        low, high = np.full((k, k), np.inf), np.full((k, k), -np.inf)
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [c.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False) for c in batch.columns]
            values = np.column_stack(columns) - centre
            there = ~np.isnan(values)
            values = np.where(there, values, 0.0)
            has = there.astype(np.float64)
            n += has.T @ has
            x += values.T @ has  # sums of i over the rows that have j
            xx += (values * values).T @ has
            xy += values.T @ values
            for j in gaps:
                rows = there[:, j]
                if rows.any():
                    part, seen = values[rows], there[rows]
                    low[:, j] = np.minimum(low[:, j], np.where(seen, part, np.inf).min(axis=0))
                    high[:, j] = np.maximum(high[:, j], np.where(seen, part, -np.inf).max(axis=0))
        i, j = np.indices((k, k)).reshape(2, -1).astype(np.int32)
        cells = [n[i, j], x[i, j], x[j, i], xx[i, j], xx[j, i], xy[i, j], low[i, j], high[i, j]]
        names = ["i", "j", *SUMS, "low", "high"]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (i, j, *cells)], names)

    return run


def pair_moments(df: DataFrame, values: list[Column], centre: list[float], gaps: list[int]) -> DataFrame:
    """One row for each ordered pair of columns, by number, over the rows where both are present.

    ``n, x, y, xx, yy, xy`` are the count, sums, sums of squares and of products of the values less ``centre``; ``low``
    and ``high`` the range of the first column over the rows that have the second, where the second is among ``gaps``.
    """
    numbers = df.select(*[v.cast("double").alias(f"c{i}") for i, v in enumerate(values)])
    cells = numbers.mapInArrow(_products(np.array(centre), gaps), CELL)
    sums = [F.sum(c).alias(c) for c in SUMS]
    return cells.groupBy("i", "j").agg(*sums, F.min("low").alias("low"), F.max("high").alias("high"))
