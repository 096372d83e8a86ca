"""Exploratory statistics: exact quantiles, outlier bounds, describe, correlation, chart data."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.measures import nan_to_null
from tidemill.operators import gram, quantiles
from tidemill.operators.cleaning import columns_of_type, quoted


def numeric_columns(df: DataFrame) -> list[str]:
    return columns_of_type(df, T.NumericType)


def _number(column: str) -> Column:
    """The column as double, with NaN as NULL."""
    return nan_to_null(F.col(quoted(column)).cast("double"))


def exact_quantiles(df: DataFrame, columns: list[str], probabilities: list[float]) -> dict[str, dict[float, float]]:
    """Exact quantiles with linear interpolation, for all columns together (see :mod:`tidemill.operators.quantiles`)."""
    return quantiles.exact_quantiles(df, {c: _number(c) for c in columns}, probabilities)


BOUNDS_SCHEMA = "column_name string, q1 double, q3 double, iqr double, lower double, upper double"


def _bounds(df: DataFrame, columns: list[str]) -> list[tuple]:
    rows = []
    for column, q in exact_quantiles(df, columns, [0.25, 0.75]).items():
        q1, q3 = q[0.25], q[0.75]
        if q1 is None:
            rows.append((column, None, None, None, None, None))
            continue
        iqr = q3 - q1
        rows.append((column, q1, q3, iqr, q1 - 1.5 * iqr, q3 + 1.5 * iqr))
    return rows


def iqr_bounds(df: DataFrame, columns: list[str]) -> DataFrame:
    """Quartiles and the 1.5 IQR fences per column."""
    return df.sparkSession.createDataFrame(_bounds(df, columns), BOUNDS_SCHEMA)


def iqr_filter(df: DataFrame, column: str) -> DataFrame:
    """Rows inside the fences, both ends included; NULL is outside.

    The fences are literals in the filter, so it reaches the scan.
    """
    (_, _, _, _, lower, upper), = _bounds(df, [column])
    if lower is None:
        return df.filter(F.lit(False))
    return df.filter(F.col(quoted(column)).between(lower, upper))


def feature_variance(df: DataFrame, columns: list[str], threshold: float = 0.0) -> DataFrame:
    """``column_name, variance, kept``; population variance, constant columns have exactly 0."""
    pairs = df.agg(
        *[
            F.struct(
                F.var_pop(_number(c)).alias("variance"),
                (F.max(_number(c)) > F.min(_number(c))).alias("varies"),
            ).alias(c)
            for c in columns
        ]
    )
    rows = pairs.unpivot([], [F.col(quoted(c)) for c in columns], "column_name", "s")
    return rows.select(
        "column_name",
        F.when(F.col("s.varies"), F.col("s.variance")).otherwise(F.lit(0.0)).alias("variance"),
        (F.coalesce(F.col("s.varies"), F.lit(False)) & (F.col("s.variance") > threshold)).alias("kept"),
    )


def select_features(df: DataFrame, columns: list[str], threshold: float = 0.0) -> DataFrame:
    """The frame without the columns whose variance does not exceed the threshold."""
    kept = {r["column_name"] for r in feature_variance(df, columns, threshold).filter("kept").collect()}
    return df.select(*[F.col(quoted(c)) for c in df.columns if c in kept or c not in columns])


DESCRIBE_SCHEMA = (
    "column_name string, count long, mean double, std double, min double, "
    "q25 double, q50 double, q75 double, max double"
)


def describe_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum per column."""
    typed = {c: _number(c) for c in columns}
    moments = df.agg(
        *[
            F.struct(F.count(v), F.avg(v), F.stddev_samp(v), F.min(v), F.max(v)).alias(c)
            for c, v in typed.items()
        ]
    ).first()
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    rows = []
    for c in columns:
        count, mean, std, low, high = moments[c]
        q = quartiles[c]
        rows.append((c, count, mean, std, low, q[0.25], q[0.5], q[0.75], high))
    return df.sparkSession.createDataFrame(rows, DESCRIBE_SCHEMA)


def corr_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """``column_a, column_b, correlation`` for all ordered pairs: Pearson over the rows where
    both are present, NULL when either does not vary there.

    A light first pass finds the columns' ranges, means and gaps. The second multiplies blocks of rows (see
    :mod:`tidemill.operators.gram`), so any number of columns is one scan with one row for a pair and task.
    """
    typed = [_number(c) for c in columns]
    if not columns:
        return df.sparkSession.createDataFrame([], "column_a string, column_b string, correlation double")
    seen = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.struct(F.count(v), F.min(v), F.max(v), F.avg(v)).alias(f"c{i}") for i, v in enumerate(typed)],
    ).first()
    stats = [seen[f"c{i}"] for i in range(len(columns))]
    gaps = [i for i, s in enumerate(stats) if s[0] < seen["rows"]]
    varies = [s[1] is not None and s[2] > s[1] for s in stats]
    centre = [s[3] if s[3] is not None and math.isfinite(s[3]) else 0.0 for s in stats]
    cells = gram.pair_moments(df, typed, centre, gaps)
    # the range of one column over the rows that have the other; without gaps it is that of the whole column
    other = cells.select(F.col("j").alias("i"), F.col("i").alias("j"), F.col("low").alias("low_y"), F.col("high").alias("high_y"))
    names, moving = F.array(*[F.lit(c) for c in columns]), F.array(*[F.lit(v) for v in varies])

    def moves(low: str, high: str, this: str, that: str) -> Column:
        with_gaps = F.col(that).isin(gaps) if gaps else F.lit(False)
        return F.when(with_gaps, F.col(low) < F.col(high)).otherwise(F.get(moving, F.col(this)))

    def spread(square: str, total: str) -> Column:
        return F.col(square) - F.col(total) * F.col(total) / F.col("n")

    covariance = F.col("xy") - F.col("x") * F.col("y") / F.col("n")
    pearson = covariance / F.sqrt(F.greatest(spread("xx", "x"), F.lit(0.0)) * F.greatest(spread("yy", "y"), F.lit(0.0)))
    both = moves("low", "high", "i", "j") & moves("low_y", "high_y", "j", "i")
    value = F.when(both & (F.col("i") == F.col("j")), F.lit(1.0)).when(both & (F.col("n") > 0), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), pearson)))
    return cells.join(other, ["i", "j"]).select(
        F.get(names, F.col("i")).alias("column_a"), F.get(names, F.col("j")).alias("column_b"), nan_to_null(value).alias("correlation")
    )


def histogram_bins(df: DataFrame, columns: list[str], bins: int = 10) -> DataFrame:
    """``column_name, bin, bin_start, bin_end, n``: equal bins, the last one closed, empty ones kept."""
    spark = df.sparkSession
    typed = {c: _number(c) for c in columns}
    ranges = df.agg(*[F.struct(F.min(v), F.max(v)).alias(c) for c, v in typed.items()]).first()
    edges, expressions = [], []
    for c, value in typed.items():
        low, high = ranges[c]
        if low is None:
            continue
        used = bins if high > low else 1
        width = (high - low) / used
        number = F.least(F.floor((value - low) / width), F.lit(used - 1)) if high > low else F.lit(0)
        expressions.append(F.when(value.isNotNull(), number.cast("int")).alias(c))
        edges += [
            (c, i, low + i * width, high if i == used - 1 else low + (i + 1) * width) for i in range(used)
        ]
    frame = spark.createDataFrame(edges, "column_name string, bin int, bin_start double, bin_end double")
    if not edges:
        return frame.withColumn("n", F.lit(0).cast("long"))
    counts = (
        df.select(*expressions)
        .unpivot([], [F.col(quoted(c)) for c in dict.fromkeys(e[0] for e in edges)], "column_name", "bin")
        .filter("bin is not null")
        .groupBy("column_name", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return frame.join(counts, ["column_name", "bin"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def boxplot_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """Quartiles, whiskers at the last value inside the fences, and the number of outliers."""
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    aggregates, rows = [], []
    for c in columns:
        value, q = _number(c), quartiles[c]
        if q[0.25] is None:
            continue
        reach = 1.5 * (q[0.75] - q[0.25])
        inside = value.between(q[0.25] - reach, q[0.75] + reach)
        aggregates.append(
            F.struct(F.min(F.when(inside, value)), F.max(F.when(inside, value)), F.count_if(~inside)).alias(c)
        )
    ends = df.agg(*aggregates).first() if aggregates else {}
    for c in columns:
        q = quartiles[c]
        if q[0.25] is not None:
            low, high, outliers = ends[c]
            # a whisker never ends inside the box
            low, high = min(low, q[0.25]), max(high, q[0.75])
            rows.append((c, q[0.25], q[0.5], q[0.75], low, high, outliers))
    return df.sparkSession.createDataFrame(
        rows,
        "column_name string, q1 double, median double, q3 double, "
        "whisker_low double, whisker_high double, outliers long",
    )


def profile_info(df: DataFrame) -> DataFrame:
    """``position, column_name, non_null, data_type``."""
    counts = df.agg(*[F.count(F.col(quoted(c))).alias(c) for c in df.columns])
    cells = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.col(quoted(f.name)).alias("non_null"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return counts.select(F.inline(F.array(*cells)))
