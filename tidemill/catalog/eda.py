"""Exploratory statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators import eda
from tidemill.plans.testbed import table

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
DIGITS = 6


def _rounded(df: DataFrame) -> DataFrame:
    """Sums of doubles differ in the last digits with the order of rows."""
    return df.withColumns(
        {f.name: F.round(f.name, DIGITS) for f in df.schema.fields if f.dataType.typeName() == "double"}
    )


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(*MEASURES, F.lit(1).alias("constant"))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def iqr_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(eda.iqr_bounds(_events(spark, sf_dir), ["value", "user_id"]))


def iqr_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eda.iqr_filter(_events(spark, sf_dir), "value").select("event_id", "value")


def feature_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(eda.feature_variance(_items(spark, sf_dir), [*MEASURES, "constant"]))


def describe_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(eda.describe_stats(_items(spark, sf_dir), MEASURES))


def corr_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(eda.corr_matrix(_items(spark, sf_dir), [*MEASURES, "constant"])).withColumn(
        "correlation", F.col("correlation") + F.lit(0.0)
    )


def histogram_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(eda.histogram_bins(_events(spark, sf_dir), ["value", "user_id"]))


def boxplot_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(eda.boxplot_stats(_events(spark, sf_dir), ["value", "user_id"]))


def profile_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return eda.profile_info(documents.join(table(spark, sf_dir, "labels"), "doc_id", "left"))


QUERIES = {
    "iqr_bounds": iqr_bounds,
    "iqr_filter": iqr_filter,
    "feature_variance": feature_variance,
    "describe_stats": describe_stats,
    "corr_matrix": corr_matrix,
    "histogram_bins": histogram_bins,
    "boxplot_stats": boxplot_stats,
    "profile_info": profile_info,
}


def _quantiles(column: str, source: str) -> str:
    return f"""SELECT '{column}' AS column_name, quantile_cont(CAST({column} AS DOUBLE), 0.25) AS q1,
  quantile_cont(CAST({column} AS DOUBLE), 0.5) AS median, quantile_cont(CAST({column} AS DOUBLE), 0.75) AS q3 FROM {source}"""


def _bins(column: str) -> str:
    return f"""SELECT '{column}' AS column_name, b.bin, ROUND(low + b.bin * w, 6) AS bin_start,
  ROUND(CASE WHEN b.bin = 9 THEN high ELSE low + (b.bin + 1) * w END, 6) AS bin_end, coalesce(n, 0) AS n
  FROM (SELECT min(CAST({column} AS DOUBLE)) AS low, max(CAST({column} AS DOUBLE)) AS high,
    (max(CAST({column} AS DOUBLE)) - min(CAST({column} AS DOUBLE))) / 10e0 AS w FROM events) r
  JOIN (SELECT CAST(range AS INTEGER) AS bin FROM range(10)) b ON TRUE
  LEFT JOIN (SELECT CAST(least(floor((CAST({column} AS DOUBLE) - (SELECT min({column}) FROM events))
      / (((SELECT max({column}) FROM events) - (SELECT min({column}) FROM events)) / 10e0)), 9) AS INTEGER) AS bin,
      COUNT(*) AS n FROM events GROUP BY 1) c ON b.bin = c.bin"""


_ITEMS = f"(SELECT {', '.join(MEASURES)}, 1 AS constant FROM lineitem)"
_PROFILE = [
    ("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "bigint"),
    ("quality", "int"), ("toxic", "int"),
]


def _correlation(a: str, b: str) -> str:
    if "constant" in (a, b):
        return f"SELECT '{a}' AS column_a, '{b}' AS column_b, CAST(NULL AS DOUBLE) AS correlation"
    return f"SELECT '{a}' AS column_a, '{b}' AS column_b, ROUND(corr({a}, {b}), 6) + 0e0 AS correlation FROM {_ITEMS}"


def _box(column: str) -> str:
    return f"""SELECT q.column_name, ROUND(q1, 6) AS q1, ROUND(median, 6) AS median, ROUND(q3, 6) AS q3,
  (SELECT ROUND(least(q1, min(CAST({column} AS DOUBLE))), 6) FROM events WHERE {column} BETWEEN q1 - 1.5e0 * (q3 - q1) AND q3 + 1.5e0 * (q3 - q1)) AS whisker_low,
  (SELECT ROUND(greatest(q3, max(CAST({column} AS DOUBLE))), 6) FROM events WHERE {column} BETWEEN q1 - 1.5e0 * (q3 - q1) AND q3 + 1.5e0 * (q3 - q1)) AS whisker_high,
  (SELECT COUNT(*) FROM events WHERE NOT {column} BETWEEN q1 - 1.5e0 * (q3 - q1) AND q3 + 1.5e0 * (q3 - q1)) AS outliers
  FROM ({_quantiles(column, "events")}) q"""


ORACLE = {
    "iqr_bounds": f"""SELECT column_name, ROUND(q1, 6) AS q1, ROUND(q3, 6) AS q3, ROUND(q3 - q1, 6) AS iqr,
  ROUND(q1 - 1.5e0 * (q3 - q1), 6) AS lower, ROUND(q3 + 1.5e0 * (q3 - q1), 6) AS upper
  FROM ({_quantiles("value", "events")} UNION ALL {_quantiles("user_id", "events")})""",
    "iqr_filter": f"""SELECT event_id, value FROM events, ({_quantiles("value", "events")}) q
  WHERE value BETWEEN q1 - 1.5e0 * (q3 - q1) AND q3 + 1.5e0 * (q3 - q1)""",
    "feature_variance": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, ROUND(var_pop({c}), 6) AS variance, var_pop({c}) > 0 AS kept FROM {_ITEMS}"
        for c in [*MEASURES, "constant"]
    ),
    "describe_stats": " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, COUNT({c}) AS count, ROUND(AVG({c}), 6) AS mean,
  ROUND(stddev_samp({c}), 6) AS std, ROUND(min({c}), 6) AS min, ROUND(quantile_cont({c}, 0.25), 6) AS q25,
  ROUND(quantile_cont({c}, 0.5), 6) AS q50, ROUND(quantile_cont({c}, 0.75), 6) AS q75, ROUND(max({c}), 6) AS max
  FROM {_ITEMS}"""
        for c in MEASURES
    ),
    "corr_matrix": " UNION ALL ".join(
        _correlation(a, b) for a in [*MEASURES, "constant"] for b in [*MEASURES, "constant"]
    ),
    "histogram_bins": f"{_bins('value')} UNION ALL {_bins('user_id')}",
    "boxplot_stats": f"{_box('value')} UNION ALL {_box('user_id')}",
    "profile_info": " UNION ALL ".join(
        f"""SELECT {i} AS position, '{c}' AS column_name, COUNT({c}) AS non_null, '{t}' AS data_type
  FROM (SELECT d.*, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""
        for i, (c, t) in enumerate(_PROFILE)
    ),
}
