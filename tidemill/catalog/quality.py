"""Cleaning and data-quality reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators import cleaning, copies, quality
from tidemill.plans.testbed import table

DATE_TEXT = "yyyy-MM-dd"


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return documents.join(table(spark, sf_dir, "labels"), "doc_id", "left")


def missing_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.missing_report(_labelled(spark, sf_dir))


def duplicate_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return copies.duplicate_count(table(spark, sf_dir, "documents").unionByName(table(spark, sf_dir, "documents").filter("doc_id % 3 = 0")))


def anomaly_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks carry no value, so they are missing; other values must be at most 100."""
    value = F.when(F.col("event_type") != "click", F.col("value"))
    events = table(spark, sf_dir, "events").select("event_id", value.alias("value"))
    return events.withColumn("status", quality.range_status(F.col("value"), 0, 100))


def _date_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates as text; fulfilled orders lack the day, so their text is not a date."""
    text = F.date_format("o_orderdate", DATE_TEXT)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", F.substring(text, 1, 7)).otherwise(text).alias("order_date"),
        text.alias("entry_date"),
    )


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.parse_dates(_date_texts(spark, sf_dir), ["order_date", "entry_date"], DATE_TEXT)


def invalid_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.invalid_dates(_parsed(spark, sf_dir), ["order_date", "entry_date"])


def gate_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = _parsed(spark, sf_dir)
    return quality.gate_status(
        quality.invalid_dates(parsed, ["order_date"]), "order dates", "invalid"
    ).unionByName(quality.gate_status(quality.invalid_dates(parsed, ["entry_date"]), "entry dates", "invalid"))


def drop_null_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.drop_null_rows(_labelled(spark, sf_dir))


def drop_sensitive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.drop_sensitive(table(spark, sf_dir, "customer"), ["c_name", "c_acctbal", "c_phone"])


def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.concat(F.lit("\t "), "c_name", F.lit(" \r\n")).alias("c_name"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("   "))
        .otherwise(F.concat(F.lit("  "), "c_mktsegment"))
        .alias("c_mktsegment"),
    )
    return cleaning.clean_text(padded)


def clean_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_text(table(spark, sf_dir, "documents"))


QUERIES = {
    "missing_report": missing_report,
    "duplicate_count": duplicate_count,
    "anomaly_range": anomaly_range,
    "invalid_dates": invalid_dates,
    "gate_status": gate_status,
    "drop_null_rows": drop_null_rows,
    "drop_sensitive": drop_sensitive,
    "clean_text": clean_text,
    "clean_text_documents": clean_documents,
}

_LABELLED = "(SELECT d.doc_id, text, lang, source, n_chars, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"
# All white space that str.strip() removes, built from code points.
_SPACE = "||".join(
    f"chr({c})"
    for c in (9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288)
)

ORACLE = {
    "missing_report": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) - COUNT({c}) AS missing FROM {_LABELLED}"
        for c in ("doc_id", "text", "lang", "source", "n_chars", "quality", "toxic")
    ),
    "duplicate_count": """SELECT COUNT(*) AS rows, COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM documents)) AS duplicate_rows
  FROM (SELECT * FROM documents UNION ALL SELECT * FROM documents WHERE doc_id % 3 = 0)""",
    "anomaly_range": """SELECT event_id, value, CASE WHEN value IS NULL THEN 'missing'
  WHEN value < 0 OR value > 100 THEN 'anomaly' ELSE 'ok' END AS status
  FROM (SELECT event_id, CASE WHEN event_type <> 'click' THEN value END AS value FROM events)""",
    "invalid_dates": """SELECT 'order_date' AS column_name, COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS invalid FROM orders
  UNION ALL SELECT 'entry_date', COUNT(*) FILTER (WHERE o_orderdate IS NULL) FROM orders""",
    "gate_status": """SELECT gate, failures, CASE WHEN failures = 0 THEN 'PASSED' ELSE 'FAILED' END AS status FROM (
  SELECT 'order dates' AS gate, COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS failures FROM orders
  UNION ALL SELECT 'entry dates', COUNT(*) FILTER (WHERE o_orderdate IS NULL) FROM orders)""",
    "drop_null_rows": f"SELECT * FROM {_LABELLED} WHERE quality IS NOT NULL AND toxic IS NOT NULL",
    "drop_sensitive": "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer",
    "clean_text": """SELECT c_custkey, c_name,
  CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS c_mktsegment FROM customer""",
    "clean_text_documents": f"""SELECT doc_id, nullif(trim(text, {_SPACE}), '') AS text,
  nullif(trim(lang, {_SPACE}), '') AS lang, nullif(trim(source, {_SPACE}), '') AS source, n_chars FROM documents""",
}
