"""Files of every format: written by a sink, read back by a reader, equal to the source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.dates import parse_strict
from tidemill.operators.keys import lookup_key
from tidemill.plans.testbed import table, tables
from tidemill.plans.warehouse import TABLES, register_views
from tidemill.sources import files, sinks
from tidemill.sources.nested import flatten_struct
from tidemill.storage import materialize, scratch_path

DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CUSTOMER = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
EVENT = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = sinks.write_csv(table(spark, sf_dir, "documents"), scratch_path(spark, "csv"))
    return files.read_csv(spark, path, DOCUMENT, multi_line=True)


def csv_latin1(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = sinks.write_csv(table(spark, sf_dir, "documents"), scratch_path(spark, "latin1"), encoding="ISO-8859-1")
    return files.read_csv(spark, path, DOCUMENT, encoding="ISO-8859-1", multi_line=True)


def csv_parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates with and without a fault, read leniently; the complete ones also strictly."""
    shown = F.date_format("o_orderdate", "M/d/yyyy H:mm")
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", F.lit("pending")).otherwise(shown).alias("shipped"),
        shown.alias("ordered"),
    )
    path = sinks.write_csv(rows, scratch_path(spark, "dates"))
    read = files.read_csv(
        spark, path, "o_orderkey bigint, shipped timestamp_ntz, ordered string", timestamp_format="M/d/yyyy H:mm"
    )
    return read.withColumn("ordered", parse_strict("ordered", "M/d/yyyy H:mm"))


def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = sinks.write_json(table(spark, sf_dir, "events"), scratch_path(spark, "json"))
    return files.read_json_lines(spark, path, EVENT)


def xml_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = sinks.write_xml(table(spark, sf_dir, "customer"), scratch_path(spark, "xml"), "customer")
    return files.read_xml(spark, path, "customer", CUSTOMER)


def json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = F.from_json("props", "k bigint")
    return table(spark, sf_dir, "events").select("event_id", parsed.getField("k").alias("k"))


def json_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as nested payloads, landed as JSON and flattened after reading."""
    payload = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.struct("user_id", F.struct(F.col("event_type").alias("kind"), "value").alias("detail")).alias("event"),
        F.from_json("props", "k bigint").alias("props"),
    )
    path = sinks.write_json(payload, scratch_path(spark, "payload"))
    landed = files.read_json_lines(
        spark,
        path,
        "id bigint, event struct<user_id: bigint, detail: struct<kind: string, value: double>>, props struct<k: bigint>",
    )
    return flatten_struct(landed, sep="_")


def tolerant_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One source is there and one is missing, so the merge is skipped."""
    present = files.read_or_empty(spark, f"{sf_dir}/customer.parquet", CUSTOMER)
    absent = files.read_or_empty(spark, f"{sf_dir}/not_landed.parquet", "c_custkey bigint, city string")
    merged = files.merge_if_present(present, absent, "c_custkey")
    counts = None
    for name, df in {"customer": present, "not_landed": absent}.items():
        row = df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("source"), "rows", F.when(F.col("rows") > 0, "loaded").otherwise("empty").alias("status")
        )
        counts = row if counts is None else counts.unionByName(row)
    return counts.withColumn("merge", F.lit("skipped" if merged is None else "done"))


def extract_csv_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as CSV, read with the columns in another order; one segment is a null token."""
    customers = table(spark, sf_dir, "customer")
    segment = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("NA")).otherwise(F.col("c_mktsegment"))
    path = sinks.write_csv(customers.select("c_custkey", "c_name", segment.alias("c_mktsegment")), scratch_path(spark, "columns"))
    return files.extract_csv(spark, path, "c_mktsegment string, c_custkey bigint, c_name string")


def extract_json_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed payloads, one JSON array a file, beside a source that has not landed."""
    path = _json_arrays(spark, sf_dir)
    schema = "s_suppkey bigint, s_name string, s_acctbal double"
    return files.extract_json(spark, path, schema).unionByName(files.extract_json(spark, f"{path}/none", schema))


#: Rows of one landed JSON array.
ARRAY_ROWS = 1000


def write_json_arrays(rows: DataFrame, group: str, key: str, columns: list[str], path: str) -> str:
    """Rows as JSON arrays, a file for each group and range of keys; text files do not add anything to them."""
    landed = rows.withColumn("page", F.floor(F.col(key) / ARRAY_ROWS)).groupBy(group, "page")
    arrays = landed.agg(F.to_json(F.collect_list(F.struct(*columns))).alias("value"))
    arrays.write.mode("overwrite").partitionBy(group, "page").text(path)
    return f"{path}/*/*"


def _json_arrays(spark: SparkSession, sf_dir: str) -> str:
    """Suppliers as arrays of a nation."""
    suppliers, path = table(spark, sf_dir, "supplier"), scratch_path(spark, "arrays")
    return write_json_arrays(suppliers, "s_nationkey", "s_suppkey", ["s_suppkey", "s_name", "s_acctbal"], path)


def json_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.read_json_array(spark, _json_arrays(spark, sf_dir), "s_suppkey bigint, s_name string, s_acctbal double")


def text_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as delimited lines with blanks around the fields; a short line lacks the last one."""
    lines = table(spark, sf_dir, "part").select(
        F.concat(
            F.lit(" "), F.col("p_partkey").cast("string"), F.lit(" ;\t"), "p_brand",
            F.when(F.col("p_size") > 5, F.concat(F.lit("; "), F.col("p_size").cast("string"), F.lit(" "))).otherwise(""),
        )
    )
    path = scratch_path(spark, "lines")
    lines.write.mode("overwrite").text(path)
    return files.read_text_delimited(spark, path, ["part", "brand", "size"], ";")


def csv_multi_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and suppliers in two folders, read as one table."""
    paths = []
    for name, short in (("customer", "c"), ("supplier", "s")):
        key = "c_custkey" if short == "c" else "s_suppkey"
        rows = table(spark, sf_dir, name).select(F.col(key).alias("id"), F.col(f"{short}_name").alias("name"))
        paths.append(sinks.write_csv(rows, scratch_path(spark, f"many-{name}")))
    return files.read_csv(spark, paths, "id bigint, name string")


def csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    path = sinks.write_csv(rows, scratch_path(spark, "inferred"))
    read = files.read_csv(spark, path)
    return read.withColumn("o_orderkey", F.col("o_orderkey").cast("bigint"))


def binary_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in files of a hundred ids, one line each in the order of ids, read as bytes."""
    path = scratch_path(spark, "bytes")
    line = F.struct("doc_id", F.regexp_replace("text", "[\\r\\n]", " ").alias("line"))
    rows = table(spark, sf_dir, "documents").groupBy(F.floor(F.col("doc_id") / 100).alias("page"))
    rows = rows.agg(F.array_join(F.transform(F.array_sort(F.collect_list(line)), lambda x: x["line"]), "\n").alias("value"))
    rows.write.mode("overwrite").partitionBy("page").text(path)
    found = files.read_binary(spark, f"{path}/page=*/*")
    key = F.regexp_extract("path", r"page=(\d+)", 1).cast("bigint")
    return found.select(key.alias("page"), "length", F.md5("content").alias("digest"))


def sql_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales by year and segment in SQL over the registered views of the star."""
    register_views({name: df for name, df in tables(spark, sf_dir).items() if name in TABLES})
    return spark.sql(
        """SELECT d.year, c.customer_segment, COUNT(*) AS items, CAST(ROUND(SUM(f.sales), 2) AS DOUBLE) AS sales
           FROM fact_sales f JOIN dim_date d ON f.order_date_key = d.date_key
           JOIN dim_customer c ON f.customer_key = c.customer_key GROUP BY d.year, c.customer_segment"""
    )


def null_key_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders looked up by a customer key that is NULL for one customer on both sides."""
    hidden = lambda c: F.when(F.col(c) != 4, F.col(c))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", hidden("o_custkey").alias("customer"))
    customers = table(spark, sf_dir, "customer").select(hidden("c_custkey").alias("id"), F.col("c_name").alias("found"))
    return lookup_key(orders, materialize(customers, "customers"), {"customer": "id"}, "found")


QUERIES = {
    "extract_csv_columns": extract_csv_columns,
    "extract_json_payload": extract_json_payload,
    "json_array": json_array,
    "text_file": text_file,
    "csv_multi_file": csv_multi_file,
    "csv_inferred": csv_inferred,
    "binary_files": binary_files,
    "sql_reports": sql_reports,
    "null_key_lookup": null_key_lookup,
    "csv_roundtrip": csv_roundtrip,
    "csv_latin1": csv_latin1,
    "csv_parse_dates": csv_parse_dates,
    "json_roundtrip": json_roundtrip,
    "xml_roundtrip": xml_roundtrip,
    "json_extract": json_extract,
    "json_flatten": json_flatten,
    "tolerant_source": tolerant_source,
}

ORACLE = {
    "extract_csv_columns": "SELECT nullif(c_mktsegment, 'BUILDING') AS c_mktsegment, c_custkey, c_name FROM customer",
    "extract_json_payload": "SELECT s_suppkey, s_name, s_acctbal FROM supplier",
    "json_array": "SELECT s_suppkey, s_name, s_acctbal FROM supplier",
    "text_file": """SELECT CAST(p_partkey AS VARCHAR) AS part, p_brand AS brand,
  CASE WHEN p_size > 5 THEN CAST(p_size AS VARCHAR) END AS size FROM part""",
    "csv_multi_file": "SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier",
    "csv_inferred": "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders",
    "binary_files": r"""SELECT page, strlen(bytes) AS length, md5(bytes) AS digest FROM (
  SELECT CAST(floor(doc_id / 100) AS BIGINT) AS page,
    string_agg(regexp_replace(text, '[\r\n]', ' ', 'g'), chr(10) ORDER BY doc_id) || chr(10) AS bytes
  FROM documents GROUP BY 1)""",
    "sql_reports": """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, c_mktsegment AS customer_segment, COUNT(*) AS items,
  CAST(ROUND(SUM(CAST(p_retailprice AS DECIMAL(10,2)) * CAST(l_quantity AS INTEGER)), 2) AS DOUBLE) AS sales
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""",
    "null_key_lookup": """SELECT o_orderkey, nullif(o_custkey, 4) AS customer, c_name AS found
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
    "csv_roundtrip": "SELECT * FROM documents",
    "csv_latin1": "SELECT * FROM documents",
    "csv_parse_dates": """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS shipped,
  o_orderdate AS ordered FROM orders""",
    "json_roundtrip": "SELECT * FROM events",
    "xml_roundtrip": "SELECT * FROM customer",
    "json_extract": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    "json_flatten": """SELECT event_id AS id, user_id AS event_user_id, event_type AS event_detail_kind,
  value AS event_detail_value, CAST(json_extract(props, '$.k') AS BIGINT) AS props_k FROM events""",
    "tolerant_source": """SELECT 'customer' AS source, COUNT(*) AS rows,
  CASE WHEN COUNT(*) > 0 THEN 'loaded' ELSE 'empty' END AS status, 'skipped' AS merge FROM customer
  UNION ALL SELECT 'not_landed', 0, 'empty', 'skipped'""",
}
