"""Loading: new keys, insert-or-ignore, update, delete, replacement, arriving files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.measures import report_money
from tidemill.operators import load
from tidemill.operators.keys import read_with_row_id
from tidemill.plans import etl
from tidemill.plans.testbed import table
from tidemill.storage import CODEC, VersionedTables, scratch_path
from tidemill.streaming import arrivals

CUTOFF = "1998-01-01"
OVERLAP = "1997-10-03"


def _history_and_batch(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders before the cut-off, and a batch that starts 90 days earlier."""
    orders = table(spark, sf_dir, "orders")
    history, _ = load.historical_split(orders, "o_orderdate", CUTOFF)
    return history, orders.filter(F.col("o_orderdate") >= F.to_date(F.lit(OVERLAP)))


def anti_join_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    history, batch = _history_and_batch(spark, sf_dir)
    return load.anti_join_new(batch, history, ["o_orderkey"])


def incremental_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    history, batch = _history_and_batch(spark, sf_dir)
    store = VersionedTables(spark, scratch_path(spark, "append"))
    store.replace("orders", history)
    for _ in range(2):
        store.append("orders", load.anti_join_new(batch, store.read("orders"), ["o_orderkey"]))
    return store.read("orders")


def insert_or_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known customers, offered ones with two rows per key, and some without a name."""
    customer = table(spark, sf_dir, "customer")
    target = customer.filter(F.col("c_mktsegment") != "BUILDING")
    offered = customer.withColumn("c_name", F.when(F.col("c_nationkey") != 4, F.concat("c_name", F.lit(" new"))))
    again = offered.withColumn("c_acctbal", F.col("c_acctbal") + 1)
    batch = offered.withColumn("seq", F.lit(1)).unionByName(again.withColumn("seq", F.lit(2)))
    return load.insert_or_ignore(target, batch, ["c_custkey"], ["c_name"], ["seq"])


def update_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = VersionedTables(spark, scratch_path(spark, "update"))
    store.replace("customer", table(spark, sf_dir, "customer"))
    return store.update("customer", F.col("c_acctbal") < 0, {"c_acctbal": F.lit(0.0)})


def delete_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = VersionedTables(spark, scratch_path(spark, "delete"))
    store.replace("customer", table(spark, sf_dir, "customer"))
    return store.delete("customer", F.nullif(F.col("c_nationkey"), F.lit(5)) > 20)


def full_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second version is computed from the first and takes its place."""
    store = VersionedTables(spark, scratch_path(spark, "replace"))
    store.replace("supplier", table(spark, sf_dir, "supplier"))
    current = store.read("supplier")
    store.replace("supplier", current.withColumn("s_name", F.upper("s_name")))
    return store.read("supplier")


def create_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = VersionedTables(spark, scratch_path(spark, "create"))
    store.create_if_absent("customer", table(spark, sf_dir, "customer"))
    return store.create_if_absent("customer", table(spark, sf_dir, "customer").withColumn("c_name", F.lit("ignored")))


def stream_new_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the events as history, then files that repeat part of it, twice."""
    root = scratch_path(spark, "arrivals")
    events = table(spark, sf_dir, "events")
    early = F.col("event_type").isin("click", "view")
    arrivals.backfill(events.filter(early), f"{root}/target", ["event_id"])
    for name, part in {"a": events, "b": events.filter(~early)}.items():
        part.write.mode("overwrite").parquet(f"{root}/landing/{name}")
    for _ in range(2):
        arrivals.stream_new_arrivals(
            spark,
            f"{root}/landing/*",
            events.schema,
            ["event_id"],
            ["ts", "event_id"],
            f"{root}/target",
            f"{root}/checkpoint",
            files_per_batch=2,
        )
    return arrivals.read_target(spark, f"{root}/target", events.schema)


def _ecommerce(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """Items as orders, a third of the recent ones in arriving files together with known ones."""
    items = read_with_row_id(spark, f"{sf_dir}/lineitem.parquet", "order_item_id").select(
        F.col("order_item_id").cast("bigint").alias("order_item_id"),
        F.col("l_orderkey").cast("bigint").alias("order_id"),
        F.col("l_suppkey").cast("bigint").alias("customer_id"),
        F.col("l_partkey").cast("bigint").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_shipdate").alias("order_date"),
    )
    orders = table(spark, sf_dir, "orders")
    frames = {
        "customers": table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("customer_id"), F.col("s_name").alias("name")),
        "products": table(spark, sf_dir, "part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_type").alias("category"),
            F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
        ),
        "payments": orders.filter("o_orderstatus <> 'P'").select(
            F.col("o_orderkey").cast("bigint").alias("order_id"), F.col("o_totalprice").alias("amount")
        ),
        "orders": items,
    }
    root = scratch_path(spark, "ecommerce")
    # an item that is known already arrives again with another quantity
    known = items.filter("order_date < DATE '1996-06-01' AND product_id % 7 = 0").withColumn("quantity", F.lit(999))
    late = items.filter("order_date >= DATE '1996-06-01'").unionByName(known)
    late.write.mode("overwrite").parquet(f"{root}/arriving", compression=CODEC)
    report = etl.ecommerce_run(spark, frames, f"{root}/arriving", items.schema, "1996-06-01", root)
    return report, root


def ecommerce_run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report, _ = _ecommerce(spark, sf_dir)
    return report.withColumn("total_sales", report_money(F.col("total_sales")))


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, root = _ecommerce(spark, sf_dir)
    return spark.read.parquet(f"{root}/log").select("step", "stage", "status", "rows", "columns")


QUERIES = {
    "ecommerce_run_report": ecommerce_run_report,
    "run_log": run_log,
    "anti_join_new": anti_join_new,
    "incremental_append": incremental_append,
    "insert_or_ignore": insert_or_ignore,
    "update_rows": update_rows,
    "delete_rows": delete_rows,
    "full_replace": full_replace,
    "create_if_absent": create_if_absent,
    "stream_new_arrivals": stream_new_arrivals,
}

ORACLE = {
    "ecommerce_run_report": """SELECT p_type AS category, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total_quantity,
  CAST(ROUND(SUM(CAST(l_quantity AS INTEGER) * CAST(p_retailprice AS DECIMAL(10,2))), 2) AS DOUBLE) AS total_sales
  FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_quantity > 0 GROUP BY p_type""",
    "run_log": """SELECT CAST(step AS INTEGER) AS step, stage, status, rows, CAST(columns AS INTEGER) AS columns FROM (
  SELECT 0 AS step, 'initialised' AS stage, 'ok' AS status, CAST(NULL AS BIGINT) AS rows, NULL AS columns
  UNION ALL SELECT 1, 'customers', 'ok', COUNT(*), 2 FROM supplier
  UNION ALL SELECT 2, 'products', 'ok', COUNT(*), 3 FROM part
  UNION ALL SELECT 3, 'payments', 'ok', COUNT(*), 2 FROM orders WHERE o_orderstatus <> 'P'
  UNION ALL SELECT 4, 'history', 'ok', COUNT(*), 6 FROM lineitem WHERE l_quantity > 0 AND l_shipdate < DATE '1996-06-01'
  UNION ALL SELECT 5, 'orders', 'ok', COUNT(*), 6 FROM lineitem WHERE l_quantity > 0
  UNION ALL SELECT 6, 'orders without payment', CASE WHEN COUNT(*) = 0 THEN 'PASSED' ELSE 'WARNING' END, COUNT(*), NULL
    FROM (SELECT DISTINCT l_orderkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'P')
  UNION ALL SELECT 7, 'finished', CASE WHEN COUNT(*) = 0 THEN 'success' ELSE 'warning' END, NULL, NULL
    FROM orders WHERE o_orderstatus = 'P' AND o_orderkey IN (SELECT l_orderkey FROM lineitem))""",
    "anti_join_new": f"""SELECT * FROM orders n WHERE o_orderdate >= DATE '{OVERLAP}' AND NOT EXISTS (
  SELECT 1 FROM orders e WHERE e.o_orderdate < DATE '{CUTOFF}' AND e.o_orderkey = n.o_orderkey)""",
    "incremental_append": f"""SELECT * FROM orders WHERE o_orderdate < DATE '{CUTOFF}'
  UNION ALL SELECT * FROM orders n WHERE o_orderdate >= DATE '{OVERLAP}' AND NOT EXISTS (
  SELECT 1 FROM orders e WHERE e.o_orderdate < DATE '{CUTOFF}' AND e.o_orderkey = n.o_orderkey)""",
    "insert_or_ignore": """SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING'
  UNION ALL SELECT c_custkey, c_name || ' new', c_nationkey, c_acctbal, c_mktsegment FROM customer
  WHERE c_mktsegment = 'BUILDING' AND c_nationkey <> 4""",
    "update_rows": """SELECT c_custkey, c_name, c_nationkey,
  CASE WHEN c_acctbal < 0 THEN 0e0 ELSE c_acctbal END AS c_acctbal, c_mktsegment FROM customer""",
    "delete_rows": "SELECT * FROM customer WHERE NOT coalesce(nullif(c_nationkey, 5) > 20, FALSE)",
    "full_replace": "SELECT s_suppkey, upper(s_name) AS s_name, s_nationkey, s_acctbal FROM supplier",
    "create_if_absent": "SELECT * FROM customer",
    "stream_new_arrivals": "SELECT * FROM events",
}
