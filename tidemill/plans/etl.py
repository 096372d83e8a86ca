"""Smaller pipelines: employees, e-commerce orders, user profiles, the sales walk-through."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.operators import quality
from tidemill.operators.cleaning import drop_null_rows
from tidemill.operators.keys import SOURCE_POSITION, dedupe_keep_first, with_source_position
from tidemill.operators.load import anti_join_new, historical_split
from tidemill.plans import reports
from tidemill.plans.audit import RunAudit
from tidemill.sources import files, sinks
from tidemill.sources.nested import flatten_struct
from tidemill.storage import VersionedTables, materialize
from tidemill.streaming import arrivals

EMPLOYEE = "id bigint, name string, salary bigint, age int"
JSON_EMPLOYEE = "id bigint, name string, salary bigint"


def employee_rules() -> dict:
    return {"salary": F.col("salary") > 0, "age": F.col("age").between(18, 60)}


def employees(spark: SparkSession, csv_paths: list[str], store: VersionedTables) -> DataFrame:
    """CSV files as one table, first row per id (files in the order of the list), valid rows, unseen ids appended.

    Returns the quarantined rows with the reason.
    """
    listed = [
        with_source_position(files.read_csv_text(spark, path)).withColumn("listed", F.lit(i))
        for i, path in enumerate(csv_paths)
    ]
    order = ["listed", *SOURCE_POSITION]
    typed = files.typed_columns(reduce(DataFrame.unionByName, listed), EMPLOYEE, keep=order)
    first = materialize(dedupe_keep_first(typed, ["id"], order).drop(*order), "employees")
    valid, quarantine = quality.split_valid(first, employee_rules())
    new = anti_join_new(valid, store.read("employees"), ["id"]) if store.exists("employees") else valid
    store.append("employees", new)
    return quarantine


def json_employees(spark: SparkSession, path: str, store: VersionedTables) -> DataFrame:
    """JSON array, salary in lakh, full replacement."""
    rows = files.read_json_array(spark, path, JSON_EMPLOYEE)
    return store.replace("json_employees", rows.withColumn("salary_lakh", F.col("salary") / F.lit(100000.0)))


def clean_frame(df: DataFrame) -> DataFrame:
    """Distinct rows without NULLs."""
    return drop_null_rows(df.dropDuplicates())


def enrich_orders(orders: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    """Cleaned order rows with their product and customer, and the amount."""
    sold = clean_frame(orders).filter(F.col("quantity") > 0)
    return (
        sold.join(clean_frame(products), "product_id")
        .join(clean_frame(customers), "customer_id")
        .withColumn("total_amount", F.col("quantity") * F.col("price"))
    )


def arriving_orders(store: VersionedTables, new: DataFrame) -> DataFrame:
    """Append the orders whose id is not stored yet; returns the appended rows."""
    fresh = anti_join_new(new, store.read("orders"), ["order_id"])
    store.append("orders", fresh)
    return fresh


def ecommerce_report(store: VersionedTables) -> DataFrame:
    """Quantity and amount per category over historical and newly arrived orders."""
    return reports.category_sales_report(
        store.read("orders"), store.read("products"), "product_id", "quantity", "price", "category"
    )


def ecommerce_run(
    spark: SparkSession, tables: dict[str, DataFrame], arriving: str, schema: T.StructType, cutoff: str, root: str
) -> DataFrame:
    """Customers, products, payments and orders: cleaned and loaded, orders from history and from files that arrive.

    Orders before ``cutoff`` are the history; the Parquet files below ``arriving`` are streamed after it, and
    a known order item is ignored. Returns the report over all loaded orders; the run log is ``root/log``.
    """
    orders = f"{root}/orders"
    with RunAudit(spark, "ecommerce", f"{root}/log") as audit:
        store = VersionedTables(spark, f"{root}/tables")
        for name in ("customers", "products", "payments"):
            audit.record(name, store.replace(name, clean_frame(tables[name])))
        sold = clean_frame(tables["orders"]).filter(F.col("quantity") > 0)
        arrivals.backfill(historical_split(sold, "order_date", cutoff)[0].select(*schema.names), orders, ["order_item_id"])
        audit.record("history", arrivals.read_target(spark, orders, schema))
        arrivals.stream_new_arrivals(
            spark, arriving, schema, ["order_item_id"], ["order_date", "order_id"], orders, f"{root}/stream"
        )
        loaded = arrivals.read_target(spark, orders, schema)
        audit.record("orders", loaded)
        unpaid = loaded.select("order_id").distinct().join(store.read("payments"), "order_id", "left_anti")
        audit.check("orders without payment", unpaid.count())
    return reports.category_sales_report(loaded, store.read("products"), "product_id", "quantity", "price", "category")


def profiles(users: DataFrame, locations: DataFrame, out_path: str | None = None) -> DataFrame | None:
    """User payload and location file joined on id; None when either side is empty."""
    flat = flatten_struct(users)
    chosen = flat.select("id", "name", "email", F.col("`company.name`").alias("company"))
    merged = files.merge_if_present(chosen, locations, "id")
    if merged is not None and out_path:
        sinks.write_csv(merged, out_path)
    return merged


def sales_walkthrough(sales: DataFrame, customers: DataFrame) -> dict[str, DataFrame]:
    """Filter, totals, distinct rows, join and averages of one sales file."""
    s, c = sales.alias("s"), customers.alias("c")
    return {
        "large_sales": sales.filter(F.col("sales") > 10000),
        "totals": reports.sales_by_category(sales, "category", "sales"),
        "distinct": sales.dropDuplicates(),
        "joined": s.join(c, F.col("s.customer_id") == F.col("c.customer_id")).select(
            "s.product", "s.category", "s.sales", "c.customer_name", "c.city"
        ),
        "averages": reports.average_by_category(sales, "category", "sales"),
    }
