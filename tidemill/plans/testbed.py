"""Driver tables mapped to the staging schema, and the star schema built from them."""

from __future__ import annotations

from collections.abc import Callable
from threading import RLock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions import measures
from tidemill.operators.keys import read_with_row_id
from tidemill.plans.transform import transform
from tidemill.plans.warehouse import build_warehouse, check_dates, extend_warehouse
from tidemill.storage import VersionedTables, join_side, scratch_path

_BUILT: dict[tuple[str, str], tuple[VersionedTables, dict[str, DataFrame]]] = {}
_LOADED: dict[tuple[str, str], dict[str, DataFrame]] = {}
_LOCK = RLock()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order items with the columns the transformation stage needs.

    Orders are joined with their customer first, then with the items, so the large table takes
    part in two joins that may shuffle. Only source columns pass through these: names of places,
    which a handful of rows hold, and texts made of a number are added behind them.
    """
    places = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    places = places.select("n_nationkey", "n_name", "r_name")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    orders = (
        table(spark, sf_dir, "orders")
        .join(join_side(customers), F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            "c_nationkey",
            F.col("c_mktsegment").alias("customer_segment"),
            F.col("o_orderpriority").alias("shipping_mode"),
            F.col("o_orderdate").alias("order_datetime"),
        )
    )
    of_order = {
        "customer_city": F.concat(F.lit("CCity_"), F.col("customer_id") % 11),
        "customer_state": F.col("r_name"),
        "customer_country": F.col("n_name"),
        "customer_segment": F.col("customer_segment"),
        "market": F.col("r_name"),
        "order_city": F.concat(F.lit("City_"), F.col("customer_id") % 7),
        "order_state": F.concat(F.lit("State_"), F.col("customer_id") % 3),
        "order_country": F.col("n_name"),
        "order_region": F.col("n_name"),
        "latitude": F.col("n_nationkey") * F.lit(1.5),
        "longitude": F.col("n_nationkey") * F.lit(-2.25),
        "shipping_mode": F.col("shipping_mode"),
        "scheduled_days": F.substring("shipping_mode", 1, 1).cast("int"),
        "order_datetime": F.col("order_datetime"),
    }
    products = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_size").cast("long").alias("category_id"),
        F.col("p_type").alias("category_name"),
        F.regexp_extract("p_brand", r"(\d+)", 1).cast("long").alias("department_id"),
        F.col("p_brand").alias("department_name"),
        F.col("p_retailprice").alias("product_price"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
    )
    items = read_with_row_id(spark, f"{sf_dir}/lineitem.parquet").select(
        "row_id",
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").cast("long").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_discount").cast("decimal(4,2)").alias("discount_rate"),
        (F.col("l_extendedprice").cast("decimal(12,2)") * F.lit(0.4).cast("decimal(2,1)")).alias("cost"),
        F.col("l_shipdate").alias("shipping_datetime"),
    )
    gross = measures.gross_amount("price", "quantity")
    profit = gross - measures.discount_amount("price", "quantity", "discount_rate") - F.col("cost")
    own = ["row_id", "order_item_id", "quantity", "discount_rate", "cost", "shipping_datetime", "customer_id"]
    return (
        items.join(orders, "order_id")
        .join(join_side(products), "product_id")
        .join(F.broadcast(places), F.col("c_nationkey") == F.col("n_nationkey"))  # one row for a nation
        .select(
            "product_id", "order_id", *own, *[value.alias(name) for name, value in of_order.items()],
            *[c for c in products.columns if c != "product_id"],
        )
        .withColumns(
            {
                "real_days": F.datediff("shipping_datetime", "order_datetime"),
                "sales": gross,
                "profit": profit.cast(measures.MONEY),
            }
        )
        .drop("cost")
    )


def staging_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transform(cleaned(spark, sf_dir))


def build(spark: SparkSession, sf_dir: str) -> tuple[VersionedTables, dict[str, DataFrame]]:
    """Write staging and the star schema to the shared folder."""
    store = VersionedTables(spark, scratch_path(spark, "warehouse"))
    rows = staging(spark, sf_dir)
    return store, {"staging": rows, **build_warehouse(rows, store)}


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The tables of :func:`build`, written once per application and source folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    with _LOCK:
        if key not in _BUILT or not _BUILT[key][0].exists("fact_sales"):
            _BUILT[key] = build(spark, sf_dir)
        return _BUILT[key][1]


def once(label: str, spark: SparkSession, sf_dir: str, make: Callable[[], dict[str, DataFrame]]) -> dict[str, DataFrame]:
    """What ``make`` writes, once per application and source folder."""
    key = (f"{label} {spark.sparkContext.applicationId}", sf_dir)
    with _LOCK:
        if key not in _LOADED:
            _LOADED[key] = make()
        return _LOADED[key]


#: Ends of the first and second load, by order date.
LOADS = ["1996-07-01", "1999-01-01"]


def loaded(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The star schema built from the first orders and extended by the later ones, load by load."""
    rows = staging(spark, sf_dir)

    def make() -> dict[str, DataFrame]:
        store, day = VersionedTables(spark, scratch_path(spark, "loads")), F.col("order_datetime")
        first, second = (F.to_timestamp_ntz(F.lit(f"{d} 00:00:00")) for d in LOADS)
        build_warehouse(rows.filter(day < first), store)
        extend_warehouse(rows.filter((day >= first) & (day < second)), store)
        return extend_warehouse(rows.filter(day >= first), store)

    return once("loads", spark, sf_dir, make)


def rebuilt(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The star schema of the orders before the second load, then built anew from all orders."""
    rows = staging(spark, sf_dir)

    def make() -> dict[str, DataFrame]:
        store = VersionedTables(spark, scratch_path(spark, "rebuilt"))
        build_warehouse(rows.filter(F.col("order_datetime") < F.to_timestamp_ntz(F.lit(f"{LOADS[1]} 00:00:00"))), store)
        return build_warehouse(rows, store)

    return once("rebuilt", spark, sf_dir, make)


def staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staging table, written once, with its dates checked. Who reads nothing else does not wait for the star schema."""

    def make() -> dict[str, DataFrame]:
        store = VersionedTables(spark, scratch_path(spark, "staging"))
        return {"staging": store.replace("staging", staging_plan(spark, sf_dir), check_dates)}

    return once("staging", spark, sf_dir, make)["staging"]
