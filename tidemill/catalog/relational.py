"""Filters, joins, aggregates, distinct rows and unions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.measures import report_money
from tidemill.operators import copies, quality
from tidemill.operators.keys import dedupe_keep_first
from tidemill.operators.load import historical_split
from tidemill.plans import etl, reports
from tidemill.plans.testbed import table


def filter_gt(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    return items.filter(F.col("l_extendedprice") > 10000).select("l_orderkey", "l_linenumber", "l_extendedprice")


def _item_rules() -> dict:
    return {"quantity": F.col("l_quantity") > 5, "discount": F.col("l_discount").between(0.02, 0.08)}


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")


def filter_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.split_valid(_items(spark, sf_dir), _item_rules())[0]


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.split_valid(_items(spark, sf_dir), _item_rules())[1]


def _sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales and number of items for each part with its category: the items are reduced before they are joined."""
    sales = F.col("l_extendedprice").cast("decimal(12,2)")
    by_part = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(
        F.sum(sales).alias("sales"), F.count(sales).alias("n")
    )
    return by_part.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("p_type").alias("category"), "sales", "n"
    )


def group_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = reports.sales_by_category(_sales(spark, sf_dir), "category", "sales")
    return totals.withColumn("total_sales", report_money(F.col("total_sales")))


def group_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = _sales(spark, sf_dir).groupBy("category").agg(F.sum("sales").alias("sales"), F.sum("n").alias("n"))
    return totals.select("category", F.round(F.col("sales").cast("double") / F.col("n"), 2).alias("average_sales"))


def category_sales_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("product_id"), F.col("l_quantity").cast("bigint").alias("quantity")
    )
    products = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
    )
    report = reports.category_sales_report(orders, products, "product_id", "quantity", "price", "category")
    return report.withColumn("total_sales", report_money(F.col("total_sales")))


def join_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c = table(spark, sf_dir, "orders").alias("o"), table(spark, sf_dir, "customer").alias("c")
    return o.join(c, F.col("o.o_custkey") == F.col("c.c_custkey"), "inner").select(
        "o.o_orderkey", "o.o_totalprice", "c.c_name", "c.c_mktsegment"
    )


def join_inner_using(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return documents.join(table(spark, sf_dir, "labels"), "doc_id", "inner")


def join_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items as orders, parts as products, suppliers in the place of customers."""
    orders = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_suppkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_shipdate").alias("order_date"),
    )
    products = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
    )
    customers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("customer_id"), F.col("s_name").alias("name")
    )
    report = etl.enrich_orders(orders, products, customers)
    return report.withColumns({c: F.col(c).cast("double") for c in ("price", "total_amount")})


def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns of the items, each row twice."""
    items = table(spark, sf_dir, "lineitem")
    return copies.distinct_rows(items.unionByName(items))


def dedupe_first_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe_keep_first(table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"])


def union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"), F.lit("supplier").alias("role")
    )
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"), F.lit("customer").alias("role"), F.col("c_acctbal").alias("balance")
    )
    return customers.unionByName(suppliers)


def historical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both halves; pending orders have no date."""
    orders = table(spark, sf_dir, "orders")
    dated = orders.filter("o_orderstatus <> 'P'")
    undated = orders.filter("o_orderstatus = 'P'").withColumn("o_orderdate", F.lit(None).cast("timestamp_ntz"))
    halves = [historical_split(part, "o_orderdate", "1998-01-01") for part in (dated, undated)]
    before, after = (first.unionByName(second) for first, second in zip(*halves))
    return before.withColumn("half", F.lit("history")).unionByName(after.withColumn("half", F.lit("arriving")))


QUERIES = {
    "filter_gt": filter_gt,
    "filter_valid": filter_valid,
    "quarantine": quarantine,
    "group_sum": group_sum,
    "group_avg": group_avg,
    "category_sales_report": category_sales_report,
    "join_select": join_select,
    "join_inner_using": join_inner_using,
    "join_chain": join_chain,
    "distinct_rows": distinct_rows,
    "dedupe_keep_first": dedupe_first_order,
    "union_all": union_all,
    "historical_split": historical,
}

_SALES = """(SELECT p_type AS category, CAST(l_extendedprice AS DECIMAL(12,2)) AS sales
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""
_VALID = "l_quantity > 5 AND l_discount BETWEEN 0.02e0 AND 0.08e0"

ORACLE = {
    "filter_gt": "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_extendedprice > 10000",
    "filter_valid": f"SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem WHERE {_VALID}",
    "quarantine": f"""SELECT l_orderkey, l_linenumber, l_quantity, l_discount,
  concat_ws(',', CASE WHEN NOT l_quantity > 5 THEN 'quantity' END,
    CASE WHEN NOT l_discount BETWEEN 0.02e0 AND 0.08e0 THEN 'discount' END) AS reason
  FROM lineitem WHERE NOT ({_VALID})""",
    "group_sum": f"SELECT category, CAST(ROUND(SUM(sales), 2) AS DOUBLE) AS total_sales FROM {_SALES} GROUP BY category",
    "group_avg": f"SELECT category, ROUND(AVG(sales), 2) AS average_sales FROM {_SALES} GROUP BY category",
    "category_sales_report": """SELECT p_type AS category,
  CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total_quantity,
  CAST(ROUND(SUM(CAST(l_quantity AS INTEGER) * CAST(p_retailprice AS DECIMAL(10,2))), 2) AS DOUBLE) AS total_sales
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type""",
    "join_select": """SELECT o_orderkey, o_totalprice, c_name, c_mktsegment
  FROM orders JOIN customer ON o_custkey = c_custkey""",
    "join_inner_using": "SELECT doc_id, lang, source, quality, toxic FROM documents JOIN labels USING (doc_id)",
    "join_chain": """SELECT DISTINCT l_orderkey AS order_id, l_linenumber AS line, s_suppkey AS customer_id,
  p_partkey AS product_id, CAST(l_quantity AS INTEGER) AS quantity, l_shipdate AS order_date, p_name AS product,
  CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS DOUBLE) AS price, s_name AS name,
  CAST(CAST(l_quantity AS INTEGER) * CAST(p_retailprice AS DECIMAL(10,2)) AS DOUBLE) AS total_amount
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey WHERE l_quantity > 0""",
    "distinct_rows": "SELECT DISTINCT * FROM lineitem",
    "dedupe_keep_first": """SELECT * FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1""",
    "union_all": """SELECT c_name AS name, 'customer' AS role, c_acctbal AS balance FROM customer
  UNION ALL SELECT s_name, 'supplier', s_acctbal FROM supplier""",
    "historical_split": """SELECT *, CASE WHEN o_orderdate < DATE '1998-01-01' THEN 'history' ELSE 'arriving' END AS half
  FROM (SELECT * REPLACE (CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS o_orderdate) FROM orders)""",
}
