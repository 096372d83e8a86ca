"""Staging, star schema and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators import quality
from tidemill.operators.keys import lookup_key
from tidemill.plans import reports, testbed, warehouse
from tidemill.plans.transform import date_parts
from tidemill.sources import sinks
from tidemill.storage import scratch_path

STAGING = """
items AS MATERIALIZED (SELECT *, row_number() OVER () AS row_id FROM lineitem),
mapped AS (
  SELECT i.row_id, l_orderkey AS order_id, CAST(l_linenumber AS BIGINT) AS order_item_id,
    o_custkey AS customer_id, 'CCity_' || CAST(o_custkey % 11 AS VARCHAR) AS customer_city,
    r_name AS customer_state, n_name AS customer_country, c_mktsegment AS customer_segment,
    p_partkey AS product_id, p_name AS product_name, CAST(p_size AS BIGINT) AS category_id,
    p_type AS category_name, CAST(regexp_extract(p_brand, '(\\d+)', 1) AS BIGINT) AS department_id,
    p_brand AS department_name, p_retailprice AS product_price,
    r_name AS market, 'City_' || CAST(o_custkey % 7 AS VARCHAR) AS order_city,
    'State_' || CAST(o_custkey % 3 AS VARCHAR) AS order_state, n_name AS order_country,
    n_name AS order_region, n_nationkey * 1.5e0 AS latitude, n_nationkey * -2.25e0 AS longitude,
    o_orderpriority AS shipping_mode, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS scheduled_days,
    o_orderdate AS order_datetime, l_shipdate AS shipping_datetime,
    CAST(p_retailprice AS DECIMAL(10,2)) AS price, CAST(l_quantity AS INTEGER) AS quantity,
    CAST(l_discount AS DECIMAL(4,2)) AS discount_rate,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 0.4 AS DECIMAL(18,4)) AS cost
  FROM items i JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    JOIN part ON l_partkey = p_partkey),
priced AS (
  SELECT *, CAST(price * quantity AS DECIMAL(18,4)) AS sales,
    CAST(price * quantity * discount_rate AS DECIMAL(18,4)) AS discount_amount,
    CAST(date_diff('day', CAST(order_datetime AS DATE), CAST(shipping_datetime AS DATE)) AS INTEGER)
      - scheduled_days AS shipping_delay_days
  FROM mapped),
earned AS (
  SELECT *, CAST(sales - discount_amount AS DECIMAL(18,4)) AS revenue,
    CAST(sales - discount_amount - cost AS DECIMAL(18,4)) AS profit
  FROM priced),
staging AS MATERIALIZED (
  SELECT *, coalesce(CAST(profit AS DOUBLE) / nullif(CAST(revenue AS DOUBLE), 0) * 100e0, 0e0) AS profit_margin
  FROM earned)"""


def _dimension(name: str, key: str, natural: list[str], attributes: list[str], order: str = "row_id") -> str:
    columns = ", ".join([*natural, *attributes])
    return f"""
{name}_first AS (SELECT {columns}, {order} FROM staging
  QUALIFY row_number() OVER (PARTITION BY {", ".join(natural)} ORDER BY {order}) = 1),
{name} AS MATERIALIZED (SELECT row_number() OVER (ORDER BY {order}) AS {key}, {columns} FROM {name}_first)"""


def _parts(d: str, prefix: str = "") -> str:
    return f"""CAST(year({d}) AS INTEGER) AS {prefix}year, CAST(month({d}) AS INTEGER) AS {prefix}month,
    monthname({d}) AS {prefix}month_name, 'Q' || CAST(quarter({d}) AS VARCHAR) AS {prefix}quarter,
    CAST(day({d}) AS INTEGER) AS {prefix}day, dayname({d}) AS {prefix}day_name"""


_DIMENSIONS = [
    ("dim_customer", "customer_key", ["customer_id"], warehouse.CUSTOMER),
    ("dim_product", "product_key", ["product_id"], warehouse.PRODUCT),
    ("dim_location", "location_key", warehouse.LOCATION, []),
    ("dim_shipping", "shipping_key", warehouse.SHIPPING, []),
]
DIM_SQL = {
    "dim_date": f"""
dim_date AS (SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, strftime(d, '%Y-%m-%d') AS full_date,
    {_parts("d")}
  FROM (SELECT CAST(order_datetime AS DATE) AS d FROM staging UNION SELECT CAST(shipping_datetime AS DATE) FROM staging)
  WHERE d IS NOT NULL)""",
    **{name: _dimension(name, *of) for name, *of in _DIMENSIONS},
}
FACT_SQL = f"""
fact_sales AS MATERIALIZED (
  SELECT s.row_id AS sales_key, s.order_id, s.order_item_id, c.customer_key, p.product_key,
    CAST(strftime(s.order_datetime, '%Y%m%d') AS INTEGER) AS order_date_key,
    CAST(strftime(s.shipping_datetime, '%Y%m%d') AS INTEGER) AS shipping_date_key,
    l.location_key, h.shipping_key, s.quantity, s.sales, s.discount_amount, s.revenue, s.profit,
    s.profit_margin, s.shipping_delay_days
  FROM staging s LEFT JOIN dim_customer c ON s.customer_id = c.customer_id
    LEFT JOIN dim_product p ON s.product_id = p.product_id
    LEFT JOIN dim_location l ON {" AND ".join(f"s.{c} IS NOT DISTINCT FROM l.{c}" for c in warehouse.LOCATION)}
    LEFT JOIN dim_shipping h ON {" AND ".join(f"s.{c} IS NOT DISTINCT FROM h.{c}" for c in warehouse.SHIPPING)})"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


STAR = _with(STAGING, *DIM_SQL.values(), FACT_SQL)
# The loads of the incremental warehouse: members are numbered load by load, each by first appearance.
_LOAD = f"""CASE WHEN order_datetime < '{testbed.LOADS[0]}' THEN 1 WHEN order_datetime < '{testbed.LOADS[1]}' THEN 2 ELSE 3 END"""
STAGING_LOADS = STAGING.replace("staging AS MATERIALIZED", "rows_staged AS MATERIALIZED") + f""",
staging AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY {_LOAD}, row_id) AS loaded FROM rows_staged)"""
LOADS = _with(STAGING_LOADS, DIM_SQL["dim_date"], *(_dimension(n, *of, order="loaded") for n, *of in _DIMENSIONS), FACT_SQL)


def _table(name: str):
    return lambda spark, sf_dir: testbed.tables(spark, sf_dir)[name]


def fact_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse.fact_output(testbed.tables(spark, sf_dir)["fact_sales"])


def _loaded(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = testbed.loaded(spark, sf_dir)[name]
        return warehouse.fact_output(df) if name == "fact_sales" else df

    return run


def stable_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers after a rebuild that sees earlier rows for the first time: known ones keep their keys."""
    return testbed.rebuilt(spark, sf_dir)["dim_customer"]


PERIOD = "full_date BETWEEN '1996-04-01' AND '1997-06-30'"


def period_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months of a period: the fact is read for its years only."""
    return reports.monthly_sales(testbed.tables(spark, sf_dir), F.expr(PERIOD))


def period_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.yearly_sales(testbed.tables(spark, sf_dir), F.expr(PERIOD))


def _report(name: str):
    run = reports.REPORTS.get(name) or getattr(reports, name)
    return lambda spark, sf_dir: run(testbed.tables(spark, sf_dir))


def _staging(*columns: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = testbed.staging(spark, sf_dir).select(*columns)
        return df.withColumns(
            {f.name: F.col(f.name).cast("double") for f in df.schema.fields if f.dataType.typeName() == "decimal"}
        )

    return run


MEASURE_COLUMNS = ["row_id", "order_id", "shipping_delay_days", "discount_amount", "revenue", "profit_margin"]


def order_date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return date_parts(testbed.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate")


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the label looked up: not every document has one."""
    documents = testbed.table(spark, sf_dir, "documents").select("doc_id", "lang")
    return lookup_key(documents, testbed.table(spark, sf_dir, "labels"), {"doc_id": "doc_id"}, "quality")


def missing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = testbed.tables(spark, sf_dir)["fact_sales"]
    return quality.missing_keys(fact, warehouse.FACT_KEYS).unionByName(
        quality.missing_keys(_labelled(spark, sf_dir), ["quality"])
    )


def null_fk_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = quality.null_fk_check(testbed.tables(spark, sf_dir)["fact_sales"], warehouse.FACT_KEYS)
    labels = quality.null_fk_check(_labelled(spark, sf_dir), ["doc_id", "quality"])
    return fact.withColumn("table_name", F.lit("fact_sales")).unionByName(
        labels.withColumn("table_name", F.lit("documents"))
    )


def fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = testbed.tables(spark, sf_dir)
    labels = testbed.table(spark, sf_dir, "labels")
    documents = testbed.table(spark, sf_dir, "documents")
    return quality.fk_orphans(tables["fact_sales"], warehouse.references(tables)).unionByName(
        quality.fk_orphans(documents, {"doc_id": (labels, "doc_id")})
    )


def key_uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = testbed.tables(spark, sf_dir)
    checks = [
        quality.key_uniqueness(tables["dim_date"], ["date_key"], "dim_date"),
        quality.key_uniqueness(tables["dim_customer"], ["customer_id"], "dim_customer"),
        quality.key_uniqueness(tables["dim_product"], ["product_id"], "dim_product"),
        quality.key_uniqueness(tables["dim_location"], ["location_key"], "dim_location"),
        quality.key_uniqueness(tables["dim_location"], warehouse.LOCATION, "dim_location places"),
        quality.key_uniqueness(tables["dim_shipping"], ["shipping_key"], "dim_shipping"),
        quality.key_uniqueness(tables["dim_shipping"], warehouse.SHIPPING, "dim_shipping modes"),
        quality.key_uniqueness(tables["fact_sales"], ["sales_key"], "fact_sales"),
        quality.key_uniqueness(tables["fact_sales"], ["order_id", "order_item_id"], "fact_sales order items"),
        quality.key_uniqueness(_labelled(spark, sf_dir), ["quality"], "documents by label"),
    ]
    result = checks[0]
    for check in checks[1:]:
        result = result.unionByName(check)
    return result


def row_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = testbed.tables(spark, sf_dir)
    return quality.row_reconcile(tables["staging"], tables["fact_sales"])


def warehouse_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = testbed.tables(spark, sf_dir)
    return quality.row_counts({name: tables[name] for name in warehouse.TABLES})


#: The raw tables of the star schema and how many columns they have.
RAW_COLUMNS = {"lineitem": 11, "orders": 6, "customer": 5, "part": 6, "nation": 3, "region": 2}


def stage_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = warehouse.public(testbed.tables(spark, sf_dir))
    raw = {name: testbed.table(spark, sf_dir, name) for name in RAW_COLUMNS}
    return quality.stage_audit({**raw, "staging": tables["staging"], "fact_sales": tables["fact_sales"]})


def export_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = warehouse.public(testbed.tables(spark, sf_dir))
    names = [*warehouse.TABLES, "dim_unknown"]
    audit = sinks.export_tables(spark, names, tables, scratch_path(spark, "export"))
    return audit.select("name", "rows", "columns", "status")


def run_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    audit = sinks.run_reports(
        spark, reports.REPORTS, reports.shared(testbed.tables(spark, sf_dir)), scratch_path(spark, "reports")
    )
    return audit.select("name", "rows", "columns", "status")


QUERIES = {
    **{name: _table(name) for name in warehouse.DIMENSIONS},
    "fact_sales": fact_sales,
    "derived_measures": _staging(*MEASURE_COLUMNS),
    "shipping_flag": _staging("row_id", "shipping_delay_days", "shipping_performance"),
    "date_parts": order_date_parts,
    "missing_keys": missing_keys,
    "null_fk_check": null_fk_check,
    "fk_orphans": fk_orphans,
    "key_uniqueness": key_uniqueness,
    "row_reconcile": row_reconcile,
    "warehouse_counts": warehouse_counts,
    "stage_audit": stage_audit,
    "incremental_fact_sales": _loaded("fact_sales"),
    "incremental_dim_customer": _loaded("dim_customer"),
    "incremental_dim_product": _loaded("dim_product"),
    "stable_customer_keys": stable_keys,
    "rpt_period_sales": period_sales,
    "rpt_period_orders": period_orders,
    "export_tables": export_tables,
    "run_reports": run_reports,
    **{f"rpt_{name}": _report(name) for name in [*reports.REPORTS, "order_status"]},
}

_SALES_PROFIT = """CAST(ROUND(SUM(sales), 2) AS DOUBLE) AS total_sales,
  CAST(ROUND(SUM(profit), 2) AS DOUBLE) AS total_profit"""
_ORDERS = "COUNT(DISTINCT order_id) AS total_orders"
_MARGIN = "ROUND(AVG(profit_margin), 2) + 0e0 AS average_profit_margin"
_QUANTITY = "CAST(SUM(quantity) AS BIGINT)"
_PRODUCT = "fact_sales f JOIN dim_product p ON f.product_key = p.product_key"
_PLACE = "fact_sales f JOIN dim_location l ON f.location_key = l.location_key"
_DATE = "fact_sales f JOIN dim_date d ON f.order_date_key = d.date_key"
_DELAYED = "CAST(SUM(CASE WHEN shipping_delay_days > 0 THEN 1 ELSE 0 END) AS BIGINT)"
_BY_PRODUCT = "GROUP BY p.product_key, product_name, category_name"

REPORT_SQL = {
    "overall_performance": f"""SELECT {_ORDERS}, COUNT(*) AS total_order_items, {_QUANTITY} AS total_quantity,
  CAST(ROUND(SUM(revenue), 2) AS DOUBLE) AS total_revenue, {_SALES_PROFIT}, {_MARGIN} FROM fact_sales""",
    "yearly_sales": f"SELECT year, {_ORDERS}, {_SALES_PROFIT} FROM {_DATE} GROUP BY year",
    "monthly_sales": f"SELECT year, month, month_name, {_SALES_PROFIT} FROM {_DATE} GROUP BY year, month, month_name",
    "market_sales": f"SELECT market, {_ORDERS}, {_SALES_PROFIT} FROM {_PLACE} GROUP BY market",
    "region_sales": f"SELECT order_region, {_ORDERS}, {_SALES_PROFIT} FROM {_PLACE} GROUP BY order_region",
    "top_products": f"""SELECT product_name, category_name, {_ORDERS}, {_QUANTITY} AS quantity_sold, {_SALES_PROFIT}
  FROM {_PRODUCT} {_BY_PRODUCT} ORDER BY total_sales DESC, p.product_key LIMIT 10""",
    "category_sales": f"""SELECT category_name, {_ORDERS}, {_QUANTITY} AS quantity_sold, {_SALES_PROFIT}
  FROM {_PRODUCT} GROUP BY category_name""",
    "customer_segments": f"""SELECT customer_segment, {_ORDERS},
  COUNT(DISTINCT f.customer_key) AS unique_customers, {_SALES_PROFIT}
  FROM fact_sales f JOIN dim_customer c ON f.customer_key = c.customer_key GROUP BY customer_segment""",
    "shipping_performance": f"""SELECT shipping_mode, {_ORDERS},
  ROUND(AVG(shipping_delay_days), 2) + 0e0 AS average_shipping_delay, {_DELAYED} AS delayed_items,
  ROUND(100e0 * {_DELAYED} / COUNT(*), 2) AS delay_percentage
  FROM fact_sales f JOIN dim_shipping s ON f.shipping_key = s.shipping_key GROUP BY shipping_mode""",
    "profitable_products": f"""SELECT product_name, category_name, {_SALES_PROFIT}, {_MARGIN}
  FROM {_PRODUCT} {_BY_PRODUCT} ORDER BY total_profit DESC, p.product_key LIMIT 10""",
    "loss_products": f"""SELECT product_name, category_name, {_SALES_PROFIT}, {_MARGIN}
  FROM {_PRODUCT} {_BY_PRODUCT} ORDER BY total_profit ASC NULLS FIRST, p.product_key LIMIT 10""",
    "top_cities": f"""SELECT order_city, order_state, order_country, {_ORDERS}, {_SALES_PROFIT}
  FROM {_PLACE} GROUP BY order_city, order_state, order_country
  ORDER BY total_sales DESC, order_city, order_state, order_country LIMIT 10""",
    "discount_analysis": f"""SELECT category_name,
  ROUND(CAST(SUM(discount_amount) AS DOUBLE) / COUNT(discount_amount), 2) + 0e0 AS average_discount, {_SALES_PROFIT}
  FROM {_PRODUCT} GROUP BY category_name""",
    "shipping_delay": f"""SELECT shipping_delay_days, COUNT(*) AS order_items, {_SALES_PROFIT}
  FROM fact_sales GROUP BY shipping_delay_days""",
    "order_status": f"SELECT {_ORDERS}, {_SALES_PROFIT} FROM fact_sales",
}
_FACT_NULLS = " UNION ALL ".join(
    f"SELECT '{k}' AS key_column, COUNT(*) AS missing FROM fact_sales WHERE {k} IS NULL" for k in warehouse.FACT_KEYS
)
_DOUBLES = "CAST({0} AS DOUBLE) AS {0}"
_REPORT_COLUMNS = {
    "overall_performance": 7, "yearly_sales": 4, "monthly_sales": 5, "market_sales": 4, "region_sales": 4,
    "top_products": 6, "category_sales": 5, "customer_segments": 5, "shipping_performance": 5,
    "profitable_products": 5, "loss_products": 5, "top_cities": 6, "discount_analysis": 4, "shipping_delay": 4,
}
_TABLE_COLUMNS = {
    "dim_date": 8, "dim_customer": 6, "dim_product": 8, "dim_location": 8, "dim_shipping": 3, "fact_sales": 16,
}


def _unique(table: str, keys: str, label: str) -> str:
    null = " OR ".join(f"{k.strip()} IS NULL" for k in keys.split(","))
    return f"""SELECT '{label}' AS table_name, CAST(SUM(n) AS BIGINT) AS rows,
  CAST(coalesce(SUM(CASE WHEN {null} THEN n END), 0) AS BIGINT) AS null_keys,
  COUNT(*) FILTER (WHERE NOT ({null}) AND n > 1) AS duplicate_keys
  FROM (SELECT {keys}, COUNT(*) AS n FROM {table} GROUP BY {keys})"""


_REFERENCES = [
    ("customer_key", "dim_customer", "customer_key"), ("product_key", "dim_product", "product_key"),
    ("order_date_key", "dim_date", "date_key"), ("shipping_date_key", "dim_date", "date_key"),
    ("location_key", "dim_location", "location_key"), ("shipping_key", "dim_shipping", "shipping_key"),
]
_LABELS = "(SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"

ORACLE = {
    **{name: f"{_with(STAGING, sql)} SELECT * FROM {name}" for name, sql in DIM_SQL.items()},
    "fact_sales": f"""{STAR} SELECT * REPLACE ({
        ", ".join(_DOUBLES.format(c) for c in ("sales", "discount_amount", "revenue", "profit"))}) FROM fact_sales""",
    "incremental_fact_sales": f"""{LOADS} SELECT * REPLACE ({
        ", ".join(_DOUBLES.format(c) for c in ("sales", "discount_amount", "revenue", "profit"))}) FROM fact_sales""",
    "incremental_dim_customer": f"{LOADS} SELECT * FROM dim_customer",
    "incremental_dim_product": f"{LOADS} SELECT * FROM dim_product",
    "stable_customer_keys": f"""{STAR}, before AS (
  SELECT customer_id, row_number() OVER (ORDER BY min(row_id)) AS customer_key
  FROM staging WHERE order_datetime < '{testbed.LOADS[1]}' GROUP BY customer_id),
later AS (
  SELECT customer_id, (SELECT max(customer_key) FROM before) + row_number() OVER (ORDER BY min(row_id)) AS customer_key
  FROM staging WHERE customer_id NOT IN (SELECT customer_id FROM before) GROUP BY customer_id)
  SELECT k.customer_key, c.* EXCLUDE (customer_key)
  FROM dim_customer c JOIN (SELECT * FROM before UNION ALL SELECT * FROM later) k USING (customer_id)""",
    "rpt_period_sales": f"""{STAR} SELECT year, month, month_name, {_SALES_PROFIT} FROM {_DATE}
  WHERE {PERIOD} GROUP BY year, month, month_name""",
    "rpt_period_orders": f"""{STAR} SELECT year, {_ORDERS}, {_SALES_PROFIT} FROM {_DATE}
  WHERE {PERIOD} GROUP BY year""",
    "derived_measures": f"""{_with(STAGING)} SELECT row_id, order_id, shipping_delay_days,
  {_DOUBLES.format("discount_amount")}, {_DOUBLES.format("revenue")}, profit_margin FROM staging""",
    "shipping_flag": f"""{_with(STAGING)} SELECT row_id, shipping_delay_days,
  CASE WHEN shipping_delay_days > 0 THEN 'Delayed' ELSE 'On Time' END AS shipping_performance FROM staging""",
    "date_parts": f"SELECT o_orderkey, o_orderdate, {_parts('o_orderdate', 'order_')} FROM orders",
    "missing_keys": f"""{STAR} {_FACT_NULLS}
  UNION ALL SELECT 'quality', COUNT(*) FROM {_LABELS} WHERE quality IS NULL""",
    "null_fk_check": f"""{STAR} SELECT 'fact_sales' AS table_name, COUNT(*) AS invalid_records FROM fact_sales
  WHERE {" OR ".join(f"{k} IS NULL" for k in warehouse.FACT_KEYS)}
  UNION ALL SELECT 'documents', COUNT(*) FROM {_LABELS} WHERE quality IS NULL OR doc_id IS NULL""",
    "fk_orphans": STAR + " UNION ALL ".join(
        f""" SELECT '{fk}' AS key_column, COUNT(*) AS orphans FROM fact_sales f
  WHERE f.{fk} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{pk} = f.{fk})"""
        for fk, dim, pk in _REFERENCES
    ) + """ UNION ALL SELECT 'doc_id', COUNT(*) FROM documents d
  WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
    "key_uniqueness": STAR + " " + " UNION ALL ".join(
        [
            _unique("dim_date", "date_key", "dim_date"),
            _unique("dim_customer", "customer_id", "dim_customer"),
            _unique("dim_product", "product_id", "dim_product"),
            _unique("dim_location", "location_key", "dim_location"),
            _unique("dim_location", ", ".join(warehouse.LOCATION), "dim_location places"),
            _unique("dim_shipping", "shipping_key", "dim_shipping"),
            _unique("dim_shipping", ", ".join(warehouse.SHIPPING), "dim_shipping modes"),
            _unique("fact_sales", "sales_key", "fact_sales"),
            _unique("fact_sales", "order_id, order_item_id", "fact_sales order items"),
            _unique(_LABELS, "quality", "documents by label"),
        ]
    ),
    "row_reconcile": f"""{STAR} SELECT *, CASE WHEN staging_rows = fact_rows THEN 'PASSED' ELSE 'WARNING' END AS status
  FROM (SELECT (SELECT COUNT(*) FROM staging) AS staging_rows, (SELECT COUNT(*) FROM fact_sales) AS fact_rows)""",
    "warehouse_counts": STAR + " " + " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, COUNT(*) AS rows FROM {t}" for t in warehouse.TABLES
    ),
    "stage_audit": STAR + " " + " UNION ALL ".join(
        f"SELECT '{t}' AS stage, COUNT(*) AS rows, {n} AS columns FROM {t}"
        for t, n in [*RAW_COLUMNS.items(), ("staging", 43), ("fact_sales", 16)]
    ),
    "export_tables": STAR + " " + " UNION ALL ".join(
        f"SELECT '{t}' AS name, COUNT(*) AS rows, {n} AS columns, 'ok' AS status FROM {t}"
        for t, n in _TABLE_COLUMNS.items()
    ) + " UNION ALL SELECT 'dim_unknown', NULL, NULL, 'failed'",
    "run_reports": STAR + " " + " UNION ALL ".join(
        f"SELECT '{r}' AS name, COUNT(*) AS rows, {n} AS columns, 'ok' AS status FROM ({REPORT_SQL[r]})"
        for r, n in _REPORT_COLUMNS.items()
    ),
    **{f"rpt_{name}": f"{STAR} {sql}" for name, sql in REPORT_SQL.items()},
}
