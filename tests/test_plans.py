"""Physical plans: what must be in them at scale and what must never be."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from test_copies import shuffled_bytes

from tidemill import catalog, storage
from tidemill.operators import eda, keys, load
from tidemill.plans import reports, testbed

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# html_tables is the one Python function of the library.
PYTHON = {"html_tables"}


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_no_cross_join_and_no_row_python(spark, name):
    text = plan(catalog.queries()[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text
    assert ("MapInPandas" in text) == (name in PYTHON)


def test_filters_reach_the_scan(spark):
    assert "GreaterThan(l_extendedprice,10000.0)" in plan(catalog.queries()["filter_gt"](spark, SF))
    # the query's longer filter list is cut in the printed plan, so the operator is looked at by itself
    history, _ = load.historical_split(testbed.table(spark, SF, "orders"), "o_orderdate", "1998-01-01")
    assert "LessThan(o_orderdate" in plan(history)
    events = testbed.table(spark, SF, "events")
    pushed = re.search(r"PushedFilters: \[(.*?)\]", plan(eda.iqr_filter(events, "value"))).group(1)
    assert "GreaterThanOrEqual(value" in pushed and "LessThanOrEqual(value" in pushed


def test_dated_reports_read_the_years_they_need(spark):
    """A condition on the calendar prunes the fact's partitions at run time."""
    tables = testbed.tables(spark, SF)
    period = F.expr("full_date BETWEEN '1997-04-01' AND '1997-06-30'")
    for report in (reports.yearly_sales, reports.monthly_sales):
        scans = re.findall(r"PartitionFilters: \[(.*?)\]", plan(report(tables, period)))
        assert any("order_year" in scan and "dynamicpruning" in scan for scan in scans), report.__name__
    whole = reports.monthly_sales(tables).filter("year = 1997 AND month BETWEEN 4 AND 6").collect()
    assert whole and reports.monthly_sales(tables, period).collect() == whole


COUNTED = ["overall_performance", "yearly_sales", "market_sales", "region_sales", "customer_segments",
           "shipping_performance", "top_cities"]


@pytest.mark.parametrize("name", COUNTED)
def test_distinct_orders_do_not_shuffle_ids(spark, name):
    """Bitmaps are shuffled: no Expand, no id in an exchange, and no more bytes for more rows of an order."""
    tables = testbed.tables(spark, SF)
    text = plan(reports.REPORTS[name](tables))
    assert "Expand" not in text and "bitmap_construct_agg" in text
    assert not re.search(r"Exchange hashpartitioning\([^)]*order_(id|number)#", text)
    fact = storage.materialize(tables["fact_sales"].coalesce(2), "fact")
    often = storage.materialize(fact.withColumn("n", F.explode(F.array(*[F.lit(i) for i in range(5)]))).drop("n").coalesce(2), "often")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1g")
    try:
        one, five = (shuffled_bytes(reports.REPORTS[name]({**tables, "fact_sales": f})) for f in (fact, often))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert five <= 1.2 * one + 2000


def test_reports_share_their_scans_of_the_fact(spark):
    """Two scans answer thirteen reports; the fourteenth reads the fact for ten products."""
    tables = testbed.tables(spark, SF)
    shared = reports.shared(tables)
    for name, report in {**reports.REPORTS, "order_status": reports.order_status}.items():
        reads_fact = any("/fact_sales/" in file for file in report(shared).inputFiles())
        assert reads_fact == (name == "top_products"), name
        one, other = (report(t) for t in (tables, shared))
        assert one.schema.simpleString() == other.schema.simpleString()
        assert one.collect() == other.collect(), name


def test_bitmaps_of_loads_add_up(spark):
    tables = testbed.tables(spark, SF)
    fact = tables["fact_sales"].join(tables["dim_shipping"], "shipping_key")
    halves = [fact.filter(f"sales_key % 2 = {i}") for i in (0, 1)]
    bits = [reports.order_bitmaps(half, ["shipping_mode"]) for half in halves]
    merged = bits[0].union(bits[1]).groupBy("shipping_mode", "bucket").agg(F.bitmap_or_agg("orders").alias("orders"))
    got = merged.groupBy("shipping_mode").agg(F.sum(F.bitmap_count("orders")))
    assert sorted(map(tuple, got.collect())) == sorted(
        map(tuple, fact.groupBy("shipping_mode").agg(F.count_distinct("order_id")).collect())
    )


def test_reports_read_only_their_columns(spark):
    tables = testbed.tables(spark, SF)
    fact_scan = re.findall(r"ReadSchema: struct<(.*?)>", plan(reports.discount_analysis(tables)))[0]
    assert set(re.findall(r"(\w+):", fact_scan)) == {"product_key", "sales", "discount_amount", "profit"}


def test_product_reports_aggregate_before_the_join(spark):
    text = plan(reports.profitable_products(testbed.tables(spark, SF)))
    assert "TakeOrderedAndProject" in text
    join = text.index("HashJoin") if "HashJoin" in text else text.index("SortMergeJoin")
    assert "HashAggregate" in text[join:]


def test_large_dimensions_take_the_shuffle_join(spark):
    tables = testbed.tables(spark, SF)
    expected = {n: sorted(map(tuple, r(tables).collect())) for n, r in reports.REPORTS.items()}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in plan(reports.category_sales(tables))
        for name, report in reports.REPORTS.items():
            assert sorted(map(tuple, report(tables).collect())) == expected[name], name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_key_is_split_in_the_lookup_join(spark):
    """A third of the rows share one key; with no broadcast the join splits their partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2.0",
    }
    facts = spark.range(60000).repartition(8).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000).alias("product_id"), "id"
    )
    facts = storage.materialize(facts, "facts")
    dim = storage.materialize(spark.range(5000).select(F.col("id").alias("product_id"), (F.col("id") + 1).alias("product_key")), "dim")
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        joined = keys.lookup_key(facts, dim, {"product_id": "product_id"}, "product_key")
        rows = joined.collect()
        assert "skew=true" in plan(joined)
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert len(rows) == 60000 and all(r["product_key"] == r["product_id"] + 1 for r in rows)


def test_row_numbers_do_not_shuffle_rows(spark):
    assert "Exchange hashpartitioning" not in plan(keys.read_with_row_id(spark, f"{SF}/lineitem.parquet"))


def test_row_numbers_with_many_files_do_not_shuffle_rows(spark, tmp_path, monkeypatch):
    """More files than one broadcast takes are numbered step by step, and each step reads its own files."""
    path = str(tmp_path / "items")
    testbed.table(spark, SF, "lineitem").repartition(23).write.parquet(path)
    expected = keys.read_with_row_id(spark, path)
    rows = sorted(map(str, expected.collect()))
    monkeypatch.setattr(keys, "BROADCAST_BYTES", 5 * 32)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        numbered = keys.read_with_row_id(spark, path)
        text = plan(numbered)
        assert "Exchange hashpartitioning" not in text and "SortMergeJoin" not in text
        assert text.count("BroadcastHashJoin") >= 5
        assert sorted(map(str, numbered.collect())) == rows
        n = numbered.count()
        assert numbered.agg(F.min("row_id"), F.max("row_id"), F.count_distinct("row_id")).first() == (1, n, n)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_small_batches_do_not_shuffle_the_target(spark):
    orders = testbed.table(spark, SF, "orders")
    text = plan(load.anti_join_new(orders.limit(3), orders, ["o_orderkey"]))
    assert "SortMergeJoin" not in text and "GreaterThanOrEqual(o_orderkey" in text


def test_no_unpartitioned_window_over_rows(spark):
    """The fact is numbered by position and dimensions by sorted partitions, never by one task."""
    for name in ("fact_sales", "dim_customer", "dim_product"):
        assert "Window" not in plan(catalog.queries()[name](spark, SF))
