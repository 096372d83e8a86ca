"""Star schema and reports: invariants on the driver tables, literals on a raw file."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemill.operators import quality
from tidemill.plans import reports, supply_chain, testbed, warehouse
from tidemill.sources import files, sinks
from tidemill.storage import VersionedTables

SF = "/root/testdata/sf0.001"

HEADER = [*supply_chain.RAW_COLUMNS, *supply_chain.SENSITIVE_COLUMNS]


def raw_row(item, order, customer, product, mode="Standard Class", scheduled=4, real=5, quantity=2, rate="0.1",
            profit="10.5", name="Smart watch", category="Sporting Goods", latitude="18.25", ordered="1/31/2018 22:56",
            city="México", price="59.99000168"):
    values = {
        "Order Id": order, "Order Item Id": item, "Customer Id": customer, "Customer City": "Caguas",
        "Customer State": "PR", "Customer Country": "Puerto Rico", "Customer Segment": "Consumer",
        "Product Card Id": product, "Product Name": name, "Product Category Id": 73, "Category Name": category,
        "Department Id": 2, "Department Name": "Fitness", "Product Price": price, "Market": "LATAM",
        "Order City": city, "Order State": "s", "Order Country": "c", "Order Region": "r", "Latitude": latitude,
        "Longitude": "-66.03", "Shipping Mode": mode, "Days for shipping (real)": real,
        "Days for shipment (scheduled)": scheduled, "order date (DateOrders)": ordered,
        "shipping date (DateOrders)": "2/3/2018 22:56", "Order Item Product Price": price,
        "Order Item Quantity": quantity, "Order Item Discount Rate": rate, "Sales": "119.98", "Order Profit Per Order": profit,
    }
    return [str(values.get(c, "secret")) for c in HEADER]


def write_raw(path, rows):
    lines = [",".join(HEADER), *[",".join(f'"{v}"' for v in r) for r in rows]]
    path.write_bytes(("\n".join(lines) + "\n").encode("latin1"))
    return str(path)


ROWS = [
    raw_row(1, 10, 500, 1360),
    raw_row(2, 10, 500, 365, name=" As Seen on  TV! ", mode="First Class", scheduled=1, real=2),
    raw_row(3, 11, 501, 1360, name="renamed later", quantity=1, profit="-4.25", mode="Same Day", scheduled=0, real=0),
    raw_row(4, 12, 500, 1360, latitude="NA", quantity=0, city="México"),
]


def test_raw_file_to_star(spark, tmp_path):
    t = supply_chain.run(spark, write_raw(tmp_path / "raw.csv", ROWS), str(tmp_path / "out"))
    staging = t["staging"].orderBy("row_id").collect()
    assert [r["row_id"] for r in staging] == [1, 2, 3, 4]
    assert [r["order_item_id"] for r in staging] == [1, 2, 3, 4]
    first = staging[0]
    assert first["order_datetime"] == datetime(2018, 1, 31, 22, 56) and first["order_city"] == "México"
    assert (first["order_year"], first["order_month_name"], first["order_quarter"]) == (2018, "January", "Q1")
    assert (first["shipping_delay_days"], first["shipping_performance"]) == (1, "Delayed")
    assert staging[2]["shipping_performance"] == "On Time"
    assert (first["discount_amount"], first["revenue"]) == (Decimal("11.998000336"), Decimal("107.982003024"))
    assert first["profit_margin"] == pytest.approx(10.5 / 107.982 * 100)
    assert staging[3]["profit_margin"] == 0.0 and staging[3]["latitude"] is None
    assert not set(supply_chain.SENSITIVE_COLUMNS) & set(t["staging"].columns)

    products = {r["product_key"]: (r["product_id"], r["product_name"]) for r in t["dim_product"].collect()}
    assert products == {1: (1360, "Smart watch"), 2: (365, "As Seen on  TV!")}
    shipping = sorted(tuple(r) for r in t["dim_shipping"].collect())
    assert shipping == [(1, "Standard Class", 4), (2, "First Class", 1), (3, "Same Day", 0)]
    assert t["dim_location"].count() == 2 and t["dim_date"].count() == 2
    fact = {r["sales_key"]: r for r in t["fact_sales"].collect()}
    assert [fact[i]["product_key"] for i in range(1, 5)] == [1, 2, 1, 1]
    assert [fact[i]["location_key"] for i in range(1, 5)] == [1, 1, 1, 2]
    assert (fact[1]["order_date_key"], fact[1]["shipping_date_key"]) == (20180131, 20180203)

    stages = {r["stage"]: (r["status"], r["rows"]) for r in t["audit"].collect()}
    assert stages["fact_sales"] == ("ok", 4) and stages["finished"] == ("success", None)
    assert stages["null foreign keys"] == stages["staging and fact rows"] == ("PASSED", 0)
    assert sinks.success_line(t["quality_audit"]) == "4/4"
    assert sinks.success_line(t["report_audit"]) == "14/14" and sinks.success_line(t["export_audit"]) == "6/6"
    exported = files.read_csv(spark, str(tmp_path / "out/export/dim_product"))
    assert exported.columns == t["dim_product"].columns and exported.count() == 2
    performance = files.read_csv(spark, str(tmp_path / "out/reports/overall_performance")).first()
    assert (performance["total_orders"], performance["total_order_items"], performance["total_quantity"]) == (3, 4, 5)


def test_dates_do_not_depend_on_the_time_zone(spark, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        cleaned = supply_chain.clean_raw(supply_chain.ingest(spark, write_raw(tmp_path / "raw.csv", ROWS)))
        store = VersionedTables(spark, str(tmp_path / "out"))
        staging = store.replace("staging", supply_chain.stage(store.replace("cleaned", cleaned)))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    row = staging.orderBy("row_id").first()
    assert row["order_datetime"] == datetime(2018, 1, 31, 22, 56) and row["order_day"] == 31
    assert warehouse.dim_date(staging).count() == 2


def test_quality_reports_of_the_raw_file(spark, tmp_path):
    cleaned = supply_chain.clean_raw(
        supply_chain.ingest(spark, write_raw(tmp_path / "raw.csv", [*ROWS, ROWS[0], raw_row(9, 9, 9, 9, ordered="soon")]))
    )
    found = supply_chain.quality_reports(cleaned)
    assert tuple(found["duplicates"].first()) == (6, 1)
    assert {r[0]: r[1] for r in found["invalid_dates"].collect()} == {
        "order date (DateOrders)": 1, "shipping date (DateOrders)": 0,
    }
    assert {r[0]: r[1] for r in found["missing_values"].collect()} == {"order date (DateOrders)": 1, "Latitude": 1}


def test_invalid_dates_stop_the_build(spark, tmp_path):
    path = write_raw(tmp_path / "raw.csv", [*ROWS, raw_row(9, 9, 9, 9, ordered="soon")])
    with pytest.raises(quality.GateFailed, match="invalid dates: 1"):
        supply_chain.run(spark, path, str(tmp_path / "out"))
    assert not VersionedTables(spark, str(tmp_path / "out/warehouse")).exists("fact_sales")


def test_missing_keys_stop_the_build(spark, tmp_path, monkeypatch):
    staging = testbed.staging(spark, SF)
    monkeypatch.setitem(
        warehouse.DIMENSIONS, "dim_shipping", lambda s, known=None: warehouse.dim_shipping(s, known).filter("shipping_mode <> '1-URGENT'")
    )
    store = VersionedTables(spark, str(tmp_path))
    with pytest.raises(quality.GateFailed, match="missing dimension keys"):
        warehouse.build_warehouse(staging, store)
    assert not store.exists("fact_sales") and not store.exists("dim_customer")


def test_a_failed_rebuild_leaves_the_whole_star_as_it_was(spark, tmp_path):
    staging = testbed.staging(spark, SF)
    store = VersionedTables(spark, str(tmp_path))
    warehouse.build_warehouse(staging, store)

    def customers():
        t = store.read_together(warehouse.TABLES)
        joined = t["fact_sales"].join(t["dim_customer"], "customer_key")
        return sorted(map(tuple, joined.select("sales_key", "customer_id").collect()))

    before, paths = customers(), {n: store.path(n) for n in warehouse.TABLES}
    broken = staging.withColumn("order_datetime", F.when(F.col("row_id") > 10, F.col("order_datetime")))
    with pytest.raises(quality.GateFailed):
        warehouse.build_warehouse(broken, store)
    moved = staging.withColumn("row_id", -F.col("row_id"))
    lost = {**warehouse.DIMENSIONS, "dim_shipping": lambda s, known=None: warehouse.dim_shipping(s, known).limit(1)}
    with pytest.MonkeyPatch.context() as patch, pytest.raises(quality.GateFailed):
        patch.setattr(warehouse, "DIMENSIONS", lost)
        warehouse.build_warehouse(moved, store)
    assert {n: store.path(n) for n in warehouse.TABLES} == paths and customers() == before
    warehouse.build_warehouse(moved, store)
    assert all(store.path(n) != paths[n] for n in warehouse.TABLES)


def test_increments_equal_one_load_and_repeat_without_effect(spark, tmp_path, monkeypatch):
    """Rows loaded part by part get the keys of one load, also when folders are joined in between."""
    staging, whole = testbed.staging(spark, SF), testbed.tables(spark, SF)
    store = VersionedTables(spark, str(tmp_path))
    n = staging.count()
    warehouse.build_warehouse(staging.filter(F.col("row_id") <= n // 4), store)
    folders = len(store.parts("fact_sales", store.current("fact_sales")))
    monkeypatch.setattr(warehouse, "MAX_FOLDERS", 2)
    for upto in (n // 2, n // 2, n):
        tables = warehouse.extend_warehouse(staging.filter(F.col("row_id") <= upto), store)
    assert folders == 1 and store.current("fact_sales") == 3
    again = store.read_together(warehouse.TABLES)
    for name in warehouse.TABLES:
        key = whole[name].columns
        expected = sorted(map(str, whole[name].select(*key).collect()))
        for found in (tables[name], again[name]):
            assert sorted(map(str, found.select(*key).collect())) == expected, name


def test_known_keys_stay_over_a_rebuild(spark, tmp_path):
    """A member that is missing for one build has its key again in the next, in a rebuild or an increment."""
    staging = testbed.staging(spark, SF)
    store = VersionedTables(spark, str(tmp_path))
    some = F.col("customer_id") % 3 == 0

    def keys(tables):
        return {r["customer_id"]: r["customer_key"] for r in tables["dim_customer"].collect()}

    first = keys(warehouse.build_warehouse(staging, store))
    fewer = keys(warehouse.build_warehouse(staging.filter(some), store))
    assert fewer == {c: k for c, k in first.items() if c % 3 == 0}
    assert keys(warehouse.extend_warehouse(staging, store)) == first
    assert keys(warehouse.build_warehouse(staging.withColumn("row_id", -F.col("row_id")), store)) == first


def test_null_natural_keys_are_found(spark):
    fact = spark.createDataFrame([(1, None), (2, 7), (3, 8)], "n int, id int")
    dim = spark.createDataFrame([(10, None), (11, 7)], "k int, id int")
    from tidemill.operators.keys import lookup_key

    got = lookup_key(fact, dim, {"id": "id"}, "k")
    assert sorted((r["n"], r["k"]) for r in got.collect()) == [(1, 10), (2, 11), (3, None)]


def test_null_tokens_and_failed_casts_are_reported(spark):
    raw = spark.createDataFrame([("NA", "2.0", "x"), ("b", "2.5", "3"), ("", "7", "4")], "a string, b string, c string")
    typed = raw.select(supply_chain.typed(F.col("b"), "int").alias("b"), supply_chain.typed(F.col("c"), "bigint").alias("c"))
    assert [tuple(r) for r in typed.collect()] == [(2, None), (None, 3), (7, 4)]


@pytest.fixture(scope="module")
def star(spark):
    return testbed.tables(spark, SF)


def total(df, column):
    return df.agg(F.sum(column)).first()[0]


def test_totals_agree_between_reports(star):
    overall = reports.overall_performance(star).first()
    for name in ("yearly_sales", "market_sales", "region_sales", "customer_segments", "shipping_performance"):
        assert total(reports.REPORTS[name](star), "total_orders") == overall["total_orders"], name
    for name in ("yearly_sales", "monthly_sales", "market_sales", "region_sales", "customer_segments", "category_sales",
                 "discount_analysis", "shipping_delay"):
        report = reports.REPORTS[name](star)
        slack = 0.006 * report.count()
        assert total(report, "total_sales") == pytest.approx(overall["total_sales"], abs=slack), name
        assert total(report, "total_profit") == pytest.approx(overall["total_profit"], abs=slack), name
    delays = reports.shipping_delay(star)
    assert total(delays, "order_items") == overall["total_order_items"] == star["fact_sales"].count()
    assert total(delays.filter("shipping_delay_days > 0"), "order_items") == total(
        reports.shipping_performance(star), "delayed_items"
    )


def test_keys_are_dense(star):
    for table, key in [("dim_customer", "customer_key"), ("dim_product", "product_key"), ("dim_location", "location_key"),
                       ("dim_shipping", "shipping_key"), ("fact_sales", "sales_key")]:
        n = star[table].count()
        assert tuple(star[table].agg(F.min(key), F.max(key), F.count_distinct(key)).first()) == (1, n, n), table


def test_reports_are_ordered(star):
    sales = [r["total_sales"] for r in reports.market_sales(star).collect()]
    assert sales == sorted(sales, reverse=True)
    assert [r["total_profit"] for r in reports.loss_products(star).collect()] == sorted(
        r["total_profit"] for r in reports.loss_products(star).collect()
    )


def test_sql_over_registered_views(spark, star):
    warehouse.register_views({k: v for k, v in star.items() if k != "staging"})
    row = spark.sql(
        "SELECT count(*) AS n FROM fact_sales f JOIN dim_date d ON f.order_date_key = d.date_key"
    ).first()
    assert row["n"] == star["fact_sales"].count()


def test_products_that_share_a_name_stay_apart(spark):
    tables = {
        "fact_sales": spark.createDataFrame(
            [(1, 1, 1, Decimal(5), Decimal(1), Decimal(1)), (2, 2, 1, Decimal(7), Decimal(2), Decimal(1))],
            "product_key long, order_id long, quantity int, sales decimal(18,4), profit decimal(18,4), discount_amount decimal(18,4)",
        ),
        "dim_product": spark.createDataFrame(
            [(1, "watch", "Electronics", 13), (2, "watch", "Electronics", 37)],
            "product_key long, product_name string, category_name string, category_id long",
        ),
    }
    assert [r["total_sales"] for r in reports.top_products(tables).collect()] == [7.0, 5.0]
    assert [tuple(r) for r in reports.category_sales(tables).collect()] == [("Electronics", 2, 2, 12.0, 3.0)]
    assert [tuple(r) for r in reports.discount_analysis(tables).collect()] == [("Electronics", 1.0, 12.0, 3.0)]


def test_negative_zero_average_is_printed_as_zero(spark):
    tables = {
        "fact_sales": spark.createDataFrame(
            [(1, i, -1 if i == 0 else 0) for i in range(1000)], "shipping_key long, order_number long, shipping_delay_days int"
        ),
        "dim_shipping": spark.createDataFrame([(1, "Standard Class")], "shipping_key long, shipping_mode string"),
    }
    row = reports.shipping_performance(tables).first()
    assert str(row["average_shipping_delay"]) == "0.0" and row["delay_percentage"] == 0.0
