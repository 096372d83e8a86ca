"""The small pipelines on their literal inputs."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tidemill.operators.load import historical_split
from tidemill.plans import etl, reports
from tidemill.plans.audit import RunAudit
from tidemill.sources import files
from tidemill.storage import VersionedTables
from tidemill.streaming import arrivals


def test_employees_load_once(spark, tmp_path):
    (tmp_path / "one.csv").write_text("id,name,salary,age\n21,Oda,3100,44\n22,Per,2900,19\n23,Wrong,-1,15\n")
    (tmp_path / "two.csv").write_text("id,name,salary,age\n24,Ulf,4100,60\n21,Late,1,30\n")
    store = VersionedTables(spark, str(tmp_path / "db"))
    paths = [str(tmp_path / "one.csv"), str(tmp_path / "two.csv")]
    bad = etl.employees(spark, paths, store).collect()
    assert [(r["id"], r["reason"]) for r in bad] == [(23, "salary,age")]
    etl.employees(spark, paths, store)
    got = sorted((r["id"], r["name"]) for r in store.read("employees").collect())
    assert got == [(21, "Oda"), (22, "Per"), (24, "Ulf")]


def test_employees_keep_the_first_file_of_the_list(spark, tmp_path):
    (tmp_path / "z.csv").write_text("id,name,salary,age\n5,From z,10,30\n")
    (tmp_path / "a.csv").write_text("id,name,salary,age\n5,From a,10,30\n")
    store = VersionedTables(spark, str(tmp_path / "db"))
    etl.employees(spark, [str(tmp_path / "z.csv"), str(tmp_path / "a.csv")], store)
    assert [r["name"] for r in store.read("employees").collect()] == ["From z"]


def test_json_employees_are_replaced(spark, tmp_path):
    path = tmp_path / "staff.json"
    path.write_text(json.dumps([{"id": 31, "name": "Ines", "salary": 250000}, {"id": 32, "name": "Jon", "salary": 90000}]))
    store = VersionedTables(spark, str(tmp_path / "db"))
    for _ in range(2):
        etl.json_employees(spark, str(path), store)
    rows = store.read("json_employees").collect()
    assert sorted((r["id"], r["salary_lakh"]) for r in rows) == [(31, 2.5), (32, 0.9)]


CUSTOMERS = [(1, "Oda", "Bergen"), (2, "Per", "Turku"), (3, "Ulf", "Ribe")]
PRODUCTS = [(51, "tent", "camping", 900), (52, "stove", "camping", 250), (53, "rope", "climbing", 40)]
ORDERS = [
    (701, 1, 51, 1, "2021-03-01"), (702, 2, 53, 10, "2021-03-05"), (703, 3, 52, 2, "2021-03-09"),
    (704, 1, 53, 5, "2021-03-12"),
]
ORDER = "order_id int, customer_id int, product_id int, quantity int, order_date string"


def order_frame(spark, rows):
    return spark.createDataFrame(rows, ORDER).withColumn("order_date", F.to_date("order_date"))


def test_ecommerce_with_a_late_order(spark, tmp_path):
    store = VersionedTables(spark, str(tmp_path))
    customers = spark.createDataFrame(CUSTOMERS, "customer_id int, name string, city string")
    products = spark.createDataFrame(PRODUCTS, "product_id int, product string, category string, price int")
    dirty = order_frame(spark, [*ORDERS, ORDERS[0], (799, 1, 51, 0, "2021-03-01"), (798, 1, 51, 1, None)])
    enriched = etl.enrich_orders(dirty, products, customers).collect()
    assert {r["order_id"]: r["total_amount"] for r in enriched} == {
        701: 900, 702: 400, 703: 500, 704: 200,
    }
    orders = etl.clean_frame(dirty).filter("quantity > 0")
    for name, df in {"orders": orders, "products": products, "customers": customers}.items():
        store.replace(name, df)
    history, _ = historical_split(store.read("orders"), "order_date", "2021-03-09")
    assert sorted(r["order_id"] for r in history.collect()) == [701, 702]
    late = order_frame(spark, [(705, 2, 51, 2, "2021-03-15")])
    for _ in range(2):
        etl.arriving_orders(store, late)
    assert store.read("orders").count() == 5
    report = {r["category"]: (r["total_quantity"], r["total_sales"]) for r in etl.ecommerce_report(store).collect()}
    assert report == {"camping": (5, 3200), "climbing": (15, 600)}


def test_profiles(spark, tmp_path):
    path = tmp_path / "users.json"
    users = [{"id": i, "name": f"n{i}", "email": f"e{i}", "company": {"name": f"c{i}", "bs": "x"}} for i in range(1, 11)]
    path.write_text(json.dumps(users))
    landed = files.extract_json(spark, str(path), "id int, name string, email string, company struct<name: string>")
    cities = spark.createDataFrame([(i, f"city{i}") for i in range(1, 11)], "id int, city string")
    out = str(tmp_path / "profiles")
    merged = etl.profiles(landed, cities, out)
    assert merged.columns == ["id", "name", "email", "company", "city"] and merged.count() == 10
    assert files.read_csv(spark, out).count() == 10
    assert etl.profiles(landed.limit(0), cities) is None


def test_sales_walkthrough(spark):
    sales = spark.createDataFrame(
        [
            (1, "tent", "camping", 12000, 9), (2, "stove", "camping", 10000, 8), (3, "rope", "climbing", 700, 9),
            (4, "axe", "climbing", 15300, 7), (4, "axe", "climbing", 15300, 7), (5, "mat", "camping", 500, 6),
        ],
        "product_id int, product string, category string, sales int, customer_id int",
    )
    customers = spark.createDataFrame([(7, "Oda", "Bergen"), (8, "Per", "Turku"), (9, "Ulf", "Ribe")], "customer_id int, customer_name string, city string")
    got = etl.sales_walkthrough(sales, customers)
    assert sorted(r["product"] for r in got["large_sales"].collect()) == ["axe", "axe", "tent"]
    assert dict(map(tuple, got["totals"].collect())) == {"camping": 22500, "climbing": 31300}
    assert dict(map(tuple, got["averages"].collect())) == {"camping": 7500.0, "climbing": pytest.approx(31300 / 3)}
    assert got["distinct"].count() == 5 and got["joined"].count() == 5
    assert got["joined"].columns == ["product", "category", "sales", "customer_name", "city"]


def test_run_log(spark):
    audit = RunAudit(spark, "p")
    audit.record("extract", spark.createDataFrame([(1, "p"), (2, "q"), (3, "r")], "id int, name string"))
    audit.check("nulls", 0)
    audit.finish()
    rows = [(r["step"], r["stage"], r["status"], r["rows"], r["columns"]) for r in audit.table().collect()]
    assert sorted(rows) == [
        (0, "initialised", "ok", None, None), (1, "extract", "ok", 3, 2), (2, "nulls", "PASSED", 0, None),
        (3, "finished", "success", None, None),
    ]


def test_a_failed_run_leaves_its_log(spark, tmp_path):
    path = str(tmp_path / "log")
    with pytest.raises(ValueError), RunAudit(spark, "p", path) as audit:
        audit.record("extract", spark.range(3))
        raise ValueError("gate")
    rows = spark.read.parquet(path).orderBy("step").collect()
    assert [(r["stage"], r["status"]) for r in rows] == [
        ("initialised", "ok"), ("extract", "ok"), ("failed: ValueError: gate", "failed"),
    ]


def test_run_log_with_a_warning(spark):
    audit = RunAudit(spark, "p")
    audit.check("rows", 3)
    audit.finish()
    assert {r["stage"]: r["status"] for r in audit.table().collect()}["finished"] == "warning"


def arrive(spark, tmp_path, **options):
    return arrivals.stream_new_arrivals(
        spark, str(tmp_path / "in"), order_frame(spark, ORDERS).schema, ["order_id"], ["order_date"],
        str(tmp_path / "target"), str(options.pop("checkpoint", tmp_path / "cp")), **options,
    )


def test_arrivals_load_each_key_once(spark, tmp_path):
    schema = order_frame(spark, ORDERS).schema
    arrivals.backfill(order_frame(spark, ORDERS[:3]), str(tmp_path / "target"), ["order_id"])
    late = (706, 2, 51, 1, "2021-08-06")
    twice = (706, 9, 9, 9, "2021-08-07")  # in one file with the other row of its key, hence in one batch
    order_frame(spark, [*ORDERS[2:], late, twice]).coalesce(1).write.parquet(str(tmp_path / "in"))
    assert arrive(spark, tmp_path, files_per_batch=1) == 1

    def stored():
        return sorted(map(tuple, arrivals.read_target(spark, str(tmp_path / "target"), schema).select(*schema.names).collect()))

    want = sorted(map(tuple, order_frame(spark, [*ORDERS, late]).collect()))
    assert stored() == want
    order_frame(spark, [(701, 7, 7, 7, "2021-09-01")]).write.mode("append").parquet(str(tmp_path / "in"))
    arrive(spark, tmp_path)  # a known key is ignored
    assert stored() == want
    arrive(spark, tmp_path, checkpoint=tmp_path / "cp2")  # a new stream re-reads every file, nothing is added
    assert stored() == want


def test_every_micro_batch_is_counted(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i in range(12):
        (tmp_path / "in" / f"f{i}.json").write_text(json.dumps({"id": i, "seq": 1, "name": "x"}))
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    try:
        n = arrivals.stream_new_arrivals(
            spark, str(tmp_path / "in"), files._as_schema("id int, seq int, name string"), ["id"], ["seq"],
            str(tmp_path / "target"), str(tmp_path / "check"), fmt="json", files_per_batch=1,
        )
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert n == 12


def test_arrivals_without_history(spark, tmp_path):
    order_frame(spark, ORDERS).write.parquet(str(tmp_path / "in"))
    arrive(spark, tmp_path)
    schema = order_frame(spark, ORDERS).schema
    assert arrivals.read_target(spark, str(tmp_path / "target"), schema).count() == len(ORDERS)


def test_category_report_with_a_hot_product(spark):
    rows = [(101 if i % 3 else 102 + i % 2, 1) for i in range(3000)]
    orders = spark.createDataFrame(rows, "product_id int, quantity int").repartition(6)
    products = spark.createDataFrame([(101, "a", 2), (102, "b", 3), (103, "b", 4)], "product_id int, category string, price int")
    report = reports.category_sales_report(orders, products, "product_id", "quantity", "price", "category")
    assert {r[0]: tuple(r)[1:] for r in report.collect()} == {"a": (2000, 4000), "b": (1000, 3500)}
