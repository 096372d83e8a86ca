"""What a build shuffles and writes: bounded by the columns and rows it needs."""

import os
import re
import time

import pytest
from pyspark.sql import functions as F

from tidemill import catalog
from tidemill.catalog import pipelines
from tidemill.operators import keys, load
from tidemill.plans import reports, supply_chain, testbed, warehouse
from tidemill.sources import sinks
from tidemill.storage import VersionedTables, join_side, materialize, scratch_path, shared_dir

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_names_of_places_are_not_shuffled(spark, no_broadcast):
    """The items pass through two exchanges, with source columns only."""
    rows = testbed.cleaned(spark, SF)
    shuffled = re.findall(r"Exchange hashpartitioning\((?:product_id|order_id)#", plan(rows))
    assert len(shuffled) == 4
    below = plan(rows).split("Exchange hashpartitioning(product_id#", 1)[1]
    assert "CCity_" not in below and "State_" not in below and "CCity_" in plan(rows)


def test_only_numbers_of_the_fact_are_shuffled(spark, no_broadcast):
    """Wide natural keys are looked up first, and no year is brought together."""
    tables = testbed.tables(spark, SF)
    staging = testbed.staging(spark, SF)
    text = plan(warehouse.fact_sales(staging, tables))
    assert "rebalance" not in text.lower()
    projected = text.split("Exchange hashpartitioning(coalesce(customer_id#", 1)[1].split("\n")[1]
    assert "Project [" in projected and "AS order_date_key" in projected
    assert not any(wide in projected for wide in ("market", "order_city", "order_region", "shipping_mode"))


def test_staging_does_not_wait_for_the_star(spark, tmp_path):
    for name in ("region", "nation", "customer", "part", "orders", "lineitem"):
        os.symlink(f"{SF}/{name}.parquet", tmp_path / f"{name}.parquet")
    before = len(testbed._BUILT)
    assert catalog.queries()["derived_measures"](spark, str(tmp_path)).count() > 0
    assert len(testbed._BUILT) == before
    assert testbed.tables(spark, str(tmp_path))["staging"].inputFiles() == testbed.staging(spark, str(tmp_path)).inputFiles()


def test_staging_by_itself_still_refuses_invalid_dates(spark, tmp_path):
    for name in ("region", "nation", "customer", "part", "orders"):
        os.symlink(f"{SF}/{name}.parquet", tmp_path / f"{name}.parquet")
    items = testbed.table(spark, SF, "lineitem")
    broken = F.when(F.col("l_linenumber") > 1, F.col("l_shipdate")).alias("l_shipdate")
    items.select(*[broken if c == "l_shipdate" else c for c in items.columns]).write.parquet(str(tmp_path / "lineitem.parquet"))
    with pytest.raises(Exception, match="invalid dates"):
        catalog.queries()["derived_measures"](spark, str(tmp_path))


def test_an_increment_writes_no_copy_of_its_rows(spark):
    def copies():
        root = f"{shared_dir(spark)}/tidemill/{spark.sparkContext.applicationId}"
        return {n for n in os.listdir(root) if n.startswith(("new-staging", "new-facts", "new-rows"))}

    before = copies()
    rows, store = testbed.staging(spark, SF), VersionedTables(spark, scratch_path(spark, "store"))
    warehouse.build_warehouse(rows.filter("row_id % 3 = 0"), store)
    grown = warehouse.extend_warehouse(rows, store)
    assert grown["fact_sales"].count() == rows.count() == grown["fact_sales"].select("sales_key").distinct().count()
    assert copies() == before


@pytest.mark.parametrize("small_bytes", [64 << 20, 0])
def test_anti_join_of_numbers(spark, small_bytes):
    new = [(1,), (7,), (7,), (8,), (32768,), (32769,), (65536,), (0,), (-1,), (-9,), (None,), (10**15,)]
    known = [(7,), (7,), (32768,), (65536,), (-9,), (0,), (None,), (16,)]
    new = materialize(spark.createDataFrame(new, "row_id long").withColumn("n", F.lit("x")), "new")
    known = materialize(spark.createDataFrame(known, "row_id long"), "known")
    left = load.anti_join_numbers(new, known, "row_id", small_bytes)
    assert left.columns == ["row_id", "n"]
    found = sorted((r[0] for r in left.collect()), key=lambda v: (v is None, v))
    assert found == [-1, 1, 8, 32769, 10**15, None]
    if small_bytes:
        assert "Exchange hashpartitioning" not in plan(left)


def shuffles(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("|")
    return {path for path in files.split("|") if "/shuffle_" in path}


def test_a_written_table_leaves_no_shuffle_files(spark):
    """Before, they stayed until the driver collected its garbage, and were most of a build's disk."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was, before = spark.conf.get(setting), shuffles(spark)
    rows = spark.range(20000).groupBy((F.col("id") % 5000).alias("k")).count().orderBy("k")
    stored = materialize(rows, "rows")
    VersionedTables(spark, scratch_path(spark, "store")).replace("rows", rows)
    sinks.write_csv(rows, scratch_path(spark, "rows"))
    until = time.time() + 20
    while shuffles(spark) - before and time.time() < until:  # files are removed behind the write
        time.sleep(0.2)
    assert not shuffles(spark) - before
    assert spark.conf.get(setting) == was and stored.count() == 5000


def test_a_well_compressed_side_is_not_broadcast(spark):
    """Its files are under the limit of a broadcast, its rows in memory are not."""
    known = materialize(spark.range(500_000).select("id", (F.col("id") + 1).alias("key")), "known", "zstd")
    rows = materialize(spark.range(1000), "rows")
    assert "BroadcastHashJoin" in plan(rows.join(known, "id", "left"))
    assert "BroadcastHashJoin" not in plan(rows.join(join_side(known), "id", "left"))
    assert "BroadcastHashJoin" in plan(rows.join(join_side(known.limit(1000)), "id", "left"))


@pytest.mark.parametrize("packed_bytes", [64 << 20, 0])
def test_a_large_dimension_is_looked_up_without_moving_rows(spark, packed_bytes):
    """Null, negative, scattered and neighbouring numbers; beyond the limit the rows are shuffled."""
    ids = [*range(-3000, 3000, 7), *range(90_000, 99_000), 63, 64, 127, 4095, 4096, 2**40, 2**40 + 63, -64, -(2**50)]
    ids = sorted({*ids}, key=lambda i: (i * 7919) % 104_729)
    members = [(i, n) for n, i in enumerate(ids, 1)]
    dim = materialize(spark.createDataFrame([*members, (None, 1_000_000)], "id long, key long"), "members")
    asked = [*ids[::2], None, None, 5, 89_999, -7, 2**40 + 1, -(2**50) + 1, 2**62]
    facts = materialize(spark.createDataFrame([(i, n) for n, i in enumerate(asked)], "id long, n int"), "facts")
    found = keys.lookup_number(facts, dim, "id", "key", plain_bytes=0, packed_bytes=packed_bytes)
    assert ("Exchange hashpartitioning" in plan(found)) == (not packed_bytes)
    assert found.dtypes == [("id", "bigint"), ("n", "int"), ("key", "bigint")]
    known = dict([*members, (None, 1_000_000)])
    rows = found.collect()
    assert len(rows) == len(asked) and {r["n"]: r["key"] for r in rows} == {n: known.get(i) for n, i in enumerate(asked)}


def test_numbers_that_come_twice_or_do_not_fit_are_shuffled(spark):
    facts = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    for rows in ([(1, 10), (1, 11), (2, 20)], [(1, 10), (2, 1 << 40)], [(None, 1), (None, 2), (1, 10)]):
        dim = materialize(spark.createDataFrame(rows, "id long, key long"), "members")
        want = sorted(map(str, keys.lookup_key(facts, dim, {"id": "id"}, "key").collect()))
        assert sorted(map(str, keys.lookup_number(facts, dim, "id", "key", plain_bytes=0).collect())) == want


def test_compressed_csv_files_are_read_alike(spark, tmp_path, monkeypatch):
    """Small files of limited rows, in the order of the rows, with the text of plain files."""
    monkeypatch.setattr(sinks, "PACKED_FILE_ROWS", 300)
    rows = spark.range(1000).repartition(2).select("id", F.concat(F.lit(' "é", '), F.col("id").cast("string"), F.lit(" ")).alias("text"))
    rows = materialize(rows, "rows")
    plain = sinks.write_csv(rows, str(tmp_path / "plain"), encoding="ISO-8859-1")
    packed = sinks.write_csv(rows, str(tmp_path / "packed"), encoding="ISO-8859-1", compression="gzip")
    assert len([f for f in os.listdir(packed) if f.endswith(".csv.gz")]) >= 4
    found = []
    for path in (plain, packed):
        stored = materialize(supply_chain.ingest(spark, path), "ingested")
        found.append(sorted(map(tuple, keys.number_by_position(stored).select("row_id", "id", "text").collect())))
    assert found[0] == found[1] and [r[0] for r in found[1]] == list(range(1, 1001))


def test_a_supply_chain_run_exports_packed_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(pipelines, "scratch_path", lambda _, label: str(tmp_path / label))
    monkeypatch.setattr(testbed, "once", lambda label, spark, sf_dir, make: make())
    done = pipelines._supply_chain(spark, SF)
    for folder in (tmp_path / "raw-orders", tmp_path / "supply-chain" / "export" / "fact_sales"):
        files = [f for f in os.listdir(folder) if f.startswith("part-")]
        assert files and all(f.endswith(".csv.gz") for f in files)
    assert {r["status"] for r in done["export_audit"].collect()} == {"ok"}
    exported = spark.read.option("header", True).csv(str(tmp_path / "supply-chain" / "export" / "fact_sales"))
    assert exported.count() == testbed.table(spark, SF, "lineitem").count() == done["fact_sales"].count()


def test_orders_of_groups_are_counted_without_a_sort_of_rows(spark):
    """More than 64 groups of a kind, orders in several groups, rows without an order or a partner."""
    rows = [(n % 97 + 1, n % 7 + 1, n % 5 + 1, n % 89 + 1, n % 150 + 1, 20200101 + n % 2, None if n % 11 == 0 else n % 230 + 1) for n in range(4000)]
    fact = spark.createDataFrame(
        rows, "location_key long, shipping_key long, one long, customer_key long, product_key long, order_date_key int, order_number long"
    ).drop("one")
    days = spark.createDataFrame([(20200101, 2020), (20200102, 2021)], "date_key int, year int")
    cities = [(k, "m%d" % (k % 2), None if k % 3 else "r", "c%d" % k, "s", "l") for k in range(1, 91)]
    tables = {
        "fact_sales": materialize(fact, "fact"),
        "dim_date": materialize(days, "days"),
        "dim_location": materialize(spark.createDataFrame(
            cities, "location_key long, market string, order_region string, order_city string, order_state string, order_country string"), "places"),
        "dim_shipping": materialize(spark.createDataFrame([(k, "mode %d" % (k % 3)) for k in range(1, 8)], "shipping_key long, shipping_mode string"), "modes"),
        "dim_customer": materialize(spark.createDataFrame([(k, None if k % 4 == 0 else "g%d" % (k % 4)) for k in range(1, 90)], "customer_key long, customer_segment string"), "people"),
        "dim_product": materialize(spark.createDataFrame([(k, "cat %d" % (k % 130)) for k in range(1, 151)], "product_key long, category_name string"), "goods"),
    }
    counts = reports._count_orders(tables)
    assert "SortAggregate" not in plan(counts)
    places = tables["fact_sales"].filter("order_number IS NOT NULL")
    for table, key, group in zip(reports.ORDER_TABLES, reports.ORDER_KEYS, reports.ORDER_GROUPS):
        joined = places if table is None else places.join(tables[table].withColumnRenamed("date_key", "order_date_key"), key)
        want = joined.groupBy(*group).agg(F.count_distinct("order_number").alias("total_orders"))
        got = counts.filter(F.col("grouped") == reports.ORDER_GROUPS.index(group)).select(*group, "total_orders")
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), group
