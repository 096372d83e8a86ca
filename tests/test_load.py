"""Incremental loads, insert-or-ignore, update, delete and versioned replacement."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemill.operators import load
from tidemill.operators.quality import GateFailed
from tidemill.storage import VersionedTables, data_files

TOOL = "tool_id int, name string, weight int, depot string, fee double"
TOOLS = [(11, "kiln", 40, "north", 12.5), (12, "loom", 9, "north", 31.0), (13, "anvil", 75, "south", 7.25), (14, "lathe", 60, "north", 19.0)]


def ids(df, column="id"):
    return sorted(r[column] for r in df.collect())


def test_create_read_update_delete(spark, tmp_path):
    store = VersionedTables(spark, str(tmp_path))
    empty = spark.createDataFrame([], TOOL)
    store.create_if_absent("tools", empty)
    offered = [*TOOLS, (11, "other", 1, "x", 1.0), (15, None, 1, "x", 1.0)]
    batch = spark.createDataFrame([(i, *r) for i, r in enumerate(offered)], f"seq int, {TOOL}")
    for _ in range(2):  # the second insert is ignored
        store.replace("tools", load.insert_or_ignore(store.read("tools"), batch, ["tool_id"], ["name"], ["seq"]))
    assert sorted(map(tuple, store.read("tools").collect())) == TOOLS
    store.update("tools", F.col("tool_id") == 12, {"fee": F.lit(33.0)})
    store.delete("tools", F.col("tool_id") == 13)
    assert sorted((r["tool_id"], r["fee"]) for r in store.read("tools").collect()) == [(11, 12.5), (12, 33.0), (14, 19.0)]


def test_delete_keeps_rows_with_unknown_predicate(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 1)], "id int, v int")
    assert ids(load.delete_rows(df, F.col("v") > 3)) == [2, 3]


def test_update_where_predicate_is_unknown(spark):
    df = spark.createDataFrame([(1, None), (2, 9)], "id int, v int")
    assert {r["id"]: r["v"] for r in load.update_rows(df, F.col("v") > 3, {"v": F.lit(0)}).collect()} == {1: None, 2: 0}


@pytest.mark.parametrize("small", [1 << 20, 0])
def test_anti_join_paths_agree(spark, small):
    existing = spark.createDataFrame([(i % 40, "x") for i in range(400)], "id int, v string")
    new = spark.createDataFrame([(i, "y") for i in [1, 39, 40, 41, 41]], "id int, v string")
    assert ids(load.anti_join_new(new, existing, ["id"], small)) == [40, 41, 41]


@pytest.mark.parametrize("small", [1 << 20, 0])
def test_anti_join_composite_and_empty(spark, small):
    existing = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int")
    new = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("b", 2)], "k string, n int")
    got = load.anti_join_new(new, existing, ["k", "n"], small)
    assert sorted(map(tuple, got.collect())) == [("a", 2), ("b", 1)]
    assert load.anti_join_new(new.limit(0), existing, ["k", "n"], small).count() == 0
    assert load.anti_join_new(new, existing.limit(0), ["k", "n"], small).count() == 4


def test_replacement_reads_the_old_version_safely(spark, tmp_path):
    store = VersionedTables(spark, str(tmp_path))
    store.replace("t", spark.range(10))
    store.replace("t", store.read("t").filter("id < 4"))
    assert ids(store.read("t")) == [0, 1, 2, 3]


def test_failed_gate_leaves_the_old_version(spark, tmp_path):
    store = VersionedTables(spark, str(tmp_path))
    store.replace("t", spark.range(3))

    def refuse(_):
        raise GateFailed("no")

    with pytest.raises(GateFailed):
        store.replace("t", spark.range(99), gate=refuse)
    assert ids(store.read("t")) == [0, 1, 2]
    store.replace("t", spark.range(1))
    assert ids(store.read("t")) == [0]


def test_vacuum_keeps_the_newest_versions(spark, tmp_path):
    store = VersionedTables(spark, str(tmp_path))
    for n in range(1, 5):
        store.replace("t", spark.range(n))
    assert store.vacuum("t", keep=2) == [1, 2]
    assert store.read("t").count() == 4 and store.vacuum("t", keep=0) == [3]
    assert store.read("t").count() == 4


def test_update_and_delete_keep_untouched_files(spark, tmp_path):
    """Only files with rows of the condition are written anew, also in partitions whose names need escaping."""
    store = VersionedTables(spark, str(tmp_path / "a store"))
    rows = spark.range(400).withColumn("group", F.concat(F.lit("g "), (F.col("id") % 4).cast("string")))
    store.replace("t", rows.repartitionByRange(8, "id"), partition_by=["group"])
    first = data_files(spark, store.path("t"))
    assert len(first) == 32
    store.update("t", F.col("id") == 7, {"id": F.lit(1007).cast("long")})
    parts = store.parts("t", 2)
    assert sorted(map(len, (parts["v1"], data_files(spark, store.path("t"))))) == [1, 31]
    assert set(parts["v1"]) < set(first)
    store.delete("t", F.col("id") < 60)  # rows of two ranges in each group, of which one is already new
    assert ids(store.read("t")) == [*range(60, 400), 1007]
    assert {f: len(n) for f, n in store.parts("t", 3).items() if n} == {"v1": 24}
    assert store.delete("t", F.col("id") == 5).count() == 341 and store.current("t") == 3
    store.delete("t", F.lit(True))
    assert store.read("t").count() == 0
    assert store.vacuum("t", keep=2) == [2]


def test_appends_are_versions_that_share_files(spark, tmp_path):
    store = VersionedTables(spark, str(tmp_path))
    for n in range(5):
        store.append("t", spark.range(10 * n, 10 * n + 10))
    assert len(store.parts("t", 5)) == 5 and store.vacuum("t", keep=1) == []

    def refuse(_):
        raise GateFailed("no")

    with pytest.raises(GateFailed):
        store.append("t", spark.range(3), gate=refuse)
    assert ids(store.read("t")) == list(range(50))
    assert ids(store.compact("t")) == list(range(50)) and store.parts("t", store.current("t")) == {"v7": None}
    assert store.vacuum("t", keep=1) == [1, 2, 3, 4, 5, 6] and ids(store.read("t")) == list(range(50))


def test_builds_are_read_without_a_job(spark, tmp_path):
    """A build names all tables ever built, so only the newest file is read."""
    store = VersionedTables(spark, str(tmp_path))
    for _ in range(4):
        store.publish({name: store.write_version(name, spark.range(2))[0] for name in ("a", "b")})
    store.publish({"c": store.write_version("c", spark.range(3))[0]})
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("builds", "builds")
    try:
        assert store.current("a") == 4 and store.exists("c") and store.path("b").endswith("v4")
        assert not jobs.getJobIdsForGroup("builds")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert store.read_together(["a", "c"])["c"].count() == 3
    assert store.vacuum("a", keep=2) == [1, 2] and store._build_numbers() == [3, 4, 5]


def test_missing_table(spark, tmp_path):
    store = VersionedTables(spark, str(tmp_path))
    assert not store.exists("t")
    with pytest.raises(ValueError, match="no published version"):
        store.read("t")


def test_historical_split(spark):
    df = spark.createDataFrame(
        [(1, "2026-08-03"), (2, "2026-08-04"), (3, None)], "id int, d string"
    ).withColumn("d", F.to_date("d"))
    before, rest = load.historical_split(df, "d", "2026-08-04")
    assert ids(before) == [1] and ids(rest) == [2, 3]
