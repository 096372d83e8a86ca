"""Row numbers, surrogate keys, first rows and lookups, also on skewed and many-file input."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemill import storage
from tidemill.operators import keys


def rows_by(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_row_id_is_dense_over_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).repartition(7).withColumn("v", F.col("id") * 2).write.parquet(path)
    numbered = keys.read_with_row_id(spark, path)
    assert sorted(r[0] for r in numbered.select("row_id").collect()) == list(range(1, 1001))
    expected = []
    for name in sorted(p.name for p in (tmp_path / "t").glob("*.parquet")):
        expected += [r["id"] for r in spark.read.parquet(f"{path}/{name}").collect()]
    assert [r["id"] for r in numbered.orderBy("row_id").collect()] == expected


def test_row_id_with_a_step_for_each_range(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    spark.range(100).repartition(3).write.parquet(path)
    monkeypatch.setattr(keys, "BROADCAST_BYTES", 0)
    numbered = keys.read_with_row_id(spark, path)
    assert sorted(r[0] for r in numbered.select("row_id").collect()) == list(range(1, 101))


def test_number_by_position_follows_csv_order(spark, tmp_path):
    for name, start in {"b.csv": 500, "a.csv": 0, "c.csv": 900}.items():
        (tmp_path / name).write_text("id,text\n" + "".join(f"{start + i},{'x' * 50}\n" for i in range(100)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    try:
        raw = spark.read.option("header", True).schema("id int, text string").csv(str(tmp_path))
        assert raw.rdd.getNumPartitions() > 3
        stored = storage.materialize(keys.with_source_position(raw), "csv")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    ids = [r["id"] for r in keys.number_by_position(stored).orderBy("row_id").collect()]
    assert ids == [*range(100), *range(500, 600), *range(900, 1000)]
    assert rows_by(keys.number_by_position(stored), "row_id") == [(i,) for i in range(1, 301)]


def test_number_by_position_rejects_gaps(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id\n" + "".join(f"{i}\n" for i in range(10)))
    raw = spark.read.option("header", True).schema("id int").csv(str(tmp_path))
    stored = storage.materialize(keys.with_source_position(raw).filter("id <> 4"), "gap")
    with pytest.raises(ValueError, match="gaps"):
        keys.number_by_position(stored)


def test_dense_key_equals_row_number(spark):
    rng = random.Random(7)
    rows = [(i, rng.randrange(50) if i % 3 else 7) for i in range(3000)]  # a third of the rows share a value
    df = spark.createDataFrame(rows, "id int, v int").repartition(6)
    got = keys.dense_key(df, "k", ["v", "id"])
    want = df.withColumn("k", F.row_number().over(Window.orderBy("v", "id")))
    assert rows_by(got, "k", "id") == rows_by(want, "k", "id")


def test_dense_key_of_nothing(spark):
    assert keys.dense_key(spark.createDataFrame([], "id int"), "k", ["id"]).count() == 0


def test_keep_first_with_a_hot_key(spark):
    rows = [(1 if i % 3 == 0 else i, i, None if i == 0 else f"r{i}") for i in range(900)]
    df = spark.createDataFrame(rows, "k int, o int, v string").repartition(5)
    first = {}
    for k, o, v in rows:
        first.setdefault(k, (o, v))
    got = {r["k"]: (r["o"], r["v"]) for r in keys.dedupe_keep_first(df, ["k"], ["o"]).collect()}
    assert got == first


def test_first_versions_keeps_first_attributes(spark):
    rows = [(5, "new", 9), (5, "old", 2), (5, "new", 3), (6, None, 1)]
    got = keys.first_versions(spark.createDataFrame(rows, "k int, a string, p long"), ["k"], ["a"], "p")
    assert rows_by(got, "k", "first_row", "a") == [(5, 2, "old"), (6, 1, None)]


def test_composite_lookup_matches_null_parts(spark):
    facts = spark.createDataFrame([(1, "x", None), (2, "x", 1.5), (3, "y", 1.5)], "id int, a string, b double")
    dim = spark.createDataFrame([(10, "x", None), (11, "x", 1.5)], "key int, a string, b double")
    got = keys.lookup_key(facts, dim, {"a": "a", "b": "b"}, "key")
    assert sorted((r["id"], r["key"]) for r in got.collect()) == [(1, 10), (2, 11), (3, None)]
