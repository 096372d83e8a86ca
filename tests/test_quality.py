"""Reports and gates on small frames with known faults."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemill.operators import cleaning, quality


def as_dict(df):
    return {r[0]: r[1] for r in df.collect()}


def test_missing_report(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, `b c.d` string")
    assert as_dict(quality.missing_report(df)) == {"a": 1, "b c.d": 2}
    assert as_dict(quality.missing_report(df.filter("a = 3"), only_missing=True)) == {}


def test_missing_comes_before_anomaly(spark):
    df = spark.createDataFrame([("85",), ("",), ("-5",), ("105",), (None,), ("x",), ("0",), ("100",)], "m string")
    got = [r[0] for r in df.select(quality.text_number_status("m", 0, 100)).collect()]
    assert got == ["ok", "missing", "anomaly", "anomaly", "missing", "invalid", "ok", "ok"]
    df = spark.createDataFrame([(85,), (None,), (105,)], "m int")
    assert [r[0] for r in df.select(quality.range_status(F.col("m"), 0, 100)).collect()] == ["ok", "missing", "anomaly"]


def test_split_valid_states_every_broken_rule(spark):
    rows = [(1, 45000, 24), (4, -5000, 150), (5, None, 30), (6, 1, 17)]
    df = spark.createDataFrame(rows, "id int, salary int, age int")
    rules = {"salary": F.col("salary") > 0, "age": F.col("age").between(18, 60)}
    valid, bad = quality.split_valid(df, rules)
    assert [r["id"] for r in valid.collect()] == [1]
    assert {r["id"]: r["reason"] for r in bad.collect()} == {4: "salary,age", 5: "salary", 6: "age"}


def test_gates(spark):
    df = spark.createDataFrame([(None,), (1,)], "order_date int")
    counts = quality.invalid_dates(df, ["order_date"])
    assert tuple(quality.gate_status(counts, "dates", "invalid").first()) == ("dates", 1, "FAILED")
    with pytest.raises(quality.GateFailed, match="dates: 1 failing rows"):
        quality.assert_gate(counts, "dates", "invalid")
    quality.assert_gate(quality.invalid_dates(df.na.drop(), ["order_date"]), "dates", "invalid")


def test_orphans_and_null_keys(spark):
    fact = spark.createDataFrame([(1, 1), (9, 1), (9, None), (None, 3)], "a int, b long")
    dim_a = spark.createDataFrame([(1,), (2,)], "key int")
    dim_b = spark.createDataFrame([(1,)], "key long")
    got = as_dict(quality.fk_orphans(fact, {"a": (dim_a, "key"), "b": (dim_b, "key")}))
    assert got == {"a": 2, "b": 1}
    assert as_dict(quality.missing_keys(fact, ["a", "b"])) == {"a": 1, "b": 1}
    assert quality.null_fk_check(fact, ["a", "b"]).first()[0] == 2


def test_key_uniqueness(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k int")
    assert tuple(quality.key_uniqueness(df, ["k"], "t").first()) == ("t", 5, 2, 1)


def test_reconcile_warns_and_does_not_stop(spark):
    assert tuple(quality.row_reconcile(spark.range(3), spark.range(3)).first()) == (3, 3, "PASSED")
    assert tuple(quality.row_reconcile(spark.range(3), spark.range(2)).first()) == (3, 2, "WARNING")


def test_cleaning_drops_parses_and_trims(spark):
    df = spark.createDataFrame(
        [("s", " 1/2/2018 3:04", "\tx "), ("s", "bad", "  ")], "`Customer Email` string, `order date (D)` string, t string"
    ).withColumn("order date (D)", F.trim(F.col("`order date (D)`")))
    out = cleaning.clean(df, ["Customer Email", "Not There"], ["order date (D)"], "M/d/yyyy H:mm")
    assert out.columns == ["order date (D)", "t"]
    assert [(str(r[0]), r[1]) for r in out.collect()] == [("2018-01-02 03:04:00", "x"), ("None", None)]


def test_drop_null_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "a int, b string")
    assert cleaning.drop_null_rows(df).count() == 1
