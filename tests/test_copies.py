"""Copies of rows: digests first, full rows only where a digest comes back."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemill import storage
from tidemill.operators import copies

ROWS = [(1, "x", 0.0)] * 300 + [(2, None, None), (2, None, None), (None, "2", 1.5), (3, "y", -0.0), (3, "y", 0.0)]
SCHEMA = "a int, `b c.d` string, v double"


def one_digest(df):
    return [F.lit(1).cast("long"), F.lit(2).cast("long")]


def some_digests(df):
    """Rows that differ share a digest here and there."""
    return [F.coalesce(F.col("a") % 2, F.lit(0)).cast("long"), F.lit(2).cast("long")]


@pytest.mark.parametrize("digest", [copies.row_digest, one_digest, some_digests])
@pytest.mark.parametrize("broadcast", [True, False])
def test_copies(spark, monkeypatch, digest, broadcast):
    if not broadcast:
        monkeypatch.setattr(copies, "broadcast_if_small", lambda df: storage.broadcast_if_small(df, 0))
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(4)
    assert tuple(copies.duplicate_count(df, digest).first()) == (305, 301)
    expected = sorted(map(str, df.distinct().collect()))
    assert sorted(map(str, copies.distinct_rows(df, digest).collect())) == expected
    assert copies.distinct_rows(df, digest).columns == df.columns


def test_no_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert tuple(copies.duplicate_count(df).first()) == (0, 0)
    assert copies.distinct_rows(df).count() == 0


def shuffled_bytes(df) -> int:
    """Bytes that the shuffles of a plan write."""
    df.sparkSession.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = df._jdf.queryExecution().executedPlan()
        df._jdf.queryExecution().toRdd().count()
        total, open_nodes = 0, [plan]
        while open_nodes:
            node = open_nodes.pop()
            if node.nodeName() == "Exchange":
                total += node.metrics().apply("dataSize").value()
            children = node.children()
            open_nodes += [children.apply(i) for i in range(children.size())]
        return total
    finally:
        df.sparkSession.conf.unset("spark.sql.adaptive.enabled")


def test_only_rows_with_a_copy_are_shuffled(spark):
    """5,000 texts of 2,000 characters, ten of them twice."""
    texts = spark.range(5000).withColumn("text", F.repeat(F.sha2(F.col("id").cast("string"), 512), 16))
    table = storage.materialize(texts.unionByName(texts.limit(10)), "texts")
    whole = shuffled_bytes(table.groupBy("id", "text").count())
    single, several = copies.split_by_digest(table)
    counted = shuffled_bytes(several.groupBy("id", "text").count())
    assert shuffled_bytes(single) == 0
    assert several.count() == 20 and counted < whole / 100
    assert tuple(copies.duplicate_count(table).first()) == (5010, 10)
