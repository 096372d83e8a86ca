"""The keyed table: which files a batch opens, and how many folders are left."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.streaming import key_index
from tidemill.streaming.key_index import KeyedTable

SCHEMA = "id long, part string, value int"


def rows(spark, low, high, value=0):
    return spark.range(low, high).select("id", F.concat(F.lit("p"), F.col("id") % 3).alias("part"), F.lit(value).alias("value"))


def table(spark, path):
    return KeyedTable(spark, str(path), T._parse_datatype_string(SCHEMA), ["id", "part"])


def stored(keyed):
    return sorted((r["id"], r["value"]) for r in keyed.read().collect())


def test_many_batches_leave_few_folders_and_open_few_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(key_index, "MAX_FOLDERS", 3)
    monkeypatch.setattr(key_index, "BUCKETS", (4, 4))
    keyed = table(spark, tmp_path)
    keyed.backfill(rows(spark, 0, 6000))
    assert len(keyed.folders()) == 1
    for n in range(7):
        begin = 6000 + 20 * n
        # five keys of the batch before come again with another value
        opened = keyed.load(rows(spark, begin - 5, begin + 20, n + 1), f"b{n}")
        assert len(keyed.folders()) <= 3
        assert len(opened) <= 6  # the five known keys' buckets, and a chance hit
    assert keyed.load(rows(spark, 9000, 9040), "new") == []
    found = dict(stored(keyed))
    assert sorted(found) == [*range(6140), *range(9000, 9040)]
    assert all(found[i] == (i - 6000) // 20 + 1 for i in range(6000, 6140)) and found[5999] == 0
    assert len(keyed.load(rows(spark, 100, 101), "old")) == 1


def test_a_repeated_batch_changes_nothing(spark, tmp_path, monkeypatch):
    keyed = table(spark, tmp_path)
    keyed.load(rows(spark, 0, 10), "a")
    keyed.load(rows(spark, 5, 15, 1), "b")
    expected = stored(keyed)
    keyed.load(rows(spark, 5, 15, 1), "b")
    assert stored(keyed) == expected and keyed.folders() == ["a", "b"]
    monkeypatch.setattr(key_index, "MAX_FOLDERS", 1)
    keyed.load(rows(spark, 0, 3), "c")
    assert len(keyed.folders()) == 2 and stored(keyed) == expected
    keyed.load(rows(spark, 5, 15, 1), "b")  # its rows are in the joined folder now
    assert stored(keyed) == expected


def test_null_keys_and_nothing(spark, tmp_path):
    keyed = table(spark, tmp_path)
    assert keyed.read().count() == 0
    keyed.load(spark.createDataFrame([], SCHEMA), "none")
    some = spark.createDataFrame([(None, "x", 1), (1, None, 2), (None, None, 3)], SCHEMA)
    keyed.load(some, "a")
    keyed.load(some.withColumn("value", F.lit(9)), "b")
    assert sorted(r["value"] for r in keyed.read().collect()) == [1, 2, 3]


def test_unknown_keys_are_rarely_taken_for_known(spark, tmp_path):
    keyed = table(spark, tmp_path)
    keyed.backfill(rows(spark, 0, 40_000))
    state = keyed._state()
    other = rows(spark, 10**6, 10**6 + 2000)
    assert len(keyed.places(rows(spark, 0, 2000), state["folders"], state["buckets"])) == state["buckets"]
    assert len(keyed.places(other, state["folders"], state["buckets"])) <= 2
