"""Tables that a run writes are compressed with the codec of the library's tables."""

from pyspark.sql import functions as F

from tidemill.storage import CODEC, VersionedTables, data_files, materialize, scratch_path
from tidemill.streaming.key_index import KeyedTable


def test_written_tables_have_the_codec(spark, tmp_path):
    rows = spark.range(100).withColumn("text", F.lit("x"))
    table = KeyedTable(spark, scratch_path(spark, "keyed"), rows.schema, ["id"])
    table.backfill(rows)
    store = VersionedTables(spark, scratch_path(spark, "store"))
    store.replace("rows", rows)
    for folder in (f"{table.root}/history", store.path("rows")):
        names = data_files(spark, folder)
        assert names and all(name.endswith(f".{CODEC}.parquet") for name in names)
    assert all(f".{CODEC}." in path for path in materialize(rows, "rows", CODEC).inputFiles())
    assert not any(f".{CODEC}." in path for path in materialize(rows, "rows").inputFiles())
    assert table.read().count() == 100
