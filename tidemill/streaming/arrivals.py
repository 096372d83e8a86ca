"""Historical rows first, then newly arriving files: each key is loaded once."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemill.operators.keys import dedupe_keep_first
from tidemill.storage import filesystem
from tidemill.streaming.key_index import KeyedTable


def backfill(df: DataFrame, target: str, keys: list[str]) -> None:
    """First load of the target, whose rows have their own key each."""
    KeyedTable(df.sparkSession, target, df.schema, keys).backfill(df)


def read_target(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """All loaded rows."""
    return KeyedTable(spark, target, schema, []).read()


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark stores with the checkpoint: batch numbers are unique only within it."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()["value"])["id"]


def stream_new_arrivals(
    spark: SparkSession,
    src_dir: str,
    schema: T.StructType,
    keys: list[str],
    order_by: list[str],
    target: str,
    checkpoint: str,
    fmt: str = "parquet",
    glob: str | None = None,
    files_per_batch: int | None = None,
) -> int:
    """Load every file that arrived since the last call; returns the number of micro-batches.

    Within a batch the first row per key wins, and a key that the target already holds is ignored: the target's key
    index tells which of its files may hold one (see :mod:`tidemill.streaming.key_index`). A batch writes its own
    folder, named by stream and batch number, so a repeated batch gives the same result. Many folders become few.
    """
    reader = spark.readStream.format(fmt).schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    loaded: set[int] = set()

    def load(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        mine = f"{_stream_id(session, checkpoint)}-{batch_id}"
        KeyedTable(session, target, schema, keys).load(dedupe_keep_first(batch, keys, order_by), mine)
        loaded.add(batch_id)

    fs, folder = filesystem(spark, target)
    fs.mkdirs(folder)
    query = (
        reader.load(src_dir)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return len(loaded)
