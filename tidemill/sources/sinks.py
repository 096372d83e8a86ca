"""Writers: CSV, JSON and XML folders, table export and the report runner with isolated errors."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemill.storage import shuffles_dropped

# Writers cut timestamps to milliseconds unless told otherwise.
TIMESTAMP_FORMATS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
#: Rows of a compressed file, which one task reads.
PACKED_FILE_ROWS = 1_000_000
#: Exports submitted at the same time.
JOBS = 4
AUDIT_SCHEMA = "name string, rows long, columns int, status string, error string"


def write_csv(
    df: DataFrame, path: str, encoding: str = "UTF-8", single_file: bool = False, compression: str | None = None
) -> str:
    """CSV folder with headers that reads back unchanged: spaces are kept, quotes are doubled.

    ``single_file`` is for small reports only. Compressed files are not split by readers, so their rows are limited.
    """
    out = df.coalesce(1) if single_file else df
    writer = (
        out.write.mode("overwrite")
        .options(**TIMESTAMP_FORMATS)
        .option("header", True)
        .option("encoding", encoding)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("emptyValue", '""')
    )
    if compression:
        writer = writer.option("compression", compression).option("maxRecordsPerFile", PACKED_FILE_ROWS)
    with shuffles_dropped(df.sparkSession):
        writer.csv(path)
    return path


def write_json(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").options(**TIMESTAMP_FORMATS).json(path)
    return path


def write_xml(df: DataFrame, path: str, row_tag: str) -> str:
    writer = df.write.format("xml").options(**TIMESTAMP_FORMATS).option("rootTag", "rows").option("rowTag", row_tag)
    writer.mode("overwrite").save(path)
    return path


def write_report_csv(df: DataFrame, path: str) -> str:
    """A report is an aggregate of bounded size, so it goes to one file, in its order."""
    return write_csv(df, path, single_file=True)


def export_each(
    spark: SparkSession,
    names: list[str],
    build: Callable[[str], DataFrame],
    out_dir: str,
    write: Callable[[DataFrame, str], str],
) -> DataFrame:
    """Write every named frame to its own folder. One failure is recorded and the rest go on.

    The jobs do not depend on each other, so a few are submitted together. The rows are counted by the
    write itself, so the audit costs no second pass.
    """

    def one(name: str) -> tuple:
        try:
            df = build(name)
            written = Observation()
            write(df.observe(written, F.count(F.lit(1)).alias("rows")), f"{out_dir}/{name}")
            return name, written.get["rows"], len(df.columns), "ok", None
        except Exception as error:
            return name, None, None, "failed", f"{type(error).__name__}: {error}"

    with ThreadPoolExecutor(max_workers=JOBS) as pool:
        audit = list(pool.map(one, names))
    return spark.createDataFrame(audit, AUDIT_SCHEMA)


def export_tables(
    spark: SparkSession, names: list[str], tables: dict[str, DataFrame], out_dir: str, compression: str | None = None
) -> DataFrame:
    """Each table to CSV files of its own; returns ``name, rows, columns, status, error``."""
    return export_each(spark, names, tables.__getitem__, out_dir, partial(write_csv, compression=compression))


def run_reports(
    spark: SparkSession, reports: dict[str, Callable[[dict[str, DataFrame]], DataFrame]],
    tables: dict[str, DataFrame], out_dir: str,
) -> DataFrame:
    """Each named report to a CSV file of its own; returns the same audit."""
    return export_each(spark, list(reports), lambda name: reports[name](tables), out_dir, write_report_csv)


def success_line(audit: DataFrame) -> str:
    """``n/m`` of an audit."""
    done, total = audit.selectExpr("count_if(status = 'ok')", "count(*)").first()
    return f"{done}/{total}"
