"""Readers: delimited text, CSV, JSON, XML, binary files, and a reader that tolerates a missing path."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.dates import parse_or_null
from tidemill.functions.text import strip
from tidemill.operators.cleaning import quoted
from tidemill.storage import path_matches

# The tokens a data-frame CSV reader takes as missing.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def _typed(name: str, data_type: T.DataType, timestamp_format: str | None) -> Column:
    text = F.col(quoted(name))
    if isinstance(data_type, T.StringType):
        return text.alias(name)
    if isinstance(data_type, T.BinaryType):
        return F.encode(text, "UTF-8").alias(name)
    value = strip(text)
    if timestamp_format and isinstance(data_type, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return parse_or_null(value, timestamp_format).cast(data_type).alias(name)
    return value.try_cast(data_type).alias(name)


def _as_schema(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def read_csv_text(
    spark: SparkSession,
    path: str | list[str],
    names: list[str] | None = None,
    encoding: str = "UTF-8",
    multi_line: bool = False,
) -> DataFrame:
    """CSV with a header, every field as text; ``names`` picks columns by their header.

    Only the first header is read ahead. The header of every other file is compared with it, so
    a file with another column order is refused instead of being read into wrong columns.
    """
    df = _csv_reader(spark, encoding, multi_line).option("enforceSchema", False).csv(path)
    return df if names is None else df.select(*[F.col(quoted(n)) for n in names])


def _csv_reader(spark: SparkSession, encoding: str, multi_line: bool):
    return (
        spark.read.option("header", True)
        .option("encoding", encoding)
        .option("escape", '"')
        .option("multiLine", multi_line)
    )


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    encoding: str = "UTF-8",
    null_tokens: list[str] = NULL_TOKENS,
    timestamp_format: str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """CSV with a header. Several paths are read as one table.

    With a schema, the named columns are read as text, the null tokens become NULL and the text
    is cast; text that does not fit its type becomes NULL (see :func:`cast_failures`). Without a
    schema the types are inferred, which costs one more pass over the files.
    ``multi_line`` is needed only when quoted fields hold line breaks; such files are not split.
    """
    if schema is None:
        return _csv_reader(spark, encoding, multi_line).option("inferSchema", True).csv(path)
    text = read_csv_text(spark, path, _as_schema(schema).names, encoding, multi_line)
    return typed_columns(text, schema, null_tokens, timestamp_format)


def typed_columns(
    df: DataFrame,
    schema: T.StructType | str,
    null_tokens: list[str] = NULL_TOKENS,
    timestamp_format: str | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """Text columns to the types of ``schema``; the columns in ``keep`` stay as they are."""
    fields = _as_schema(schema).fields
    present = df.select(
        *[
            F.when(~F.col(quoted(f.name)).isin(null_tokens), F.col(quoted(f.name))).alias(f.name)
            for f in fields
        ],
        *(keep or []),
    )
    return present.select(*[_typed(f.name, f.dataType, timestamp_format) for f in fields], *(keep or []))


def cast_failures(
    df: DataFrame,
    schema: T.StructType | str,
    null_tokens: list[str] = NULL_TOKENS,
    timestamp_format: str | None = None,
) -> DataFrame:
    """Rows of a text frame where a present value does not fit its type, with the column names."""
    bad = [
        F.when(
            ~F.col(quoted(f.name)).isin(null_tokens) & _typed(f.name, f.dataType, timestamp_format).isNull(),
            F.lit(f.name),
        )
        for f in _as_schema(schema).fields
    ]
    return df.withColumn("failed_columns", F.concat_ws(",", *bad)).filter("failed_columns <> ''")


def split_line(line: Column | str, names: list[str], delimiter: str = ",") -> list[Column]:
    """Trimmed fields of a delimited line; a missing field is NULL."""
    parts = F.split(strip(line), "\\Q" + delimiter + "\\E")
    return [strip(F.get(parts, F.lit(i))).alias(name) for i, name in enumerate(names)]


def read_text_delimited(spark: SparkSession, path: str, names: list[str], delimiter: str = ",") -> DataFrame:
    """Text file without a header; every field is trimmed text."""
    return spark.read.text(path).select(*split_line("value", names, delimiter))


def read_json_array(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Files that hold one JSON array (or object) each."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """One JSON object per line: the layout to use for large inputs, because files are split."""
    return spark.read.schema(schema).json(path)


def read_xml(spark: SparkSession, path: str, row_tag: str, schema: T.StructType | str) -> DataFrame:
    """One row per ``row_tag`` element; child elements are columns, an empty element is NULL."""
    return (
        spark.read.format("xml").option("rowTag", row_tag).option("nullValue", "").schema(schema).load(path)
    )


def read_binary(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: path, modificationTime, length, content."""
    return spark.read.format("binaryFile").load(path)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet", **options) -> DataFrame:
    """The files at ``path``; an empty frame when nothing is there. Other errors are raised."""
    if not path_matches(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.format(fmt).options(**options).schema(schema).load(path)


def extract_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Landed API payloads (a JSON array per file); empty when nothing has landed."""
    return read_or_empty(spark, path, schema, "json", multiLine=True)


def extract_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A CSV file with a header, columns found by name as in :func:`read_csv`; empty when nothing is there."""
    if not path_matches(spark, path):
        return spark.createDataFrame([], schema)
    return read_csv(spark, path, schema)


def merge_if_present(left: DataFrame, right: DataFrame, key: str) -> DataFrame | None:
    """Inner join on a shared column, or None when either side has no rows."""
    if left.isEmpty() or right.isEmpty():
        return None
    return left.join(right, key, "inner")
