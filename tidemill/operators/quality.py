"""Data-quality reports and gates. Each report is one aggregate pass, whatever the number of columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.text import is_blank
from tidemill.operators.cleaning import quoted


class GateFailed(ValueError):
    """A hard gate found rows that must not be loaded."""


def _long_form(one_row: DataFrame, name: str, value: str) -> DataFrame:
    """One row of aggregates to (column, value) rows."""
    return one_row.unpivot([], [F.col(quoted(c)) for c in one_row.columns], name, value)


def missing_report(df: DataFrame, only_missing: bool = False) -> DataFrame:
    """NULLs per column: ``column_name, missing``."""
    counts = df.agg(*[F.count_if(F.col(quoted(c)).isNull()).alias(c) for c in df.columns])
    report = _long_form(counts, "column_name", "missing")
    return report.filter("missing > 0") if only_missing else report


def range_status(value: Column, low, high, missing: Column | None = None) -> Column:
    """``missing`` before ``anomaly`` before ``ok``."""
    absent = value.isNull() if missing is None else missing
    return (
        F.when(absent, "missing").when((value < low) | (value > high), "anomaly").otherwise("ok")
    )


def text_number_status(text: str, low, high) -> Column:
    """Status of a number held as text: blank, not a number, out of range, or fine."""
    number = F.col(text).try_cast("int")
    return (
        F.when(is_blank(text), "missing")
        .when(number.isNull(), "invalid")
        .when((number < low) | (number > high), "anomaly")
        .otherwise("ok")
    )


def invalid_dates(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per parsed date column, rows without a date: ``column_name, invalid``."""
    counts = df.agg(*[F.count_if(F.col(quoted(c)).isNull()).alias(c) for c in columns])
    return _long_form(counts, "column_name", "invalid")


def missing_keys(fact: DataFrame, key_columns: list[str]) -> DataFrame:
    """Per key column, facts without a dimension row: ``key_column, missing``."""
    counts = fact.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in key_columns])
    return _long_form(counts, "key_column", "missing")


def any_null(columns: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(quoted(c)).isNull() for c in columns])


def null_fk_check(fact: DataFrame, key_columns: list[str]) -> DataFrame:
    return fact.agg(F.count_if(any_null(key_columns)).alias("invalid_records"))


def fk_orphans(fact: DataFrame, references: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Per foreign key, facts whose non-null key is not in its dimension.

    The fact is scanned once and reduced to (key column, key, rows) before the join, so the
    join sees distinct keys only and a hot key arrives as one row.
    """
    used = (
        fact.select(*[F.col(fk).cast("long").alias(fk) for fk in references])
        .unpivot([], list(references), "key_column", "key")
        .filter("key is not null")
        .groupBy("key_column", "key")
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    present = reduce(
        DataFrame.unionByName,
        [
            dim.select(F.lit(fk).alias("key_column"), F.col(pk).cast("long").alias("key"))
            for fk, (dim, pk) in references.items()
        ],
    ).withColumn("_found", F.lit(True))
    return (
        used.join(present.distinct(), ["key_column", "key"], "left")
        .groupBy("key_column")
        .agg(F.coalesce(F.sum(F.when(F.col("_found").isNull(), F.col("_rows"))), F.lit(0)).alias("orphans"))
    )


def key_uniqueness(df: DataFrame, keys: list[str], table: str) -> DataFrame:
    """Primary-key check: ``table_name, rows, null_keys, duplicate_keys``."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    null_key = any_null(keys)
    return groups.agg(
        F.lit(table).alias("table_name"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(null_key, F.col("_n"))), F.lit(0)).alias("null_keys"),
        F.count_if(~null_key & (F.col("_n") > 1)).alias("duplicate_keys"),
    )


def row_count(df: DataFrame, label: str, column: str = "table_name") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(label).alias(column), "rows")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``table_name, rows`` for every table, as one plan."""
    return reduce(DataFrame.unionByName, [row_count(df, name) for name, df in tables.items()])


def stage_audit(stages: dict[str, DataFrame]) -> DataFrame:
    """``stage, rows, columns`` for every stage of a pipeline."""
    return reduce(
        DataFrame.unionByName,
        [
            row_count(df, name, "stage").withColumn("columns", F.lit(len(df.columns)))
            for name, df in stages.items()
        ],
    )


def row_reconcile(staging: DataFrame, fact: DataFrame) -> DataFrame:
    """Staging against fact row count; a difference is a warning and does not stop the load."""
    counts = staging.agg(F.count(F.lit(1)).alias("s"), F.lit(0).cast("long").alias("f")).unionByName(
        fact.agg(F.lit(0).cast("long").alias("s"), F.count(F.lit(1)).alias("f"))
    )
    totals = counts.agg(F.sum("s").alias("staging_rows"), F.sum("f").alias("fact_rows"))
    return totals.withColumn(
        "status",
        F.when(F.col("staging_rows") == F.col("fact_rows"), "PASSED").otherwise("WARNING"),
    )


def split_valid(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that satisfy every rule, and the others with the names of the broken rules.

    A rule that is unknown (NULL) for a row counts as broken.
    """
    holds = {name: F.coalesce(rule, F.lit(False)) for name, rule in rules.items()}
    every = reduce(lambda a, b: a & b, holds.values())
    reason = F.concat_ws(",", *[F.when(~ok, F.lit(name)) for name, ok in holds.items()])
    return df.filter(every), df.filter(~every).withColumn("reason", reason)


def gate_status(counts: DataFrame, name: str, failures: str) -> DataFrame:
    """Sum of a failure column as one row: ``gate, failures, status``."""
    total = counts.agg(F.coalesce(F.sum(failures), F.lit(0)).alias("failures"))
    return total.select(
        F.lit(name).alias("gate"),
        "failures",
        F.when(F.col("failures") == 0, "PASSED").otherwise("FAILED").alias("status"),
    )


def assert_gate(counts: DataFrame, name: str, failures: str) -> None:
    """Raise :class:`GateFailed` when the failure column does not sum to zero."""
    row = gate_status(counts, name, failures).first()
    if row["status"] != "PASSED":
        raise GateFailed(f"{name}: {row['failures']} failing rows")
