"""The cleaning stage: drop sensitive columns, parse dates, trim text. No row is removed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.dates import parse_or_null
from tidemill.functions.text import strip_to_null


def drop_sensitive(df: DataFrame, names: list[str]) -> DataFrame:
    """Drop the named columns that exist."""
    return df.drop(*names)


def columns_of_type(df: DataFrame, *types: type[T.DataType]) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, types)]


def quoted(name: str) -> str:
    """Column reference for names with spaces, dots or parentheses."""
    return "`" + name.replace("`", "``") + "`"


def clean_text(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Trim text columns; text that is empty afterwards becomes NULL."""
    chosen = set(columns if columns is not None else columns_of_type(df, T.StringType))
    return df.select(
        *[strip_to_null(F.col(quoted(c))).alias(c) if c in chosen else F.col(quoted(c)) for c in df.columns]
    )


def parse_dates(df: DataFrame, columns: list[str], fmt: str) -> DataFrame:
    """Text columns to timestamps; unparsable text becomes NULL."""
    return df.withColumns({c: parse_or_null(F.col(quoted(c)), fmt) for c in columns})


def drop_null_rows(df: DataFrame) -> DataFrame:
    return df.na.drop("any")


def clean(df: DataFrame, sensitive: list[str], date_columns: list[str], fmt: str) -> DataFrame:
    """Dates are parsed first and so are no longer text when the text columns are trimmed."""
    return clean_text(parse_dates(drop_sensitive(df, sensitive), date_columns, fmt))
