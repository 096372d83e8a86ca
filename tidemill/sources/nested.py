"""Nested records to flat columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.operators.cleaning import quoted


def flatten_struct(df: DataFrame, sep: str = ".") -> DataFrame:
    """Every leaf of every struct column as a column named by its path."""

    def leaves(fields, path):
        for field in fields:
            here = [*path, field.name]
            if isinstance(field.dataType, T.StructType):
                yield from leaves(field.dataType.fields, here)
            else:
                yield F.col(".".join(quoted(p) for p in here)).alias(sep.join(here))

    return df.select(*leaves(df.schema.fields, []))
