"""Run a query and its SQL on the same files and compare names, types and all values."""

from __future__ import annotations

import math
from decimal import Decimal

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

TYPE_NAMES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE", "date": "DATE",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, Decimal):
        return float(value)
    return value


def differences(df, con, sql: str) -> list[str]:
    relation = con.sql(sql)
    names = sorted(df.columns)
    problems = []
    if names != sorted(relation.columns):
        return [f"columns {names} / {sorted(relation.columns)}"]
    types = dict(zip(relation.columns, map(str, relation.types)))
    for field in df.schema.fields:
        expected = TYPE_NAMES.get(field.dataType.simpleString(), field.dataType.simpleString())
        if types[field.name] != expected:
            problems.append(f"type of {field.name}: {expected} / {types[field.name]}")

    def key(row):
        return [(v is None, str(type(v)), v) if v is not None else (True, "", 0) for v in row]

    mine = sorted((tuple(_plain(r[n]) for n in names) for r in df.collect()), key=key)
    order = [relation.columns.index(n) for n in names]
    theirs = sorted((tuple(_plain(r[i]) for i in order) for r in relation.fetchall()), key=key)
    if len(mine) != len(theirs):
        problems.append(f"rows {len(mine)} / {len(theirs)}")
    for a, b in zip(mine, theirs):
        if a != b:
            problems.append(f"first difference {names}: {str(a)[:300]} / {str(b)[:300]}")
            break
    return problems
