"""Calendar expressions. None of them depends on the session time zone for date input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def date_key(value: Column | str) -> Column:
    """Integer ``yyyymmdd`` by arithmetic, which stays inside generated code."""
    day = _col(value)
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def iso_date(value: Column | str) -> Column:
    return F.to_date(_col(value)).cast("string")


# Full English names.
MONTHS = [
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
]
DAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def month_full_name(value: Column | str) -> Column:
    """A constant array lookup, several times cheaper per row than a date formatter."""
    return F.get(F.array(*map(F.lit, MONTHS)), F.month(_col(value)) - 1)


def day_full_name(value: Column | str) -> Column:
    return F.get(F.array(*map(F.lit, DAYS)), F.weekday(_col(value)))


def quarter_label(value: Column | str) -> Column:
    return F.concat(F.lit("Q"), F.quarter(_col(value)).cast("string"))


def parse_or_null(value: Column | str, fmt: str) -> Column:
    """Text to timestamp without time zone; text that does not fit the format becomes NULL.

    The text is read as UTC, and the result built from its microseconds, so that an hour which the
    session's time zone leaves out stays as it is.
    """
    moment = F.try_to_timestamp(F.concat(_col(value), F.lit(" +00:00")), F.lit(f"{fmt} xxx"))
    seconds = (F.unix_micros(moment).cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    since = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + since


def parse_strict(value: Column | str, fmt: str) -> Column:
    """Text to timestamp without time zone; text that does not fit the format raises (ANSI mode)."""
    return F.to_timestamp_ntz(_col(value), F.lit(fmt))


def calendar_columns(value: Column | str, prefix: str = "") -> dict[str, Column]:
    """Year, month, names, quarter and day of one date or timestamp column."""
    day = _col(value)
    return {
        f"{prefix}year": F.year(day),
        f"{prefix}month": F.month(day),
        f"{prefix}month_name": month_full_name(day),
        f"{prefix}quarter": quarter_label(day),
        f"{prefix}day": F.dayofmonth(day),
        f"{prefix}day_name": day_full_name(day),
    }
