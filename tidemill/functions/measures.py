"""Sales measures. Money is decimal at full scale, so sums do not depend on the order of rows; only reports round."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,4)"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def shipping_performance(delay_days: Column | str) -> Column:
    """A missing delay counts as on time."""
    return F.when(_col(delay_days) > 0, F.lit("Delayed")).otherwise(F.lit("On Time"))


def gross_amount(price: Column | str, quantity: Column | str) -> Column:
    return _col(price) * _col(quantity)


def discount_amount(price: Column | str, quantity: Column | str, rate: Column | str) -> Column:
    return _col(price) * _col(quantity) * _col(rate)


def profit_margin(profit: Column | str, revenue: Column | str) -> Column:
    """Profit as a percentage of revenue; 0 where revenue is 0 or either side is missing."""
    ratio = F.try_divide(_col(profit).cast("double"), _col(revenue).cast("double"))
    return F.coalesce(ratio * F.lit(100.0), F.lit(0.0))


def report_money(total: Column) -> Column:
    """Round the decimal first and convert afterwards: half cents round the same everywhere."""
    return F.round(total, 2).cast("double")


def nan_to_null(value: Column | str) -> Column:
    col = _col(value)
    return F.when(~F.isnan(col), col)
