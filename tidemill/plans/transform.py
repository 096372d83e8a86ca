"""The transformation stage: calendar columns and sales measures, added to cleaned rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions import measures
from tidemill.functions.dates import calendar_columns


def date_parts(df: DataFrame, column: str, prefix: str = "order_") -> DataFrame:
    return df.withColumns(calendar_columns(column, prefix))


def shipping_delay(df: DataFrame) -> DataFrame:
    """Real minus scheduled days, and the Delayed / On Time flag."""
    delayed = df.withColumn("shipping_delay_days", F.col("real_days") - F.col("scheduled_days"))
    return delayed.withColumn("shipping_performance", measures.shipping_performance("shipping_delay_days"))


def sales_measures(df: DataFrame) -> DataFrame:
    """Discount amount, revenue and profit margin."""
    discounted = df.withColumn("discount_amount", measures.discount_amount("price", "quantity", "discount_rate"))
    revenue = measures.gross_amount("price", "quantity") - F.col("discount_amount")
    with_revenue = discounted.withColumn("revenue", revenue)
    return with_revenue.withColumn("profit_margin", measures.profit_margin("profit", "revenue"))


def transform(df: DataFrame) -> DataFrame:
    """All derived columns; the frame needs ``order_datetime, real_days, scheduled_days, price,
    quantity, discount_rate, profit``."""
    return sales_measures(shipping_delay(date_parts(df, "order_datetime")))
