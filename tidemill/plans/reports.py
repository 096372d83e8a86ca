"""The report catalogue over the star schema.

Each report takes the tables by name and returns an ordered frame. Where the dimension key
determines the group, the fact is aggregated by that key before the join: the join then sees
one row per key, and a product that makes up a third of the fact costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.measures import report_money
from tidemill.operators.keys import dense_key, lookup_number
from tidemill.operators.load import has_bit
from tidemill.storage import join_side, materialize

Tables = dict[str, DataFrame]

TOP = 10


def _orders() -> Column:
    return F.count_distinct("order_id").alias("total_orders")


def order_bitmaps(fact: DataFrame, group: list[str], number: str = "order_number") -> DataFrame:
    """The groups' orders as bitmaps: ``group, bucket, orders``, one row for 32,768 numbers.

    Ids are not shuffled: a task sends a bitmap for each group and range of order numbers that it has seen, however
    many rows an order has. Bitmaps of several days or loads are joined by ``bitmap_or_agg``.
    """
    bucket = F.bitmap_bucket_number(number).alias("bucket")
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("orders")
    return fact.filter(F.col(number).isNotNull()).groupBy(*group, bucket).agg(bits)


def _with_orders(fact: DataFrame, group: list[str], partial: list[Column], final: list[Column], name: str = "total_orders",
                 number: str = "order_number") -> DataFrame:
    """Exact distinct orders of few groups beside other aggregates, in one scan.

    ``partial`` is computed by group and range of order numbers, together with the bitmap of that range; ``final`` adds
    up the ranges. A row without order counts in the aggregates only. Groups should be few: each has its own bitmaps.
    """
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("_orders")
    ranges = fact.groupBy(*group, F.bitmap_bucket_number(number).alias("_bucket")).agg(bits, *partial)
    counted = F.sum(F.when(F.col("_bucket").isNotNull(), F.bitmap_count("_orders"))).alias(name)
    orders = F.coalesce(counted, F.lit(0).cast("long")).alias(name)
    return ranges.groupBy(*group).agg(orders, *final) if group else ranges.agg(orders, *final)


def _partial_sums(*columns: str) -> list[Column]:
    return [F.sum(c).alias(c) for c in columns]


#: What can be added up, by the name that reports use.
MEASURES: dict[str, Callable[[], Column]] = {
    "items": lambda: F.count(F.lit(1)),
    **{c: lambda c=c: F.sum(c) for c in ("quantity", "sales", "revenue", "profit", "profit_margin")},
    "margins": lambda: F.count("profit_margin"),
    "discount": lambda: F.sum("discount_amount"),
    "discounts": lambda: F.count("discount_amount"),
    "delay": lambda: F.sum("shipping_delay_days"),
    "delays": lambda: F.count("shipping_delay_days"),
    "delayed": lambda: F.count_if(F.col("shipping_delay_days") > 0),
}
#: Columns of the fact by which measures are added up in one scan, each by itself and all together.
ROLLUP_KEYS = ["order_date_key", "location_key", "product_key", "shipping_key", "shipping_delay_days"]
#: Groups whose distinct orders are counted in one scan, and the whole.
ORDER_GROUPS = [
    ["year"], ["market"], ["order_region"], ["order_city", "order_state", "order_country"], ["shipping_mode"],
    ["customer_segment"], ["category_name"], [],
]
#: The dimension of each group and its key in the fact.
ORDER_TABLES = ["dim_date", "dim_location", "dim_location", "dim_location", "dim_shipping", "dim_customer", "dim_product", None]
ORDER_KEYS = ["order_date_key", "location_key", "location_key", "location_key", "shipping_key", "customer_key", "product_key", None]


def _set_number(all_columns: list[str], grouped: list[str]) -> int:
    """What grouping_id gives for a grouping set: a bit for each column that is not in it."""
    return sum(1 << (len(all_columns) - 1 - i) for i, c in enumerate(all_columns) if c not in grouped)


def _codes(dimension: DataFrame, key: str, group: list[str], code: str) -> tuple[DataFrame, DataFrame]:
    """``key, code`` of a dimension, and ``code`` with the columns of a group: 0, 1, ... for the few groups there are."""
    numbered = dense_key(dimension.select(*group).distinct(), code, group)
    codes = materialize(numbered.withColumn(code, F.col(code) - 1), code)
    named = join_side(codes).alias("n")
    same = reduce(lambda a, b: a & b, [F.col(f"d.{c}").eqNullSafe(F.col(f"n.{c}")) for c in group])
    pairs = dimension.alias("d").join(named, same).select(f"d.{key}", f"n.{code}")
    return materialize(pairs, f"{code}-keys"), codes


def _count_orders(t: Tables) -> DataFrame:
    """``grouped, total_orders`` and the group's columns, for every group of ``ORDER_GROUPS``.

    Each group has a number, and an order one bit for each group that it has rows in: 64 groups are one whole number, so
    an order's rows meet in a hash aggregate, leave a task as one row for a kind of group, and are counted by equal
    numbers. What is shuffled grows with the orders, however their numbers are spread over the files.
    """
    rows, kinds, names = t["fact_sales"].filter("order_number IS NOT NULL"), len(ORDER_GROUPS), {}
    for i, (table, key, group) in enumerate(zip(ORDER_TABLES, ORDER_KEYS, ORDER_GROUPS)):
        if table is None:
            rows = rows.withColumn(f"_code{i}", F.lit(0).cast("long"))
            continue
        dimension = t[table].withColumnRenamed("date_key", "order_date_key") if table == "dim_date" else t[table]
        pairs, names[i] = _codes(dimension, key, group, f"_code{i}")
        rows = lookup_number(rows, pairs, key, f"_code{i}")
    code = F.col("of.code")
    of = F.explode(F.array(*[F.struct(F.lit(i).alias("kind"), F.col(f"_code{i}").alias("code")) for i in range(kinds)]))
    rows = rows.select("order_number", of.alias("of")).filter("of.code IS NOT NULL").select(
        "order_number",
        (F.shiftright(code, 6) * kinds + F.col("of.kind")).alias("slot"),
        F.call_function("shiftleft", F.lit(1).cast("long"), code.bitwiseAND(63).cast("int")).alias("bit"),
    )
    orders = rows.groupBy("order_number", "slot").agg(F.bit_or("bit").alias("bits"))
    alike = orders.groupBy("slot", "bits").agg(F.count(F.lit(1)).alias("orders"))
    bits = alike.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(63)))).filter(F.getbit("bits", F.col("i")) == 1)
    counts = bits.groupBy("slot", "i").agg(F.sum("orders").alias("total_orders")).select(
        (F.col("slot") % kinds).cast("int").alias("grouped"), (F.expr(f"slot div {kinds}") * 64 + F.col("i")).alias("code"),
        "total_orders",
    )
    counts = materialize(counts, "order-groups")
    found = []
    for i, group in enumerate(ORDER_GROUPS):
        of_kind = counts.filter(F.col("grouped") == i)
        if group:
            of_kind = of_kind.join(join_side(names[i]), F.col("code") == F.col(f"_code{i}"))
        found.append(of_kind.select("grouped", *group, "total_orders"))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found)


def _count_buyers(t: Tables) -> DataFrame:
    """``customer_segment, unique_customers, sales, profit``; customers by bitmaps of their dense surrogate keys."""
    bucket = F.bitmap_bucket_number("customer_key").alias("_bucket")
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("customer_key")).alias("_bits")
    seen = t["fact_sales"].filter("customer_key IS NOT NULL").groupBy(bucket).agg(bits)
    seen = join_side(materialize(seen, "customers-seen"))
    found = t["dim_customer"].select("customer_key", "customer_segment").withColumn("_bucket", bucket).join(seen, "_bucket")
    found = found.filter(has_bit(F.col("_bits"), F.bitmap_bit_position("customer_key")))
    found = found.groupBy("customer_segment").agg(F.count(F.lit(1)).alias("unique_customers"))
    pairs, codes = _codes(t["dim_customer"], "customer_key", ["customer_segment"], "_segment")
    sums = lookup_number(t["fact_sales"].select("customer_key", "sales", "profit"), pairs, "customer_key", "_segment")
    sums = sums.filter("_segment IS NOT NULL").groupBy("_segment").agg(*_partial_sums("sales", "profit"))
    # one row for a segment on either side
    both = sums.join(codes, "_segment").alias("s").join(found.alias("b"), F.expr("s.customer_segment <=> b.customer_segment"))
    return both.select("s.customer_segment", "unique_customers", "sales", "profit")


def shared(t: Tables) -> Tables:
    """The tables with the answers of a few scans of the fact, from which the reports then come.

    ``rollup`` has all measures by each key of the fact but the customer's, as many rows as these dimensions together;
    ``order_counts`` the distinct orders of every group that a report asks for, ``buyers`` the customers and sums of each
    segment. Reports look there first. Groups are looked up as numbers, so a product or customer dimension of millions
    moves no row of the fact. The dimensions come back with a hint by their measured size, for the reports' own joins.
    """
    fact = t["fact_sales"]
    sets = [[k] for k in ROLLUP_KEYS] + [[]]
    rollup = fact.groupingSets([[F.col(c) for c in one] for one in sets], *[F.col(c) for c in ROLLUP_KEYS])
    rollup = rollup.agg(F.grouping_id().alias("grouped"), *[m().alias(f"_{name}") for name, m in MEASURES.items()])
    return {
        **t,
        **{name: join_side(df) for name, df in t.items() if name.startswith("dim_")},
        "rollup": materialize(rollup, "rollup"),
        "order_counts": materialize(_count_orders(t), "order-counts"),
        "buyers": materialize(_count_buyers(t), "buyers"),
    }


def _added_up(t: Tables, key: str | None, *measures: str) -> DataFrame:
    """Measures by a key of the fact, or of the whole: from the shared scan if there was one."""
    if "rollup" in t:
        number = _set_number(ROLLUP_KEYS, [key] if key else [])
        rows = t["rollup"].filter(F.col("grouped") == number)
        return rows.select(*([key] if key else []), *[F.col(f"_{m}").alias(m) for m in measures])
    aggregates = [MEASURES[m]().alias(m) for m in measures]
    return t["fact_sales"].groupBy(key).agg(*aggregates) if key else t["fact_sales"].agg(*aggregates)


def _order_counts(t: Tables, group: list[str]) -> DataFrame:
    """``group, total_orders`` of the shared scan; a group without a partner in its dimension is left out."""
    return t["order_counts"].filter(F.col("grouped") == ORDER_GROUPS.index(group)).select(*group, "total_orders")


def _counted(t: Tables, placed: DataFrame, group: list[str], final: list[Column]) -> DataFrame:
    """Final aggregates of the shared scan's measures with the distinct orders of each group."""
    sums = placed.groupBy(*group).agg(*final).alias("s") if group else placed.agg(*final).alias("s")
    same = F.lit(True)
    for c in group:
        same = same & F.col(f"s.{c}").eqNullSafe(F.col(f"o.{c}"))
    orders = _order_counts(t, group).alias("o")
    if not group:  # one row on either side
        sums, orders, same = sums.withColumn("_one", F.lit(1)), orders.withColumn("_one", F.lit(1)), F.expr("s._one = o._one")
    names = [c for c in sums.columns if c not in (*group, "_one")]
    total = F.coalesce("o.total_orders", F.lit(0).cast("long")).alias("total_orders")
    return sums.alias("s").join(orders.alias("o"), same, "left").select(*[f"s.{c}" for c in group], total, *[f"s.{c}" for c in names])


def _money(column: str, name: str) -> Column:
    return report_money(F.sum(column)).alias(name)


def _mean(column: str, rows: str | None = None) -> Column:
    """Mean rounded to 2; with ``rows`` the mean of pre-aggregated sums. Never negative zero."""
    mean = F.avg(column) if rows is None else F.try_divide(F.sum(column).cast("double"), F.sum(rows))
    return F.round(mean, 2) + F.lit(0.0)


def _sales_profit() -> list[Column]:
    return [_money("sales", "total_sales"), _money("profit", "total_profit")]


def overall_performance(t: Tables) -> DataFrame:
    measures = ["quantity", "sales", "revenue", "profit", "profit_margin", "margins", "items"]
    final = [
        F.coalesce(F.sum("items"), F.lit(0)).alias("total_order_items"),
        F.sum("quantity").alias("total_quantity"),
        _money("sales", "total_sales"),
        _money("revenue", "total_revenue"),
        _money("profit", "total_profit"),
        _mean("profit_margin", rows="margins").alias("average_profit_margin"),
    ]
    if "rollup" in t:
        return _counted(t, _added_up(t, None, *measures), [], final)
    return _with_orders(t["fact_sales"], [], [MEASURES[m]().alias(m) for m in measures], final)


def _dated(t: Tables, period: Column | None = None) -> DataFrame:
    """Facts with the calendar of their order date. A condition on the calendar also chooses the years that are read.

    The fact lies by order year, and the year is part of the join, so the days that meet the condition prune its
    partitions at run time.
    """
    days = t["dim_date"] if period is None else t["dim_date"].filter(period)
    same = (F.col("order_date_key") == F.col("date_key")) & (F.col("order_year") == F.col("year"))
    return t["fact_sales"].join(days, same)


def yearly_sales(t: Tables, period: Column | None = None) -> DataFrame:
    if "rollup" in t and period is None:
        per_day = _added_up(t, "order_date_key", "sales", "profit")
        placed = per_day.join(t["dim_date"], F.col("order_date_key") == F.col("date_key"))
        return _counted(t, placed, ["year"], _sales_profit()).orderBy("year")
    by_year = _with_orders(_dated(t, period), ["year"], _partial_sums("sales", "profit"), _sales_profit())
    return by_year.orderBy("year")


def monthly_sales(t: Tables, period: Column | None = None) -> DataFrame:
    days, same = t["dim_date"], F.col("order_date_key") == F.col("date_key")
    if period is None:
        per_day = _added_up(t, "order_date_key", "sales", "profit")
    else:
        days, same = days.filter(period), same & (F.col("order_year") == F.col("year"))
        per_day = t["fact_sales"].groupBy("order_year", "order_date_key").agg(*_partial_sums("sales", "profit"))
    return per_day.join(days, same).groupBy("year", "month", "month_name").agg(*_sales_profit()).orderBy("year", "month")


def _by_location(t: Tables, *group: str) -> DataFrame:
    if "rollup" in t:
        placed = _added_up(t, "location_key", "sales", "profit").join(t["dim_location"], "location_key")
        return _counted(t, placed, list(group), _sales_profit())
    placed = t["fact_sales"].join(t["dim_location"], "location_key")
    return _with_orders(placed, list(group), _partial_sums("sales", "profit"), _sales_profit())


def market_sales(t: Tables) -> DataFrame:
    return _by_location(t, "market").orderBy(F.desc("total_sales"), "market")


def region_sales(t: Tables) -> DataFrame:
    return _by_location(t, "order_region").orderBy(F.desc("total_sales"), "order_region")


def top_cities(t: Tables) -> DataFrame:
    place = ["order_city", "order_state", "order_country"]
    return _by_location(t, *place).orderBy(F.desc("total_sales"), *place).limit(TOP)


def top_products(t: Tables) -> DataFrame:
    """The product key identifies a row, also where two products share a name."""
    fact = t["fact_sales"]
    if "rollup" in t:  # the ten are known without the orders, which are counted for them alone
        first = _added_up(t, "product_key", "sales").join(t["dim_product"].select("product_key"), "product_key")
        first = first.orderBy(F.desc(report_money(F.col("sales"))), "product_key").limit(TOP).collect()
        fact = fact.filter(F.col("product_key").isin([r["product_key"] for r in first]))
    per_product = fact.groupBy("product_key").agg(
        _orders(), F.sum("quantity").alias("quantity_sold"), *_sales_profit()
    )
    return (
        per_product.join(t["dim_product"], "product_key")
        .orderBy(F.desc("total_sales"), "product_key")
        .limit(TOP)
        .select("product_name", "category_name", "total_orders", "quantity_sold", "total_sales", "total_profit")
    )


def category_sales(t: Tables) -> DataFrame:
    """Grouped by name: categories that share a name are one row."""
    if "rollup" in t:
        placed = _added_up(t, "product_key", "quantity", "sales", "profit").join(t["dim_product"], "product_key")
        final = [F.sum("quantity").alias("quantity_sold"), *_sales_profit()]
        return _counted(t, placed, ["category_name"], final).orderBy(F.desc("total_sales"), "category_name")
    return (
        t["fact_sales"]
        .join(t["dim_product"], "product_key")
        .groupBy("category_name")
        .agg(_orders(), F.sum("quantity").alias("quantity_sold"), *_sales_profit())
        .orderBy(F.desc("total_sales"), "category_name")
    )


def customer_segments(t: Tables) -> DataFrame:
    """Two distinct counts: orders by their numbers, customers by their dense surrogate key, both by bitmaps."""
    if "rollup" in t:
        orders, same = _order_counts(t, ["customer_segment"]).alias("o"), F.expr("b.customer_segment <=> o.customer_segment")
        money = [report_money(F.col(c)).alias(f"total_{c}") for c in ("sales", "profit")]
        total = F.coalesce("o.total_orders", F.lit(0).cast("long")).alias("total_orders")
        both = t["buyers"].alias("b").join(orders, same, "left")
        found = both.select("b.customer_segment", total, "unique_customers", *money)
        return found.orderBy(F.desc("total_sales"), "customer_segment")
    placed = t["fact_sales"].join(t["dim_customer"], "customer_key")
    partial, final = _partial_sums("sales", "profit"), _sales_profit()
    orders = _with_orders(placed, ["customer_segment"], partial, final)
    customers = t["fact_sales"].select("customer_key").join(t["dim_customer"], "customer_key")
    customers = _with_orders(customers, ["customer_segment"], [], [], "unique_customers", "customer_key")
    # one row for a segment on either side
    both = orders.alias("o").join(customers.alias("c"), F.expr("o.customer_segment <=> c.customer_segment"))
    return both.select(
        "o.customer_segment", "total_orders", "unique_customers", "total_sales", "total_profit"
    ).orderBy(F.desc("total_sales"), "customer_segment")


def shipping_performance(t: Tables) -> DataFrame:
    measures = ["delay", "delays", "delayed", "items"]
    final = [
        _mean("delay", rows="delays").alias("average_shipping_delay"),
        F.sum("delayed").alias("delayed_items"),
        F.round(F.lit(100.0) * F.sum("delayed") / F.sum("items"), 2).alias("delay_percentage"),
    ]
    if "rollup" in t:
        shipped = _added_up(t, "shipping_key", *measures).join(t["dim_shipping"], "shipping_key")
        found = _counted(t, shipped, ["shipping_mode"], final)
    else:
        shipped = t["fact_sales"].join(t["dim_shipping"], "shipping_key")
        found = _with_orders(shipped, ["shipping_mode"], [MEASURES[m]().alias(m) for m in measures], final)
    return found.orderBy(F.desc("delay_percentage"), "shipping_mode")


def _product_profit(t: Tables) -> DataFrame:
    measures = _added_up(t, "product_key", "sales", "profit", "profit_margin", "margins")
    margin = F.try_divide(F.col("profit_margin"), F.col("margins"))
    per_product = measures.select(
        "product_key",
        report_money(F.col("sales")).alias("total_sales"),
        report_money(F.col("profit")).alias("total_profit"),
        (F.round(margin, 2) + F.lit(0.0)).alias("average_profit_margin"),
    )
    return per_product.join(t["dim_product"], "product_key")


PROFIT_COLUMNS = ["product_name", "category_name", "total_sales", "total_profit", "average_profit_margin"]


def profitable_products(t: Tables) -> DataFrame:
    return _product_profit(t).orderBy(F.desc("total_profit"), "product_key").limit(TOP).select(*PROFIT_COLUMNS)


def loss_products(t: Tables) -> DataFrame:
    return _product_profit(t).orderBy(F.asc("total_profit"), "product_key").limit(TOP).select(*PROFIT_COLUMNS)


def discount_analysis(t: Tables) -> DataFrame:
    per_product = _added_up(t, "product_key", "discount", "discounts", "sales", "profit")
    return (
        per_product.join(t["dim_product"], "product_key")
        .groupBy("category_name")
        .agg(_mean("discount", rows="discounts").alias("average_discount"), *_sales_profit())
        .orderBy(F.desc("average_discount"), "category_name")
    )


def shipping_delay(t: Tables) -> DataFrame:
    found = _added_up(t, "shipping_delay_days", "items", "sales", "profit")
    money = [report_money(F.col(c)).alias(f"total_{c}") for c in ("sales", "profit")]
    return found.select("shipping_delay_days", F.col("items").alias("order_items"), *money).orderBy("shipping_delay_days")


def order_status(t: Tables) -> DataFrame:
    """Kept from the SQL catalogue: order, sales and profit totals."""
    if "rollup" in t:
        return _counted(t, _added_up(t, None, "sales", "profit"), [], _sales_profit())
    return _with_orders(t["fact_sales"], [], _partial_sums("sales", "profit"), _sales_profit())


REPORTS: dict[str, Callable[[Tables], DataFrame]] = {
    report.__name__: report
    for report in (
        overall_performance, yearly_sales, monthly_sales, market_sales, region_sales, top_products,
        category_sales, customer_segments, shipping_performance, profitable_products, loss_products,
        top_cities, discount_analysis, shipping_delay,
    )
}


def category_sales_report(orders: DataFrame, products: DataFrame, product_id: str, quantity: str, price: str,
                          category: str) -> DataFrame:
    """Quantity and amount per category of an order table and a product table.

    Quantities are added per product before the join, because the price belongs to the product.
    """
    per_product = orders.groupBy(product_id).agg(F.sum(quantity).alias("_quantity"))
    return (
        per_product.join(products, product_id)
        .groupBy(category)
        .agg(
            F.sum("_quantity").alias("total_quantity"),
            F.sum(F.col("_quantity") * F.col(price)).alias("total_sales"),
        )
    )


def sales_by_category(sales: DataFrame, category: str, amount: str) -> DataFrame:
    return sales.groupBy(category).agg(F.sum(amount).alias("total_sales"))


def average_by_category(sales: DataFrame, category: str, amount: str) -> DataFrame:
    return sales.groupBy(category).agg(F.avg(amount).alias("average_sales"))
