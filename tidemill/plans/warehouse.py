"""The star schema: five dimensions, one fact table, their gates and their load order.

Input is a staging table with one row per order item and a dense ``row_id`` (1..n) that states
the order of the source rows. "First appearance" below means the smallest ``row_id``.

Surrogate keys are stable: a build publishes a map of natural keys to surrogates with its tables, and the next build
numbers only what the map does not hold. New rows can be loaded by themselves: they are added to the published tables
as further files.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.dates import calendar_columns, date_key, iso_date
from tidemill.operators import quality
from tidemill.operators.keys import dense_key, first_versions, lookup_key, lookup_number
from tidemill.operators.load import anti_join_numbers
from tidemill.storage import VersionedTables, join_side, materialize

# Column names of the star schema, which exports and reports use.
CUSTOMER = ["customer_city", "customer_state", "customer_country", "customer_segment"]
PRODUCT = ["product_name", "category_id", "category_name", "department_id", "department_name", "product_price"]
LOCATION = ["market", "order_city", "order_state", "order_country", "order_region", "latitude", "longitude"]
SHIPPING = ["shipping_mode", "scheduled_days"]
MEASURES = ["quantity", "sales", "discount_amount", "revenue", "profit", "profit_margin", "shipping_delay_days"]
FACT_KEYS = [
    "customer_key", "product_key", "order_date_key", "shipping_date_key", "location_key", "shipping_key",
]
DATE_COLUMNS = ["order_datetime", "shipping_datetime"]
TABLES = ["dim_date", "dim_customer", "dim_product", "dim_location", "dim_shipping", "fact_sales"]
#: Columns of the stored fact that serve its plans and are not part of its exports: a dense number of the order, from
#: which distinct orders are counted by bitmaps, and the year by which the files are laid out.
LAYOUT = ["order_number", "order_year"]
#: Natural key and surrogate of each key map.
KEYS = {
    "dim_customer": (["customer_id"], "customer_key"),
    "dim_product": (["product_id"], "product_key"),
    "dim_location": (LOCATION, "location_key"),
    "dim_shipping": (SHIPPING, "shipping_key"),
    "order_numbers": (["order_id"], "order_number"),
}
#: Folders of a table from which its increments are joined.
MAX_FOLDERS = 16
#: Jobs of an increment that run beside each other.
AT_ONCE = 2


def dim_date(staging: DataFrame) -> DataFrame:
    """One row per day that occurs as an order or shipping date. One scan covers both roles."""
    days = (
        staging.select(F.explode(F.array(*[F.to_date(c) for c in DATE_COLUMNS])).alias("d"))
        .filter("d is not null")
        .distinct()
    )
    return days.select(
        date_key("d").alias("date_key"),
        iso_date("d").alias("full_date"),
        *[value.alias(name) for name, value in calendar_columns("d").items()],
    )


def _same(left: str, right: str, columns: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns])


def _numbered(
    staging: DataFrame, keys: list[str], attributes: list[str], key: str, known: DataFrame | None = None
) -> DataFrame:
    """First version per natural key. Keys of the map ``known`` stay; others are numbered on by first appearance."""
    first = first_versions(staging, keys, attributes, "row_id")
    if known is None:
        return dense_key(first, key, ["first_row"]).drop("first_row")
    first = materialize(first, f"first-{key}").alias("f")
    known = join_side(known.select(*keys, key)).alias("k")
    old = first.join(known, _same("f", "k", keys)).select(F.col(f"k.{key}"), *[f"f.{c}" for c in (*keys, *attributes)])
    return old.unionByName(_unknown(first, known, keys, key).drop("first_row"))


def _unknown(first: DataFrame, known: DataFrame, keys: list[str], key: str) -> DataFrame:
    """Natural keys that the map does not hold, numbered from its highest key on."""
    top = known.agg(F.max(key)).first()[0] or 0
    new = first.alias("f").join(join_side(known.select(*keys)).alias("k"), _same("f", "k", keys), "left_anti")
    return dense_key(new, key, ["first_row"]).withColumn(key, F.col(key) + top)


def dim_customer(staging: DataFrame, known: DataFrame | None = None) -> DataFrame:
    return _numbered(staging, ["customer_id"], CUSTOMER, "customer_key", known)


def dim_product(staging: DataFrame, known: DataFrame | None = None) -> DataFrame:
    return _numbered(staging, ["product_id"], PRODUCT, "product_key", known)


def dim_location(staging: DataFrame, known: DataFrame | None = None) -> DataFrame:
    return _numbered(staging, LOCATION, [], "location_key", known)


def dim_shipping(staging: DataFrame, known: DataFrame | None = None) -> DataFrame:
    return _numbered(staging, SHIPPING, [], "shipping_key", known)


DIMENSIONS = {
    "dim_date": dim_date,
    "dim_customer": dim_customer,
    "dim_product": dim_product,
    "dim_location": dim_location,
    "dim_shipping": dim_shipping,
}


def fact_sales(staging: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """One row per staging row: surrogate key, order ids, dimension keys, measures, and the columns of its layout."""
    # small dimensions with wide natural keys first: what a later lookup shuffles are numbers
    looked_up = staging
    for table, natural, key in [
        ("dim_shipping", SHIPPING, "shipping_key"),
        ("dim_location", LOCATION, "location_key"),
    ]:
        side = join_side(dims[table].select(*natural, key))
        looked_up = lookup_key(looked_up, side, {c: c for c in natural}, key)
    looked_up = looked_up.select(
        F.col("row_id").alias("sales_key"),
        "order_id",
        "order_item_id",
        "customer_id",
        "product_id",
        date_key("order_datetime").alias("order_date_key"),
        date_key("shipping_datetime").alias("shipping_date_key"),
        "location_key",
        "shipping_key",
        *MEASURES,
    )
    for table, natural, key in [
        ("dim_customer", "customer_id", "customer_key"),
        ("dim_product", "product_id", "product_key"),
    ]:
        looked_up = lookup_number(looked_up, dims[table], natural, key)
    # orders grow with the fact, so this one lookup shuffles at every size
    orders = dims["order_numbers"].hint("merge")
    looked_up = lookup_key(looked_up, orders, {"order_id": "order_id"}, "order_number")
    return looked_up.select(
        "sales_key",
        "order_id",
        "order_item_id",
        "customer_key",
        "product_key",
        "order_date_key",
        "shipping_date_key",
        "location_key",
        "shipping_key",
        *MEASURES,
        "order_number",
        F.expr("order_date_key div 10000").cast("int").alias("order_year"),
    )


def public(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables as exports have them, without the layout's columns."""
    return {name: df.drop(*LAYOUT) if name == "fact_sales" else df for name, df in tables.items()}


def fact_output(fact: DataFrame) -> DataFrame:
    """The fact with money as double, the type it has in exports."""
    return fact.drop(*LAYOUT).withColumns(
        {c: F.col(c).cast("double") for c in ("sales", "discount_amount", "revenue", "profit")}
    )


def references(tables: dict[str, DataFrame]) -> dict[str, tuple[DataFrame, str]]:
    """Foreign key of the fact -> (dimension, its key)."""
    return {
        "customer_key": (tables["dim_customer"], "customer_key"),
        "product_key": (tables["dim_product"], "product_key"),
        "order_date_key": (tables["dim_date"], "date_key"),
        "shipping_date_key": (tables["dim_date"], "date_key"),
        "location_key": (tables["dim_location"], "location_key"),
        "shipping_key": (tables["dim_shipping"], "shipping_key"),
    }


def _map_name(table: str) -> str:
    return table if table == "order_numbers" else f"keys_{table}"


MAPS = [_map_name(name) for name in KEYS]


def check_dates(staging: DataFrame) -> None:
    quality.assert_gate(quality.invalid_dates(staging, DATE_COLUMNS), "invalid dates", "invalid")


def _check_fact(fact: DataFrame) -> None:
    quality.assert_gate(quality.missing_keys(fact, FACT_KEYS), "missing dimension keys", "missing")


def _together(jobs: dict[str, Callable[[], object]], at_once: int | None = None) -> dict[str, object]:
    """Results of jobs that do not depend on each other, submitted at the same time, or ``at_once`` of them."""
    with ThreadPoolExecutor(max_workers=at_once or len(jobs)) as pool:
        submitted = {name: pool.submit(job) for name, job in jobs.items()}
        return {name: job.result() for name, job in submitted.items()}


def _number_orders(staging: DataFrame, store: VersionedTables, before: DataFrame | None) -> tuple[int, DataFrame]:
    """A dense number for each order, by first appearance: neighbouring rows share bitmaps."""
    first = first_versions(staging.filter("order_id IS NOT NULL"), ["order_id"], [], "row_id")
    if before is None:
        new = dense_key(first, "order_number", ["first_row"])
    else:
        new = _unknown(materialize(first, "first-order"), before, ["order_id"], "order_number")
    return _grow(store, "order_numbers", before, new.select("order_id", "order_number"))


def _grow(
    store: VersionedTables, name: str, before: DataFrame | None, new: DataFrame, layout: list[str] | None = None
) -> tuple[int, DataFrame]:
    """A version of the rows ``before`` and the new ones; only the latter are written, unless there are many folders."""
    if before is None:
        return store.write_version(name, new, layout)
    if len(store.parts(name, store.current(name))) >= MAX_FOLDERS:
        return store.write_version(name, before.unionByName(new), layout)
    return store.append_version(name, new, layout)


def build_warehouse(staging: DataFrame, store: VersionedTables) -> dict[str, DataFrame]:
    """Check dates, write the dimensions, then the fact, and publish all at once with complete keys.

    Until then readers see the build before, and after a failed gate as well: keys of one build
    mean nothing in another that was never published. Natural keys of the published key maps keep their surrogates, also
    if they are missing from this ``staging`` and come back later. ``staging`` should be a written table: every
    dimension reads only its own columns of it. The dimensions do not depend on each other, so their jobs are
    submitted together.
    """
    check_dates(staging)
    known = store.read_together(MAPS) if store.holds_build(MAPS) else dict.fromkeys(MAPS)

    def number(name: str):
        """A dimension and its key map, which also keeps the keys that this staging does not have."""
        if name not in KEYS:
            return {name: store.write_version(name, DIMENSIONS[name](staging))}
        (natural, key), before = KEYS[name], known[_map_name(name)]
        if name == "order_numbers":
            return {name: _number_orders(staging, store, before)}
        build = DIMENSIONS[name]
        written = store.write_version(name, build(staging) if before is None else build(staging, before))
        pairs = written[1].select(*natural, key)
        if before is not None:
            pairs = pairs.filter(F.col(key) > (before.agg(F.max(key)).first()[0] or 0))
        return {name: written, _map_name(name): _grow(store, _map_name(name), before, pairs)}

    built = _together({name: lambda name=name: number(name) for name in [*DIMENSIONS, "order_numbers"]})
    written = {name: version for group in built.values() for name, version in group.items()}
    tables = {name: df for name, (_, df) in written.items()}
    # a task writes a file for each year it has: bringing a year together would shuffle the whole fact once more
    fact = fact_sales(staging, tables)
    written["fact_sales"] = store.write_version("fact_sales", fact, partition_by=["order_year"])
    tables["fact_sales"] = written["fact_sales"][1]
    _check_fact(tables["fact_sales"])
    store.publish({name: version for name, (version, _) in written.items()})
    return {name: tables[name] for name in [*TABLES, "order_numbers"]}


def extend_warehouse(staging: DataFrame, store: VersionedTables) -> dict[str, DataFrame]:
    """Load further staging rows into the published build: what is there is not written again.

    Rows whose ``row_id`` the fact holds are left out, so a repeated call changes nothing. New members of the dimensions
    are numbered on, an existing member keeps its first attributes. New members and facts become further files of the
    tables, and all tables are published together. A table of more than ``MAX_FOLDERS`` increments is joined first.
    """
    before = store.read_together([*TABLES, *MAPS])
    loaded = before["fact_sales"].select(F.col("sales_key").alias("row_id"))
    rows = anti_join_numbers(staging, loaded, "row_id")
    if rows.isEmpty():
        return {name: before[name] for name in [*TABLES, "order_numbers"]}
    check_dates(rows)

    def number(name: str):
        if name == "order_numbers":
            return {name: _number_orders(rows, store, before[name])}
        if name == "dim_date":
            days = dim_date(rows).join(before[name].select("date_key"), "date_key", "left_anti")
            return {name: _grow(store, name, before[name], days.select(*before[name].columns))}
        (natural, key), known, table = KEYS[name], before[_map_name(name)], before[name]
        attributes = [c for c in table.columns if c not in (*natural, key)]
        first = materialize(first_versions(rows, natural, attributes, "row_id"), f"first-{key}")
        members = materialize(_unknown(first, known, natural, key).select(*table.columns), f"new-{key}")
        # a member that the build before left out comes back with the key it had
        there = join_side(table.select(*natural)).alias("d")
        back = first.alias("f").join(there, _same("f", "d", natural), "left_anti")
        back = back.alias("f").join(join_side(known.select(*natural, key)).alias("k"), _same("f", "k", natural))
        back = back.select(F.col(f"k.{key}"), *[f"f.{c}" for c in (*natural, *attributes)])
        grown = _grow(store, name, table, members.unionByName(back))
        return {name: grown, _map_name(name): _grow(store, _map_name(name), known, members.select(*natural, key))}

    # each job holds the bitmaps of the loaded rows on the driver while it runs
    built = _together({name: lambda name=name: number(name) for name in [*DIMENSIONS, "order_numbers"]}, at_once=AT_ONCE)
    written = {name: version for group in built.values() for name, version in group.items()}
    fact = fact_sales(rows, {name: df for name, (_, df) in written.items()})
    version, _ = written["fact_sales"] = _grow(store, "fact_sales", before["fact_sales"], fact, ["order_year"])
    _check_fact(store.read_version("fact_sales", version, {f"v{version}": None}))
    store.publish({name: version for name, (version, _) in written.items()})
    return {name: written[name][1] for name in [*TABLES, "order_numbers"]}


def register_views(tables: dict[str, DataFrame]) -> None:
    """Expose the star schema to ``spark.sql``."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
