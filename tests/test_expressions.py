"""Text, date and measure expressions against literal expectations."""

from __future__ import annotations

import re
from datetime import datetime
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemill.functions import dates, measures, text

CONTACT = "\nMilk: dairy-7@farm.example, before noon.\n\tPhone 0401239876, or write to o_k@mill.example.org!\n"


def one(spark, value, expression, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expression.alias("r")).first()["r"]


def test_find_all_emails(spark):
    for search in (text.find_all, text.find_emails):
        assert one(spark, CONTACT, search("v")) == ["dairy-7@farm.example", "o_k@mill.example.org"]
        assert one(spark, "none", search("v")) == [] and one(spark, None, search("v")) is None
    assert one(spark, "é@x.fr none@", text.find_all("v")) == ["é@x.fr"]


def test_split_words_matches_python(spark):
    assert one(spark, CONTACT, text.split_words("v")) == re.split(r"\s+", CONTACT.strip())


def test_whitespace_is_that_of_python(spark):
    points = [i for i in range(1, 0x30000) if not 0xD800 <= i <= 0xDFFF]
    df = spark.createDataFrame([(i, chr(i)) for i in points], "i int, c string")
    found = {r["i"] for r in df.filter(F.col("c").rlike("^" + text.WHITESPACE_CLASS + "$")).collect()}
    spaces = {i for i in points if chr(i).isspace()}
    assert found == spaces == set(map(ord, text.WHITESPACE))
    assert {r["i"] for r in df.filter(text.is_blank("c")).collect()} == spaces


def test_mask_ten_digits_only(spark):
    assert one(spark, CONTACT, text.mask("v")) == re.sub(r"\d{10}", "XXXXXXXXXX", CONTACT)
    assert one(spark, "123456789", text.mask("v")) == "123456789"


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=" \t\n\x0b\x1c\x85\xa0 　abé_.@1٣²", max_size=30), min_size=1, max_size=20))
def test_text_functions_match_python(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    rows = df.select("i", text.strip("v"), text.split_words("v"), text.mask("v"), text.find_all("v"), text.find_emails("v")).collect()
    for i, stripped, words, masked, found, emails in rows:
        v = values[i]
        assert stripped == v.strip()
        assert words == re.split(r"\s+", v.strip())
        assert masked == re.sub(r"\d{10}", "XXXXXXXXXX", v)
        assert emails == found == re.findall(r"[\w\.-]+@[\w\.-]+\.\w+", v)


def test_strip_keeps_inner_runs(spark):
    assert one(spark, "\t\xa0 As Seen on  TV! 　", text.strip("v")) == "As Seen on  TV!"
    assert one(spark, " \t ", text.strip_to_null("v")) is None


def test_calendar_columns(spark):
    df = spark.createDataFrame([(datetime(2018, 2, 5, 22, 56),)], "v timestamp_ntz")
    row = df.select(
        *[c.alias(n) for n, c in dates.calendar_columns("v").items()],
        dates.date_key("v").alias("key"),
        dates.iso_date("v").alias("iso"),
    ).first()
    assert tuple(row) == (2018, 2, "February", "Q1", 5, "Monday", 20180205, "2018-02-05")


def test_missing_date_gives_missing_parts(spark):
    df = spark.createDataFrame([(None,)], "v timestamp_ntz")
    assert set(df.select(*dates.calendar_columns("v").values(), dates.date_key("v")).first()) == {None}


def test_parse_or_null(spark):
    assert one(spark, "not a date", dates.parse_or_null("v", "M/d/yyyy H:mm")) is None
    assert one(spark, "1/31/2018 22:56", dates.parse_or_null("v", "M/d/yyyy H:mm").cast("string")) == "2018-01-31 22:56:00"


def test_shipping_flag(spark):
    df = spark.createDataFrame([(1,), (0,), (-2,), (None,)], "d int")
    flags = [r[0] for r in df.select(measures.shipping_performance("d")).collect()]
    assert flags == ["Delayed", "On Time", "On Time", "On Time"]


def test_profit_margin_guard(spark):
    rows = [(Decimal("5"), Decimal("20")), (Decimal("5"), Decimal("0")), (None, Decimal("1")), (Decimal("5"), None)]
    df = spark.createDataFrame(rows, "p decimal(18,4), r decimal(18,4)")
    assert [r[0] for r in df.select(measures.profit_margin("p", "r")).collect()] == [25.0, 0.0, 0.0, 0.0]


def test_half_cents_round_in_decimal(spark):
    df = spark.createDataFrame([(Decimal("20165.2950"),)], "m decimal(18,4)")
    assert df.agg(measures.report_money(F.sum("m"))).first()[0] == 20165.30


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "v double")
    assert [r[0] for r in df.select(measures.nan_to_null("v")).collect()] == [None, 1.0, None]


def test_an_hour_that_a_time_zone_leaves_out_is_kept(spark):
    from tidemill.functions.dates import parse_or_null, parse_strict

    df = spark.createDataFrame([("3/13/2016 2:30",), ("1/2/1969 3:04",), ("soon",), (None,)], "t string")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = df.select(parse_or_null("t", "M/d/yyyy H:mm").cast("string")).collect()
        strict = df.filter("t LIKE '3%'").select(parse_strict("t", "M/d/yyyy H:mm").cast("string")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert [r[0] for r in got] == ["2016-03-13 02:30:00", "1969-01-02 03:04:00", None, None]
    assert strict == "2016-03-13 02:30:00"
