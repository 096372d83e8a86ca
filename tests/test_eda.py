"""Statistics against the literal frame and against brute force."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemill.operators import eda, quantiles

FRAME = [(3, 30, 4.0, 7), (4, 28, 5.0, 7), (6, 24, 9.0, 7), (7, 22, 8.0, 7), (10, 16, 15.0, 7), (90, 1, 2.0, 7)]
COLUMNS = ["depth", "light", "load", "site"]


@pytest.fixture()
def frame(spark):
    return spark.createDataFrame(FRAME, "depth int, light int, load double, site int")


def test_iqr(frame):
    assert tuple(eda.iqr_bounds(frame, ["depth"]).first()) == ("depth", 4.5, 9.25, 4.75, -2.625, 16.375)
    assert sorted(r["depth"] for r in eda.iqr_filter(frame, "depth").collect()) == [3, 4, 6, 7, 10]


def test_feature_selection(frame):
    clean = eda.iqr_filter(frame, "depth")
    assert eda.select_features(clean, COLUMNS).columns == ["depth", "light", "load"]
    assert {r[0]: r[2] for r in eda.feature_variance(clean, COLUMNS).collect()}["site"] is False


def test_correlation(frame):
    got = {(r[0], r[1]): r[2] for r in eda.corr_matrix(eda.iqr_filter(frame, "depth"), COLUMNS).collect()}
    assert len(got) == 16
    assert got["depth", "light"] == pytest.approx(-1.0)
    assert got["site", "site"] is None and got["depth", "site"] is None
    assert got["light", "load"] == got["load", "light"]


def test_correlation_uses_complete_pairs(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, None), (None, 9.0), (4.0, 8.5)], "a double, b double")
    got = {(r[0], r[1]): r[2] for r in eda.corr_matrix(df, ["a", "b"]).collect()}
    assert got["a", "b"] == pytest.approx(np.corrcoef([1, 2, 4], [2, 4, 8.5])[0, 1])


def test_correlation_of_many_columns(spark):
    """200 columns with gaps, far from zero, some constant as a whole or where another is present."""
    rng = np.random.default_rng(8)
    base = rng.normal(size=(300, 200)) + rng.normal(size=(300, 1)) + 1e6
    base[rng.random(base.shape) < 0.1] = np.nan
    base[:, 5] = 7.25
    base[150:, 6] = np.nan
    base[:150, 7], base[150:, 7] = 3.1, rng.normal(size=150)  # constant where column 6 is present
    base[:, 8] = np.nan
    names = [f"c{i}" for i in range(200)]
    df = spark.createDataFrame(pd.DataFrame(base, columns=names)).repartition(3)
    got = eda.corr_matrix(df, names).toPandas().pivot(index="column_a", columns="column_b", values="correlation")
    got = got.loc[names, names].to_numpy()
    want = pd.DataFrame(base).corr().to_numpy()
    want[5, :] = want[:, 5] = np.nan
    want[6, 7] = want[7, 6] = np.nan
    assert np.array_equal(np.isnan(got), np.isnan(want))
    assert np.nanmax(np.abs(got - want)) < 1e-9


@pytest.mark.parametrize("seed", [1, 2])
def test_quantiles_equal_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    normal = rng.normal(size=2000).round(2)
    hot = np.where(rng.random(2000) < 0.4, 3.5, rng.exponential(size=2000) * 1e6)  # one value holds 40 %
    rows = [(float(a), float(b) if i % 10 else None, float("nan") if i % 7 == 0 else float(i)) for i, (a, b) in enumerate(zip(normal, hot))]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(6)
    probabilities = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = eda.exact_quantiles(df, ["a", "b", "c"], probabilities)
    columns = {
        "a": [r[0] for r in rows],
        "b": [r[1] for r in rows if r[1] is not None],
        "c": [r[2] for r in rows if r[2] == r[2]],
    }
    for name, values in columns.items():
        for p in probabilities:
            assert got[name][p] == pytest.approx(float(np.quantile(values, p)), rel=1e-12)


def test_quantiles_down_to_the_last_bit(spark):
    """Neighbouring doubles, both signs, both zeros, infinities and numbers below the normal range."""
    near = [1.0]
    for _ in range(300):
        near.append(float(np.nextafter(near[-1], 2)))
    edge = [-np.inf, -1e300, -5.0, -5e-324, -0.0, 0.0, 0.0, 5e-324, 1e-308, 7.0, np.inf] * 3
    rows = [(near[(7 * i) % 301], -near[(11 * i) % 301], float(edge[i % 33])) for i in range(301 * 33)]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(5)
    probabilities = [0.0, 1 / 3, 0.5, 0.77, 1.0]
    got = eda.exact_quantiles(df, ["a", "b", "c"], probabilities)
    for i, name in enumerate("abc"):
        ordered = sorted(r[i] for r in rows)
        for p in probabilities:
            place = (len(ordered) - 1) * p
            low, high = ordered[int(np.floor(place))], ordered[int(np.ceil(place))]
            expected = low if low == high else low + (high - low) * (place - np.floor(place))
            assert got[name][p] == expected


def test_quantiles_do_not_exchange_values(spark, monkeypatch):
    """Tasks send buckets: far fewer rows than there are values. Held buckets are added up before they pass a bound."""
    monkeypatch.setattr(quantiles, "HELD_BUCKETS", 100)
    df = spark.range(200_000).select((F.col("id") % 1000 / 7).alias("v")).repartition(4)
    rows = df.mapInArrow(quantiles._counter([None], 48), quantiles.BUCKETS)
    assert rows.count() < 4 * 250
    assert eda.exact_quantiles(df, ["v"], [0.25])["v"][0.25] == pytest.approx(np.quantile(np.arange(1000) / 7, 0.25), abs=0.2)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "a double")
    assert eda.exact_quantiles(df, ["a"], [0.5]) == {"a": {0.5: None}}
    assert eda.iqr_filter(df, "a").count() == 0
    assert eda.boxplot_stats(df, ["a"]).count() == 0


def test_describe(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (9,), (None,)], "v int")
    row = eda.describe_stats(df, ["v"]).first()
    assert tuple(row)[:3] == ("v", 4, 3.5)
    assert row["std"] == pytest.approx(np.std([1, 2, 2, 9], ddof=1))
    assert (row["min"], row["q25"], row["q50"], row["q75"], row["max"]) == (1.0, 1.75, 2.0, 3.75, 9.0)


def test_histogram_last_bin_is_closed(spark):
    df = spark.createDataFrame([(float(i),) for i in range(11)] + [(None,)], "v double").withColumn("c", F.lit(4.0))
    got = {(r["column_name"], r["bin"]): r["n"] for r in eda.histogram_bins(df, ["v", "c"]).collect()}
    assert [got["v", i] for i in range(10)] == [1] * 9 + [2]
    assert got["c", 0] == 12 and ("c", 1) not in got


def test_boxplot(frame):
    row = eda.boxplot_stats(frame, ["depth"]).first()
    assert tuple(row) == ("depth", 4.5, 6.5, 9.25, 3.0, 10.0, 1)


def test_whiskers_do_not_end_inside_the_box(spark):
    high = eda.boxplot_stats(spark.createDataFrame([(1,), (1,), (1,), (100,)], "v int"), ["v"]).first()
    assert (high["q3"], high["whisker_high"], high["outliers"]) == (25.75, 25.75, 1)
    low = eda.boxplot_stats(spark.createDataFrame([(-1,), (-1,), (-1,), (-100,)], "v int"), ["v"]).first()
    assert (low["q1"], low["whisker_low"]) == (-25.75, -25.75)


def test_profile(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert sorted(map(tuple, eda.profile_info(df).collect())) == [(0, "a", 2, "int"), (1, "b", 1, "string")]
