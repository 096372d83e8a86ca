from __future__ import annotations

import random
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest
from helpers import awkward, docs, words

from tidemill.llm import mixing as mx


def exact_targets(sizes, weights=(5, 2, 1), share=Fraction(3, 2), cap=2):
    weight = [Fraction(weights[i % len(weights)]) for i in range(len(sizes))]
    free, out, rest = set(range(len(sizes))), [Fraction(0)] * len(sizes), share * sum(sizes)
    while free:
        total = sum(weight[i] for i in free)
        above = {i for i in free if rest * weight[i] / total > cap * sizes[i]}
        if not above:
            for i in free:
                out[i] = rest * weight[i] / total
            break
        for i in above:
            out[i] = Fraction(cap * sizes[i])
            rest -= out[i]
        free -= above
    return [float(x) for x in out]


def test_targets():
    random.seed(1)
    for _ in range(200):
        sizes = [random.choice([0, 1, 10, 500, 9000]) for _ in range(random.randint(1, 9))]
        assert np.allclose(mx.targets(sizes), exact_targets(sizes))
        assert abs(mx.targets(sizes).sum() - 1.5 * sum(sizes)) < 1e-6 * max(1, sum(sizes))


def test_quotas_are_split_exactly():
    rng = np.random.default_rng(5)
    for shards in (1, 2, 7, 16):
        quotas = rng.integers(0, 500, 6) * (rng.random(6) < 0.8)
        split = np.zeros((shards, 6), np.int64)
        for shard, (sources, counts) in enumerate(mx.split_quotas(quotas, shards, rng)):
            split[shard, sources] = counts
        assert (split >= 0).all() and (split.sum(axis=0) == quotas).all()
        assert np.ptp(split.sum(axis=1)) <= shards


def test_fill():
    """Near the best sum there is: for few items often the best, for more always within a word or two."""
    random.seed(2)
    exact = 0
    for _ in range(300):
        sizes = np.array([random.randint(0, 30) for _ in range(random.randint(1, 12))])
        room = random.random() * sizes.sum()
        off = abs(sizes[mx.fill(sizes, room)].sum() - room)
        sums = {0}
        for size in sizes:
            sums |= {s + size for s in sums}
        best = min(abs(s - room) for s in sums)
        assert off <= best + sizes.max() / 2
        exact += off <= best + 1
    assert exact > 240
    for n in (200, 5000):
        sizes = np.array([random.randint(1, 400) for _ in range(n)])
        assert abs(sizes[mx.fill(sizes, 0.37 * sizes.sum())].sum() - 0.37 * sizes.sum()) <= 2
    assert mx.fill(np.zeros(0, np.int64), 5.0).tolist() == [] and mx.fill(np.array([0, 7]), 2.0).tolist() == [True, False]


def check(spark, rows):
    report, mixed = (f.toPandas() for f in mx.mix(docs(spark, rows)))
    assert len(report) == len(rows)
    assert (report["taken"] == report["size"] * report["times"]).all() and (report["times"] <= 2).all()
    sources = sorted({r[2] for r in rows if r[2] is not None}) + [None] * any(r[2] is None for r in rows)
    sizes = [sum(len((t or "").encode().split()) for _, t, s in rows if s == name) for name in sources]
    for name, size, target in zip(sources, sizes, exact_targets(sizes)):
        own = report[report["source"].isna() if name is None else report["source"] == name]
        assert (own["source_size"] == size).all() and np.allclose(own["target"], target)
        assert abs(own["taken"].sum() - target) <= 0.05 * target + 3
    return report, mixed


def test_sources_come_near_their_targets(spark):
    random.seed(4)
    names = ["a", "b", "Z", "é", "", None, "hot"]
    rows = [
        (i, words("w", random.randint(1, 60)), random.choice(names) if i % 3 else "hot") for i in range(1500)
    ]
    report, mixed = check(spark, rows)
    again, _ = mx.mix(docs(spark, rows[::-1]).repartition(5))
    key = ["doc_id", "taken"]
    assert again.toPandas()[key].sort_values(key).values.tolist() == report[key].sort_values(key).values.tolist()
    assert not mixed.duplicated(["doc_id", "source", "repeat"]).any()
    assert len(mixed) == report["times"].sum()


def test_sources_that_share_ids(spark):
    """The same 300 ids in four sources: each source has its own target and draws."""
    random.seed(6)
    rows = [(i, words("w", random.randint(1, 120)), name) for name in "abcd" for i in range(300)]
    report, mixed = check(spark, rows)
    assert len(report) == 1200 and len(mixed) == report["times"].sum()
    frame = docs(spark, rows)
    taken = mx.mixed_documents(frame).groupBy("doc_id", "source").count().toPandas()
    expected = report[report["times"] > 0]
    key = lambda f, n: sorted(zip(f["doc_id"], f["source"], f[n]))
    assert key(taken, "count") == key(expected, "times")


def test_many_sources(spark):
    frame = spark.range(120_000).selectExpr(
        "id AS doc_id", "concat('s', id % 10000) AS source", "repeat('w ', CAST(1 + pmod(xxhash64(id), 9) AS INT)) AS text"
    )
    report = mx.mix(frame)[0].toPandas()
    assert len(report) == 120_000 and report["times"].max() <= 2
    own = report.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"))
    assert len(own) == 10_000 and ((own["taken"] - own["target"]).abs() <= 0.05 * own["target"] + 3).all()


def test_shards_follow_the_size(spark, monkeypatch):
    monkeypatch.setattr(mx, "SHARD_WORDS", 9)
    frame = spark.range(6000).selectExpr("id AS doc_id", "concat('s', id % 3) AS source", "'w w w' AS text")
    _, mixed = mx.mix(frame)
    assert mixed.select("shard").distinct().count() > 50
    blocks = pd.DataFrame({"source": ["a"] * 4096, "block": range(4096), "words": [10_000_000] * 4096, "docs": [5000] * 4096})
    blocks.attrs["bits"] = 12
    _, draws = mx.plan(blocks, (1.0,), 1.5, 2.0, 1)
    assert draws["shard"].nunique() > 2000


def test_rest_is_taken_from_other_blocks_too():
    words, docs = np.array([30_000.0, 10_000.0]), np.array([101, 99])
    whole, cut, left = mx.part(np.array([0, 1]), words, docs, 12_000.0)
    assert whole.tolist() == [1] and cut.tolist() == [0] and left == 2000
    sizes = np.array([20_000] + [100] * 100)
    assert sizes[mx.fill(sizes, left)].sum() == 2000


def test_skewed_source_comes_near_its_target():
    """200 documents in two blocks, one with a document of 20000 words; every order of the blocks."""
    blocks = pd.DataFrame({"source": ["a", "a"], "block": [0, 1], "words": [30_000, 10_000], "docs": [101, 99]})
    blocks.attrs["bits"] = 1
    for seed in range(8):
        _, draws = mx.plan(blocks, (1.0,), 0.3, 2.0, seed)
        whole, cut = draws[draws["rest"].isna()], draws[draws["rest"].notna()]
        assert whole["block"].tolist() == [1] and cut["block"].tolist() == [0] and set(cut["rest"]) == {2000.0}


def test_awkward_rows(spark):
    rows = [(i, t, None if n % 3 else "x") for n, (i, t) in enumerate(awkward())]
    report, _ = mx.mix(docs(spark, rows))
    assert report.count() == len(rows)
    frame = docs(spark, rows)
    assert mx.mixed_documents(frame).columns == frame.columns
    nothing = [(1, None, "a"), (2, "", None)]
    assert mx.mix(docs(spark, nothing))[0].agg({"taken": "sum"}).first()[0] == 0


def test_empty_table(spark):
    report, mixed = mx.mix(docs(spark, []))
    assert report.count() == mixed.count() == mx.mixed_documents(docs(spark, [])).count() == 0
