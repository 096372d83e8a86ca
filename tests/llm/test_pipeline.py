from __future__ import annotations

import random
import re

import pytest
from helpers import docs, words
from test_ngram_join import brute as near_groups

import corpus_pipeline
from tidemill.llm import exact_dedup
from tidemill.llm import toxicity as tx
from tidemill.storage import materialize


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    """A small corpus with toxic documents, copies, near copies and awkward rows."""
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(400):
        toxic = i % 8 == 0
        text = words(f"d{i}_", rng.randint(20, 120)) + (" horrid vile horrid" if toxic else "")
        rows.append((i, text, f"s{i % 5}"))
        labels.append((i, 1, int(toxic)))
    rows += [(1000 + i, rows[3][1] + " " * i, "s1") for i in range(20)]  # copies
    rows += [(2000 + i, words("near", 100) + f" end{i}", "s2") for i in range(20)]  # near copies
    rows += [(3000, None, None), (3001, "", "s0"), (3002, words("long", 5000), "s3"), (7, rows[7][1], "s2"), (None, "no id", "s4")]
    path = str(tmp_path_factory.mktemp("corpus"))
    docs(spark, rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages_against_plain_python(spark, sf_dir):
    frame = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, seen = frame.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before, frame = frame, materialize(stage(spark, frame, sf_dir), name)
        seen[name] = (before.collect(), frame.collect())
        assert name == corpus_pipeline.STAGES[-1][0] or frame.columns == columns

    before, after = seen["toxicity"]
    model = tx.train(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scores = tx.Scorer(model).scores([r["text"] or "" for r in before])
    assert sorted(map(str, after)) == sorted(str(r) for r, s in zip(before, scores) if s < 0.5)
    gone = {r["doc_id"] for r in before} - {r["doc_id"] for r in after}
    assert gone == {i for i in range(400) if i % 8 == 0}

    before, after = seen["exact_dedup"]
    best = {}
    for r in before:
        key = re.sub(r"[\x20\x09-\x0D]", "", r["text"] or "")
        rank = (-len(r["text"] or ""), r["doc_id"] is None, r["doc_id"] or 0)
        best[key] = min(rank, best.get(key, rank))
    want = sorted(-n for n, _, _ in best.values())
    assert sorted(len(r["text"] or "") for r in after) == want and len(after) == len(best)
    assert {(r["doc_id"]) for r in after} == {None if null else i for _, null, i in best.values()}

    before, after = seen["ngram_jaccard_join"]
    groups = near_groups([(r["doc_id"], r["text"]) for r in before])
    stays = sorted((i for i, _, c in groups if i is None or i == c), key=str)
    assert sorted((r["doc_id"] for r in after), key=str) == stays
    assert sum(i is not None and i >= 2000 and i < 3000 for i in stays) == 1

    before, after = seen["mixing"]
    size = lambda rows: sum(len((r["text"] or "").split()) for r in rows)
    assert {r["doc_id"] for r in after} <= {r["doc_id"] for r in before}
    assert abs(size(after) - 1.5 * size(before)) < 0.02 * size(before)

    before, after = seen["best_fit_packing"]
    assert sum(r["n_words"] for r in after) == size(before)
    assert len({(r["bin_id"], r["source"]) for r in after if r["bin_id"] is not None}) == sum(r["n_words"] > 0 for r in after)


def test_run_reruns_alike(spark, sf_dir):
    one, two = (sorted(map(str, corpus_pipeline.run(spark, sf_dir).select("doc_id", "start", "n_words").collect())) for _ in "ab")
    assert one == two and one


def test_empty_corpus(spark, tmp_path):
    docs(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_copies_when_splits_move_between_jobs(spark, tmp_path, monkeypatch):
    """As when executors are lost or added: later scans of the same files are split otherwise."""
    rows = [(i, words(f"d{i % 60}_", 30)) for i in range(90)]
    docs(spark, rows).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    frame, settings = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        settings[key] = spark.conf.get(key)

    def then_split(df, label):
        out = materialize(df, label)
        for key in settings:
            spark.conf.set(key, "1000")
        return out

    monkeypatch.setattr(exact_dedup, "materialize", then_split)
    try:
        kept = corpus_pipeline.drop_copies(spark, frame, str(tmp_path)).collect()
    finally:
        for key, value in settings.items():
            spark.conf.set(key, value)
    assert sorted(r["doc_id"] for r in kept) == list(range(60))
