from __future__ import annotations

import hashlib
import random
import re

import pytest
from helpers import awkward, docs, words

from tidemill.llm import substring_dedup as sd


def brute(rows, window=50):
    tokens = [[w for w in re.split(r"[\x20\x09-\x0D]+", t or "") if w] for _, t in rows]
    first = {}
    for (i, _), own in zip(rows, tokens):
        if i is not None:
            for k in range(len(own) - window + 1):
                key = tuple(own[k : k + window])
                first[key] = min(i, first.get(key, i))
    out = []
    for (i, _), own in zip(rows, tokens):
        gone = set()
        if i is not None:
            for k in range(len(own) - window + 1):
                if first[tuple(own[k : k + window])] < i:
                    gone.update(range(k, k + window))
        kept = " ".join(w for k, w in enumerate(own) if k not in gone)
        out.append((i, len(own), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows, **options):
    return sorted((tuple(r) for r in sd.substring_dedup(docs(spark, rows), **options).collect()), key=str)


def test_awkward_rows(spark):
    rows = awkward() + [(30, "spam " * 500), (31, "spam " * 49), (32, "spam " * 50 + "end")]
    assert found(spark, rows) == brute(rows)


def test_empty_table(spark):
    result = sd.substring_dedup(docs(spark, []))
    assert result.count() == 0
    assert result.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]


@pytest.mark.parametrize("slices", [8_000_000, 2000])
@pytest.mark.parametrize("window", [50, 7, 6])
def test_passages_at_any_place(spark, monkeypatch, slices, window):
    """Passages of about a window's length, overlapping, shared by few and by many, inside a slice and across."""
    monkeypatch.setattr(sd, "SLICE_BYTES", slices)
    rng = random.Random(window)
    pool = words("q", 400).split()
    rows = []
    for i in rng.sample(range(10_000), 150):
        parts = []
        for _ in range(rng.randrange(4)):
            parts.append(words(f"u{rng.randrange(10**6)}_", rng.randrange(0, 30)))
            begin, size = rng.randrange(300), rng.choice([window - 1, window, window + 1, 2 * window, 90])
            parts.append(" ".join(pool[begin : begin + size]))
        rows.append((i, "\n".join(parts)))
    rows += [(20_000 + i, "hot " + " ".join(pool[:60])) for i in range(60)]
    assert found(spark, rows, window=window) == brute(rows, window)


def test_rows_that_share_an_id_do_not_cut_each_other(spark):
    rows = [(5, words("a", 60)), (5, words("a", 60) + " more"), (6, words("a", 60)), (None, words("a", 60))]
    assert found(spark, rows) == brute(rows)
