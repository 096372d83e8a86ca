from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from helpers import awkward, docs

from tidemill.llm import periodic_runs as pr


def brute_runs(words, min_length=6, min_exponent=4):
    """Every lag, every stretch of equal words on it, and the smallest period by trial."""
    found, n = [], len(words)
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(min_length, min_exponent * q):
                piece = words[i : i + length]
                if not any(piece[d:] == piece[:-d] for d in range(1, q)):
                    found.append((i, length, q))
            i = max(i + 1, j)
    return sorted(found, key=lambda r: (r[0], r[2]))


def split(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def rewritten(key, words):
    h = zlib.crc32(str(key).encode())
    g, n = h // 10, len(words)
    if key is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def expected(rows):
    out = []
    for key, text in rows:
        words = rewritten(key, split(text))
        runs = brute_runs(words)
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        best = (None,) * 4
        for s, n, q in runs:
            if best[0] is None or n * best[2] > best[1] * q:
                best = (s, n, q, 1000 * n // q)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)]
        out.append((key, len(runs), *best, *digests))
    return sorted(out, key=str)


def queried(spark, rows):
    found = pr.digest_runs(pr.periodic_runs(pr.rewrite_words(docs(spark, rows), pr.repeated_tail)))
    return sorted((tuple(r) for r in found.collect()), key=str)


def test_awkward_rows(spark):
    rows = [(k, t) for k, t in awkward() if len(t or "") < 100] + [(8, "x" * 100_000)]
    rows += [(30, "a b " * 4), (31, "a b " * 3 + "a"), (32, "a " * 5), (33, "a " * 6), (34, "x " + "a b " * 4 + "a y")]
    assert queried(spark, rows) == expected(rows)


def test_long_texts(spark):
    text = " ".join(f"w{i % 9000}" for i in range(40_000)) + " end" * 5000
    (row,) = pr.periodic_runs(docs(spark, [(1, text)])).collect()
    assert row.n_words == 45_000
    assert [tuple(r) for r in row.runs] == [(0, 40_000, 9000), (40_000, 5000, 1)]
    assert row.collapsed == " ".join(f"w{i}" for i in range(9000)) + " end"


@pytest.mark.parametrize("slice_words", [250_000, 50])
def test_rewritten_documents(spark, monkeypatch, slice_words):
    monkeypatch.setattr(pr, "SLICE_WORDS", slice_words)
    rng = random.Random(slice_words)
    rows = [(i, " ".join(rng.choice("abcdefgh") * rng.randint(1, 2) for _ in range(rng.randint(0, 150)))) for i in range(400)]
    assert queried(spark, rows) == expected(rows)


@pytest.mark.parametrize("letters", [1, 2, 3])
def test_few_letters(letters):
    """Short periods, runs inside runs, runs that overlap each other."""
    import numpy as np

    rng = random.Random(letters)
    documents = [[rng.randrange(letters) for _ in range(rng.randint(0, 60))] for _ in range(1500)]
    for _ in range(500):
        period = [rng.randrange(letters + 1) for _ in range(rng.randint(1, 14))]
        text = (period * 9)[: rng.randint(1, 9 * len(period))]
        text[rng.randrange(len(text))] = rng.randrange(letters + 1)
        documents.append([rng.randrange(letters) for _ in range(rng.randint(0, 5))] + text + text[: rng.randint(0, 9)])
    sizes = np.array([len(d) for d in documents])
    found = pr.find_runs(np.array([w for d in documents for w in d], np.int64), sizes, 6, 4)
    assert found == [(i, *run) for i, d in enumerate(documents) for run in brute_runs(d)]
    other = pr.find_runs(np.array([w for d in documents for w in d], np.int64), sizes, 20, 3)
    assert other == [(i, *run) for i, d in enumerate(documents) for run in brute_runs(d, 20, 3)]


def test_empty_table(spark):
    found = pr.digest_runs(pr.periodic_runs(docs(spark, [])))
    assert found.count() == 0
    assert found.columns == [
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256",
    ]


def test_too_few_periods_are_refused(spark):
    with pytest.raises(ValueError):
        pr.periodic_runs(docs(spark, []), min_exponent=2)
