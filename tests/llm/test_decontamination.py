from __future__ import annotations

import random
import re

import pytest
from helpers import awkward, docs, words

from tidemill.llm import decontamination as dc

ITEMS = "item_id string, text string, doc_id long, id long, row long, name string"


def benchmark(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, 3, "n") for i, t in rows], ITEMS)


def split(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [(m.group(), m.span()) for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)]


def brute(rows, items, window=10):
    patterns = set()
    for name, text in items:
        own = [w for w, _ in split(text)]
        size = min(window, len(own))
        patterns |= {(name, tuple(own[i : i + size])) for i in range(len(own) - size + 1) if own}
    out = []
    for key, text in rows:
        own = split(text)
        hit, names = set(), set()
        for name, pattern in patterns:
            for i in range(len(own) - len(pattern) + 1):
                if tuple(w for w, _ in own[i : i + len(pattern)]) == pattern:
                    hit.update(range(i, i + len(pattern)))
                    names.add(name)
        spans = []
        for i in sorted(hit):
            if spans and spans[-1][1] == i - 1:
                spans[-1] = (spans[-1][0], i, spans[-1][2], own[i][1][1])
            else:
                spans.append((i, i, *own[i][1]))
        out.append((key, len(own), len(hit), spans, sorted(n for n in names if n is not None)))
    return sorted(out, key=str)


def found(spark, rows, items, **options):
    result = dc.contamination(docs(spark, rows), benchmark(spark, items), **options).collect()
    return sorted(((r[0], r[1], r[2], [tuple(s) for s in r.spans], r["items"]) for r in result), key=str)


ITEM_ROWS = [
    ("a", words("w", 12)), ("b", "Short Item!"), ("c", None), ("d", ""), ("e", "?!"), (None, "no id"), ("a", words("v", 10)),
    ("b", "Short Item!"), ("f", "über-Straße"), ("g", words("w", 11)), ("10", "x y"), ("9", "y z"),
]


def test_awkward_rows(spark):
    rows = [(k, t) for k, t in awkward() if len(t or "") < 200_000 or k == 6] + [
        (20, "SHORT--item short, item"), (21, "say no id"), (22, "Über Straße. über straße"), (23, "x y z"),
        (24, "pre " + words("v", 10).upper() + " post"), (25, words("v", 9)), (26, "é short item short item"),
    ]
    assert found(spark, rows, ITEM_ROWS) == brute(rows, ITEM_ROWS)


@pytest.mark.parametrize("budget", [1 << 20, 300])
def test_passages(spark, monkeypatch, budget):
    """Parts of items at any place, in one automaton or in several."""
    monkeypatch.setattr(dc, "AUTOMATON_BYTES", budget)
    rng = random.Random(3)
    letters = [f"k{i}" for i in range(12)]
    items = [(str(i), " ".join(rng.choice(letters) for _ in range(rng.randint(0, 25)))) for i in range(30)]
    rows = [(1, None), (None, "k1"), (2, "k1 k2"), (2, "k1 k2")]
    for i in range(150):
        text = " ".join(rng.choice(letters) for _ in range(rng.randint(0, 20)))
        source = rng.choice(items)[1].split()
        at = rng.randint(0, 10)
        rows.append((i, f"{text}; {' '.join(source[at : at + rng.randint(2, 14)]).upper()}\n{text}"))
    assert found(spark, rows, items, window=6) == brute(rows, items, 6)


def test_empty_tables(spark):
    assert dc.contamination(docs(spark, []), benchmark(spark, ITEM_ROWS)).count() == 0
    assert found(spark, [(1, "a b"), (2, None)], []) == [(1, 2, 0, [], []), (2, 0, 0, [], [])]
