from __future__ import annotations

import hashlib
import random

import pytest
from helpers import awkward, docs

from tidemill.llm import fingerprints as fp


def prefixes(text: str) -> fp.Prefixes:
    return fp.Prefixes(fp.code_points(text.encode()))


def test_spans_and_extensions():
    random.seed(1)
    for _ in range(300):
        x = "".join(random.choice("ab😀") for _ in range(random.randint(0, 60)))
        y = x[: random.randint(0, 60)] + "".join(random.choice("ab😀") for _ in range(random.randint(0, 30)))
        a, b = prefixes(x), prefixes(y)
        i, j = random.randint(0, len(x)), random.randint(0, len(y))
        right = next((k for k in range(100) if i + k >= len(x) or j + k >= len(y) or x[i + k] != y[j + k]))
        left = next((k for k in range(100) if k >= i or k >= j or x[i - k - 1] != y[j - k - 1]))
        assert a.forward(i, b, j) == right and a.backward(i, b, j) == left
        n = random.randint(0, min(len(x) - i, len(y) - j))
        assert a.same(i, b, j, n) == (x[i : i + n] == y[j : j + n])


def test_joined_arrays_are_those_of_the_joined_text():
    random.seed(2)
    for _ in range(100):
        x, y = ("".join(random.choice("abcé") for _ in range(random.randint(0, 40))) for _ in range(2))
        keep, take = random.randint(0, len(x)), random.randint(0, len(y))
        joined, whole = fp.Prefixes.joined(prefixes(x), prefixes(y), keep, take), prefixes(x[:keep] + y[:take])
        assert joined.fingerprint() == whole.fingerprint()
        assert all((s == t).all() for s, t in zip(joined.sums, whole.sums))


def test_likeness():
    random.seed(3)
    text = "".join(random.choice("abcdefgh ") for _ in range(3000))
    other = "".join(random.choice("abcdefgh ") for _ in range(3000))
    like = lambda x, y: fp.likeness(prefixes(x), prefixes(y))
    assert like(text, text) == 1 and like("", "") == 1 and like(text, "") == 0 and like("", text) == 0
    assert like(text, other) < 0.02
    assert 0.95 < like(text, text[:1000] + "XX" + text[1003:]) < 1  # one edit
    assert like(text, text[:500] + "Y" + text[500:2000] + "Z" + text[2000:]) > 0.95  # insertions
    assert like(text, text[1500:] + text[:1500]) > 0.95  # moved
    assert 0.45 < like(text, text[:1500] + other[:1500]) < 0.55


def brute(rows):
    keyed = sorted((r for r in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    out = []
    for n, (i, text) in enumerate(keyed):
        text, after = text or "", keyed[(n + 1) % len(keyed)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("ranges", [None, 1, 3, 200])
def test_next_documents_across_ranges(spark, ranges):
    random.seed(4)
    rows = [(i * 3, "".join(random.choice("xyz é") for _ in range(random.randint(0, 30)))) for i in range(150)]
    rows.append((None, "first of all"))
    found = fp.fingerprint_table(docs(spark, rows).repartition(4), ranges=ranges).toPandas()
    got = [(None if i != i else int(i), int(n), d) for i, n, d in zip(found["doc_id"], found["n_chars"], found["edited_sha256"])]
    assert sorted(got, key=str) == brute(rows)


def test_awkward_rows(spark):
    found = fp.fingerprint_table(docs(spark, awkward())).toPandas()
    assert len(found) == len(awkward())
    assert found["near_edited"].between(0, 1).all() and found["near_next"].between(0, 1).all()
    texts = sorted((t or "") for _, t in awkward())
    assert found["fingerprint"].nunique() == len(set(texts))
    long_ones = found[found["doc_id"].isin([6, 10])]
    assert long_ones["fingerprint"].nunique() == 1


def test_one_row_and_none(spark):
    row = fp.fingerprint_table(docs(spark, [(7, "abcdef")])).first()
    assert row["edited_sha256"] == hashlib.sha256(b"abcabc").hexdigest() and row["near_next"] == 1
    empty = fp.fingerprint_table(docs(spark, []))
    assert empty.count() == 0 and empty.columns[0] == "doc_id"
