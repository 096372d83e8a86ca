from __future__ import annotations

import hashlib
import random
import re
import tempfile
from collections import defaultdict

import pytest
from helpers import awkward, docs

from tidemill.llm import exact_dedup as ed


def brute(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((i, text or ""))
    out = []
    for norm, members in groups.items():
        order = sorted(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))
        digest = hashlib.sha256(norm.encode()).hexdigest()
        out += [(i, order[0][0], len(members), n == 0, digest) for n, (i, _) in enumerate(order)]
    return sorted(out, key=str)


def found(spark, rows, **options):
    return sorted((tuple(r) for r in ed.exact_dedup(docs(spark, rows), **options).collect()), key=str)


def test_awkward_rows(spark):
    assert found(spark, awkward()) == brute(awkward())


def test_empty_table(spark):
    result = ed.exact_dedup(docs(spark, []))
    assert result.count() == 0
    assert result.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


@pytest.mark.parametrize("budget", [ed.TRIE_BYTES, 2000])
def test_hot_group_and_spilled_subtrees(spark, budget):
    random.seed(3)
    rows = [(i, random.choice(["one text", "one  text", " one text"])) for i in range(400)]
    rows += [(1000 + i, "stem " * 20 + " ".join(random.choice("ab") for _ in range(random.randint(0, 6)))) for i in range(300)]
    assert found(spark, rows, trie_bytes=budget) == brute(rows)


def test_forgotten_texts_are_sent_again(spark, monkeypatch):
    rows = [(i, f"t{i % 7}") for i in range(200)]
    monkeypatch.setattr(ed, "REMEMBERED", 3)
    assert found(spark, rows) == brute(rows)


def test_rows_are_told_apart_by_row_column(spark):
    frame = docs(spark, [(1, "a"), (1, "a"), (2, "b")]).selectExpr("*", "monotonically_increasing_id() AS nr")
    result = ed.exact_dedup(frame, row_col="nr").filter("kept")
    assert result.count() == 2 and result.select("nr").distinct().count() == 2


@pytest.mark.parametrize("budget", [10**9, 1000, 1])
def test_tries_against_a_dictionary(budget):
    random.seed(11)
    texts = [b"".join(random.choice([b"a", b"bb", b"ab" * 30]) for _ in range(random.randint(0, 8))) for _ in range(500)]
    items = [(t, hashlib.sha256(t).digest(), (i,), 1) for i, t in enumerate(texts)]
    with tempfile.TemporaryDirectory() as folder:
        got = {e[0]: (e[1], e[2]) for e in ed.owners(iter(items), folder, budget)}
    want = {}
    for text, content, owner, _ in items:
        first, n = want.get(content, (owner, 0))
        want[content] = (min(first, owner), n + 1)
    assert got == want
