from __future__ import annotations

import random
import re
from itertools import combinations

import numpy as np
import pytest
import zstandard
from helpers import awkward, docs, words

from tidemill.llm import ngram_join as nj
from tidemill.llm.components import connected_components


def shingles(text, n=4):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    tokens = [w for w in re.split(r"[\x20\x09-\x0D]+", lower) if w]
    if not tokens:
        return set()
    n = min(n, len(tokens))
    return {tuple(tokens[i : i + n]) for i in range(len(tokens) - n + 1)}


def brute(rows, num=85, den=100):
    sets = [shingles(t) for _, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if rows[a][0] is None or rows[b][0] is None or not sets[a] or not sets[b]:
                continue
            both = len(sets[a] & sets[b])
            if den * both >= num * len(sets[a] | sets[b]):
                x, y = sorted((find(rows[a][0]), find(rows[b][0])))
                parent[y] = x
    return sorted(((i, len(s), None if i is None else find(i)) for (i, _), s in zip(rows, sets)), key=str)


def found(spark, rows, **options):
    return sorted((tuple(r) for r in nj.jaccard_components(docs(spark, rows), **options).collect()), key=str)


def edited(rng, tokens, n):
    out = list(tokens)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"e{rng.randrange(10**6)}"
    return " ".join(out)


def test_awkward_rows(spark):
    rows = awkward() + [(20, "One TWO three"), (21, "one two\tthree"), (22, "one two"), (23, "É x"), (24, "é x")]
    assert found(spark, rows) == brute(rows)


def test_empty_table(spark):
    result = nj.jaccard_components(docs(spark, []))
    assert result.count() == 0 and result.columns == ["doc_id", "n_shingles", "component_id"]


@pytest.mark.parametrize("slices, often", [(8_000_000, 5000), (400, 3)])
def test_groups_of_near_copies(spark, monkeypatch, slices, often):
    """Chains, stars with many edits, sets just at the threshold, and a passage that many share."""
    monkeypatch.setattr(nj, "SLICE_BYTES", slices)
    monkeypatch.setattr(nj, "OFTEN", often)
    monkeypatch.setattr(nj, "PIVOT_ROWS", 7)
    rng = random.Random(5)
    rows, at = [], iter(rng.sample(range(10_000), 2000))
    base = words("b", 150).split()
    rows += [(next(at), edited(rng, base, rng.randrange(9))) for _ in range(60)]
    chain = words("c", 120).split()
    for _ in range(20):
        chain = edited(rng, chain, 1).split()
        rows.append((next(at), " ".join(chain)))
    passage = words("p", 50)
    rows += [(next(at), f"{words(f'x{i}_', rng.randrange(5, 300))} {passage}") for i in range(60)]
    for n in range(4, 60, 5):
        text = words(f"s{n}_", n)
        rows += [(next(at), text), (next(at), text + " z"), (next(at), "y " + text + " z"), (next(at), text.upper())]
    rng.shuffle(rows)
    assert found(spark, rows) == brute(rows)


def test_groups_too_large_to_compare_all_pairs(spark, monkeypatch):
    """Many copies of one text with other edits: few rows are paired, and no link is lost."""
    made = []
    join = nj.verify
    monkeypatch.setattr(nj, "verify", lambda pairs, *rest: made.append(pairs.count()) or join(pairs, *rest))
    rng = random.Random(11)
    base = words("b", 150).split()
    rows = [(i, edited(rng, base, rng.choice([1, 2, 3, 8, 9, 10, 11, 12]))) for i in range(300)]
    rows += [(300 + i, edited(rng, words("c", 90 + i % 9).split(), 1 + i % 4)) for i in range(60)]
    assert found(spark, rows) == brute(rows)
    links = sum(
        100 * len(a & b) >= 85 * len(a | b) for a, b in combinations([shingles(t) for _, t in rows], 2)
    )
    assert sum(made) < links + 12 * len(rows)


def test_prefixes_pair_each_likely_pair_once(spark):
    """Not similar, but alike in their rarest shingles: the parities tell them apart in the join."""
    rng = random.Random(3)
    base = words("b", 120).split()
    texts = [" ".join(base)] * 2 + [edited(rng, base, 12) for _ in range(40)]
    pack = zstandard.ZstdCompressor().compress
    schema = "version long, id long, component long, major boolean, size int, text binary"
    members = [
        (i, i, i, i == 0, len(shingles(t)), bytearray(pack(t.encode()))) for i, t in enumerate(texts)
    ]
    pairs = nj.rare_pairs(spark.createDataFrame(members, schema), 4, 85, 100).collect()
    assert [(r.a, r.b) for r in pairs] == [(1, 0)]


def test_repeated_ids_are_one_document(spark):
    rows = [(3, words("a", 40)), (3, words("b", 40)), (2, words("a", 40)), (1, words("b", 40))]
    assert {r[2] for r in found(spark, rows)} == {1}


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(9)
    for _ in range(2000):
        n = int(rng.integers(1, 400))
        pool = rng.integers(0, 2**63, 2 * n + 2, dtype=np.uint64)
        a = np.unique(pool[:n])
        drop, add = (int(rng.integers(0, max(1, n // 6) + 1)) for _ in range(2))
        b = np.unique(np.concatenate([a[drop:], pool[n : n + add]]))
        if not len(b):
            continue
        both = len(np.intersect1d(a, b))
        if 100 * both >= 85 * (len(a) + len(b) - both):
            assert np.intersect1d(nj.signatures(a), nj.signatures(b)).size


def batches(*columns, size):
    import pyarrow as pa

    for begin in range(0, len(columns[0]), size):
        part = [np.asarray(c[begin : begin + size]) for c in columns]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in part], [f"c{i}" for i in range(len(part))])


@pytest.mark.parametrize("size", [1, 2, 3, 7, 1000])
def test_signatures_that_go_on_in_the_next_batch(size):
    rng = random.Random(size)
    rows = sorted((rng.randrange(12), a, rng.choice([1, 1, 1, 2])) for a in rng.sample(range(1000), 40))
    key, a, n = (np.array(c, np.int64) for c in zip(*rows))
    got = set()
    for out in nj.gather(batches(np.full(40, nj.SIGNATURE, np.int32), key, a, a, n, size=size)):
        got |= {(r["kind"], r["a"], r["b"]) for r in out.to_pylist()}
    want = set()
    for k in set(key):
        own, many = a[key == k], n[key == k].sum() > 2
        want |= {(nj.OPEN if many else nj.CLOSED, int(x), int(own.min())) for x in own if x != own.min()}
    assert got == want


@pytest.mark.parametrize("often", [2, 4, 100])
@pytest.mark.parametrize("size", [1, 3, 1000])
def test_frequencies_across_batches(monkeypatch, size, often):
    monkeypatch.setattr(nj, "OFTEN", often)
    rng = random.Random(often)
    e = np.array(sorted(rng.choice([1, 2, 2, 2, 2, 2, 3, 4, 5, 6, 7]) for _ in range(60)), np.int64)
    got = [tuple(r.values()) for out in nj.shared_elements(batches(e, np.arange(60), size=size)) for r in out.to_pylist()]
    counts = {x: int((e == x).sum()) for x in e}
    assert sorted(got) == [(int(x), i, min(often, counts[x])) for i, x in enumerate(e) if counts[x] > 1]


def test_components_of_chains_and_stars(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(0, 200)] + [(1000, i) for i in range(1001, 1100)] + [(5000, 5000)]
    rng.shuffle(links)
    frame = spark.createDataFrame([p if rng.random() < 0.5 else p[::-1] for p in links], "a long, b long")
    got = {r["node"]: r["component"] for r in connected_components(frame).collect()}
    assert {got[i] for i in range(201)} == {0} and {got[i] for i in range(1000, 1100)} == {1000}
