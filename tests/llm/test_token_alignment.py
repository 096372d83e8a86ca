from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import awkward, docs

tokenizers = pytest.importorskip("tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
import public_tokenizers  # noqa: E402

from tidemill.llm import token_alignment as ta  # noqa: E402
from tidemill.llm.token_counts import byte_letters  # noqa: E402

PATHS = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]


@pytest.fixture(scope="module")
def library():
    a = tokenizers.Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def brute(library, rows):
    """Whole texts by the libraries, groups byte by byte, links pair by pair, counts over documents."""
    a, b = library
    byte = {letter: value for value, letter in byte_letters().items()}
    groups_of = []
    for _, text in rows:
        groups = []
        if text:
            whole = (" " + text).encode()
            of_a = [(i, bytes(byte[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
            of_b = []
            for i in b.encode(text):
                hexed = re.fullmatch("<0x([0-9A-F]{2})>", b.id_to_piece(i))
                of_b.append((i, bytes([int(hexed[1], 16)]) if hexed else b.id_to_piece(i).replace("▁", " ").encode()))
            if b"".join(t for _, t in of_a) == whole == b"".join(t for _, t in of_b):
                ends = [set(np.cumsum([len(t) for _, t in side]).tolist()) for side in (of_a, of_b)]
                common = sorted(ends[0] & ends[1])
                groups = [([], []) for _ in common]
                for side, tokens in enumerate((of_a, of_b)):
                    at = g = 0
                    for i, t in tokens:
                        at += len(t)
                        groups[g][side].append(i)
                        g += at == common[g]
        groups_of.append(groups)
    linked = [Counter((x, y) for g in groups for x in g[0] for y in g[1]) for groups in groups_of]
    count = Counter(pair for own in linked for pair in own)
    top = defaultdict(int)
    for (x, _), n in count.items():
        top[x] = max(top[x], n)
    out = []
    for (key, _), groups, own in zip(rows, groups_of, linked):
        text = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in groups)
        sha = hashlib.sha256(text.encode()).hexdigest() if groups else ""
        n_best = sum(n for pair, n in own.items() if count[pair] == top[pair[0]])
        n_a, n_b = (sum(len(g[i]) for g in groups) for i in (0, 1))
        total = sum(n * count[pair] for pair, n in own.items())
        out.append((key, n_a, n_b, len(groups), sum(own.values()), n_best, total, sha))
    return sorted(out, key=str), count, sum(linked, Counter())


def found(spark, rows):
    return sorted((tuple(r) for r in ta.aligned_tokens(docs(spark, rows), *PATHS).collect()), key=str)


TEXTS = [
    " ", "  ", "\n", "\n\n", " a", "a ", "a\nb", "a\n\nb c", "a \nb", "a\tb", "a\xa0b", "▁", "a▁b c", "<s> x </s>", "<0x41>",
    "<|endoftext|> a<|endoftext|>b", "日本語のテキスト", "日本 語の", "naïve café", "é", "🙂🙂 🙂", "don't we'll", "\x00a b",
    "1234567 89", "ﬁ ﬂ ½ ²", "​ x", "a\x1cb c", "a\r\nb", "हिन्दी पाठ", "x\u0085y", "  lead", "trail\n", "ab " * 300,
]


def test_awkward_rows(spark, library):
    rows = [(k, t) for k, t in awkward() if len(t or "") < 100] + list(enumerate(TEXTS)) + [(50, "x" * 3000)]
    assert found(spark, rows) == brute(library, rows)[0]


def test_long_texts(spark, library):
    rows = [(1, " ".join(f"w{i % 700}" for i in range(30_000))), (2, "zq" * 20_000), (3, "é" * 5000 + " a")]
    assert found(spark, rows) == brute(library, rows)[0]


@pytest.mark.parametrize("small", [False, True])
def test_random_texts(spark, library, monkeypatch, small):
    """Blocks, slices and the table of known chunks of usual and of tiny size; big groups by distinct ids."""
    if small:
        for name, value in [("BLOCK_DOCS", 30), ("BLOCK_LINKS", 300), ("SLICE_BYTES", 90), ("KNOWN_BYTES", 900), ("BIG_GROUP", 2)]:
            monkeypatch.setattr(ta, name, value)
    rng = random.Random(small)
    letters = list("aeinst  \n'.,1é😀▁") + ["the ", "ing ", " of", "  "]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    rows = list(enumerate(texts + texts[:40]))
    expected, count, links = brute(library, rows)
    assert found(spark, rows) == expected
    _, postings = ta.alignment_index(docs(spark, rows), *PATHS)
    pairs = {(r.a, r.b): (r.n_docs, r.n_links) for r in ta.pair_counts(postings).collect()}
    assert pairs == {pair: (n, links[pair]) for pair, n in count.items()}


def test_chunks_are_encoded_together_and_frequent_ones_stay_known(monkeypatch):
    got = []
    aligner, plain = ta.Aligner(*PATHS), ta.Aligner(*PATHS)
    encode = aligner._encode
    monkeypatch.setattr(aligner, "_encode", lambda texts: got.extend(texts) or encode(texts))
    monkeypatch.setattr(plain, "_learn_runs", lambda chunks: chunks)
    texts = [" ".join(f"w{i * k % 997}é,x" for i in range(500)) + "\nlast  two" for k in (1, 3, 0, 3)]

    def known(of, row):
        pairs = [of.pairs[of.first[i] : of.first[i + 1]].tolist() for i in row]
        return [of.texts[i] for i in row], of.counts[row].tolist(), pairs

    for text in texts:
        assert known(aligner, aligner.numbers([text])[0]) == known(plain, plain.numbers([text])[0])
    assert len(plain.known) > 600 and len(got) < 100
    often = {c for c in aligner.known if sum(c in aligner.chunks(t) for t in texts) > 1}
    del got[:]
    aligner.forget_rare()
    assert often <= set(aligner.known) and len(aligner.known) < len(plain.known)
    for text in texts:
        assert known(aligner, aligner.numbers([text])[0]) == known(plain, plain.numbers([text])[0])
    assert not any(c in often for c in got)
    monkeypatch.setattr(ta, "KNOWN_BYTES", 2000)
    aligner.forget_rare()
    assert 0 < aligner.known_bytes <= 1000 and len(aligner.known) == len(aligner.texts)
    assert known(aligner, aligner.numbers(texts[1:2])[0]) == known(plain, plain.numbers(texts[1:2])[0])


@pytest.mark.parametrize("n_docs", [1, 2, 17, 300, 16384])
def test_bitmaps_round_trip(n_docs):
    rng = np.random.default_rng(n_docs)
    sets = [np.sort(rng.choice(n_docs, rng.integers(1, min(n_docs, 900) + 1), replace=False)) for _ in range(60)]
    which = np.repeat(np.arange(60), [len(s) for s in sets])
    bitmaps = ta.encode_bitmaps(which, np.concatenate(sets), 60, n_docs)
    back = sorted((int(r), int(d)) for rows, held in ta.decode_bitmaps(bitmaps[3:], n_docs) for r, d in zip(rows, held))
    assert back == [(i - 3, int(d)) for i in range(3, 60) for d in sets[i]]


def test_empty_table(spark):
    result = ta.aligned_tokens(docs(spark, []), *PATHS)
    assert result.count() == 0 and result.columns[0] == "doc_id" and len(result.columns) == 8
