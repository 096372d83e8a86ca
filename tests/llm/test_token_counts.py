from __future__ import annotations

import random

import pytest
from helpers import awkward, docs

tokenizers = pytest.importorskip("tokenizers")

from tidemill.llm import token_counts as tc  # noqa: E402


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(tc.default_tokenizer())


@pytest.fixture(scope="module")
def counter():
    return tc.token_counter(tc.load_vocabulary(tc.default_tokenizer()))


def expected(library, texts):
    return [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_random_texts(library, counter):
    random.seed(7)
    letters = " \t\n\x1c\x85 　'srtvemldaaaabé1٣²🙂!?.,<|>"
    texts = ["".join(random.choice(letters) for _ in range(random.randint(0, 60))) for _ in range(1500)]
    assert counter(texts) == expected(library, texts)


def test_every_character(library, counter):
    letters = [chr(i) for i in range(0x20000) if not 0xD800 <= i < 0xE000]
    texts = ["".join(letters[i : i + 50]) for i in range(0, len(letters), 50)]
    assert counter(texts) == expected(library, texts)


@pytest.mark.parametrize(
    "text",
    ["", " ", "  ", "\n", " \n a", "a\n\nb", "a \nb", "a\tb ", "aaa aaaa aaaaa", "a" * 3000, "don't I'll we've",
     "<|endoftext|>", "x<|endoftext|> y<|endoftext|><|endoftext|>", "<|endoftext", "foo\t", "foo\t bar", "foo bar "],
)
def test_spaces_runs_and_special_strings(library, counter, text):
    assert counter([text]) == expected(library, [text])


def test_full_tables_start_anew(library, monkeypatch):
    monkeypatch.setattr(tc, "KNOWN_TOKENS", 5)
    monkeypatch.setattr(tc, "KNOWN_PIECES", 7)
    monkeypatch.setattr(tc, "ROUND_SYMBOLS", 11)
    count = tc.token_counter(tc.load_vocabulary(tc.default_tokenizer()))
    texts = [f"some words {i}, and more words{i * 37}\nof line {i}  twice" for i in range(40)]
    assert [count([t])[0] for t in texts] == expected(library, texts)


def test_rows(spark, library):
    rows = awkward()
    found = tc.token_counts(docs(spark, rows), tc.default_tokenizer()).collect()
    texts = [t or "" for _, t in rows]
    want = [(i, len(t.encode()), n, n > 1024) for (i, _), t, n in zip(rows, texts, expected(library, texts))]
    assert sorted(map(str, found)) == sorted(
        f"Row(doc_id={i}, n_bytes={b}, n_tokens={n}, over_limit={o})" for i, b, n, o in want
    )


def test_empty_table(spark):
    found = tc.token_counts(docs(spark, []), tc.default_tokenizer())
    assert found.count() == 0 and found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]


def test_other_tokenizers_are_refused():
    import public_tokenizers

    with pytest.raises(ValueError):
        tc.load_vocabulary(public_tokenizers.path("word_bpe_49k.json"))
