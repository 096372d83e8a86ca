"""Token counts of byte-level BPE by rank-synchronous merging of ragged arrays.

Pre-tokens of a batch are held as one flat array of symbols with the start of each sequence.
In each round every sequence finds its lowest-rank pair and merges all its occurrences at
once; sequences without a pair leave. What survives are the tokens. A pre-token is counted
once per worker, as long as the table of known ones has room; a full table is emptied.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import read_table, text_of, utf8, worker_state

#: Distinct pre-tokens whose counts a worker keeps. Beyond it the table starts anew; counts do not change.
KNOWN_TOKENS = 250_000
KNOWN_PIECES = 500_000
#: Symbols merged in one ragged array, to bound memory.
ROUND_SYMBOLS = 2_000_000
NONE = np.int32(2**31 - 1)

#: The byte-level pre-tokenizer's split, with Unicode's White_Space as in the library.
SPLIT = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


def load_vocabulary(path: str) -> dict:
    """Merge table of a tokenizers file: pair keys in order, their ranks and products, bytes, special strings.

    Symbols are numbered anew: bytes 0 to 255, then one per merge product.
    """
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, pre = spec["model"], spec["pre_tokenizer"]
    if model["type"] != "BPE" or pre["type"] != "ByteLevel" or spec["normalizer"] or pre["add_prefix_space"]:
        raise ValueError("only byte-level BPE without normalizer and prefix space is supported")
    if model.get("ignore_merges") or not pre.get("use_regex", True):
        raise ValueError("whole-word lookup and unsplit text are not supported")
    for token in spec["added_tokens"]:
        if token["lstrip"] or token["rstrip"] or token["single_word"]:
            raise ValueError(f"special string {token['content']!r} takes its surroundings")
    number = {letter: byte for byte, letter in byte_letters().items()}
    left, right, product = [], [], []
    for pair in model["merges"]:
        a, b = pair if isinstance(pair, list) else pair.split(" ")
        number.setdefault(a + b, len(number))
        left.append(number[a])
        right.append(number[b])
        product.append(number[a + b])
    symbols = len(number)
    keys = np.array(left, np.int64) * symbols + np.array(right, np.int64)
    order = np.argsort(keys, kind="stable")
    return {
        "symbols": symbols,
        "keys": keys[order],
        "ranks": order.astype(np.int32),
        "products": np.array(product, np.int32),
        "special": sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True),
    }


def pair_ranks(vocabulary: dict, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    wanted = a.astype(np.int64) * vocabulary["symbols"] + b
    keys = vocabulary["keys"]
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, vocabulary["ranks"][at], NONE)


def count_symbols(vocabulary: dict, words: list[bytes]) -> np.ndarray:
    """Tokens of each non-empty pre-token."""
    counts = np.fromiter(map(len, words), np.int64, len(words))
    symbols = np.frombuffer(b"".join(words), np.uint8).astype(np.int32)
    active, lengths = np.arange(len(words)), counts.copy()
    ranks = np.full(len(symbols), NONE, np.int32)
    ranks[:-1] = pair_ranks(vocabulary, symbols[:-1], symbols[1:])
    ranks[np.cumsum(lengths) - 1] = NONE
    while len(active):
        lowest = np.minimum.reduceat(ranks, np.cumsum(lengths) - lengths)
        live = lowest != NONE
        counts[active[~live]] = lengths[~live]
        if not live.all():
            kept = np.repeat(live, lengths)
            symbols, ranks = symbols[kept], ranks[kept]
            active, lengths, lowest = active[live], lengths[live], lowest[live]
            if not len(active):
                break
        hit = ranks == np.repeat(lowest, lengths)
        if (hit[1:] & hit[:-1]).any():
            # a run of overlapping occurrences, as in aaa: every second one from its start merges
            at = np.arange(len(hit))
            first = np.maximum.accumulate(np.where(hit & ~np.concatenate(([False], hit[:-1])), at, 0))
            hit &= (at - first) % 2 == 0
        where = np.flatnonzero(hit)
        symbols[where] = vocabulary["products"][ranks[where]]
        stays = np.ones(len(symbols), bool)
        stays[where + 1] = False
        place = np.cumsum(stays) - 1
        lengths = lengths - np.add.reduceat(hit, np.cumsum(lengths) - lengths, dtype=np.int64)
        symbols, ranks = symbols[stays], ranks[stays]
        # only pairs with a merged symbol are new
        fresh = place[where]
        fresh = np.concatenate((fresh, fresh[fresh > 0] - 1))
        ranks[fresh] = pair_ranks(vocabulary, symbols[fresh], symbols[np.minimum(fresh + 1, len(symbols) - 1)])
        ranks[np.cumsum(lengths) - 1] = NONE
    return counts


def count_in_slices(vocabulary: dict, words: list[bytes]) -> np.ndarray:
    sizes = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
    out, begin = [], 0
    while begin < len(words):
        limit = (sizes[begin - 1] if begin else 0) + ROUND_SYMBOLS
        end = max(begin + 1, int(np.searchsorted(sizes, limit, "right")))
        out.append(count_symbols(vocabulary, words[begin:end]))
        begin = end
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def token_counter(vocabulary: dict):
    """A function from texts to their token counts.

    No pre-token runs from a non-space into a space, so a text without two adjacent white-space
    characters is the sum of its space-led pieces, and pieces come back often enough to remember.
    """
    import re

    import regex

    split = regex.compile(SPLIT).findall
    adjacent = re.compile(r"\s\s").search
    special = "|".join(regex.escape(s) for s in vocabulary["special"])
    cut = regex.compile(f"({special})").split if special else None
    strings = set(vocabulary["special"])
    known: dict[str, int] = {}  # of pre-tokens
    pieces: dict[str, int] = {}  # of a space and the piece
    heads: dict[str, int] = {}  # of the first piece of a line

    def learn(new: set[str]) -> None:
        unknown = [p for p in new if p not in known]
        if len(known) + len(unknown) > KNOWN_TOKENS:
            known.clear()
            unknown = list(new)
        known.update(zip(unknown, count_in_slices(vocabulary, [utf8(p) for p in unknown]).tolist()))

    def learn_pieces(new: set[str]) -> None:
        """Space-led pieces are split in one go: a pre-token that begins with a space begins a piece."""
        unknown = [p for p in new if p not in pieces]
        if len(pieces) + len(unknown) > KNOWN_PIECES:
            pieces.clear()
            unknown = list(new)
        alone = [p for p in unknown if not p or p[-1].isspace()]
        if alone:  # these would join the next piece's space
            learn(set().union(*(split(" " + p) for p in alone)))
            pieces.update((p, sum(known[w] for w in split(" " + p))) for p in alone)
            unknown = [p for p in unknown if p and not p[-1].isspace()]
        if unknown:
            words = split(" " + " ".join(unknown))
            learn(set(words))
            begins = np.flatnonzero([w[0] == " " for w in words])
            counts = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
            pieces.update(zip(unknown, np.add.reduceat(counts, begins).tolist()))

    def learn_heads(new: set[str]) -> None:
        unknown = [p for p in new if p not in heads]
        if len(heads) + len(unknown) > KNOWN_TOKENS:
            heads.clear()
            unknown = list(new)
        parts = [split(p) for p in unknown]
        learn(set().union(*parts))
        get = known.__getitem__
        heads.update(zip(unknown, [sum(map(get, x)) for x in parts]))

    def count(texts: list[str]) -> list[int]:
        counts, slow, lines = [], [], []
        for i, text in enumerate(texts):
            special_found = cut is not None and any(s in text for s in strings)
            parts = cut(text) if special_found else [text]
            total = 0
            for part in parts:
                if special_found and part in strings:
                    total += 1
                elif adjacent(part):
                    slow.append((i, split(part)))
                else:
                    total += part.count("\n")
                    lines += [(i, line.split(" ")) for line in part.split("\n")]
            counts.append(total)
        learn(set().union(*(words for _, words in slow)))
        for i, words in slow:
            counts[i] += sum(map(known.__getitem__, words))
        learn_heads({words[0] for _, words in lines})
        tails: set[str] = set()
        for i, words in lines:
            counts[i] += heads[words[0]]
            del words[0]
            tails.update(words)
        learn_pieces(tails)
        get = pieces.__getitem__
        for i, words in lines:
            counts[i] += sum(map(get, words))
        return counts

    return count


def token_counts(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024
) -> DataFrame:
    """One row per input row: id, ``n_bytes``, ``n_tokens``, ``over_limit`` (n_tokens > limit).

    A null text is empty: 0 bytes, 0 tokens. Null and repeated ids are kept as they are. Other
    columns are ignored. Whole texts are counted; special strings in a text are one token each,
    as the library does by default. The plan is one scan without a shuffle. The merge table is
    sent to the executors; its size is that of the vocabulary.
    """
    vocabulary = load_vocabulary(tokenizer_path)
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)
    key = f"bpe {tokenizer_path}"

    def run(batches):
        count = worker_state(key, lambda: token_counter(sent.value))
        for batch in batches:
            tokens, texts = [], batch.column(1)
            sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
            # slices of about 4 MB of text: only one slice's pre-tokens are in memory
            part = np.cumsum(sizes) // 4_000_000
            for p in np.unique(part):
                at = np.flatnonzero(part == p)
                tokens += count(texts.slice(at[0], len(at)).to_pylist())
            tokens = np.array(tokens, np.int64)
            columns = [batch.column(0), pa.array(sizes), pa.array(tokens), pa.array(tokens > limit)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    counted = rows.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean")
    return counted.withColumnRenamed("id", id_col)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read_table(spark, sf_dir, "documents"), default_tokenizer())


QUERIES = {"op1_token_counts": op1_token_counts}
ORACLE = {}
