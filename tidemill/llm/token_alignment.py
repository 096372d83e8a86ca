"""Which tokens of two tokenizers meet in the same bytes, counted by inverted bitmaps.

Documents are cut into groups at the byte offsets where tokens of both end; all pairs of a group are links. Blocks of
documents hold, for each pair of ids, a compressed bitmap of the documents that link it, and one further bitmap for
each binary digit of the links beyond the first (a multiplicity plane). A document's bits are OR-ed into its block's
bitmaps; blocks share no document, so a pair's document count is the sum of its bitmaps' popcounts. The counts return to
the postings, and each block turns them into its documents' scores.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import read_table, text_of, utf8, worker_state
from tidemill.llm.token_counts import byte_letters
from tidemill.storage import materialize

#: A block of documents is closed at so many documents (numbers of 16 bits) or links.
BLOCK_DOCS = 1 << 14
BLOCK_LINKS = 2_000_000
#: Bytes of text that the tokenizers get at once, and after which a worker forgets chunks it knows.
SLICE_BYTES = 2 << 20
KNOWN_BYTES = 64 << 20
#: Plain chunks that the tokenizers get as one text.
RUN = 64
#: Links of a group from which its distinct ids are paired instead of its tokens.
BIG_GROUP = 1 << 20

#: A place where both tokenizers must cut: before a single space or line feed between other characters.
CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
PLAIN = re.compile(r"[ \n]\S+")


class Aligner:
    """Tokens, groups and links of texts. What is known of a chunk of text is kept by number."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        with open(path_a, encoding="utf-8") as file:
            spec = json.load(file)
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte = {letter: value for value, letter in byte_letters().items()}
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for token, number in self.a.get_vocab().items():
            known = all(c in byte for c in token)
            self.bytes_a[number] = bytes(byte[c] for c in token) if known else utf8(token)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        is_byte = re.compile(r"<0x([0-9A-F]{2})>").fullmatch
        self.bytes_b = [bytes([int(m[1], 16)]) if (m := is_byte(p)) else utf8(p.replace("▁", " ")) for p in pieces]
        self.size_b = len(pieces)
        # other vocabularies get whole texts
        pre = spec["pre_tokenizer"] or {}
        byte_level = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not spec["normalizer"]
        crossing = any("\n" in p or re.search("[^▁]▁", p) for p in pieces)
        self.cuts = byte_level and not pre["add_prefix_space"] and not crossing
        self.len_a = np.array([len(t) for t in self.bytes_a], np.int64)
        self.len_b = np.array([len(t) for t in self.bytes_b], np.int64)
        names = [str(i) for i in range(len(self.bytes_a))] + [str(i) for i in range(self.size_b)]
        self.names = [n + mark for mark in ",|;\0" for n in names]
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.known_bytes = 0
        self.texts: list[str] = []  # a chunk's groups as text
        self.counts = np.zeros((0, 4), np.int64)  # tokens of A, of B, groups, links
        self.valid = np.zeros(0, bool)
        self.seen = np.zeros(0, np.int64)  # how often a chunk came up since it was learned or last kept
        self.sizes = np.zeros(0, np.int64)  # bytes that it takes, about
        self.first = np.zeros(1, np.int64)  # a chunk's pairs are pairs[first[i]:first[i + 1]]
        self.pairs = np.zeros(0, np.int64)
        self.times = np.zeros(0, np.int64)

    def forget_rare(self) -> None:
        """Keep the chunks that came up most, more than once each, in half of the room."""
        order = np.argsort(-self.seen, kind="stable")
        order = order[self.seen[order] > 1]
        kept = np.sort(order[np.cumsum(self.sizes[order]) <= KNOWN_BYTES // 2])
        names = list(self.known)  # in the order of their numbers
        count = self.first[kept + 1] - self.first[kept]
        at = np.repeat(self.first[kept] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        self.known = {names[i]: place for place, i in enumerate(kept.tolist())}
        self.texts = [self.texts[i] for i in kept.tolist()]
        self.counts, self.valid, self.sizes = self.counts[kept], self.valid[kept], self.sizes[kept]
        self.seen = np.zeros(len(kept), np.int64)
        self.first = np.concatenate((np.zeros(1, np.int64), np.cumsum(count)))
        self.pairs, self.times = self.pairs[at], self.times[at]
        self.known_bytes = int(self.sizes.sum())

    def chunks(self, text: str) -> list[str]:
        whole = " " + text
        if not self.cuts:
            return [whole]
        found = PLAIN.findall(whole)
        # a text that is more than single spaces and line feeds between words takes the slower way
        return found if sum(map(len, found)) == len(whole) else CUT.split(whole)

    def learn(self, chunks: list[str]) -> None:
        """Encode chunks that are not known yet, some at a time."""
        held, size = [], 0
        for chunk in chunks:
            held.append(chunk)
            size += len(chunk)
            if size >= SLICE_BYTES:
                self._learn(held)
                held, size = [], 0
        if held:
            self._learn(held)

    def _learn(self, chunks: list[str]) -> None:
        single = self._learn_runs(chunks) if self.cuts else chunks
        if single:
            self._learn_each(single)

    def _learn_runs(self, chunks: list[str]) -> list[str]:
        """Encode plain chunks many at a time, as one text that both cut between them. Returns those left over."""
        runs, joined, left = [], [], []
        for i in range(0, len(chunks), RUN):
            run = chunks[i : i + RUN]
            text = "".join(run)
            if PLAIN.findall(text) == run:
                runs.append(run)
                joined.append(text)
            else:
                left += run
        of_a, of_b = self._encode(joined)
        raw = [utf8(text) for text in joined]
        fits = self._spelled(self.bytes_a, of_a, raw) & self._spelled(self.bytes_b, of_b, raw)
        done, sizes, ids_a, ids_b = [], [], [], []
        for run, text, own, a, b, fit in zip(runs, joined, raw, of_a, of_b, fits.tolist()):
            size = np.fromiter(map(len, run if len(own) == len(text) else map(utf8, run)), np.int64, len(run))
            a, b = np.array(a, np.int64), np.array(b, np.int64)
            n_a, n_b = (_per_chunk(np.cumsum(of[x]), size) if fit else None for of, x in ((self.len_a, a), (self.len_b, b)))
            if n_a is None or n_b is None:
                left += run
                continue
            done += run
            sizes.append((size, n_a, n_b))
            ids_a.append(a)
            ids_b.append(b)
        if done:
            size, n_a, n_b = (np.concatenate(x) for x in zip(*sizes))
            self._keep(done, size, n_a, n_b, np.concatenate(ids_a), np.concatenate(ids_b), np.ones(len(done), bool))
        return left

    def _encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of A and of B."""
        of_a = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        # B puts a space before a text: the chunk's own, or one too many before a line feed
        of_b = self.b.encode([t[1:] if t[0] == " " else t for t in texts], num_threads=1)
        return of_a, [ids if t[0] == " " else ids[1:] for t, ids in zip(texts, of_b)]

    def _learn_each(self, chunks: list[str]) -> None:
        raw = [utf8(c) for c in chunks]
        of_a, of_b = self._encode(chunks)
        valid = self._spelled(self.bytes_a, of_a, raw) & self._spelled(self.bytes_b, of_b, raw)
        if not valid.all():
            of_a = [x if ok else () for x, ok in zip(of_a, valid)]
            of_b = [x if ok else () for x, ok in zip(of_b, valid)]
        n = len(chunks)
        n_a = np.fromiter(map(len, of_a), np.int64, n)
        n_b = np.fromiter(map(len, of_b), np.int64, n)
        a = np.fromiter(chain.from_iterable(of_a), np.int64, int(n_a.sum()))
        b = np.fromiter(chain.from_iterable(of_b), np.int64, int(n_b.sum()))
        self._keep(chunks, np.fromiter(map(len, raw), np.int64, n), n_a, n_b, a, b, valid)

    def _keep(self, chunks: list[str], size, n_a, n_b, a, b, valid) -> None:
        n, base = len(chunks), len(self.texts)
        ends_a, ends_b = np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b])
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        in_a, in_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        size_a, size_b = np.bincount(in_a, minlength=len(common)), np.bincount(in_b, minlength=len(common))
        chunk_of = np.repeat(np.arange(n), n_a)[np.cumsum(size_a) - size_a]  # of each group
        links = size_a * size_b
        counts = [n_a, n_b, np.bincount(chunk_of, minlength=n)]
        counts.append(np.add.reduceat(np.append(links, 0), np.searchsorted(chunk_of, np.arange(n))) * (n_a > 0))
        owner, pairs, times = self._links(a, b, in_a, size_a, size_b, chunk_of)
        self.texts += self._group_texts(a, b, in_a, in_b, chunk_of, n_a > 0)
        self.known.update(zip(chunks, range(base, base + n)))
        per_chunk = np.bincount(owner, minlength=n)
        takes = 2 * size + 16 * per_chunk + 8 * (n_a + n_b) + 200
        self.known_bytes += int(takes.sum())
        self.sizes = np.concatenate((self.sizes, takes))
        self.seen = np.concatenate((self.seen, np.zeros(n, np.int64)))
        self.counts = np.concatenate((self.counts, np.stack(counts, 1)))
        self.valid = np.concatenate((self.valid, valid))
        self.first = np.concatenate((self.first, self.first[-1] + np.cumsum(per_chunk)))
        self.pairs, self.times = np.concatenate((self.pairs, pairs)), np.concatenate((self.times, times))

    @staticmethod
    def _spelled(table: list[bytes], tokens: list[list[int]], raw: list[bytes]) -> np.ndarray:
        """Whether each chunk's tokens spell its bytes: of all chunks at once, or of each if one does not."""
        get = table.__getitem__
        made = [b"".join(map(get, own)) for own in tokens]
        return np.ones(len(raw), bool) if made == raw else np.array([x == r for x, r in zip(made, raw)], bool)

    def _links(self, a, b, in_a, size_a, size_b, chunk_of) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(chunk, pair, links) of each chunk's distinct pairs; a pair is a's id times B's size plus b's id."""
        begin_a, begin_b = np.cumsum(size_a) - size_a, np.cumsum(size_b) - size_b
        big = size_a * size_b > BIG_GROUP
        here = np.flatnonzero(~big[in_a])
        repeat = size_b[in_a[here]]
        inner = np.arange(int(repeat.sum())) - np.repeat(np.cumsum(repeat) - repeat, repeat)
        owner = [np.repeat(chunk_of[in_a[here]], repeat)]
        pairs = [np.repeat(a[here], repeat) * self.size_b + b[np.repeat(begin_b[in_a[here]], repeat) + inner]]
        times = [np.ones(len(pairs[0]), np.int64)]
        for g in np.flatnonzero(big).tolist():
            ids_a, n_a = np.unique(a[begin_a[g] : begin_a[g] + size_a[g]], return_counts=True)
            ids_b, n_b = np.unique(b[begin_b[g] : begin_b[g] + size_b[g]], return_counts=True)
            pairs.append((ids_a[:, None] * self.size_b + ids_b).ravel())
            times.append((n_a[:, None] * n_b).ravel())
            owner.append(np.full(len(pairs[-1]), chunk_of[g]))
        n_pairs = len(self.bytes_a) * self.size_b
        keys, times = _summed(np.concatenate(owner) * n_pairs + np.concatenate(pairs), np.concatenate(times))
        return *np.divmod(keys, n_pairs), times

    def _group_texts(self, a, b, in_a, in_b, chunk_of, filled) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` of each chunk."""
        order = np.argsort(np.concatenate((2 * in_a, 2 * in_b + 1)), kind="stable")
        place = np.concatenate((2 * in_a, 2 * in_b + 1))[order]
        name = np.concatenate((a, b + len(self.bytes_a)))[order]
        of = chunk_of[place >> 1]
        same, same_chunk = np.append(place[1:], -1) == place, np.append(of[1:], -1) == of
        mark = np.where(same, 0, np.where(place & 1 == 0, 1, np.where(same_chunk, 2, 3)))
        total = len(self.bytes_a) + self.size_b
        made = iter("".join(map(self.names.__getitem__, (mark * total + name).tolist())).split("\0"))
        return [next(made) if ok else "" for ok in filled]

    def numbers(self, texts: list[str]) -> list[np.ndarray | None]:
        """The numbers of each text's chunks; None for a text without tokens."""
        cut = [self.chunks(t) if t else [] for t in texts]
        self.learn(sorted(set(chain.from_iterable(cut)).difference(self.known)))
        get = self.known.__getitem__
        out: list[np.ndarray | None] = []
        for text, chunks in zip(texts, cut):
            row = np.fromiter(map(get, chunks), np.int64, len(chunks))
            if not self.valid[row].all():  # let the library have the whole text
                whole = " " + text
                if whole not in self.known:
                    self.learn([whole])
                row = np.array([self.known[whole]])
            out.append(row if len(row) and self.valid[row].all() else None)
        used = [row for row in out if row is not None]
        if used:
            self.seen += np.bincount(np.concatenate(used), minlength=len(self.seen))
        return out


def _per_chunk(ends: np.ndarray, size: np.ndarray) -> np.ndarray | None:
    """Tokens of each chunk, of the ends of all tokens and the chunks' sizes; None if one lies across two chunks."""
    cuts = np.cumsum(size)
    last = np.searchsorted(ends, cuts)
    whole = len(ends) and (np.diff(ends) > 0).all() and ends[0] > 0 and ends[-1] == cuts[-1]
    return np.diff(last, prepend=-1) if whole and (ends[last] == cuts).all() else None


def _summed(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, with their times added up."""
    if not len(keys):
        return keys, times
    order = np.argsort(keys)
    keys = keys[order]
    new = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[new], np.add.reduceat(times[order], new)


def encode_bitmaps(which: np.ndarray, docs: np.ndarray, n_bitmaps: int, n_docs: int) -> pa.Array:
    """Bitmaps of document numbers: sorted 16-bit numbers where these are shorter, else a bit for each document."""
    count = np.bincount(which, minlength=n_bitmaps)
    full = (n_docs + 7) // 8
    dense = 2 * count >= full
    offsets = np.concatenate(([0], np.cumsum(np.where(dense, full, 2 * count))))
    data = np.zeros(int(offsets[-1]), np.uint8)
    rank = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
    bit = dense[which]
    place = offsets[which[~bit]] + 2 * rank[~bit]
    data[place], data[place + 1] = docs[~bit] & 255, docs[~bit] >> 8
    np.bitwise_or.at(data, offsets[which[bit]] + (docs[bit] >> 3), (1 << (docs[bit] & 7)).astype(np.uint8))
    buffers = [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())]
    return pa.Array.from_buffers(pa.binary(), n_bitmaps, buffers)


def decode_bitmaps(bitmaps: pa.Array, n_docs: int):
    """Slices of (bitmap, document number) for all set bits, of a few million at most."""
    full = (n_docs + 7) // 8
    if not len(bitmaps):
        return
    offsets = np.frombuffer(bitmaps.buffers()[1], np.int32)[bitmaps.offset : bitmaps.offset + len(bitmaps) + 1]
    data = np.frombuffer(bitmaps.buffers()[2] or b"", np.uint8)
    sizes = np.diff(offsets).astype(np.int64)
    sparse = np.flatnonzero(sizes < full)
    step = max(1, (1 << 22) // max(1, n_docs))
    for low in range(0, len(sparse), 1 << 16):
        rows = sparse[low : low + (1 << 16)]
        count = sizes[rows] // 2
        inner = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        place = np.repeat(offsets[rows].astype(np.int64), count) + 2 * inner
        yield np.repeat(rows, count), data[place].astype(np.int64) | (data[place + 1].astype(np.int64) << 8)
    dense = np.flatnonzero(sizes == full)
    for low in range(0, len(dense), step):
        rows = dense[low : low + step]
        bits = data[offsets[rows].astype(np.int64)[:, None] + np.arange(full)]
        which, docs = np.nonzero(np.unpackbits(bits, axis=1, bitorder="little"))
        yield rows[which], docs


def postings_of(aligner: Aligner, rows: list[np.ndarray | None]) -> dict[str, np.ndarray | pa.Array]:
    """One block's bitmaps: (pair, plane, n_docs, docs), sorted by pair and plane."""
    sizes = np.array([0 if r is None else len(r) for r in rows])
    if not sizes.sum():
        return {}
    doc = np.repeat(np.arange(len(rows)), sizes)
    chunk = np.concatenate([r for r in rows if r is not None])
    held, times = np.unique(doc * len(aligner.texts) + chunk, return_counts=True)
    doc, chunk = np.divmod(held, len(aligner.texts))
    count = aligner.first[chunk + 1] - aligner.first[chunk]
    at = np.repeat(aligner.first[chunk] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
    links = aligner.times[at] * np.repeat(times, count)
    keys, links = _summed(aligner.pairs[at] * len(rows) + np.repeat(doc, count), links)
    pair, doc = np.divmod(keys, len(rows))
    new = np.append(True, pair[1:] != pair[:-1])
    number, distinct = np.cumsum(new) - 1, pair[new]
    found = []
    for plane in range(int((links - 1).max()).bit_length() + 1):
        here = np.ones(len(links), bool) if plane == 0 else ((links - 1) >> (plane - 1) & 1).astype(bool)
        if not here.any():
            continue
        ids, which = np.unique(number[here], return_inverse=True)
        bitmaps = encode_bitmaps(which, doc[here], len(ids), len(rows))
        found.append((distinct[ids], np.full(len(ids), plane), np.bincount(which), bitmaps))
    pairs, planes, n_docs = (np.concatenate([f[i] for f in found]) for i in range(3))
    order = np.lexsort((planes, pairs))
    bitmaps = pa.concat_arrays([f[3] for f in found]).take(pa.array(order))
    return {"pair": pairs[order], "plane": planes[order], "n_docs": n_docs[order], "docs": bitmaps}


INDEX = "no int, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
POSTING = "a int, b int, plane int, n_docs int, docs binary"


def _indexer(path_a: str, path_b: str):
    """Documents (block, number, id, counts) and, after each block, its postings."""

    def run(batches):
        aligner = worker_state(f"aligner {path_a} {path_b}", lambda: Aligner(path_a, path_b))
        task, block, rows, links = TaskContext.get().partitionId(), 0, [], 0

        def documents(ids: pa.Array, own: list[np.ndarray | None], first: int) -> pa.RecordBatch:
            counts = np.array([np.zeros(4, np.int64) if r is None else aligner.counts[r].sum(0) for r in own])
            counts = counts.reshape(len(own), 4)
            get = aligner.texts.__getitem__
            shas = [
                "" if r is None else hashlib.sha256(";".join(map(get, r.tolist())).encode()).hexdigest() for r in own
            ]
            n = len(own)
            columns = [pa.array(np.full(n, task << 32 | block)), ids]
            columns.append(pa.array(np.arange(first, first + n), pa.int32()))
            columns += [pa.array(counts[:, i]) for i in range(4)] + [pa.array(shas, pa.string())]
            columns += [pa.nulls(n, pa.int32())] * 4 + [pa.nulls(n, pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names)

        def postings() -> pa.RecordBatch | None:
            made = postings_of(aligner, rows)
            if not made:
                return None
            n = len(made["pair"])
            a, b = np.divmod(made["pair"], aligner.size_b)
            columns = [pa.array(np.full(n, task << 32 | block)), pa.nulls(n, kind), pa.nulls(n, pa.int32())]
            columns += [pa.nulls(n, pa.int64())] * 4 + [pa.nulls(n, pa.string())]
            columns += [pa.array(x.astype(np.int32)) for x in (a, b, made["plane"], made["n_docs"])] + [made["docs"]]
            return pa.RecordBatch.from_arrays(columns, names)

        names = ["block", "id", "no", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
        names += ["a", "b", "plane", "n_docs", "docs"]
        kind = pa.null()
        for batch in batches:
            kind = batch.schema.field(0).type
            texts = batch.column(1)
            sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
            low = 0
            while low < len(texts):
                # some documents of a few MB together, one longer one alone
                total = np.cumsum(sizes[low : low + BLOCK_DOCS - len(rows)])
                high = low + max(1, int(np.searchsorted(total, SLICE_BYTES, "right")))
                own = aligner.numbers(texts.slice(low, high - low).to_pylist())
                yield documents(batch.column(0).slice(low, high - low), own, len(rows))
                rows += own
                links += sum(int((aligner.first[r + 1] - aligner.first[r]).sum()) for r in own if r is not None)
                if len(rows) >= BLOCK_DOCS or links >= BLOCK_LINKS:
                    made = postings()
                    if made is not None:
                        yield made
                    block, rows, links = block + 1, [], 0
                    if aligner.known_bytes > KNOWN_BYTES:
                        aligner.forget_rare()
                low = high
        made = postings()
        if made is not None:
            yield made

    return run


def alignment_index(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text"):
    """The written index: (documents by block and number, postings by block, pair and plane)."""
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    made = rows.mapInArrow(_indexer(path_a, path_b), f"block long, id {kind}, {INDEX}, {POSTING}")
    made = materialize(made, "alignment-index")
    documents = made.filter("no IS NOT NULL").drop("a", "b", "plane", "n_docs", "docs")
    return documents, made.filter("a IS NOT NULL").select("block", "a", "b", "plane", "n_docs", "docs")


def pair_counts(postings: DataFrame) -> DataFrame:
    """(a, b, n_docs, n_links): how many documents link a pair, and how often they do in all."""
    weight = F.when(F.col("plane") == 0, F.lit(1)).otherwise(F.expr("shiftleft(1L, plane - 1)"))
    return postings.groupBy("a", "b").agg(
        F.sum(F.when(F.col("plane") == 0, F.col("n_docs")).otherwise(0)).alias("n_docs"),
        F.sum(F.col("n_docs") * weight).alias("n_links"),
    )


def _score_block(key: tuple, documents: pa.Table, scored: pa.Table) -> pa.Table:
    n = documents.num_rows
    number = documents.column("no").to_numpy()
    total, best = np.zeros(n, np.int64), np.zeros(n, np.int64)
    if scored.num_rows:
        plane, count = scored.column("plane").to_numpy(), scored.column("count").to_numpy()
        is_best = scored.column("best").to_numpy().astype(np.int64)
        weight = np.where(plane == 0, 1, 1 << np.maximum(plane.astype(np.int64) - 1, 0))
        base = 0
        for part in scored.column("docs").chunks:
            for row, doc in decode_bitmaps(part, n):
                np.add.at(total, doc, (weight * count)[base + row])
                np.add.at(best, doc, (weight * is_best)[base + row])
            base += len(part)
    kept = [documents.column(c) for c in ("id", "n_a", "n_b", "n_groups", "n_links")]
    kept += [pa.array(best[number]), pa.array(total[number]), documents.column("groups_sha256")]
    return pa.table(kept, names=["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])


def aligned_tokens(
    docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256``.

    A is a byte-level vocabulary and gets a space before the text, B a sentencepiece model that puts one there. A pair's
    count is the number of documents, of all, that link it; ``n_best`` counts the links whose pair has its A id's highest
    count, ties included, ``count_sum`` adds up the counts over all links. Null and empty texts, and those whose tokens of
    A or B do not spell the space and the text, have no tokens: zeros and an empty ``groups_sha256``. Each row is a
    document of its own, also if it shares its id or text with others; null ids are kept; other columns are ignored.

    Texts are encoded chunk by chunk, cut where no token of either can cross, and a worker remembers chunks up to
    ``KNOWN_BYTES``. A block holds ``BLOCK_LINKS`` distinct links or one longer document. The shuffles carry one row for a
    block's pair, not one for a document's; the only broadcast has a row for each id of A at most.
    """
    documents, postings = alignment_index(docs, path_a, path_b, id_col, text_col)
    counts = materialize(pair_counts(postings).select("a", "b", F.col("n_docs").alias("count")), "alignment-counts")
    top = counts.groupBy("a").agg(F.max("count").alias("top"))
    scores = counts.join(F.broadcast(top), "a").select("a", "b", "count", (F.col("count") == F.col("top")).alias("best"))
    scored = postings.join(scores, ["a", "b"]).select(F.col("block").alias("of"), "plane", "docs", "count", "best")
    kind = documents.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long"
    found = documents.groupBy("block").cogroup(scored.groupBy("of"))
    found = found.applyInArrow(_score_block, f"{schema}, groups_sha256 string")
    return found.withColumnRenamed("id", id_col)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return aligned_tokens(read_table(spark, sf_dir, "documents"), *paths)


QUERIES = {"op12_token_alignment": op12_token_alignment}
#: Tokenizers have no SQL form.
ORACLE = {}
