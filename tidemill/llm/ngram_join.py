"""N-gram Jaccard join by PartEnum signatures, and the components of its links.

Sets of similar size fall into the same or the next size band. A band bounds by how many elements
two similar sets of it can differ; call it k. The domain of shingle hashes is cut into more than k
parts, so that similar sets agree on a whole part (small sets: on all but one sub-part of a part,
every choice enumerated). The sum of a part's hashes, with band and part, is a signature.

Sets that share a signature are not compared pair by pair. Each one is compared with the smallest
documents of its signatures, those that it shares most with first: in two rounds, between which the
links found join components, so that only what is still apart is compared in the next. Where sets that
share signatures are then still in several components, every pair of different components that may
be similar is found by prefix filtering (similar sets share one of their rarest shingles) with a
bitmap filter (the bits in which the parities of two sets differ are no more than the elements in
which the sets do) and compared as well. So no link between two components is lost, and a group of
copies costs one comparison each.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.llm.common import (
    mix64, read_table, rolling_hashes, text_of, utf8, word_bounds, word_hashes,
)
from tidemill.llm.components import connected_components
from tidemill.storage import materialize

WORDS = 4
#: Similar: den * intersection >= num * union.
NUM, DEN = 85, 100
#: Sets that can differ by fewer elements get enumerated sub-parts, larger ones plain parts.
ENUMERATED_BELOW = 8
#: Comparisons with one document that a group takes at most.
PIVOT_ROWS = 1000
SLICE_BYTES = 8_000_000
#: Up to which place of a document's smallest documents the two rounds compare. Prefix filtering covers the others.
ROUNDS = (1, 8)
#: 64-bit words of a set's parities, a bit for the elements of each remainder.
PARITIES = 8
#: Copies of an element that are told apart when elements are ordered by frequency.
OFTEN = 5000

#: Kinds of rows between the first steps. Documents of an open pair share a signature with others as well.
OPEN, CLOSED, SIGNATURE, KNOWN, SIZE = -2, -1, 0, 1, 2


def shingle_set(text: str | bytes, words: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a text, lower-cased in A-Z. Without words it is empty."""
    data = np.frombuffer(utf8(text) if isinstance(text, str) else text, np.uint8)
    starts, ends = word_bounds(data)
    hashes = word_hashes(data, starts, ends, lower=True)
    if not len(hashes):
        return hashes
    return np.unique(rolling_hashes(hashes, min(words, len(hashes))))


@lru_cache(maxsize=None)
def bands(num: int, den: int) -> list[tuple[int, int]]:
    """Smallest and largest size of each band. Similar sets are in the same band or in neighbours."""
    out, low = [], 1
    while low < 1 << 40:
        high = low * den // num
        out.append((low, high))
        low = high + 1
    return out


@lru_cache(maxsize=None)
def scheme(band: int, num: int, den: int) -> tuple[int, int, int, int]:
    """(k, parts, sub-parts, spare): sets of this or the previous band differ in at most k elements.

    They agree on all but one sub-part of a part, or without sub-parts on more than ``spare`` parts.
    Spare parts let a set leave out its smallest parts, which unrelated sets may share.
    """
    k = (den - num) * 2 * bands(num, den)[band][1] // (den + num)
    if k == 0:
        return k, 1, 1, 0
    spare = k // 4
    if k < ENUMERATED_BELOW:
        return k, k // 2 + 1 + spare, 3, spare
    return k, k + 1 + spare, 1, spare


def band_of(size: int, num: int, den: int) -> int:
    table = worker_bands(num, den)
    return int(np.searchsorted(table, size, "right")) - 1


@lru_cache(maxsize=None)
def worker_bands(num: int, den: int) -> np.ndarray:
    return np.array([low for low, _ in bands(num, den)], np.int64)


def signatures(elements: np.ndarray, num: int = NUM, den: int = DEN) -> np.ndarray:
    """Signatures of a non-empty sorted set for its band and the next."""
    sums = np.zeros(len(elements) + 1, np.uint64)
    np.cumsum(mix64(elements ^ np.uint64(0xA0761D6478BD642F)), out=sums[1:])
    own, out = band_of(len(elements), num, den), []
    for band in (own, own + 1):
        _, parts, subs, spare = scheme(band, num, den)
        n = parts * subs
        edges = (np.arange(n + 1, dtype=np.uint64) << np.uint64(32)) // np.uint64(n) << np.uint64(32)
        cuts = np.searchsorted(elements, edges[:-1])
        cuts = np.append(cuts, len(elements))
        value = (sums[cuts[1:]] - sums[cuts[:-1]]).reshape(parts, subs)
        counts = (cuts[1:] - cuts[:-1]).reshape(parts, subs)
        if subs > 1:
            chosen = [list(c) for c in combinations(range(subs), subs - 1)]
            value = np.stack([value[:, c].sum(axis=1, dtype=np.uint64) for c in chosen], axis=1)
            counts = np.stack([counts[:, c].sum(axis=1) for c in chosen], axis=1)
        # similar sets agree in more than the spare parts, so in one that neither counts to its smallest
        large = counts >= np.partition(counts.min(axis=1), spare)[spare]
        label = np.arange(parts)[:, None] * 8 + np.arange(value.shape[1])
        label, value = label[large], value[large]
        place = label.astype(np.uint64) + np.uint64(band << 40)
        out.append(mix64(value + mix64(place)))
    return np.concatenate(out).view(np.int64)


def _runs(*sorted_columns: np.ndarray) -> np.ndarray:
    """Starts of runs of equal rows."""
    n = len(sorted_columns[0])
    if not n:
        return np.zeros(0, np.int64)
    new = np.ones(n, bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in sorted_columns])
    return np.flatnonzero(new)


def _pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of different values, and how often they occur."""
    keep = a != b
    order = np.lexsort((b[keep], a[keep]))
    a, b = a[keep][order], b[keep][order]
    starts = _runs(a, b)
    return a[starts], b[starts], np.diff(np.append(starts, len(a)))


#: n: of a signature the documents that have it, of a pair the signatures they share.
TAGGED = "kind int, key long, a long, b long, n long"


def _tagged(kind: int, key: np.ndarray, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    columns = [np.full(len(a), kind, np.int32), *(np.asarray(x, np.int64) for x in (key, a, b, n))]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["kind", "key", "a", "b", "n"])


def sign(words: int, num: int, den: int):
    """From (id, text): signatures, pairs known to be equal, and the size of every set.

    In a slice of a batch, one of equal sets goes on, and of each signature the smallest id. The
    others are paired with it at once, so a hot group is a row per slice.
    """

    def slices(batches):
        for batch in batches:
            rows, size = [], 0
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows.append((key, shingle_set(text, words)))
                size += len(text)
                if size > SLICE_BYTES:
                    yield rows
                    rows, size = [], 0
            yield rows

    def run(batches):
        for rows in slices(batches):
            rows.sort(key=lambda r: (r[0] is None, r[0] or 0))
            first, equal, own, found = {}, [], [], []
            for key, elements in rows:
                if key is None or not len(elements):
                    continue
                at = first.setdefault(elements.tobytes(), key)
                if at != key:
                    equal.append((key, at))
                else:
                    found.append(signatures(elements, num, den))
                    own.append(np.full(len(found[-1]), key, np.int64))
            sizes = [len(e) for _, e in rows]
            ids = [k for k, _ in rows]
            columns = [
                pa.array(np.full(len(rows), SIZE, np.int32)),
                pa.array(mix64(np.arange(len(rows)) + 1).view(np.int64)),
                pa.array(ids, pa.int64()),
                pa.array(sizes, pa.int64()),
                pa.array(np.ones(len(rows), np.int64)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["kind", "key", "a", "b", "n"])
            if equal:
                a, b = np.array(sorted(set(equal)), np.int64).T
                yield _tagged(KNOWN, mix64(a).view(np.int64), a, b, np.ones(len(a)))
            if found:
                signature, owner = np.concatenate(found), np.concatenate(own)
                order = np.lexsort((owner, signature))
                signature, owner = signature[order], owner[order]
                starts = _runs(signature)
                lengths = np.diff(np.append(starts, len(signature)))
                yield _tagged(SIGNATURE, signature[starts], owner[starts], owner[starts], lengths)
                a, b, n = _pairs(owner, np.repeat(owner[starts], lengths))
                yield _tagged(OPEN, mix64(a).view(np.int64), a, b, n)

    return run


def gather(batches):
    """From rows sorted by kind, key and a: signatures become pairs with their smallest id; others pass.

    A signature of two documents is settled by comparing them; the pair is closed. With three or
    more the pairs are open. The last signature of a batch may go on in the next one, so it waits;
    of a long one only its smallest id does.
    """

    def pairs(key, a, n):
        starts = _runs(key)
        lengths = np.diff(np.append(starts, len(key)))
        pivot = np.repeat(a[starts], lengths)
        several = np.repeat(np.add.reduceat(n, starts) > 2, lengths)
        for kind, chosen in ((OPEN, several), (CLOSED, ~several)):
            left, right, shared = _pairs(a[chosen], pivot[chosen])
            yield _tagged(kind, left, left, right, shared)

    waiting = [np.zeros(0, np.int64)] * 3
    for batch in batches:
        kind = batch.column(0).to_numpy()
        signature = kind == SIGNATURE
        if not signature.all():
            yield batch.filter(pa.array(~signature))
        if not signature.any():
            continue
        rows = [batch.column(i).to_numpy(zero_copy_only=False)[signature].astype(np.int64) for i in (1, 2, 4)]
        key, a, n = (np.concatenate(pair) for pair in zip(waiting, rows))
        last = _runs(key)[-1]
        if len(key) - last > 2:
            yield from pairs(key, a, n)
            waiting = [key[last : last + 1], a[last : last + 1], np.array([3], np.int64)]
        else:
            if last:
                yield from pairs(key[:last], a[:last], n[:last])
            waiting = [key[last:], a[last:], n[last:]]
    if len(waiting[0]):
        yield from pairs(*waiting)


MARKED = "id long, kind int, text binary"


def packed_texts(batches):
    """(id, 1, text) with compressed texts."""
    packer = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        ids, texts = batch.column(0), [packer.compress(utf8(t)) for t in batch.column(1).to_pylist()]
        columns = [ids, pa.array(np.ones(len(ids), np.int32)), pa.array(texts, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["id", "kind", "text"])


def only_wanted(batches):
    """From rows sorted by id and kind: the texts (kind 1) of the ids that have a row of kind 0."""
    wanted = None
    for batch in batches:
        ids, kinds = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        keep = []
        for key, kind in zip(ids, kinds):
            if kind == 0:
                wanted = key
            keep.append(kind == 1 and key is not None and key == wanted)
        yield batch.filter(pa.array(keep, pa.bool_())).select(["id", "text"])


def texts_of(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, compressed text) of the wanted ids. Both sides are dealt by id, whatever their sizes."""
    marks = wanted.select("id", F.lit(0).alias("kind"), F.lit(None).cast("binary").alias("text"))
    both = rows.filter("id IS NOT NULL").mapInArrow(packed_texts, MARKED).union(marks)
    both = both.repartition("id").sortWithinPartitions("id", "kind")
    return both.mapInArrow(only_wanted, "id long, text binary")


def compare(words: int, num: int, den: int):
    """From (a, salt, b, text) sorted so that the texts of a come first with a null b: similar pairs."""

    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        group, pivots, linked = None, [], []
        for batch in batches:
            for a, salt, b, text in zip(*(c.to_pylist() for c in batch.columns)):
                if (a, salt) != group:
                    group, pivots = (a, salt), []
                elements = shingle_set(unpack.decompress(text), words)
                if b is None:
                    pivots.append(elements)
                    continue
                for other in pivots:
                    shared = len(np.intersect1d(elements, other, assume_unique=True))
                    if den * shared >= num * (len(elements) + len(other) - shared):
                        linked.append((b, a))
                        break
            left, right = zip(*linked) if linked else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])
            linked = []

    return run


def verify(pairs: DataFrame, texts: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """Those of the pairs (a, b) whose texts are similar. A frequent b is split over several groups."""
    groups = pairs.groupBy("b").agg(F.ceil(F.count("*") / PIVOT_ROWS).cast("int").alias("salts"))
    dealt = pairs.join(groups, "b").withColumn("salt", F.pmod(F.xxhash64("a"), F.col("salts")).cast("int"))
    others = dealt.join(texts, F.col("a") == F.col("id")).select(
        F.col("b").alias("p"), "salt", F.col("a").alias("q"), "text"
    )
    pivots = groups.join(texts, F.col("b") == F.col("id")).select(
        F.col("b").alias("p"),
        F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
        F.lit(None).cast("long").alias("q"),
        "text",
    )
    rows = others.union(pivots).repartition("p", "salt").sortWithinPartitions("p", "salt", F.col("q").asc_nulls_first())
    return rows.mapInArrow(compare(words, num, den), "a long, b long")


def elements_of(words: int):
    """From (id, text): every shingle hash of it."""

    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for key, text in zip(*(c.to_pylist() for c in batch.columns)):
                e = shingle_set(unpack.decompress(text), words).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(e), pa.array(np.full(len(e), key))], ["e", "id"])

    return run


def shared_elements(batches):
    """From (e, id) sorted by e: (e, id, df) of the elements that several rows have.

    ``df`` is the number of rows, or OFTEN for more; it only has to be the same for all of them.
    So no more than that many rows of an element wait for it.
    """

    def rows(e, ids, df):
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (e, ids, df)], ["e", "id", "df"])

    empty = np.zeros(0, np.int64)
    e, ids, flowing = empty, empty, None
    for batch in batches:
        e = np.concatenate([e, batch.column(0).to_numpy()])
        ids = np.concatenate([ids, batch.column(1).to_numpy()])
        if flowing is not None:  # an element of which OFTEN rows have gone out
            n = int(np.searchsorted(e != flowing, True))
            yield rows(e[:n], ids[:n], np.full(n, OFTEN))
            e, ids = e[n:], ids[n:]
            flowing = flowing if not len(e) else None
        if not len(e):
            continue
        starts = _runs(e)
        lengths = np.diff(np.append(starts, len(e)))
        df = np.repeat(np.minimum(lengths, OFTEN), lengths)
        last = len(e) if lengths[-1] >= OFTEN else starts[-1]
        flowing = e[-1] if lengths[-1] >= OFTEN else None
        out = np.flatnonzero(df[:last] > 1)
        yield rows(e[out], ids[out], df[out])
        e, ids = e[last:], ids[last:]
    if len(e) > 1:
        yield rows(e, ids, np.full(len(e), len(e)))


def rare_pairs(members: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """Pairs of different components that share one of their rarest shingles, from the texts as ``version`` numbers.

    Similar sets of n elements share at least one of their first n - ceil(num * n / den) + 1 elements
    in any fixed order; rarest first leaves few of them shared. What follows the first shared one on
    either side bounds the intersection. So do the elements that no other member has, and the parities
    of the others: where these differ for a remainder, so do the sets. Prefixes that go on together from
    one element to the next are joined at the first. ``major`` marks the members of a group's largest
    component: of two components one is not the largest of the group.
    """
    sets = members.select("version", "text").distinct()
    rows = sets.toDF("id", "text").mapInArrow(elements_of(words), "e long, id long")
    rows = rows.repartition("e").sortWithinPartitions("e").mapInArrow(shared_elements, "e long, id long, df long")
    bits = [f"p{i}" for i in range(PARITIES)]
    parity = [F.expr(f"bit_xor(IF((e & {PARITIES - 1}) = {i}, shiftleft(1L, CAST((e >> 8) & 63 AS INT)), 0L))") for i in range(PARITIES)]
    found = rows.groupBy("id").agg(
        F.sort_array(F.collect_list(F.struct("df", "e"))).alias("found"), *(p.alias(b) for p, b in zip(parity, bits))
    )
    known = members.select("version", "id", "component", "major", "size").distinct()
    found = found.withColumnRenamed("id", "version")
    length = F.col("size") - F.ceil(F.col("size") * num / den) + 1
    room = (length - (F.col("size") - F.size("found"))).cast("int")
    first = F.slice("found.e", F.lit(1), room)
    before = F.concat(F.array(F.lit(None).cast("long")), F.slice("found.e", F.lit(1), room - 1))
    prefix = found.join(known, "version").filter(room > 0).select(
        "id",
        "component",
        "major",
        "size",
        *bits,
        F.size("found").alias("often"),
        F.posexplode(F.arrays_zip(first.alias("e"), before.alias("before"))).alias("place", "x"),
    )
    # elements from this one on, in the common order
    after = (F.col("often") - F.col("place")).alias("after")
    alone = (F.col("size") - F.col("often")).alias("alone")
    prefix = materialize(prefix.select("x.e", "x.before", "id", "component", "major", "size", *bits, alone, after), "jaccard-prefixes")
    differ = " + ".join(["m.alone", "o.alone", *(f"bit_count(m.{b} ^ o.{b})" for b in bits)])
    minor, similar = prefix.filter("NOT major").alias("m"), (
        f"m.e = o.e AND m.component <> o.component AND {den} * least(m.size, o.size) >= {num} * greatest(m.size, o.size)"
        f" AND {num + den} * least(m.after, o.after) >= {num} * (m.size + o.size)"
        " AND NOT coalesce(m.before = o.before, false)"
        f" AND {num + den} * ({differ}) <= {den - num} * (m.size + o.size)"
    )
    both = minor.join(prefix.alias("o"), F.expr(similar))
    return both.select(F.greatest("m.id", "o.id").alias("a"), F.least("m.id", "o.id").alias("b")).distinct()


def jaccard_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    num: int = NUM,
    den: int = DEN,
) -> DataFrame:
    """One row per input row: id, ``n_shingles`` and ``component_id``, the smallest id reachable by links.

    The set of a text are its distinct shingles of ``words`` words, of a shorter text the whole
    sequence. Two documents link when ``den * intersection >= num * union``. Null texts and texts
    without words have an empty set and link with nothing. Rows that share an id are versions of one
    document, which links when one of them does. A row without id links with nothing and has a
    null component. Shingles are compared by 64-bit hashes. Other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    signed = rows.mapInArrow(sign(words, num, den), TAGGED)
    signed = signed.repartition("key").sortWithinPartitions("kind", "key", "a")
    tagged = materialize(signed.mapInArrow(gather, TAGGED), "jaccard-pairs")
    known = tagged.filter(F.col("kind") == KNOWN).select("a", "b")
    sizes = tagged.filter(F.col("kind") == SIZE).select(F.col("a").alias("id"), F.col("b").alias("n_shingles"))
    pairs = tagged.filter(F.col("kind") < SIGNATURE).groupBy("a", "b")
    pairs = materialize(pairs.agg(F.sum("n").alias("shared"), F.min("kind").alias("kind")), "jaccard-candidates")
    wanted = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    texts = materialize(texts_of(rows, wanted), "jaccard-texts")

    place = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("shared"), "b"))
    left = materialize(pairs.select("a", "b", "kind", place.alias("place")), "jaccard-places")
    due = left.filter(F.col("place") <= ROUNDS[0]).select("a", "b")
    links = materialize(known.union(verify(due, texts, words, num, den)), "jaccard-links")
    found = materialize(connected_components(links), "jaccard-found")
    # a closed pair has no other to cover it
    rest = left.filter((F.col("place") > ROUNDS[0]) & ((F.col("kind") == CLOSED) | (F.col("place") <= ROUNDS[1])))
    due = materialize(between(rest, found).select("a", "b"), "jaccard-apart")
    found = joined_components(found, verify(due, texts, words, num, den))
    more = later_links(pairs.filter(F.col("kind") == OPEN), found, texts, sizes, words, num, den)
    found = joined_components(found, more)
    return sizes.join(found, F.col("id") == F.col("node"), "left").select(
        F.col("id").alias(id_col), "n_shingles", F.coalesce("component", "id").alias("component_id")
    )


def labelled(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs with the components ``ca`` and ``cb`` of both; a document without links is its own."""
    left = found.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    right = found.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    both = pairs.join(left, "a", "left").join(right, "b", "left")
    return both.withColumn("ca", F.coalesce("ca", "a")).withColumn("cb", F.coalesce("cb", "b"))


def between(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """The pairs of different components."""
    return labelled(pairs, found).filter("ca <> cb").select(*pairs.columns)


def joined_components(found: DataFrame, links: DataFrame) -> DataFrame:
    """Components after further links: those of the graph of components, which is small."""
    links = materialize(labelled(links, found), "jaccard-more-links")
    if links.isEmpty():
        return found
    ends = links.select(F.col("a").alias("node"), F.col("ca").alias("component"))
    ends = ends.union(links.select("b", "cb")).distinct()
    nodes = found.union(ends.join(found, "node", "left_anti"))
    joined = connected_components(links.select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    joined = joined.select(F.col("node").alias("component"), F.col("component").alias("new"))
    nodes = nodes.join(joined, "component", "left").select("node", F.coalesce("new", "component").alias("component"))
    return materialize(nodes, "jaccard-found")


def later_links(pairs: DataFrame, found: DataFrame, texts: DataFrame, sizes: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """Links between components of documents that share signatures, beyond those with the smallest documents."""
    groups = connected_components(pairs.select("a", "b"))
    member = groups.withColumnRenamed("component", "group").join(found, "node", "left").select(
        F.col("node").alias("id"), "group", F.coalesce("component", "node").alias("component")
    )
    counts = member.groupBy("group", "component").agg(F.count("*").alias("n"))
    split = counts.groupBy("group").agg(
        F.max(F.struct("n", "component")).alias("most"), F.count("*").alias("components")
    )
    split = split.filter("components > 1").select("group", F.col("most.component").alias("largest"))
    contested = member.join(split, "group").select(
        "id", "group", "component", (F.col("component") == F.col("largest")).alias("major")
    )
    size = sizes.groupBy("id").agg(F.max("n_shingles").alias("size"), F.count("*").alias("texts"))
    members = texts.join(contested.join(size, "id"), "id").withColumn("version", F.xxhash64("id", "text"))
    members = members.select("version", "id", "component", "major", "size", "texts", "text")
    members = materialize(members, "jaccard-contested")
    # each text of a document is a set of its own
    several = members.filter("texts > 1")
    own = several.select("version", "text").mapInArrow(set_sizes(words), "version long, size int").distinct()
    several = several.drop("size").join(own, "version").select(*members.columns)
    members = members.filter("texts = 1").union(several).drop("texts")
    return verify(rare_pairs(members, words, num, den), texts, words, num, den)


def set_sizes(words: int):
    """From (version, text): the size of its set."""

    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            sizes = [len(shingle_set(unpack.decompress(t), words)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int32())], ["version", "size"])

    return run


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read_table(spark, sf_dir, "documents"))


QUERIES = {"op10_ngram_jaccard_join": op10_ngram_jaccard_join}

ORACLE = {
    "op10_ngram_jaccard_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') IF x <> ''] AS words
  FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN []
           WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
           ELSE [array_to_string(words[i : i + 3], ' ') FOR i IN range(1, len(words) - 2)] END) AS shingles
  FROM w
), e AS MATERIALIZED (
  SELECT doc_id, len(shingles) AS n, hash(unnest(shingles)) AS h FROM s
), links AS MATERIALIZED (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM e a JOIN e b ON a.h = b.h AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM s
  UNION
  SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
), c AS (
  SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x
)
SELECT doc_id, len(shingles)::BIGINT AS n_shingles, component_id FROM s JOIN c USING (doc_id)
"""
}
