"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Every source is cut into blocks by a hash of the document id. A source's quota, in blocks, is
its whole blocks as often as the target holds its size, plus as many permuted blocks as the rest
holds. A tree splits the quotas exactly: each node draws the share of its left half from the
multivariate hypergeometric distribution. A shard takes the next run of each source's permuted
blocks, so shards are disjoint, and its rows are shuffled by hash. Blocks that
do not fit the rest are resolved by documents.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import count_words, read_table, text_of
from tidemill.storage import broadcast_if_small, materialize

SEED = 20240229
WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
CAP = 2.0
#: A source has at most this many blocks, all sources together at most MAX_BLOCKS: the block table is
#: the only thing that the driver and broadcasts hold, whatever the number of documents.
SOURCE_BLOCKS = 4096
MAX_BLOCKS = 1 << 18
#: Documents that a block has on average at least; few per block would leave the last one too coarse.
BLOCK_DOCS = 64
#: Blocks are cut until they have so many documents.
CUT_DOCS = 1024
SHARD_WORDS = 4_000_000
#: Changes of one or two items after the first fit.
EXCHANGES = 16


def targets(sizes: list[int], weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> np.ndarray:
    """Each source's target: ``share`` of all sizes by weight, at most ``cap`` times its size.

    What a stopped source leaves is shared again by weight among the others, until none is above.
    """
    size = np.array(sizes, np.float64)
    weight = np.resize(np.array(weights, np.float64), len(size))
    free, out, rest = np.ones(len(size), bool), np.zeros(len(size)), share * size.sum()
    while free.any():
        part = rest * weight / weight[free].sum()
        above = free & (part > cap * size)
        if not above.any():
            out[free] = part[free]
            break
        out[above] = cap * size[above]
        rest -= out[above].sum()
        free &= ~above
    return out


def split_quotas(quotas: np.ndarray, shards: int, rng: np.random.Generator) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each shard the sources and how many of their blocks it gets. A source's counts add up to its quota.

    A node of the tree holds only the sources that have blocks below it.
    """

    def split(sources: np.ndarray, left: np.ndarray, n: int) -> None:
        if n == 1:
            out.append((sources, left))
            return
        first, total = n // 2, int(left.sum())
        taken = rng.multivariate_hypergeometric(left, round(total * first / n), method="marginals") if total else left
        for own, parts in ((taken, first), (left - taken, n - first)):
            split(sources[own > 0], own[own > 0], parts)

    out: list[tuple[np.ndarray, np.ndarray]] = []
    split(np.arange(len(quotas))[quotas > 0], quotas[quotas > 0], shards)
    return out


def fill(sizes: np.ndarray, room: float) -> np.ndarray:
    """Which items to take so that their sum comes near ``room``.

    Each item that still fits is taken, in order. Then, while it comes nearer, one item is added, left out, or
    exchanged for another: the best such change each time.
    """
    taken, left = np.zeros(len(sizes), bool), room
    for i, size in enumerate(sizes.tolist()):
        if size <= left:
            taken[i] = True
            left -= size
    for _ in range(EXCHANGES):
        # what goes out (0: nothing) and what comes in (0: nothing), both by size
        outs, ins = (np.append(-1, own[np.argsort(sizes[own], kind="stable")]) for own in (np.flatnonzero(taken), np.flatnonzero(~taken)))
        gone, come = (np.where(own < 0, 0, sizes[own]) if len(sizes) else np.zeros(1) for own in (outs, ins))
        at = np.searchsorted(come, gone + left)
        best = abs(left), -1, -1
        for near in (np.maximum(at - 1, 0), np.minimum(at, len(come) - 1)):
            off = np.abs(left + gone - come[near])
            i = int(off.argmin())
            if off[i] < best[0]:
                best = off[i], i, int(near[i])
        _, i, j = best
        if i < 0:
            break
        left += gone[i] - come[j]
        if outs[i] >= 0:
            taken[outs[i]] = False
        if ins[j] >= 0:
            taken[ins[j]] = True
    return taken | (sizes == 0)


def part(order: np.ndarray, words: np.ndarray, docs: np.ndarray, rest: float) -> tuple[np.ndarray, np.ndarray, float]:
    """Of permuted blocks: those taken whole, those whose documents resolve what is left, and that.

    A block that does not fit is passed over for later ones that do. What is left is taken from the
    first of those passed over, and from more while they have few documents.
    """
    whole, cut, left, held = [], [], rest, 0
    for block in order.tolist():
        if words[block] <= left:
            whole.append(block)
            left -= words[block]
        elif held < CUT_DOCS:
            cut.append(block)
            held += docs[block]
    return np.array(whole, order.dtype), np.array(cut if left > 0 else [], order.dtype), left


def plan(blocks: pd.DataFrame, weights, share: float, cap: float, seed: int) -> tuple[pd.DataFrame, pd.DataFrame]:
    """From (source, block, words, docs): the sources' table and every draw of a block.

    A draw is (source, block, shift, repeat, shard, rest); rest is null for a whole block, else the
    words still to be taken from it. ``block`` counts coarse blocks, ``shift`` merges fine ones.
    """
    names = sorted((s for s in blocks["source"].unique() if s is not None), key=lambda s: s)
    if not names and not len(blocks):
        return pd.DataFrame({"source": [], "source_size": [], "target": []}), pd.DataFrame()
    names += [None] if blocks["source"].isna().any() else []
    place = {s: i for i, s in enumerate(names)}
    at = np.array([place[s] for s in blocks["source"]], np.int64)
    by_source = [blocks.iloc[rows] for rows in np.split(np.argsort(at, kind="stable"), np.cumsum(np.bincount(at))[:-1])]
    sizes = [int(b["words"].sum()) for b in by_source]
    goal = targets(sizes, weights, share, cap)
    table = pd.DataFrame({"source": pd.Series(names, dtype=object), "source_size": sizes, "target": goal})
    fine = 1 << int(blocks.attrs["bits"])
    rng, drawn, quotas = np.random.default_rng(seed), [], []
    for i, (own, size, want) in enumerate(zip(by_source, sizes, goal)):
        coarse = 1 << max(0, int(math.log2(max(1, own["docs"].sum() / BLOCK_DOCS))))
        shift = int(math.log2(fine // min(fine, coarse)))
        words = np.bincount(own["block"].to_numpy() >> shift, own["words"].to_numpy(), minlength=fine >> shift)
        docs = np.bincount(own["block"].to_numpy() >> shift, own["docs"].to_numpy(), minlength=fine >> shift)
        full = int(want // size) if size else 1  # a source without words goes through as it is
        rest, at = (want - full * size if size else 0.0), 0
        for repeat in range(full + 1):
            order = rng.permutation(len(words))
            left, cut = None, order[:0]
            if repeat == full:
                order, cut, left = part(order, words, docs, rest)
            drawn.append((i, shift, repeat, order, at, None))
            at += len(order)
            if len(cut):
                drawn.append((i, shift, repeat, cut, at, left))
                at += len(cut)
        quotas.append(at)
    # a shard has a block at least
    shards = max(1, min(sum(quotas), math.ceil(sum(goal) / SHARD_WORDS)))
    shares = split_quotas(np.array(quotas, np.int64), shards, rng)
    of = np.concatenate([own for own, _ in shares])
    shard_of = np.repeat(np.arange(shards), [len(own) for own, _ in shares])
    many = np.concatenate([n for _, n in shares])
    order_of = np.argsort(of, kind="stable")
    starts = np.searchsorted(of[order_of], np.arange(len(quotas) + 1))
    own_shards = [np.repeat(shard_of[rows], many[rows]) for rows in (order_of[a:b] for a, b in zip(starts, starts[1:]))]
    draws = []
    for i, shift, repeat, order, at, left in drawn:
        shard = own_shards[i][at : at + len(order)]
        draws.append(
            pd.DataFrame(
                {"at": i, "block": order, "shift": shift, "repeat": repeat, "shard": shard,
                 "rest": np.nan if left is None else left}
            )
        )
    return table, pd.concat(draws) if draws else pd.DataFrame()


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
    seed: int = SEED,
) -> tuple[DataFrame, DataFrame]:
    """The documents with what the mix takes of them, and the mix itself.

    The first frame has one row per input row: id, ``size`` (words), ``source``, ``source_size``,
    ``target``, ``times`` and ``taken``. The second has one row per time a document is taken:
    id, ``source``, ``repeat``, ``shard`` and ``place``, the order inside the shard. ``weights`` go to the
    sources in code point order, null last, over and over.

    Null texts have size 0; documents without words are taken whenever their block is. Rows of a
    source that share an id are taken together; in different sources they are different documents. A null id is an id like any other. Other columns are ignored.
    An empty table gives empty frames. The result depends on the rows and ``seed`` alone.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), text_of(text_col).alias("text")
    )
    sized = materialize(
        rows.select("id", "source", count_words("text").alias("size"), F.xxhash64("id", F.lit(seed)).alias("hash")),
        "mix-sizes",
    )
    n_sources = sized.select("source").distinct().count()
    if not n_sources:
        return _empty(sized, id_col)
    bits = max(0, min(int(math.log2(SOURCE_BLOCKS)), int(math.log2(max(1, MAX_BLOCKS // n_sources)))))
    block = F.shiftright(F.shiftrightunsigned("hash", 1), 63 - bits).cast("int") if bits else F.lit(0)
    sized = sized.withColumn("fine", block)
    blocks = sized.groupBy("source", F.col("fine").alias("block")).agg(
        F.sum("size").alias("words"), F.count("*").alias("docs")
    )
    blocks = blocks.toPandas()
    blocks["source"] = blocks["source"].astype(object).where(blocks["source"].notna(), None)
    blocks = blocks.sort_values(["source", "block"], ignore_index=True)
    blocks.attrs["bits"] = bits
    table, draws = plan(blocks, weights, share, cap, seed)
    table["shift"] = draws.groupby("at")["shift"].first() if len(draws) else 0
    facts = [
        (s, int(n), float(t), int(h)) for s, n, t, h in zip(*(table[c] for c in ("source", "source_size", "target", "shift")))
    ]
    sources = spark.createDataFrame(facts, "source string, source_size long, target double, shift int")
    names = list(table["source"])
    listed = [
        (names[a], int(b), int(r), int(s), None if np.isnan(w) else float(w))
        for a, b, r, s, w in zip(*(draws[c] for c in ("at", "block", "repeat", "shard", "rest")))
    ]
    drawn = spark.createDataFrame(listed, "source string, block int, repeat int, shard int, rest double")
    sources = broadcast_if_small(materialize(sources, "mix-sources"))
    drawn = broadcast_if_small(materialize(drawn, "mix-draws"))
    known = sized.alias("d").join(sources.alias("s"), F.expr("d.source <=> s.source"))
    known = known.select(
        "id", "d.source", "size", "hash", "source_size", "target", F.expr("shiftright(fine, shift)").alias("block")
    )
    taken = known.alias("d").join(drawn.alias("b"), F.expr("d.source <=> b.source AND d.block = b.block"))
    taken = taken.select("id", "d.source", "size", "hash", "repeat", "shard", "rest")
    whole = taken.filter("rest IS NULL").select("id", "source", "repeat", "shard")
    cut = taken.filter("rest IS NOT NULL").groupBy("source", "id", "hash", "repeat", "shard", "rest")
    cut = cut.agg(F.sum("size").alias("size"), F.count("*").alias("rows"))

    def resolve(group: pd.DataFrame) -> pd.DataFrame:
        order = group.sort_values(["hash", "id"], ignore_index=True)
        return order[fill(order["size"].to_numpy(), float(order["rest"].iloc[0]))][["id", "source", "repeat", "shard"]]

    kind = sized.schema["id"].dataType.simpleString()
    partly = cut.groupBy("source").applyInPandas(resolve, f"id {kind}, source string, repeat int, shard int")
    partly = materialize(partly, "mix-cut")
    both = whole.groupBy("id", "source").agg(F.countDistinct("repeat").alias("times"))
    both = both.unionByName(partly.groupBy("id", "source").agg(F.count("*").alias("times")))
    times = both.groupBy("id", "source").agg(F.sum("times").alias("times"))
    left, right = known.alias("d"), times.alias("t")
    report = left.join(right, F.expr("d.id <=> t.id AND d.source <=> t.source"), "left").select(
        F.col("d.id").alias(id_col),
        "size",
        "d.source",
        "source_size",
        "target",
        F.coalesce("times", F.lit(0)).alias("times"),
        (F.col("size") * F.coalesce("times", F.lit(0))).alias("taken"),
    )
    mixed = whole.distinct().unionByName(partly)
    mixed = mixed.withColumn("place", F.xxhash64("id", "source", "repeat", F.lit(seed + 1)))
    return report, mixed.withColumnRenamed("id", id_col)


def _empty(sized: DataFrame, id_col: str) -> tuple[DataFrame, DataFrame]:
    report = sized.selectExpr(
        f"id AS `{id_col}`", "size", "source", "0L AS source_size", "0D AS target", "0L AS times", "0L AS taken"
    )
    return report, sized.selectExpr(f"id AS `{id_col}`", "source", "0 AS repeat", "0 AS shard", "hash AS place")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, by shard and shuffled inside each."""
    _, mixed = mix(docs, **options)
    id_col, source_col = options.get("id_col", "doc_id"), options.get("source_col", "source")
    side = mixed.select(
        F.col(id_col).alias("_mix_id"), F.col("source").alias("_mix_source"), F.struct("shard", "place").alias("_mix")
    )
    same = F.col(id_col).eqNullSafe(F.col("_mix_id")) & F.col(source_col).cast("string").eqNullSafe(F.col("_mix_source"))
    rows = docs.join(side, same)
    rows = rows.repartition(F.col("_mix.shard")).sortWithinPartitions("_mix.shard", "_mix.place")
    return rows.select(*(F.col(f"`{c}`") for c in docs.columns))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    report, _ = mix(read_table(spark, sf_dir, "documents"))
    return report


QUERIES = {"op9_mixing": op9_mixing}
ORACLE = {}
