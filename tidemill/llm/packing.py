"""Best-fit packing under conflicts: no bin holds two pieces of one source or one duplicate cluster.

Documents of at least a bin's capacity fill whole bins; their remainders and the shorter
documents are packed, largest first, each into the tightest bin that is compatible. Bins are held
by residual; within a residual by the bitmap of their sources, so that a conflicting group is
skipped at once. Shards of a bounded number of pieces are packed independently of each other.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import SPACES, read_table, text_of, utf8
from tidemill.storage import materialize

CAPACITY = 2048
#: Pieces that a shard has on average. The last bins of a shard stay open, so few shards pack tighter.
SHARD_PIECES = 8192


class Bins:
    """Open bins by residual. ``levels`` has a bit for each residual that has bins."""

    def __init__(self, capacity: int):
        self.capacity, self.levels, self.count = capacity, 0, 0
        self.by_residual: dict[int, dict[int, list]] = {}  # residual: source bitmap: [(bin, cluster bitmap)]

    def take(self, size: int, source: int, cluster: int) -> tuple[int, int, int] | None:
        """The tightest compatible bin, taken out: (residual, source bitmap, index in its list)."""
        residual = size
        above = self.levels >> residual
        while above:
            residual += (above & -above).bit_length() - 1
            for sources, bins in self.by_residual[residual].items():
                if sources & source:
                    continue
                for i, (_, clusters) in enumerate(bins):
                    if not clusters & cluster:
                        return residual, sources, i
            residual += 1
            above = self.levels >> residual
        return None

    def put(self, size: int, source: int, cluster: int) -> int:
        """Places a piece; returns its bin."""
        found = self.take(size, source, cluster)
        if found is None:
            at, clusters, residual, sources = self.count, 0, self.capacity, 0
            self.count += 1
        else:
            residual, sources, i = found
            level = self.by_residual[residual]
            at, clusters = level[sources].pop(i)
            if not level[sources]:
                del level[sources]
            if not level:
                del self.by_residual[residual]
                self.levels &= ~(1 << residual)
        left = residual - size
        if left:
            self.by_residual.setdefault(left, {}).setdefault(sources | source, []).append((at, clusters | cluster))
            self.levels |= 1 << left
        return at


def pack_shard(pieces: pd.DataFrame, capacity: int) -> np.ndarray:
    """Bin of each piece. Pieces of a whole capacity get bins of their own."""
    order = pieces.sort_values(["n_words", "hash", "start"], ascending=[False, True, True], kind="stable")
    sources = pd.factorize(order["source"], use_na_sentinel=False)[0]
    often = order["cluster"].value_counts()
    shared = {c: i for i, c in enumerate(often.index[often > 1])}
    bits = [1 << shared[c] if c in shared else 0 for c in order["cluster"]]
    bins, placed = Bins(capacity), np.empty(len(order), np.int64)
    for i, (size, source, cluster) in enumerate(zip(order["n_words"].tolist(), sources.tolist(), bits)):
        placed[i] = bins.put(size, 1 << source, cluster)
    out = np.empty(len(order), np.int64)
    out[order.index.to_numpy()] = placed
    return out


def _measure(column: str):
    """Words of a text, and a hash of it without white space that copies share."""

    @F.pandas_udf("n long, cluster long")
    def measure(texts: pd.Series) -> pd.DataFrame:
        found = []
        for text in texts:
            data = utf8(text)
            digest = hashlib.blake2b(data.translate(None, SPACES), digest_size=8).digest()
            found.append((len(data.split()), int.from_bytes(digest, "big", signed=True)))
        return pd.DataFrame(found, columns=["n", "cluster"])

    return measure(F.col(column))


def pack(
    docs: DataFrame,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    cluster_col: str | None = None,
    shard_pieces: int = SHARD_PIECES,
) -> DataFrame:
    """One row per piece: id, ``source``, ``piece``, ``start``, ``n_words``, ``bin_id``, ``bin_fill``.

    Sizes are words. A document is cut into pieces of ``capacity`` words and a remainder; ``start``
    is the first word of the piece. Each word is in one piece, each piece in one bin, and
    ``bin_fill``, the words of the bin, is at most ``capacity``. A bin has at most one piece of a
    source and of a duplicate cluster (``cluster_col``, else texts that agree without white space).
    A document without words, or with a null text, has one row with 0 words and a null bin. A null
    source or cluster is a value like any other; repeated rows are separate documents. Other
    columns are ignored. No rows in, no rows out.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).cast("string").alias("source"),
        (F.xxhash64(cluster_col) if cluster_col else F.lit(None).cast("long")).alias("given"),
        text_of(text_col).alias("text"),
    )
    sizes = rows.select("id", "source", "given", _measure("text").alias("m"))
    sizes = sizes.select("id", "source", F.coalesce("given", "m.cluster").alias("cluster"), F.col("m.n").alias("words"))
    sizes = materialize(sizes.withColumn("hash", F.xxhash64("id", "cluster")), "pack-sizes")
    last = F.greatest(F.ceil(F.col("words") / capacity).cast("int") - 1, F.lit(0))
    pieces = sizes.withColumn("piece", F.explode(F.sequence(F.lit(0), last)))
    pieces = pieces.withColumn("start", F.col("piece").cast("long") * capacity)
    pieces = pieces.withColumn("n_words", F.least(F.col("words") - F.col("start"), F.lit(capacity)).cast("long"))
    shards = max(1, -(-(pieces.count()) // shard_pieces))
    # the row's own number spreads rows that agree in everything over the shards
    number = F.xxhash64("hash", "piece", F.monotonically_increasing_id())
    pieces = pieces.withColumn("shard", F.pmod(number, F.lit(shards)))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.reset_index(drop=True)
        filled = group[group["n_words"] > 0].reset_index(drop=True)
        if len(filled):
            at = pack_shard(filled, capacity)
            filled["bin_id"] = at + (int(filled["shard"].iloc[0]) << 32)
            filled["bin_fill"] = filled.groupby("bin_id")["n_words"].transform("sum")
        else:
            filled["bin_id"], filled["bin_fill"] = pd.Series(dtype="int64"), pd.Series(dtype="int64")
        empty = group[group["n_words"] == 0].assign(bin_id=None, bin_fill=None)
        names = ["id", "source", "piece", "start", "n_words", "bin_id", "bin_fill"]
        return pd.concat([filled[names].astype(object), empty[names].astype(object)])

    kind = sizes.schema["id"].dataType.simpleString()
    packed = pieces.groupBy("shard").applyInPandas(
        run, f"id {kind}, source string, piece int, start long, n_words long, bin_id long, bin_fill long"
    )
    return packed.withColumnRenamed("id", id_col)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"))


QUERIES = {"op3_best_fit_packing": op3_best_fit_packing}
ORACLE = {}
