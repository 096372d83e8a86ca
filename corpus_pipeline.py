"""The corpus pipeline: from ``documents`` to packed bins.

Toxic documents go, copies go, one document of each near-duplicate group stays, sources are mixed
to their weights, and what is taken is packed. Every stage gets what its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import read_table
from tidemill.llm.exact_dedup import exact_dedup
from tidemill.llm.mixing import mixed_documents
from tidemill.llm.ngram_join import jaccard_components
from tidemill.llm.packing import pack
from tidemill.llm.toxicity import score, train
from tidemill.storage import materialize

ROW = "__pipeline_row"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score under 0.5, by a model fitted on the labelled ones among them."""
    model = train(docs, read_table(spark, sf_dir, "labels"))
    return docs.filter(score(model) < 0.5)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts. Rows are told apart by a number that is written once.

    Made anew by each scan, the number would change with the splits, which follow the cores there are.
    """
    rows = materialize(docs.withColumn(ROW, F.monotonically_increasing_id()), "pipeline-rows")
    kept = exact_dedup(rows, row_col=ROW).filter("kept").select(ROW)
    return rows.join(kept, ROW, "left_semi").drop(ROW)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component of links; documents without id stay.

    Links follow op10's contract, 4 words and a similarity of 0.85.
    """
    found = jaccard_components(docs)
    kept = found.filter("doc_id = component_id").select(F.col("doc_id").alias(ROW)).distinct()
    stays = docs.filter("doc_id IS NOT NULL").join(kept, F.col("doc_id") == F.col(ROW), "left_semi")
    return stays.unionByName(docs.filter("doc_id IS NULL"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixed_documents(docs)


def pack_bins(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the mixed documents with their bins."""
    return pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("mixing", mix_sources),
    ("best_fit_packing", pack_bins),
]

#: The learned scores and the random draws have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
