"""Documents to training sequences: each stage is written as a table before the next one reads it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlens.llm import classifier, exact_dedup, mixing, near_dup, packing
from bazaarlens.llm.base import saved, small_batches, small_or_shuffled, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

MOST_BROADCAST = 200_000
# Workers serve all stages in turn, so packing remembers fewer pieces of text than on its own.
REMEMBERED = 1 << 16


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    with small_batches(spark):
        model = classifier.train(docs, table(spark, sf_dir, "labels"))
        scored = classifier.score(docs, model, name="__score")
        return saved(scored.filter(F.col("__score") >= classifier.THRESHOLD).select(*docs.columns), "good-documents")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with the same text."""
    return exact_dedup.exact_dedup(docs).filter("kept").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, the one with the smallest id. Documents without an id stay; rows that share an
    id stay or go together."""
    with small_batches(spark):
        found = near_dup.near_duplicates(docs)
    gone = saved(found.filter("doc_id <> class_id").select("doc_id").distinct(), "near-copies")
    return docs.join(small_or_shuffled(gone, MOST_BROADCAST), "doc_id", "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, rounded to whole documents: at most one document of a source is taken in
    part. Documents without words are not taken."""
    taken = mixing.words_taken(mixing.mix(docs).pieces).groupBy(F.col("doc_id").alias("__id"))
    times = taken.agg(F.round(F.sum("taken") / F.sum("size")).cast("int").alias("__times")).filter("__times > 0")
    times = small_or_shuffled(saved(times, "mix-times"), MOST_BROADCAST)
    repeated = docs.join(times, F.col("doc_id").eqNullSafe(F.col("__id")))
    return repeated.withColumn("__n", F.explode(F.sequence(F.lit(1), "__times"))).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    with small_batches(spark):
        return packing.packed_documents(docs, remembered=REMEMBERED)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", keep_good),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources", mix_sources),
    ("best-fit packing", pack_sequences),
]

# SQL can express neither a trained classifier nor a similarity join.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
