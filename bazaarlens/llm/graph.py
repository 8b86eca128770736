"""Connected components of large graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens.llm.base import saved

SALTS = 32


def _relabelled(labels: DataFrame, table: DataFrame) -> DataFrame:
    """``(node, label)`` with labels replaced by what ``table`` has for them. A label that very many nodes share is looked up
    in ``SALTS`` parts."""
    salted = table.select(
        F.col("node").alias("__old"),
        F.col("label").alias("__new"),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__salt"),
    )
    salt = F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")
    joined = labels.withColumn("__part", salt).join(
        salted, (F.col("label") == F.col("__old")) & (F.col("__part") == F.col("__salt")), "left"
    )
    return joined.select("node", F.col("label").alias("old"), F.coalesce("__new", "label").alias("label"))


def _rooted(labels: DataFrame) -> DataFrame:
    """Labels followed to their ends, in steps that double."""
    while True:
        heads = labels.join(labels.select(F.col("label").alias("node")).distinct(), "node", "left_semi")
        further = saved(_relabelled(labels, heads), "labels")
        labels = further.select("node", "label")
        if not further.filter("old <> label").limit(1).count():
            return labels


def components(edges: DataFrame) -> DataFrame:
    """``(node, label)`` for the nodes of ``(a, b)``: the smallest node that edges lead to. Edges of a node with itself are
    left out.

    Each round joins every node with its smallest neighbour, and all that this leads to, and goes on with the edges between
    what is left, so edges inside a joined group are gone after the first rounds. Rounds are written to the shared folder.
    """
    links = edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    links, labels = saved(links.distinct(), "links"), None
    while labels is None or links.limit(1).count():
        ends = links.select(F.col("a").alias("node"), F.col("b").alias("near")).unionByName(
            links.select(F.col("b").alias("node"), F.col("a").alias("near"))
        )
        lowest = ends.groupBy("node").agg(F.min("near").alias("near"))
        lowest = saved(lowest.select("node", F.least("node", "near").alias("label")), "lowest")
        step = _rooted(lowest)
        labels = step if labels is None else saved(_relabelled(labels, step).drop("old"), "labels")
        one, other = (step.select(F.col("node").alias(c), F.col("label").alias(f"__{c}")) for c in ("a", "b"))
        between = links.join(one, "a").join(other, "b").filter("__a <> __b")
        links = saved(between.select(F.least("__a", "__b").alias("a"), F.greatest("__a", "__b").alias("b")).distinct(), "links")
    return labels
