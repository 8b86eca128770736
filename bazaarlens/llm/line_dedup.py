"""Removing lines that many sites share, by sketches of the sites each line is found on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.llm.base import SPACES, saved, small_or_shuffled, text_of

MIN_SITES = 5
# Bits of the sketch's table size; its error is about 1.04 divided by the root of that size.
SKETCH_BITS = 10
MOST_BROADCAST_LINES, MOST_BROADCAST_DOCS = 200_000, 200_000
# Places of lines that may go along with those documents: 4 bytes each.
MOST_BROADCAST_PLACES = 2_000_000


def _line(column: str) -> Column:
    return F.btrim(column, F.lit(SPACES))


def _lines(docs: DataFrame, text: str) -> DataFrame:
    """One row for each line that holds a letter or digit, by its hash."""
    every = docs.select("*", F.posexplode(F.split(text_of(text), "\n")).alias("pos", "line")).drop(text)
    return every.filter(F.col("line").rlike(r"[\p{L}\p{N}]")).withColumn("line", F.md5(_line("line")))


def boilerplate(docs: DataFrame, text: str = "text", site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """``(line, sites, exact)``: hashes of the lines found on ``min_sites`` sites or more.

    A HyperLogLog sketch of the sites of each line is built before the shuffle and merged after it. Lines whose estimate
    is within three standard errors of the limit, or within one, are counted exactly; only these are read again.
    """
    sites = _lines(docs.select(F.coalesce(F.col(site), F.lit("")).alias("site"), text), text).select("line", "site")
    error = max(1.0, 3 * 1.04 / 2 ** (SKETCH_BITS / 2) * min_sites)
    spread = sites.groupBy("line").agg(F.hll_sketch_agg("site", F.lit(SKETCH_BITS)).alias("sketch"))
    spread = spread.select("line", F.hll_sketch_estimate("sketch").alias("sites"))
    spread = saved(spread.filter(F.col("sites") >= min_sites - error), "line-sites")
    near = small_or_shuffled(
        saved(spread.filter(F.col("sites") <= min_sites + error).select("line"), "near-lines"), MOST_BROADCAST_LINES
    )
    exact = sites.join(near, "line", "left_semi").distinct().groupBy("line").agg(F.count("*").alias("sites"))
    sure = spread.filter(F.col("sites") > min_sites + error)
    return sure.withColumn("exact", F.lit(False)).unionByName(
        exact.filter(F.col("sites") >= min_sites).withColumn("exact", F.lit(True))
    )


def drop_boilerplate(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", site: str = "source", min_sites: int = MIN_SITES
) -> DataFrame:
    """The rows with boilerplate lines taken out of ``text``, and ``n_lines`` and ``n_removed``, which replace columns of
    that name.

    Lines are told apart without the white space around them, and only those with a letter or digit count. A null site is
    a site of its own. A null text stays null, with no lines; an empty text has one empty line. Repeated rows are treated
    alike. The lines themselves are never shuffled, only their hashes; the text is moved only where more than
    ``MOST_BROADCAST_DOCS`` rows lose lines, or more than ``MOST_BROADCAST_PLACES`` lines go.
    """
    docs = docs.drop("n_lines", "n_removed")
    found = small_or_shuffled(
        saved(boilerplate(docs, text, site, min_sites).select("line"), "boilerplate"), MOST_BROADCAST_LINES
    )
    # Which lines go follows from the text, so equal rows may share a key.
    key = F.md5(F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(" "), text_of(text)))
    hit = _lines(docs.select(key.alias("__key"), text), text).join(found, "line", "left_semi")
    hits = saved(hit.groupBy("__key").agg(F.collect_set("pos").alias("__drop")), "boilerplate-places")
    n, places = hits.agg(F.count("*"), F.coalesce(F.sum(F.size("__drop")), F.lit(0))).head()
    small = n <= MOST_BROADCAST_DOCS and places <= MOST_BROADCAST_PLACES
    joined = docs.withColumn("__key", key).join(F.broadcast(hits) if small else hits, "__key", "left")
    lines = F.split(F.col(text), "\n")
    rest = F.filter("__lines", lambda line, i: ~F.array_contains("__drop", i))
    return (
        joined.withColumn("__lines", lines)
        .withColumn(text, F.when(F.col("__drop").isNull(), F.col(text)).otherwise(F.concat_ws("\n", rest)))
        .withColumn("n_lines", F.coalesce(F.size("__lines"), F.lit(0)).cast("bigint"))
        .withColumn("n_removed", F.when(F.col("__drop").isNull(), F.lit(0)).otherwise(F.size("__drop")).cast("bigint"))
        .select(*docs.columns, "n_lines", "n_removed")
    )
