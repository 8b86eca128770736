"""Which URLs are still to be worked on, from a table of what was done.

``processed`` holds ``(category, pos, url)`` of URLs whose work has begun, ``finished`` one ``category`` per row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cursors(processed: DataFrame) -> DataFrame:
    """Furthest position reached in each category."""
    return processed.groupBy("category").agg(F.max("pos").alias("cursor"))


def resume(urls: DataFrame, processed: DataFrame, redo_last: bool = True) -> DataFrame:
    """URLs from the furthest position of their category onwards.

    The URL at the cursor may have been cut off half-way and is worked on again; ``redo_last=False`` trusts it as done.
    """
    return resume_at(urls, cursors(processed), redo_last)


def resume_at(urls: DataFrame, cursors: DataFrame, redo_last: bool = True) -> DataFrame:
    """URLs from the ``cursor`` of their category onwards; all of a category that has none."""
    reached = cursors.withColumnRenamed("category", "__category")
    joined = urls.join(reached, F.col("category").eqNullSafe(F.col("__category")), "left")
    start = F.coalesce("cursor", F.lit(-1))
    keep = F.col("pos") >= start if redo_last else F.col("pos") > start
    return joined.where(keep).drop("__category", "cursor")


def unseen(urls: DataFrame, processed: DataFrame) -> DataFrame:
    """URLs never begun, whatever their position: for lists that grow out of order."""
    return urls.join(processed.select("category", "url"), ["category", "url"], "left_anti")


def unfinished(urls: DataFrame, finished: DataFrame) -> DataFrame:
    """URLs of categories that are not finished."""
    return urls.join(finished.select("category"), "category", "left_anti")


def distinct_records(records: DataFrame) -> DataFrame:
    """One record per URL and option choice: undoes what a redone URL wrote twice.

    Of a stream, those seen in earlier batches go as well: what was seen is the stream's state.
    """
    choices = F.array_sort(F.map_entries("attrs"))  # whatever the order of the map
    keyed = records.withColumn("__attrs", F.to_json(choices, {"ignoreNullFields": "false"}))
    return keyed.dropDuplicates(["url", "__attrs"]).drop("__attrs")
