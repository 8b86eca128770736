"""Helpers the operators share: tables in the shared folder, size checks, words, and prefix sums without a large window."""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bazaarlens.session import scratch_path

# What separates words; fixed by the contracts.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
# Rows of whole texts that Spark hands to a worker at once where several operators share executors; Spark's own 10,000 are
# some 26 MB, in buffers twice as large on either side.
BATCH_ROWS = 1_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """The rows as a written table in the shared folder, so a lost executor means reading again, not working it out again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> Iterator[None]:
    """Arrow batches of at most so many rows for what runs inside; what is lazy must be saved there. No effect on results."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = int(spark.conf.get(name))
    spark.conf.set(name, min(rows, before) if before > 0 else rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def small_or_shuffled(df: DataFrame, most_rows: int) -> DataFrame:
    """A saved table, marked for broadcast if it has at most ``most_rows`` rows; a plain join side otherwise."""
    return F.broadcast(df) if df.count() <= most_rows else df


def root(n: int) -> int:
    return max(1, math.isqrt(max(0, n - 1)) + 1)


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def place_of(key: Column) -> Column:
    """The first 32 bits of the MD5 of a key, an order that has nothing to do with the key's own."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 8), 16, 10).cast("bigint")


def running(rows: DataFrame, groups: list[str], bucket: str, order: list[Column], value: Column, name: str) -> DataFrame:
    """Adds the sum of ``value`` over the rows ahead in the same group.

    ``bucket`` must follow the order: it cuts each group into parts, so that no task sorts a whole group. Parts are summed
    first, then only one narrow row for each part meets the others of its group. Groups may not be null.
    """
    keys = [*groups, bucket]
    until = (Window.unboundedPreceding, -1)
    sums = rows.groupBy(*keys).agg(F.sum(value).alias("__sum"))
    parts = Window.partitionBy(*groups).orderBy(bucket).rowsBetween(*until)
    before = sums.select(*keys, F.coalesce(F.sum("__sum").over(parts), F.lit(0)).alias("__before"))
    within = Window.partitionBy(*keys).orderBy(*order).rowsBetween(*until)
    return (
        rows.withColumn("__within", F.coalesce(F.sum(value).over(within), F.lit(0)))
        .join(before, keys)
        .withColumn(name, F.col("__before") + F.col("__within"))
        .drop("__before", "__within")
    )
