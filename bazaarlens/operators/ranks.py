"""Values numbered by how often they come up, for any number of values: nothing is gathered on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlens.session import written

# The most frequent values, which are joined by broadcast: so many rows at most, whatever the number of values.
HOT_VALUES = 10_000


def frequency_ranks(values: DataFrame, column: str, times: str | None = None) -> DataFrame:
    """``(value, n, rank)``, a row for each distinct value that is not null: the most frequent has rank 0, and equal counts go
    by the value. A row stands for as many values as ``times`` says, one if no such column is named.

    Counts are dealt out by ranges of (count, value). Ranks inside a range are added to the number of values in the ranges
    before it, of which there is one row each.
    """
    found = F.sum(times) if times else F.count("*")
    counted = values.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(found.alias("n"))
    order = [F.col("n").desc(), F.col("value")]
    dealt = written(counted.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()), "counted-values")
    ahead = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy("__range").agg(F.count("*").alias("__values"))
    starts = sizes.select("__range", F.coalesce(F.sum("__values").over(ahead), F.lit(0)).alias("__start"))
    within = Window.partitionBy("__range").orderBy(*order)
    ranked = dealt.withColumn("__nth", F.row_number().over(within) - 1).join(starts, "__range")
    return ranked.select("value", "n", (F.col("__start") + F.col("__nth")).alias("rank"))


def with_rank(rows: DataFrame, ranks: DataFrame, column: str, output: str, hot_values: int = HOT_VALUES) -> DataFrame:
    """Adds the rank of ``column`` to the rows that have a known value; others are left out.

    Rows with one of the most frequent values meet a broadcast of those. Any other value has so few rows that the shuffle of
    the rest cannot be skewed. ``ranks`` and ``rows`` should be written tables: both are read twice.
    """
    known = ranks.select(F.col("value").alias("__value"), F.col("rank").alias(output))
    hot, rest = known.where(F.col(output) < hot_values), known.where(F.col(output) >= hot_values)
    names = [*[c for c in rows.columns if c != output], output]
    kept = rows.drop(output)
    common = kept.join(F.broadcast(hot), F.col(column) == F.col("__value"))
    # The anti join takes the rows with hot values out before the shuffle.
    rare = kept.join(F.broadcast(hot.select("__value")), F.col(column) == F.col("__value"), "left_anti")
    rare = rare.join(rest, F.col(column) == F.col("__value"))
    return common.select(*names).unionByName(rare.select(*names))


def index_labels(rows: DataFrame, columns: tuple[str, ...], fitted_on: DataFrame | None = None) -> DataFrame:
    """Adds ``<column>_index``, the frequency rank of each label as a double, and drops rows with a null or unknown label: what
    ``StringIndexer`` does, for more labels than an array on the driver holds."""
    out = rows
    for name in columns:
        index = f"{name}_index"
        ranks = written(frequency_ranks(fitted_on if fitted_on is not None else rows, name), "label-ranks")
        out = with_rank(out, ranks, name, index).withColumn(index, F.col(index).cast("double"))
    return out


def one_hot_place(index: Column, labels: int) -> Column:
    """Where the one of an encoded label stands; null for the last label, which is encoded as zeros."""
    return F.when(index < labels - 1, index.cast("int"))
