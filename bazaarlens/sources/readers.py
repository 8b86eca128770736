"""Readers for seeds, URL lists, raw listings and the model table. Every schema is given, none inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlens.schemas import LISTINGS, MODEL_CSV, SEED
from bazaarlens.sources.csv_records import read_csv_records

_BLANKS = " \t\r\n"


def spread(scan: DataFrame) -> DataFrame:
    """Rows of a plain file scan over all cores when its files split into fewer pieces, as one small or compressed file
    does. A scan that already has a piece per core stays as it is, without a shuffle."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def read_model_csv(spark: SparkSession, path: str) -> DataFrame:
    """Headered CSV of the model table, all text; quoted fields may hold line breaks and doubled quotes. Large files are read in
    splits."""
    return read_csv_records(spark, path, MODEL_CSV)


def read_listings(spark: SparkSession, path: str, site: str, partitioned: bool = False) -> DataFrame:
    """Raw listings as NDJSON; ``partitioned`` takes ``category`` from the folder names, as text.

    On site B a description reading ``None`` is a missing one.
    """
    schema = LISTINGS[site]
    if partitioned and "category" not in schema.names:
        schema = T.StructType([*schema.fields, T.StructField("category", T.StringType())])
    return fix_missing(spark.read.schema(schema).json(path), site)


def stream_listings(
    spark: SparkSession, path: str, site: str, files_per_batch: int | None = None, bytes_per_batch: int | None = None
) -> DataFrame:
    """Raw listings as a stream over the files of a folder."""
    reader = spark.readStream.schema(LISTINGS[site])
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if bytes_per_batch:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    return fix_missing(reader.json(path), site)


def fix_missing(records: DataFrame, site: str) -> DataFrame:
    if site != "b":
        return records
    return records.withColumn("product_desc", F.nullif("product_desc", F.lit("None")))


def read_seeds(spark: SparkSession, root: str, levels: int, file_name: str = "base_url.txt") -> DataFrame:
    """Category seeds: one JSON object per file, a fixed number of folders below the root."""
    pattern = "/".join([root.rstrip("/"), *["*"] * levels, file_name])
    return spark.read.schema(SEED).option("multiLine", True).json(pattern)


def _folder_name(path: Column) -> Column:
    """Name of the folder a file lies in; paths come percent-encoded, with ``+`` standing for itself."""
    name = F.regexp_extract(path, "([^/]+)/[^/]+$", 1)
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


def read_urls(spark: SparkSession, pattern: str) -> DataFrame:
    """URL lists, one folder per category, as ``(category, pos, url)`` with the line number as ``pos``.

    A folder may hold its list in several files, taken in name order. A list may be large, so lines are numbered within
    the blocks the files are read in, and each block starts from the line count of those before it.
    """
    lines = spark.read.text(pattern).select(
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__order"),
        F.btrim("value", F.lit(_BLANKS)).alias("url"),
    )
    sizes = lines.groupBy("__file", "__block").agg(F.count("*").alias("__lines"))
    folder = F.regexp_extract("__file", "^(.*)/", 1)
    ahead = Window.partitionBy(folder).orderBy("__file", "__block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__file", "__block", F.coalesce(F.sum("__lines").over(ahead), F.lit(0)).alias("__start"))
    within = Window.partitionBy("__file", "__block").orderBy("__order")
    return (
        lines.withColumn("__line", F.row_number().over(within) - 1)
        .join(starts, ["__file", "__block"])
        .select(
            _folder_name(F.col("__file")).alias("category"),
            (F.col("__start") + F.col("__line")).cast("int").alias("pos"),
            "url",
        )
    )


def read_url_table(spark: SparkSession, path: str) -> DataFrame:
    """URL lists as written by ``sources.writers.append_urls``: partitioned text, category kept as text."""
    return spark.read.schema("value string, category string").text(path).select(
        "category", F.btrim("value", F.lit(_BLANKS)).alias("url")
    )
