"""Writers for raw listings and URL lists, partitioned by category.

The rebalance hint sizes the output files: small categories share a task, and a large one is spread over several.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def append_listings(records: DataFrame, path: str, compression: str = "none") -> None:
    """Appends records as NDJSON, nulls and non-ASCII text kept as they are. Readers know compressed files by their names."""
    if "category" in records.columns:
        writer = records.hint("rebalance", "category").write.partitionBy("category")
    else:
        writer = records.hint("rebalance").write
    writer.mode("append").option("ignoreNullFields", False).json(path, compression=compression)


def append_urls(urls: DataFrame, path: str) -> None:
    """Appends one URL per line to the list of its category."""
    lines = urls.select("category", "url").hint("rebalance", "category")
    lines.write.mode("append").partitionBy("category").text(path)


def append_url_table(urls: DataFrame, path: str) -> None:
    """Appends URLs with their page and position, for resuming by position."""
    urls.hint("rebalance", "category").write.mode("append").partitionBy("category").parquet(path)
