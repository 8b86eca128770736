"""Incremental cleaning of listings as their files land."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from bazaarlens.operators.cleaning import clean_listings
from bazaarlens.operators.progress import distinct_records
from bazaarlens.sources.readers import stream_listings


def ingest(
    spark: SparkSession,
    landing: str,
    output: str,
    checkpoint: str,
    site: str = "a",
    clean: Callable[[DataFrame], DataFrame] = clean_listings,
    files_per_batch: int | None = None,
    bytes_per_batch: int | None = None,
    distinct: bool = False,
) -> StreamingQuery:
    """Cleans every landed file that no earlier run has taken, then stops.

    Each micro-batch overwrites the folder named after it, so a batch that is run again after a failure replaces what it
    had written instead of adding to it. Read the result with ``spark.read.parquet(output)``. The first batch takes all that
    has landed unless files or bytes of a batch are bounded.

    With ``distinct`` a record, one URL and option choice, is taken once over all batches and runs: what was taken is kept as
    state in the checkpoint, a key each. For very many records, keep that state in RocksDB
    (``spark.sql.streaming.stateStore.providerClass``).
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        # Cleaned listings hold their text three times over.
        clean(batch).write.mode("overwrite").parquet(f"{output}/batch={batch_id}", compression="zstd")

    landed = stream_listings(spark, landing, site, files_per_batch, bytes_per_batch)
    return (
        (distinct_records(landed) if distinct else landed)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
