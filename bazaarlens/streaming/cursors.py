"""How far each category has got, kept up to date from progress rows as they land."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from bazaarlens.operators import progress

PROGRESS = "category string, pos int, url string"
REACHED = "category string, cursor int"


def track(spark: SparkSession, landing: str, output: str, checkpoint: str, files_per_batch: int | None = None) -> StreamingQuery:
    """Takes the progress files (JSON lines of ``category``, ``pos``, ``url``) that no earlier run has taken, then stops.

    The state is one number a category and lives in the checkpoint, so it outlasts restarts. Each batch writes the whole table
    of cursors into a folder named after it; a batch that is run again writes the same one.
    """
    reader = spark.readStream.schema(PROGRESS)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{output}/batch={batch_id}")

    return (
        progress.cursors(reader.json(landing))
        .writeStream.outputMode("complete")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def latest(spark: SparkSession, output: str) -> DataFrame:
    """The cursors after the last batch."""
    tables = spark.read.schema(f"{REACHED}, batch bigint").parquet(output)
    last = tables.agg(F.max("batch")).head()[0]
    return tables.where(F.col("batch") == last).select("category", "cursor")
