"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", memory: str = "8g", app: str = "bazaarlens") -> SparkSession:
    """A local session for tests and benchmarks. On a cluster, use the session the cluster hands out."""
    partitions = "8" if cpus == "*" else str(cpus)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@lru_cache(maxsize=1)
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="bazaarlens-")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it then gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    return _local_folder()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str, even: bool = True) -> DataFrame:
    """The rows as a table in the shared folder, in files of even size, or as their tasks made them if not ``even``.

    For rows that are read many times: whoever reads them again, after a lost executor too, reads the table instead of
    working them out anew, and small inputs end up in few partitions.
    """
    path = scratch_path(df.sparkSession, name)
    (df.hint("rebalance") if even else df).write.parquet(path)
    return df.sparkSession.read.parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What shuffles left on disk goes as soon as the query ends that wrote it, not once its plan is collected as garbage. For
    writes that run inside; a frame that is run again shuffles again. No effect on results."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)
