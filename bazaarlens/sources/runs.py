"""Appends that can be repeated: a run's rows count once its manifest is there, and a run counts once.

A run writes its rows into a folder of its own. One rename then puts the manifest of the run in place, which names the folder.
Readers take the folders that manifests name, so a run that was killed leaves nothing that is read, and a run that is repeated
adds nothing.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlens.sources import writers

MANIFESTS, DATA = "manifests", "data"
RUN = re.compile(r"[A-Za-z0-9._-]{1,100}")


class RunConflict(RuntimeError):
    """Another attempt has finished the same run first."""


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _filesystem(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def finished_runs(spark: SparkSession, path: str) -> dict[str, str]:
    """The folder of each finished run, by run: a line each, one small file a run."""
    folder = f"{path}/{MANIFESTS}"
    if not _filesystem(spark, folder).exists(_path(spark, folder)):
        return {}
    lines = spark.read.schema("value string").text(folder).select("value", F.col("_metadata.file_name").alias("run")).collect()
    return {row["run"]: row["value"] for row in lines}


def commit(spark: SparkSession, path: str, run: str, folder: str) -> None:
    """Puts the manifest of a run in place by one rename. Of two attempts, the later one is an error and adds nothing."""
    files = _filesystem(spark, path)
    staged = _path(spark, f"{path}/staged-manifests/{run}-{uuid.uuid4().hex}")
    out = files.create(staged, False)
    out.write(bytearray(f"{folder}\n".encode()))
    out.close()
    target = _path(spark, f"{path}/{MANIFESTS}/{run}")
    files.mkdirs(target.getParent())
    if files.exists(target) or not files.rename(staged, target):
        files.delete(staged, False)
        raise RunConflict(f"run {run} is finished already")


def append_run(records: DataFrame, path: str, run: str, write=writers.append_listings) -> bool:
    """Appends the rows of a run with one of the ``writers``; false if the run was finished before, and nothing is written.

    ``run`` names the work, not the attempt: repeat it with the same name after a failure. Letters, digits, ``.``, ``_`` and
    ``-`` are allowed.
    """
    if not RUN.fullmatch(run):
        raise ValueError(f"{run!r} cannot name a run")
    spark = records.sparkSession
    if run in finished_runs(spark, path):
        return False
    folder = f"{DATA}/attempt={run}-{uuid.uuid4().hex}"
    write(records, f"{path}/{folder}")
    commit(spark, path, run, folder)
    return True


def _folders(spark: SparkSession, path: str) -> list[str]:
    return [f"{path}/{folder}" for folder in sorted(finished_runs(spark, path).values())]


def read_runs(spark: SparkSession, path: str, schema: T.StructType | str, kind: str = "json") -> DataFrame:
    """The rows of all finished runs. A ``category`` in the schema that the files do not hold comes from the folder names."""
    folders = _folders(spark, path)
    if not folders:
        return spark.createDataFrame([], schema)
    frame = spark.read.schema(schema).format(kind).option("basePath", f"{path}/{DATA}").load(folders)
    return frame.select(*(T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fieldNames())
