"""Headered CSV whose quoted fields may hold line breaks, read in splits: a large file takes as many tasks as it has blocks.

Whether a line starts inside a quoted field depends on all quotes before it. Quotes are counted for each block first; a
running sum over blocks tells how each one starts, and then every task finds the records of its blocks by itself. Only the
pieces of records that lie in two blocks or more are shuffled.
"""

from __future__ import annotations

import csv
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Workers get the functions below along with the query.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

QUOTE, BREAK, MARK = '"', "\n", "﻿"
# Records handed over at once.
BATCH_ROWS = 1_000

# What a piece of text is: a whole record, the start of one, or more of one that started in an earlier block.
WHOLE, OPENING, MORE = 0, 1, 2
PIECES = "file string, block bigint, kind int, text string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with the block they were read in; inside a partition they come block by block, in order."""
    return spark.read.option("lineSep", BREAK).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"
    )


def block_starts(lines: DataFrame) -> DataFrame:
    """``(file, block, inside, cut)``: whether a block starts inside a quoted field, and whether a record lies across its start
    or its end. A row for each block, as many as the scan itself is planned from."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit(QUOTE), F.lit("")))
    counted = lines.groupBy("file", "block").agg(F.sum(quotes).alias("quotes"))
    ahead = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("quotes").over(ahead), F.lit(0))
    inside, ends_inside = before % 2 == 1, (before + F.col("quotes")) % 2 == 1
    return counted.select("file", "block", inside.alias("inside"), (inside | ends_inside).alias("cut"))


def _check_header(record: str, names: list[str], file: str) -> None:
    found = next(csv.reader([record.removeprefix(MARK)]), [])
    if [name.strip().lower() for name in found] != [name.lower() for name in names]:
        raise ValueError(f"the header of {file} is {found}, expected {names}")


def _cut(names: list[str]):
    """Lines of blocks to whole records and pieces of records; the header of each file is checked and left out."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        here, inside, kind, parts = None, False, WHOLE, []

        def close(kind: int) -> None:
            text = BREAK.join(parts)
            rows.append((*here, kind, text.removesuffix("\r") if kind == WHOLE else text))

        def flushed() -> pa.RecordBatch:
            columns = [list(c) for c in zip(*rows, strict=True)]
            rows.clear()
            types = [pa.string(), pa.int64(), pa.int32(), pa.string()]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, ["file", "block", "kind", "text"])

        first = False
        for batch in batches:
            for file, block, value, starts in zip(*[batch[c].to_pylist() for c in ("file", "block", "value", "inside")], strict=True):
                if (file, block) != here:
                    if parts:
                        close(MORE if kind == MORE else OPENING)
                    if starts is None:
                        raise RuntimeError(f"the blocks of {file} have changed between two scans")
                    here, inside, parts, first = (file, block), starts, [], block == 0
                    kind = MORE if inside else WHOLE
                parts.append(value)
                inside ^= value.count(QUOTE) % 2 == 1
                if not inside:
                    if first:
                        _check_header(BREAK.join(parts), names, file)
                        first = False
                    else:
                        close(kind)
                    kind, parts = WHOLE, []
            if len(rows) >= BATCH_ROWS:
                yield flushed()
        if parts:
            close(MORE if kind == MORE else OPENING)
        if rows:
            yield flushed()

    return cut


def _stitched(pieces: DataFrame) -> DataFrame:
    """Records that lie in several blocks: each opening takes the pieces up to the next one. There are two pieces a block at
    most."""
    order = Window.partitionBy("file").orderBy("block", F.col("kind").desc())
    # In one block, more of an earlier record comes before the opening of the next.
    numbered = pieces.where(F.col("kind") != WHOLE).withColumn("record", F.sum(F.when(F.col("kind") == OPENING, 1).otherwise(0)).over(order))
    sorted_parts = F.array_sort(F.collect_list(F.struct("block", "text")))
    joined = numbered.groupBy("file", "record").agg(F.array_join(F.transform(sorted_parts, lambda p: p["text"]), BREAK).alias("text"))
    return joined.select(F.regexp_replace("text", "\r$", "").alias("text"))


def read_csv_records(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of CSV files with a header, as text columns: equal to a ``multiLine`` scan, in splits.

    Fields with quotes, commas or line breaks are quoted, and quotes in them doubled; a quote inside a field that is not
    quoted is not covered. Records end with a line feed, with or without a carriage return; line breaks inside fields stay as
    they are. Empty lines are left out. A header that is not the schema's names is an error, as is a schema with other types
    than text.
    """
    if any(field.dataType != T.StringType() for field in schema.fields):
        raise ValueError("CSV rows are read as text")
    lines = _lines(spark, path)
    starts = block_starts(lines)
    placed = lines.join(F.broadcast(starts), ["file", "block"], "left").select("file", "block", "value", "inside", "cut")

    def pieces(of: DataFrame) -> DataFrame:
        return of.select("file", "block", "value", "inside").mapInArrow(_cut(schema.names), PIECES)

    whole = pieces(placed).where(F.col("kind") == WHOLE).select("text")
    # Few blocks start or end inside a record; only those are read for pieces.
    records = whole.unionByName(_stitched(pieces(placed.where("cut"))))
    parsed = F.from_csv("text", ", ".join(f"`{name}` string" for name in schema.names), {"escape": QUOTE, "multiLine": "true"})
    return records.where(F.col("text") != "").select(parsed.alias("row")).select("row.*")
