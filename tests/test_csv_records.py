"""Splittable CSV against Spark's own scan of whole files."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

from bazaarlens.session import scratch_path
from bazaarlens.sources import csv_records

SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in ("name", "text", "price")])


def whole(spark, path):
    return spark.read.schema(SCHEMA).option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def written_csv(spark, folder, rows, ending="\n", name="a.csv"):
    import os

    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", encoding="utf-8", newline="") as out:
        out.write(ending.join(["name,text,price", *rows]) + ending)


def quoted(text):
    return '"' + text.replace('"', '""') + '"'


def made(rng, n):
    rows = []
    for i in range(n):
        text = rng.choice(["plain", "a, b", 'say "hi"', "two\nlines", "end\n", "\n\n\nmany", 'q""\n"', "x" * rng.randrange(200), "", "áo\r\nlen"])
        fields = [f"n{i}", quoted(text) if rng.random() < 0.8 or not text.isalnum() else text, rng.choice(["", "1.5", quoted("2,5")])]
        rows.append(",".join(fields))
    return rows


def same(a, b, ending="\n"):
    """In a file with carriage returns, Spark's own scan drops those inside fields as well."""
    key = lambda df: sorted((repr(tuple(r)).replace(repr(ending)[1:-1], "\\n") for r in df.collect()))
    return key(a) == key(b)


@pytest.fixture
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "300b", "spark.sql.files.openCostInBytes": "1b", "spark.sql.files.minPartitionNum": "1"}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name in names:
        spark.conf.unset(name)


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
@pytest.mark.parametrize("seed", range(3))
def test_many_splits_give_the_same_rows(spark, small_splits, ending, seed):
    folder = scratch_path(spark, "csv")
    rng = random.Random(seed)
    written_csv(spark, folder, made(rng, 150), ending)
    written_csv(spark, folder, made(rng, 40), ending, "b.csv")
    found = csv_records.read_csv_records(spark, folder, SCHEMA)
    blocks = csv_records.block_starts(csv_records._lines(spark, folder))
    assert blocks.count() > 10 and blocks.where("cut").count() > 0
    assert found.count() == 190 and same(found, whole(spark, folder), ending)


def test_a_record_longer_than_many_splits(spark, small_splits):
    folder = scratch_path(spark, "csv")
    written_csv(spark, folder, ["a,b,c", "long," + quoted("line of text\n" * 300) + ",1", "d,e,f", "x," + quoted("\n" * 900) + ",2"])
    found = csv_records.read_csv_records(spark, folder, SCHEMA)
    assert same(found, whole(spark, folder)) and found.count() == 4


def test_headers_marks_and_empty_lines(spark):
    folder = scratch_path(spark, "csv")
    written_csv(spark, folder, ["", "a,,", "", 'b,"",3', "c"])
    found = csv_records.read_csv_records(spark, folder, SCHEMA)
    assert found.count() == 3 and same(found, whole(spark, folder))
    marked = scratch_path(spark, "csv")
    written_csv(spark, marked, ["a,b,c"])
    with open(f"{marked}/a.csv", encoding="utf-8") as source:
        text = source.read()
    with open(f"{marked}/a.csv", "w", encoding="utf-8") as out:
        out.write("﻿" + text)
    assert [tuple(r) for r in csv_records.read_csv_records(spark, marked, SCHEMA).collect()] == [("a", "b", "c")]
    other = scratch_path(spark, "csv")
    written_csv(spark, other, ["a,b,c"])
    with pytest.raises(Exception, match="header"):
        csv_records.read_csv_records(spark, other, T.StructType([T.StructField("other", T.StringType())])).collect()
    with pytest.raises(ValueError, match="text"):
        csv_records.read_csv_records(spark, other, T.StructType([T.StructField("name", T.LongType())]))
