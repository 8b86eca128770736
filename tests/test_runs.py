"""Repeatable appends, streamed cursors, and records that a stream takes once."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from bazaarlens.operators import progress
from bazaarlens.session import scratch_path
from bazaarlens.sources import readers, runs, writers
from bazaarlens.schemas import LISTING_A
from bazaarlens.streaming import cursors
from bazaarlens.streaming.ingest import ingest

SCHEMA = "category string, url string"


def urls(spark, *rows):
    return spark.createDataFrame([(r[0], r[1:]) for r in rows], SCHEMA)


def read(spark, path):
    return sorted(tuple(r) for r in runs.read_runs(spark, path, SCHEMA).collect())


def test_a_repeated_run_adds_nothing(spark):
    path = scratch_path(spark, "t")
    assert read(spark, path) == []
    assert runs.append_run(urls(spark, "a1", "b2"), path, "one")
    assert not runs.append_run(urls(spark, "a1", "b2"), path, "one")
    assert runs.append_run(urls(spark, "a1", "ă3"), path, "two")
    assert read(spark, path) == [("a", "1"), ("a", "1"), ("b", "2"), ("ă", "3")]
    with pytest.raises(ValueError, match="name a run"):
        runs.append_run(urls(spark, "a1"), path, "../x")


def test_a_run_that_fails_half_way_leaves_nothing_and_can_be_repeated(spark):
    path = scratch_path(spark, "t")

    def killed(records, folder):
        writers.append_listings(records, folder)
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        runs.append_run(urls(spark, "a1"), path, "one", write=killed)
    assert read(spark, path) == []
    failing = urls(spark, "a1").withColumn("url", F.expr("if(url = '1', raise_error('lost'), url)"))
    with pytest.raises(Exception, match="lost"):
        runs.append_run(failing, path, "one")
    assert read(spark, path) == []
    assert runs.append_run(urls(spark, "a1"), path, "one") and read(spark, path) == [("a", "1")]


def test_of_two_attempts_at_once_one_counts(spark):
    path = scratch_path(spark, "t")
    other = {}

    def overtaken(records, folder):
        if not other:
            other["first"] = runs.append_run(records, path, "one", write=overtaken)
        writers.append_listings(records, folder)

    other.clear()
    with pytest.raises(runs.RunConflict):
        calls = []

        def slow(records, folder):
            writers.append_listings(records, folder)
            if not calls:
                calls.append(1)
                assert runs.append_run(records, path, "one")

        runs.append_run(urls(spark, "a1"), path, "one", write=slow)
    assert read(spark, path) == [("a", "1")]


def test_cursors_equal_those_of_all_progress_so_far(spark):
    folder = scratch_path(spark, "t")
    landing, output, checkpoint = (f"{folder}/{n}" for n in ("landing", "out", "checkpoint"))
    listed = spark.createDataFrame([(c, i, f"{c}{i}") for c in "abc" for i in range(6)], "category string, pos int, url string")
    loads = [[("a", 2), ("b", 5)], [("a", 1), ("c", 0)], [("a", 4), (None, 3)], [("b", 2)]]
    seen = []
    for load in loads:
        rows = [(c, p, "u") for c, p in load]
        seen += rows
        spark.createDataFrame(rows, cursors.PROGRESS).coalesce(1).write.mode("append").json(landing)
        cursors.track(spark, landing, output, checkpoint).awaitTermination()
        so_far = spark.createDataFrame(seen, cursors.PROGRESS)
        pick = lambda df: sorted(map(tuple, df.collect()), key=str)
        assert pick(cursors.latest(spark, output)) == pick(progress.cursors(so_far))
        assert pick(progress.resume_at(listed, cursors.latest(spark, output))) == pick(progress.resume(listed, so_far))


def test_a_stream_takes_each_record_once_over_restarts(spark):
    folder = scratch_path(spark, "t")
    landing, output, checkpoint = (f"{folder}/{n}" for n in ("landing", "out", "checkpoint"))

    def land(*rows):
        empty = dict.fromkeys(LISTING_A.names)
        lines = [json.dumps({**empty, "url": url, "attrs": attrs, "price": price}) for url, attrs, price in rows]
        spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.mode("append").text(landing)
        query = ingest(spark, landing, output, checkpoint, clean=lambda df: df, distinct=True, bytes_per_batch=1 << 30)
        query.awaitTermination()
        return sorted((r.url, r.price) for r in spark.read.parquet(output).collect())

    land(("u1", {"size": "S", "colour": "red"}, "1"), ("u1", {"size": "M"}, "2"), ("u2", None, "3"), ("u2", None, "3"))
    # The same choice in another order, a redone URL, a new choice, and a new URL.
    found = land(("u1", {"colour": "red", "size": "S"}, "9"), ("u2", None, "9"), ("u1", {"size": None}, "4"), ("u3", {}, "5"))
    assert found == [("u1", "1"), ("u1", "2"), ("u1", "4"), ("u2", "3"), ("u3", "5")]
    assert land(("u3", {}, "6")) == found
    assert readers.read_listings(spark, landing, "a").count() == 9
