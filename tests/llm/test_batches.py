"""The pipeline's stages hand few rows at once to Python workers, which they share with an executor."""

from __future__ import annotations

import corpus_pipeline
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from bazaarlens.llm.base import BATCH_ROWS, small_batches

CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def test_batches_are_small_inside_and_as_before_outside(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    before = spark.conf.get(CONF)
    rows = spark.range(3 * BATCH_ROWS).coalesce(1)
    with small_batches(spark):
        assert rows.mapInArrow(sizes, "n bigint").agg(F.max("n"), F.sum("n")).head() == (BATCH_ROWS, 3 * BATCH_ROWS)
    with pytest.raises(ValueError), small_batches(spark, 10):
        raise ValueError
    assert spark.conf.get(CONF) == before


@pytest.mark.parametrize(
    ("stage", "module", "name"),
    [
        ("keep_good", corpus_pipeline.classifier, "score"),
        ("drop_near_copies", corpus_pipeline.near_dup, "near_duplicates"),
        ("pack_sequences", corpus_pipeline.packing, "packed_documents"),
    ],
)
def test_stages_with_python_workers_run_in_small_batches(spark, monkeypatch, stage, module, name):
    class Reached(Exception):
        pass

    def reached(*args, **options):
        raise Reached(spark.conf.get(CONF))

    monkeypatch.setattr(module, name, reached)
    monkeypatch.setattr(corpus_pipeline.classifier, "train", lambda *args: None)
    with pytest.raises(Reached, match=f"^{BATCH_ROWS}$"):
        getattr(corpus_pipeline, stage)(spark, spark.createDataFrame([(1, "a")], "doc_id bigint, text string"), "/root/testdata/sf0.001")
