"""What parts sold: aggregated in place by a hash, with the supplier of the first order."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from bazaarlens.plans import bridge, model_queries, page_queries
from bazaarlens.schemas import MODEL_CATEGORIES


def test_sales_are_added_up_without_sorting_lines(spark, sf):
    plan = bridge.sold_parts(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_first_supplier_is_that_of_the_least_order_and_nulls_come_first(spark):
    lines = [(1, None, 5), (1, 3, 2), (2, 7, 9), (2, 7, 4), (3, 4, None), (3, 4, 6), (4, 2**62, 2**62), (4, 2**62 + 1, 0)]
    rows = spark.createDataFrame(lines, "part bigint, l_orderkey bigint, l_suppkey bigint")
    packed, supplier = bridge._first_supplier()
    found = rows.groupBy("part").agg(F.min(packed).alias("first")).select("part", supplier(F.col("first")).alias("key")).collect()
    assert {row.part: row.key for row in found} == {1: 5, 2: 4, 3: None, 4: 2**62}


@pytest.fixture
def four_parts(spark, tmp_path):
    """Tables of four parts, one of them with a text."""
    tables = {
        "part": ([(i, f"red part{i % 2}", f"brand{i}", f"kind{i % 2}", 10 + i, 5.0 + i) for i in range(4)],
                 "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
        "lineitem": ([(i, i, i, 2.0 + i) for i in range(4)], "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_quantity double"),
        "supplier": ([(i, f"shop{i}", 0, 10.0 * i) for i in range(4)], "s_suppkey bigint, s_name string, s_nationkey bigint, s_acctbal double"),
        "nation": ([(0, "VIETNAM")], "n_nationkey bigint, n_name string"),
        "documents": ([(1, "some words of a text")], "doc_id bigint, text string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


def test_assembled_vectors_hold_the_words_of_a_listing(spark, four_parts):
    sizes = {(row.url[-1], row["size"]) for row in model_queries.ft_assemble(spark, four_parts).collect()}
    labels = bridge.model_rows(spark, four_parts).agg(*[F.count_distinct(name) for name in MODEL_CATEGORIES]).first()
    assert sizes == {(str(i), 500 + sum(labels) - len(labels) + 7) for i in range(4)}


def test_distinct_stream_leaves_no_shuffles_and_lands_compressed_files(spark, four_parts, tmp_path, monkeypatch):
    monkeypatch.setattr(page_queries, "scratch_path", lambda _, name: str(tmp_path / name))

    def shuffles():
        blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
        return {name for name in blocks.mkString(" ").split() if name.startswith("shuffle_")}

    before = shuffles()
    found = page_queries.pg_stream_distinct(spark, four_parts)
    assert not shuffles() - before
    assert found.count() == 4
    files = [*(tmp_path / "stream" / "landing").glob("part-*")]
    assert files and all(file.name.endswith(".json.gz") for file in files)
