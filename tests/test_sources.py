"""Readers, writers and the stream."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from bazaarlens.operators.cleaning import clean_listings
from bazaarlens.schemas import LISTING_A, MODEL_CSV
from bazaarlens.session import scratch_path
from bazaarlens.sources import readers, writers
from bazaarlens.streaming.ingest import ingest

ROW = ("Áo Thun", None, "Yêu Thích\nShop\n", "₫9.000", "<p>x</p>", None, "1,2k", "3k", {"Màu": "Đen", "Size": None}, "u1")


def test_listings_survive_a_round_trip(spark):
    path = scratch_path(spark, "t")
    records = spark.createDataFrame([ROW, ROW[:-1] + ("u2",)], LISTING_A)
    writers.append_listings(records, path)
    writers.append_listings(records, path)
    lines = [json.loads(r.value) for r in spark.read.text(path).collect()]
    assert len(lines) == 4 and set(lines[0]) == set(LISTING_A.names) and lines[0]["avg_rating"] is None
    assert "Áo Thun" in spark.read.text(path).first().value
    back = readers.read_listings(spark, path, "a")
    assert back.schema == LISTING_A
    assert sorted(r.url for r in back.collect()) == ["u1", "u1", "u2", "u2"]
    assert back.first().attrs == {"Màu": "Đen", "Size": None}


def test_category_named_like_a_number_stays_text(spark):
    path = scratch_path(spark, "t")
    records = spark.createDataFrame([ROW], LISTING_A).withColumn("category", F.lit("007"))
    writers.append_listings(records, path)
    assert readers.read_listings(spark, path, "a", partitioned=True).first().category == "007"
    urls = spark.createDataFrame([("007", "u1 "), ("007", "u1 "), ("áo & quần", "u2")], "category string, url string")
    path = scratch_path(spark, "t")
    writers.append_urls(urls, path)
    found = sorted(tuple(r) for r in readers.read_url_table(spark, path).collect())
    assert found == [("007", "u1"), ("007", "u1"), ("áo & quần", "u2")]


def test_url_table_keeps_places(spark):
    path = scratch_path(spark, "t")
    urls = spark.createDataFrame([("c", 1, 0, "u1"), ("c", 1, 1, "u2")], "category string, page_no int, pos int, url string")
    writers.append_url_table(urls, path)
    assert sorted(tuple(r) for r in spark.read.parquet(path).select(urls.columns).collect()) == [
        ("c", 1, 0, "u1"), ("c", 1, 1, "u2"),
    ]


def test_missing_description_of_site_b(spark, tmp_path):
    (tmp_path / "b.ndjson").write_text('{"product_name": "x", "product_desc": "None"}\n{"product_desc": "<p>"}\n')
    found = readers.read_listings(spark, str(tmp_path), "b").select("product_desc").collect()
    assert sorted(str(r.product_desc) for r in found) == ["<p>", "None"] and None in [r.product_desc for r in found]


def test_seeds_two_and_three_levels_deep(spark, tmp_path):
    for folder, category in (("a/b", "x"), ("a/c", "y"), ("a/b/d", "z")):
        (tmp_path / folder).mkdir(parents=True, exist_ok=True)
        seed = json.dumps({"category": category, "url": f"https://{category}"}, indent=1)
        (tmp_path / folder / "base_url.txt").write_text(seed)
    read = lambda levels: sorted(tuple(r) for r in readers.read_seeds(spark, str(tmp_path), levels).collect())
    assert read(2) == [("x", "https://x"), ("y", "https://y")]
    assert read(3) == [("z", "https://z")]


def test_url_lists_are_numbered_across_blocks(spark, tmp_path):
    lists = {"áo + quần": [f"https://a/{i}" for i in range(3000)], "b": ["https://b/0 ", "", "https://b/2"]}
    for category, urls in lists.items():
        (tmp_path / category).mkdir()
        (tmp_path / category / "url.txt").write_text("\n".join(urls) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("4096", before):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            found = {}
            for r in readers.read_urls(spark, f"{tmp_path}/*/url.txt").orderBy("category", "pos").collect():
                found.setdefault(r.category, []).append((r.pos, r.url))
            assert found == {c: [(i, u.strip()) for i, u in enumerate(urls)] for c, urls in lists.items()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_url_list_in_several_files_is_numbered_in_name_order(spark, tmp_path):
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "part-1.txt").write_text("c\nd\n")
    (tmp_path / "c" / "part-0.txt").write_text("a\nb\n")
    found = readers.read_urls(spark, f"{tmp_path}/*/*.txt").orderBy("pos").collect()
    assert [(r.pos, r.url) for r in found] == [(0, "a"), (1, "b"), (2, "c"), (3, "d")]


def test_scans_of_one_split_are_spread_and_others_left(spark, sf):
    cores = spark.sparkContext.defaultParallelism
    one = spark.read.parquet(f"{sf}/pages.parquet")
    assert readers.spread(one).rdd.getNumPartitions() == cores
    many = spark.range(100).repartition(cores + 1)
    assert readers.spread(many) is many


def test_model_csv_is_text_with_quotes_and_line_breaks(spark, tmp_path):
    header = ",".join(MODEL_CSV.names)
    values = ['"áo ""đẹp""\nhai dòng"'] + ["1"] * (len(MODEL_CSV.names) - 1)
    (tmp_path / "m.csv").write_text(header + "\n" + ",".join(values) + "\n")
    row = readers.read_model_csv(spark, str(tmp_path)).first()
    assert row.name_description == 'áo "đẹp"\nhai dòng' and row.price == "1"


def test_stream_takes_each_file_once_and_equals_the_batch(spark):
    folder = scratch_path(spark, "t")
    landing, output, checkpoint = (f"{folder}/{n}" for n in ("landing", "out", "checkpoint"))
    rows = [ROW[:-1] + (f"u{i}",) for i in range(6)]
    for load in (rows[:4], rows[4:]):
        writers.append_listings(spark.createDataFrame(load, LISTING_A), landing)
        ingest(spark, landing, output, checkpoint).awaitTermination()
    ingest(spark, landing, output, checkpoint).awaitTermination()
    streamed = spark.read.parquet(output).drop("batch")
    batch = clean_listings(readers.read_listings(spark, landing, "a"))
    assert streamed.count() == 6
    assert streamed.select(batch.columns).exceptAll(batch).count() == 0


def test_scratch_folder_comes_from_the_session(spark, monkeypatch):
    from bazaarlens import session

    class Conf:
        def get(self, name, default):
            return {"spark.checkpoint.dir": "hdfs://shared/x/"}.get(name, default) if self.named else default

    class Fake:
        conf = Conf()
        sparkContext = type("C", (), {"master": "yarn"})

    Conf.named = True
    assert session.scratch_path(Fake, "n").startswith("hdfs://shared/x/n-")
    Conf.named = False
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_path(Fake, "n")
