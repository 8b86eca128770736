"""Archives read back against the pages that went in, and the order of the index."""

from __future__ import annotations

import base64
import hashlib
import random

import pytest

from bazaarlens.llm import warc


def expected(pages):
    """page_id -> bytes, digest, type, refers_to."""
    rows, smallest = [], {}
    for key, _, html in pages:
        if key is not None:
            smallest[html or ""] = min(key, smallest.get(html or "", key))
    for key, _, html in pages:
        data = (html or "").encode()
        first = smallest.get(html or "")
        revisit = first is not None and key != first
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        rows.append((key, len(data), digest, "revisit" if revisit else "response", first if revisit else None))
    return sorted(rows, key=repr)


def result(frame):
    return sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in frame.collect()), key=repr)


def test_round_trip_and_order(spark):
    pages = [
        (5, "http://www.b.example/x y", "same"), (3, "https://a.example:8080/?q=1#f", "same"), (9, None, None), (4, "http://[bad", ""),
        (None, "http://b.example/", "same"), (None, "http://b.example/", "no id"), (7, "HTTP://B.example/X%20Y", "WARC/1.1\r\n\r\n\r\nWARC/1.1\r\n"),
        (8, "http://c.example/", "é" * 200_000), (5, "http://www.b.example/x y", "same"), (11, "http://c.example/\r\nA: b", "é"), (3, "u", "other"),
    ]
    frame = spark.createDataFrame([(*p, "clash") for p in pages], "page_id bigint, url string, html string, body string")
    captures = warc.capture_histories(frame)
    assert result(captures) == expected(pages)
    rows = sorted(captures.collect(), key=lambda r: (r["range"], r["nth"]))
    keys = [(r["urlkey"], r["timestamp"], r["page_id"] is None, r["page_id"] or 0) for r in rows]
    assert keys == sorted(keys)


def test_small_payloads_are_all_responses(spark):
    frame = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id bigint, url string, html string")
    found = result(warc.capture_histories(frame, min_bytes=3))
    assert [r[3:] for r in found] == [("response", None), ("response", None), ("response", None), ("revisit", 3)]


def test_query(spark):
    from bazaarlens.llm.queries import op9_warc_index

    sf = "/root/testdata/sf0.01"
    pages = [(r["page_id"], r["url"], r["html"]) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    assert result(op9_warc_index(spark, sf)) == expected(pages)


def test_no_pages(spark):
    assert warc.capture_histories(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


@pytest.mark.parametrize("k", range(9))
def test_loser_tree(k):
    rng = random.Random(k)
    runs = [sorted((rng.randrange(20), i, j) for j in range(rng.randrange(0, 12))) for i in range(k)]
    assert list(warc.LoserTree(runs)) == sorted(x for run in runs for x in run)


def test_url_keys():
    assert warc.key_of("http://www.B.example:80/A/?b=1#c") == "example,b)/a?b=1"
    assert warc.key_of(None) == "" and warc.key_of("http://[bad") == "http://[bad"


def test_files_are_bounded_by_bytes_and_hold_longer_pages_alone(spark, monkeypatch):
    import glob
    import os

    from bazaarlens.session import scratch_path

    monkeypatch.setattr(warc, "SHORT_BYTES", 1_000)
    monkeypatch.setattr(warc, "RECORDS_PER_FILE", 5)
    monkeypatch.setattr(warc, "FILE_BYTES", 5_000)
    pages = [(i, f"http://a.example/{i}", f"{i}" * 150) for i in range(60)] + [(100 + i, f"http://b.example/{i}", f"{i}x" * 900) for i in range(9)]
    pages.append((200, "http://c.example/", "long" * 5_000))
    frame = spark.createDataFrame(pages, "page_id bigint, url string, html string").coalesce(1)
    path = scratch_path(spark, "t")
    assert result(warc.capture_histories(frame, path=path)) == expected(pages)
    sizes = sorted(os.path.getsize(f) for f in glob.glob(f"{path}/*.txt"))
    # Heads take some 500 bytes a record.
    assert len(sizes) >= 22 and sizes[-1] < 21_000 and sizes[-2] < 5_000 + 5 * 600


def test_times_are_in_utc_in_any_zone(spark):
    from pyspark.sql import functions as F

    seconds = [0, 1_711_846_800, 1_711_850_399, 1_730_000_000, -1, 253_402_300_799]
    frame = spark.createDataFrame([(s,) for s in seconds], "s bigint")
    expected_times = ["1970-01-01T00:00:00Z", "2024-03-31T01:00:00Z", "2024-03-31T01:59:59Z", "2024-10-27T03:33:20Z", "1969-12-31T23:59:59Z", "9999-12-31T23:59:59Z"]
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("Europe/Paris", "Asia/Ho_Chi_Minh", "UTC"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            found = frame.select(warc.utc_time(F.timestamp_seconds("s")).alias("t")).collect()
            assert [r.t for r in found] == expected_times
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_the_merged_order_is_in_the_result(spark):
    from bazaarlens.llm.queries import op9_warc_index

    rows = op9_warc_index(spark, "/root/testdata/sf0.001").collect()
    rows.sort(key=lambda r: (r["range"], r["nth"]))
    keys = [(r["urlkey"], r["timestamp"], r["page_id"]) for r in rows]
    assert keys == sorted(keys) and len({(r["range"], r["nth"]) for r in rows}) == len(rows)
