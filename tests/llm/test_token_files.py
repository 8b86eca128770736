"""Files of token records: round trips, order, damage, and ids against the tokenizers library."""

from __future__ import annotations

import glob
import os
import random
import struct
import zlib

import pytest

from bazaarlens.llm import token_files, tokens
from bazaarlens.session import scratch_path

TEXTS = [
    None, "", " ", "\n\n", "a  b", "Word WORD, word\nThe\tthing  end ", "x" * 300, "nœud ÉTÉ à b", "don't they'LL it's''s 's 'S",
    "<|endoftext|> is <|startoftext|>", "中文 字符 a1b2 3.14 $$$ ###", "we\x1cre\x85x\xa0y\xady", "é ́x İstanbul ΣΑΣ Σ",
    "²½³ª٣ हिन्दी ที่ \U0001f600", "q " * 20_000,
]


@pytest.fixture(scope="module")
def words():
    return tokens.word_ids(tokens.tokenizer_path(tokens.WORD_BPE))


@pytest.fixture(scope="module")
def pieces():
    return tokens.byte_ids(tokens.tokenizer_path(tokens.BYTE_BPE))


def test_ids_equal_those_of_whole_texts(words, pieces, spark, sf):
    documents = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    for text in [t for t in TEXTS if t is not None] + documents:
        assert words.encode(text.encode()) == words.of_whole(text)
        assert pieces.encode(text) == pieces.of_whole(text)


@pytest.mark.parametrize("seed", range(5))
def test_ids_of_random_texts(words, pieces, seed):
    rng = random.Random(seed)
    alphabet = "ab AB'st  dé.,!1٣²½ªß́\xad​İΣς\t\n\r　\x85\xa0\x1c中\U0001f600"
    for _ in range(2_000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 16)))
        assert words.encode(text.encode()) == words.of_whole(text)
        assert pieces.encode(text) == pieces.of_whole(text)


def test_remembering_little_changes_nothing(words):
    small = tokens.WordIds(tokens.tokenizer_path(tokens.WORD_BPE), chunks=2, pieces=3)
    for text in TEXTS:
        if text:
            assert small.encode(text.encode()) == words.of_whole(text)
    assert len(small.pieces) <= 3 and len(small.pieces.old) <= 3


def test_frames():
    for data in (b"", b"\x00" * 7, os.urandom(1000)):
        record = token_files.framed(data)
        assert struct.unpack("<Q", record[:8])[0] == len(data) and len(record) == len(data) + token_files.FRAME_BYTES
        assert token_files.unframed(record) == data
        crc = zlib.crc32(data)
        assert struct.unpack("<I", record[-4:])[0] == ((crc >> 15) + (crc << 17 & 0xFFFFFFFF) + 0xA282EAD8) % (1 << 32)
        for at in range(0, len(record), 37):
            broken = bytearray(record)
            broken[at] ^= 4
            with pytest.raises(ValueError, match="damaged"):
                token_files.unframed(bytes(broken))
        for cut in (record[:-1], record[:5], b""):
            with pytest.raises(ValueError):
                token_files.unframed(cut)


def rows_of(words, docs):
    """What the files must give, in order; ids of rows that share a doc_id may come in any order."""
    return sorted((key is not None, key or 0, words.of_whole(text or "") + struct.pack("<I", 2)) for key, text in docs)


def check(words, docs, found):
    ordered = sorted(found, key=lambda r: r["start"])
    at = 0
    for row in ordered:
        assert row["start"] == at and row["n_tokens"] * 4 == len(row["ids"])
        at += row["n_tokens"]
    keys = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in ordered]
    assert keys == sorted(keys)
    assert sorted((*k, bytes(r["ids"])) for k, r in zip(keys, ordered, strict=True)) == rows_of(words, docs)


@pytest.mark.parametrize("file_bytes", [token_files.FILE_BYTES, 500])
def test_round_trip(spark, words, file_bytes):
    docs = [*((i * 7 - 20, t) for i, t in enumerate(TEXTS)), (8, "same id"), (8, "same id"), (8, "other"), (None, "no id"), (None, None)]
    docs += [(1000 + i, f"text number {i} " * (i % 9)) for i in range(300)]
    random.Random(1).shuffle(docs)
    frame = spark.createDataFrame([(k, t, 1, b"x") for k, t in docs], "doc_id bigint, text string, start int, ids binary").repartition(5)
    path = scratch_path(spark, "t")
    found = token_files.written_and_read(frame, path, file_bytes=file_bytes).collect()
    check(words, docs, found)
    files = glob.glob(f"{path}/data/*.rec")
    assert len(files) > 20 if file_bytes == 500 else len(files) <= 8
    index = spark.read.parquet(f"{path}/index").collect()
    assert {r["file"] for r in index} == {os.path.relpath(f, path) for f in files}
    for row in index:
        with open(f"{path}/{row['file']}", "rb") as source:
            source.seek(row["offset"])
            assert len(token_files.unframed(source.read(row["bytes"]))) == 2 * row["n_tokens"]


def test_shuffled_reads_give_all_documents_in_another_order(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(500)], "doc_id bigint, text string")
    files = token_files.write_token_files(docs, scratch_path(spark, "t"))
    orders = [[r.doc_id for r in token_files.read_token_files(spark, files, seed).collect()] for seed in (1, 1, 2)]
    assert orders[0] == orders[1] != orders[2] and sorted(orders[0]) == sorted(orders[2]) == list(range(500))


def test_damaged_files_and_files_without_an_index_row(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(50)], "doc_id bigint, text string")
    files = token_files.write_token_files(docs, scratch_path(spark, "t"))
    with open(f"{files.path}/data/part-000000-0000-left-over.rec", "wb") as left_over:
        left_over.write(b"of a task that was run again")
    assert token_files.read_token_files(spark, files).count() == 50
    victim = spark.read.parquet(f"{files.path}/index").first()
    with open(f"{files.path}/{victim['file']}", "r+b") as source:
        source.seek(victim["offset"] + 13)
        byte = source.read(1)
        source.seek(victim["offset"] + 13)
        source.write(bytes([byte[0] ^ 1]))
    with pytest.raises(Exception, match="damaged"):
        token_files.read_token_files(spark, files).count()


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert token_files.written_and_read(docs).count() == 0


def test_query(spark, sf, words):
    from bazaarlens.llm.queries import op12_token_files

    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    expected, start = [], 0
    for key, text in sorted(docs):
        ids = words.of_whole(text or "") + struct.pack("<I", 2)
        expected.append((key, start, len(ids) // 4, zlib.crc32(ids)))
        start += len(ids) // 4
    assert sorted(tuple(r) for r in op12_token_files(spark, sf).collect()) == expected
