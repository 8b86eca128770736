"""Token ids as files of length-delimited binary records, with an index of offsets beside them."""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bazaarlens.llm import tokens
from bazaarlens.llm.base import small_or_shuffled
from bazaarlens.session import scratch_path

END_ID = 2
# A file is closed at this size; a record is never split.
FILE_BYTES = 256 << 20
# A read task takes about this much, in reads of at most this much.
TASK_BYTES, READ_BYTES = 32 << 20, 4 << 20
MOST_BROADCAST_FILES = 100_000

# Frame of a record: length of the data, masked checksum of these 8 bytes, data, masked checksum of the data.
LENGTH, CHECK = struct.Struct("<Q"), struct.Struct("<I")
FRAME_BYTES = LENGTH.size + 2 * CHECK.size
MASK = 0xA282EAD8

INDEX = "doc_id bigint, file string, part int, nth int, offset bigint, bytes bigint, token_start bigint, n_tokens bigint"
DOCUMENTS = "doc_id bigint, part int, nth int, token_start bigint, ids binary"


def masked(data: bytes) -> int:
    """The CRC-32 of the data, turned by 15 bits and shifted by a constant, so that the checksum of data that holds
    checksums is not a special case."""
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF


def framed(data: bytes) -> bytes:
    length = LENGTH.pack(len(data))
    return b"".join([length, CHECK.pack(masked(length)), data, CHECK.pack(masked(data))])


def unframed(record: bytes, place: str = "") -> bytes:
    """The data of one whole record; a record that is cut short, or of which a bit has changed, is an error."""
    if len(record) < FRAME_BYTES:
        raise ValueError(f"a record is cut short {place}")
    (length,), (check,) = LENGTH.unpack_from(record), CHECK.unpack_from(record, LENGTH.size)
    if check != masked(record[: LENGTH.size]) or length != len(record) - FRAME_BYTES:
        raise ValueError(f"the length of a record is damaged {place}")
    data = record[LENGTH.size + CHECK.size : -CHECK.size]
    if CHECK.unpack_from(record, len(record) - CHECK.size)[0] != masked(data):
        raise ValueError(f"the data of a record is damaged {place}")
    return data


def filesystem(uri: str):
    """The file system of a folder and the folder's path in it: local, HDFS and the object stores that Arrow knows."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


@dataclass(frozen=True)
class TokenFiles:
    """Files of records under ``path``, and how many bytes an id takes in them."""

    path: str
    id_bytes: int

    def index(self, spark: SparkSession) -> DataFrame:
        """A row for each record: id, file, place in the file in bytes and in tokens. Files are in the order of ``part`` and
        ``nth``. A file that no row names was left by a task that was run again."""
        return spark.read.schema(INDEX).parquet(f"{self.path}/index")


def write_token_files(
    docs: DataFrame,
    path: str | None = None,
    text: str = "text",
    doc_id: str = "doc_id",
    end_id: int = END_ID,
    tokenizer: str | None = None,
    file_bytes: int = FILE_BYTES,
) -> TokenFiles:
    """Encodes whole texts, ends each with ``end_id`` and writes one record a document, in the order of their ids.

    Documents are dealt to tasks by ranges of ids, so the files in order, and the records in each, ascend by id. Rows
    without an id come first; rows that share an id go by a hash of the text and then by the text, and may lie in several
    tasks. A null text counts as empty: its record holds the end id alone. Ids take two bytes where all of the vocabulary
    fits, else four, as little-endian unsigned numbers.

    Every attempt of a task writes files of its own name, and Spark commits the index: a file counts once the index names it.
    """
    from tokenizers import Tokenizer

    path = path or scratch_path(docs.sparkSession, "token-files")
    tokenizer = tokenizer or tokens.tokenizer_path(tokens.WORD_BPE)
    highest = max(end_id, Tokenizer.from_file(tokenizer).get_vocab_size() - 1)
    files = TokenFiles(path, 2 if highest < 1 << 16 else 4)
    end, narrow = end_id.to_bytes(4, "little"), files.id_bytes == 2

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, (store, folder) = tokens.word_ids(tokenizer), filesystem(path)
        store.create_dir(f"{folder}/data", recursive=True)
        part, nth, out, name = TaskContext.get().partitionId(), -1, None, ""
        try:
            for batch in tokens.few_rows(batches):
                keys, rows = [], []
                for key, value in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                    if out is None or offset >= file_bytes:
                        if out is not None:
                            out.close()
                        nth, offset, token = nth + 1, 0, 0
                        name = f"data/part-{part:06d}-{nth:04d}-{uuid.uuid4().hex}.rec"
                        out = store.open_output_stream(f"{folder}/{name}")
                    ids = ids_of.encode(value or b"") + end
                    count = len(ids) // 4
                    record = framed(np.frombuffer(ids, "<u4").astype("<u2").tobytes() if narrow else ids)
                    out.write(record)
                    keys.append(key)
                    rows.append((name, nth, offset, len(record), token, count))
                    offset, token = offset + len(record), token + count
                if rows:
                    columns = [list(c) for c in zip(*rows, strict=True)]
                    types = [pa.string(), pa.int32(), *[pa.int64()] * 4]
                    name_column, *others = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
                    parts = pa.array([part] * len(rows), pa.int32())
                    arrays = [pa.array(keys, pa.int64()), name_column, parts, *others]
                    yield pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in INDEX.split(", ")])
        finally:
            if out is not None:
                out.close()

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order, "text")
    dealt.mapInArrow(write, INDEX).write.parquet(f"{path}/index")
    return files


def read_token_files(spark: SparkSession, files: TokenFiles, seed: int | None = None) -> DataFrame:
    """The documents of all files, read by the index: ``doc_id``, their place, and ``ids`` as little-endian unsigned 32-bit
    numbers. Without a seed each task reads stretches of files from front to back; with one, tasks hold documents drawn
    from all files and read them in a shuffled order that the seed fixes. Damaged records are errors."""
    index, path, narrow = files.index(spark), files.path, files.id_bytes == 2

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = filesystem(path)
        name, source = None, None
        try:
            for batch in batches:
                places = list(zip(*[batch[c].to_pylist() for c in ("file", "offset", "bytes")], strict=True))
                at = 0
                while at < len(places):
                    first, offset, size = places[at]
                    end, upto = offset + size, at + 1
                    # Records that follow each other are read at once.
                    while upto < len(places) and places[upto][:2] == (first, end) and end + places[upto][2] - offset <= READ_BYTES:
                        end, upto = end + places[upto][2], upto + 1
                    if first != name:
                        if source is not None:
                            source.close()
                        name, source = first, store.open_input_file(f"{folder}/{first}")
                    data = source.read_at(end - offset, offset)
                    ids = []
                    for _, start, length in places[at:upto]:
                        found = unframed(data[start - offset : start - offset + length], f"at {start} of {first}")
                        ids.append(np.frombuffer(found, "<u2").astype("<u4").tobytes() if narrow else found)
                    stretch = batch.slice(at, upto - at)
                    arrays = [*[stretch[c] for c in ("doc_id", "part", "nth", "token_start")], pa.array(ids, pa.binary())]
                    yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "part", "nth", "token_start", "ids"])
                    at = upto
        finally:
            if source is not None:
                source.close()

    total = index.agg(F.coalesce(F.sum("bytes"), F.lit(0))).head()[0]
    tasks = max(1, -(-total // TASK_BYTES))
    if seed is None:
        stretch = F.expr(f"offset div {TASK_BYTES}")
        dealt = index.repartition(tasks, "file", stretch).sortWithinPartitions("file", "offset")
    else:
        drawn = F.xxhash64(F.lit(seed), "file", "offset")
        dealt = index.repartition(tasks, drawn).sortWithinPartitions(drawn, "file", "offset")
    return dealt.select("doc_id", "file", "part", "nth", "offset", "bytes", "token_start").mapInArrow(read, DOCUMENTS)


def with_starts(documents: DataFrame, files: TokenFiles) -> DataFrame:
    """Adds ``start``, the tokens of all documents before. Only a row for each file is put in order as a whole."""
    sizes = files.index(documents.sparkSession).groupBy("part", "nth").agg(F.sum("n_tokens").alias("__tokens"))
    before = Window.orderBy("part", "nth").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", "nth", F.coalesce(F.sum("__tokens").over(before), F.lit(0)).alias("__before"))
    placed = documents.join(small_or_shuffled(starts, MOST_BROADCAST_FILES), ["part", "nth"])
    return placed.withColumn("start", F.col("__before") + F.col("token_start")).drop("__before")


def written_and_read(docs: DataFrame, path: str | None = None, **options) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` of all documents as read back from their files; see ``write_token_files``.

    No documents give no files and no rows. Other columns are left out.
    """
    files = write_token_files(docs, path, **options)
    placed = with_starts(read_token_files(docs.sparkSession, files), files)
    return placed.select("doc_id", "start", F.expr("octet_length(ids) div 4").cast("bigint").alias("n_tokens"), "ids")
