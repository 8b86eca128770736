"""Packing token pieces into sequences: best-fit decreasing over the lengths of all pieces."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlens.llm import tokens
from bazaarlens.llm.base import place_of, root, running, saved

SEQUENCE_TOKENS = 1024
END_ID = 2
# Pieces of text whose ids a worker remembers.
REMEMBERED = tokens.PIECES

PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
)
PIECES_WITH_IDS = T.StructType([*PIECES.fields, T.StructField("ids", T.BinaryType())])


def tokenizer_path(name: str = tokens.BYTE_BPE) -> str:
    return tokens.tokenizer_path(name)


def cut(total: int, most: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of a document: full ones, of which the first may be shorter."""
    first = total % most or min(total, most)
    starts = [0, *range(first, total, most)]
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], total], strict=True)]


def token_pieces(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    most: int = SEQUENCE_TOKENS,
    end_id: int = END_ID,
    path: str | None = None,
    with_ids: bool = False,
    remembered: int = REMEMBERED,
) -> DataFrame:
    """Documents as pieces of at most ``most`` tokens, the end id included. A null text counts as empty: its piece is the
    end id alone. A worker remembers the ids of so many pieces of text, twice over at most: some 200 bytes each, and no
    effect on results."""
    path = path or tokenizer_path()
    end = end_id.to_bytes(4, "little")

    schema = PIECES_WITH_IDS if with_ids else PIECES

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.byte_ids(path, pieces=remembered).encode
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        for batch in tokens.few_rows(batches):
            rows = []
            for key, value in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                ids = encode(value or "") + end
                for n, (start, length) in enumerate(cut(len(ids) // 4, most)):
                    part = ids[4 * start : 4 * (start + length)]
                    row = (key, n, start, length, zlib.crc32(part))
                    rows.append((*row, part) if with_ids else row)
            if rows:
                columns = zip(zip(*rows, strict=True), types, strict=False)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], schema.names)

    narrow = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return narrow.mapInArrow(encoded, schema)


class TightestBins:
    """Open bins by room left. A segment tree over the rooms holds which have bins, so the smallest room that is large
    enough is found in logarithmic time."""

    def __init__(self, room: int):
        self.leaves = 1 << room.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.bins: list[list[tuple[int, int]]] = [[] for _ in range(room + 1)]

    def _add(self, room: int, bins: int) -> None:
        node = room + self.leaves
        while node:
            self.count[node] += bins
            node >>= 1

    def put(self, room: int, first: int, bins: int) -> None:
        """Bins ``first`` to ``first + bins - 1`` have this room left."""
        if bins and room:
            self.bins[room].append((first, bins))
            self._add(room, bins)

    def take(self, room: int) -> tuple[int, int]:
        first, bins = self.bins[room].pop()
        self._add(room, -bins)
        return first, bins

    def tightest(self, length: int) -> int | None:
        """The smallest room of at least ``length`` that has bins."""
        node = length + self.leaves
        if self.count[node]:
            return length
        while node > 1:
            if node % 2 == 0 and self.count[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.count[2 * node] else 2 * node + 1
                return node - self.leaves
            node >>= 1
        return None


def best_fit(counts: dict[int, int], most: int = SEQUENCE_TOKENS) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over pieces counted by length, as runs ``(length, first rank, pieces, first sequence, pieces for
    each sequence, offset)``.

    Pieces of one length are alike, and so are bins that were filled alike: where the tightest bins have room for ``k``
    more of a length, each of them takes ``k`` before the next is touched, just as piece by piece. So whole runs of bins
    are filled at once, and the plan's size follows from ``most``, not from the number of pieces: each length leaves
    three runs more than it found at most.
    """
    bins, plan, sequences = TightestBins(most), [], 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = bins.tightest(length)
            if room is None:
                room, each = most, most // length
                first, found = sequences, -(-left // each)
                sequences += found
            else:
                first, found = bins.take(room)
                each = room // length
            full = min(found, left // each)
            if full:
                plan.append((length, rank, full * each, first, each, most - room))
                bins.put(room - each * length, first, full)
                rank, left = rank + full * each, left - full * each
            if full < found:
                if left:
                    plan.append((length, rank, left, first + full, left, most - room))
                    bins.put(room - left * length, first + full, 1)
                    rank, left, full = rank + left, 0, full + 1
                bins.put(room, first + full, found - full)
    return plan


PLAN = "length bigint, __from bigint, __pieces bigint, __sequence bigint, __each bigint, __offset bigint"


def pack(pieces: DataFrame, most: int = SEQUENCE_TOKENS, keys: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``, in about as few sequences as can be.

    Only the number of pieces of each length, at most ``most`` numbers, goes to the driver, which plans best-fit
    decreasing over all pieces; the plan is bounded by ``most`` as well and is broadcast. Pieces find their place by
    their rank within their length, in the order of a hash of their keys; a length that a third of all pieces have is
    ranked in parts.

    ``pieces`` should be a saved table: it is read more than once. Extra columns pass through. No rows give no rows.
    """
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = pieces.sparkSession.createDataFrame(best_fit(counts, most), PLAN)
    parts = root(sum(counts.values()))
    hashed = pieces.withColumn("__hash", place_of(F.concat_ws(" ", *keys)))
    hashed = hashed.withColumn("__bucket", F.expr(f"__hash * {parts} div {1 << 32}"))
    ranked = running(hashed, ["length"], "__bucket", [F.col("__hash"), *[F.col(k) for k in keys]], F.lit(1), "__rank")
    placed = ranked.join(F.broadcast(plan), "length").filter("__rank >= __from AND __rank < __from + __pieces")
    return placed.select(
        *pieces.columns,
        F.expr("__sequence + (__rank - __from) div __each").alias("sequence_id"),
        F.expr("__offset + (__rank - __from) % __each * length").alias("offset"),
    )


def packed_documents(docs: DataFrame, most: int = SEQUENCE_TOKENS, **options) -> DataFrame:
    """All documents as packed pieces; see ``token_pieces`` and ``pack``.

    Ties: pieces of equal length and key hash are placed in the order of their keys. Rows that repeat an id are documents of
    their own, all placed, with the same ``(doc_id, piece)``. Null ids are kept.
    """
    return pack(saved(token_pieces(docs, most=most, **options), "token-pieces"), most)


def sequence_ids(packed: DataFrame) -> DataFrame:
    """The sequences themselves as ``(sequence_id, n_tokens, ids)``, ids in unsigned little-endian 32-bit numbers. A
    sequence has at most as many pieces as tokens, so a group is small."""
    inside = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return (
        packed.groupBy("sequence_id")
        .agg(inside.alias("__parts"), F.sum("length").alias("n_tokens"))
        .select(
            "sequence_id",
            "n_tokens",
            F.aggregate("__parts", F.lit(b""), lambda ids, part: F.concat(ids, part["ids"])).alias("ids"),
        )
    )

