"""How filters overlap: which documents survive which subsets of filters, and what each filter removes in every order."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.llm.base import saved

# The five filters: a document fails A to E where it is short, repeats words, shouts, holds signs, or repeats a text.
NAMES = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, SIGNS = 200, 50, 3, b"#$%&*|"
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
# Bytes that continue a character in UTF-8.
CONTINUATION = bytes(range(0x80, 0xC0))

# Parts a task counts at once; with more it hands over what it has and starts anew.
MOST_KEYS = 4_096

MEASURED = "doc_id bigint, part string, sha binary, failed int"
COUNTED = "part string, good boolean, toxic boolean, survivors array<bigint>"


def failed_bits(text: bytes) -> int:
    """Bits of the filters A to D that a text fails, A the lowest. Whole bytes suffice: every sign that counts is ASCII."""
    words = text.split()
    n_chars = len(text.translate(None, CONTINUATION))
    n_capitals = len(text) - len(text.translate(None, CAPITALS))
    return (
        (len(words) < LEAST_WORDS)
        | (100 * len(set(words)) < LEAST_DISTINCT * len(words)) << 1
        | (100 * n_capitals > MOST_CAPITALS * n_chars) << 2
        | (len(text.translate(None, SIGNS)) < len(text)) << 3
    )


def measured(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", part: str = "lang") -> DataFrame:
    """A narrow row for each document: id, part, SHA-256 of the text, and the bits of the filters A to D it fails."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [value or b"" for value in batch["text"].to_pylist()]
            shas = pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())
            bits = pa.array([failed_bits(t) for t in texts], pa.int32())
            names = ["doc_id", "part", "sha", "failed"]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["part"], shas, bits], names)

    narrow = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.col(text).cast("binary").alias("text"),
    )
    return narrow.mapInArrow(measure, MEASURED)


def with_repeats(rows: DataFrame, bit: int) -> DataFrame:
    """Adds ``bit`` to ``failed`` where a smaller id has the same text.

    The smallest id of each text is found with partial sums before the shuffle; rows then look for themselves by text and
    id together, so copies of one text stay spread over all tasks.
    """
    firsts = rows.filter("doc_id IS NOT NULL").groupBy(F.col("sha").alias("__sha")).agg(F.min("doc_id").alias("__first"))
    found = rows.join(firsts, (F.col("sha") == F.col("__sha")) & (F.col("doc_id") == F.col("__first")), "left")
    repeat = F.col("doc_id").isNotNull() & F.col("__first").isNull()
    return found.select("doc_id", "part", F.col("failed").bitwiseOR(F.when(repeat, bit).otherwise(0)).alias("failed"))


def with_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Adds ``good`` and ``toxic``. A document with several labels is good or toxic if any of them says so."""
    known = labels.groupBy(F.col("doc_id").alias("__id")).agg(
        F.max(F.col("quality") == 1).alias("__good"), F.max(F.col("toxic") == 1).alias("__toxic")
    )
    return rows.join(known, F.col("doc_id") == F.col("__id"), "left").select(
        "part",
        "failed",
        F.coalesce("__good", F.lit(False)).alias("good"),
        F.coalesce("__toxic", F.lit(False)).alias("toxic"),
    )


def survival_words(filters: int) -> np.ndarray:
    """For each set of failed filters the word whose bit s is on where no filter of subset s is failed."""
    sets = np.arange(1 << filters)
    survives = (sets[:, None] & sets[None, :]) == 0
    return (survives * (np.uint32(1) << sets.astype(np.uint32))).sum(axis=1, dtype=np.uint32)


def positional_popcount(words: np.ndarray) -> np.ndarray:
    """How many of the 32-bit words have each bit on.

    Carry-save: three words of one weight become a sum of that weight and a carry of twice the weight, at all 32 places and
    for a third of the words at once, until two words of each weight are left.
    """
    counts, weight, places = np.zeros(32, np.int64), 1, np.arange(32, dtype=np.uint32)
    while len(words):
        carries = []
        while len(words) > 2:
            third = len(words) // 3
            a, b, c = words[:third], words[third : 2 * third], words[2 * third : 3 * third]
            either = a ^ b
            carries.append((a & b) | (either & c))
            words = np.concatenate([either ^ c, words[3 * third :]])
        for word in words:
            counts += ((word >> places) & np.uint32(1)).astype(np.int64) * weight
        words = np.concatenate(carries) if carries else words[:0]
        weight *= 2
    return counts


def survivors(rows: DataFrame, filters: int = len(NAMES)) -> DataFrame:
    """``(part, everyone, good, toxic)`` from ``(part, failed, good, toxic)``: how many documents of the part survive each
    subset of at most five filters, as arrays by the subset's bits, of all documents and of those labelled good and toxic.

    Each task keeps 32 counts for each part and label, whatever the number of documents.
    """
    if not 1 <= filters <= 5:
        raise ValueError("a word of 32 bits holds the subsets of one to five filters")
    size = 1 << filters

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, totals = survival_words(filters), {}

        def counted() -> pa.RecordBatch:
            keys = list(totals)
            values = [[k[0] for k in keys], [k[1] for k in keys], [k[2] for k in keys], [totals[k][:size].tolist() for k in keys]]
            types = [pa.string(), pa.bool_(), pa.bool_(), pa.list_(pa.int64())]
            arrays = [pa.array(v, t) for v, t in zip(values, types, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, ["part", "good", "toxic", "survivors"])

        for batch in batches:
            words = table[batch["failed"].to_numpy()]
            parts = batch["part"].dictionary_encode()
            code = parts.indices.to_numpy().astype(np.int64) * 4
            code += batch["good"].to_numpy(zero_copy_only=False) * 2 + batch["toxic"].to_numpy(zero_copy_only=False)
            order = np.argsort(code, kind="stable")
            codes, starts = np.unique(code[order], return_index=True)
            for c, group in zip(codes.tolist(), np.split(words[order], starts[1:]), strict=True):
                key = (parts.dictionary[c // 4].as_py(), bool(c & 2), bool(c & 1))
                totals[key] = totals.get(key, 0) + positional_popcount(group)
            if len(totals) > MOST_KEYS:
                yield counted()
                totals.clear()
        if totals:
            yield counted()

    def summed(condition: Column) -> Column:
        columns = [F.coalesce(F.sum(F.when(condition, F.col("survivors")[s])), F.lit(0)) for s in range(size)]
        return F.array(*columns)

    counts = rows.select("part", "failed", "good", "toxic").mapInArrow(count, COUNTED)
    return counts.groupBy("part").agg(
        summed(F.lit(True)).alias("everyone"), summed(F.col("good")).alias("good"), summed(F.col("toxic")).alias("toxic")
    )


def in_every_order(counts: DataFrame, names: Sequence[str] = NAMES) -> DataFrame:
    """A row for each part, order of the filters and step, all from the survivors of subsets; see ``audit``."""
    filters = len(names)
    every = (1 << filters) - 1

    def at(array: str, subset: Column) -> Column:
        return F.element_at(array, subset.cast("int") + 1)

    def shapley(bit: int) -> Column:
        total = F.lit(0).cast("bigint")
        for subset in range(1 << filters):
            if not subset & bit:
                ahead = subset.bit_count()
                orders = math.factorial(ahead) * math.factorial(filters - 1 - ahead)
                total += orders * (at("everyone", F.lit(subset)) - at("everyone", F.lit(subset | bit)))
        return total

    worth = counts.withColumn("__shapley", F.array(*[shapley(1 << i) for i in range(filters)]))
    steps = worth.withColumn("filter_order", F.explode(F.lit(["".join(p) for p in permutations(names)])))
    steps = steps.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(filters))))
    ahead = F.substring("filter_order", F.lit(1), F.col("step") - 1)
    steps = steps.withColumns(
        {
            "__nth": F.instr(F.lit("".join(names)), F.substring("filter_order", F.col("step"), F.lit(1))),
            "__before": sum((F.when(ahead.contains(n), 1 << i).otherwise(0) for i, n in enumerate(names)), F.lit(0)),
        }
    )
    steps = steps.withColumn("__bit", F.expr("shiftleft(1, __nth - 1)"))
    steps = steps.withColumn("__after", F.col("__before").bitwiseOR(F.col("__bit")))

    def lost(array: str) -> Column:
        return at(array, F.col("__before")) - at(array, F.col("__after"))

    fails = at("everyone", F.lit(0)) - at("everyone", F.col("__bit"))
    return steps.select(
        "part",
        "filter_order",
        "step",
        at("everyone", F.col("__after")).alias("kept"),
        lost("everyone").alias("removed"),
        (fails - lost("everyone")).alias("redundant"),
        (at("everyone", F.lit(every) - F.col("__bit")) - at("everyone", F.lit(every))).alias("unique_fails"),
        lost("good").alias("good_lost"),
        lost("toxic").alias("toxic_lost"),
        F.element_at("__shapley", F.col("__nth")).alias("shapley"),
    )


def audit(
    docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", part: str = "lang"
) -> DataFrame:
    """What the filters A to E do in every order and part: ``(part, filter_order, step, kept, removed, redundant,
    unique_fails, good_lost, toxic_lost, shapley)``.

    Each document becomes a word of 32 bits, one for each subset of filters it survives; the words are added up by place.
    Any order's step is a pair of subsets, so all orders follow from 32 counts for each part and label.

    A null text counts as empty, a null part as the empty string. Rows without an id have no labels, and neither repeat a
    text nor make another row repeat it; rows that share an id do not repeat each other. Labels without an id, or with a
    null in place of 1, count for nothing. No documents give no rows. Other columns are left out.
    """
    rows = saved(measured(docs, text, doc_id, part), "filter-measures")
    rows = with_labels(with_repeats(rows, 1 << NAMES.index("E")), labels)
    # The counts are read once for each of 600 rows a part: worked out once, they are a row a part.
    return in_every_order(saved(survivors(rows), "filter-survivors"))
