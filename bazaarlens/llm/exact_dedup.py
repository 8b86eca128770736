"""Exact duplicates by two passes over a counting Bloom filter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens.llm.base import saved, text_of

# 2^27 places: at most 2^21 words of 64 places reach the executors, 32 MB of numbers.
MOST_PLACES = 1 << 27
PLACES_PER_ROW = 16
HASHES = 2
HOT_COUNT = 256
SALTS = 64


def repeated_places(hashes: DataFrame, places: int) -> DataFrame:
    """Places of the filter that two or more rows hit, as bit masks over words of 64 places.

    Counts are combined before the shuffle. ``hot`` marks the places hit ``HOT_COUNT`` times or more.
    """
    hits = hashes.select(F.explode("__places").alias("place")).groupBy("place").agg(F.count("*").alias("hits"))
    bit = F.expr("shiftleft(1L, cast(place & 63 as int))")
    return (
        hits.filter("hits > 1")
        .groupBy(F.shiftright("place", 6).alias("word"))
        .agg(F.bit_or(bit).alias("seen"), F.bit_or(F.when(F.col("hits") >= HOT_COUNT, bit).otherwise(F.lit(0))).alias("hot"))
    )


def exact_dedup(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", most_places: int = MOST_PLACES
) -> DataFrame:
    """The rows with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``; equal texts form a group, and the row with
    the largest id stays.

    The first pass counts the hits of every place of a Bloom filter. The second tests each row: where one of its
    ``HASHES`` places was hit by no other row, the text is unique and the row passes straight through; only the others are
    shuffled, by their SHA-256, and compared exactly. The filter has ``PLACES_PER_ROW`` places a row for each hash up to
    ``most_places`` in all; beyond that more rows are shuffled, and the result is the same. Only the repeated places are
    broadcast, 16 bytes for 64 of them. Copies of a frequent text are dealt over ``SALTS`` tasks.

    A null text counts as empty; empty texts are equal to each other. Null ids count as smaller than others: they stay only
    if the whole group has none (``keep_id`` is then null, and all of its rows stay). Rows that repeat id and text are all
    counted, and stay or go together. Other columns pass through; new columns replace those of the same name.
    """
    added = ("keep_id", "group_size", "kept", "text_sha256")
    docs = docs.drop(*added)
    rows = docs.count()
    part = max(1 << 10, min(most_places, HASHES * PLACES_PER_ROW * rows) // HASHES // 64 * 64)
    places = [F.pmod(F.xxhash64(text_of(text), F.lit(i)), F.lit(part)) + i * part for i in range(HASHES)]
    repeated = saved(repeated_places(docs.select(F.array(*places).alias("__places")), part), "repeated-places")

    tested = docs.withColumns({f"__place{i}": place for i, place in enumerate(places)})
    for i in range(HASHES):
        words = repeated.select(
            F.col("word").alias(f"__word{i}"), F.col("seen").alias(f"__seen{i}"), F.col("hot").alias(f"__hot{i}")
        ).filter((F.col("word") >= i * part // 64) & (F.col("word") < (i + 1) * part // 64))
        tested = tested.join(F.broadcast(words), F.shiftright(f"__place{i}", 6) == F.col(f"__word{i}"), "left")

    def all_set(kind: str):
        hit = [F.expr(f"coalesce(shiftright({kind}{i}, cast(__place{i} & 63 as int)) & 1, 0) = 1") for i in range(HASHES)]
        return hit[0] if len(hit) == 1 else F.expr("true") & hit[0] & hit[1]

    sha = F.sha2(text_of(text).cast("binary"), 256)
    tested = tested.select(
        *[F.col(c) for c in docs.columns],
        sha.alias("text_sha256"),
        all_set("__seen").alias("__maybe"),
        F.when(all_set("__hot"), F.pmod(F.xxhash64(doc_id), F.lit(SALTS))).otherwise(F.lit(0)).alias("__salt"),
        all_set("__hot").alias("__spread"),
    )
    alone = tested.filter("NOT __maybe").select(
        *docs.columns,
        F.col(doc_id).alias("keep_id"),
        F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"),
        "text_sha256",
    )
    maybe = tested.filter("__maybe")
    groups = (
        maybe.groupBy(F.col("text_sha256").alias("__sha"), F.col("__spread").alias("__wide"))
        .agg(F.max(doc_id).alias("keep_id"), F.count("*").alias("group_size"))
        .withColumn("__share", F.explode(F.expr(f"if(__wide, sequence(0, {SALTS - 1}), array(0))").cast("array<bigint>")))
    )
    compared = (
        maybe.join(groups, (F.col("text_sha256") == F.col("__sha")) & (F.col("__salt") == F.col("__share")))
        .withColumn("kept", F.col(doc_id).eqNullSafe(F.col("keep_id")))
        .select(*docs.columns, "keep_id", "group_size", "kept", "text_sha256")
    )
    return alone.unionByName(compared)
