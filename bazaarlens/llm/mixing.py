"""Mixing sources to target weights by a low-discrepancy schedule of slots."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaarlens.llm.base import WORD, place_of, root, running, saved, small_or_shuffled, text_of

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_TIMES = 2
BLOCK_WORDS = 4096
# Step of the golden ratio sequence on a circle of 2^32 points.
GOLDEN, CIRCLE, CELLS = 2654435769, 1 << 32, 1024
MOST_BROADCAST_SOURCES = 100_000


@dataclass(frozen=True)
class Mix:
    """``targets``: a row for each source. ``pieces``: a row for each document and slot that takes words of it, and one
    with a null ``slot`` for a document that no slot takes."""

    targets: DataFrame
    pieces: DataFrame


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most_times: int = MOST_TIMES) -> DataFrame:
    """Target of each source from ``(source, source_size)``: shares by weight of ``share`` times all words, none above
    ``most_times`` its source's size, what is left over shared again by weight.

    Sources fill in the order of room by weight: those ahead of the first whose room holds the water level are full.
    """
    everything = Window.partitionBy()
    ranked = sizes.withColumn("source_no", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    ranked = ranked.withColumns(
        {
            "weight": F.element_at(F.array(*[F.lit(w) for w in weights]), F.col("source_no") % len(weights) + 1),
            "room": F.col("source_size") * F.lit(most_times),
        }
    )
    order = Window.orderBy(F.col("room") / F.col("weight"), "source_no")
    ahead = order.rowsBetween(Window.unboundedPreceding, -1)
    goal = F.sum("source_size").over(everything) * F.lit(float(share))
    level = (goal - F.coalesce(F.sum("room").over(ahead), F.lit(0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(ahead), F.lit(0))
    )
    filled = ranked.withColumns({"__nth": F.row_number().over(order), "__level": level})
    first_open = F.min(
        F.when(F.col("__level") <= F.col("room") / F.col("weight"), F.struct("__nth", "__level"))
    ).over(everything)
    target = F.least(F.col("room").cast("double"), F.coalesce(first_open["__level"] * F.col("weight"), F.col("room")))
    return filled.withColumn("target", target).withColumn("take", F.round("target").cast("bigint")).drop("__nth", "__level", "room")


def slot_schedule(targets: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Slots as ``(slot, source_no, block)``: slot i's golden-ratio point picks a source by the cumulative targets, and
    slots are ranked per source. A source whose share no point meets gets one slot at the end."""
    spark = targets.sparkSession
    words = targets.agg(F.coalesce(F.sum("take"), F.lit(0))).head()[0]
    slots = -(-words // block_words)
    upto = F.sum("take").over(Window.orderBy("source_no"))
    scale = F.lit(CIRCLE / max(1, words))
    edges = targets.select(
        "source_no",
        F.floor((upto - F.col("take")) * scale).alias("__from"),
        F.when(upto == words, F.lit(CIRCLE)).otherwise(F.floor(upto * scale)).alias("__to"),
    ).filter("__from < __to")
    width = CIRCLE // CELLS
    cells = edges.withColumn("__cell", F.explode(F.expr(f"sequence(__from div {width}, (__to - 1) div {width})")))
    part = root(slots)
    points = spark.range(slots).select(
        F.col("id").alias("slot"),
        F.expr(f"id div {part}").alias("__part"),
        ((F.col("id") % (1 << 31)) * GOLDEN % CIRCLE).alias("__point"),
    )
    picked = points.withColumn("__cell", F.expr(f"__point div {width}")).join(cells, "__cell")
    picked = picked.filter("__from <= __point AND __point < __to").select("slot", "__part", "source_no")
    ranked = running(picked, ["source_no"], "__part", [F.col("slot")], F.lit(1), "block").drop("__part")
    missed = targets.filter("take > 0").join(picked.select("source_no").distinct(), "source_no", "left_anti")
    last = missed.select((F.lit(slots) + F.col("source_no")).alias("slot"), "source_no", F.lit(0).cast("bigint").alias("block"))
    return ranked.select("slot", "source_no", "block").unionByName(last)


def mix(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    source: str = "source",
    weights=WEIGHTS,
    share: float = SHARE,
    most_times: int = MOST_TIMES,
    block_words: int = BLOCK_WORDS,
) -> Mix:
    """Which words of which document fill which slot of the mix.

    Sizes are words. Each source's documents lie in the order of the MD5 of their ids on an axis of words, repeated up to
    ``most_times``; its target is cut into as many blocks of equal size as the schedule has slots for it, and block b
    fills the source's slot of rank b. So every source meets its target to the word, and any run of slots is close to
    the weights.

    A null text has no words; a null source is a source of its own, the last. Documents without words are in no slot.
    Repeated rows are documents of their own. No rows give no targets and no pieces. Other columns are left out.
    """
    sized = saved(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.col(source).alias("source"),
            F.regexp_count(text_of(text), F.lit(WORD)).cast("bigint").alias("size"),
            place_of(F.col(doc_id)).alias("__place"),
        ),
        "mix-sizes",
    )
    targets = saved(
        source_targets(
            sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most_times
        ).coalesce(1),
        "mix-targets",
    )
    slots = saved(slot_schedule(targets, block_words), "mix-slots")
    blocks = slots.groupBy("source_no").agg(F.count("*").alias("__blocks"))
    per_source = small_or_shuffled(
        saved(
            targets.join(blocks, "source_no", "left").select(
                F.col("source").alias("__source"), "source_no", "source_size", "target", "take", "__blocks"
            ),
            "mix-blocks",
        ),
        MOST_BROADCAST_SOURCES,
    )
    parts = root(sized.count())
    placed = sized.join(per_source, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    placed = placed.withColumn("__bucket", F.expr(f"__place * {parts} div {CIRCLE}"))
    order = [F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.col("doc_id"), F.col("size")]
    placed = running(placed, ["source_no"], "__bucket", order, F.col("size"), "__start")
    return Mix(targets, _pieces(placed, slots, most_times))


def _pieces(placed: DataFrame, slots: DataFrame, most_times: int) -> DataFrame:
    # Blocks have __small words each, the first __large of them one more.
    def block(at: str) -> str:
        return (
            f"if({at} < __large * (__small + 1), {at} div (__small + 1),"
            f" __large + ({at} - __large * (__small + 1)) div greatest(__small, 1L))"
        )

    cut = (
        placed.withColumns({"__small": F.expr("take div __blocks"), "__large": F.expr("take % __blocks")})
        .withColumn("__pass", F.explode(F.sequence(F.lit(0), F.lit(most_times - 1))))
        .withColumn("__from", F.col("__start") + F.col("__pass") * F.col("source_size"))
        .withColumn("__to", F.least(F.col("__from") + F.col("size"), F.col("take")))
        .withColumn("__taken", F.expr("__from < __to AND __blocks IS NOT NULL"))
        .filter("__pass = 0 OR __taken")
        # A block number below 0 meets no slot, and does not bring all rows without slots into one task.
        .withColumn(
            "block", F.expr(f"explode(if(__taken, sequence({block('__from')}, {block('(__to - 1)')}), array(-1L - __place)))")
        )
        .withColumn("__first", F.expr("greatest(__from, block * __small + least(block, __large))"))
        .withColumn("__last", F.expr("least(__to, (block + 1) * __small + least(block + 1, __large))"))
    )
    return cut.select(
        "doc_id",
        "source",
        "source_no",
        "size",
        "source_size",
        "target",
        F.col("__start").alias("doc_start"),
        F.col("__pass").alias("pass"),
        "block",
        F.expr("if(__taken, __first - __from, null)").alias("piece_start"),
        F.expr("if(__taken, __last - __first, 0L)").alias("piece_words"),
    ).join(slots, ["source_no", "block"], "left")


def words_taken(pieces: DataFrame) -> DataFrame:
    """A row for each document with ``taken``, the words the mix takes of it. A document with words is the only one at its
    start in its source; one without words has one piece."""
    keep = ["doc_id", "source", "source_no", "size", "source_size", "target", "doc_start"]
    taken = pieces.filter("size > 0").groupBy(*keep).agg(F.sum("piece_words").alias("taken"))
    return taken.unionByName(pieces.filter("size = 0").select(*keep, F.col("piece_words").alias("taken")))
