"""The trie of all conversation prefixes, by grouping sets over columns of turns."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlens.llm.base import WORD, saved

# Turns in a block of columns.
WIDTH = 8
# Conversations that share a number by this divisor begin alike, by up to ``FORKS - 1`` turns of the first of them.
FAMILY, FORKS = 20, 4
# Turn numbers that one task ranks at once, and conversation ids in one piece of a list of ids.
STRETCH, IDS_PER_PIECE = 4_096, 256
SALTS = 64


def turn_id(role: Column, text: Column) -> Column:
    """The first half of a SHA-256 over role and text; the length of the role sets the two apart."""
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return F.substring(F.unhex(F.sha2(whole.cast("binary"), 256)), 1, 16)


def ordered_turns(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """Narrow rows of turns with their place, from 1, in their conversation, and ``n_own``, its number of turns.

    Turns are ranked within stretches of turn numbers, and only the sizes of the stretches meet in one row of places, so a
    conversation with a third of all turns is not sorted by one task.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    narrow = conversations.select(
        F.col(conv_id).cast("bigint").alias("conv_id"),
        F.col(turn).cast("bigint").alias("turn"),
        turn_id(role, text).alias("turn_id"),
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("words"),
    ).filter("conv_id IS NOT NULL")
    # Turns without a number come first.
    narrow = narrow.withColumn("__stretch", F.coalesce(F.floor(F.col("turn") / STRETCH), F.lit(-(1 << 62))))
    keys = ["conv_id", "__stretch"]
    before = narrow.groupBy(*keys).agg(F.count("*").alias("__n"))
    before = before.select(*keys, ahead(F.sum("__n")).alias("__before"), whole(F.sum("__n")).alias("n_own"))
    within = Window.partitionBy(*keys).orderBy(F.col("turn").asc_nulls_first(), "turn_id")
    placed = narrow.withColumn("__nth", F.row_number().over(within)).join(before, keys)
    return placed.select("conv_id", (F.col("__before") + F.col("__nth")).alias("pos"), "turn_id", "words", "n_own")


def ahead(value: Column) -> Column:
    """An aggregate over the stretches of a conversation before this one."""
    order = Window.partitionBy("conv_id").orderBy("__stretch")
    return F.coalesce(value.over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def whole(value: Column) -> Column:
    """An aggregate over all stretches of a conversation."""
    return value.over(Window.partitionBy("conv_id"))


def rebuilt(
    conversations: DataFrame,
    family: int = FAMILY,
    forks: int = FORKS,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like the first of their family: the first h turns of conversation ``c - c % family``, then
    their own from the one after h, where h is the CRC-32 of the decimal id by ``forks``. Returns the turns ``(conv_id, pos,
    turn_id, words)``, and the ids of conversations that have no turns left.

    A family has at most ``family`` members, each of which takes at most ``forks - 1`` turns of its first.
    """
    turns = saved(ordered_turns(conversations, conv_id, turn, role, text), "turns")
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % forks
    ids = turns.filter("pos = 1").select("conv_id", "n_own", h.alias("h"), F.expr(f"conv_id - conv_id % {family}").alias("base"))
    head = F.struct("pos", "turn_id", "words")
    firsts = turns.filter(F.col("pos") < forks).groupBy(F.col("conv_id").alias("base")).agg(F.collect_list(head).alias("heads"))
    members = ids.join(firsts, "base", "left").withColumn("taken", F.expr("filter(heads, t -> t.pos <= h)"))
    # A first conversation shorter than h makes the rest move up.
    gap = F.col("h") - F.coalesce(F.size("taken"), F.lit(0))
    members = saved(members.select("conv_id", "n_own", "h", gap.alias("gap"), "taken"), "conversations")
    taken = members.select("conv_id", F.inline("taken"))
    own = turns.join(members.select("conv_id", "h", "gap"), "conv_id").filter("pos > h")
    own = own.select("conv_id", (F.col("pos") - F.col("gap")).alias("pos"), "turn_id", "words")
    return taken.unionByName(own), members.filter("gap = h AND n_own <= h").select("conv_id")


def halves(pos: Column, turn: Column) -> list[Column]:
    """Two hashes of a turn at its place. The key of a prefix is the exclusive or of those of its turns, so that, like sums,
    keys of long conversations are made over stretches of turns first."""
    return [F.xxhash64(F.lit(i), pos.cast("bigint"), turn) for i in (1, 2)]


def with_prefixes(turns: DataFrame) -> DataFrame:
    """Turns with the keys and words of the prefix ahead of them, and the length and words of their whole conversation."""
    a, b = halves(F.col("pos"), F.col("turn_id"))
    marked = turns.withColumns({"__a": a, "__b": b, "__stretch": F.expr(f"pos div {STRETCH}")})
    keys = ["conv_id", "__stretch"]
    stretches = marked.groupBy(*keys).agg(
        F.bit_xor("__a").alias("__sa"), F.bit_xor("__b").alias("__sb"), F.sum("words").alias("__sw"), F.count("*").alias("__sn")
    )
    before = stretches.select(
        *keys,
        ahead(F.bit_xor("__sa")).alias("__xa"),
        ahead(F.bit_xor("__sb")).alias("__xb"),
        ahead(F.sum("__sw")).alias("__xw"),
        whole(F.sum("__sn")).alias("n_turns"),
        whole(F.sum("__sw")).alias("total"),
    )
    until = Window.partitionBy(*keys).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    within = {f"__r{c}": F.coalesce(f(f"__{c}").over(until), F.lit(0)) for c, f in (("a", F.bit_xor), ("b", F.bit_xor))}
    within["__rw"] = F.coalesce(F.sum("words").over(until), F.lit(0))
    return marked.withColumns(within).join(before, keys).select(
        "conv_id",
        "pos",
        "turn_id",
        "words",
        F.col("__xa").bitwiseXOR(F.col("__ra")).alias("prior_a"),
        F.col("__xb").bitwiseXOR(F.col("__rb")).alias("prior_b"),
        (F.col("__xw") + F.col("__rw")).alias("prior_words"),
        "n_turns",
        "total",
    )


def blocks_of(prefixes: DataFrame, turnless: DataFrame, width: int = WIDTH) -> DataFrame:
    """Conversations cut into rows of ``width`` turns: columns ``t1`` and on hold turn ids, null after the end, and ``w1``
    and on the words of all but the last. A row is keyed by its block's number and the prefix before it. A conversation without turns has one
    empty row."""
    cut = prefixes.withColumns({"block": F.expr(f"(pos - 1) div {width}"), "__place": F.expr(f"(pos - 1) % {width} + 1")})

    def at(place: int, column: str) -> Column:
        return F.max(F.when(F.col("__place") == place, F.col(column)))

    rows = cut.groupBy("conv_id", "block").agg(
        *[at(i + 1, "turn_id").alias(f"t{i + 1}") for i in range(width)],
        *[at(i, "words").alias(f"w{i}") for i in range(1, width)],
        *[at(1, name).alias(name) for name in ("prior_a", "prior_b", "prior_words")],
        *[F.max(name).alias(name) for name in ("n_turns", "total")],
    )
    numbers = ["block", "prior_a", "prior_b", "prior_words", "n_turns", "total"]
    empty = turnless.withColumns({name: F.lit(0).cast("bigint") for name in numbers})
    return rows.unionByName(empty, allowMissingColumns=True)


def rolled_up(blocks: DataFrame, values: str, width: int = WIDTH) -> DataFrame:
    """``values``, aggregates in SQL, for every prefix at once: one ROLLUP over the columns of turns in each block. Adds the
    prefix's ``depth`` and key, the words ahead of its last turn, and its parent's key.

    A set that ends in a column after the end of its conversations is no prefix, and a later block's own root is the last
    prefix of the block before.
    """
    turns = [f"t{i + 1}" for i in range(width)]
    words = ", ".join(["max(prior_words) AS __w0", *[f"max(w{i}) AS __w{i}" for i in range(1, width)]])
    found = blocks.sparkSession.sql(
        f"""
        SELECT block, prior_a, prior_b, {', '.join(turns)}, {words},
               {width} - bit_count(grouping_id()) AS __depth, {values}
        FROM {{blocks}} GROUP BY block, prior_a, prior_b, ROLLUP ({', '.join(turns)})
        """,
        blocks=blocks,
    )
    depth = F.col("__depth")
    last = F.element_at(F.array(*turns), F.greatest(depth, F.lit(1)).cast("int"))
    kept = found.filter((depth > 0) & last.isNotNull() | (depth == 0) & (F.col("block") == 0))

    def key(half: int, upto: Column) -> Column:
        out = F.col(("prior_a", "prior_b")[half])
        for i, turn in enumerate(turns):
            mark = halves(F.col("block") * width + i + 1, F.col(turn))[half]
            out = out.bitwiseXOR(F.when(upto > i, mark).otherwise(F.lit(0)))
        return out

    before = sum((F.when(depth > i, F.col(f"__w{i}")).otherwise(0) for i in range(1, width)), F.col("__w0"))
    marked = kept.withColumns(
        {
            "depth": F.col("block") * width + depth,
            "key_a": key(0, depth),
            "key_b": key(1, depth),
            "up_a": key(0, depth - 1),
            "up_b": key(1, depth - 1),
            "words_ahead": before,
        }
    )
    return marked.drop("block", "prior_a", "prior_b", "__depth", *turns, *[f"__w{i}" for i in range(width)])


def lists_of_ids(ends: DataFrame) -> DataFrame:
    """For each prefix with which conversations end, the SHA-256 of their ids in decimals, ascending and set apart by
    commas.

    Ids are joined to short pieces by ranges first, at most ``IDS_PER_PIECE`` ids each; then every prefix's pieces pass
    through one hash in order. A task holds a batch of pieces, never a list.
    """
    pieces = ends.groupBy("depth", "key_a", "key_b", F.floor(F.col("conv_id") / IDS_PER_PIECE).alias("__range")).agg(
        F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids")
    )
    names = ["depth", "key_a", "key_b"]

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(rows: list) -> pa.RecordBatch:
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            arrays = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, [*names, "ends_sha256"])

        key, digest = None, None
        for batch in batches:
            rows = []
            for *found, ids in zip(*[batch[c].to_pylist() for c in (*names, "ids")], strict=True):
                if found == key:
                    digest.update(b"," + ids.encode())
                    continue
                if key is not None:
                    rows.append((*key, digest.hexdigest()))
                key, digest = found, hashlib.sha256(ids.encode())
            if rows:
                yield done(rows)
        if key is not None:
            yield done([(*key, digest.hexdigest())])

    order = [*names, "__range"]
    schema = "depth bigint, key_a bigint, key_b bigint, ends_sha256 string"
    return pieces.repartition(*names).sortWithinPartitions(*order).select(*names, "ids").mapInArrow(digests, schema)


def prefix_trie(conversations: DataFrame, width: int = WIDTH, **options) -> DataFrame:
    """A row for each distinct prefix of the rebuilt conversations: ``conv_id`` (its smallest member), ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    A conversation that is the smallest member of a prefix is the smallest of all longer ones it has, so each conversation
    owns its prefixes from some depth on. A first ROLLUP finds the owners; then everything about a subtree is a sum over
    its members of what they own, which a second ROLLUP adds up. Only prefixes whose parent has another owner look it up,
    by parent and salt, so the children of a frequent prefix are not gathered.

    Null roles and texts are empty. Turns go by number, those without one first; equal numbers by the hash of role and
    text, so rows that repeat are turns of their own. Rows without a conversation are left out. No conversations give no
    rows; else the root is there, even if no conversation has turns. Options: ``family``, ``forks`` and the names of the
    four columns; see ``rebuilt``. Other columns are left out.
    """
    turns, turnless = rebuilt(conversations, **options)
    prefixes = saved(with_prefixes(turns), "prefixes")
    blocks = saved(blocks_of(prefixes, turnless, width), "turn-blocks")

    owned = rolled_up(blocks, "min(conv_id) AS conv_id, max(n_turns) AS longest", width)
    owners = owned.groupBy("conv_id").agg(
        F.min("depth").alias("first_depth"),
        # The words ahead of the first prefix that a conversation owns.
        F.min_by("words_ahead", "depth").alias("ahead"),
        F.max(F.col("longest") == F.col("depth")).cast("bigint").alias("owns_leaf"),
    )
    shared = blocks.join(owners, "conv_id", "left").withColumns(
        {
            "own": F.coalesce(F.col("total") - F.col("ahead"), F.lit(0)),
            "owns_leaf": F.coalesce("owns_leaf", F.lit(0)),
        }
    )
    values = """
        min(conv_id) AS conv_id, count(*) AS n_convs, sum(owns_leaf) AS n_leaves, sum(total) AS __total, sum(own) AS __own,
        min_by(ahead, conv_id) AS __ahead, min_by(first_depth, conv_id) AS __first, min_by(n_turns, conv_id) AS __turns
    """
    nodes = rolled_up(shared, values, width)
    # Words of all members from this depth on, less those of each distinct prefix below; the owner counts from here on,
    # however little further down it owns.
    distinct = F.col("__own") + F.col("__ahead") - F.col("words_ahead")
    nodes = nodes.withColumns(
        {
            "saved_tokens": F.col("__total") - F.col("n_convs") * F.col("words_ahead") - distinct,
            "__looks_up": (F.col("depth") > 0) & (F.col("depth") == F.col("__first")),
            "__salt": F.pmod(F.xxhash64("conv_id"), F.lit(SALTS)),
            "__follows": (F.col("__turns") > F.col("depth")).cast("bigint"),
        }
    ).drop("__total", "__own", "__ahead", "__first", "__turns", "words_ahead")
    nodes = saved(nodes, "trie-nodes")

    keys = ["depth", "key_a", "key_b"]
    parent = [(F.col("depth") - 1).alias("depth"), F.col("up_a").alias("key_a"), F.col("up_b").alias("key_b")]
    children = nodes.filter("__looks_up").select(*parent, "__salt").groupBy(*keys, "__salt").agg(F.count("*").alias("__n"))
    children = children.groupBy(*keys).agg(F.sum("__n").alias("__others"), F.collect_list("__salt").alias("__salts"))
    a, b = halves(F.col("pos"), F.col("turn_id"))
    ends = prefixes.filter("pos = n_turns").select(
        "conv_id", F.col("pos").alias("depth"), F.col("prior_a").bitwiseXOR(a).alias("key_a"), F.col("prior_b").bitwiseXOR(b).alias("key_b")
    )
    ends = ends.unionByName(turnless.select("conv_id", *[F.lit(0).cast("bigint").alias(name) for name in keys]))
    known = saved(nodes.join(children, keys, "left").join(lists_of_ids(ends), keys, "left"), "trie-children")

    above = known.filter("__salts IS NOT NULL").select(
        (F.col("depth") + 1).alias("depth"),
        F.col("key_a").alias("up_a"),
        F.col("key_b").alias("up_b"),
        F.explode("__salts").alias("__salt"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    found = known.filter("__looks_up").join(above, ["depth", "up_a", "up_b", "__salt"])
    same = known.filter("NOT __looks_up").withColumn("parent_conv_id", F.when(F.col("depth") > 0, F.col("conv_id")))
    return same.unionByName(found).select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        (F.coalesce("__others", F.lit(0)) + F.col("__follows")).alias("n_children"),
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
