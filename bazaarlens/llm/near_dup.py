"""Texts alike by the Jaccard similarity of their word n-grams: a MinHash LSH forest, then exact verification."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens.llm.base import saved, small_or_shuffled
from bazaarlens.llm.graph import components
from bazaarlens.llm.words import shingle_set

WORDS = 5
SIMILARITY = Fraction(4, 5)
TREES, DEPTH, STEP = 16, 8, 4
HASHES = TREES * STEP
TARGET_RECALL = 0.9995
# Of 64 signature values, so many are equal in a pair of similarity 0.8 but for one pair in ten million.
LEAST_EQUAL = 35
# Runs up to this size are compared in sorted order; larger ones are cut into parts of so many texts, and every two parts
# meet in a task of their own.
SMALL_RUN, RUN_TEXTS = 32, 1024
BLOCK_TEXTS, BLOCK_SHINGLES = 256, 1_000_000
COLUMNS = 2048
ROWS_SENT = 500
MOST_BROADCAST = 500_000


def prefix_for(similarity: float, trees: int, depth: int, target: float) -> int:
    """The longest prefix whose recall at ``similarity`` meets the target: matches start at full depth and are shortened
    by one hash at a time."""
    while depth > 1 and 1 - (1 - similarity**depth) ** trees < target:
        depth -= 1
    return depth


def _permutations(count: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.Generator(np.random.PCG64(20))
    factors = random.integers(0, 1 << 63, (2, count), dtype=np.uint64)
    return factors[0] * np.uint64(2) + np.uint64(1), factors[1]


def signature(shingles: np.ndarray, factors: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """MinHash values, the upper 32 bits of multiply-add hashes."""
    least = np.full(len(factors[0]), np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(shingles), 2048):
        hashed = shingles[at : at + 2048, None] * factors[0] + factors[1]
        np.minimum(least, (hashed >> np.uint64(32)).astype(np.uint32).min(axis=0), out=least)
    return least


def node_of(shingles: np.ndarray) -> int | None:
    """A 64-bit name for a shingle set; none for the empty set."""
    if not len(shingles):
        return None
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def signatures(docs: DataFrame, text: str, doc_id: str, words: int) -> DataFrame:
    """``(doc_id, node, size, sig, sketch)``: the name of a text's shingle set, its size, the MinHash values as bytes in
    unsigned order, and the last byte of each value. A task holds the shingles of one text at a time."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = _permutations(HASHES)
        for batch in batches:
            nodes, sizes, sigs, sketches = [], [], [], []
            for value in batch.column("text"):
                shingles = shingle_set(value.as_py(), words)
                sig = signature(shingles, factors) if len(shingles) else None
                nodes.append(node_of(shingles))
                sizes.append(len(shingles))
                sigs.append(None if sig is None else sig.astype(">u4").tobytes())
                sketches.append(None if sig is None else sig.astype(np.uint8).tobytes())
            columns = {
                "doc_id": batch.column("doc_id"),
                "node": pa.array(nodes, pa.int64()),
                "size": pa.array(sizes, pa.int64()),
                "sig": pa.array(sigs, pa.binary()),
                "sketch": pa.array(sketches, pa.binary()),
            }
            yield pa.RecordBatch.from_pydict(columns)

    narrow = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return narrow.mapInArrow(signed, "doc_id bigint, node bigint, size bigint, sig binary, sketch binary")


def _pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs within runs of rows that share a prefix, from rows sorted by prefix. What a run needs of the batch before is
    carried over."""
    keys, nodes, sketches = np.empty(0, np.int64), np.empty(0, np.int64), np.empty((0, HASHES), np.uint8)
    for batch in batches:
        if not len(batch):
            continue
        old = len(keys)
        keys = np.concatenate([keys, batch["key"].to_numpy(np.int64)])
        nodes = np.concatenate([nodes, batch["node"].to_numpy(np.int64)])
        sketches = np.concatenate([sketches, np.frombuffer(b"".join(batch["sketch"]), np.uint8).reshape(-1, HASHES)])
        found = []
        for offset in range(1, SMALL_RUN):
            if offset >= len(keys):
                break
            same = keys[offset:] == keys[:-offset]
            if not same.any():
                break
            right = np.flatnonzero(same) + offset
            found.append((right - offset, right))
        left, right = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (list(zip(*found)) or ([], [])))
        new = right >= old
        left, right = left[new], right[new]
        alike = (nodes[left] != nodes[right]) & ((sketches[left] == sketches[right]).sum(axis=1) >= LEAST_EQUAL)
        a, b = nodes[left[alike]], nodes[right[alike]]
        yield pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)}).drop_duplicates()
        keep = max(0, len(keys) - SMALL_RUN + 1)
        keys, nodes, sketches = keys[keep:], nodes[keep:], sketches[keep:]


def smallest_linked(alike: np.ndarray) -> np.ndarray:
    """The lowest place each row of a symmetric matrix leads to."""
    label = np.arange(len(alike))
    while True:
        near = np.where(alike, label[None, :], len(label)).min(axis=1, initial=len(label))
        lower = np.minimum(label, near)
        lower = np.minimum(lower, lower[lower])
        if (lower == label).all():
            return label
        label = lower


def _ties(run: pa.Table) -> pa.Table:
    """Compares all pairs of one part of a run, or across two parts, and gives a row for each text tied to a smaller one: as
    many rows as tie the same texts together, not all pairs."""
    nodes, side = run["node"].to_numpy(), run["side"].to_numpy()
    order = np.lexsort((nodes, side))
    nodes, cut = nodes[order], int((side == 0).sum())
    sketches = np.frombuffer(b"".join(run["sketch"].to_pylist()), np.uint8).reshape(-1, HASHES)[order]
    two = 0 < cut < len(nodes)
    rows, columns = (sketches[:cut], sketches[cut:]) if two else (sketches, sketches)
    across = np.ascontiguousarray(columns.T)
    equal = np.zeros((len(rows), len(columns)), np.uint8)
    for at in range(0, len(rows), 128):
        for value in range(HASHES):
            equal[at : at + 128] += rows[at : at + 128, value, None] == across[value]
    alike = equal >= LEAST_EQUAL
    if two:
        whole = np.zeros((len(nodes), len(nodes)), bool)
        whole[:cut, cut:], whole[cut:, :cut] = alike, alike.T
        alike = whole
    near = nodes[smallest_linked(alike)]
    tied = nodes != near
    a, b = nodes[tied], near[tied]
    return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})


def candidate_pairs(texts: DataFrame, prefix: int) -> DataFrame:
    """Pairs ``(a, b)`` of nodes that tie together all that share a prefix in some tree and whose sketches are close enough.

    Tree t's labels are ``DEPTH`` values from the t-th stretch of the signature on, wrapping around. All texts under one
    prefix are compared with each other. Up to ``SMALL_RUN`` of them stand together in one task; of a prefix that more texts
    share, each text is sent to every part of its run, and the parts are compared two by two in tasks of their own.
    """
    tree = texts.select("node", "sketch", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"), "sig")
    label = F.expr(f"substring(concat(sig, sig), tree * {4 * STEP} + 1, {4 * prefix})")
    rows = tree.select(F.xxhash64("tree", label).alias("key"), "node", "sketch")
    counted = rows.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > SMALL_RUN)
    large = saved(counted.select("key", F.ceil(F.col("n") / RUN_TEXTS).cast("int").alias("parts")), "large-runs")
    large = small_or_shuffled(large, MOST_BROADCAST)
    small = rows.join(large, "key", "left_anti").repartition("key").sortWithinPartitions("key")
    pairs = small.select("key", "node", "sketch").mapInPandas(_pairs, "a bigint, b bigint")
    dealt = dealt_to_parts(rows.join(large, "key"), "key", "node", "sketch")
    ties = dealt.groupBy("key", "low", "high").applyInArrow(_ties, "a bigint, b bigint")
    return pairs.unionByName(ties).distinct()


def dealt_to_parts(rows: DataFrame, group: str, *columns: str) -> DataFrame:
    """Rows of a group of ``parts``, once for every two parts ``(low, high)`` that their own is one of; ``side`` is 1 in
    the higher one of two."""
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    meets = F.expr(
        "transform(sequence(0, parts - 1), other -> named_struct('low', least(part, other), 'high', greatest(part, other),"
        " 'side', if(other < part, 1, 0)))"
    )
    dealt = rows.withColumn("part", part).select("*", F.explode(meets).alias("meet"))
    return dealt.select(group, "meet.low", "meet.high", "meet.side", *columns)


def links_within(sets: list[np.ndarray], side: np.ndarray, similarity: Fraction) -> np.ndarray:
    """Which sets are alike, as a matrix. Where there are two sides, only pairs across them count."""
    sizes = np.array([len(s) for s in sets], np.int64)
    if len(sets) <= 8:
        common = np.zeros((len(sets), len(sets)), np.int64)
        for i, j in combinations(range(len(sets)), 2):
            common[i, j] = common[j, i] = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
    else:
        _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        row = np.repeat(np.arange(len(sets)), sizes)
        shared = count[column] > 1  # the others are in one set only
        row, column = row[shared], np.unique(column[shared], return_inverse=True)[1]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        common = np.zeros((len(sets), len(sets)), np.float32)
        for at in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
            some = slice(np.searchsorted(column, at), np.searchsorted(column, at + COLUMNS))
            part = np.zeros((len(sets), COLUMNS), np.float32)
            part[row[some], column[some] - at] = 1
            common += part @ part.T
        common = common.astype(np.int64)
    up, down = similarity.numerator, similarity.denominator
    alike = common * (up + down) >= up * (sizes[:, None] + sizes[None, :])
    np.fill_diagonal(alike, False)
    if side.any():
        alike &= side[:, None] != side[None, :]
    return alike


def _verifier(similarity: Fraction):
    def verify(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("node", kind="stable").drop_duplicates("node")
        nodes, weights = group["node"].to_numpy(np.int64), group["copies"].to_numpy(np.int64)
        sets = [np.frombuffer(x, np.uint64) for x in group["shingles"]]
        alike = links_within(sets, group["side"].to_numpy() == 1, similarity)
        label = smallest_linked(alike)
        return pd.DataFrame(
            {"node": nodes, "links": alike @ weights, "text_links": alike.sum(axis=1), "label": nodes[label]}
        )

    return verify


def verified_links(blocks: DataFrame, docs: DataFrame, text: str, doc_id: str, words: int, similarity: Fraction) -> DataFrame:
    """Exact links inside blocks ``(node, block, rep, copies, parts)`` as ``(node, links, text_links, label)``, a row for
    each node and part of its block; ``label`` is the smallest node it is linked with there.

    Every text's shingles are sent to its block once. A block that is too large for a task is cut into parts, and every
    two parts are compared in a task of their own.
    """

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_SENT):
                batch = whole.slice(at, ROWS_SENT)
                sets = [shingle_set(value.as_py(), words) for value in batch.column("text")]
                # A repeated id may stand for other texts too.
                own = [node_of(s) == n for s, n in zip(sets, batch.column("node").to_pylist(), strict=True)]
                shingles = pa.array([s.tobytes() for s in sets], pa.binary())
                names = ["node", "block", "copies", "parts"]
                arrays = [*(batch.column(name) for name in names), shingles]
                yield pa.RecordBatch.from_arrays(arrays, [*names, "shingles"]).filter(pa.array(own, pa.bool_()))

    reps = small_or_shuffled(blocks, MOST_BROADCAST).withColumnRenamed("rep", "__rep")
    texts = docs.select(F.col(doc_id).cast("bigint").alias("__id"), F.col(text).alias("text"))
    sets = texts.join(reps, F.col("__id") == F.col("__rep")).select("node", "block", "copies", "parts", "text")
    sets = sets.mapInArrow(shingled, "node bigint, block bigint, copies bigint, parts int, shingles binary")
    dealt = dealt_to_parts(sets, "block", "node", "copies", "shingles")
    return dealt.groupBy("block", "low", "high").applyInPandas(
        _verifier(similarity), "node bigint, links bigint, text_links bigint, label bigint"
    )


def near_duplicates(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    words: int = WORDS,
    similarity: Fraction = SIMILARITY,
    target_recall: float = TARGET_RECALL,
) -> DataFrame:
    """``(doc_id, class_id, n_links, n_text_links, copies)`` for every row.

    Two texts are linked if the Jaccard similarity of their sets of ``words`` successive words is at least
    ``similarity``. A class holds all that links lead to, under its smallest id. ``n_links`` counts the other rows linked
    with a row, ``n_text_links`` the other sets, ``copies`` the rows with the same set.

    Rows with equal sets are one text from the start. Texts that share a prefix in a tree of the LSH forest, shortened
    until ``target_recall`` of pairs at the threshold share one, are tied into blocks; inside blocks all pairs are compared
    exactly, so false candidates go and pairs that no tree brought together are found.

    Texts of fewer words than ``words`` have one shingle, all of their words. Texts without words, null ones too, and
    rows without an id are linked with nothing and stay alone. Repeated rows are copies. Other columns are left out.
    """
    signed = saved(signatures(docs, text, doc_id, words), "signatures")
    texts = saved(
        signed.filter("node IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("node")
        .agg(
            F.min("doc_id").alias("rep"),
            F.count("*").alias("copies"),
            F.max("size").alias("size"),
            F.first("sig").alias("sig"),
            F.first("sketch").alias("sketch"),
        ),
        "texts",
    )
    prefix = prefix_for(float(similarity), TREES, DEPTH, target_recall)
    pairs = saved(candidate_pairs(texts, prefix), "candidate-pairs")
    tied = components(pairs)
    sizes = tied.join(texts.select("node", "rep", "copies", "size"), "node")
    parts = F.greatest(F.ceil(F.count("*") / BLOCK_TEXTS), F.ceil(F.sum("size") / BLOCK_SHINGLES)).cast("int")
    per_block = saved(sizes.groupBy(F.col("label").alias("block")).agg(parts.alias("parts")), "block-sizes")
    blocks = sizes.withColumnRenamed("label", "block").join(small_or_shuffled(per_block, MOST_BROADCAST), "block")
    blocks = saved(blocks.select("node", "block", "rep", "copies", "parts"), "blocks")
    verified = saved(verified_links(blocks, docs, text, doc_id, words, similarity), "verified")
    forest = verified.filter("node <> label").select(F.col("node").alias("a"), F.col("label").alias("b"))
    linked = components(forest)
    counts = verified.groupBy("node").agg(F.sum("links").alias("links"), F.sum("text_links").alias("text_links"))
    # Texts with a link or with copies; all others are alone in their class.
    members = (
        texts.select("node", "rep", "copies")
        .join(linked, "node", "left")
        .join(counts, "node", "left")
        .filter("label IS NOT NULL OR copies > 1")
        .withColumn("label", F.coalesce("label", "node"))
    )
    members = saved(members, "members")
    smallest = saved(members.groupBy("label").agg(F.min("rep").alias("class_id")), "class-ids")
    classes = saved(members.join(small_or_shuffled(smallest, MOST_BROADCAST), "label").drop("rep", "label"), "classes")
    return signed.select("doc_id", F.when(F.col("doc_id").isNotNull(), F.col("node")).alias("node")).join(
        small_or_shuffled(classes, MOST_BROADCAST), "node", "left"
    ).select(
        "doc_id",
        F.coalesce("class_id", "doc_id").alias("class_id"),
        F.expr("coalesce(links, 0) + coalesce(copies, 1) - 1").alias("n_links"),
        F.expr("coalesce(text_links, 0L)").alias("n_text_links"),
        F.expr("coalesce(copies, 1L)").alias("copies"),
    )
