"""Exact dedup and mixing on odd rows, against plain Python."""

from __future__ import annotations

import hashlib
from collections import Counter

import pytest

import __spark_entry__ as contract
from bazaarlens.llm import exact_dedup, mixing
from check import compare, connect

SCHEMA = "doc_id bigint, text string, source string, kept string, size string"


def odd_rows(spark):
    rows = [(1, "a", "s"), (2, "a", "t"), (3, None, "s"), (4, "", None), (5, " a", ""), (5, "a", "s"), (5, "a", "s"), (None, "a", "s")]
    rows += [(None, "only null", None), (None, "only null", "s"), (7, "long " * 100_000, "t")]
    rows += [(100 + i, "hot copy", "s") for i in range(700)] + [(1000 + i, f"text {i}", f"s{i % 7}") for i in range(300)]
    return rows, spark.createDataFrame([(*r, "old", "old") for r in rows], SCHEMA)


@pytest.mark.parametrize("most_places", [exact_dedup.MOST_PLACES, 2048])
def test_groups_of_equal_texts(spark, most_places):
    rows, frame = odd_rows(spark)
    groups = {}
    for key, text, _ in rows:
        groups.setdefault(text or "", []).append(key)
    expected = []
    for key, text, _ in rows:
        ids = groups[text or ""]
        keep = max((i for i in ids if i is not None), default=None)
        expected.append((key, keep, len(ids), key == keep, hashlib.sha256((text or "").encode()).hexdigest()))
    found = exact_dedup.exact_dedup(frame, most_places=most_places)
    assert found.columns == ["doc_id", "text", "source", "size", "keep_id", "group_size", "kept", "text_sha256"]
    assert Counter((r[0], *r[4:]) for r in found.collect()) == Counter(expected)


def test_only_possible_copies_are_shuffled(spark):
    frame = spark.createDataFrame([(i, f"text {i}") for i in range(500)], "doc_id bigint, text string")
    maybe = exact_dedup.exact_dedup(frame).filter("group_size > 1").count()
    assert maybe == 0


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert exact_dedup.exact_dedup(empty).count() == 0
    mixed = mixing.mix(empty)
    assert mixed.targets.count() == mixed.pieces.count() == mixing.words_taken(mixed.pieces).count() == 0


def targets_by_rounds(sizes, weights, share, most):
    """The excess reshared until no source is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full, left = {}, share * sum(sizes.values())
    while True:
        rest = [s for s in order if s not in full]
        total = sum(weight[s] for s in rest)
        over = [s for s in rest if left * weight[s] / total > most * sizes[s]]
        if not over:
            return full | {s: left * weight[s] / total for s in rest}
        for s in over:
            full[s] = most * sizes[s]
        left = share * sum(sizes.values()) - sum(full.values())


def test_mix_of_odd_rows(spark):
    rows, frame = odd_rows(spark)
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
    mixed = mixing.mix(frame, block_words=50)
    targets = targets_by_rounds(sizes, (3, 1, 2), 1.5, 2)
    found = {r["source"]: r for r in mixed.targets.collect()}
    assert {s: r["source_size"] for s, r in found.items()} == dict(sizes)
    for source, target in targets.items():
        assert found[source]["target"] == pytest.approx(target)
    taken = mixing.words_taken(mixed.pieces).collect()
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in taken) == Counter((k, s, len((t or "").split())) for k, t, s in rows)
    per_source = Counter()
    for r in taken:
        assert 0 <= r["taken"] <= 2 * r["size"]
        per_source[r["source"]] += r["taken"]
    for source, target in targets.items():
        assert abs(per_source[source] - target) <= 0.5


def test_schedule_is_even_and_used_once(spark):
    _, frame = odd_rows(spark)
    mixed = mixing.mix(frame, block_words=20)
    slots = [r for r in mixed.pieces.filter("slot IS NOT NULL").select("slot", "source_no", "block").distinct().collect()]
    assert len({r["slot"] for r in slots}) == len(slots)
    words = {r["source_no"]: r["take"] for r in mixed.targets.collect()}
    total = sum(words.values())
    for part in (0.25, 0.5, 0.75):
        first = [r["source_no"] for r in slots if r["slot"] < part * len(slots)]
        for source, take in words.items():
            assert abs(first.count(source) - part * len(slots) * take / total) <= 6


@pytest.mark.parametrize("name", ["op2_exact_dedup", "op10_mixing", "op4_quality_rules", "op5_line_dedup"])
def test_query_equals_sql(spark, sf, name):
    assert compare(contract.queries()[name](spark, sf), connect(sf), contract.oracle_sql()[name]) == []
