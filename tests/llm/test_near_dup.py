"""The n-gram Jaccard join against all pairs compared one by one."""

from __future__ import annotations

from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from bazaarlens.llm import near_dup
from bazaarlens.llm.graph import components


def shingles(text, size=5):
    words = (text or "").encode().split()
    if 0 < len(words) < size:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def brute_force(docs, similarity=Fraction(4, 5)):
    """Rows as the operator gives them, from all pairs of distinct sets that share a shingle."""
    sets = {}
    for key, text in docs:
        if key is not None and shingles(text):
            sets.setdefault(shingles(text), []).append(key)
    order = list(sets)
    holders = {}
    for i, s in enumerate(order):
        for x in s:
            holders.setdefault(x, []).append(i)
    links = {i: set() for i in range(len(order))}
    for i, s in enumerate(order):
        common = Counter(j for x in s for j in holders[x] if j > i)
        for j, n in common.items():
            if Fraction(n, len(s) + len(order[j]) - n) >= similarity:
                links[i].add(j)
                links[j].add(i)
    rows = []
    place = {s: i for i, s in enumerate(order)}
    for key, text in docs:
        if key is None or not shingles(text):
            rows.append((key, key, 0, 0, 1))
            continue
        reached, todo = set(), [place[shingles(text)]]
        while todo:
            at = todo.pop()
            if at not in reached:
                reached.add(at)
                todo.extend(links[at])
        i = place[shingles(text)]
        copies = len(sets[order[i]])
        smallest = min(k for j in reached for k in sets[order[j]])
        rows.append((key, smallest, sum(len(sets[order[j]]) for j in links[i]) + copies - 1, len(links[i]), copies))
    return rows


def result(frame):
    return [(r["doc_id"], r["class_id"], r["n_links"], r["n_text_links"], r["copies"]) for r in frame.collect()]


def changed(rng, words, edits):
    words = list(words)
    for at in rng.integers(0, len(words), edits):
        words[at] = f"x{rng.integers(1 << 30)}"
    return words


def test_small_groups_odd_rows_and_a_large_group(spark):
    rng = np.random.default_rng(3)
    docs = [(1, None), (2, ""), (3, " \n"), (None, "a b c d e f"), (4, "one two"), (5, "one  two"), (6, "one two three")]
    docs += [(7, "a b c d e f"), (8, "a b c d e f"), (8, "a b c d e f"), (9, "a b c d e g")]
    key = 100
    for size in (2, 3, 7, 40, 330):
        base = [f"w{rng.integers(5000)}" for _ in range(200)]
        for _ in range(size):
            docs.append((key, " ".join(changed(rng, base, rng.integers(0, 5)))))
            key += 1
    docs.append((key, "long " * 50_000 + " ".join(f"y{i}" for i in range(3000))))
    frame = spark.createDataFrame([(k, t, 1, 2) for k, t in docs], "doc_id bigint, text string, node int, size int")
    assert Counter(result(near_dup.near_duplicates(frame))) == Counter(brute_force(docs))


def test_query_equals_all_pairs(spark):
    from bazaarlens.llm.queries import op1_ngram_jaccard_join

    sf = "/root/testdata/sf0.01"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert Counter(result(op1_ngram_jaccard_join(spark, sf))) == Counter(brute_force(docs))


def test_no_rows(spark):
    assert near_dup.near_duplicates(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_prefixes_are_shortened_to_the_target():
    assert near_dup.prefix_for(0.8, 16, 8, 0.9995) == 4
    assert near_dup.prefix_for(0.99, 16, 8, 0.9995) == 8
    assert near_dup.prefix_for(0.1, 2, 8, 0.9999) == 1


@pytest.mark.parametrize("sided", [False, True])
def test_matrix_equals_pairs(sided):
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 40, 30).astype(np.uint64)) for _ in range(60)]
    side = (np.arange(60) % 2 == 1) & sided
    alike = near_dup.links_within(sets, side, Fraction(1, 2))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            n = len(np.intersect1d(a, b))
            expected = i != j and 2 * n >= len(a) + len(b) - n and (not sided or side[i] != side[j])
            assert alike[i, j] == expected


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1500), (1500, 1200)]
    found = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {(r["node"], r["label"]) for r in found} == {(i, 0) for i in range(201)} | {(i, 1000) for i in (1000, 1200, 1500)}


def test_alike_texts_far_apart_under_one_prefix(spark, monkeypatch):
    """Texts that share only the first tree's prefix, and stand at both ends of a run of many others."""
    rng = np.random.default_rng(11)

    def signed(node, values):
        values = np.array(values, np.uint64).astype(">u4")
        return node, bytearray(values.tobytes()), bytearray(values.astype(np.uint8).tobytes())

    count = 3 * near_dup.SMALL_RUN
    rows, expected = [], set()
    for n in range(count):
        values = rng.integers(1 << 20, 1 << 31, near_dup.HASHES)
        values[:4] = 7
        other = values.copy()
        values[4::4], other[4::4] = n, (1 << 32) - 1 - n
        rows += [signed(n, values), signed(10_000 + n, other)]
        expected.add((n, 10_000 + n))
    texts = spark.createDataFrame(rows, "node bigint, sig binary, sketch binary")
    for part in (1024, 50):
        monkeypatch.setattr(near_dup, "RUN_TEXTS", part, raising=False)
        assert {(r["a"], r["b"]) for r in near_dup.candidate_pairs(texts, 4).collect()} == expected


def test_ties_of_a_part_hold_its_texts_together():
    sketches = np.random.default_rng(2).integers(0, 256, (6, near_dup.HASHES)).astype(np.uint8)
    sketches[3] = sketches[5] = sketches[0]
    nodes = np.array([10, 11, 12, 13, 14, 15])
    for side, expected in (([0] * 6, {(10, 13), (10, 15)}), ([0, 0, 0, 1, 1, 1], {(10, 13), (10, 15)}), ([0, 0, 0, 0, 1, 1], {(10, 15), (10, 13)})):
        run = pa.table({"node": nodes, "side": side, "sketch": [s.tobytes() for s in sketches]})
        assert {tuple(r.values()) for r in near_dup._ties(run).to_pylist()} == expected
