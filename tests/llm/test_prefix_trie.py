"""The prefix trie against one built node by node, on odd and on random conversations."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

import __spark_entry__ as contract
from bazaarlens.llm import prefix_trie
from check import compare, connect

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def built(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, (role or "", text or "")))

    def place(row):
        role, text = row[2]
        return (*row[:2], hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16])

    own = {conv: [r[2] for r in sorted(turns, key=place)] for conv, turns in own.items()}
    out = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 4
        base = conv - (conv % 20 if conv >= 0 else -(-conv % 20))
        out[conv] = tuple(own.get(base, [])[:h] + turns[h:])
    return out


def node_by_node(rows):
    members = {}
    for conv, turns in built(rows).items():
        for depth in range(len(turns) + 1):
            members.setdefault(turns[:depth], {})[conv] = len(turns) == depth
    saved = {p: (len(m) - 1) * (len(p[-1][1].encode().split()) if p else 0) for p, m in members.items()}
    children = dict.fromkeys(members, 0)
    for prefix in members:
        if prefix:
            children[prefix[:-1]] += 1
    leaves, below = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for prefix in members:
        for depth in range(len(prefix) + 1):
            below[prefix[:depth]] += saved[prefix]
            leaves[prefix[:depth]] += children[prefix] == 0
    return sorted(
        (
            min(m), len(prefix), min(members[prefix[:-1]]) if prefix else -(10**9), len(m), children[prefix], leaves[prefix], below[prefix],
            hashlib.sha256(",".join(map(str, sorted(c for c, ends in m.items() if ends))).encode()).hexdigest(),
        )
        for prefix, m in members.items()
    )


def found(frame, **options):
    rows = prefix_trie.prefix_trie(frame, **options).collect()
    return sorted(tuple(-(10**9) if r[c] is None else r[c] for c in COLUMNS) for r in rows)


ODD = [
    (0, 0, "user", "hello there"), (0, 1, "bot", "hi"), (0, None, None, None), (0, None, "user", "first\tof all"), (0, 1, "bot", "hi"),
    (1, 5, "user", "x"), (2, 0, "us", "er hello"), (2, 1, "user", " hello"), (3, 0, None, None), (3, None, "", ""), (20, 0, "user", "only one"),
    (21, 0, "a", "b"), (21, 1, "c", "d"), (21, 2, "e", "f g h"), (45, 0, "a", "base is absent"), (45, 1, "b", "so it moves up"), (46, 0, "q", ""),
    (None, 0, "user", "nobody's"), (None, 1, "user", "nobody's"), (-7, 0, "user", "negative"), (-20, 0, "user", "its base"), (-7, 1, "u", "v"),
]


def test_odd_rows(spark):
    long = [(60, i, "user" if i % 2 else "bot", f"turn {i}") for i in range(45)]
    long += [(61, i, "user" if i % 2 else "bot", f"turn {i}") for i in range(45)] + [(62, 0, "user", "word " * 50_000)]
    frame = spark.createDataFrame([(*r, 1, 2, "t") for r in ODD + long], SCHEMA + ", pos int, depth int, t1 string")
    assert found(frame) == node_by_node(ODD + long)


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("width", [1, 3, 8])
def test_random_conversations(spark, seed, width):
    rng = random.Random(seed)
    rows = []
    for conv in rng.sample(range(300), 120):
        for turn in range(rng.randrange(0, 12)):
            rows.append((conv, turn, rng.choice(["user", "bot"]), rng.choice(["a", "b b", "c c c"]) if turn < 3 else f"t{rng.randrange(3)}"))
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert found(frame, width=width) == node_by_node(rows)


def test_long_conversations_are_ranked_and_keyed_by_stretches(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "STRETCH", 3)
    monkeypatch.setattr(prefix_trie, "IDS_PER_PIECE", 2)
    rng = random.Random(9)
    rows = [(conv, turn, "user", f"t{turn // 9}") for conv in range(40) for turn in range(rng.choice([1, 10, 30]))]
    rng.shuffle(rows)
    assert found(spark.createDataFrame(rows, SCHEMA)) == node_by_node(rows)


def test_many_conversations_that_end_alike_and_many_that_begin_alike(spark):
    rows = [(i, 0, "system", "same") for i in range(0, 3000)] + [(i, 1, "user", f"text {i}") for i in range(0, 3000, 2)]
    assert found(spark.createDataFrame(rows, SCHEMA)) == node_by_node(rows)


def test_no_conversations_and_none_with_turns(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == []
    # h is 3 for 5 and the first of its family is absent, so nothing is left.
    assert zlib.crc32(b"5") % 4 > 0
    rows = [(5, 0, "user", "gone")]
    assert found(spark.createDataFrame(rows, SCHEMA)) == node_by_node(rows)
    assert len(node_by_node(rows)) == 1


def test_query_equals_sql(spark, sf):
    name = "op13_prefix_trie"
    assert compare(contract.queries()[name](spark, sf), connect(sf), contract.oracle_sql()[name]) == []
