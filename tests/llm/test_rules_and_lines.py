"""Quality rules and line dedup on odd rows, against plain Python."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from bazaarlens.llm import line_dedup, quality_rules

TEXTS = [
    None, "", " \t\n", "one", "a b c", "a b c a b c", "a a a a a", "x\n\ny\nx\n x\nx\r", "é ü 日本語 𝄞 # * $%&|<>", "line\nline\nline",
    "w " * 30_000, " ".join(str(i) for i in range(5000)), "a\x0bb\x0cc d", "z" * 1500 + " short words",
]


def measured(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "longest_word": max(map(len, words), default=0),
    }


def test_measurements(spark):
    rng = random.Random(1)
    texts = TEXTS + [" ".join(rng.choice("abc\n") for _ in range(rng.randrange(60))) for _ in range(200)]
    frame = spark.createDataFrame([(i, t, 7, 8) for i, t in enumerate(texts)], "doc_id bigint, text string, n_words int, fail_bits int")
    for row in quality_rules.ledger(frame).collect():
        assert {m: row[m] for m in quality_rules.MEASURES} == measured(texts[row["doc_id"]]), texts[row["doc_id"]]


def test_bits_policies_and_ablation(spark):
    texts = ["good words here and there " * 1 + " ".join(f"w{i}" for i in range(80)), "few", "same again " * 60, "### " * 20 + " ".join(f"w{i}" for i in range(80))]
    rows = quality_rules.ledger(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))
    bits = {r["doc_id"]: r["fail_bits"] for r in rows.collect()}
    mask = quality_rules.mask
    assert bits == {0: 0, 1: mask(("few_words",)), 2: mask(("repeated_words",)), 3: mask(("many_symbols",))}
    kept = {r["doc_id"] for r in rows.filter(~quality_rules.fails(quality_rules.POLICIES["base"])).collect()}
    assert kept == {0, 3}
    found = {(r["policy"], r["rule"]): (r["failed"], r["failed_alone"], r["documents"]) for r in quality_rules.ablation(rows).collect()}
    assert found["base", "few_words"] == (1, 1, 4) and found["v1", "many_symbols"] == (1, 1, 4)
    assert found["v2", "long_words"] == (0, 0, 4) and ("base", "many_symbols") not in found


def test_clean_documents_are_kept(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    good = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").filter("quality = 1")
    rows = quality_rules.ledger(docs).join(good, "doc_id")
    base = rows.filter(~quality_rules.fails(quality_rules.BASE)).count()
    assert rows.filter(~quality_rules.fails(quality_rules.POLICIES["v2"])).count() >= 0.99 * base


def without_boilerplate(rows, least):
    sites = {}
    for _, text, site in rows:
        for line in (text or "").split("\n"):
            if re.search(r"[^\W_]", line):
                sites.setdefault(line.strip(" \t\n\x0b\x0c\r"), set()).add(site or "")
    out = []
    for key, text, _ in rows:
        if text is None:
            out.append((key, None, 0, 0))
            continue
        lines = text.split("\n")
        rest = [x for x in lines if not re.search(r"[^\W_]", x) or len(sites[x.strip(" \t\n\x0b\x0c\r")]) < least]
        out.append((key, "\n".join(rest), len(lines), len(lines) - len(rest)))
    return Counter(out)


def test_lines_on_many_sites_go(spark):
    rng = random.Random(2)
    rows = [(1, None, "a"), (2, "", "a"), (3, "\n\n", None), (None, "shared 3\nmine", "z"), (None, "shared 3\nmine", "z"), (4, "--\n***", "b")]
    rows += [(10 + i, "\n".join(["  shared %d \r" % rng.randrange(12), f"own {i}", "--", "common"]), f"site{rng.randrange(9)}") for i in range(120)]
    rows += [(500, "common\n" * 5000 + "end", "site1"), (501, "common", None)]
    frame = spark.createDataFrame([(*r, "old") for r in rows], "doc_id bigint, text string, source string, n_lines string")
    for least in (2, 5, 8):
        found = line_dedup.drop_boilerplate(frame, min_sites=least).collect()
        assert Counter((r["doc_id"], r["text"], r["n_lines"], r["n_removed"]) for r in found) == without_boilerplate(rows, least)


def test_many_sites_are_estimated(spark):
    rows = [(i, "everywhere\nhalf" if i % 2 else "everywhere", f"site{i}") for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    found = {r["exact"]: r["sites"] for r in line_dedup.boilerplate(frame, min_sites=200).collect()}
    assert found[True] == 200 and abs(found[False] - 400) < 50


def test_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string, source string")
    assert quality_rules.ledger(empty).count() == 0
    assert line_dedup.drop_boilerplate(empty).count() == 0


@pytest.mark.parametrize("name", ["MOST_BROADCAST_DOCS", "MOST_BROADCAST_PLACES"])
def test_lines_go_the_same_without_a_broadcast(spark, monkeypatch, name):
    rows = [(i, f"own {i}\nshared line\nother shared line", f"s{i % 9}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    expected = sorted(line_dedup.drop_boilerplate(docs).collect())
    monkeypatch.setattr(line_dedup, name, 3)
    found = line_dedup.drop_boilerplate(docs)
    assert sorted(found.collect()) == expected and {r.n_removed for r in expected} == {2}
