"""The quality classifier and language ID: exact parts against brute force, held-out accuracy, odd rows; the pipeline."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from bazaarlens.llm import classifier, language
from bazaarlens.llm.queries import op6_quality_classifier, op7_language_id

SF = "/root/testdata/sf0.01"
ODD = [(1, None), (2, ""), (3, " \n "), (4, "12 34 --"), (5, "日本語"), (None, "the and of"), (6, "word " * 50_000), (7, "q" * 100_000)]


def naive_likelihood(word, probabilities, column, known):
    if not word:
        return 1.0
    total = 0.0 if word[0] in known else probabilities[-1, column] * naive_likelihood(word[1:], probabilities, column, known)
    for n in range(1, len(word) + 1):
        if word[:n] in known:
            total += probabilities[known[word[:n]], column] * naive_likelihood(word[n:], probabilities, column, known)
    return total


def naive_counts(word, probabilities, column, known):
    """Expected pieces from all segmentations listed one by one."""
    found = []

    def walk(rest, taken, chance):
        if not rest:
            found.append((taken, chance))
        for n in range(1, len(rest) + 1):
            if rest[:n] in known:
                walk(rest[n:], [*taken, known[rest[:n]]], chance * probabilities[known[rest[:n]], column])
        if rest and rest[0] not in known:
            walk(rest[1:], taken, chance * probabilities[-1, column])

    walk(word, [], 1.0)
    total, counts = sum(c for _, c in found), {}
    for taken, chance in found:
        for piece in taken:
            counts[piece] = counts.get(piece, 0) + chance / total
    return counts


def test_forward_sums_all_segmentations():
    path = language.vocabulary_path()
    known = language.pieces(path)
    rng = np.random.default_rng(1)
    probabilities = rng.random((len(known) + 1, 3)) / 100
    words = ["the", "thandin", "ñandú", "日本語", "aŷb", "x", "erheoring"]
    found = language.lattice(words, path).likelihoods(probabilities)
    for i, word in enumerate(words):
        for column in range(3):
            assert found[i, column] == pytest.approx(naive_likelihood(word, probabilities, column, known))
    times = np.arange(1.0, len(words) + 1)
    counts = language.lattice(words, path).expected(probabilities, np.arange(len(words)) % 3, times)
    expected = np.zeros_like(counts)
    for i, word in enumerate(words):
        for piece, n in naive_counts(word, probabilities, i % 3, known).items():
            expected[piece, i % 3] += n * times[i]
    assert np.allclose(counts, expected)


@pytest.mark.parametrize("word", ["internationalization" * 5, "ab" * 500, "ที่นี่ไม่มีช่องว่าง".replace(" ", "") * 20, "zß字" * 40])
def test_long_words_are_scored_whole(word):
    path = language.vocabulary_path()
    known = language.pieces(path)
    probabilities = np.random.default_rng(1).dirichlet(np.ones(len(known)), 3).T
    probabilities = np.vstack([probabilities, np.full(3, language.UNKNOWN)])
    found = language.log_likelihoods(["short", word], probabilities, path)
    # Exact sums over all segmentations, by place, in numbers of any size.
    for lang in range(3):
        total = [Fraction(1)]
        for end in range(1, len(word) + 1):
            here = Fraction(0)
            for start in range(max(0, end - 40), end):
                if word[start:end] in known:
                    here += total[start] * Fraction(float(probabilities[known[word[start:end]], lang]))
            if word[end - 1] not in known:
                here += total[end - 1] * Fraction(language.UNKNOWN)
            total.append(here)
        exact = math.log(total[-1].numerator) - math.log(total[-1].denominator)
        assert found[1, lang] == pytest.approx(exact, rel=1e-9)
    one = language.lattice(["short"], path)
    assert np.allclose(found[0], one.log_likelihood(probabilities)) and np.allclose(found[0], np.log(one.likelihoods(probabilities)[0]))
    both = one.expected(probabilities, np.array([2]), np.array([3.0])), one.log_expected(probabilities, 2, 3.0)
    assert np.allclose(*both)
    assert language.lattice([word], path).log_expected(probabilities, 1, 2.0).sum() > 0


def test_marks_stay_with_their_letters():
    assert language.letter_words("हिन्दी, ที่ a1b 12 ́ don't é́x \u0301a") == ["हिन्दी", "ที่", "ab", "", "", "dont", "é́x", "\u0301a"]


def test_languages_of_held_out_documents(spark):
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op7_language_id(spark, SF).collect()
    assert len(rows) == len(langs)
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == langs[r["doc_id"]] for r in held]) >= 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_odd_texts_have_a_language(spark):
    docs = spark.createDataFrame([(i, "uno dos tres el la" if i % 2 else "one two the and of", "es" if i % 2 else "en") for i in range(40)], "doc_id bigint, text string, lang string")
    model = language.train(docs)
    frame = spark.createDataFrame([(*r, 9) for r in ODD], "doc_id bigint, text string, score int")
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.identify(frame, model).collect()}
    assert [found[i][0] for i in (1, 2, 3, 4)] == ["und"] * 4 and found[None][0] == "en"
    assert found[5][0] in ("en", "es") and 0 <= found[7][1] <= 1
    none = language.train(docs.filter("false"))
    assert {r["lang_pred"] for r in language.identify(frame, none).collect()} == {"und"}
    assert language.identify(frame.filter("false"), model).count() == 0


def test_thin_languages_are_learned_beside_a_large_one(spark):
    texts = {"en": "one two the and of", "es": "uno dos tres el la", "de": "eins zwei drei der das"}
    lang = F.when(F.col("id") % 1000 == 7, "es").when(F.col("id") % 1000 == 8, "de").otherwise("en")
    text = F.create_map(*[F.lit(x) for pair in texts.items() for x in pair])
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), lang.alias("lang")).withColumn("text", text[F.col("lang")])
    assert [language.level(x, 100) for x in ([5, 10, 1000], [50, 50], [1, 2], [40] * 4, [])] == [85, 50, 99, 25, 100]
    # A uniform draw would leave 0.01 documents of each thin language.
    model = language.train(docs, train_rows=9, language_rows=3)
    assert model.languages == ["de", "en", "es"]
    usable = docs.filter(~classifier.held_out(F.col("doc_id")))
    n = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}
    assert np.allclose(np.exp(model.prior), [n[x] / sum(n.values()) for x in model.languages])
    # Whole samples of thin languages: learned from their own words.
    model = language.train(docs, train_rows=60, language_rows=20)
    frame = spark.createDataFrame([(x, t) for x, t in texts.items()], "lang string, text string")
    assert all(r["lang"] == r["lang_pred"] for r in language.identify(frame, model).collect())


def test_updates_equal_the_closed_form_of_one_row():
    row = (np.array([5]), np.array([0.5]), 1)
    weights = classifier.follow_the_leader([row], 1)
    # First gradient: (1/2 - 1) * 0.5 for the bucket and -1/2 for the intercept.
    for bucket, gradient in ((5, -0.25), (0, -0.5)):
        expected = (-gradient - classifier.L1) / ((classifier.BETA + abs(gradient)) / classifier.ALPHA + classifier.L2)
        assert weights[bucket] == pytest.approx(expected)
    assert np.count_nonzero(weights) == 2


def test_quality_of_held_out_documents(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    rows = op6_quality_classifier(spark, "/root/testdata/sf0.1").collect()
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in held]) >= 0.97
    assert all(r["predicted"] == 1 for r in held if labels[r["doc_id"]])
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)


def test_odd_texts_have_a_score(spark):
    docs = spark.createDataFrame([(i, "bad ### junk" if i % 2 else "good plain words", "x") for i in range(60)], "doc_id bigint, text string, score string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(60)] + [(None, 1), (3, None), (4, 7)], "doc_id bigint, quality int")
    model = classifier.train(docs, labels)
    again = classifier.train(docs, labels)
    assert (model.weights == again.weights).all()
    frame = spark.createDataFrame([(*r, "old") for r in ODD], "doc_id bigint, text string, score string")
    found = {r["doc_id"]: r["score"] for r in classifier.score(frame, model).collect()}
    assert found[1] == found[2] == found[3] and all(0 <= s <= 1 for s in found.values())
    scores = [r["score"] for r in classifier.score(docs, model).orderBy("doc_id").collect()]
    assert min(scores[::2]) > max(scores[1::2])
    assert (classifier.train(docs, labels.filter("false")).weights == 0).all()


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {}
    rows, at = docs, docs
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"] for r in at.select("doc_id").collect()}
        rows = corpus_pipeline.saved(stage(spark, at, SF), "test-stage")
        kept[name] = {r["doc_id"] for r in rows.select("doc_id").collect()}
        assert kept[name] <= before
        if name != "best-fit packing":
            assert rows.columns == docs.columns
            if name != "mixing sources":
                assert rows.count() == len(kept[name])
        if name == "exact dedup":
            assert rows.select("text").distinct().count() == rows.count() == at.select("text").distinct().count()
        if name == "mixing sources":
            assert rows.groupBy("doc_id").count().filter("count > 2").count() == 0
        at = rows
    assert kept["best-fit packing"] == kept["mixing sources"]
    good = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1").collect()}
    assert good <= kept["quality classifier"]
