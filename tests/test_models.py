"""Features, models, tuning and scores."""

from __future__ import annotations

import math

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from bazaarlens.operators import experiments, features, metrics, models
from bazaarlens.operators.features import FeatureSpec
from bazaarlens.session import scratch_path
from bazaarlens.sources import artefacts

SMALL = {"regParam": [0.1, 0.01], "elasticNetParam": [0.0]}


@pytest.fixture(scope="module")
def rows(spark):
    """300 listings whose log price follows their words, category and reviews."""
    made = []
    for i in range(300):
        brand, tier, reviews = i % 3, i % 2, (i * 37) % 100
        price = 10 ** (2 + 0.5 * brand + 0.2 * tier + 0.01 * reviews)
        made.append(
            (f"u{i}", f"áo brand{brand} {'x ' * (i % 4)}", "aug", f"c{brand}", f"s{i % 2}", "no" if i % 5 else "deep", str(tier), "4.5",
             str(reviews), None, "10", "0.5", "12", "7", f"{price:.6f}")
        )
    names = ["url", *[f.name for f in __import__("bazaarlens.schemas", fromlist=["x"]).MODEL_CSV.fields]]
    return spark.createDataFrame(made, ", ".join(f"{n} string" for n in names)).cache()


def test_missing_numbers_become_zero_and_bad_prices_have_no_label(spark, rows):
    bad = rows.withColumn("price", F.lit("abc")).withColumn("avg_rating", F.lit("x")).withColumn(
        "name_description", F.lit(None).cast("string")
    )
    row = features.prepare(bad).first()
    assert (row.num_sold, row.avg_rating, row.price, row.log_price, row.name_description) == (0.0, 0.0, None, None, "")


def test_vector_is_text_then_categories_then_numbers(rows):
    spec = FeatureSpec()
    prepared = features.prepare(rows)
    row = Pipeline(stages=features.feature_stages(spec)).fit(prepared).transform(prepared).first()
    parts = [row.name_description_features, *[row[f"{n}_onehot"] for n in spec.categories], row.numerics_scaled]
    assert list(row.features.toArray()) == [v for p in parts for v in p.toArray()]
    assert row.features.size == 500 + 2 + 1 + 1 + 1 + 7


def test_scaled_numbers_lie_between_0_and_1_and_constants_in_the_middle(rows):
    prepared = features.prepare(rows)
    scaled = Pipeline(stages=features.scale_stages(FeatureSpec())).fit(prepared).transform(prepared)
    values = [r.v for r in scaled.select(vector_to_array("numerics_scaled").alias("v")).collect()]
    assert all(0 <= x <= 1 for v in values for x in v) and all(v[0] == 0.5 for v in values)


def test_hashed_weights_follow_the_formula(spark):
    from pyspark.ml.feature import HashingTF

    texts = ["a b b", "a c", "A d  e", ""]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    weighted = Pipeline(stages=features.text_stages(FeatureSpec(text="text"))).fit(rows).transform(rows)
    found = {r.i: r.v for r in weighted.select("i", vector_to_array("text_features").alias("v")).collect()}
    place = HashingTF(numFeatures=500).indexOf
    counts = []
    for text in texts:
        words = text.lower().rstrip().split(" ")
        mine = {}
        for word in words:
            mine[place(word)] = mine.get(place(word), 0) + 1
        counts.append(mine)
    for i, mine in enumerate(counts):
        for index in range(500):
            seen = sum(index in other for other in counts)
            weight = math.log((len(texts) + 1) / (seen + 1)) if seen >= 2 else 0.0
            assert found[i][index] == pytest.approx(mine.get(index, 0) * weight, abs=1e-12)


def test_omitted_features_are_left_out_and_unknown_ones_refused(rows):
    prepared = features.prepare(rows)
    spec = FeatureSpec(text_method="count-vectorizer").without("shop_like_tier", "num_sold", "name_description")
    row = Pipeline(stages=features.feature_stages(spec)).fit(prepared).transform(prepared).first()
    assert row.features.size == 2 + 1 + 1 + 6
    with pytest.raises(ValueError, match="shop_review"):
        FeatureSpec().without("shop_review")
    with pytest.raises(ValueError, match="text method"):
        FeatureSpec(text_method="bag")


def test_stages_are_new_on_each_call():
    assert features.feature_stages()[0] is not features.feature_stages()[0]


def test_row_loss_is_counted(spark, rows):
    prepared = features.prepare(rows)
    model = Pipeline(stages=features.feature_stages()).fit(prepared)
    spoiled = prepared.withColumn(
        "first_category", F.when(F.col("url") == "u1", None).when(F.col("url") == "u2", "new").otherwise(F.col("first_category"))
    ).withColumn("log_price", F.when(F.col("url") != "u3", F.col("log_price")))
    assert tuple(features.row_loss(spoiled, model).first()) == (300, 1, 2)
    assert model.transform(spoiled).count() == 298


def test_split_goes_by_key_and_not_by_layout(rows):
    train, test = models.key_split(rows, ("url",))
    again, _ = models.key_split(rows.repartition(7, "price"), ("url",))
    urls = lambda df: {r.url for r in df.collect()}
    assert urls(train) == urls(again) and not urls(train) & urls(test) and len(urls(train) | urls(test)) == 300
    assert 0.6 < len(urls(train)) / 300 < 0.8
    a, b = models.random_split(rows)
    assert a.count() + b.count() == 300


@pytest.mark.parametrize("name", ["lr", "random_forest", "gbt"])
def test_planted_price_is_learned_and_repeats_with_its_seed(spark, rows, name):
    train, test = models.key_split(rows, ("url",))
    params = {"maxIter": 5} if name == "gbt" else {"numTrees": 10} if name == "random_forest" else {}
    scores = []
    for _ in range(2):
        model = models.fit(train, name, **params)
        found = models.predict(model, test)
        assert found.columns == ["price", "log_prediction", "prediction"]
        scores.append(metrics.evaluate(found).first().r2)
    assert scores[0] > 0.7 and scores[0] == pytest.approx(scores[1], abs=1e-12)
    if name == "lr":
        assert scores[0] > 0.9


def test_plain_forest_has_100_trees(rows):
    model = models.fit(rows.limit(60), "random_forest", maxDepth=2)
    assert model.stages[-1].getNumTrees == 100


def test_texts_are_cut_into_words_once_for_a_fit(spark, rows):
    """Fitted stages read hashed words from the written table, and the whole model gives the same vectors."""
    spec = FeatureSpec()
    prepared = features.prepare(rows)
    whole, rest, hashed = features.fit_features(prepared, spec, unread=("name_description", "price", "log_price"))
    assert "name_description_counts" in hashed.columns and not {"name_description", "name_description_words"} & set(hashed.columns)
    old = Pipeline(stages=features.feature_stages(spec)).fit(prepared).transform(prepared).select("url", "features")
    for made in (whole.transform(prepared), rest.transform(hashed)):
        assert {r.url: r.features for r in made.collect()} == {r.url: r.features for r in old.collect()}
    counted = FeatureSpec(text_method="count-vectorizer")
    whole, rest, kept = features.fit_features(prepared, counted)
    assert len(whole.stages) == len(rest.stages) and "name_description" in kept.columns


def test_unknown_model():
    with pytest.raises(ValueError, match="unknown model"):
        models.regressor("svm")


def test_fit_drops_rows_without_label(rows):
    spoiled = rows.withColumn("price", F.when(F.col("url") == "u1", "0").when(F.col("url") == "u2", "").otherwise(F.col("price")))
    assert models.labelled(spoiled, FeatureSpec()).count() == 298
    assert models.fit(spoiled, "lr") is not None


@pytest.mark.parametrize("once", [False, True])
def test_tuning_picks_the_best_point(spark, rows, once):
    tuned = models.tune(rows, "lr", keys=("url",), grid=SMALL, fit_features_once=once)
    assert len(tuned.scores) == 2 and tuned.best_score == max(tuned.scores) > 0.9
    table = tuned.score_table().where("best").collect()
    assert len(table) == 1 and table[0].cv_r2 == tuned.best_score
    assert metrics.evaluate(models.predict(tuned.model, rows)).first().r2 > 0.9


def test_fits_of_a_small_grid_have_few_tasks_and_large_ones_take_turns(rows, monkeypatch):
    """Side by side, 20,000 rows are one task of a fit; of large tables only as many fits as hold the stated rows are at work."""
    assert models.fit_partitions(20_000, models.FEW_ROWS_OF_MANY_FITS) == 1
    assert [models.fit_partitions(n) for n in (300, 20_000, 3_000_000)] == [1, 16, 30]
    assert models.fits_at_once(20_000, 3, 8) == (3, 8)
    assert models.fits_at_once(600_000, 3, 8) == (3, 1)
    assert models.fits_at_once(5_000_000, 3, 8) == (1, 1)
    asked = []
    monkeypatch.setattr(models, "_score_grid", lambda *args: asked.append((args[2].rdd.getNumPartitions(), args[4])) or [0.0])
    monkeypatch.setattr(models, "FEW_ROWS", 50)
    monkeypatch.setattr(models, "ROWS_AT_ONCE", 300)
    models.tune(rows, "gbt", grid={"maxDepth": [2]}, keys=("url",), parallelism=8)
    assert asked == [(1, 1)] * 3


def test_full_grids():
    assert [len(models._param_maps(models.regressor(n), g)) for n, g in models.GRIDS.items()] == [9, 6, 9]


def test_saved_models_predict_the_same(spark, rows):
    model = models.fit(rows, "lr")
    path = scratch_path(spark, "t")
    artefacts.save_model(model, path, overwrite=False)
    with pytest.raises(Exception, match="exists"):
        artefacts.save_model(model, path, overwrite=False)
    artefacts.save_model(model, path)
    pick = lambda m: sorted(r.prediction for r in models.predict(m, rows).collect())
    assert pick(artefacts.load_model(path)) == pick(model)


def test_price_model_saves_itself_and_predicts_from_what_it_loads(spark, rows):
    from bazaarlens.operators.price_model import PriceModel

    path = scratch_path(spark, "t")
    model = PriceModel("lr", path=path, keys=("url",)).tune(rows, grid=SMALL)
    assert model.tuned.best_score > 0.9 and model.evaluate(rows).first().r2 > 0.9
    other = PriceModel("lr", path=path)
    with pytest.raises(ValueError, match="first"):
        other.predict(rows)
    with pytest.raises(ValueError, match="path"):
        PriceModel("lr").predict(rows, load=True)
    pick = lambda df: sorted(r.prediction for r in df.collect())
    assert pick(other.predict(rows, load=True)) == pick(model.predict(rows))
    model.save(scratch_path(spark, "t"))
    assert PriceModel("lr", path=path).fit(rows).predict(rows).count() == 300


def test_experiments_give_one_row_each_on_their_own_predictions(spark, rows):
    chosen = [e for e in experiments.EXPERIMENTS if e.model == "lr"]
    folder = scratch_path(spark, "t")
    found = experiments.run_all(rows, rows, chosen, save_to=folder, keys=("url",), grid=SMALL).collect()
    assert [r.experiment for r in found] == ["linear", "linear_augmented", "linear_counts"]
    assert all(r.rmsle >= 0 and r.r2 > 0.5 for r in found)
    assert len({r.rmsle for r in found}) > 1
    assert artefacts.load_model(f"{folder}/linear") is not None
    assert [e.model for e in experiments.EXPERIMENTS] == ["random_forest", "lr", "gbt", "lr", "lr"]


def test_scores(spark):
    rows = spark.createDataFrame([(10.0, 12.0), (100.0, 90.0), (None, 1.0)], "price double, prediction double")
    found = metrics.evaluate(rows).first()
    assert found.rmsle == pytest.approx(0.13924335796818993, abs=1e-15)
    assert found.rmse == pytest.approx(math.sqrt((4 + 100) / 2))
    assert found.r2 == pytest.approx(1 - 104 / (2 * 45**2))


def test_experiments_run_side_by_side_as_far_as_the_drivers_heap_goes(spark, monkeypatch):
    heap = spark._jvm.java.lang.Runtime.getRuntime().maxMemory()
    pools, given = [], []

    def run(experiment, train, test, save_to, **tuning):
        given.append(tuning["parallelism"])
        return None, (experiment.name, "m", "p", 0.0, 0.0, 0.0)

    pool = experiments.ThreadPool
    monkeypatch.setattr(experiments, "ThreadPool", lambda n: pools.append(n) or pool(n))
    monkeypatch.setattr(experiments, "run", run)
    for share in (heap // 2, heap + 1):
        monkeypatch.setattr(experiments, "EXPERIMENT_HEAP", share)
        monkeypatch.setattr(experiments, "FIT_HEAP", heap // 13)
        found = experiments.run_all(spark.range(1), spark.range(1), parallelism=8, at_once=5)
        assert [row.experiment for row in found.collect()] == [e.name for e in experiments.EXPERIMENTS]
    assert pools == [2, 1] and given == [2] * 5 + [4] * 5
