"""Price models: splitting, fitting, tuning, predicting.

A model is one ``PipelineModel`` from prepared rows to ``log_prediction``. Estimators always get a seed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import cached_property
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel
from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.base import Estimator
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from bazaarlens.constants import SPLIT_SEED, SPLIT_WEIGHTS
from bazaarlens.functions.numbers import price_from_log
from bazaarlens.operators import forests, moments, wide
from bazaarlens.operators.features import FEATURES, LABEL, FeatureSpec, feature_stages, fit_features, prepare
from bazaarlens.session import written

LOG_PREDICTION = "log_prediction"
PLAIN_FOREST_TREES = 100
# Rows in a partition of those a model is fitted on: few as long as there are few partitions. Trees draw their rows by
# partition, so the number follows from the rows, not from the cluster.
FIT_PARTITIONS, FEW_ROWS, MANY_ROWS = 16, 1_000, 100_000
# Fits of a grid run side by side, so each gets fewer tasks: every task of every level of every tree costs a few
# milliseconds on top of its rows. Rows that fits at work hold at once, some 4 KB each while trees grow.
FEW_ROWS_OF_MANY_FITS, ROWS_AT_ONCE = 25_000, 2_000_000
# A grid of forests is one fit a fold, which so few fits need more tasks for.
FEW_ROWS_OF_ONE_FIT = 3_000

# The grids that are searched.
GRIDS: dict[str, dict[str, Sequence[float]]] = {
    "random_forest": {"maxDepth": [2, 5, 10], "numTrees": [5, 20, 50]},
    "lr": {"regParam": [0.1, 0.01], "elasticNetParam": [0.0, 0.5, 1.0]},
    "gbt": {"maxBins": [10, 20, 40], "maxDepth": [2, 5, 10]},
}


def regressor(name: str, seed: int = SPLIT_SEED, **params) -> Estimator:
    columns = {"featuresCol": FEATURES, "labelCol": LABEL, "predictionCol": LOG_PREDICTION}
    if name == "lr":
        return LinearRegression(**columns, **params)
    if name == "random_forest":
        return RandomForestRegressor(**columns, seed=seed, **params)
    if name == "gbt":
        return GBTRegressor(**columns, seed=seed, **params)
    raise ValueError(f"unknown model {name!r}, expected one of {sorted(GRIDS)}")


# --- splitting -------------------------------------------------------------------------------------------------------


def hash_bucket(keys: Iterable[str], buckets: int, seed: int = SPLIT_SEED) -> Column:
    """A number below ``buckets`` that depends on the key values alone, not on how rows are laid out or recomputed."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    return (F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("bigint") % buckets).cast("int")


def key_split(
    df: DataFrame, keys: Sequence[str], train_share: float = SPLIT_WEIGHTS[0], seed: int = SPLIT_SEED
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a hash of their key: the same rows on any cluster."""
    bucket = hash_bucket(keys, 1000, seed)
    cut = round(train_share * 1000)
    return df.where(bucket < cut), df.where(bucket >= cut)


def random_split(
    df: DataFrame, weights: Sequence[float] = SPLIT_WEIGHTS, seed: int = SPLIT_SEED
) -> tuple[DataFrame, DataFrame]:
    """Spark's own random split. Its rows change with the partition layout, so split a written table."""
    train, test = df.randomSplit(list(weights), seed=seed)
    return train, test


# --- fitting ---------------------------------------------------------------------------------------------------------


def labelled(df: DataFrame, spec: FeatureSpec, keys: Sequence[str] = ()) -> DataFrame:
    """Prepared rows that have a label, cut down to the columns a fit reads."""
    columns = dict.fromkeys([*keys, spec.text, *spec.categories, *spec.numerics, "price", LABEL])
    return prepare(df, spec).where(F.col(LABEL).isNotNull()).select(*columns)


def fit_partitions(rows: int, few_rows: int = FEW_ROWS) -> int:
    return max(1, min(FIT_PARTITIONS, -(-rows // few_rows)), -(-rows // MANY_ROWS))


def fits_at_once(rows: int, folds: int, parallelism: int) -> tuple[int, int]:
    """Folds at work at once and fits of each, so that together they hold about ``ROWS_AT_ONCE`` rows or are one fit."""
    fits = max(1, min(folds * parallelism, ROWS_AT_ONCE // max(1, rows)))
    folds_at_once = min(folds, fits)
    return folds_at_once, fits // folds_at_once


def laid_out(rows: DataFrame, partitions: int | None = None, by: Sequence[str] = ()) -> DataFrame:
    """The rows in a layout that follows from their values alone, those of the columns ``by`` if named: the same on any cluster."""
    partitions = partitions or fit_partitions(rows.count())
    columns = sorted(by or rows.columns)
    return rows.repartition(partitions, F.xxhash64(*columns)).sortWithinPartitions(*columns)


def fit(
    train: DataFrame,
    model_name: str = "random_forest",
    spec: FeatureSpec = FeatureSpec(),
    seed: int = SPLIT_SEED,
    partitions: int | None = None,
    **params,
) -> PipelineModel:
    """Fits features and regressor. Prepared rows are written down first, since every fitted stage reads them; what the
    regressor reads is laid out by value."""
    if model_name == "random_forest":
        params.setdefault("numTrees", PLAIN_FOREST_TREES)
    columns = labelled(train, spec)
    features, rest, rows = fit_features(columns, spec)
    points = rest.transform(laid_out(rows, partitions, columns.columns)).select(FEATURES, LABEL)
    return _chain(features, regressor(model_name, seed, **params).fit(points))


def predict(
    model: PipelineModel, df: DataFrame, spec: FeatureSpec = FeatureSpec(), keys: Sequence[str] = ()
) -> DataFrame:
    """``(price, log_prediction, prediction)``, behind the ``keys``, for the rows whose categories the model knows."""
    scored = model.transform(prepare(df, spec))
    return scored.select(*keys, "price", LOG_PREDICTION, price_from_log(F.col(LOG_PREDICTION)).alias("prediction"))


# --- tuning ----------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class TunedModel:
    """Every grid point with its mean score over the folds, and the model refitted with the best of them when first asked for."""

    refit: Callable[[], PipelineModel]
    grid: tuple[dict[str, float], ...]
    scores: tuple[float, ...]

    @cached_property
    def model(self) -> PipelineModel:
        return self.refit()

    @property
    def best_index(self) -> int:
        return max(range(len(self.scores)), key=self.scores.__getitem__)

    @property
    def best_params(self) -> dict[str, float]:
        return self.grid[self.best_index]

    @property
    def best_score(self) -> float:
        return self.scores[self.best_index]

    def score_table(self) -> DataFrame:
        """One row per grid point: parameters, mean r2, and whether it is the best."""
        rows = [
            (i, describe(point), float(score), i == self.best_index)
            for i, (point, score) in enumerate(zip(self.grid, self.scores, strict=True))
        ]
        return SparkSession.active().createDataFrame(rows, "point int, params string, cv_r2 double, best boolean")


def describe(params: dict[str, float]) -> str:
    return ", ".join(f"{name}={value:g}" for name, value in sorted(params.items()))


def _param_maps(estimator: Estimator, grid: dict[str, Sequence[float]]) -> list[dict]:
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), list(values))
    return builder.build()


def _named(maps: list[dict]) -> list[dict[str, float]]:
    return [{param.name: value for param, value in point.items()} for point in maps]


def _r2() -> RegressionEvaluator:
    return RegressionEvaluator(predictionCol=LOG_PREDICTION, labelCol=LABEL, metricName="r2")


def _score_grid(
    estimator: Estimator, maps: list[dict], fit_rows: DataFrame, check_rows: DataFrame, parallelism: int
) -> list[float]:
    """r2 of every grid point, several points at a time."""
    fitted = estimator.fitMultiple(fit_rows, maps)
    evaluator = _r2()

    def score(_: int) -> tuple[int, float]:
        index, model = next(fitted)
        return index, evaluator.evaluate(model.transform(check_rows))

    with ThreadPool(min(parallelism, len(maps))) as pool:
        scores = dict(pool.imap_unordered(inheritable_thread_target(fit_rows.sparkSession)(score), range(len(maps))))
    return [scores[i] for i in range(len(maps))]


def _fold_scores(
    rows: DataFrame, fold: int, spec: FeatureSpec, estimator: Estimator, maps: list[dict], parallelism: int
) -> list[float]:
    """r2 of every grid point on one fold, with features fitted on the other folds."""
    fit_part, check_part = rows.where(F.col("fold") != fold), rows.where(F.col("fold") == fold)
    features = Pipeline(stages=feature_stages(spec)).fit(fit_part)
    one = forests.from_one(estimator, points := _named(maps))
    partitions = fit_partitions(fit_part.count(), FEW_ROWS_OF_ONE_FIT if one else FEW_ROWS_OF_MANY_FITS)
    fit_rows, check_rows = (
        features.transform(part).select(FEATURES, LABEL).persist(StorageLevel.MEMORY_AND_DISK)
        for part in (laid_out(fit_part, partitions), check_part)
    )
    try:
        if one:
            return forests.scores(estimator, points, fit_rows, check_rows)
        return _score_grid(estimator, maps, fit_rows, check_rows, parallelism)
    finally:
        fit_rows.unpersist()
        check_rows.unpersist()


def tune(
    train: DataFrame,
    model_name: str = "random_forest",
    spec: FeatureSpec = FeatureSpec(),
    folds: int = 3,
    seed: int = SPLIT_SEED,
    keys: Sequence[str] = (),
    grid: dict[str, Sequence[float]] | None = None,
    parallelism: int = 4,
    fit_features_once: bool = False,
) -> TunedModel:
    """Cross-validated search of a model's grid by r2 on the log price, then a refit on all rows.

    Features are fitted on the training rows of each fold and shared by the whole grid: no fold sees its own check rows,
    at one feature fit per fold. ``fit_features_once`` fits them on all rows before folding instead. Folds go by a hash of
    ``keys`` (of all model columns when none are given), so a task that is run again puts each row in the same fold. Rows
    are laid out by their values, so neither the cluster nor the files change what a forest draws.

    Penalised linear models with hashed words are scored from sums over the folds (``moments``) up to
    ``moments.MOST_FEATURES`` features, wider ones by passes that folds and points share (``wide``). Forests that differ in trees and depth alone are scored from the largest one of each fold (``forests``). The
    best point is fitted on all rows when ``model`` is first read: by Spark, but wide linear ones by the same passes.
    """
    estimator = regressor(model_name, seed)
    grid = grid or GRIDS[model_name]
    maps = _param_maps(estimator, grid)
    points = tuple(_named(maps))
    rows = labelled(train, spec, keys)
    rows = written(rows.withColumn("fold", hash_bucket(keys or rows.columns, folds, seed)), "tune-rows")

    by_sums = _by_sums(model_name, spec, grid)
    narrow = by_sums and _is_hashed(spec) and moments.feature_count(rows, spec) <= moments.MOST_FEATURES

    def refitted() -> PipelineModel:
        features = Pipeline(stages=feature_stages(spec)).fit(rows)
        best = max(range(len(scores)), key=scores.__getitem__)
        if by_sums and not narrow:
            return _chain(features, wide.fitted(estimator, features.transform(rows), points[best]))
        return _chain(features, estimator.fit(features.transform(laid_out(rows)).select(FEATURES, LABEL), maps[best]))

    refit = refitted
    if by_sums:
        by_fold = (moments if narrow else wide).linear_scores(rows, spec, points, folds, fit_features_once)
        scores = [float(sum(point) / folds) for point in zip(*by_fold, strict=True)]
    elif fit_features_once:
        features = Pipeline(stages=feature_stages(spec)).fit(rows)
        search = CrossValidator(
            estimator=estimator,
            estimatorParamMaps=maps,
            evaluator=_r2(),
            numFolds=folds,
            foldCol="fold",
            parallelism=parallelism,
        ).fit(features.transform(laid_out(rows)).select(FEATURES, LABEL, "fold"))
        scores, refit = list(search.avgMetrics), lambda: _chain(features, search.bestModel)
    else:
        # Fits of one fold leave gaps that those of the others fill.
        folds_at_once, fits = fits_at_once(rows.count(), folds, parallelism)
        with ThreadPool(folds_at_once) as pool:
            one = inheritable_thread_target(rows.sparkSession)(
                lambda fold: _fold_scores(rows, fold, spec, estimator, maps, fits)
            )
            by_fold = pool.map(one, range(folds), chunksize=1)
        scores = [sum(point) / folds for point in zip(*by_fold, strict=True)]
    return TunedModel(refit, points, tuple(scores))


def _by_sums(model_name: str, spec: FeatureSpec, grid: dict[str, Sequence[float]]) -> bool:
    """Whether scores follow from sums over the rows: penalised linear models."""
    return model_name == "lr" and set(grid) == {"regParam", "elasticNetParam"} and min(grid["regParam"]) > 0


def _is_hashed(spec: FeatureSpec) -> bool:
    return spec.text_method == "tf-idf" or spec.text in spec.omit


def _chain(features: PipelineModel, best: Model) -> PipelineModel:
    return PipelineModel([*features.stages, best])
