"""Feature preparation and the feature stages of the price models."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.base import Estimator
from pyspark.ml.feature import (
    IDF,
    HashingTF,
    MinMaxScaler,
    OneHotEncoder,
    StringIndexer,
    Tokenizer,
    VectorAssembler,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens.functions.numbers import log_price, to_double
from bazaarlens.operators.vocabulary import MOST_WORDS, TermCounts
from bazaarlens.schemas import MODEL_CATEGORIES, MODEL_NUMERICS
from bazaarlens.session import written

LABEL = "log_price"
FEATURES = "features"
TEXT_METHODS = ("tf-idf", "count-vectorizer")

Stage = Estimator | Transformer


@dataclass(frozen=True)
class FeatureSpec:
    """Which columns become features and how. ``omit`` leaves named columns out of the final vector."""

    text: str = "name_description"
    categories: tuple[str, ...] = MODEL_CATEGORIES
    numerics: tuple[str, ...] = MODEL_NUMERICS
    text_method: str = "tf-idf"
    min_doc_freq: int = 2
    hash_width: int = 500
    most_words: int = MOST_WORDS
    omit: frozenset[str] = frozenset()

    def __post_init__(self) -> None:
        if self.text_method not in TEXT_METHODS:
            raise ValueError(f"unknown text method {self.text_method!r}, expected one of {TEXT_METHODS}")
        unknown = set(self.omit) - {self.text, *self.categories, *self.numerics}
        if unknown:
            raise ValueError(f"cannot omit {sorted(unknown)}: no such feature")

    def without(self, *names: str) -> FeatureSpec:
        return replace(self, omit=self.omit | set(names))

    def kept(self, names: tuple[str, ...]) -> list[str]:
        return [name for name in names if name not in self.omit]


def prepare(df: DataFrame, spec: FeatureSpec = FeatureSpec()) -> DataFrame:
    """Types the model columns: numbers as double with 0 for missing ones, text never null, and the label added."""
    return df.withColumns(
        {
            **{name: F.coalesce(to_double(F.col(name)), F.lit(0.0)) for name in spec.numerics},
            spec.text: F.coalesce(F.col(spec.text), F.lit("")),
            "price": to_double(F.col("price")),
        }
    ).withColumn(LABEL, log_price(F.col("price")))


def text_stages(spec: FeatureSpec) -> list[Stage]:
    """Words of the text column to ``<text>_features``."""
    words, counts, output = (f"{spec.text}_{part}" for part in ("words", "counts", "features"))
    tokenizer = Tokenizer(inputCol=spec.text, outputCol=words)
    if spec.text_method == "count-vectorizer":
        return [tokenizer, TermCounts(inputCol=words, outputCol=output, mostWords=spec.most_words)]
    return [
        tokenizer,
        HashingTF(inputCol=words, outputCol=counts, numFeatures=spec.hash_width),
        IDF(inputCol=counts, outputCol=output, minDocFreq=spec.min_doc_freq),
    ]


def index_stage(spec: FeatureSpec) -> StringIndexer:
    """Category labels to numbers, most frequent first. Rows with a null or unknown label are dropped."""
    return StringIndexer(
        inputCols=list(spec.categories),
        outputCols=[f"{name}_index" for name in spec.categories],
        handleInvalid="skip",
    )


def onehot_stage(spec: FeatureSpec) -> OneHotEncoder:
    kept = spec.kept(spec.categories)
    return OneHotEncoder(inputCols=[f"{n}_index" for n in kept], outputCols=[f"{n}_onehot" for n in kept])


def scale_stages(spec: FeatureSpec) -> list[Stage]:
    """Numerics to [0, 1], column by column but in one vector, so that fitting takes one pass over the rows."""
    return [
        VectorAssembler(inputCols=spec.kept(spec.numerics), outputCol="numerics"),
        MinMaxScaler(inputCol="numerics", outputCol="numerics_scaled"),
    ]


def feature_stages(spec: FeatureSpec = FeatureSpec()) -> list[Stage]:
    """Unfitted stages from prepared rows to ``features``: text, then categories, then numerics. A new list each call."""
    stages: list[Stage] = []
    inputs: list[str] = []
    if spec.categories:
        stages.append(index_stage(spec))
    if spec.text not in spec.omit:
        stages += text_stages(spec)
        inputs.append(f"{spec.text}_features")
    if spec.kept(spec.categories):
        stages.append(onehot_stage(spec))
        inputs += [f"{name}_onehot" for name in spec.kept(spec.categories)]
    if spec.kept(spec.numerics):
        stages += scale_stages(spec)
        inputs.append("numerics_scaled")
    return [*stages, VectorAssembler(inputCols=inputs, outputCol=FEATURES)]


def fit_features(
    rows: DataFrame, spec: FeatureSpec = FeatureSpec(), unread: Sequence[str] = ()
) -> tuple[PipelineModel, PipelineModel, DataFrame]:
    """All feature stages fitted on prepared rows; those of them that are left once words are hashed; and the written rows
    with hashed words that those take, without the columns ``unread``. So a text is cut into words once, not by each stage
    that is fitted behind it."""
    stages = feature_stages(spec)
    early = [s for s in stages if isinstance(s, Tokenizer | HashingTF)] if spec.text_method == "tf-idf" else []
    hashed = PipelineModel(early).transform(rows)
    rows = written(hashed.drop(*unread, *[s.getOutputCol() for s in early if isinstance(s, Tokenizer)]), "fit-rows")
    rest = Pipeline(stages=[s for s in stages if s not in early]).fit(rows)
    fitted = iter(rest.stages)
    return PipelineModel([s if s in early else next(fitted) for s in stages]), rest, rows


def row_loss(prepared: DataFrame, model: PipelineModel) -> DataFrame:
    """How many rows go in, lack a label, and are dropped by the category index, counted in one pass.

    A copy of the index that keeps all rows gives unknown labels the number behind the last known one.
    """
    indexer = model.stages[0].copy()
    indexer.setHandleInvalid("keep")
    known = F.lit(True)
    for output, labels in zip(indexer.getOutputCols(), indexer.labelsArray, strict=True):
        known = known & (F.col(output) < len(labels))
    return indexer.transform(prepared).agg(
        F.count("*").alias("rows_in"),
        F.count_if(F.col(LABEL).isNull()).alias("unlabelled"),
        F.count_if(~known).alias("dropped_by_index"),
    )
