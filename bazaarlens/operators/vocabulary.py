"""Word counts over a vocabulary that stays a table: counted, ranked and joined in Spark."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.ml import Estimator, Model
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlens.operators.ranks import frequency_ranks, with_rank
from bazaarlens.session import written

# Workers get the functions below along with the query.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The widest vector a model is fitted on: its coefficients are kept on the driver, 8 bytes each.
MOST_WORDS = 1 << 22


def word_ranks(rows: DataFrame, words: str) -> DataFrame:
    """``(value, n, rank)`` of all words in a column of word lists: the most frequent has rank 0, equal ones go by the word."""
    return frequency_ranks(rows.select(F.explode(words).alias("word")), "word")


def counted_words(rows: DataFrame, words: str, key: str) -> DataFrame:
    """``(key, word, n)``: how often each word comes up in each row, as a written table. A row sorts its own words and counts
    stretches of equal ones, so no word is shuffled. ``key`` must tell rows apart."""
    ordered = rows.select(key, F.sort_array(words).alias("__w"))
    at = "if(size(__w) > 0, sequence(0, size(__w) - 1), cast(array() AS array<int>))"
    starts = ordered.withColumn("__s", F.expr(f"filter({at}, i -> i = 0 OR NOT get(__w, i) <=> get(__w, i - 1))"))
    stretch = "struct(get(__w, s) AS word, cast(coalesce(get(__s, j + 1), size(__w)) - s AS bigint) AS n)"
    counted = starts.select(key, F.explode(F.expr(f"transform(__s, (s, j) -> {stretch})")).alias("__e"))
    return written(counted.select(key, "__e.word", "__e.n"), "counted-words", even=False)


def word_entries(counted: DataFrame, ranks: DataFrame, key: str) -> DataFrame:
    """``(key, place, n)``: counted words with their rank for their name. Unknown words are left out."""
    placed = with_rank(counted, ranks, "word", "__rank")
    return placed.select(key, F.col("__rank").cast("int").alias("place"), F.col("n").cast("double").alias("n"))


def word_counts(rows: DataFrame, words: str, ranks: DataFrame, key: str) -> DataFrame:
    """``(key, places, counts)``: the ranks of the known words of each row, ascending, and how often each comes up.

    ``key`` must tell rows apart. Rows without a known word are left out.
    """
    pairs = F.array_sort(F.collect_list(F.struct("place", "n")))
    return word_entries(counted_words(rows, words, key), ranks, key).groupBy(key).agg(pairs.alias("__pairs")).select(
        key, F.col("__pairs.place").alias("places"), F.col("__pairs.n").alias("counts")
    )


class TermCounts(Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Word lists to vectors of word counts, as ``CountVectorizer`` makes them, without its vocabulary on the driver.

    Every word has a place. More than ``mostWords`` words are an error, never cut.
    """

    mostWords = Param(Params._dummy(), "mostWords", "most words a vocabulary may have", TypeConverters.toInt)

    def __init__(self, inputCol: str | None = None, outputCol: str | None = None, mostWords: int = MOST_WORDS):
        super().__init__()
        self._setDefault(mostWords=MOST_WORDS)
        given = {"inputCol": inputCol, "outputCol": outputCol, "mostWords": mostWords}
        self._set(**{name: value for name, value in given.items() if value is not None})

    def _fit(self, dataset: DataFrame) -> TermCountsModel:
        ranks = written(word_ranks(dataset, self.getInputCol()), "vocabulary")
        size, most = ranks.count(), self.getOrDefault(self.mostWords)
        if size > most:
            raise ValueError(f"{size} words are more than {most}: hash them, or raise mostWords")
        return TermCountsModel(self.getInputCol(), self.getOutputCol(), ranks, size)


class TermCountsModel(Model, HasInputCol, HasOutputCol, MLReadable, MLWritable):
    """A written vocabulary. Transforming writes the rows down once, as each is taken apart and put together again."""

    size = Param(Params._dummy(), "size", "words in the vocabulary", TypeConverters.toInt)

    def __init__(self, inputCol: str | None = None, outputCol: str | None = None, ranks: DataFrame | None = None, size: int = 0):
        super().__init__()
        self.ranks = ranks
        self._set(size=size)
        if inputCol is not None:
            self._set(inputCol=inputCol, outputCol=outputCol)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        size, output = max(1, self.getOrDefault(self.size)), self.getOutputCol()
        vector = F.udf(lambda places, counts: SparseVector(size, places or [], counts or []), VectorUDT())
        # Vectors of earlier stages go along; words are read back from the table, so a row keeps its number.
        rows = written(dataset.withColumn("__row", F.monotonically_increasing_id()), "counted-rows")
        counts = word_counts(rows, self.getInputCol(), self.ranks, "__row")
        attributes = {"ml_attr": {"num_attrs": size}}
        joined = rows.join(counts, "__row", "left").withColumn("__vector", vector("places", "counts"))
        return joined.select(*dataset.columns, F.col("__vector").alias(output, metadata=attributes))

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _Writer(MLWriter):
    def __init__(self, model: TermCountsModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, SparkSession.active())
        self.model.ranks.write.parquet(f"{path}/vocabulary")


class _Reader(MLReader):
    def __init__(self, cls: type):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> TermCountsModel:
        spark = SparkSession.active()
        metadata = DefaultParamsReader.loadMetadata(path, spark, str(self.cls.__module__ + "." + self.cls.__name__))
        model = self.cls(ranks=spark.read.parquet(f"{path}/vocabulary"))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
