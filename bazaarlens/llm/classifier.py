"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader updates."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.llm.words import REMEMBERED, mixed, word_hashes

BUCKETS = 1 << 18
# Labelled rows that training takes at most, about: a bound the size of the data does not move.
TRAIN_ROWS = 20_000
SHARDS, EPOCHS = 8, 5
ALPHA, BETA, L1, L2 = 4.0, 1.0, 0.02, 0.0
THRESHOLD = 0.3


def held_out(doc_id: Column) -> Column:
    """Rows that training never sees: a fifth, by the CRC-32 of the id as text."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


class Shapes(dict):
    """Word -> hash of its shape: its case and the signs in it."""

    def __missing__(self, word: bytes) -> int:
        text = word.decode("utf-8", "replace")
        case = "u" if text.isupper() and len(text) > 1 else "t" if text[:1].isupper() else "l"
        if len(self) >= REMEMBERED:
            self.clear()
        found = xxhash.xxh64_intdigest((case + "".join(c for c in text if not c.isalnum()))[:16])
        if len(word) < 64:
            self[word] = found
        return found


_SHAPES = Shapes()
# Sets apart what words and shapes hash to.
_WORD, _PAIR, _SHAPE, _SHAPE_PAIR, _SAME = (np.uint64(i) for i in (3, 5, 7, 11, 13))


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values of a text: n-grams of one and two words and of one and two word shapes, by the root of their
    count, at length 1. A pair of the same word twice is one n-gram, whichever the word."""
    words = word_hashes(text)
    if not len(words):
        return np.empty(0, np.int64), np.empty(0)
    shapes = np.fromiter(map(_SHAPES.__getitem__, text.encode("utf-8", "surrogatepass").split()), np.uint64, len(words))
    pairs = mixed(words[:-1] * _PAIR + words[1:])
    pairs[words[:-1] == words[1:]] = _SAME
    grams = [mixed(words * _WORD), pairs, mixed(shapes * _SHAPE), mixed(shapes[:-1] * _SHAPE_PAIR + shapes[1:])]
    buckets, counts = np.unique((np.concatenate(grams) % np.uint64(BUCKETS - 1)).astype(np.int64) + 1, return_counts=True)
    values = np.sqrt(counts)
    return buckets, values / np.sqrt((values**2).sum())


@dataclass(frozen=True)
class Model:
    """A weight for each bucket; bucket 0 is the intercept."""

    weights: np.ndarray

    def score(self, text: str | None) -> float:
        buckets, values = features(text)
        margin = self.weights[0] + float(self.weights[buckets] @ values)
        return float(1 / (1 + np.exp(-np.clip(margin, -35, 35))))


def follow_the_leader(rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int) -> np.ndarray:
    """FTRL-proximal over the rows in order: per bucket, the weight that minimises all gradients so far under L1 and L2."""
    z, n = np.zeros(BUCKETS), np.zeros(BUCKETS)

    def weights(at: np.ndarray) -> np.ndarray:
        over = np.sign(z[at]) * L1 - z[at]
        return np.where(np.abs(z[at]) <= L1, 0.0, over / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    for _ in range(epochs):
        for buckets, values, label in rows:
            at, x = np.concatenate([[0], buckets]), np.concatenate([[1.0], values])
            w = weights(at)
            gradient = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label) * x
            step = (np.sqrt(n[at] + gradient**2) - np.sqrt(n[at])) / ALPHA
            z[at] += gradient - step * w
            n[at] += gradient**2
    return weights(np.arange(BUCKETS))


def labelled_sample(labels: DataFrame, doc_id: str, label: str, rows: int) -> DataFrame:
    """About ``rows`` labelled ids at most, by a hash of the id; held-out ids and null labels are left out. An id with
    several labels counts once, with the smallest."""
    usable = labels.filter(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull() & ~held_out(F.col(doc_id)))
    usable = usable.select(F.col(doc_id).cast("bigint").alias("__id"), F.col(label).cast("int").alias("label"))
    share = min(1.0, rows / max(1, usable.count()))
    chosen = usable.filter(F.pmod(F.xxhash64("__id", F.lit("train")), F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))
    return chosen.groupBy("__id").agg(F.min("label").alias("label"))


def train(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    label: str = "quality",
    train_rows: int = TRAIN_ROWS,
    shards: int = SHARDS,
    epochs: int = EPOCHS,
) -> Model:
    """A model from a sample of at most about ``train_rows`` labelled documents.

    The sample's ids are broadcast (their number is bounded), texts become features where they are read, and only
    features are shuffled, to ``shards`` trainers. The model is the mean of theirs, ``BUCKETS`` numbers each. Rows are
    taken in the order of a hash, so a rerun gives the same model.

    Null labels, texts without a label and held-out ids play no part; without a single label all scores are one half. A
    null text counts as empty, and an empty one has the intercept alone.
    """

    def featured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [features(t) for t in batch["text"]]
            yield batch.drop(columns="text").assign(
                buckets=[f[0].astype(np.int32).tobytes() for f in found], values=[f[1].astype(np.float32).tobytes() for f in found]
            )

    def fitted(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["place", "__id", "buckets"], kind="stable")
        rows = [
            (np.frombuffer(b, np.int32).astype(np.int64), np.frombuffer(v, np.float32).astype(float), y)
            for b, v, y in zip(group["buckets"], group["values"], group["label"].tolist(), strict=True)
        ]
        weights = follow_the_leader(rows, epochs)
        return pd.DataFrame({"shard": [int(group["shard"].iloc[0])], "weights": [weights.tobytes()]})

    sample = labelled_sample(labels, doc_id, label, train_rows)
    read = docs.select(F.col(doc_id).cast("bigint").alias("__id"), F.col(text).alias("text")).join(F.broadcast(sample), "__id")
    read = read.withColumn("place", F.xxhash64("__id", F.lit("order"))).withColumn("shard", F.pmod("place", F.lit(shards)).cast("int"))
    rows = read.select("__id", "label", "place", "shard", "text").mapInPandas(
        featured, "__id bigint, label int, place bigint, shard int, buckets binary, values binary"
    )
    trained = rows.groupBy("shard").applyInPandas(fitted, "shard int, weights binary").collect()
    parts = [np.frombuffer(r["weights"]) for r in sorted(trained, key=lambda r: r["shard"])]
    return Model(np.mean(parts, axis=0) if parts else np.zeros(BUCKETS))


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """The rows with ``name``, the likelihood of label 1; a column of that name is replaced. Other columns pass through."""
    weights = docs.sparkSession.sparkContext.broadcast(model.weights)

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        held = Model(weights.value)
        return pa.array([held.score(t.as_py()) for t in texts], pa.float64())

    return docs.withColumn(name, scored(F.col(text)))
