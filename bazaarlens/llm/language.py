"""Language identification by piece unigrams, summed over all segmentations of every word."""

from __future__ import annotations

import unicodedata
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens.llm.classifier import held_out

VOCABULARY = "piece_bpe_32k.model"
# Documents that training takes at most, about: in equal parts of all languages, each of so many at least.
TRAIN_ROWS = 5_000
LANGUAGE_ROWS = 500
ROUNDS = 2
SMOOTHING = 0.1
# Longer words are taken one by one, in logarithms, so that they need little memory and lose no precision.
TOGETHER = 64
REMEMBERED = 1 << 19
BATCH_WORDS, BATCH_TEXTS = 10_000, 200
# Probability of a character that no piece starts with, in any language.
UNKNOWN = 1e-7


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=1)
def pieces(path: str) -> dict[str, int]:
    """The vocabulary's pieces of letters, lower case, by number. Words are scored without their white space, so the mark
    of a word's start is taken off."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = {model.id_to_piece(i).lstrip("▁").lower() for i in range(model.vocab_size())}
    return {p: n for n, p in enumerate(sorted(p for p in found if p and letters_of(p) == p))}


def _letter_or_mark(character: str) -> bool:
    return character.isalpha() or unicodedata.category(character)[0] == "M"


def letters_of(word: str) -> str:
    """A word without all but letters and their marks, such as vowel signs; nothing if it has no letter."""
    if word.isalpha():
        return word
    # No character before this one is a mark.
    if word < "\u0300" and max(word, default="") < "\u0300":
        return "".join(filter(str.isalpha, word))
    kept = "".join(filter(_letter_or_mark, word))
    return kept if any(map(str.isalpha, kept)) else ""


def letter_words(text: str | None) -> list[str]:
    """The words of a text in lower case, letters and marks only."""
    return [letters_of(w) for w in (text or "").lower().split()]


@lru_cache(maxsize=1)
def beginnings(path: str) -> frozenset[str]:
    """All beginnings of pieces: where a stretch is none, no longer piece starts there."""
    return frozenset(p[:n] for p in pieces(path) for n in range(1, len(p) + 1))


@dataclass(frozen=True)
class Lattice:
    """The pieces found in words: arc i leads from ``start`` to ``end`` in a word. Piece -1 is a character that is none."""

    lengths: np.ndarray
    word: np.ndarray
    start: np.ndarray
    end: np.ndarray
    piece: np.ndarray

    def _walk(self, chances: np.ndarray, backward: bool) -> np.ndarray:
        """Sums over all paths from a word's start to each place, or from each place to its end."""
        height = int(self.lengths.max(initial=0)) + 1
        total = np.zeros((len(self.lengths), height, chances.shape[1]))
        total[np.arange(len(self.lengths)), self.lengths if backward else 0] = 1
        near, far = (self.end, self.start) if backward else (self.start, self.end)
        order = np.lexsort((self.word, far))
        cuts = np.searchsorted(far[order], np.arange(height + 1))
        for at in range(height - 2, -1, -1) if backward else range(1, height):
            arcs = order[cuts[at] : cuts[at + 1]]
            if len(arcs):
                word = self.word[arcs]
                first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
                total[word[first], at] = np.add.reduceat(total[word, near[arcs]] * chances[arcs], first)
        return total

    def likelihoods(self, probabilities: np.ndarray) -> np.ndarray:
        """The forward algorithm: the probability of each word in each language, over all its segmentations. The last row
        of ``probabilities`` is for unknown characters."""
        total = self._walk(probabilities[self.piece], False)
        return total[np.arange(len(self.lengths)), self.lengths]

    def expected(self, probabilities: np.ndarray, language: np.ndarray, times: np.ndarray) -> np.ndarray:
        """How often each piece is to be expected in each language, where word i was seen ``times[i]`` in ``language[i]``."""
        chances = probabilities[self.piece, language[self.word]][:, None]
        ahead, behind = self._walk(chances, False)[..., 0], self._walk(chances, True)[..., 0]
        whole = np.maximum(ahead[np.arange(len(self.lengths)), self.lengths], 1e-300)
        share = ahead[self.word, self.start] * chances[:, 0] * behind[self.word, self.end] / whole[self.word]
        counts = np.zeros(probabilities.shape)
        np.add.at(counts, (self.piece, language[self.word]), share * times[self.word])
        return counts[:-1]

    def _log_walk(self, logs: np.ndarray, backward: bool) -> np.ndarray:
        """``_walk`` of a single word, in logarithms. A piece is short, so each place adds up few arcs, whatever the word."""
        length = int(self.lengths[0])
        total = np.full((length + 1, logs.shape[1]), -np.inf)
        total[length if backward else 0] = 0
        near, far = (self.end, self.start) if backward else (self.start, self.end)
        order = np.argsort(far, kind="stable")
        cuts = np.searchsorted(far[order], np.arange(length + 2))
        for at in range(length - 1, -1, -1) if backward else range(1, length + 1):
            arcs = order[cuts[at] : cuts[at + 1]]
            total[at] = np.logaddexp.reduce(total[near[arcs]] + logs[arcs], axis=0)
        return total

    def log_likelihood(self, probabilities: np.ndarray) -> np.ndarray:
        """The logarithm of ``likelihoods`` of a single word."""
        return self._log_walk(np.log(probabilities[self.piece]), False)[-1]

    def log_expected(self, probabilities: np.ndarray, language: int, times: float) -> np.ndarray:
        """``expected`` of a single word."""
        logs = np.log(probabilities[self.piece, language])[:, None]
        ahead, behind = self._log_walk(logs, False)[:, 0], self._log_walk(logs, True)[:, 0]
        share = np.exp(ahead[self.start] + logs[:, 0] + behind[self.end] - ahead[-1])
        counts = np.zeros(probabilities.shape)
        np.add.at(counts, (self.piece, language), share * times)
        return counts[:-1]


def lattice(words: list[str], path: str) -> Lattice:
    known, begun, found = pieces(path), beginnings(path), []
    for n, word in enumerate(words):
        for start in range(len(word)):
            if word[start] not in known:
                found.append((n, start, start + 1, -1))
            for end in range(start + 1, len(word) + 1):
                part = word[start:end]
                if part not in begun:
                    break
                if part in known:
                    found.append((n, start, end, known[part]))
    arcs = np.array(found, np.int64).reshape(-1, 4)
    return Lattice(np.array([len(w) for w in words], np.int64), *arcs.T)


def log_likelihoods(words: list[str], probabilities: np.ndarray, path: str) -> np.ndarray:
    """The logarithm of the probability of each word in each language, whatever its length."""
    out = np.zeros((len(words), probabilities.shape[1]))
    short = [i for i, w in enumerate(words) if len(w) <= TOGETHER]
    out[short] = np.log(np.maximum(lattice([words[i] for i in short], path).likelihoods(probabilities), 1e-300))
    for i, word in enumerate(words):
        if len(word) > TOGETHER:
            out[i] = lattice([word], path).log_likelihood(probabilities)
    return out


@dataclass(frozen=True)
class Model:
    """``probabilities``: a row for each piece and one for unknown characters, a column for each language."""

    languages: list[str]
    probabilities: np.ndarray
    prior: np.ndarray
    path: str
    name: str = field(default_factory=lambda: uuid.uuid4().hex)


class WordScores:
    """Log probabilities of words by language, worked out once for a worker."""

    def __init__(self, model: Model):
        self.model, self.place, self.rows = model, {}, np.zeros((0, len(model.languages)))

    def learn(self, words: set[str]) -> None:
        if len(self.place) > REMEMBERED:
            self.place, self.rows = {}, self.rows[:0]
        new = sorted(words - self.place.keys())
        for at in range(0, len(new), BATCH_WORDS):
            some = new[at : at + BATCH_WORDS]
            whole = log_likelihoods(some, self.model.probabilities, self.model.path)
            self.place.update(zip(some, range(len(self.rows), len(self.rows) + len(some)), strict=True))
            self.rows = np.concatenate([self.rows, whole])

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Texts are taken a few at a time, so that the words to be remembered at once stay few."""
        found = []
        for at in range(0, len(texts), BATCH_TEXTS):
            words = [[w for w in letter_words(t) if w] for t in texts[at : at + BATCH_TEXTS]]
            if self.model.languages:
                self.learn(set().union(*words))
            found += [self._best(w) for w in words]
        return found

    def _best(self, words: list[str]) -> tuple[str, float]:
        if not words or not self.model.languages:
            return "und", 0.0
        total = self.rows[[self.place[w] for w in words]].sum(axis=0) + self.model.prior
        best = int(total.argmax())
        return self.model.languages[best], float(1 / np.exp(total - total[best]).sum())


_KEPT: dict[str, WordScores] = {}


def kept_scores(model: Model) -> WordScores:
    """The word scores of a worker, kept from batch to batch for one model at a time."""
    if model.name not in _KEPT:
        _KEPT.clear()
        _KEPT[model.name] = WordScores(model)
    return _KEPT[model.name]


def level(counts: list[int], rows: int) -> int:
    """The number such that so many of each count, or all of a smaller one, are ``rows`` in all, about."""
    found = rows
    for i, n in enumerate(sorted(counts)):
        found = -(-rows // (len(counts) - i))
        if n >= found:
            break
        rows -= n
    return found


def train(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    lang: str = "lang",
    train_rows: int = TRAIN_ROWS,
    rounds: int = ROUNDS,
    path: str | None = None,
    language_rows: int = LANGUAGE_ROWS,
) -> Model:
    """Piece probabilities for each value of ``lang``, by expectation maximisation over a fixed public vocabulary.

    From a sample by a hash of the id: about ``train_rows`` documents in equal parts of all languages, or ``language_rows``
    of each where that is more, and all documents of a language that has fewer, whose room goes to the others. So each
    language is learned, however thin it is. Priors come from the count of all documents. Held-out ids and null languages
    play no part. Words are counted by language once; each round spreads a word's count over the pieces of all its
    segmentations. What reaches the driver is a number for each piece and language. A rerun gives the same model.
    """
    path = path or vocabulary_path()
    usable = docs.filter(F.col(lang).isNotNull() & F.col(doc_id).isNotNull() & ~held_out(F.col(doc_id)))
    usable = usable.select(F.col(doc_id).cast("bigint").alias("__id"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    totals = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(totals)
    each = max(language_rows, level(list(totals.values()), train_rows))
    below = [(x, (min(n, each) << 30) // n) for x, n in totals.items()]
    shares = docs.sparkSession.createDataFrame(below, "lang string, __below bigint")
    # A row for each language, as in the model.
    sample = usable.join(F.broadcast(shares), "lang").filter(
        F.pmod(F.xxhash64("__id", F.lit("train")), F.lit(1 << 30)) < F.col("__below")
    )

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = pd.DataFrame({"lang": batch["lang"], "word": [letter_words(t) for t in batch["text"]]}).explode("word")
            found = found[found["word"].notna() & (found["word"] != "")]
            yield found.groupby(["lang", "word"], sort=False).size().rename("n").reset_index()

    counted = sample.select("lang", "text").mapInPandas(words, "lang string, word string, n bigint")
    counted = counted.groupBy("lang", "word").agg(F.sum("n").alias("n")).persist()
    known = pieces(path)
    found = np.full((len(known) + 1, len(languages)), 1.0 / max(1, len(known)))
    found[-1] = UNKNOWN
    for _ in range(rounds):
        found = _round(counted, languages, found, path)
    counted.unpersist()
    prior = np.log(np.array([totals[x] for x in languages], float) / max(1, sum(totals.values()))) if languages else np.empty(0)
    return Model(languages, found, prior, path)


def _round(counted: DataFrame, languages: list[str], before: np.ndarray, path: str) -> np.ndarray:
    shared = counted.sparkSession.sparkContext.broadcast(before)

    def expected(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place = {x: i for i, x in enumerate(languages)}
        total = np.zeros((before.shape[0] - 1, len(languages)))
        for batch in batches:
            rows = [(w, place[x], n) for x, w, n in batch.itertuples(index=False)]
            short = [row for row in rows if len(row[0]) <= TOGETHER]
            words, language, times = map(list, zip(*short, strict=True)) if short else ([], [], [])
            total += lattice(words, path).expected(shared.value, np.array(language, np.int64), np.array(times, float))
            for word, language_at, n in rows:
                if len(word) > TOGETHER:
                    total += lattice([word], path).log_expected(shared.value, language_at, n)
        # Whole millionths, so that sums do not hang on the order of tasks.
        for i, lang in enumerate(languages):
            some = np.flatnonzero(total[:, i])
            yield pd.DataFrame({"lang": lang, "piece": some, "n": np.rint(total[some, i] * 1e6).astype(np.int64)})

    sums = counted.mapInPandas(expected, "lang string, piece int, n bigint").groupBy("lang", "piece").agg(F.sum("n").alias("n"))
    counts = np.full((before.shape[0] - 1, len(languages)), SMOOTHING)
    place = {x: i for i, x in enumerate(languages)}
    for r in sums.collect():
        counts[r["piece"], place[r["lang"]]] += r["n"] / 1e6
    return np.vstack([counts / counts.sum(axis=0), np.full(len(languages), UNKNOWN)])


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows with ``lang_pred`` and ``score``, the language's share among all known ones; columns of those names are
    replaced, others pass through. Without a letter, or null: ``und`` at 0. Ties go to the first language by name."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predicted(texts: pd.Series) -> pd.DataFrame:
        scores = kept_scores(shared.value)
        return pd.DataFrame(scores.predict(texts.tolist()), columns=["lang_pred", "score"])

    found = docs.drop("lang_pred", "score").withColumn("__found", predicted(F.col(text)))
    return found.select("*", "__found.lang_pred", "__found.score").drop("__found")
