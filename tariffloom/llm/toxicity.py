"""Toxicity: gradient-boosted trees over dense features of a text, with isotonic calibration.

1. Training rows: at most ``SAMPLE`` labelled rows, those of the smallest hash of their id, from the folds given for training.
   Everything below learns from these alone.
2. Lexicon: words and word beginnings that mark the toxic rows, by a smoothed log odds ratio over document counts, found in
   Spark (one count per batch, then a grouped sum). At most ``LEXICON`` entries of the highest significance.
3. Features: densities and maxima of lexicon hits, hits near a second-person word, capitals, punctuation, symbols, digits,
   obfuscated and stretched words, length.
4. Trees learn from features whose lexicon comes from the other half of the rows, so they see what lexicon hits are
   worth on unseen texts; the isotonic map is fitted on margins of the half a model hasn't seen.

Scoring is one pass without a shuffle; the model is a few hundred kilobytes by the bounds above.

Cases: NULL and empty texts get the score of their (zero) features; NULL labels and labels without a document are not
used; a document labelled twice is toxic if any label says so; with no or one class of labels the score is the constant
prior (0.5 without labels), the empty table gives an empty result; extra columns are ignored by ``scored``, kept by
``without_toxic``.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffloom.llm.boosting import Trees, calibrated, fit_isotonic, fit_trees
from tariffloom.llm.common import checkpointed, fold, ids_of, map_batches, row_of_each, texts_of

SAMPLE, LEXICON = 20_000, 5_000
FOLDS = 5
#: Significance and size of the log odds ratio of an entry.
LEAST_Z, LEAST_ODDS = 2.8, 2.0
#: Bytes of a word's beginning.
BEGINNINGS = (4, 5, 6, 7)
NEAR = 6
#: Entries counted before they are handed on.
HELD = 200_000

#: Second-person words of the languages at hand.
SECOND_PERSON = frozenset(
    b"you your yours yourself u ur du dich dir dein deine deinen ihr euch sie tu te toi ton ta tes vous votre vos ti tus usted "
    b"ustedes vosotros os".split())

UPPER = bytes(range(65, 91))
PUNCTUATION = b"!?.,;:"
SYMBOLS = b"#*$%&|<>@~^+=_\\/"
#: A-Z lower-cased, ASCII other than letters and digits made blank.
PLAIN = bytes((c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 else 32) for c in range(256))
OBFUSCATED = re.compile(rb"[A-Za-z][0-9*@$!#%]+[A-Za-z]")
STRETCHED = re.compile(rb"([A-Za-z])\1{3,}|[!?]{3,}")

FEATURES = (
    "log_words", "hits", "hit_rate", "weight_rate", "best", "second_best", "distinct", "near_you", "you_rate", "capitals",
    "loud_words", "exclaims", "punctuation", "symbols", "digits", "obfuscated", "stretched",
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(PLAIN).split()


def beginnings(word: bytes) -> list[bytes]:
    """Marks of a word: itself, and its beginnings with a ``^`` before them."""
    return [b"^" + word[:k] for k in BEGINNINGS if len(word) >= k]


class Weights(dict):
    """Weight of a word: the largest of its marks', 0 for none. Remembers what it was asked, up to a bound."""

    def __init__(self, lexicon: dict[bytes, float]):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, word: bytes) -> float:
        if len(self) > 500_000:
            self.clear()
        get = self.lexicon.get
        value = max([get(word, 0.0), *(get(b, 0.0) for b in beginnings(word))])
        if len(word) < 64:
            self[word] = value
        return value


def features(text: bytes, weights: Weights) -> list[float]:
    words = words_of(text)
    n, size = max(len(words), 1), max(len(text), 1)
    marks = np.fromiter(map(weights.__getitem__, words), float, len(words))
    at = np.flatnonzero(marks)
    hit = marks[at]
    you = [i for i, w in enumerate(words) if w in SECOND_PERSON]
    near = 0
    if len(at) and you:
        place = np.searchsorted(you, at)
        spots = np.array(you)
        gap = np.minimum(np.abs(at - spots[np.minimum(place, len(you) - 1)]), np.abs(at - spots[np.maximum(place - 1, 0)]))
        near = int((gap <= NEAR).sum())
    loud = len(re.findall(rb"\b[A-Z]{3,}\b", text))
    best = np.sort(hit)[::-1]
    count = lambda chars: (size if text else 0) - len(text.translate(None, chars)) if text else 0
    return [
        np.log1p(len(words)), len(at), len(at) / n, hit.sum() / n, best[0] if len(best) else 0.0, best[1] if len(best) > 1 else 0.0,
        len({words[i] for i in at}), near, len(you) / n, count(UPPER) / size, loud / n, text.count(b"!") / n,
        count(PUNCTUATION) / size, count(SYMBOLS) / size, count(b"0123456789") / size,
        len(OBFUSCATED.findall(text)) / n, len(STRETCHED.findall(text)) / n,
    ]


@dataclass
class Model:
    lexicon: dict[bytes, float]
    trees: Trees
    knots: tuple[np.ndarray, np.ndarray]

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(calibrated(self.trees.margin(x), self.knots), 0, 1)


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, held_out: bool = True) -> DataFrame:
    """text, toxic, half: at most ``sample`` labelled rows, one of each id; fold 0 is left out if ``held_out``."""
    known = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    if held_out:
        known = known.filter(fold("doc_id", FOLDS) != 0)
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)  # bounded: the hint below is safe
    return row_of_each(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), "doc_id", "toxic").select(
        "text", (F.col("toxic") > 0).cast("int").alias("toxic"),
        F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2)).cast("int").alias("half"))


def mark_counts(rows: DataFrame) -> DataFrame:
    """mark, and in how many texts of each half and class it is: t0, c0, t1, c1."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        counts: Counter = Counter()

        def out() -> pa.RecordBatch:
            keys = list(counts)
            batch = pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.binary()), pa.array([k[1] for k in keys], pa.int32()),
                 pa.array([counts[k] for k in keys], pa.int64())], names=["mark", "cell", "n"])
            counts.clear()
            return batch

        for batch in batches:
            toxic, half = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for text, t, h in zip(texts_of(batch), toxic, half):
                words, cell = set(words_of(text)), 2 * h + 1 - t
                marks = {b for w in words for b in beginnings(w)} | words
                counts.update((m, cell) for m in marks)
                if len(counts) > HELD:
                    yield out()
        yield out()

    cell = F.col("cell")
    return map_batches(rows, run, "mark binary, cell int, n long").groupBy("mark").agg(
        *[F.sum(F.when(cell == k, F.col("n")).otherwise(0)).alias(name) for k, name in enumerate(("t0", "c0", "t1", "c1"))])


def lexicon(counts: DataFrame, toxic: str, clean: str, n_toxic: int, n_clean: int, most: int = LEXICON) -> dict[bytes, float]:
    """Weights of the ``most`` most significant marks of toxic texts."""
    t, c = F.expr(toxic) + 0.5, F.expr(clean) + 0.5
    odds = F.log(t / (n_toxic + 1 - t)) - F.log(c / (n_clean + 1 - c))
    found = (
        counts.select("mark", odds.alias("odds"), (odds / F.sqrt(1 / t + 1 / c)).alias("z"))
        .filter((F.col("z") >= LEAST_Z) & (F.col("odds") >= LEAST_ODDS))
        .orderBy(F.desc("z"), "mark").limit(most)
    )
    return {bytes(r["mark"]): float(r["odds"]) for r in found.collect()}


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, held_out: bool = True) -> Model:
    rows = checkpointed(training_rows(docs, labels, sample, held_out))
    sizes = {(r["half"], r["toxic"]): r["n"] for r in rows.groupBy("half", "toxic").agg(F.count("*").alias("n")).collect()}
    n = [[sizes.get((h, t), 0) for t in (0, 1)] for h in (0, 1)]
    counts = checkpointed(mark_counts(rows))
    every = lexicon(counts, "t0 + t1", "c0 + c1", n[0][1] + n[1][1], n[0][0] + n[1][0])
    other = (lexicon(counts, "t1", "c1", n[1][1], n[1][0]), lexicon(counts, "t0", "c0", n[0][1], n[0][0]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        weights = (Weights(other[0]), Weights(other[1]))
        for batch in batches:
            half = batch.column(2).to_pylist()
            made = [features(t, weights[h]) for t, h in zip(texts_of(batch), half)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(made, pa.list_(pa.float64())), batch.column(1), batch.column(2)], names=["x", "toxic", "half"])

    table = map_batches(rows, run, "x array<double>, toxic int, half int").toPandas()  # at most ``sample`` rows of numbers
    x = np.array(table.x.tolist(), float).reshape(-1, len(FEATURES))
    order = np.lexsort(x.T)  # the same model whatever the order of rows
    x, y, half = x[order], table.toxic.to_numpy(float)[order], table.half.to_numpy()[order]
    unseen = np.zeros(len(y))
    for h in (0, 1):
        unseen[half == h] = fit_trees(x[half != h], y[half != h]).margin(x[half == h])
    return Model(every, fit_trees(x, y), fit_isotonic(unseen, y))


def batch_scores(batch: pa.RecordBatch, model: Model, weights: Weights, text: str) -> np.ndarray:
    x = np.array([features(t, weights) for t in texts_of(batch, text)], float).reshape(-1, len(FEATURES))
    return model.score(x)


def scored(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, score (0 to 1) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        weights = Weights(model.lexicon)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [ids_of(batch), pa.array(batch_scores(batch, model, weights, "text"))], names=["doc_id", "score"])

    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return map_batches(rows, run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")


def without_toxic(docs: DataFrame, model: Model, threshold: float = 0.5, text: str = "text") -> DataFrame:
    """The rows of ``docs`` below the threshold, with all their columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        weights = Weights(model.lexicon)
        for batch in batches:
            yield batch.filter(pa.array(batch_scores(batch, model, weights, text) < threshold))

    return map_batches(docs, run, docs.schema)
