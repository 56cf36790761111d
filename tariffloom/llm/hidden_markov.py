"""Hidden Markov language model: Baum-Welch counts from all partitions, exact likelihood by the scaled forward recursion.

Words are runs of ``[^\\x20\\x09-\\x0D]`` after lower-casing A-Z; a text is its words and one end token.

1. Word counts of all training texts: counted in each task, summed after one shuffle. The table has every word.
2. Each token belongs to one of a fixed number of classes: the ``OWN`` most frequent words of at most ``LONGEST`` bytes have one
   each, the end has one, any other word falls into one of ``ENDINGS`` by a hash of its last bytes. Latent states emit classes; a class emits its
   words by their counts, P(w | class) = (c + D) / (C + D (V + 1)) with C and V the class's tokens and distinct words. So
   the emission table is of fixed size, and yet every word of the corpus has its own probability.
3. Baum-Welch: each round passes over all training sequences; each task accumulates expected counts of starts, transitions
   and emissions, which are added up in two steps. A text is one sequence however long it is: it is held in pieces of ``PIECE``
   tokens, and the states at their cuts are carried on, forward and backward.
4. Score: log10 of P(text), the forward recursion over the whole text, scaled at each token, times the words within their
   classes. Counts of frequent words travel with the model (at most ``FREQUENT`` words of at most ``LONGEST`` bytes);
   those of all others are looked up by a join on the word.

The base score is the sum over tokens of log10((c + 0.1) / (N + 0.1 (V + 1))).

Cases: NULL and empty texts are one end token; very long texts are scored whole; rows that repeat an id are scored one
by one; with no training text all counts are zero and the model is uniform; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffloom.llm.common import checkpointed, fold, map_batches, texts_of

FOLDS = 10
OWN, ENDINGS, STATES, ROUNDS = 2000, 512, 8, 5
FREQUENT, LONGEST = 131_072, 32
#: Tokens of a piece, and pieces whose forward states are kept for the way back.
PIECE, KEPT = 512, 4
#: Words counted before they are handed on; words whose class is remembered; tokens of a training batch and of a scoring batch.
HELD, REMEMBERED, TRAINED, SCORED = 500_000, 300_000, 1 << 17, 1 << 21
BASE, D = 0.1, 0.3
#: A blank is no word, so it stands for the end token.
END = b" "
PARTS = 64


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()  # bytes: both know ASCII only


def word_counts(docs: DataFrame) -> DataFrame:
    """word (binary), n. ``docs``: text. The end token is a word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        counts: Counter = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(counts.keys()), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
            counts.clear()
            return batch

        for batch in batches:
            for text in texts_of(batch):
                counts.update(words_of(text))
                counts[END] += 1
                if len(counts) > HELD:
                    yield out()
        yield out()

    return map_batches(docs, run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """What travels with the model; its size is bounded by the constants above."""

    tokens: int
    distinct: int
    frequent: dict[bytes, int]
    own: dict[bytes, int]
    class_tokens: np.ndarray
    class_words: np.ndarray

    @property
    def classes(self) -> int:
        return OWN + ENDINGS + 1

    def denominators(self) -> np.ndarray:
        return np.log10(self.class_tokens + D * (self.class_words + 1))


def ending(word: bytes) -> int:
    return OWN + zlib.crc32(word[-3:]) % ENDINGS


class Classes(dict):
    """Class of a word."""

    def __init__(self, own: dict[bytes, int]):
        super().__init__(own)
        self.own = own

    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
            self.update(self.own)
        value = ending(word)
        if len(word) <= LONGEST:
            self[word] = value
        return value


def vocabulary(counts: DataFrame) -> Vocabulary:
    word = F.col("word")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    short = counts.filter(F.length(word) <= LONGEST)
    ranked = {bytes(r["word"]): r["n"] for r in short.filter(word != F.lit(END)).orderBy(F.desc("n"), word).limit(OWN).collect()}
    # more frequent words, to be looked up at once: all above a threshold of the binned counts, at most ``FREQUENT``
    scale = F.floor(F.log2("n") * 16).cast("int")
    bins = sorted(short.groupBy(scale.alias("bin")).agg(F.count("*").alias("k")).collect(), reverse=True)
    lowest, held = None, 0
    for b in bins:
        held += b["k"]
        if held > FREQUENT:
            break
        lowest = b["bin"]
    frequent = dict(ranked)
    if lowest is not None:
        frequent |= {bytes(r["word"]): r["n"] for r in short.filter(scale >= lowest).toLocalIterator()}
    ends = counts.filter(word == F.lit(END)).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    frequent[END] = ends  # asked for by every text
    own = {w: k for k, w in enumerate(ranked)} | {END: OWN + ENDINGS}
    by_ending = counts.groupBy((F.crc32(F.substring(word, -3, 3)) % ENDINGS).cast("int").alias("ending")).agg(
        F.sum("n").alias("n"), F.count("*").alias("k"))
    class_tokens, class_words = np.zeros(OWN + ENDINGS + 1), np.zeros(OWN + ENDINGS + 1)
    for r in by_ending.collect():
        class_tokens[OWN + r["ending"]], class_words[OWN + r["ending"]] = r["n"], r["k"]
    for w, k in own.items():
        class_tokens[k] = frequent[w]
        if frequent[w]:  # it was counted under its ending
            class_tokens[ending(w)] -= frequent[w]
            class_words[ending(w)] -= 1
    return Vocabulary(int(total[0]), int(total[1]), frequent, own, class_tokens, class_words)


def sequences(docs: DataFrame, own: dict[bytes, int]) -> DataFrame:
    """classes (binary: 16-bit numbers) of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        known = Classes(own)
        for batch in batches:
            coded = [coded_text(words_of(t), known).tobytes() for t in texts_of(batch)]
            yield pa.RecordBatch.from_arrays([pa.array(coded, pa.binary())], names=["classes"])

    return map_batches(docs, run, "classes binary")


def coded_text(words: list[bytes], known: Classes) -> np.ndarray:
    out = np.empty(len(words) + 1, np.uint16)
    out[:-1] = np.fromiter(map(known.__getitem__, words), np.uint16, len(words))
    out[-1] = OWN + ENDINGS
    return out


@dataclass
class Model:
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # states x classes

    @staticmethod
    def initial(class_tokens: np.ndarray, states: int = STATES) -> Model:
        """Sticky states whose emissions are the corpus's, each distorted in its own way."""
        rng = np.random.default_rng(20)
        share = (class_tokens + 1) / (class_tokens + 1).sum()
        emit = share * np.exp(rng.normal(0, 1, (states, len(share))))
        move = np.full((states, states), 0.1 / max(states - 1, 1))
        np.fill_diagonal(move, 0.9)
        return Model(np.full(states, 1 / states), move / move.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True))

    @staticmethod
    def of_counts(counts: np.ndarray, states: int) -> Model:
        start, move, emit = unpacked(counts, states)
        smooth = lambda x, by: (x + by) / (x + by).sum(-1, keepdims=True)
        return Model(smooth(start, 0.1), smooth(move, 0.1), smooth(emit, 0.01))


def unpacked(counts: np.ndarray, states: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return counts[:states], counts[states:states * (states + 1)].reshape(states, states), counts[states * (states + 1):].reshape(states, -1)


def forward(seen: np.ndarray, active: np.ndarray, model: Model, before: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Scaled forward states of a piece, and the chance of each token by its scale. ``before``: states at the end of the piece before."""
    chance = np.ascontiguousarray(model.emit.T)[seen]
    alpha, scale, ones = np.zeros_like(chance), np.ones(seen.shape), np.ones(len(model.start))
    for t, n in enumerate(active):
        if t:
            a = (alpha[t - 1, :n] @ model.move) * chance[t, :n]
        else:
            a = (model.start if before is None else before[:n] @ model.move) * chance[0, :n]
        scale[t, :n] = total = a @ ones
        np.divide(a, total[:, None], out=alpha[t, :n])
    return alpha, chance / scale[:, :, None]


def expected_counts(texts: list[np.ndarray], model: Model) -> np.ndarray:
    """Forward-backward over a batch of sequences: expected starts, transitions and emissions in one array.

    Only ``KEPT`` pieces of each sequence are held at once: a first pass keeps the forward states of the last ones, and of the others
    those at the cuts; a second one goes back from the last piece to the first and carries what comes later over the cuts.
    """
    texts = sorted(texts, key=len, reverse=True)
    sizes, states, move = np.array([len(x) for x in texts]), len(model.start), model.move
    cuts = list(range(0, int(sizes[0]), PIECE))

    def piece(lo: int) -> tuple[np.ndarray, np.ndarray]:
        """Tokens (steps x sequences), and how many sequences have a token at each step."""
        rows = int(np.searchsorted(-sizes, -lo, side="left"))
        seen = np.zeros((min(int(sizes[0]) - lo, PIECE), rows), np.int64)
        for k in range(rows):
            part = texts[k][lo:lo + PIECE]
            seen[:len(part), k] = part
        return seen, np.searchsorted(-sizes, -np.arange(lo, lo + len(seen)), side="left")

    before: list[np.ndarray | None] = [None]
    kept = {}
    for lo in cuts:
        seen, active = piece(lo)
        kept[lo] = seen, active, *forward(seen, active, model, before[-1])
        kept.pop(lo - KEPT * PIECE, None)
        before.append(kept[lo][2][-1].copy())
    start, moves, emit = None, np.zeros_like(move), np.zeros((states, model.emit.shape[1]))
    after = np.zeros((0, states))  # of the first tokens behind the cut
    for lo, state in zip(reversed(cuts), reversed(before[:-1])):
        if lo in kept:
            seen, active, alpha, scaled = kept.pop(lo)
        else:
            seen, active = piece(lo)
            alpha, scaled = forward(seen, active, model, state)
        steps, beta, later = len(seen), np.zeros_like(alpha), np.zeros_like(alpha)
        for t in range(steps - 1, -1, -1):
            n = len(after)
            m = active[t]
            np.matmul(after, move.T, out=beta[t, :n])
            beta[t, n:m] = 1
            if t == steps - 1:
                moves += alpha[t, :n].T @ after
            after = np.multiply(scaled[t, :m], beta[t, :m], out=later[t, :m])
        gamma = alpha * beta
        there = np.arange(steps)[:, None] < sizes[:seen.shape[1]] - lo
        tokens, weight = seen[there], np.ascontiguousarray(gamma[there].T)
        for k in range(states):
            emit[k] += np.bincount(tokens, weight[k], emit.shape[1])
        moves += alpha[:-1].reshape(-1, states).T @ later[1:].reshape(-1, states)
        start = gamma[0].sum(0)
    return np.concatenate([start, (move * moves).ravel(), emit.ravel()])


def training_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Sequences of about equal length; of their pieces, those held at once have ``TRAINED`` tokens with their padding at most."""
    for batch in batches:
        texts = sorted((np.frombuffer(coded, np.uint16) for coded in batch.column(0).to_pylist()), key=len, reverse=True)
        at = 0
        while at < len(texts):
            n = max(TRAINED // min(len(texts[at]), PIECE), 1)
            yield texts[at:at + n]
            at += n


def added(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
    """One sum of all count arrays of a partition."""
    total = None
    for batch in batches:
        for x in batch.column(0).to_pylist():
            total = np.frombuffer(x) + (0 if total is None else total)
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["counts"])


def train(coded: DataFrame, vocab: Vocabulary, states: int = STATES, rounds: int = ROUNDS) -> Model:
    """``coded``: classes. The driver receives at most ``PARTS`` arrays of the model's fixed size a round."""
    model = Model.initial(vocab.class_tokens, states)

    def counted(now: Model):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
            total = None
            for texts in training_batches(batches):
                total = expected_counts(texts, now) + (0 if total is None else total)
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["counts"])
        return run

    for _ in range(rounds):
        parts = map_batches(coded, counted(model), "counts binary")
        sums = map_batches(parts.repartition(PARTS), added, "counts binary").collect()
        if not sums:
            break
        model = Model.of_counts(np.sum([np.frombuffer(r["counts"]) for r in sums], axis=0), states)
    return model


def likelihoods(coded: list[np.ndarray], model: Model) -> np.ndarray:
    """log10 P of each whole sequence of classes."""
    sizes = np.array([len(c) for c in coded])
    order = np.argsort(-sizes, kind="stable")
    flat = np.concatenate(coded)
    offsets = (np.cumsum(sizes) - sizes)[order]
    active = np.searchsorted(-sizes[order], -np.arange(sizes.max()), side="left")
    by_class = np.ascontiguousarray(model.emit.T)
    out, ones = np.zeros(len(coded)), np.ones(len(model.start))
    state = None
    for t, n in enumerate(active):
        a = (model.start if t == 0 else state[:n] @ model.move) * by_class[flat[offsets[:n] + t]]
        scale = a @ ones
        state = a / scale[:, None]
        out[:n] += np.log10(scale)
    result = np.empty(len(coded))
    result[order] = out
    return result


RARE = pa.list_(pa.struct([("word", pa.binary()), ("times", pa.int64())]))


def scored_parts(docs: DataFrame, model: Model, vocab: Vocabulary) -> DataFrame:
    """Per row what the model and the frequent words give, and the words still to be looked up."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        known, denominators = Classes(vocab.own), vocab.denominators()
        denominators[:OWN] = denominators[OWN + ENDINGS:] = 0  # an own word is all its class
        # frequent words by number, so that a word is looked up once; the last place stands for all others
        number = {w: k for k, w in enumerate(vocab.frequent)}
        times = np.array([*vocab.frequent.values(), 0], float)
        base, own = np.log10(times + BASE), np.array([w in vocab.own for w in number] + [True])
        within, other = np.where(own, 0.0, np.log10(times + D)), len(number)
        base[other] = 0
        classes = np.array([*map(known.__getitem__, number), 0], np.uint16)

        def part(text: bytes) -> tuple:
            words = words_of(text)
            words.append(END)
            ids = np.fromiter(map(number.get, words, repeat(other)), np.int64, len(words))
            coded, at = classes[ids], np.flatnonzero(ids == other)
            left = [words[k] for k in at]
            coded[at] = [known[w] for w in left]
            return (
                coded, len(words), len(words) - len(left) - (not vocab.frequent[END]), float(base[ids].sum()),
                float(within[ids].sum() - denominators[coded].sum()), [{"word": w, "times": n} for w, n in Counter(left).items()],
            )

        for batch in batches:
            ids, texts, start = batch.column(0), texts_of(batch), 0
            while start < len(texts):
                rows, size, end = [], 0, start
                while end < len(texts) and size < SCORED:
                    rows.append(part(texts[end]))
                    size += rows[-1][1]
                    end += 1
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [ids[start:end], pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.float64()),
                     pa.array(likelihoods(list(cols[0]), model) + np.array(cols[4])), pa.array(cols[5], RARE)],
                    names=["doc_id", "n_tokens", "n_known", "base_part", "part", "rare"])
                start = end

    return map_batches(docs, run, f"doc_id {kind}, n_tokens long, n_known long, base_part double, part double, "
                                  "rare array<struct<word: binary, times: bigint>>")


def scores(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", folds: int = FOLDS, states: int = STATES,
           rounds: int = ROUNDS) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    training = rows.filter(fold("doc_id", folds) != 0).select("text")
    counts = checkpointed(word_counts(training))
    vocab = vocabulary(counts)
    model = train(checkpointed(sequences(training, vocab.own)), vocab, states, rounds)
    parts = checkpointed(scored_parts(rows, model, vocab).withColumn("row", F.monotonically_increasing_id()))
    asked = parts.select("row", F.inline("rare"))
    n, times = F.coalesce("n", F.lit(0)), F.col("times")
    # an own word is frequent, so these are words of the ending classes; their denominators are in ``part``
    looked_up = asked.join(counts, "word", "left").groupBy("row").agg(
        F.sum(times * (n > 0).cast("long")).alias("more_known"), F.sum(times * F.log10(n + BASE)).alias("more_base"),
        F.sum(times * F.log10(n + D)).alias("more"))
    each = float(np.log10(vocab.tokens + BASE * (vocab.distinct + 1)))
    zero = F.lit(0.0)
    return parts.drop("rare").join(looked_up, "row", "left").select(
        "doc_id", (fold("doc_id", folds) == 0).alias("held_out"), "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(vocab.tokens).cast("long").alias("train_tokens"),
        (F.col("base_part") + F.coalesce("more_base", zero) - F.col("n_tokens") * each).alias("base_score"),
        (F.col("part") + F.coalesce("more", zero)).alias("score"))
