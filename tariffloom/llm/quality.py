"""Quality rules: a learned decision list over text statistics, as one ordered Spark conditional expression.

1. Statistics of whole texts (see ``STATISTICS``), one pass over the corpus without a shuffle.
2. Sequential covering on at most ``SAMPLE`` labelled rows, those of the smallest hash of their id: a rule is a
   conjunction of thresholds that grows on two thirds of the rows still uncovered by information gain, is pruned
   from its end on the other third, and is accepted if it is at least ``PRECISION`` right there. What it covers is removed
   and the next rule grows, until none is accepted.
3. The rules, in order, become ``CASE WHEN ... THEN 'drop' ... ELSE 'keep'`` over the columns of statistics. They can be
   read, stored and edited; ``describe`` prints them.

Words are runs of ``[^\\x20\\x09-\\x0D]``. Cases: NULL and empty texts have zero words; rows that repeat are judged one by one;
NULL labels and labels without a document are not used, a document labelled twice is bad if any label says so; without
labels of both classes the list is empty and keeps every row; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariffloom.llm.common import map_batches, row_of_each, texts_of

SAMPLE = 20_000
RULES, CONDITIONS, CUTS = 24, 4, 64
PRECISION, LEAST_ROWS = 0.9, 3

SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\r\x0b\x0c"
CONTINUED = bytes(range(0x80, 0xC0))
UPPER = bytes(range(65, 91))
LETTERS = bytes([*range(65, 91), *range(97, 123), *range(0x80, 0x100)])

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RATES = (
    "symbol_rate", "dup_line_rate", "repeat_rate", "mean_word", "capital_rate", "exclaim_rate", "digit_rate", "other_rate",
    "distinct_rate", "words_a_line", "end_rate",
)
STATISTICS = (*COUNTS, *RATES)
#: Rules are about rates, which don't grow with the text, and about its length.
LEARNED = ("n_words", *RATES)


def repeat_words(words: list[bytes], window: int = 3) -> int:
    """Words inside windows of ``window`` words that are found twice or more, the first included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    key = ids[:n].copy()
    for k in range(1, window):
        # dense numbers of the windows so far, so that no product overflows
        if k > 1:
            key = np.unique(key, return_inverse=True)[1]
        key = key * len(number) + ids[k:n + k]
    _, at, times = np.unique(key, return_inverse=True, return_counts=True)
    found = np.flatnonzero(times[at] > 1)
    covered = np.zeros(len(words) + 1, np.int64)
    np.add.at(covered, found, 1)
    np.add.at(covered, found + window, -1)
    return int((covered.cumsum() > 0).sum())


def statistics(text: bytes) -> tuple:
    words = text.split()  # bytes: ASCII blanks only
    lines = [x for x in text.split(b"\n") if x.strip()]
    count = lambda chars: len(text) - len(text.translate(None, chars))
    n, chars = len(words), len(text) - count(CONTINUED) - count(BLANKS)
    symbols, dup, repeat = count(SYMBOLS), len(lines) - len(set(lines)), repeat_words(words)
    size, many = max(chars, 1), max(n, 1)
    letters, digits = count(LETTERS) - count(CONTINUED), count(b"0123456789")
    ends = sum(x.rstrip()[-1:] in b".!?\"'" for x in lines)
    return (
        n, chars, symbols, dup, repeat,
        symbols / size, dup / max(len(lines), 1), repeat / many, chars / many, count(UPPER) / size, text.count(b"!") / many,
        digits / size, (chars - letters - digits) / size, len(set(words)) / many, n / max(len(lines), 1), ends / max(len(lines), 1),
    )


def measured(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The ``keep`` columns and ``STATISTICS``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            cols = list(zip(*map(statistics, texts_of(batch, "_text")))) or [()] * len(STATISTICS)
            made = [pa.array(c, pa.int64() if name in COUNTS else pa.float64()) for name, c in zip(STATISTICS, cols)]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *made], names=[*batch.schema.names[1:], *STATISTICS])

    rows = docs.select(F.col(f"`{text}`").alias("_text"), *[F.col(f"`{c}`") for c in keep])
    wide = rows.drop("_text").withColumns({c: F.lit(0).cast("long" if c in COUNTS else "double") for c in STATISTICS})
    return map_batches(rows, run, wide.schema)


@dataclass(frozen=True)
class Condition:
    name: str
    above: bool
    cut: float

    def column(self) -> Column:
        return F.col(self.name) > self.cut if self.above else F.col(self.name) <= self.cut

    def holds(self, x: np.ndarray) -> np.ndarray:
        v = x[:, STATISTICS.index(self.name)]
        return v > self.cut if self.above else v <= self.cut

    def __str__(self) -> str:
        return f"{self.name} {'>' if self.above else '<='} {self.cut:.6g}"


Rule = tuple[Condition, ...]


def covers(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for c in rule:
        out &= c.holds(x)
    return out


def best_condition(x: np.ndarray, bad: np.ndarray) -> Condition | None:
    """The threshold with the largest information gain over the rows of ``x`` (bad: what the rule looks for)."""
    p0, n0 = bad.sum(), len(bad) - bad.sum()
    before = np.log2(p0 / (p0 + n0))
    best, found = 1e-6, None
    for name in LEARNED:
        values = x[:, STATISTICS.index(name)]
        cuts = np.unique(np.quantile(values, np.linspace(0, 1, CUTS + 1), method="lower"))[:-1]
        if not len(cuts):
            continue
        at = np.searchsorted(cuts, values, side="left")  # value <= cuts[k]  <=>  at <= k
        low_p = np.bincount(at, bad, len(cuts) + 1).cumsum()[:-1]
        low = np.bincount(at, minlength=len(cuts) + 1).cumsum()[:-1]
        for above, p, n in ((False, low_p, low - low_p), (True, p0 - low_p, (len(bad) - low) - (p0 - low_p))):
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(p > 0, p * (np.log2(p / (p + n)) - before), 0)
            k = int(gain.argmax())
            if gain[k] > best:
                best, found = gain[k], Condition(name, above, float(cuts[k]))
    if found is None:
        return None
    values = x[:, STATISTICS.index(found.name)]  # in the middle of the gap, not at its edge
    return Condition(found.name, found.above, float((found.cut + values[values > found.cut].min()) / 2))


def grow(x: np.ndarray, bad: np.ndarray) -> Rule:
    rule: Rule = ()
    inside = np.ones(len(x), bool)
    while len(rule) < CONDITIONS and 0 < bad[inside].sum() < inside.sum():
        condition = best_condition(x[inside], bad[inside])
        if condition is None:
            break
        rule += (condition,)
        inside &= condition.holds(x)
    return rule


def worth(rule: Rule, x: np.ndarray, bad: np.ndarray) -> float:
    inside = covers(rule, x)
    p, n = bad[inside].sum(), (~bad[inside]).sum()
    return (p - n) / (p + n) if p + n else -1.0


def prune(rule: Rule, x: np.ndarray, bad: np.ndarray) -> Rule:
    """The beginning of ``rule`` that is worth most on unseen rows; the shorter one of equals."""
    return max((rule[:k] for k in range(1, len(rule) + 1)), key=lambda r: (round(worth(r, x, bad), 9), -len(r)))


def cover(x: np.ndarray, bad: np.ndarray) -> list[Rule]:
    """Ordered rules for the bad rows. Every third row, in the order given, is kept for pruning."""
    rules: list[Rule] = []
    left = np.ones(len(x), bool)
    third = np.arange(len(x)) % 3 == 2
    while len(rules) < RULES and bad[left & ~third].sum() >= LEAST_ROWS:
        rule = grow(x[left & ~third], bad[left & ~third])
        if not rule:
            break
        rule = prune(rule, x[left & third], bad[left & third])
        inside = covers(rule, x) & left
        p, held = bad[inside].sum(), bad[inside & third]
        if p < LEAST_ROWS or p / inside.sum() < PRECISION or (len(held) and held.mean() < PRECISION):
            break
        rules.append(rule)
        left &= ~inside
    return rules


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> list[Rule]:
    known = labels.filter("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)  # bounded: the hint below is safe
    rows = row_of_each(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), "doc_id", "quality").select(
        "text", (F.col("quality") <= 0).alias("bad"), F.xxhash64("doc_id").alias("place"))
    # the list judges what the base rules leave, so it learns from such rows; at most ``sample`` rows of numbers
    table = measured(rows, ("bad", "place")).filter(~base_failed()).toPandas()
    table = table.sort_values(["place", *STATISTICS], kind="stable")
    return cover(table[list(STATISTICS)].to_numpy(float), table.bad.to_numpy(bool))


def verdict(rules: list[Rule]) -> Column:
    """The list as one expression over the columns of ``STATISTICS``: 'drop' or 'keep'."""
    out = None
    for rule in rules:
        condition = rule[0].column()
        for c in rule[1:]:
            condition &= c.column()
        out = F.when(condition, "drop") if out is None else out.when(condition, "drop")
    return F.lit("keep") if out is None else out.otherwise("keep")


def describe(rules: list[Rule]) -> list[str]:
    return [" and ".join(map(str, rule)) + " -> drop" for rule in rules] + ["otherwise -> keep"]


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


def judged(docs: DataFrame, rules: list[Rule], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, all statistics, base_failed, kept."""
    rows = measured(docs, (doc_id,), text).withColumn("base_failed", base_failed())
    return rows.withColumn("kept", ~F.col("base_failed") & (verdict(rules) == "keep"))
