"""Importance resampling towards a target: documents are drawn by how much their n-grams look like the target's.

Overlapped regex scanning. Every separator run of a lower-cased text is collapsed to one space; then one ``finditer`` with
``overlapped=True`` steps from word start to word start, held there by a lookbehind, and each match carries the spans of the
runs of 1, 2 .. words that begin there, as the ends of nested groups. The bytes of a span go straight to CRC-32; no word list is built.

1. ``hashed`` maps whole texts to their features' buckets, two bytes a feature, and writes them to the shared folder, so that
   texts are scanned once.
2. Buckets are counted over all documents and over the target: each task adds its rows up to one vector. The two vectors,
   of ``BUCKETS`` numbers at any size of the corpus, give a bucket's gain: a thousandfold log ratio of smoothed frequencies, floored.
3. A document's weight is the floored mean of its features' gains; the score adds Gumbel noise from a hash of the id, so that
   the highest scores are a draw without replacement, proportional to the exponential of the weights.
4. Scores are whole numbers of a bounded range (gains and noise are logarithms), so a histogram finds the lowest drawn
   one. Documents from there on are put in order over range partitions and numbered by the sizes of these.

Cases: NULL and empty texts have no features, weight 0, and are never drawn (too few words); a NULL id counts as empty text in
the noise and comes first among equal scores; rows that repeat an id share its noise and take ranks one after the other, by
a hash of their text; very long texts are scanned in blocks of matches; an empty target smooths to zero counts; empty tables give
empty results; other columns, whatever their names, are ignored by ``ranked`` and kept by ``resampled``.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariffloom.llm.common import checkpointed, ids_of, map_batches, remove, shared_folder, texts_of
from tariffloom.operators.pieces import placed

LONGEST, BUCKETS, LEAST_WORDS, SHARE, SEED = 2, 10_000, 20, (25, 100), 7
SEPARATORS = regex.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BLOCK = 1 << 14


def run_pattern(longest: int) -> regex.Pattern:
    """Group k ends where the run of k words ends; the lookarounds hold both ends of a run at spaces."""
    tail = ""
    for _ in range(longest - 1):
        tail = rf"(?:( [^ ]++){tail})?+"
    return regex.compile(rf"(?<![^ ])([^ ]++){tail}(?![^ ])".encode())


class Scanner:
    """Words and feature buckets of one text."""

    def __init__(self, longest: int = LONGEST, buckets: int = BUCKETS):
        self.longest, self.buckets, self.runs = longest, buckets, run_pattern(longest)

    def __call__(self, text: bytes) -> tuple[int, np.ndarray]:
        text, crc = SEPARATORS.sub(b" ", text.lower()), zlib.crc32  # bytes.lower touches A-Z only
        found, words, parts = self.runs.finditer(text, overlapped=True), 0, []
        while block := list(islice(found, BLOCK)):
            words += len(block)
            hashes = [crc(m[1]) for m in block]
            for k in range(2, self.longest + 1):
                hashes += [crc(text[m.start():end]) for m in block if (end := m.end(k)) >= 0]
            parts.append((np.array(hashes, np.uint32) % self.buckets).astype("<u2"))
        return words, np.concatenate(parts) if parts else np.empty(0, "<u2")


def hashed(rows: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """``rows``: doc_id, text. doc_id, n_words, n_features, found (little-endian 16-bit buckets), text_hash."""
    if not 0 < buckets <= 1 << 16:
        raise ValueError("buckets are stored in 16 bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        scan = Scanner(longest, buckets)
        for batch in batches:
            made = [scan(text) for text in texts_of(batch)]
            yield pa.RecordBatch.from_arrays([
                ids_of(batch), ids_of(batch, "text_hash"), pa.array([w for w, _ in made], pa.int64()),
                pa.array([len(f) for _, f in made], pa.int64()), pa.array([f.tobytes() for _, f in made], pa.binary()),
            ], names=["doc_id", "text_hash", "n_words", "n_features", "found"])

    rows = rows.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_batches(rows, run, f"doc_id {kind}, text_hash long, n_words long, n_features long, found binary")


def bucket_counts(features: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs: a vector a task, summed by bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for data in batch.column(0):
                total += np.bincount(np.frombuffer(data.as_buffer() or b"", "<u2"), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some], pa.int64())], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for bucket, n in map_batches(features.select("found"), run, "bucket int, n long").groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln((t + 1) * (S + B) / ((s + 1) * (T + B)))) of each bucket, in doubles."""
    size, whole, goal = len(corpus), float(corpus.sum()), float(target.sum())
    return np.array([
        math.floor(1000 * math.log((float(t) + 1) * (whole + size) / ((float(s) + 1) * (goal + size))))
        for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def weighed(features: DataFrame, gain: np.ndarray) -> DataFrame:
    """``features`` with weight, the floored mean gain (0 without features), in place of ``found``."""
    keep = [c for c in features.columns if c != "found"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            weights = []
            for data in batch.column(batch.schema.get_field_index("found")):
                at = np.frombuffer(data.as_buffer() or b"", "<u2")
                weights.append(int(gain[at].sum()) // len(at) if len(at) else 0)
            yield pa.RecordBatch.from_arrays([*[ids_of(batch, c) for c in keep], pa.array(weights, pa.int64())], names=[*keep, "weight"])

    schema = ", ".join(f"{c} {features.schema[c].dataType.simpleString()}" for c in keep)
    return map_batches(features, run, f"{schema}, weight long")


def noise(seed: int = SEED) -> Column:
    """floor(-1000 * ln(-ln(u))): Gumbel noise of the id, u from the first 32 bits of a SHA-256."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def numbered(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` (placed, and written) with their place, from 1, in the whole order. The place in a piece stands in ``_at`` already, and the
    driver adds up the sizes of the pieces."""
    piece, within = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    starts, total = [], 0
    for p, n in sorted(rows.groupBy(piece.alias("p")).agg(F.count("*").alias("n")).collect()):
        starts.append((p, total))
        total += n
    offsets = rows.sparkSession.createDataFrame(starts, "_p long, _start long")  # a row a piece
    return rows.join(F.broadcast(offsets), piece == F.col("_p")).withColumn(name, F.col("_start") + within + 1).drop("_p", "_start", "_at")


def ranked(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text",
           longest: int = LONGEST, buckets: int = BUCKETS, least_words: int = LEAST_WORDS, share: tuple[int, int] = SHARE,
           seed: int = SEED) -> DataFrame:
    """Per row of ``docs``: doc_id, n_features, weight, score, rank (NULL: not drawn), n_words, text_hash."""
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    goal = target.select(F.lit(0).alias("doc_id"), F.col(f"`{target_text}`").alias("text"))
    spark, folder = docs.sparkSession, f"{shared_folder(docs.sparkSession)}/features-{uuid.uuid4().hex}"
    hashed(source, longest, buckets).write.option("compression", "zstd").parquet(folder)
    found = spark.read.parquet(folder)
    gain = gains(bucket_counts(found, buckets), bucket_counts(hashed(goal, longest, buckets), buckets))
    rows = checkpointed(weighed(found, gain).withColumn("score", F.col("weight") + noise(seed)))
    remove(spark, folder)
    may = F.col("n_words") >= least_words
    heights = sorted(rows.filter(may).groupBy("score").agg(F.count("*").alias("n")).collect(), reverse=True)  # bounded by the range of scores
    wanted = sum(n for _, n in heights) * share[0] // share[1]
    lowest, above = None, 0
    for lowest, n in heights:  # noqa: B007
        above += n
        if above >= wanted:
            break
    near = may & (F.col("score") >= F.lit(lowest)) if wanted else F.lit(False)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_first(), F.col("text_hash")]
    drawn = numbered(checkpointed(placed(rows.filter(near), order)), "rank") if wanted else rows.filter(near).withColumn("rank", F.lit(0).cast("long"))
    drawn = drawn.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank")))
    rest = rows.filter(~near).withColumn("rank", F.lit(None).cast("long"))
    columns = ["doc_id", "n_features", "weight", "score", "rank", "n_words", "text_hash"]
    return drawn.select(columns).unionByName(rest.select(columns))


def resampled(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The drawn rows of ``docs`` with all their columns. Rows equal in id and text are drawn together."""
    drawn = ranked(docs, target, doc_id, text, **how).filter("rank IS NOT NULL").select(
        F.col("doc_id").alias("_drawn"), F.col("text_hash").alias("_hash")).distinct()
    return docs.join(drawn, docs[f"`{doc_id}`"].eqNullSafe(F.col("_drawn")) & (F.xxhash64(docs[f"`{text}`"]) == F.col("_hash")), "left_semi")
