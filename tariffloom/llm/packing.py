"""Packing: length buckets whose boundaries minimise padding, and token-budget batches inside each bucket.

1. Lengths are counted into a global histogram, a bin for each distinct length; n distinct lengths take n * (n - 1) / 2 words
   at least, so the ``DISTINCT`` bins that are allowed suffice for any input of up to 8.5e9 words. Beyond them, lengths up
   to ``EXACT`` have a bin each; above, ``FINE`` bins cover each doubling, and every bin carries its row count, its summed
   length and its true maximum: at most ``EXACT`` + 64 * ``FINE`` rows. The histogram is the only thing the driver sees.
2. Dynamic programming over the bins chooses at most ``buckets`` boundaries (true maxima of bins) so that the tokens of
   padding, every row padded to its bucket's boundary, are fewest; with a bin for each length this is the optimum over all
   lengths, else boundaries between bins are optimal.
3. A batch of a bucket with boundary L has max(1, budget // L) rows. Rows are numbered inside their bucket over slices:
   a slice holds about ``SLICE`` rows, so a bucket with a third of all rows becomes many tasks; the slices' offsets come
   from their counts. All batches of a bucket but its last are full.

Cases: NULL and wordless texts have length 0 and form batches of the bucket they fall in; a row longer than the budget is a
batch of its own; rows that repeat are placed one by one; an empty table gives an empty result; extra columns are kept, but for
those named like a column of the result, which take its values.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from tariffloom.llm.common import checkpointed

DISTINCT, EXACT, FINE = 1 << 17, 1024, 64
BUCKETS, BUDGET, SLICE = 16, 32768, 20_000


def word_count(text: Column) -> Column:
    """Runs of ``[^\\x20\\x09-\\x0D]``; NULL has none."""
    body = F.regexp_replace(F.coalesce(text, F.lit("")), r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    return F.when(body == "", F.lit(0)).otherwise(F.size(F.split(body, r"[\x20\x09-\x0D]+"))).cast("long")


def bin_of(length: Column) -> Column:
    """The bin of a length: itself up to ``EXACT``, then ``FINE`` equal steps within each doubling."""
    octave = F.floor(F.log2(length / EXACT)).cast("long")
    low = F.pow(F.lit(2.0), octave) * EXACT
    return F.when(length < EXACT, length).otherwise(EXACT + octave * FINE + F.floor((length - low) / low * FINE)).cast("long")


def boundaries(counts: Sequence[int], sums: Sequence[int], tops: Sequence[int], buckets: int) -> list[int]:
    """Boundaries (of ``tops``, ascending) of at most ``buckets`` groups of consecutive bins with the least padding.

    cost(i, j) = tops[j] * rows(i..j) - tokens(i..j). Each layer is solved by divide and conquer: the best start of the last
    group never moves left as the end moves right.
    """
    n = len(tops)
    if not n:
        return []
    rows, tokens = np.concatenate([[0], np.cumsum(counts)]), np.concatenate([[0], np.cumsum(sums)])
    tops = np.asarray(tops, np.int64)
    best = tops * rows[1:] - tokens[1:]  # one group
    starts: list[np.ndarray] = []
    for _ in range(1, min(buckets, n)):
        now, cut = best.copy(), np.full(n, -1)
        stack = [(0, n - 1, 0, n - 1)]
        while stack:
            lo, hi, a, b = stack.pop()
            if lo > hi:
                continue
            end = (lo + hi) // 2
            begin = np.arange(max(a, 1), min(b, end) + 1)  # the last group is begin..end
            where = a
            if len(begin):
                cost = best[begin - 1] + tops[end] * (rows[end + 1] - rows[begin]) - (tokens[end + 1] - tokens[begin])
                k = int(cost.argmin())
                where = int(begin[k])
                if cost[k] < now[end]:
                    now[end], cut[end] = cost[k], where
            stack += [(lo, end - 1, a, where), (end + 1, hi, where, b)]
        starts.append(cut)
        best = now
    out, end = [], n - 1
    for cut in reversed(starts):
        if end >= 0 and cut[end] >= 0:
            out.append(int(tops[end]))
            end = int(cut[end]) - 1
    out.append(int(tops[end]))
    return sorted(out)


def histogram(lengths: DataFrame, length: str = "length") -> DataFrame:
    """bin, n, tokens, top: a bounded number of rows."""
    return lengths.groupBy(bin_of(F.col(length)).alias("bin")).agg(
        F.count("*").alias("n"), F.sum(length).alias("tokens"), F.max(length).alias("top"))


def counted(lengths: DataFrame, length: str = "length", distinct: int = DISTINCT) -> list[Row]:
    """n, tokens, top of each length, ascending; those of the bins of ``histogram`` if there are more than ``distinct``."""
    each = lengths.groupBy(F.col(length).alias("top")).agg(F.count("*").alias("n"), F.sum(length).alias("tokens"))
    found = each.limit(distinct + 1).collect()
    return sorted(found if len(found) <= distinct else histogram(lengths, length).collect(), key=lambda r: r["top"])


def assigned(rows: DataFrame, length: str, bounds: Sequence[int], budget: int = BUDGET, slice_rows: int = SLICE,
             order: Sequence[str] = ()) -> DataFrame:
    """``rows`` (with a unique ``_row``) and the columns bucket, bucket_len, batch, slot, padding. Inside a slice rows are
    numbered by ``order``, then by ``_row``."""
    tops = F.array(*[F.lit(int(b)).cast("long") for b in bounds or [0]])  # without rows there is no bound
    bucket = F.lit(0)  # a sum of comparisons: as a filter of an array, Spark may fail to resolve it above a window
    for b in bounds:
        bucket = bucket + (F.col(length) > F.lit(int(b))).cast("int")
    placed = rows.withColumn("bucket", bucket).withColumn("bucket_len", F.element_at(tops, F.col("bucket") + 1))
    sizes = placed.groupBy("bucket").agg(F.count("*").alias("_n"))
    slices = {r["bucket"]: -(-r["_n"] // slice_rows) for r in sizes.collect()}  # a row for each bucket
    count = F.element_at(F.array(*[F.lit(max(slices.get(k, 1), 1)) for k in range(max(len(bounds), 1))]), F.col("bucket") + 1)
    placed = placed.withColumn("_slice", F.pmod(F.xxhash64("_row"), count))
    within = Window.partitionBy("bucket", "_slice").orderBy(*[F.col(f"`{c}`") for c in order], "_row")
    # under names of their own: the aggregate of a table is joined with that table
    offsets = (
        placed.groupBy(F.col("bucket").alias("_bucket_of"), F.col("_slice").alias("_slice_of")).agg(F.count("*").alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(
            Window.partitionBy("_bucket_of").orderBy("_slice_of").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .drop("_n")
    )
    rank = F.col("_before") + F.row_number().over(within) - 1
    per_batch = F.greatest(F.floor(F.lit(budget) / F.greatest("bucket_len", F.lit(1))), F.lit(1)).cast("long")
    return (
        placed.join(offsets, (F.col("bucket") == F.col("_bucket_of")) & (F.col("_slice") == F.col("_slice_of"))).withColumn("_rank", rank).withColumn("_per", per_batch)
        .withColumn("batch", F.floor(F.col("_rank") / F.col("_per")).cast("long"))
        .withColumn("slot", F.col("_rank") % F.col("_per"))
        .withColumn("padding", F.col("bucket_len") - F.col(length))
        .drop("_row", "_slice", "_before", "_rank", "_per", "_bucket_of", "_slice_of")
    )


def pack(lengths: DataFrame, length: str = "length", buckets: int = BUCKETS, budget: int = BUDGET, order: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``lengths`` (``order`` columns, ``length``) with bucket, bucket_len, batch, slot, padding."""
    lengths = checkpointed(lengths.withColumn("_row", F.monotonically_increasing_id()))  # the checkpoint fixes the numbers
    bins = counted(lengths, length)
    bounds = boundaries([b["n"] for b in bins], [b["tokens"] for b in bins], [b["top"] for b in bins], buckets)
    return assigned(lengths, length, bounds, budget, order=order)
