"""Prefix trie of conversations, with subtree totals by time-forward processing.

Rebuilding. Turns are put in order (turn, then the first characters and a hash of role and text) over range partitions and
numbered with carries over the cuts, so one conversation may hold any share of the rows. A conversation c takes the first h turns of
conversation c - c % 100, then its own turns after its first h; h is crc32 of c, modulo 6. From here on a turn is its 128-bit hash
and its size; texts don't travel.

Nodes. The identity of a prefix of d turns is the exclusive or of two 64-bit hashes of (place, turn), a running value that is
carried over cuts as well. Grouping by (d, identity) makes the nodes; a node is named by (conv_id, depth), conv_id its smallest member.

Totals. Time-forward processing: nodes sorted in reverse level order send their subtree's totals forward to their parent through a priority
queue that spills to disk. Within shards first: a node of more than ``cap`` members belongs to the top of the trie; below it each
subtree has at most ``cap`` members, is cut every ``band`` levels, and is dealt to a shard. Then across shard roots: what
shards' roots sum to, per parent, enters the top, which is one more shard of its own. Where bands cut a subtree, their roots pass
through that last shard too, and the shards above them run again with what came from below. ``cap`` and ``band`` grow with the
number of turns R so that the top has less than R / cap and the cuts less than R / band nodes, both at most ``TOP``: the last shard is bounded at any
input, and no conversation, first turn or subtree is a task of its own.

Ends. The ids that end at a node are sorted over range partitions and joined to text there; SHA-256 has no parallel form, so a node's digest is
taken in one task, from a stream of these texts.

Cases: NULL turns come first; NULL role or text is empty; turns that tie are ordered by the first 32 characters of the role, 64 of the text, then a
hash; rows that repeat are turns of their own; rows of a NULL conv_id belong to no conversation; a conversation without rebuilt turns is a
member of the root; an empty table has no node, the root neither; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariffloom.llm.common import checkpointed, map_batches
from tariffloom.llm.disk_queue import DiskQueue
from tariffloom.operators.pieces import placed, running, running_sum, running_xor

FAMILY, HEADS = 100, 6
LIGHT, BAND, TOP = 64, 4096, 1 << 17
LIMIT = 1 << 16
MESSAGE = np.dtype([("key", "i8"), ("leaves", "i8"), ("saved", "i8")])


def _half(digest: Column, start: int) -> Column:
    return F.conv(F.substring(digest, start, 16), 16, -10).cast("long")


def ordered_turns(turns: DataFrame) -> DataFrame:
    """conv, pos (from 1), a, b (hash of role and text), size (code points of the text)."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    rows = turns.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"), "turn", F.left(role, F.lit(32)).alias("r"), F.left(text, F.lit(64)).alias("t"),
        _half(digest, 1).alias("a"), _half(digest, 17).alias("b"), F.length(text).cast("long").alias("size"))
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("r"), F.col("t"), F.col("a"), F.col("b")]
    found = checkpointed(placed(rows, order, ["conv", "a", "b", "size"]))
    return running(found, ["conv"], {"pos": running_sum(F.lit(1).cast("long"))}).drop("_at")


def rebuilt(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """conv, d, a, b, size: the rebuilt turns. ``turns``: of ``ordered_turns``; ``conversations``: conv, h, base."""
    firsts = turns.filter((F.col("conv") % FAMILY == 0) & (F.col("pos") < HEADS)).withColumnRenamed("conv", "base")
    heads = conversations.join(firsts, "base").filter("pos <= h").select("conv", F.col("pos").alias("d"), "a", "b", "size")
    have = firsts.groupBy("base").agg(F.max("pos").alias("m"))
    own = turns.withColumn("h", taken("conv")).filter("pos > h").withColumn("base", F.col("conv") - F.col("conv") % FAMILY)
    tails = own.join(have, "base", "left").select(
        "conv", (F.col("pos") - F.col("h") + F.least("h", F.coalesce("m", F.lit(0)))).alias("d"), "a", "b", "size")
    return heads.unionByName(tails)


def taken(conv: str) -> Column:
    return (F.crc32(F.col(conv).cast("string")) % HEADS).cast("long")


def prefixes(turns: DataFrame) -> DataFrame:
    """conv, d, size, x, y (identity of the first d turns), px, py (of the first d - 1). ``turns``: conv, d, a, b, size."""
    lanes = turns.select("conv", "d", "size", F.xxhash64(F.lit(1), "d", "a", "b").alias("u"), F.xxhash64(F.lit(2), "d", "b", "a").alias("v"))
    rows = checkpointed(placed(lanes, [F.col("conv"), F.col("d")]))
    found = running(rows, ["conv"], {"x": running_xor(F.col("u")), "y": running_xor(F.col("v"))})
    return found.select("conv", "d", "size", "x", "y", F.col("x").bitwiseXOR(F.col("u")).alias("px"), F.col("y").bitwiseXOR(F.col("v")).alias("py"))


def end_digests(ends: DataFrame) -> DataFrame:
    """d, x, y, ends_sha256 of the nodes at which conversations end. ``ends``: conv, d, x, y, a row a conversation."""
    def texts(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            d, x, y, conv, at = (c.to_numpy() for c in batch.columns)
            starts = np.flatnonzero(np.r_[True, (d[1:] != d[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])][:len(d)])
            ids = conv.astype(str)
            lists = [",".join(part) for part in np.split(ids, starts[1:])] if len(d) else []
            yield pa.RecordBatch.from_arrays(
                [pa.array(v[starts]) for v in (d, x, y, at)] + [pa.array(lists, pa.string())], names=["d", "x", "y", "at", "ids"])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done = []
            for *key, ids in zip(*(batch.column(k).to_pylist() for k in range(3)), batch.column(4).to_pylist(), strict=True):
                if key == node:
                    state.update(b"," + ids.encode())
                    continue
                if node is not None:
                    done.append((*node, state.hexdigest()))
                node, state = key, hashlib.sha256(ids.encode())
            if done:
                yield made(done)
        if node is not None:
            yield made([(*node, state.hexdigest())])

    def made(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols[:3]] + [pa.array(cols[3], pa.string())], names=["d", "x", "y", "ends_sha256"])

    ordered = placed(ends.select("d", "x", "y", "conv"), [F.col(c) for c in ("d", "x", "y", "conv")])
    lists = map_batches(ordered, texts, "d long, x long, y long, at long, ids string")
    dealt = lists.repartition("d", "x", "y").sortWithinPartitions("d", "x", "y", "at")
    return map_batches(dealt, digests, "d long, x long, y long, ends_sha256 string")


class Arrivals:
    """Messages to the nodes of one level, in order of their keys."""

    def __init__(self, queue: DiskQueue | None):
        self.blocks = queue.drain() if queue else iter(())
        self.block = np.empty(0, MESSAGE)

    def until(self, last: int) -> Iterator[np.ndarray]:
        """What is addressed to keys up to ``last``."""
        while True:
            n = int(np.searchsorted(self.block["key"], last, side="right"))
            if n:
                yield self.block[:n]
                self.block = self.block[n:]
            if len(self.block):
                return
            following = next(self.blocks, None)
            if following is None:
                return
            self.block = following


def time_forward(nodes: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``nodes`` with leaves and saved summed over their subtrees, as far as these lie in the partition. They must come in reverse
    level order: depth descending, then conv_id. A row that is ``out`` keeps its totals to itself; others send them to
    (parent_conv_id, parent_depth)."""
    names = nodes.columns
    at = [names.index(c) for c in ("depth", "conv_id", "parent_depth", "parent_conv_id", "out", "leaves", "saved")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        waiting: dict[int, DiskQueue] = {}
        level, arrivals = None, Arrivals(None)
        for batch in batches:
            if not batch.num_rows:
                continue
            depth, conv, above, parent = (batch.column(k).fill_null(-1).to_numpy() for k in at[:4])
            out = batch.column(at[4]).to_numpy(zero_copy_only=False)
            leaves, saved = (batch.column(k).to_numpy().copy() for k in at[5:])
            cuts = np.flatnonzero(depth[1:] != depth[:-1]) + 1
            for s, e in zip(np.r_[0, cuts], np.r_[cuts, len(depth)], strict=True):
                if depth[s] != level:
                    level = depth[s]
                    arrivals = Arrivals(waiting.pop(level, None))
                for block in arrivals.until(conv[e - 1]):
                    to = s + np.searchsorted(conv[s:e], block["key"])
                    np.add.at(leaves, to, block["leaves"])
                    np.add.at(saved, to, block["saved"])
                send = s + np.flatnonzero(~out[s:e])
                for goal in np.unique(above[send]):
                    some = send[above[send] == goal]
                    messages = np.empty(len(some), MESSAGE)
                    messages["key"], messages["leaves"], messages["saved"] = parent[some], leaves[some], saved[some]
                    waiting.setdefault(goal, DiskQueue(MESSAGE, limit)).push(messages)
            columns = list(batch.columns)
            columns[at[5]], columns[at[6]] = pa.array(leaves), pa.array(saved)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return map_batches(nodes, run, nodes.schema)


def reverse_levels(nodes: DataFrame) -> DataFrame:
    return nodes.sortWithinPartitions(F.col("depth").desc(), "conv_id")


def trie(turns: DataFrame, light: int = LIGHT, band: int = BAND, top: int = TOP, limit: int = LIMIT, **names: str) -> DataFrame:
    """Per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256. ``names``: of the columns
    conv_id, turn, role and text, where they differ."""
    turns = turns.select(*[F.col(f"`{names.get(c, c)}`").alias(c) for c in ("conv_id", "turn", "role", "text")])
    rows = checkpointed(ordered_turns(turns))
    conversations = rows.groupBy("conv").agg(F.lit(0)).select(
        "conv", taken("conv").alias("h"), (F.col("conv") - F.col("conv") % FAMILY).alias("base"))
    paths = checkpointed(prefixes(rebuilt(rows, conversations)))
    whole = paths.agg(F.count("*"), F.max("d")).first()
    least, members = conversations.agg(F.min("conv"), F.count("*")).first()
    cap, band = max(light, -(-whole[0] // top)), max(band, -(-whole[0] // top))

    nodes = paths.groupBy("d", "x", "y").agg(
        F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"), F.first("size").alias("size"), F.first("px").alias("px"), F.first("py").alias("py"))
    nodes = checkpointed(nodes)
    parents = nodes.select((F.col("d") + 1).alias("d"), F.col("x").alias("px"), F.col("y").alias("py"), F.col("conv_id").alias("parent_conv_id"))
    # the root is every first turn's parent, and no row of the join
    named = nodes.filter("d > 1").join(parents, ["d", "px", "py"]).select(*nodes.columns, "parent_conv_id").unionByName(
        nodes.filter("d = 1").withColumn("parent_conv_id", F.lit(least).cast("long")))
    root = turns.sparkSession.createDataFrame(
        [(0, 0, 0, least, members, 0, None, None, None)] if members else [],
        "d long, x long, y long, conv_id long, n_convs long, size long, px long, py long, parent_conv_id long")
    named = checkpointed(named.unionByName(root))
    children = named.filter("d > 0").groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("d") - 1).alias("d")).agg(F.count("*").alias("n_children"))
    full = named.join(children, ["conv_id", "d"], "left").select(
        "conv_id", F.col("d").alias("depth"), "parent_conv_id", (F.col("d") - 1).alias("parent_depth"), "n_convs",
        F.coalesce("n_children", F.lit(0)).alias("n_children"), F.col("n_children").isNull().cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("size")).alias("saved"), "x", "y")
    full = checkpointed(full)

    # less than one node of the top for each cap turns: at most ``top`` rows
    high = full.filter(F.col("n_convs") > cap).select(F.col("depth").alias("d"), "x", "y")
    begin = paths.join(F.broadcast(high), ["d", "x", "y"], "left_anti").groupBy("conv").agg(F.min(F.struct("d", "x", "y")).alias("begin"))
    begin = begin.select(F.col("conv").alias("conv_id"), F.col("begin.d").alias("begin"), F.col("begin.x").alias("cx"), F.col("begin.y").alias("cy"))
    peak = (F.col("n_convs") > cap) | (F.col("depth") == 0)
    low = full.filter(~peak).join(begin, "conv_id").withColumn("strip", F.floor(F.col("depth") / band)).withColumn(
        "out", (F.col("depth") == F.col("begin")) | (F.col("depth") % band == 0))
    shards = low.repartition("cx", "cy", "strip")
    below = checkpointed(time_forward(reverse_levels(shards), limit))

    def sent(rows: DataFrame) -> DataFrame:
        """What rows that are ``out`` sum to, per parent."""
        return rows.groupBy(F.col("parent_conv_id").alias("conv_id"), F.col("parent_depth").alias("depth")).agg(
            F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))

    def with_more(rows: DataFrame, more: DataFrame) -> DataFrame:
        found = rows.join(more, ["conv_id", "depth"], "left")
        return found.withColumn("leaves", F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).withColumn(
            "saved", F.col("saved") + F.coalesce("more_saved", F.lit(0))).select(*rows.columns)

    columns = ["conv_id", "depth", "parent_conv_id", "parent_depth", "leaves", "saved", "out"]
    peaks = full.filter(peak).withColumn("out", F.col("depth") == 0)
    roots = below.filter("out AND depth = begin")
    if (whole[1] or 0) < band:
        last = with_more(peaks, sent(roots)).select(*columns)
        above = time_forward(reverse_levels(last.repartition(1)), limit)
    else:
        # roots of strips take the root of the strip above them as their parent, on the path of their smallest member
        cuts = below.filter("out AND depth > begin").select(
            *columns, F.greatest("begin", F.floor((F.col("depth") - 1) / band) * band).cast("long").alias("goal"), "x", "y")
        goals = paths.join(F.broadcast(cuts.select(F.col("conv_id").alias("conv"), F.col("goal").alias("d"), F.col("depth").alias("from"))), ["conv", "d"])
        goals = goals.join(nodes.select("d", "x", "y", "conv_id"), ["d", "x", "y"]).select(
            F.col("conv").alias("conv_id"), F.col("from").alias("depth"), F.col("conv_id").alias("parent_conv_id"), F.col("d").alias("parent_depth"))
        strips = checkpointed(cuts.drop("parent_conv_id", "parent_depth").join(goals, ["conv_id", "depth"]).withColumn("out", F.lit(False)).select(*columns))
        met = strips.select(F.col("parent_conv_id").alias("conv_id"), F.col("parent_depth").alias("depth")).distinct()
        kept = roots.join(F.broadcast(met), ["conv_id", "depth"], "left_semi").withColumn("out", F.lit(False)).select(*columns)
        lone = roots.join(F.broadcast(met), ["conv_id", "depth"], "left_anti")
        last = with_more(peaks, sent(lone)).select(*columns).unionByName(kept).unionByName(strips)
        above = checkpointed(time_forward(reverse_levels(last.repartition(1)), limit))
        totals = above.select("conv_id", "depth", F.col("leaves").alias("l"), F.col("saved").alias("s"))
        ready = cuts.drop("leaves", "saved").join(totals, ["conv_id", "depth"]).withColumnsRenamed({"l": "leaves", "s": "saved"})
        below = time_forward(reverse_levels(with_more(shards, sent(ready)).repartition("cx", "cy", "strip")), limit)
    keys = ["conv_id", "depth"]
    tops = peaks.select(*keys, "parent_conv_id", "n_convs", "n_children", "x", "y").join(above.select(*keys, "leaves", "saved"), keys)
    found = tops.unionByName(below.select(*tops.columns))

    bare = conversations.join(paths.select("conv").distinct(), "conv", "left_anti").select("conv", *[F.lit(0).cast("long").alias(c) for c in "dxy"])
    ends = paths.groupBy("conv").agg(F.max(F.struct("d", "x", "y")).alias("e")).select("conv", "e.*").unionByName(bare)
    digests = end_digests(ends).withColumnRenamed("d", "depth")
    return found.join(digests, ["depth", "x", "y"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
