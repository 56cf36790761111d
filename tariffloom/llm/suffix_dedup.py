"""Suffix-array dedup: bytes covered by a 50-byte string that also starts in a document with a smaller id are removed.

1. Copies. Texts are grouped by their SHA-256; of equal texts only the one with the smallest id goes on. A copy with a
   larger id is covered as a whole (if it has a window at all).
2. Anchors (``windows``). Every 50-byte window names an anchor inside itself by content alone; a run of windows with one anchor
   is a stretch. Anchor hashes are gathered in packed arrays by buckets of the hash; those that are in two documents or
   more are sent back to their documents. Windows of other anchors can't repeat and go no further.
3. Shards. The stretches of repeated anchors meet in shards by their anchor, where external induced sorting
   (``induced_sort``) orders the suffixes of all their windows, with common prefixes, in bounded memory, and marks windows
   that a smaller id has too.
4. Marked windows become byte intervals per document, and these the removed bytes.

Hot passages: a task sends an anchor once, and a stretch's content once with its smallest id, for all documents it has at hand;
the larger ids among them are settled there and then. So a passage that a third of all documents share costs each shard a
record per task, not per document. Rows that repeat an id and a text are one document: a task looks at one of them, and what
several tasks find about it is the same and put together in partial sets, so its lists are as long as those of a single row.
Buckets and shards grow in number with the input up to ``MOST``; a bucket beyond memory is sorted on disk. Texts are shuffled once, by their spot
(32 bits of a hash of id and text), for both joins that need them; the list of copies is broadcast only below a measured
size, else shuffled. Lists are gathered by spot, so each is one document's, however many rows share an id or have none.
Documents that share a spot by chance get each other's anchors, which are more windows to judge and no other result.

Windows are judged on the input and never cross documents; overlaps count. Cases: NULL and empty texts have no window; texts
shorter than a window keep all bytes; a NULL id counts as larger than any other; rows that repeat an id don't affect
each other, whatever their texts; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariffloom.llm.common import broadcast_if_small, checkpointed, map_batches, texts_of
from tariffloom.llm.disk_queue import DiskQueue
from tariffloom.llm.induced_sort import LIMIT, SAMPLED, repeated_windows
from tariffloom.llm.windows import SPAN, WINDOW, Stretches, stretches

#: Text bytes a task looks at together; anchors of a bucket that are aimed at (a shard gets fewer); bytes an anchor stands for.
TOGETHER, BUCKET, EVERY = 16 << 20, 1 << 17, 17
#: Buckets and shards: more would leave a task's message to each of them too small. Anchors of a bucket that are sorted in memory.
MOST, IN_MEMORY = 1 << 15, 1 << 22
ANCHOR = np.dtype([("key", "u8"), ("owner", "i8")])
LAST = (1 << 63) - 1


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """id (NULL last), key (of the text), spot (of both), sha, text."""
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(
        F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(LAST)).alias("id"), F.xxhash64(value).alias("key"), value.alias("text"))
    return rows.select("id", "key", spot_of("id", "key").alias("spot"), F.sha2("text", 256).alias("sha"), "text")


def spot_of(*cols: str) -> Column:
    return F.xxhash64(*cols).bitwiseAND(F.lit((1 << 32) - 1))


def together(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Rows of about ``TOGETHER`` bytes of text."""
    held, size = [], 0
    for batch in batches:
        texts, start, part = texts_of(batch, text), 0, 0
        for k, t in enumerate(texts):
            part += len(t)
            if size + part >= TOGETHER:
                held.append(batch.slice(start, k + 1 - start))
                rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                yield rows, texts_of(rows, text)
                held, size, start, part = [], 0, k + 1, 0
        if start < len(texts):
            held.append(batch.slice(start))
            size += part
    if held:
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        yield rows, texts_of(rows, text)


def bucket_keys(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket in the upper, 32 bits of the rest in the lower half."""
    n = np.uint64(buckets)
    return (hashes % n) << np.uint64(32) | (hashes // n) & np.uint64(0xFFFFFFFF)


def planes(values: np.ndarray) -> bytes:
    """Ascending 32-bit numbers as four rows of bytes: that of the highest ones is runs, which compression takes away."""
    return values.view(np.uint8).reshape(-1, 4).T.tobytes()


def from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view(np.uint32).ravel()


def sent_twice(blocks: Iterator[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys and owners of the ``ANCHOR`` records, ascending by key, whose key comes twice or more, each pair once a block. Twice from one spot
    is enough: equal spots may be two documents. The last record of a block waits for the next one."""
    waiting, going_on = np.empty(0, ANCHOR), None
    for block in blocks:
        rows = np.concatenate([waiting, block])
        rows = rows[np.lexsort((rows["owner"], rows["key"]))]
        keys, owners = rows["key"], rows["owner"]
        new = np.r_[True, keys[1:] != keys[:-1]]
        several = ~(new & np.r_[new[1:], True])
        if going_on is not None:
            several |= keys == going_on
        single = not several[-1]
        several &= new | np.r_[True, owners[1:] != owners[:-1]]
        if several.any():
            yield keys[several], owners[several]
        waiting, going_on = (rows[-1:], None) if single else (rows[:0], keys[-1])


def repeated_anchors(texts: DataFrame, buckets: int, in_memory: int = IN_MEMORY) -> DataFrame:
    """spot, keys (binary: 64-bit bucket keys of anchors that are in another document too). ``texts``: id, key, spot, text."""
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for rows, values in together(batches):
            found = stretches(values)
            # rows of one id and text are one document; those that only share a spot are not
            _, first, doc = np.unique(
                np.rec.fromarrays([rows.column(0).to_numpy(), rows.column(1).to_numpy()], names="id,key"),
                return_index=True, return_inverse=True)
            spots = rows.column(2).to_numpy()[first]
            pairs = np.unique(np.rec.fromarrays([bucket_keys(found.hash, buckets), doc[found.doc]], names="key,doc"))
            if not len(pairs):
                continue
            keys, owners = pairs["key"], spots[pairs["doc"]]
            starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            here = np.repeat(np.diff(np.r_[starts, len(keys)]) > 1, np.diff(np.r_[starts, len(keys)]))
            yield packed(keys[starts], owners[starts])  # one of each goes to its bucket
            yield settled(keys[here], owners[here], buckets)  # what repeats here is known already

    def packed(keys: np.ndarray, owners: np.ndarray) -> pa.RecordBatch:
        bucket = (keys >> np.uint64(32)).astype(np.int32)
        cuts = np.r_[np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]), len(bucket)]
        small, owners = keys.astype(np.uint32), owners.astype(np.uint32)
        return pa.RecordBatch.from_arrays([
            pa.array(bucket[cuts[:-1]]), pa.nulls(len(cuts) - 1, pa.int64()),
            pa.array([planes(small[a:b]) for a, b in zip(cuts, cuts[1:])], pa.binary()),
            pa.array([owners[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary())], names=["bucket", "spot", "keys", "owners"])

    def settled(keys: np.ndarray, owners: np.ndarray, spread: int) -> pa.RecordBatch:
        order = np.argsort(owners, kind="stable")
        keys, owners = keys[order], owners[order]
        cuts = np.r_[np.flatnonzero(np.r_[True, owners[1:] != owners[:-1]][:len(owners)]), len(owners)]
        spots = owners[cuts[:-1]]
        return pa.RecordBatch.from_arrays([
            pa.array((spots % spread).astype(np.int32)), pa.array(spots, pa.int64()),
            pa.array([keys[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
            pa.nulls(len(spots), pa.binary())], names=["bucket", "spot", "keys", "owners"])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        bucket_anchors = DiskQueue(ANCHOR, in_memory)
        current = None

        def close() -> Iterator[pa.RecordBatch]:
            for keys, owners in sent_twice(bucket_anchors.drain()):
                yield settled(keys, owners, 1).select(["spot", "keys"])

        for batch in batches:
            known = batch.column(3).is_null()
            yield batch.filter(known).select(["spot", "keys"])
            asked = batch.filter(pc.invert(known)).select(["bucket", "keys", "owners"])
            for bucket, keys, owners in zip(*(c.to_pylist() for c in asked.columns)):
                if bucket != current:
                    yield from close()
                    current = bucket
                part = np.empty(len(owners) // 4, ANCHOR)
                part["key"] = from_planes(keys).astype(np.uint64) | np.uint64(bucket) << np.uint64(32)
                part["owner"] = np.frombuffer(owners, np.uint32)
                bucket_anchors.push(part)
        yield from close()

    asks = map_batches(texts, ask, "bucket int, spot long, keys binary, owners binary")
    return map_batches(asks.repartition("bucket").sortWithinPartitions("bucket"), answer, "spot long, keys binary")


def candidate_stretches(texts: DataFrame, buckets: int, shards: int) -> DataFrame:
    """shard, id, key, content, left, more, places. ``texts``: id, key, keys (array of binary), text. A stretch that is in a
    smaller id of the same task is settled, has no content and a negative shard; the others are still to be judged.

    ``left``: bytes of the content before its anchor; ``more``: its windows after the first; ``places``: its anchors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for rows, values in together(batches):
            _, first = np.unique(np.rec.fromarrays([rows.column(0).to_numpy(), rows.column(1).to_numpy()], names="id,key"), return_index=True)
            if len(first) < len(values):  # rows of one id and text are one document
                first.sort()
                rows, values = rows.take(pa.array(first)), [values[k] for k in first]
            ids, keys = rows.column(0).to_pylist(), rows.column(1).to_pylist()
            wanted = np.unique(np.frombuffer(b"".join(x for row in rows.column(2).to_pylist() for x in row), np.uint64))
            found = stretches(values)
            at = np.flatnonzero(np.isin(bucket_keys(found.hash, buckets), wanted))
            yield candidates(found, at, values, ids, keys)

    def candidates(found: Stretches, at: np.ndarray, values: list[bytes], ids: list[int], keys: list[int]) -> pa.RecordBatch:
        # content -> document -> anchors; a content holds its anchor at one place only
        seen: dict[bytes, dict[int, list[int]]] = {}
        about: dict[bytes, tuple[int, int]] = {}
        for doc, first, last, anchor, mark in zip(*(x[at].tolist() for x in (found.doc, found.first, found.last, found.anchor, found.hash))):
            content = values[doc][first:last + WINDOW]
            if content not in seen:
                seen[content] = {}
                about[content] = (anchor - first, mark)
            seen[content].setdefault(doc, []).append(anchor)
        out = []
        for content, docs in seen.items():
            left, mark = about[content]
            low = min(ids[d] for d in docs)
            for d, anchors in docs.items():
                whole = ids[d] > low
                # rows that repeat the smallest id: each is judged
                out.append((-1 - ids[d] % shards if whole else mark % shards, ids[d], keys[d], None if whole else content, left,
                            len(content) - WINDOW, np.array(anchors, np.int64).tobytes()))
        cols = list(zip(*out)) or [()] * 7
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                          names=["shard", "id", "key", "content", "left", "more", "places"])

    return map_batches(texts, run, "shard int, id long, key long, content binary, left int, more int, places binary")


def all_bits(left: int, more: int) -> int:
    """Mask of all windows of a stretch."""
    return (1 << left + 1) - (1 << left - more)


def marked_windows(candidates: DataFrame, limit: int = LIMIT) -> DataFrame:
    """id, key, places (anchors), mask (bit j: the window j bytes left of each anchor is in a smaller id too)."""
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
        """Parts of batches, each of one shard."""
        for batch in batches:
            shard = batch.column(0).to_numpy()
            cuts = np.r_[np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]][:len(shard)]), len(shard)]
            for a, b in zip(cuts, cuts[1:]):
                yield int(shard[a]), batch.slice(a, b - a)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for shard, group in groupby(pieces(batches), key=lambda p: p[0]):
            rows = (batch for _, batch in group)
            yield from map(settled_windows, rows) if shard < 0 else shard_windows(rows, limit)

    spread = candidates.repartition("shard").sortWithinPartitions("shard")
    return map_batches(spread, run, "id long, key long, places binary, mask long")


def window_batch(ids, keys, places, masks) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(keys, pa.int64()), pa.array(places, pa.binary()), pa.array(masks, pa.int64())],
        names=["id", "key", "places", "mask"])


def settled_windows(rows: pa.RecordBatch) -> pa.RecordBatch:
    masks = [all_bits(a, b) for a, b in zip(rows.column(4).to_pylist(), rows.column(5).to_pylist())]
    return window_batch(rows.column(1), rows.column(2), rows.column(6), masks)


def shard_windows(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Sort the suffixes of one shard. What the sort doesn't need stays in temporary files, found by record number."""
    owners, places = tempfile.TemporaryFile(), tempfile.TemporaryFile()
    count = 0

    def records() -> Iterator[np.ndarray]:
        nonlocal count
        at = 0
        for rows in batches:
            contents, lefts = rows.column(3).to_pylist(), rows.column(4).to_numpy()
            out = np.empty(len(contents), SAMPLED)
            out["key"] = [c[n:] for c, n in zip(contents, lefts)]
            left = b"".join(c[:n][::-1].ljust(SPAN, b"\0") for c, n in zip(contents, lefts))
            out["left"] = np.frombuffer(left, np.uint8).reshape(-1, SPAN)
            out["size"], out["near"] = lefts, lefts - rows.column(5).to_numpy()
            out["owner"] = rows.column(1).to_numpy()
            out["record"] = np.arange(count, count + len(out))
            blobs = rows.column(6).to_pylist()
            sizes = np.array([len(b) for b in blobs], np.int64)
            begins = at + np.cumsum(sizes) - sizes
            owners.write(np.stack([rows.column(1).to_numpy(), rows.column(2).to_numpy(), begins, sizes], 1).tobytes())
            places.write(b"".join(blobs))
            count, at = count + len(out), at + int(sizes.sum())
            yield out

    for record, mask in repeated_windows(records(), limit):
        for a in range(0, len(record), 4096):
            some = record[a:a + 4096]
            # records ascend: one read covers a stretch of them, unless they lie far apart
            for part in np.split(np.arange(len(some)), np.flatnonzero(np.diff(some) > 64) + 1):
                lo, hi = int(some[part[0]]), int(some[part[-1]]) + 1 if len(part) else 0
                if not len(part):
                    continue
                owners.seek(lo * 32)
                known = np.frombuffer(owners.read((hi - lo) * 32), np.int64).reshape(-1, 4)
                places.seek(int(known[0, 2]))
                data = places.read(int(known[-1, 2] + known[-1, 3] - known[0, 2]))
                mine = known[some[part] - lo]
                begins = mine[:, 2] - known[0, 2]
                yield window_batch(mine[:, 0], mine[:, 1], [data[b:b + n] for b, n in zip(begins, mine[:, 3])],
                                   mask[a + part].astype(np.int64))
    owners.close()
    places.close()


def removed_intervals(windows: DataFrame) -> DataFrame:
    """id, key, intervals (binary: pairs of 64-bit byte offsets, ascending and apart), one row for each id and key. A window
    without places stands for a whole text, of as many bytes as its mask says, and wins over the others."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            out = []
            for found in batch.column(2).to_pylist():
                whole = next((w["mask"] for w in found if w["places"] is None), None)
                if whole is not None:
                    out.append(np.array([0, whole], np.int64).tobytes())
                    continue
                starts = np.concatenate([
                    (np.frombuffer(w["places"], np.int64)[:, None] - np.flatnonzero(np.unpackbits(
                        np.array([w["mask"]], "<u8").view(np.uint8), bitorder="little"))).ravel() for w in found])
                starts = np.unique(starts)
                cut = np.flatnonzero(np.diff(starts) > WINDOW) + 1
                lo, hi = starts[np.r_[0, cut]], starts[np.r_[cut, len(starts)] - 1] + WINDOW
                out.append(np.stack([lo, hi], 1).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out, pa.binary())], names=["id", "key", "intervals"])

    # a document's own windows; rows that repeat it, seen by several tasks, give the same ones
    each = windows.groupBy("id", "key").agg(F.collect_set(F.struct("places", "mask")).alias("found"))
    return map_batches(each, run, "id long, key long, intervals binary")


def cut_out(text: bytes, intervals: bytes | None) -> tuple[int, int, bytes]:
    """Bytes removed, runs removed, bytes kept."""
    at, kept, runs = 0, [], np.frombuffer(intervals or b"", np.int64).reshape(-1, 2).tolist()
    for lo, hi in runs:
        kept.append(text[at:lo])
        at = hi
    kept.append(text[at:])
    return sum(hi - lo for lo, hi in runs), len(runs), b"".join(kept)


def intervals_of(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """id, key, intervals: what is to be removed, for the documents (as of ``keyed``) that lose something."""
    rows = keyed(docs, doc_id, text)
    sizes = checkpointed(rows.select("id", "key", "sha", F.octet_length("text").cast("long").alias("size")))
    total = sizes.agg(F.sum("size")).first()[0] or 0
    parts = min(max(-(-total // (EVERY * BUCKET)), 8), MOST)
    # written, so that the join has a side of its own to split: a third of the rows may be copies of one text
    least = checkpointed(sizes.groupBy("sha").agg(F.min("id").alias("low")))
    copies = checkpointed(
        sizes.filter(F.col("size") >= WINDOW).join(least, "sha").filter("id > low").select("id", "key", "size").distinct())
    whole = copies.select("id", "key", F.lit(None).cast("binary").alias("places"), F.col("size").alias("mask"))
    gone, _ = broadcast_if_small(copies.select("id", "key"), F.lit(16))
    firsts = rows.join(gone, ["id", "key"], "left_anti")
    # a set, as tasks that meet rows of one id and text send the same
    anchors = repeated_anchors(firsts.select("id", "key", "spot", "text"), parts).groupBy("spot").agg(F.collect_set("keys").alias("keys"))
    # all rows stand here, as the shuffle of the texts is the one that ``deduplicated`` uses again for its join; a copy has no
    # anchors, and is a whole text all the same if it shares the spot of another document
    asked = rows.select("id", "key", "spot", "text").join(anchors, "spot").select("id", "key", "keys", "text")
    marked = marked_windows(candidate_stretches(asked, parts, parts))
    return removed_intervals(marked.unionByName(whole))


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept (binary), kept_sha256."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            texts, spans = texts_of(batch), batch.column(2).to_pylist()
            cuts = [cut_out(t, i) for t, i in zip(texts, spans)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array([c[0] for c in cuts], pa.int64()),
                pa.array([c[1] for c in cuts], pa.int64()), pa.array([c[2] for c in cuts], pa.binary()),
                pa.array([hashlib.sha256(c[2]).hexdigest() for c in cuts])],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])

    intervals = intervals_of(docs, doc_id, text).select(
        F.col("id").alias("of"), F.col("key").alias("of_key"), spot_of("id", "key").alias("of_spot"), "intervals")
    rows = keyed(docs, doc_id, text).select("id", "key", "spot", "text")
    # by spot alone, the texts' shuffle of ``intervals_of``; ids and keys tell apart the few documents of a spot
    same = (F.col("spot") == F.col("of_spot")) & (
        F.col("id").bitwiseXOR(F.col("of")).bitwiseOR(F.col("key").bitwiseXOR(F.col("of_key"))) == 0)
    joined = rows.join(intervals, same, "left").select(
        F.when(F.col("id") != LAST, F.col("id")).alias("doc_id"), "text", "intervals")
    return map_batches(joined, run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")
