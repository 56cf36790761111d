"""SimHash near-duplicates: byte-position inverted index with count filtering.

A fingerprint has 64 bits, one per bit of XXH64 (seed 42) over the text's word shingles: a bit is 1 if it is set in over half
of the shingles, repeats included. Words are runs of ``[^\\x20\\x09-\\x0D]`` after lower-casing A-Z; a text of fewer words than a
shingle is one shingle; a wordless text has fingerprint zero, linked like any other.

Two fingerprints that differ in at most ``bits`` = 4 bits agree in at least 4 of their 8 bytes. So among the first 7 bytes
they agree in at least 3: the index has one posting list for each three of these positions and their values (35 lists a
fingerprint), and a pair is a candidate only where they meet. It is tallied in the first list both are in: the bytes
they share at equal positions are counted, pairs with fewer than the guaranteed 4 are dropped, the rest is verified by
the Hamming distance. Equal texts and equal fingerprints are one entry of the index, so copies cost nothing.

Lists are processed in order of their key, each in memory of at most ``BLOCK`` entries at a time. A list emits the
links of a spanning forest instead of all its pairs; the components are the same. Lists of more than ``BLOCK`` entries
are cut into blocks, and every pair of blocks becomes a list of its own.

Cases: NULL text counts as empty; rows that repeat an id or a text are returned once each; NULL ids take part in the
fingerprints, but a component is named by its smallest id that is not NULL (NULL if it has none); an empty table gives
an empty result; extra columns are ignored by ``near_duplicates`` and kept by ``deduplicated``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariffloom.llm.common import checkpointed, components, map_batches, texts_of

BITS, BYTES, GUARANTEED = 64, 8, 4
SHINGLE, DISTANCE = 4, 4
SEED = 42
#: Positions of a posting list, and the bytes that must hold an agreement in three of them.
TRIPLES = tuple(combinations(range(BYTES - 1), GUARANTEED - 1))
BLOCK = 2048
#: Shingles hashed at a time.
PIECE = 1 << 16


def bit_counts(words: list[bytes], shingle: int) -> tuple[np.ndarray, int]:
    """How often each bit is set over all shingles, and the number of shingles."""
    counts, total = np.zeros(BITS, np.int64), max(len(words) - shingle + 1, 1)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    for start in range(0, total, PIECE):
        part = words[start:min(start + PIECE, total) + shingle - 1]
        rows = zip(*(part[k:] for k in range(shingle))) if len(part) >= shingle else [part]
        hashes = np.array([digest(join(r), SEED) for r in rows], np.uint64)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return counts, total


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    words = text.lower().split()  # bytes: both know ASCII only
    if not words:
        return 0
    counts, total = bit_counts(words, shingle)
    return int.from_bytes(np.packbits(counts * 2 > total, bitorder="little").tobytes(), "little")


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprinted(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns and ``fingerprint`` (long)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            prints = pa.array([signed(fingerprint(t, shingle)) for t in texts_of(batch, "_text")], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], prints], names=[*batch.schema.names[1:], "fingerprint"])

    rows = docs.select(F.col(f"`{text}`").alias("_text"), *[F.col(f"`{c}`") for c in keep])
    return map_batches(rows, run, rows.drop("_text").withColumn("fingerprint", F.lit(0).cast("long")).schema)


def position_key(fp: Column, places: tuple[int, ...], number: int) -> Column:
    """A posting list: its number and the bytes at its positions."""
    key = F.lit(number).cast("long")
    for place in places:
        key = F.shiftleft(key, 8).bitwiseOR(F.shiftrightunsigned(fp, 8 * place).bitwiseAND(F.lit(255)))
    return key


def links_within(prints: np.ndarray, first: np.ndarray, list_no: int, across: int = 0) -> list[tuple[int, int]]:
    """Links of a spanning forest over the near pairs of one list. ``across`` > 0: only pairs between the first ``across``
    entries and the rest. ``first``: which list numbers come before ``list_no`` is decided by the shared bytes of a pair."""
    n, prints = len(prints), prints.view(np.uint64)
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out: list[tuple[int, int]] = []
    for i in range(across or n - 1):
        others = prints[(across or i + 1):]
        differ = others ^ prints[i]
        shared = (differ.view(np.uint8).reshape(-1, BYTES) == 0)
        near = np.flatnonzero((shared.sum(1) >= GUARANTEED) & (np.bitwise_count(differ) <= DISTANCE))
        if len(near):
            # a pair is tallied in the first list that both are in
            near = near[first[np.packbits(shared[near], axis=1, bitorder="little")[:, 0] & 127] == list_no]
        for j in near + (across or i + 1):
            a, b = find(i), find(int(j))
            if a != b:
                root[b] = a
                out.append((i, int(j)))
    return out


def first_lists() -> np.ndarray:
    """By the set of shared positions among the first seven, as a bit mask: the number of the first list both are in."""
    first = np.full(128, -1)
    for number in range(len(TRIPLES) - 1, -1, -1):
        mask = sum(1 << p for p in TRIPLES[number])
        for shared in range(128):
            if shared & mask == mask:
                first[shared] = number
    return first


def list_links(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
    """Links of sorted posting lists (key, left, right, block, fp): rows of a list follow each other, across batches too."""
    first = first_lists()

    def solve(key: tuple, block: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        across = 0
        if key[1] != key[2]:
            order = np.argsort(block, kind="stable")
            prints, across = prints[order], int((block == key[1]).sum())
            if across == len(prints):
                return prints[:0], prints[:0]
        pairs = links_within(prints, first, key[0] >> 24, across)
        at = np.array(pairs, np.int64).reshape(-1, 2)
        return prints[at[:, 0]], prints[at[:, 1]]

    held: list[np.ndarray] = []
    current = None
    for batch in batches:
        cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        keys = np.stack(cols[:3], 1)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1 if len(keys) else np.array([], int)
        out: list[tuple[np.ndarray, np.ndarray]] = []
        for lo, hi in zip([0, *cuts], [*cuts, len(keys)]):
            if lo == hi:
                continue
            key = tuple(int(x) for x in keys[lo])
            if key != current:
                if current is not None and sum(x.shape[1] for x in held) > 1:
                    out.append(solve(current, *np.concatenate(held, axis=1)))
                held, current = [], key
            held.append(np.stack([cols[3][lo:hi], cols[4][lo:hi]]))
        yield link_batch(out)
    if current is not None and sum(x.shape[1] for x in held) > 1:
        yield link_batch([solve(current, *np.concatenate(held, axis=1))])


def link_batch(pairs: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    left = np.concatenate([p[0] for p in pairs]) if pairs else np.array([], np.int64)
    right = np.concatenate([p[1] for p in pairs]) if pairs else np.array([], np.int64)
    return pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["src", "dst"])


def links(prints: DataFrame, block: int = BLOCK) -> DataFrame:
    """src, dst: links between the distinct fingerprints of ``prints`` (fingerprint) that connect all near ones."""
    fp = F.col("fp")
    lists = prints.select(F.col("fingerprint").alias("fp")).select(
        "fp", F.explode(F.array(*[position_key(fp, places, k) for k, places in enumerate(TRIPLES)])).alias("key"))
    sizes = lists.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    blocks = F.ceil(F.col("size") / block).cast("long")
    postings = (
        lists.join(sizes, "key")
        .select("key", "fp", blocks.alias("blocks"), F.pmod(F.xxhash64("fp"), blocks).alias("block"))
        # a block meets itself and each other block: one list for each pair of blocks
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select("key", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"), "block", "fp")
        .repartition("key", "left", "right").sortWithinPartitions("key", "left", "right")
    )
    return map_batches(postings, list_links, "src long, dst long")


def grouped(docs: DataFrame, doc_id: str, text: str, shingle: int) -> DataFrame:
    """Per row: doc_id, text_key, fingerprint, head. ``head`` is the first row of its component: by id (NULL last), then by
    the hash of the text."""
    named = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(f"`{text}`").alias("text_key"), F.col(f"`{text}`").alias("text"))
    rows = checkpointed(fingerprinted(named, "text", shingle, ("doc_id", "text_key")))
    head = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key")
    prints = checkpointed(rows.groupBy("fingerprint").agg(F.min(head).alias("least")))
    groups = components(links(prints))
    # a component has a row for each of its fingerprints
    heads = prints.join(groups, prints.fingerprint == groups.node).groupBy("component").agg(F.min("least").alias("head"))
    linked = groups.join(heads, "component").select("node", "head")
    # written, so that the join below has a side of its own to split: one fingerprint may hold a third of the rows
    every = checkpointed(prints.join(linked, prints.fingerprint == linked.node, "left").select(
        F.col("fingerprint").alias("fp"), F.coalesce("head", "least").alias("head")))
    return rows.join(every, rows.fingerprint == every.fp).drop("fp")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """Per row: doc_id, fingerprint (long), component_id (smallest doc_id reachable over links)."""
    return grouped(docs, doc_id, text, shingle).select("doc_id", "fingerprint", F.col("head.doc_id").alias("component_id"))


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with one row of each component, its head. Of rows that repeat both id and text one stays."""
    mine = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key")
    heads = grouped(docs, doc_id, text, shingle).filter(mine.eqNullSafe(F.col("head"))).select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"), F.col("text_key").alias("_key")).distinct()
    rows = docs.withColumns({"_id": F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")), "_key": F.xxhash64(f"`{text}`")})
    return rows.join(heads, ["_id", "_key"], "left_semi").dropDuplicates(["_id", "_key"]).select(*[f"`{c}`" for c in docs.columns])
