"""External induced sorting of the window suffixes of a shard.

A shard has stretches: a sampled suffix that begins at an anchor (its right context), the bytes to its left, and the owner.

* The sampled suffixes enter a disk-backed priority queue by their right contexts. They leave in lexicographic order, and each
  gets the length of its common prefix with the one before it.
* Recursion: the suffix one byte further left is (that byte, place of the suffix in the order). So each suffix that has more to
  its left enters the next queue under this pair and leaves it in the order of the longer suffixes. The common prefix of
  neighbours there is one more than the least common prefix between the two in the order before, which is carried in
  the tuple.
* At depth j the windows that begin j bytes left of an anchor pass by in order; those whose common prefix with the
  one before is a whole window are equal to it. Groups go through a queue by (group, owner), whose first is the smallest owner.

Every queue holds at most ``limit`` records in memory, so a shard may be far larger than memory.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

from tariffloom.llm.disk_queue import DiskQueue
from tariffloom.llm.windows import SPAN, WINDOW

LIMIT = 1 << 17
SAMPLED = np.dtype([
    ("key", f"S{WINDOW}"), ("left", "u1", (SPAN,)), ("size", "u1"), ("near", "u1"), ("owner", "i8"), ("record", "i8")])
SUFFIX = np.dtype([
    ("key", "u8"), ("common", "u1"), ("left", "u1", (SPAN,)), ("size", "u1"), ("near", "u1"), ("owner", "i8"), ("record", "i8")])
MEMBER = np.dtype([("owner", "i8"), ("record", "i8")])
MARK = np.dtype([("key", "u8")])


def common_prefixes(keys: np.ndarray, before: bytes | None) -> np.ndarray:
    """Of each padded string and the one before it; 0 for the very first."""
    rows = np.frombuffer(keys.tobytes(), np.uint8).reshape(-1, WINDOW)
    first = np.frombuffer((before or b"").ljust(WINDOW, b"\0"), np.uint8)[None]
    differ = rows != np.concatenate([first, rows[:-1]])
    out = np.where(differ.any(1), differ.argmax(1), WINDOW).astype(np.uint8)
    if before is None:
        out[0] = 0
    return out


def range_least(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Least of values[lo..hi], both included, by a table of powers of two."""
    tables = [values]
    while (1 << len(tables)) <= len(values):
        half = 1 << (len(tables) - 1)
        tables.append(np.minimum(tables[-1][:-half], tables[-1][half:]))
    level = np.log2(hi - lo + 1).astype(int)
    out = np.empty(len(lo), values.dtype)
    for k in np.unique(level):
        at = level == k
        out[at] = np.minimum(tables[k][lo[at]], tables[k][hi[at] - (1 << k) + 1])
    return out


class Carried:
    """Least common prefix since the last suffix of each left byte, across blocks. -1: there was none."""

    def __init__(self) -> None:
        self.least = np.full(256, -1, np.int64)

    def step(self, common: np.ndarray, at: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """Common prefixes, one byte further left, of the suffixes at ``at`` (ascending) with left bytes ``byte``."""
        order = np.argsort(byte, kind="stable")
        place, letter = at[order], byte[order]
        fresh = np.r_[True, letter[1:] != letter[:-1]][:len(letter)]
        lo = np.where(fresh, 0, np.r_[0, place[:-1] + 1][:len(place)])
        least = range_least(common, lo, place).astype(np.int64)
        known = self.least[letter]
        least = np.where(fresh, np.where(known < 0, -1, np.minimum(least, known)), least)
        out = np.empty(len(at), np.uint8)
        out[order] = np.minimum(least + 1, 255)
        # carry on: bytes not seen in this block, then those seen
        whole = int(common.min()) if len(common) else 255
        self.least = np.where(self.least >= 0, np.minimum(self.least, whole), -1)
        last = np.r_[letter[1:] != letter[:-1], True][:len(letter)]
        ends, letters = place[last], letter[last]
        after = np.r_[np.minimum.accumulate(common[::-1])[::-1][1:], 255]  # least of what follows each place
        self.least[letters] = after[ends]
        return out


def marked(records: np.ndarray, depth: int) -> np.ndarray:
    out = np.empty(len(records), MARK)
    out["key"] = records.astype(np.uint64) << np.uint64(6) | np.uint64(depth)
    return out


class Groups:
    """Members of groups of equal windows, group after group; hands on the members whose owner isn't the group's smallest."""

    def __init__(self, limit: int):
        self.limit, self.group, self.least = limit, -1, 0
        self.held: list[np.ndarray] = []
        self.file = None

    def add(self, group: np.ndarray, members: np.ndarray) -> Iterator[np.ndarray]:
        """``group``: ascending numbers. Yields records."""
        if not len(group):
            return
        starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        if group[0] != self.group:
            yield from self.close()
        elif len(starts) > 1:
            self._keep(members[:starts[1]])
            yield from self.close()
            group, members, starts = group[starts[1]:], members[starts[1]:], starts[1:] - starts[1]
        else:
            self._keep(members)
            return
        last = starts[-1]
        least = np.repeat(np.minimum.reduceat(members["owner"], starts), np.diff(np.r_[starts, len(members)]))
        yield members["record"][:last][members["owner"][:last] > least[:last]]
        self.group, self.least = group[-1], int(least[-1])
        self._keep(members[last:])

    def _keep(self, members: np.ndarray) -> None:
        self.least = min(self.least, int(members["owner"].min()))
        self.held.append(members.copy())
        if sum(map(len, self.held)) > self.limit:
            if self.file is None:
                self.file = tempfile.TemporaryFile()
            for part in self.held:
                self.file.write(part.tobytes())
            self.held = []

    def close(self) -> Iterator[np.ndarray]:
        if self.file is not None:
            self.file.seek(0)
            while data := self.file.read(self.limit * MEMBER.itemsize):
                part = np.frombuffer(data, MEMBER)
                yield part["record"][part["owner"] > self.least]
            self.file.close()
            self.file = None
        for part in self.held:
            yield part["record"][part["owner"] > self.least]
        self.held, self.group = [], -1


def repeated_windows(stretches: Iterator[np.ndarray], limit: int = LIMIT) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``stretches``: blocks of ``SAMPLED`` records (key: right context; left: bytes leftwards; windows begin ``near`` to ``size``
    bytes left of the anchor). Yields (record, mask) in ascending order of records, each once at most: bit j of the mask says
    that a smaller owner has the window that begins j bytes left of the anchor."""
    sampled = DiskQueue(SAMPLED, limit)
    for block in stretches:
        sampled.push(block)
    marks = DiskQueue(MARK, limit * 8)

    def first_level() -> Iterator[np.ndarray]:
        before = None
        for block in sampled.drain():
            rows = np.empty(len(block), SUFFIX)
            for name in ("left", "size", "near", "owner", "record"):
                rows[name] = block[name]
            rows["common"] = common_prefixes(block["key"], before)
            before = bytes(block["key"][-1])
            yield rows

    level = first_level()
    for depth in range(SPAN):
        following, equal, carried = DiskQueue(SUFFIX, limit), Groups(limit), Carried()
        place, group = 0, 0
        for rows in level:
            groups = group + np.cumsum(rows["common"] < WINDOW)
            group = int(groups[-1])
            here = (rows["near"] <= depth) & (rows["size"] >= depth)
            found = np.empty(int(here.sum()), MEMBER)
            found["owner"], found["record"] = rows["owner"][here], rows["record"][here]
            for records in equal.add(groups[here], found):
                marks.push(marked(records, depth))
            at = np.flatnonzero(rows["size"] > depth)
            if len(at):
                further = rows[at]
                byte = further["left"][:, depth]
                further["common"] = carried.step(rows["common"], at, byte)
                further["key"] = byte.astype(np.uint64) << np.uint64(56) | (at + place).astype(np.uint64)
                following.push(further)
            else:
                carried.step(rows["common"], at, np.zeros(0, np.uint8))
            place += len(rows)
        for records in equal.close():
            marks.push(marked(records, depth))
        level = following.drain()
    held = None
    for block in marks.drain():
        record, bit = (block["key"] >> np.uint64(6)).astype(np.int64), np.uint64(1) << (block["key"] & np.uint64(63))
        if held is not None:
            record, bit = np.r_[held[0], record], np.r_[held[1], bit]
        starts = np.flatnonzero(np.r_[True, record[1:] != record[:-1]])
        masks = np.bitwise_or.reduceat(bit, starts)
        record = record[starts]
        held = (record[-1:], masks[-1:])
        yield record[:-1], masks[:-1]
    if held is not None:
        yield held
