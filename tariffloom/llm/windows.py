"""Anchors of a text's windows: every ``window``-byte string names a place inside itself by its content alone.

The anchor of a window is the leftmost place with the smallest hash of the next ``gram`` bytes. Equal windows have their anchors at
equal offsets, and consecutive windows mostly share one; such a run of windows is a stretch.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

WINDOW, GRAM = 50, 16
SPAN = WINDOW - GRAM + 1  # places in a window where a gram may begin
SEGMENT = 1 << 20
PLACE = np.uint64((1 << 21) - 1)
MULTIPLIERS = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


@dataclass
class Stretches:
    """Runs of windows with one anchor: document number, first and last window start, anchor (all within the document), hash."""

    doc: np.ndarray
    first: np.ndarray
    last: np.ndarray
    anchor: np.ndarray
    hash: np.ndarray


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``GRAM`` = 16 bytes from each place."""
    h = data.astype(np.uint64) + np.uint64(1)
    for k, m in enumerate(MULTIPLIERS):
        h = h[:-(1 << k)] * m + h[1 << k:]
    h ^= h >> np.uint64(32)
    h *= MULTIPLIERS[0]
    h ^= h >> np.uint64(29)
    return h * MULTIPLIERS[1]


def sliding_least(values: np.ndarray, span: int) -> np.ndarray:
    width = 1
    while width * 2 <= span:
        values = np.minimum(values[:-width], values[width:])
        width *= 2
    rest = span - width
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def stretches(texts: list[bytes]) -> Stretches:
    """Of all windows of ``texts``; texts shorter than a window have none."""
    sizes = np.array([len(t) for t in texts], np.int64)
    begins = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(texts), np.uint8)
    found: list[tuple[np.ndarray, ...]] = []
    for base in range(0, max(len(data) - WINDOW + 1, 0), SEGMENT):
        part = data[base:base + SEGMENT + WINDOW - 1]
        keys = gram_hashes(part)
        keys = (keys & ~PLACE) | np.arange(len(keys), dtype=np.uint64)
        least = sliding_least(keys, SPAN)
        start = np.arange(base, base + len(least))
        doc = np.searchsorted(begins, start, side="right") - 1
        valid = start + WINDOW <= begins[doc] + sizes[doc]
        cut = np.flatnonzero((least[1:] != least[:-1]) | (doc[1:] != doc[:-1]) | (valid[1:] != valid[:-1])) + 1
        lo, hi = np.r_[0, cut], np.r_[cut, len(least)] - 1
        ok = valid[lo]
        lo, hi = lo[ok], hi[ok]
        d, low = doc[lo], least[lo]
        origin = begins[d]
        found.append((d, start[lo] - origin, start[hi] - origin, (low & PLACE).astype(np.int64) + base - origin, low >> np.uint64(21)))
    if not found:
        empty = np.zeros(0, np.int64)
        return Stretches(empty, empty, empty, empty, empty.astype(np.uint64))
    return Stretches(*(np.concatenate(x) for x in zip(*found)))
