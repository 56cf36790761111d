"""A disk-backed priority queue of numpy records, filled first and emptied in order afterwards."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np


class DiskQueue:
    """Records with a field ``key``. More than ``limit`` of them are sorted and written to an unnamed temporary file as a run;
    emptying merges the runs block by block. Records of equal keys leave in the order they came."""

    def __init__(self, dtype: np.dtype, limit: int):
        self.dtype, self.limit = np.dtype(dtype), max(limit, 2)
        self.held: list[np.ndarray] = []
        self.size = 0
        self.file = None
        self.runs: list[tuple[int, int]] = []  # first record and number of records in the file

    def push(self, records: np.ndarray) -> None:
        if len(records):
            self.held.append(records)
            self.size += len(records)
            if self.size > self.limit:
                self._write()

    def _ordered(self) -> np.ndarray:
        rows = np.concatenate(self.held) if self.held else np.empty(0, self.dtype)
        self.held, self.size = [], 0
        return rows[np.argsort(rows["key"], kind="stable")]

    def _write(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        rows = self._ordered()
        begin = self.runs[-1][0] + self.runs[-1][1] if self.runs else 0
        self.file.seek(begin * self.dtype.itemsize)
        self.file.write(rows.tobytes())
        self.runs.append((begin, len(rows)))

    def _read(self, begin: int, n: int) -> np.ndarray:
        self.file.seek(begin * self.dtype.itemsize)
        return np.frombuffer(self.file.read(n * self.dtype.itemsize), self.dtype)

    def drain(self) -> Iterator[np.ndarray]:
        """Blocks of records in order; the queue is empty afterwards."""
        if not self.runs:
            rows = self._ordered()
            if len(rows):
                yield rows
            return
        if self.held:
            self._write()
        block = max(self.limit // len(self.runs), 1)
        left = list(self.runs)
        heads = [np.empty(0, self.dtype)] * len(left)
        while True:
            for k, (begin, n) in enumerate(left):
                if n and not len(heads[k]):
                    take = min(block, n)
                    heads[k] = self._read(begin, take)
                    left[k] = (begin + take, n - take)
            live = [k for k, h in enumerate(heads) if len(h)]
            if not live:
                break
            # what is not above the smallest last key of a run that goes on can't be preceded by anything unread; of records
            # with that very key, those of later runs wait for the rest of the run that sets it
            goes_on = [k for k in live if left[k][1]]
            cut = min((heads[k]["key"][-1] for k in goes_on), default=None)
            setter = next((k for k in goes_on if heads[k]["key"][-1] == cut), None)
            out = []
            for k in live:
                n = len(heads[k]) if cut is None else int(
                    np.searchsorted(heads[k]["key"], cut, side="right" if k <= setter else "left"))
                out.append(heads[k][:n])
                heads[k] = heads[k][n:]
            rows = np.concatenate(out)
            yield rows[np.argsort(rows["key"], kind="stable")]
        self.file.close()
        self.file, self.runs = None, []
