"""External induced sorting of suffixes with common-prefix values, through disk-backed priority queues.

A shard holds pieces of text aligned on an anchor, in groups. Suffixes are sorted position by position from the right:
the suffixes that start one byte further left are induced from those already sorted. Scanning the sorted order, every suffix
tuple (group, byte before it, rank, piece, common prefix) goes into a queue, and the queue gives back the next order.
A tuple carries the smallest common prefix since the last tuple of its group and byte, so that the
new common prefix of neighbours is one more than that: no text is compared anywhere.

Queues, pieces and marks stay in memory up to a limit of tuples; beyond it the queue spills sorted runs to the task's own
folder and merges them block by block, and pieces and marks live in files there. Memory does not grow with the shard.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np

TUPLE = np.dtype([("group", "<u4"), ("byte", "<u2"), ("rank", "<u4"), ("piece", "<u4"), ("low", "<u2")])


class TupleQueue:
    """A priority queue of tuples by (group, byte, rank); filled first, then emptied in blocks."""

    def __init__(self, folder: str, limit: int):
        self.folder, self.limit, self.held, self.size, self.runs = folder, limit, [], 0, []

    @staticmethod
    def _sorted(rows: np.ndarray) -> np.ndarray:
        key = rows["group"].astype(np.uint64) << np.uint64(41) | rows["byte"].astype(np.uint64) << np.uint64(32) | rows["rank"]
        return rows[np.argsort(key, kind="stable")]

    def push(self, rows: np.ndarray) -> None:
        self.held.append(rows)
        self.size += len(rows)
        if self.size >= self.limit:
            path = os.path.join(self.folder, f"run-{id(self)}-{len(self.runs)}")
            self._sorted(np.concatenate(self.held)).tofile(path)
            self.runs.append(path)
            self.held, self.size = [], 0

    def drain(self) -> Iterator[np.ndarray]:
        rest = self._sorted(np.concatenate(self.held)) if self.held else np.zeros(0, TUPLE)
        if not self.runs:
            if len(rest):
                yield rest
            return
        sources = [np.memmap(p, TUPLE, "r") for p in self.runs] + ([rest] if len(rest) else [])
        at, step = [0] * len(sources), max(1, self.limit // len(sources))
        while any(a < len(s) for a, s in zip(at, sources, strict=True)):
            # Blocks of every run, cut at the smallest of their last tuples: all below it is complete.
            blocks = [np.array(s[a : a + step]) for a, s in zip(at, sources, strict=True)]
            edge = min(b[-1][["group", "byte", "rank"]].item() for a, b, s in zip(at, blocks, sources, strict=True) if len(b))
            taken = []
            for i, b in enumerate(blocks):
                key = b["group"].astype(np.uint64) << np.uint64(41) | b["byte"].astype(np.uint64) << np.uint64(32) | b["rank"]
                n = int(np.searchsorted(key, np.uint64(edge[0] << 41 | edge[1] << 32 | edge[2]), side="right"))
                taken.append(b[:n])
                at[i] += n
            yield self._sorted(np.concatenate(taken))
        for s in sources:
            del s
        for path in self.runs:
            os.remove(path)


def range_minima(values: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """min(values[l : r + 1]) for every pair, by a table of doubling widths."""
    width = right - left + 1
    level = np.frexp(width.astype(np.float64))[1] - 1
    out = np.empty(len(left), values.dtype)
    row = values
    for k in range(int(level.max(initial=0)) + 1):
        if k:
            row = np.minimum(row[: -(1 << k - 1)], row[1 << k - 1 :])
        hit = np.flatnonzero(level == k)
        out[hit] = np.minimum(row[left[hit]], row[right[hit] - (1 << k) + 1])
    return out


class Shard:
    """Pieces of groups (0, 1, ... in the order added), all aligned: column ``left`` of a row is the anchor's first byte."""

    def __init__(self, left: int, right: int, folder: str, limit: int):
        self.left, self.width, self.folder, self.limit = left, left + right, folder, limit
        self.blocks: list[np.ndarray] = []  # each (width, rows), column by column
        self.begin, self.end, self.group, self.waiting = [], [], [], []

    def __len__(self) -> int:
        return len(self.begin)

    def add(self, group: int, piece: bytes, anchor: int) -> None:
        """``anchor``: the anchor's place in the piece."""
        begin = self.left - anchor
        self.group.append(group)
        self.begin.append(begin)
        self.end.append(begin + len(piece))
        self.waiting.append(piece)
        if len(self.waiting) >= self.limit:
            self._store()

    def _store(self) -> None:
        if not self.waiting:
            return
        first = len(self.begin) - len(self.waiting)
        rows = np.zeros((len(self.waiting), self.width), np.uint8)
        for i, piece in enumerate(self.waiting):
            rows[i, self.begin[first + i] : self.end[first + i]] = np.frombuffer(piece, np.uint8)
        columns = np.ascontiguousarray(rows.T)
        if len(self.begin) > self.limit:
            path = os.path.join(self.folder, f"pieces-{id(self)}-{len(self.blocks)}")
            columns.tofile(path)
            columns = np.memmap(path, np.uint8, "r", shape=columns.shape)
        self.blocks.append(columns)
        self.waiting = []

    def _column(self, t: int) -> np.ndarray:
        return self.blocks[0][t] if len(self.blocks) == 1 else np.concatenate([b[t] for b in self.blocks])

    def repeated(self, length: int) -> np.ndarray:
        """Rows by columns: whether the ``length`` bytes from there equal those of another piece of the group at the same column."""
        self._store()
        n, columns = len(self), self.left + 1
        begin, end = np.array(self.begin, np.int32), np.array(self.end, np.int32)
        if n > self.limit:
            marks = np.memmap(os.path.join(self.folder, f"marks-{id(self)}"), bool, "w+", shape=(columns, n))
        else:
            marks = np.zeros((columns, n), bool)
        order = np.zeros(n, TUPLE)
        order["group"] = self.group
        order["piece"] = order["rank"] = np.arange(n)
        stream: Iterator[np.ndarray] = (order[i : i + self.limit] for i in range(0, n, self.limit))
        for t in range(int(end.max(initial=0)) - 1, int(begin.min(initial=0)) - 1, -1):
            queue = self._induce(stream, t, self._column(t), begin, end)
            stream = self._ranked(queue, marks[t] if t < columns else None, length)
        for _ in stream:
            pass
        return marks

    def _induce(self, stream: Iterator[np.ndarray], t: int, column: np.ndarray, begin: np.ndarray, end: np.ndarray) -> TupleQueue:
        """Scan the sorted suffixes that start at t + 1 (``low`` is their common prefix) and queue those that start at t."""
        queue, carried = TupleQueue(self.folder, self.limit), np.zeros(258, np.uint16)
        for rows in stream:
            piece = rows["piece"]
            inside = (t >= begin[piece]) & (t < end[piece])
            # Byte 0: a suffix that has not begun; 257: none further left, so the piece leaves the order.
            byte = np.where(inside, column[piece].astype(np.uint16) + 1, np.where(t >= end[piece], 0, 257)).astype(np.uint16)
            low, here = rows["low"], np.arange(len(rows))
            key = rows["group"].astype(np.uint64) << np.uint64(9) | byte
            by = np.argsort(key, kind="stable")
            before = np.full(len(rows), -1)
            same = np.flatnonzero(key[by][1:] == key[by][:-1])
            before[by[same + 1]] = by[same]
            smallest = np.empty(len(rows), np.uint16)
            has = before >= 0
            smallest[has] = range_minima(low, before[has] + 1, here[has])
            first = ~has
            running = np.minimum.accumulate(low)
            smallest[first] = np.minimum(running[first], carried[byte[first]])
            # What a tuple of the next block inherits: the smallest since its byte was last seen.
            behind = np.minimum.accumulate(low[::-1])[::-1]
            last = np.full(258, -1)
            np.maximum.at(last, byte, here)
            tail = np.where(last + 1 < len(rows), behind[np.minimum(last + 1, len(rows) - 1)], np.uint16(0xFFFF))
            carried = np.where(last >= 0, tail, np.minimum(carried, running[-1])).astype(np.uint16)
            out = rows.copy()
            out["byte"], out["low"] = byte, smallest
            queue.push(out[byte != 257])
        return queue

    def _ranked(self, queue: TupleQueue, marks: np.ndarray | None, length: int) -> Iterator[np.ndarray]:
        """The queue in order, with new ranks and common prefixes; neighbours with ``length`` bytes in common are marked."""
        rank, held = 0, None
        for rows in queue.drain():
            last = (held["group"], held["byte"]) if held is not None else (-1, -1)
            group = np.concatenate([[last[0]], rows["group"].astype(np.int64)])
            byte = np.concatenate([[last[1]], rows["byte"].astype(np.int64)])
            follows = (group[1:] == group[:-1]) & (byte[1:] == byte[:-1]) & (byte[1:] > 0)
            rows["low"] = np.where(follows, np.minimum(rows["low"], np.uint16(0xFFF0)) + np.uint16(1), 0)
            rows["rank"] = np.arange(rank, rank + len(rows))
            if marks is not None:
                long = np.flatnonzero(rows["low"] >= length)
                marks[rows["piece"][long]] = True
                marks[rows["piece"][long[long > 0] - 1]] = True
                if len(long) and long[0] == 0 and held is not None:
                    marks[held["piece"]] = True
            rank, held = rank + len(rows), rows[-1].copy()
            yield rows
