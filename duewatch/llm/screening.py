"""Which vectors can have a partner at all, and in which group, by buckets of random directions.

In each of several tables a vector goes to the PROBES pairs of directions, one of either codebook, with the largest sum
of its products with them. Directions are uniform on the sphere and drawn without looking at the data, so how often two
vectors share no bucket of a table depends on their cosine and length only, whatever the data. This share is counted on
drawn pairs, and there are as many tables as make it less than MISS for a pair at the threshold. Vectors of a bucket
are compared as 16-bit numbers, with a threshold lowered by all that rounding can change. Groups may therefore be too
large; they decide which vectors are compared exactly, and nothing else.

A task sends one row per bucket range, with all its vectors in it. Each table is a job of its own, and its shuffle is
deleted behind it. In a crowded bucket, all near a pivot are joined to it, and so is everything that can be a partner of
these; the near ones then need no further comparison.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PROBES = 5  # buckets of a vector per table
ROOM = 320  # vectors per bucket aimed at
MOST_DIRECTIONS = 1024  # of a codebook
MISS = 1e-12
DRAWN = 8192  # pairs the share is counted on
MOST_TABLES = 24
LEAST_SIZE = 8  # shorter vectors all lie near each other
PART_BYTES = 4 << 20
PARTS = 4  # of a reducer, so that chance deals them evenly
SENT = 8192  # vectors in a row at most
BUFFER_BYTES = 8 << 20
HELD_BYTES = 32 << 20  # after so much, a reducer thins crowded buckets
CROWD = 4096
BLOCK = 256


def _largest(scores: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest per row and their columns. Columns replace the last bits of the scores, so one partition finds both."""
    width = scores.shape[1]
    mask = (1 << max(1, (width - 1).bit_length())) - 1
    bits = np.ascontiguousarray(scores, np.float32).view(np.int32)
    bits &= ~mask
    bits |= np.arange(width, dtype=np.int32)
    best = np.partition(bits.view(np.float32), width - count, axis=1)[:, width - count :]
    return best, np.ascontiguousarray(best).view(np.int32) & mask


def buckets(scores: np.ndarray) -> np.ndarray:
    """Of each row, the PROBES pairs of directions with the largest sums; the columns hold one codebook behind the other."""
    directions = scores.shape[1] // 2
    a, i = _largest(scores[:, :directions].copy(), PROBES)
    b, j = _largest(scores[:, directions:].copy(), PROBES)
    _, pair = _largest((a[:, :, None] + b[:, None]).reshape(len(scores), -1), PROBES)
    return np.take_along_axis(i, pair // PROBES, 1).astype(np.int64) * directions + np.take_along_axis(j, pair % PROBES, 1)


def missed(directions: int, size: int, threshold: float) -> float:
    """How often two vectors at the threshold share no bucket of a table, three standard errors added."""
    rng, lost, step = np.random.default_rng(directions), 0, 1024
    for _ in range(0, DRAWN, step):
        x, y = rng.standard_normal((2, step, 2 * directions), dtype=np.float32)
        norm = np.sqrt(x * x + y * y + 2 * rng.standard_gamma((size - 2) / 2, x.shape, dtype=np.float32))
        y = (threshold * x + math.sqrt(1 - threshold**2) * y) / norm
        lost += step - (buckets(x / norm)[:, :, None] == buckets(y)[:, None]).any(axis=(1, 2)).sum()
    return (lost + 3 * math.sqrt(lost) + 3) / DRAWN


def plan(total: int, size: int, threshold: float) -> tuple[int, int, int] | None:
    """Directions of a codebook, tables and parts; none where buckets do not tell vectors apart."""
    if size < LEAST_SIZE or not 0 < threshold < 1:
        return None
    directions = min(MOST_DIRECTIONS, max(2 * PROBES, math.ceil(math.sqrt(total * PROBES / ROOM))))
    tables = math.ceil(math.log(MISS) / math.log(min(missed(directions, size, threshold), 1 - 1e-9)))
    return (directions, tables, math.ceil(total * PROBES * (2 * size + 20) / PART_BYTES)) if tables <= MOST_TABLES else None


def _directions(table: int, size: int, directions: int) -> np.ndarray:
    drawn = np.random.default_rng([table, size, directions]).standard_normal((size, 2 * directions), dtype=np.float32)
    return drawn / np.linalg.norm(drawn, axis=0)


def _binary(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """``values`` cut at ``starts`` (the end included) into one binary per piece."""
    values = np.ascontiguousarray(values)
    offsets = (starts * (values.nbytes // max(1, len(values)))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(values)])


SENT_SCHEMA = "part int, size int, cells binary, keys binary, scales binary, codes binary"


def _rows(keys: np.ndarray, units: np.ndarray, drawn: np.ndarray, parts: int) -> Iterator[pa.RecordBatch]:
    keys, first = np.unique(keys, return_index=True)
    units = units[first]
    scales = (np.abs(units).max(axis=1) / 32767).astype(np.float32)
    codes = np.rint(units / scales[:, None]).astype(np.int16)
    cells = np.concatenate([buckets(units[i : i + 2048] @ drawn) for i in range(0, len(units), 2048)])
    part = (cells.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(parts)
    order = np.lexsort((cells.ravel(), part.ravel()))
    part, cells, place = part.ravel()[order].astype(np.int32), cells.ravel()[order], order // PROBES
    starts = np.unique(np.concatenate([np.flatnonzero(np.diff(part, prepend=-1)), np.arange(0, len(part), SENT), [len(part)]]))
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(part[starts[:-1]]), pa.array(np.full(len(starts) - 1, units.shape[1], np.int32)),
            *(_binary(values, starts) for values in (cells, keys[place], scales[place], codes[place])),
        ],
        names=["part", "size", "cells", "keys", "scales", "codes"],
    )


def sent(plans: dict[int, tuple[int, int, int]], table: int, units_of):
    """Rows of ``SENT_SCHEMA`` from rows (size, key, unit); ``units_of(column, rows)`` gives a column's unit vectors."""

    def run(batches):
        waiting: dict[int, list] = {}
        drawn = {size: _directions(table, size, plans[size][0]) for size in plans}
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes).tolist():
                part = batch.take(pa.array(np.flatnonzero(sizes == size)))
                own = waiting.setdefault(size, [])
                own.append((part.column("key").to_numpy(), units_of(part.column("unit"), part.num_rows).astype(np.float32)))
                if sum(units.nbytes for _, units in own) >= BUFFER_BYTES:
                    keys, units = (np.concatenate(x) for x in zip(*waiting.pop(size)))
                    yield from _rows(keys, units, drawn[size], plans[size][2])
        for size, own in waiting.items():
            keys, units = (np.concatenate(x) for x in zip(*own))
            yield from _rows(keys, units, drawn[size], plans[size][2])

    return run


def joined(a: np.ndarray, b: np.ndarray, label: np.ndarray) -> np.ndarray:
    """``label`` (the least of a component, by place) after links between places a and b."""
    while True:
        x, y = label[a], label[b]
        if (x == y).all():
            return label
        least = np.minimum(x, y)
        np.minimum.at(label, x, least)
        np.minimum.at(label, y, least)
        while (label[label] != label).any():
            label = label[label]


def places(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the few marks of a matrix. Eight of them are looked at as one word."""
    flat = marks.ravel()
    whole = len(flat) & ~7
    some = (np.flatnonzero(flat[:whole].view(np.uint64))[:, None] * 8 + np.arange(8)).ravel()
    found = np.concatenate([some[flat[some]], whole + np.flatnonzero(flat[whole:])])
    return np.divmod(found, marks.shape[1])


class Meeting:
    """The buckets of one reducer and vector length. ``links`` are pairs of keys."""

    def __init__(self, size: int, threshold: float):
        self.size, self.threshold = size, threshold
        self.waiting: list[tuple[np.ndarray, ...]] = []
        self.held, self.limit = 0, HELD_BYTES // (2 * size)
        self.links: list[tuple[np.ndarray, np.ndarray]] = []
        self.pivots: dict[int, list[tuple[np.ndarray, int, float]]] = {}

    def add(self, cells: np.ndarray, keys: np.ndarray, scales: np.ndarray, codes: np.ndarray) -> None:
        self.waiting.append((cells, keys, scales, codes.reshape(-1, self.size)))
        self.held += len(keys)
        if self.held > self.limit:
            self.waiting = [self._distinct()[0]]
            self.held = len(self.waiting[0][0])
            self.limit = max(HELD_BYTES // (2 * self.size), 2 * self.held)

    def _distinct(self) -> tuple[list[np.ndarray], np.ndarray]:
        """The columns with each vector once in a bucket, sorted and thinned, and where buckets start, the end included."""
        cells, keys, scales, codes = (np.concatenate(x) for x in zip(*self.waiting))
        self.waiting = []
        order = np.lexsort((keys, cells))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(cells[order]) != 0) | (np.diff(keys[order]) != 0)
        columns = [x[order[new]] for x in (cells, keys, scales, codes)]
        del codes
        starts = np.append(np.flatnonzero(np.diff(columns[0], prepend=-1)), new.sum())
        left = np.ones(len(columns[0]), bool)
        for start, end in zip(starts[:-1], starts[1:]):
            if end - start > CROWD or int(columns[0][start]) in self.pivots:
                left[start:end] = self._thinned(int(columns[0][start]), *(x[start:end] for x in columns[1:]))
        columns = [x[left] for x in columns] if not left.all() else columns
        return columns, np.append(np.flatnonzero(np.diff(columns[0], prepend=-1)), len(columns[0]))

    def _error(self, scales: np.ndarray) -> float:
        return float(scales.max()) / 2 * math.sqrt(self.size)

    def _products(self, some: np.ndarray, scales: np.ndarray, codes: np.ndarray) -> np.ndarray:
        return np.concatenate(
            [some @ (codes[i : i + 16384] * scales[i : i + 16384, None]).T for i in range(0, len(codes), 16384)], axis=1
        )

    def _thinned(self, cell: int, keys: np.ndarray, scales: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Joins what is near a pivot, or may be a partner of that, to it. Marks what is near none."""
        active = np.ones(len(keys), bool)
        own = self.pivots.get(cell, [])

        def take(products: np.ndarray, key: int, error: float, least: int = 0) -> bool:
            lowered = error + self._error(scales) * (1 + 3 * error) + 1e-5
            near = active & (products >= self.threshold - lowered)
            if near.sum() < least:
                return False
            angle = math.acos(max(-1.0, self.threshold - 2 * lowered)) + math.acos(self.threshold)
            wide = keys[products >= math.cos(min(math.pi, angle)) - lowered]
            self.links.append((wide, np.full(len(wide), key)))
            active[near] = False
            return True

        for unit, key, error in own:
            take(self._products(unit[None], scales, codes)[0], key, error)
        while active.sum() > CROWD:
            left = np.flatnonzero(active)
            chosen = left[np.linspace(0, len(left) - 1, 16).astype(int)]
            units = codes[chosen] * scales[chosen, None]
            products, found = self._products(units, scales, codes), False
            for place, unit, row in zip(chosen, units, products):
                error = self._error(scales[[place]])
                if active[place] and take(row, int(keys[place]), error, max(32, len(left) // 64)):
                    self.pivots.setdefault(cell, []).append((unit, int(keys[place]), error))
                    found = True
            if not found:
                break
        return active

    def _compared(self, keys: np.ndarray, units: np.ndarray, error: float) -> None:
        least = self.threshold - (error * (2 + 3 * error) + 1e-5)
        label, found = np.arange(len(keys)), False
        for i in range(0, len(keys), BLOCK):
            for j in range(i, len(keys), 8192):
                alike = units[i : i + BLOCK] @ units[j : j + 8192].T >= least
                if i == j:
                    np.fill_diagonal(alike, False)
                a, b = places(alike)
                a, b = a + i, b + j
                later = b > a
                if later.any():
                    label, found = joined(a[later], b[later], label), True
        if found:
            moved = np.flatnonzero(label != np.arange(len(keys)))
            self.links.append((keys[moved], keys[label[moved]]))

    def finish(self) -> tuple[np.ndarray, np.ndarray]:
        """Each linked key but the least of its group, and that least key."""
        if self.waiting:
            (_, keys, scales, codes), starts = self._distinct()
            done, units = 0, np.empty((0, self.size), np.float32)
            for start, end in zip(starts[:-1], starts[1:]):
                if end > done:
                    base, done = start, max(end, min(len(keys), start + 32768))
                    units = codes[start:done] * scales[start:done, None]
                if end - start > 1:
                    self._compared(keys[start:end], units[start - base : end - base], self._error(scales[start:end]))
        if not self.links:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        a, b = (np.concatenate(x) for x in zip(*self.links))
        keys, place = np.unique(np.concatenate([a, b]), return_inverse=True)
        label = joined(place[: len(a)], place[len(a) :], np.arange(len(keys)))
        moved = label != np.arange(len(keys))
        return keys[moved], keys[label[moved]]


def met(threshold: float):
    """Links (a, b) between keys from rows of ``SENT_SCHEMA``, all rows of a part in one task."""

    def run(batches):
        meetings: dict[int, Meeting] = {}
        for batch in batches:
            for row in range(batch.num_rows):
                size = batch.column("size")[row].as_py()
                columns = [np.frombuffer(batch.column(name)[row].as_buffer(), kind).copy() for name, kind in (
                    ("cells", np.int64), ("keys", np.int64), ("scales", np.float32), ("codes", np.int16)
                )]
                meetings.setdefault(size, Meeting(size, threshold)).add(*columns)
            batch = columns = None  # not held while the buckets are compared
        for meeting in meetings.values():
            a, b = meeting.finish()
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run
