"""Filling containers of fixed capacity with items, neighbours along a space-filling curve together.

Each item has a size and a hashed vector projected to few dimensions. The vector is standardised with the
mean and spread of all items (two numbers a dimension), put on a grid, and numbered along the Hilbert curve. Items are
range-sorted by that number, and each partition fills containers with runs of neighbours: a window of
items is placed largest first, each into the fullest open container it fits; containers with room left stay open
for the next window. An item above the capacity is cut into full containers and a rest, which is placed like an
item. Sorting by (curve number, key) lets copies that share a number, be they a third of all, fall into several partitions.

Nulls: a null or zero size takes no room, and the item still gets a container; a null vector lies at the
mean of all items. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftlink.session import settle, task_count

#: Bits of a grid coordinate, items placed at a time, containers that stay open between windows.
BITS, WINDOW, OPEN = 10, 2048, 256


def hilbert(grid: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Numbers along the Hilbert curve of integer points (rows of ``grid``, coordinates below 2**bits)."""
    x = grid.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # undo the curve's turns, from the coarsest cell to the finest
        p = q - 1
        for i in range(n):
            set_ = (x[i] & q) != 0
            swap = np.where(set_, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(set_, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):  # Gray code
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def curve_number(df: DataFrame, vector: str, dims: int) -> DataFrame:
    """``df`` (key, size, vector) with ``curve`` in place of the vector."""
    v = [F.col(vector)[k].cast("double") for k in range(dims)]
    stats = df.agg(*[F.avg(c).alias(f"m{k}") for k, c in enumerate(v)], *[F.stddev_pop(c).alias(f"s{k}") for k, c in enumerate(v)]).first()
    mean = np.array([stats[f"m{k}"] or 0.0 for k in range(dims)])
    spread = np.array([stats[f"s{k}"] or 1.0 for k in range(dims)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            points = np.array([x if x else mean for x in b.column(2).to_pylist()], float).reshape(-1, dims)
            unit = 1 / (1 + np.exp(-1.7 * (points - mean) / spread))
            grid = np.minimum((unit * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(hilbert(grid), pa.int64())], ["key", "size", "curve"])

    return df.mapInArrow(run, "key long, size long, curve long")


def _fill(capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, used = TaskContext.get().partitionId() << 33, 0
        rooms: list[tuple[int, int]] = []  # (room left, container), sorted
        waiting: list[tuple[int, int, int, int]] = []
        out: list[tuple[int, int, int, int, int]] = []

        def new() -> int:
            nonlocal used
            used += 1
            return base + used - 1

        def place(last: bool) -> None:
            nonlocal rooms
            for size, key, piece, start in sorted(waiting, key=lambda x: (-x[0], x[1], x[2])):
                k = bisect.bisect_left(rooms, (size, -1))
                room, at = rooms.pop(k) if k < len(rooms) else (capacity, new())
                out.append((key, piece, at, start, size))
                bisect.insort(rooms, (room - size, at))
            waiting.clear()
            rooms = [r for r in rooms if r[0]][-OPEN:]

        def flush() -> pa.RecordBatch:
            cols = list(zip(*out)) or [()] * 5
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))], ["key", "piece", "container", "start", "size"])

        for b in batches:
            for key, size in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                size, piece, start = size or 0, 0, 0
                while size > capacity:  # full containers of their own
                    out.append((key, piece, new(), start, capacity))
                    size, piece, start = size - capacity, piece + 1, start + capacity
                waiting.append((size, key, piece, start))
                if len(waiting) >= WINDOW:
                    place(False)
            if out:
                yield flush()
        place(True)
        if out:
            yield flush()

    return run


def pack(df: DataFrame, key: str, size: str, vector: str, dims: int, capacity: int = 2048, partitions: int | None = None) -> DataFrame:
    """(key, piece, container, start, size): where every item, or every piece of an item above ``capacity``, goes.

    Each of the ``partitions`` (by default the session's shuffle partitions) leaves at most ``OPEN`` containers partly filled at its end.
    """
    partitions = partitions or task_count(df.sparkSession)
    items = curve_number(df.select(F.col(key).alias("key"), F.col(size).cast("long").alias("size"), F.col(vector).alias("vector")), "vector", dims)
    ordered = items.repartitionByRange(partitions, "curve", "key").sortWithinPartitions("curve", "key")
    # written at once: container numbers hold the task, so a later step must not run the tasks again
    placed = settle(ordered.select("key", "size").mapInArrow(_fill(capacity), "key long, piece int, container long, start long, size long"))
    return placed.select(F.col("key").alias(key), "piece", "container", "start", F.col("size").alias(size))
