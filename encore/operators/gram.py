"""Pairwise statistics of many columns in one scan.

Every batch of rows is a matrix; products of its masked, shifted columns give, for each
pair of columns, the statistics of the rows that hold both values: their number, both means,
both sums of squared deviations and the co-moment. Statistics of two sets of rows add up by
the update of Chan, Golub and LeVeque, so tasks merge their batches, and a tree of
shuffles merges the tasks. The columns are cut into tiles: a shuffled row is one pair of tiles,
and its size depends neither on the rows nor on the number of columns.

A null takes no part in the pairs of its column; a value that is not finite makes its pairs NaN.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Columns of a tile, and sets of statistics that one task merges.
TILE, FAN_IN = 128, 64
_PARTS = ("n", "mean_x", "mean_y", "ss_x", "ss_y", "co", "odd")
_TILE_SCHEMA = "part bigint, bx int, by int, packed binary"


def _statistics(x: np.ndarray, there: np.ndarray) -> tuple[np.ndarray, ...]:
    """The statistics of all pairs of columns of one batch."""
    usable = there & np.isfinite(x)
    m = usable.astype(np.float64)
    odd = (there & ~usable).astype(np.float64)
    some = usable.any(axis=0)
    low, high = np.where(usable, x, np.inf).min(axis=0, initial=np.inf), np.where(usable, x, -np.inf).max(axis=0, initial=-np.inf)
    mean = np.where(usable, x, 0.0).sum(axis=0) / np.maximum(m.sum(axis=0), 1)
    # A constant column is shifted to exact zeros, whatever its mean is rounded to.
    shift = np.where(some, np.where(low == high, low, mean), 0.0)
    z = np.where(usable, x - shift, 0.0)
    n, s, q, c = m.T @ m, z.T @ m, (z * z).T @ m, z.T @ z
    safe = np.maximum(n, 1)
    dx, dy = s / safe, s.T / safe
    both = there.astype(np.float64)
    return n, shift[:, None] + dx, shift[None, :] + dy, np.maximum(q - s * dx, 0.0), np.maximum(q.T - s.T * dy, 0.0), c - s * dy, odd.T @ both + both.T @ odd


def merge(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    """The statistics of two disjoint sets of rows together."""
    n = a[0] + b[0]
    share = b[0] / np.maximum(n, 1)
    # An empty side has no mean.
    dx, dy = np.where((a[0] > 0) & (b[0] > 0), b[1] - a[1], 0.0), np.where((a[0] > 0) & (b[0] > 0), b[2] - a[2], 0.0)
    weight = a[0] * share
    mean = [np.where(a[0] > 0, a[k] + d * share, b[k]) for k, d in ((1, dx), (2, dy))]
    return (n, *mean, a[3] + b[3] + dx * dx * weight, a[4] + b[4] + dy * dy * weight, a[5] + b[5] + dx * dy * weight, a[6] + b[6])


def _pack(statistics: Sequence[np.ndarray]) -> bytes:
    return np.stack(statistics).tobytes()


def _unpack(blob: bytes, shape: tuple[int, int]) -> tuple[np.ndarray, ...]:
    return tuple(np.frombuffer(blob, dtype=np.float64).reshape(len(_PARTS), *shape))


def pair_statistics(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x, y, n, mean_x, mean_y, ss_x, ss_y, co, odd) of all pairs of positions x <= y of the
    numeric ``columns``, over the rows that hold both values: their number, means, sums of
    squared deviations, co-moment, and how many values are not finite."""
    names = list(columns)
    k = len(names)
    tiles = [(a, min(a + TILE, k)) for a in range(0, k, TILE)]
    pairs = [(i, j) for i in range(len(tiles)) for j in range(i, len(tiles))]

    def shape(i: int, j: int) -> tuple[int, int]:
        return tiles[i][1] - tiles[i][0], tiles[j][1] - tiles[j][0]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if not batch.num_rows:
                continue
            there = np.column_stack([c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns])
            x = np.column_stack([c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in batch.columns])
            found = _statistics(x, there)
            total = found if total is None else merge(total, found)
        if total is not None:
            part = TaskContext.get().partitionId()
            blobs = [_pack([s[slice(*tiles[i]), slice(*tiles[j])] for s in total]) for i, j in pairs]
            rows = [[part] * len(pairs), [i for i, _ in pairs], [j for _, j in pairs], blobs]
            types = [pa.int64(), pa.int32(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(v, type=t) for v, t in zip(rows, types, strict=True)], ["part", "bx", "by", "packed"])

    def add(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")  # the same sum in every run
        i, j = table.column("bx")[0].as_py(), table.column("by")[0].as_py()
        total = None
        for blob in table.column("packed"):
            found = _unpack(blob.as_py(), shape(i, j))
            total = found if total is None else merge(total, found)
        first = [table.column(c).slice(0, 1) for c in ("part", "bx", "by")]
        return pa.table([*first, pa.array([_pack(total)], pa.binary())], names=["part", "bx", "by", "packed"])

    source = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(names)])
    merged = source.mapInArrow(count, _TILE_SCHEMA)
    # Each set of statistics keeps the number of its first task, by which the next step groups.
    for power in (1, 2):
        near = merged.withColumn("near", F.floor(F.col("part") / FAN_IN**power))
        merged = near.groupBy("near", "bx", "by").applyInArrow(add, _TILE_SCHEMA)
    merged = merged.groupBy("bx", "by").applyInArrow(add, _TILE_SCHEMA)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, i, j, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                x, y = np.meshgrid(np.arange(*tiles[i]), np.arange(*tiles[j]), indexing="ij")
                kept = x <= y
                values = [s[kept] for s in _unpack(blob, shape(i, j))]
                arrays = [pa.array(v.astype(np.int32)) for v in (x[kept], y[kept])] + [pa.array(values[0].astype(np.int64)), *map(pa.array, values[1:])]
                yield pa.RecordBatch.from_arrays(arrays, ["x", "y", *_PARTS])

    return merged.mapInArrow(spread, "x int, y int, n bigint, " + ", ".join(f"{p} double" for p in _PARTS[1:]))
