"""Vector columns (arrays of numbers) as NumPy blocks inside Arrow batches, and moments of them.

Vectors reach Python one Arrow batch at a time without a Python object per row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F, types as T

#: Rows and columns of distances that are summed together, in the processor's cache.
TILE = (16, 4096)
#: Distances of one block that are held at a time.
CELLS = 1 << 20


def block(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """An Arrow column of equally long lists as a float64 matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = len(column)
    if column.null_count:
        raise ValueError("vectors must not be NULL")
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if rows == 0:
        return flat.reshape(0, 0)
    if len(flat) % rows:
        raise ValueError("vectors differ in length")
    return flat.reshape(rows, -1)


def distances(left: np.ndarray, right: np.ndarray, p: float = 2.0) -> np.ndarray:
    """Minkowski distances between the rows of two matrices, summed one dimension at a time."""
    total = _summed_gaps(left, np.ascontiguousarray(right.T, dtype=np.float64), p)
    if p == 2:
        return np.sqrt(total, out=total)
    return total if p == 1 else total ** (1.0 / p)


def _summed_gaps(left: np.ndarray, b: np.ndarray, p: float) -> np.ndarray:
    """Sums of |a - b| ** p, one dimension at a time, tile by tile: a tile stays in the processor's cache.

    ``b`` has a row for each dimension; its type is that of the sums.
    """
    a, kind = np.ascontiguousarray(left.T, dtype=b.dtype), b.dtype
    total = np.zeros((len(left), b.shape[1]), kind)
    if not total.size:
        return total
    gap = np.empty((min(TILE[0], len(left)), min(TILE[1], b.shape[1])), kind)
    for i in range(0, len(left), TILE[0]):
        for j in range(0, b.shape[1], TILE[1]):
            rows, cols = a[:, i : i + TILE[0]], b[:, j : j + TILE[1]]
            held, out = gap[: rows.shape[1], : cols.shape[1]], total[i : i + TILE[0], j : j + TILE[1]]
            for x, y in zip(rows, cols):
                np.subtract(x[:, None], y[None, :], out=held)
                if p == 2:
                    np.multiply(held, held, out=held)
                else:
                    np.abs(held, out=held)
                    if p != 1:
                        np.power(held, p, out=held)
                out += held
    return total


def nearest_pairs(left: np.ndarray, right: np.ndarray, k: int, p: float = 2.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row of ``left`` its k closest rows of ``right`` and all that are as close as the k-th.

    Gives (left row, right row, distance), the distances as ``distances`` has them.  For p = 2 one matrix
    product, |a|^2 + |b|^2 - 2ab, and for p = 1 sums in single precision find the rows that can be among the
    closest within their rounding error, and only their distances are computed from differences.  No more
    than CELLS distances are held at a time, at least those of one row.
    """
    step = max(1, CELLS // max(1, len(right)))
    # made once for all slices: squared lengths, or values by dimension in single precision
    other = None
    if p == 2:
        other = np.einsum("ij,ij->i", right, right)
    elif p == 1 and max(np.abs(left).max(initial=0), np.abs(right).max(initial=0)) < 1e30:
        other = np.ascontiguousarray(right.T, dtype=np.float32)
    parts = []
    for at in range(0, len(left), step):
        row, col, gaps = _nearest_slice(left[at : at + step], right, other, min(k, len(right)), p)
        parts.append((row + at, col, gaps))
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(c) for c in zip(*parts))


def _kth(gaps: np.ndarray, take: int) -> np.ndarray:
    """A bound of each row's ``take``-th smallest value that is not below it: of the least of every few columns."""
    fold = 16
    while fold > 1 and gaps.shape[1] // fold < 16 * take:
        fold //= 2
    width = gaps.shape[1] // fold
    least = gaps[:, : width * fold].reshape(len(gaps), fold, width).min(axis=1) if fold > 1 else gaps
    return np.partition(least, take - 1, axis=1)[:, take - 1]


def _nearest_slice(left: np.ndarray, right: np.ndarray, other: np.ndarray | None, take: int, p: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if p == 2:
        own = np.einsum("ij,ij->i", left, left)
        rough = left @ right.T
        rough *= -2
        rough += own[:, None]
        rough += other[None, :]
        # rounding: a few units in the last place of the norms for each dimension
        slack = 8 * np.finfo(np.float64).eps * (left.shape[1] + 2) * (own + other.max())
    elif other is not None:
        rough = _summed_gaps(left, other, p)
        # each value, difference and sum is rounded once; sums are at most those of both rows' values
        most = np.abs(left).sum(axis=1) + np.abs(other).sum(axis=0, dtype=np.float64).max()
        slack = 2 * np.finfo(np.float32).eps * (left.shape[1] + 4) * most + 1e-36 * left.shape[1]
    else:
        rough, slack = distances(left, right, p), np.zeros(len(left))
    bound = np.nextafter((_kth(rough, take).astype(np.float64) + 2 * slack).astype(rough.dtype), np.inf, dtype=rough.dtype)
    row, col = np.divmod(np.flatnonzero(rough <= bound[:, None]), len(right))
    if p in (1, 2):
        total = np.zeros(len(row))
        for i in range(left.shape[1]):
            gap = left[row, i] - right[col, i]
            total += gap * gap if p == 2 else np.abs(gap)
        exact = np.sqrt(total) if p == 2 else total
    else:
        exact = rough[row, col]
    # the k-th smallest exact distance of each row ends the list
    order = np.lexsort((exact, row))
    row, col, exact = row[order], col[order], exact[order]
    starts = np.searchsorted(row, np.arange(len(left)))
    stay = exact <= exact[starts + take - 1][row]
    return row[stay], col[stay], exact[stay]


def with_columns(
    df: DataFrame, vector: str, added: T.StructType, compute: Callable[[np.ndarray], list[np.ndarray]]
) -> DataFrame:
    """Append columns computed from the vector column of each Arrow batch."""
    schema = T.StructType([*df.schema.fields, *added.fields])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            made = compute(block(batch.column(batch.schema.get_field_index(vector))))
            names = [*batch.schema.names, *added.names]
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(m) for m in made]], names=names)

    return df.mapInArrow(add, schema)


def nearest_centre(df: DataFrame, centres: np.ndarray, vector: str = "features") -> DataFrame:
    """Add ``cluster`` (lowest index on ties) and ``dist`` to the closest of the given centres."""

    def compute(x: np.ndarray) -> list[np.ndarray]:
        gaps = distances(x, centres)
        return [gaps.argmin(axis=1).astype(np.int32), gaps.min(axis=1)]

    added = T.StructType().add("cluster", T.IntegerType()).add("dist", T.DoubleType())
    return with_columns(df, vector, added, compute)


def linear_class(df: DataFrame, weights: np.ndarray, vector: str = "features", name: str = "prediction") -> DataFrame:
    """Class with the highest w . (1, x), the lowest index on ties."""

    def compute(x: np.ndarray) -> list[np.ndarray]:
        return [(weights[:, 0] + x @ weights[:, 1:].T).argmax(axis=1).astype(np.int32)]

    return with_columns(df, vector, T.StructType().add(name, T.IntegerType()), compute)


def group_means(df: DataFrame, group: str, vector: str = "features") -> DataFrame:
    """Element-wise mean per group; one buffer of the vector's length per group and task."""
    as_vector = array_to_vector(F.col(vector).cast("array<double>"))
    return df.groupBy(group).agg(vector_to_array(Summarizer.mean(as_vector)).alias("mean"))


def mean_vector(df: DataFrame, vector: str = "features") -> tuple[int, np.ndarray]:
    """Row count and element-wise mean of all vectors: one vector comes back to the driver."""
    as_vector = array_to_vector(F.col(vector).cast("array<double>"))
    row = df.agg(F.count(F.lit(1)).alias("n"), Summarizer.mean(as_vector).alias("mean")).first()
    return row["n"], np.asarray(row["mean"].toArray()) if row["n"] else np.zeros(0)


def gram(df: DataFrame, vector: str = "features", centred: bool = True) -> DataFrame:
    """Scatter matrix of the rows, (i, j, value) with i <= j.

    Each task adds up its own matrix product and hands on one small matrix.
    """
    shift = mean_vector(df, vector)[1] if centred else None

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = block(batch.column(0))
            x = x - shift if shift is not None else x
            total = x.T @ x if total is None else total + x.T @ x
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_arrays(
                [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], names=["i", "j", "value"]
            )

    parts = df.select(vector).mapInArrow(partial, "i int, j int, value double")
    return parts.groupBy("i", "j").agg(F.sum("value").alias("value"))


def squared_distance_totals(df: DataFrame, key: str, vector: str = "features") -> DataFrame:
    """For each row the sum of squared distances to all rows, without forming pairs.

    sum_j |x - x_j|^2 = n |x - m|^2 + sum_j |x_j - m|^2 with m the mean: two passes.
    """
    n, mean = mean_vector(df, vector)

    def compute(x: np.ndarray) -> list[np.ndarray]:
        return [((x - mean) ** 2).sum(axis=1)]

    off = with_columns(df.select(key, vector), vector, T.StructType().add("_off", T.DoubleType()), compute).drop(vector)
    spread = off.agg(F.sum("_off")).first()[0] or 0.0
    return off.select(key, (F.col("_off") * n + F.lit(spread)).alias("total"))


def to_doubles(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("array<double>")
