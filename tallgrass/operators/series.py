"""Series in long form, one row per series and period: selection, returns, smoothing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F


def of_year(prices: DataFrame, year: int, symbol: str | None = None) -> DataFrame:
    """Rows of one year (dates start with it), optionally of one symbol."""
    rule = F.col("date").startswith(f"{year:04d}")
    return prices.where(rule if symbol is None else rule & (F.col("symbol") == symbol))


def complete(prices: DataFrame, periods: int) -> DataFrame:
    """Rows of the symbols that have exactly ``periods`` rows."""
    if periods < 1:
        raise ValueError("periods must be at least 1")
    whole = prices.groupBy("symbol").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") == periods)
    return prices.join(whole.select("symbol"), "symbol", "left_semi")


def with_sector(prices: DataFrame, securities: DataFrame) -> DataFrame:
    return prices.join(securities, "symbol")


def load_complete(prices: DataFrame, securities: DataFrame, year: int, periods: int) -> DataFrame:
    """Closes of one year with the sector, complete series of listed symbols only."""
    return with_sector(complete(of_year(prices, year), periods), securities)


def log_returns(prices: DataFrame) -> DataFrame:
    """log(close) minus log of the previous close; a symbol has one row per period."""
    order = Window.partitionBy("symbol").orderBy("date")
    change = F.log("close") - F.log(F.lag("close").over(order))
    return prices.withColumn("log_return", change).where(F.col("log_return").isNotNull())


def as_vectors(rows: DataFrame, value: str, *keys: str) -> DataFrame:
    """One vector per symbol, ordered by date; meant for complete series of a fixed length."""
    ordered = F.sort_array(F.collect_list(F.struct("date", value)))
    return rows.groupBy("symbol", *keys).agg(F.transform(ordered, lambda x: x[value]).alias("features"))


def closest_value(weight: np.ndarray | float, s: np.ndarray | float, left: np.ndarray | float, right: np.ndarray | float) -> np.ndarray:
    """The x that minimises weight (x - s)^2 + |x - left| + |x - right|, element by element.

    Between the neighbours the two distances cancel out and x = s; outside, x moves from s
    towards them by 1 / weight and stops at the nearer one.
    """
    low, high = np.minimum(left, right), np.maximum(left, right)
    return np.where(s < low, np.minimum(s + 1 / weight, low), np.where(s > high, np.maximum(s - 1 / weight, high), s))


def _smooth(signals: np.ndarray, alpha: float, sweeps: int) -> np.ndarray:
    """All sweeps over all rows of a matrix of series of one length.

    A point needs its left neighbour of the same sweep and its right neighbour of the sweep
    before.  So sweep t may be at point w - 2t while sweep 0 is at point w: step w moves every
    second point of a range at once, in all series, and gives what sweeps one by one would give.
    """
    x, last = signals.copy(), signals.shape[1] - 1
    if last == 0:
        return x
    points = np.arange(last + 1)
    # an end point has its only neighbour on both sides, and twice the weight
    left, right = abs(points - 1), last - abs(last - 1 - points)
    weight = np.where((points == 0) | (points == last), 2 * alpha, alpha)
    for w in range(last + 2 * sweeps + 1):
        k = np.arange(max(w - 2 * sweeps, w % 2), min(w, last) + 1, 2)
        x[:, k] = closest_value(weight[k], signals[:, k], x[:, left[k]], x[:, right[k]])
    return x


#: Values of series that are smoothed together.
BLOCK_VALUES = 1 << 20


def denoise(df: DataFrame, alpha: float, sweeps: int) -> DataFrame:
    """Smooth each series by ``sweeps + 1`` coordinate sweeps, from the first point to the last.

    df: (series, pos, value) with one row per series and period, so a series is as long as the
    number of periods; series of one length are smoothed together, as matrices of bounded size.
    A missing value stays missing, and a point beside one stays as it is.  Of rows that repeat a
    position the smaller value comes first.  Returns (series, pos, value, smooth).
    """
    if alpha <= 0 or sweeps < 0:
        raise ValueError("alpha must be positive and sweeps not negative")
    point = F.struct("pos", F.col("value").cast("double").alias("value"))
    whole = df.groupBy("series").agg(F.sort_array(F.collect_list(point)).alias("_p"))
    whole = whole.select("series", F.col("_p.pos").alias("pos"), F.col("_p.value").alias("value"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("value")
            flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            lengths = values.value_lengths().to_numpy(zero_copy_only=False)
            starts = np.cumsum(lengths) - lengths
            smooth = np.empty_like(flat)
            for n in np.unique(lengths):
                of_length = starts[lengths == n]
                for at in range(0, len(of_length), max(1, BLOCK_VALUES // n)):
                    places = of_length[at : at + max(1, BLOCK_VALUES // n), None] + np.arange(n)
                    smooth[places] = _smooth(flat[places], alpha, sweeps)
            offsets = pa.array(np.r_[starts, len(flat)], type=pa.int32())
            filled = pa.ListArray.from_arrays(offsets, pa.array(smooth, from_pandas=True))
            yield pa.RecordBatch.from_arrays([*batch.columns, filled], [*batch.schema.names, "smooth"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in whole.schema.fields) + ", smooth array<double>"
    done = whole.mapInArrow(run, schema)
    return done.select("series", F.inline(F.arrays_zip("pos", "value", "smooth")))
