"""Support vector machines fitted to a certified distance from their optimum.

The function is  penalty / 2 |w|^2 + mean of max(0, 1 - y (w.x + b)).  Its hinge is rounded over a
width h, which makes Newton steps possible; h is made smaller until the fit is good enough.  A pass over
the rows adds up the gradient, the curvature and the shares of both classes, and its result is a
few numbers.  The slopes of the rounded hinge are a solution of the dual problem once the
classes are balanced, so each pass also gives a lower bound on the optimum: the gap between
the function and that bound is the certificate.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from tallgrass.functions.vectors import block

#: The rounding starts at this width, at which all rows bend, and shrinks by this factor.
FIRST_WIDTH, SHRINK = 2.0, 2.0
#: What the damping of the last step is multiplied by in the trials of the next one.
TRIALS = (0.04, 0.2, 1.0, 8.0)
#: Stands in for a penalty of 0, whose optimum need not exist.
LEAST_PENALTY = 1e-6


@dataclass(frozen=True)
class Machine:
    """Weights, intercept, the value reached and how far it can lie above the optimum."""

    weights: np.ndarray
    intercept: float
    value: float
    gap: float
    passes: int

    @property
    def margin(self) -> float:
        norm = float(np.linalg.norm(self.weights))
        return 1 / norm if norm else math.inf

    def prediction(self, features: str = "features") -> Column:
        """1.0 on the positive side of the plane, else 0.0, from a vector column."""
        weights = F.array(*[F.lit(float(w)) for w in self.weights])
        products = F.zip_with(vector_to_array(features), weights, lambda x, w: x * w)
        return (F.aggregate(products, F.lit(self.intercept), lambda a, p: a + p) > 0).cast("double")


def _sums(rows: DataFrame, planes: list[np.ndarray], width: float) -> list[dict[str, np.ndarray]]:
    """What one pass finds at each plane (weights, then intercept), as means over the rows."""
    size = len(planes[0])
    length = 5 + 3 * size + size * size

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(planes), length))
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = block(batch.column(0))
            x = np.hstack([x, np.ones((len(x), 1))])
            y = np.where(batch.column(1).to_numpy() > 0, 1.0, -1.0)
            for at, plane in enumerate(planes):
                short = 1 - y * (x @ plane)
                slope = np.clip(short / width, 0, 1)
                rounded = slope * (short - slope * width / 2)
                bent = x[(short > 0) & (short < width)]
                total[at] += np.concatenate([
                    [len(x), np.maximum(short, 0).sum(), rounded.sum(), (slope**2 * (y > 0)).sum(), (slope**2 * (y < 0)).sum()],
                    (slope * (y > 0)) @ x, (slope * (y < 0)) @ x, (x * x).sum(axis=0), (bent.T @ bent / width).ravel(),
                ])
        ends = np.arange(len(planes) + 1, dtype=np.int32) * length
        sums = pa.ListArray.from_arrays(pa.array(ends), pa.array(total.ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(range(len(planes)), pa.int32()), sums], names=["at", "sums"])

    # one row a plane comes back, as long as the curvature has entries
    parts = rows.mapInArrow(partial, "at int, sums array<double>").select("at", array_to_vector("sums").alias("sums"))
    found = np.zeros((len(planes), length))
    for r in parts.groupBy("at").agg(Summarizer.sum(F.col("sums")).alias("sums")).collect():
        found[r["at"]] = r["sums"].toArray()
    answers = []
    for own in found:
        head, positive, negative, squares, curve = np.split(own / max(own[0], 1.0), [5, 5 + size, 5 + 2 * size, 5 + 3 * size])
        answers.append({
            "hinge": head[1], "rounded": head[2], "squared": head[3:5], "positive": positive, "negative": negative,
            "squares": squares, "curve": curve.reshape(size, size),
        })
    return answers


def _lower_bounds(sums: dict[str, np.ndarray], penalty: float, width: float) -> tuple[float, float]:
    """The dual values of the slopes, of the hinge and of the rounded one.

    The heavier class is scaled down to the weight of the other: a plane is free to move along its
    intercept, so only balanced slopes bound the function from below.
    """
    up, down = sums["positive"], sums["negative"]
    weight = min(up[-1], down[-1])
    if weight <= 0:
        return 0.0, 0.0
    scale = np.array([weight / up[-1], weight / down[-1]])
    pull = up[:-1] * scale[0] - down[:-1] * scale[1]
    plain = float(2 * weight - pull @ pull / (2 * penalty))
    return plain, plain - float(width / 2 * scale**2 @ sums["squared"])


def fit_machine(df: DataFrame, penalty: float, tolerance: float = 1e-4, max_passes: int = 1000) -> Machine:
    """The machine of (features, label 0 or 1) whose value lies within ``tolerance`` of the optimum.

    ``gap`` tells how far it can lie above it; it passes ``tolerance`` only if ``max_passes`` passes were
    not enough.  A penalty of 0 counts as 1e-6.  Without rows, or with one class only, the
    plane has no weights and names that class.
    """
    if penalty < 0 or tolerance <= 0:
        raise ValueError("penalty must not be negative and tolerance must be positive")
    penalty = max(penalty, LEAST_PENALTY)
    rows = df.select(vector_to_array("features").alias("x"), F.col("label").cast("double").alias("y")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        shape = rows.agg(F.max(F.size("x")), F.min("y"), F.max("y")).first()
        if shape[0] is None or (shape[1] > 0) == (shape[2] > 0):
            positive = shape[0] is not None and shape[1] > 0
            return Machine(np.zeros(shape[0] or 0), 1.0 if positive else -1.0, 0.0, 0.0, 0)
        ridge = penalty * np.append(np.ones(shape[0]), 0.0)
        plane, width, damping, passes = np.zeros(shape[0] + 1), FIRST_WIDTH, 1e-3, 1
        [now] = _sums(rows, [plane], width)
        bound, rounded_bound = _lower_bounds(now, penalty, width)
        best = (float(now["hinge"]), plane)
        while best[0] - bound > tolerance and passes < max_passes:
            value = float(now["rounded"] + ridge @ plane**2 / 2)
            if value - rounded_bound <= width / 20:
                # as good as it needs to be at this width
                width /= SHRINK
                [now] = _sums(rows, [plane], width)
            else:
                # the curvature can be no greater than if all rows were bent: a share of that
                # steadies steps into regions where few rows are.  One pass tries several shares
                slope = ridge * plane + now["negative"] - now["positive"]
                shares = [min(damping * f, 1.0) for f in TRIALS]
                steps = [np.linalg.lstsq(now["curve"] + np.diag(ridge + d * now["squares"] / width), slope, rcond=None)[0] for d in shares]
                tried = [(then["rounded"] + ridge @ (plane - step) ** 2 / 2, plane - step, then, d, slope @ step / 20)
                         for step, then, d in zip(steps, _sums(rows, [plane - step for step in steps], width), shares, strict=True)]
                low = min(tried, key=lambda t: t[0])
                if low[0] <= value - low[4]:
                    plane, now, damping = low[1], low[2], max(low[3], 1e-7)
                else:
                    damping = min(shares[-1] * TRIALS[-1], 1.0)
            passes += 1
            reached = float(now["hinge"] + ridge @ plane**2 / 2)
            best = min(best, (reached, plane), key=lambda b: b[0])
            plain, rounded_bound = _lower_bounds(now, penalty, width)
            bound = max(bound, plain)
        return Machine(best[1][:-1], float(best[1][-1]), float(best[0]), float(best[0] - bound), passes)
    finally:
        rows.unpersist()
