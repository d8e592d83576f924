"""K-means that leaves out every q-th point of a cluster, in order of distance."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tallgrass.functions.vectors import group_means, nearest_centre
from tallgrass.plans.lineage import bucketed, cut_lineage
from tallgrass.plans.ordering import rank_in_group


def without_every_qth(df: DataFrame, q: int, group: str = "cluster", dist: str = "dist", key: str = "id") -> DataFrame:
    """Rank rows by distance inside each group and leave out ranks q, 2q, 3q ..."""
    if q < 1:
        raise ValueError("q must be at least 1")
    return rank_in_group(df, [group], [dist, key]).where(F.col("rank") % q != 0)


def trimmed_kmeans(points: DataFrame, centres: np.ndarray, max_iter: int, q: int, tolerance: float = 1e-9) -> np.ndarray:
    """Centres after at most ``max_iter`` rounds, earlier if they repeat.

    points: (id, features), ids unique.  The points are written once, in buckets of their id.  A
    round assigns them and ranks only (cluster, dist, id), whatever the size of a cluster; the
    ids of every q-th rank are then taken out of the buckets by an anti join in which the vectors
    stay where they are, and one aggregate gives the means.  Only the k centres are held on the
    driver.  A cluster left without points keeps its centre.
    """
    if max_iter < 1:
        raise ValueError("max_iter must be at least 1")
    if not len(centres):
        raise ValueError("at least one start centre is needed")
    centres = np.asarray(centres, dtype=np.float64)
    with bucketed(points.select("id", "features"), "id", points.count()) as placed:
        for _ in range(max_iter):
            # written: the range sort looks at its input twice
            assigned = cut_lineage(nearest_centre(placed, centres).select("id", "cluster", "dist"))
            left_out = rank_in_group(assigned, ["cluster"], ["dist", "id"]).where(F.col("rank") % q == 0).select("id")
            kept = nearest_centre(placed.join(left_out, "id", "left_anti"), centres)
            moved = centres.copy()
            for row in group_means(kept, "cluster").collect():
                moved[row["cluster"]] = row["mean"]
            done = np.abs(moved - centres).max() <= tolerance
            centres = moved
            if done:
                break
    return centres


def first_points(points: DataFrame, k: int) -> np.ndarray:
    """The first k points by id as start centres."""
    rows = points.orderBy("id").limit(k).collect()
    return np.asarray([r["features"] for r in rows], dtype=np.float64)
