"""Exact k nearest neighbours and the classifier built on them.

Training rows are grouped around pivots, and groups that lie together are joined to bins of about
one block.  A query first searches its own bin and then only those bins of which the triangle
inequality cannot rule out every group; what it visits is kept as ids.  A bin is cut into blocks of
bounded size on both sides, so a group that holds a third of the rows becomes many tasks, and
the vectors of a block move once for each block on the other side, not once for each group.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from tallgrass.functions.vectors import block, distances, nearest_pairs, with_columns
from tallgrass.plans.lineage import cut_lineage

#: Queries whose distances to all pivots are held at a time.
ASKED = 256
_FOUND = "part int, query_id long, train_id long, label int, dist double"


def _metric(left: np.ndarray, right: np.ndarray, p: float) -> np.ndarray:
    """A distance that obeys the triangle inequality: for p < 1 the sum without the root does."""
    plain = distances(left, right, p)
    return plain if p >= 1 else plain**p


def _pivots(train: DataFrame, rows: int, limit: int) -> np.ndarray:
    """A few training vectors spread by hash; their number has a fixed ceiling."""
    wanted = max(1, min(limit, math.ceil(math.sqrt(rows) / 4)))
    picked = train.select("features", F.xxhash64("train_id").alias("_h"), "train_id").orderBy("_h", "train_id").limit(wanted)
    return np.asarray([r["features"] for r in picked.select("features").collect()], dtype=np.float64)


def _with_cell(df: DataFrame, pivots: np.ndarray, p: float) -> DataFrame:
    def compute(x: np.ndarray) -> list[np.ndarray]:
        cell, gap = np.zeros(len(x), np.int32), np.zeros(len(x))
        # a slice of rows, as a batch is not bounded by the number of pivots
        for at in range(0, len(x), ASKED):
            gaps = _metric(x[at : at + ASKED], pivots, p)
            cell[at : at + ASKED], gap[at : at + ASKED] = gaps.argmin(axis=1), gaps.min(axis=1)
        return [cell, gap]

    return with_columns(df, "features", T.StructType().add("cell", T.IntegerType()).add("gap", T.DoubleType()), compute)


def _top_k(k: int, p: float):
    """Best k training rows of one block for every query of one block, by (dist, label, id)."""

    def search(queries: pa.Table, train: pa.Table) -> pa.Table:
        out: dict[str, list[np.ndarray]] = {"part": [], "query_id": [], "train_id": [], "label": [], "dist": []}
        if queries.num_rows and train.num_rows:
            part = queries.column("part")[0].as_py()
            ids = queries.column("query_id").to_numpy()
            train_ids, labels = train.column("train_id").to_numpy(), train.column("label").to_numpy()
            points = block(train.column("features"))
            asked = block(queries.column("features"))
            take = min(k, len(points))
            for at in range(0, len(asked), 256):
                row, col, gaps = nearest_pairs(asked[at : at + 256], points, k, p)
                order = np.lexsort((train_ids[col], labels[col], gaps, row))
                row, col, gaps = row[order], col[order], gaps[order]
                starts = np.searchsorted(row, row, side="left")
                keep = np.arange(len(row)) - starts < take
                row, col, gaps = row[keep], col[keep], gaps[keep]
                out["part"].append(np.full(len(row), part, dtype=np.int32))
                out["query_id"].append(ids[at : at + 256][row])
                out["train_id"].append(train_ids[col])
                out["label"].append(labels[col])
                out["dist"].append(gaps)
        types = {"part": pa.int32(), "query_id": pa.int64(), "train_id": pa.int64(), "label": pa.int32(), "dist": pa.float64()}
        return pa.table(
            {n: pa.array(np.concatenate(v) if v else [], type=types[n]) for n, v in out.items()}
        )

    return search


def _bins(pivots: np.ndarray, rows: dict[tuple[int, int], int], per_bin: int) -> dict[tuple[int, int], int]:
    """Groups to bins of about ``per_bin`` rows: in each part, along a path from pivot to nearest pivot.

    There are at most as many groups as pivots in a part.
    """
    left = np.ones(len(pivots), bool)
    path, here = [], 0
    for _ in range(len(pivots)):
        left[here] = False
        path.append(here)
        gaps = ((pivots - pivots[here]) ** 2).sum(axis=1)
        here = int(np.where(left, gaps, np.inf).argmin())
    bins: dict[tuple[int, int], int] = {}
    for part in {part for part, _ in rows}:
        number, filled = 0, 0
        for cell in path:
            own = rows.get((part, cell), 0)
            if filled and filled + own > per_bin:
                number, filled = number + 1, 0
            # a query may belong to a group without training rows
            bins[part, cell] = number
            filled += own
    return bins


def _search(
    queries: DataFrame, train: DataFrame, asked: dict[tuple[int, int], int], known: dict[tuple[int, int], int],
    k: int, p: float, rows_per_block: int,
) -> DataFrame:
    """Block-wise search of each query in the bin it is assigned to.

    ``asked`` and ``known`` count the query and training rows per (part, bin): their size is
    bounded by the number of pivots.
    """
    plan = [
        (part, bin_no, -(-n // rows_per_block), -(-known[part, bin_no] // rows_per_block))
        for (part, bin_no), n in asked.items()
        if (part, bin_no) in known
    ]
    schema = "part int, bin int, q_blocks int, t_blocks int"
    blocks = F.broadcast(queries.sparkSession.createDataFrame(plan, schema))

    def spread(df: DataFrame, key: str, own: str, other: str, own_name: str, other_name: str) -> DataFrame:
        # a row stays in one of the blocks of its own side and visits all blocks of the other
        placed = df.join(blocks, ["part", "bin"]).withColumn(own_name, F.pmod(F.xxhash64(key), F.col(own)).cast("int"))
        return placed.withColumn(other_name, F.explode(F.sequence(F.lit(0), F.col(other) - 1))).drop("q_blocks", "t_blocks")

    q = spread(queries.select("part", "bin", "query_id", "features"), "query_id", "q_blocks", "t_blocks", "qb", "tb")
    t = spread(train.select("part", "bin", "train_id", "features", "label"), "train_id", "t_blocks", "q_blocks", "tb", "qb")
    keys = ["part", "bin", "qb", "tb"]
    return q.groupBy(*keys).cogroup(t.groupBy(*keys)).applyInArrow(_top_k(k, p), _FOUND)


def _bin_counts(df: DataFrame) -> dict[tuple[int, int], int]:
    counted = df.groupBy("part", "bin").agg(F.count(F.lit(1)).alias("rows")).collect()
    return {(r["part"], r["bin"]): r["rows"] for r in counted}


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("part", "query_id").orderBy("dist", "label", "train_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest_by_part(
    queries: DataFrame, train: DataFrame, k: int, p: float = 2.0, rows_per_block: int = 16384, max_pivots: int = 2048
) -> DataFrame:
    """The k nearest training rows of every query, within each ``part``.

    queries: (part int, query_id long, features); train: (part int, train_id long, features,
    label int).  Returns (part, query_id, rank, train_id, label, dist), ranked by distance,
    then label, then id.  Exact for every p > 0.
    """
    if k < 1 or p <= 0:
        raise ValueError("k must be at least 1 and p positive")
    queries = queries.select("part", "query_id", "features")
    train = train.select("part", "train_id", "features", "label")
    rows = train.count()
    if rows == 0:
        raise ValueError("the training table is empty")
    pivots = _pivots(train, rows, max_pivots)
    train = cut_lineage(_with_cell(train, pivots, p))
    queries = cut_lineage(_with_cell(queries, pivots, p))

    # one row per part and pivot
    shells = train.groupBy("part", "cell").agg(
        F.count(F.lit(1)).alias("rows"), F.min("gap").alias("inner"), F.max("gap").alias("outer")
    ).collect()
    bins = _bins(pivots, {(r["part"], r["cell"]): r["rows"] for r in shells}, rows_per_block)
    places = [(part, cell, number) for (part, cell), number in bins.items()]

    def binned(df: DataFrame) -> DataFrame:
        # one row per part and pivot
        table = df.sparkSession.createDataFrame(places, "part int, cell int, bin int")
        return df.join(F.broadcast(table), ["part", "cell"])

    train, queries = binned(train), binned(queries)
    known: dict[tuple[int, int], int] = {}
    for r in shells:
        key = r["part"], bins[r["part"], r["cell"]]
        known[key] = known.get(key, 0) + r["rows"]
    own = cut_lineage(_search(queries, train, _bin_counts(queries), known, k, p, rows_per_block))
    if max((number for _, number in known), default=0) == 0:
        # one bin a part: everything has been searched
        return _best(own, k)
    reach = _best(own, k).groupBy("part", "query_id").agg(F.max("dist").alias("_d"), F.count(F.lit(1)).alias("_n"))
    bound = F.when(F.col("_n") == k, F.col("_d")).otherwise(F.lit(float("inf")))
    open_queries = queries.drop("gap").join(reach, ["part", "query_id"], "left").select(
        "part", "query_id", "features", F.col("bin").alias("home"), F.coalesce(bound, F.lit(float("inf"))).alias("bound")
    )
    table = {}
    for part in {r["part"] for r in shells}:
        cells = sorted((r for r in shells if r["part"] == part), key=lambda r: (bins[part, r["cell"]], r["cell"]))
        numbers = np.asarray([bins[part, r["cell"]] for r in cells])
        # groups in the order of their bins, and where each bin begins
        table[part] = (*(np.asarray([r[c] for r in cells]) for c in ("cell", "inner", "outer")), *np.unique(numbers, return_index=True))

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            # a slice of queries visits at most ASKED times the number of pivots
            for at in range(0, whole.num_rows, ASKED):
                batch = whole.slice(at, ASKED)
                gaps = _metric(block(batch.column(2)), pivots, p)
                parts, home = batch.column(0).to_numpy(), batch.column(3).to_numpy()
                limit = batch.column(4).to_numpy()
                limit = limit if p >= 1 else limit**p
                # a little slack: rounding must not rule out a row that lies exactly on the bound
                limit = limit * (1 + 1e-9) + 1e-12
                for part in np.unique(parts):
                    if part not in table:
                        continue
                    cells, inner, outer, numbers, begins = table[part]
                    mine = np.nonzero(parts == part)[0]
                    near = gaps[mine][:, cells]
                    lowest = np.maximum(near - outer, inner - near)
                    needed = np.logical_or.reduceat(lowest <= limit[mine][:, None], begins, axis=1)
                    hit, at_bin = np.nonzero(needed & (numbers[None, :] != home[mine][:, None]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(hit), part, np.int32)), pa.array(numbers[at_bin], type=pa.int32()), batch.column(1).take(pa.array(mine[hit]))],
                        names=["part", "bin", "query_id"],
                    )

    # ids only, written once: they are counted first and searched then
    visits = cut_lineage(open_queries.mapInArrow(candidates, "part int, bin int, query_id long"))
    counts = _bin_counts(visits)
    visits = visits.join(queries.select("part", "query_id", "features"), ["part", "query_id"])
    away = _search(visits, train, counts, known, k, p, rows_per_block)
    return _best(own.unionByName(away), k)


def nearest(queries: DataFrame, train: DataFrame, k: int, p: float = 2.0, **sizes: int) -> DataFrame:
    """The k nearest training rows of every query: (query_id, rank, train_id, label, dist)."""
    one = F.lit(0).alias("part")
    found = nearest_by_part(queries.select(one, "*"), train.select(one, "*"), k, p, **sizes)
    return found.drop("part")


def vote(neighbours: DataFrame, keys: tuple[str, ...] = ("query_id",)) -> DataFrame:
    """Most frequent label per query; of equals the one with the closest row, then the smallest."""
    tally = neighbours.groupBy(*keys, "label").agg(F.count(F.lit(1)).alias("_n"), F.min("dist").alias("_d"))
    best = F.min(F.struct((-F.col("_n")).alias("n"), F.col("_d").alias("d"), F.col("label").alias("label")))
    return tally.groupBy(*keys).agg(best.alias("_b")).select(*keys, F.col("_b.label").alias("prediction"))


def vote_for_each_k(neighbours: DataFrame, most: int) -> DataFrame:
    """Predictions for k = 1..most from neighbours ranked once: rank r counts for every k >= r."""
    each = neighbours.withColumn("k", F.explode(F.sequence(F.col("rank"), F.lit(most))))
    return vote(each, ("k", "query_id"))
