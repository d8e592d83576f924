"""Exact top-k inner products with M-trees: paged metric nodes, covering radii, parent distances.

The vectors are dealt to the nearest of a bounded number of pivots; a pivot with many vectors is
dealt over several subtrees, so each subtree is built in one task.  A subtree is a root over
leaf pages; each page stores its centre, its covering radius and its distance to the root's
centre, and each vector its distance to its page's centre.

For a query q and any x within distance r of c, the inner product q.x is at most q.c + |q| r.  A
query first searches the subtree of the highest bound, which gives it a score to beat, and then
only those subtrees that can beat it.  Inside, pages come best bound first; a page whose bound by
the stored distance to its parent is too low is not even compared with its centre, and a vector
whose bound by its stored distance is too low is not multiplied.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallgrass.plans.lineage import cut_lineage

#: Rows of a subtree and pivots: at most MAX_PIVOTS pivots, then subtrees grow.
SUBTREE_ROWS, MAX_PIVOTS = 4096, 4096
#: Rows of a leaf page, and queries that are searched together.
PAGE_ROWS, QUERY_BLOCK = 128, 8192
#: Above this, sums of products might not be exact as doubles.
_EXACT = float(1 << 52)


def scaled(vector: Column, factor: int = 256) -> Column:
    """floor(factor * x) of each component as a double; null if the vector or a component is null or not finite."""
    number = vector.cast("array<double>")
    odd = F.exists(number, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~odd, F.transform(number, lambda x: F.floor(x * factor)))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    out = np.zeros((len(column), dims), np.int64)
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    if (lengths == dims).all():
        return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)
    for k, values in enumerate(lists.to_pylist()):
        out[k, :len(values)] = values
    return out


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances, rounded up a little so that bounds hold."""
    a, b = a.astype(float), b.astype(float)
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T
    size = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :]
    return np.sqrt(np.maximum(square, 0) + 1e-9 * size) + 1e-6


def _products(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact inner products, as 64-bit integers (modulo 2 ** 64)."""
    if float(abs(rows).max(initial=0)) * float(abs(query).max(initial=0)) * max(1, len(query)) < _EXACT:
        return np.rint(rows.astype(float) @ query.astype(float)).astype(np.int64)
    return rows @ query


def build_pages(ids: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, float, list[tuple]]:
    """Centre and radius of a subtree and its pages: (centre, radius, distance to the root, ids, rows, distances)."""
    root = rows.astype(float).mean(axis=0)
    parts = max(1, len(rows) // PAGE_ROWS)
    # pivots at equal steps of the ids: any choice is right, this one needs no random numbers
    order = np.argsort(ids, kind="stable")
    pivots = rows[order[np.linspace(0, len(rows) - 1, parts).astype(int)]]
    nearest = _distances(rows, pivots).argmin(axis=1)
    pages = []
    for p in np.unique(nearest):
        members = np.nonzero(nearest == p)[0]
        for i in range(0, len(members), 4 * PAGE_ROWS):
            part = members[i:i + 4 * PAGE_ROWS]
            centre = rows[part].astype(float).mean(axis=0)
            far = _distances(rows[part], centre[None, :])[:, 0]
            down = np.argsort(-far, kind="stable")
            pages.append((centre, float(far.max()), float(_distances(centre[None, :], root[None, :])[0, 0]), ids[part[down]], rows[part[down]], far[down]))
    return root, max(p[1] + p[2] for p in pages), pages


class Subtree:
    """One subtree, ready to be searched."""

    def __init__(self, root: np.ndarray, pages: list[tuple]):
        self.root = root
        self.centres = np.array([p[0] for p in pages])
        self.radii = np.array([p[1] for p in pages])
        self.to_root = np.array([p[2] for p in pages])
        self.pages = [(p[3], p[4], p[5]) for p in pages]

    def search(self, query_id: int, query: np.ndarray, k: int, beat: float) -> list[tuple[int, int]]:
        """The k best (score, vec_id) of at least ``beat``, ties to smaller ids, without the query's own row."""
        length = float(np.sqrt((query.astype(float) ** 2).sum()))
        best: list[tuple[int, int]] = []  # heap, the worst on top: (score, -id)

        def slack(x):
            return x + 1e-9 * abs(x) + 1e-6

        # by the parent distance alone
        at_root = float(self.root @ query)
        open_pages = np.nonzero(slack(at_root + length * (self.to_root + self.radii)) >= beat)[0]
        centre = self.centres[open_pages] @ query.astype(float)
        bounds = slack(centre + length * self.radii[open_pages])
        for j in np.argsort(-bounds, kind="stable"):
            if bounds[j] < beat:
                break
            ids, rows, far = self.pages[open_pages[j]]
            # the distances fall: those from here on are too close to the centre to beat the score
            reach = len(far) if not length else int(np.searchsorted(-far, -(beat - 1e-6 - abs(beat) * 1e-9 - centre[j]) / length, side="right"))
            if not reach:
                continue
            scores = _products(rows[:reach], query)
            for i in np.nonzero((scores >= beat) & (ids[:reach] != query_id))[0]:
                entry = (int(scores[i]), -int(ids[i]))
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
            if len(best) == k:
                beat = max(beat, best[0][0])
        return [(score, -i) for score, i in best]


_PAGE = "tree long, root binary, radius double, centre binary, page_radius double, to_root double, ids binary, rows binary, far binary"


def build_index(vectors: DataFrame, dims: int, count: int) -> DataFrame:
    """Pages of all subtrees over ``vectors`` (vec_id, vector), written to the shared folder."""
    pivots = min(MAX_PIVOTS, -(-count // SUBTREE_ROWS))
    room = 2 * max(SUBTREE_ROWS, -(-count // MAX_PIVOTS))
    chosen = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(pivots).select("vector").toArrow()["vector"]
    centres = _matrix(chosen, dims)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 2048):
                part = batch.slice(i, 2048)
                pivot = _distances(_matrix(part.column("vector"), dims), centres).argmin(axis=1)
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), part.column("vector"), pa.array(pivot)], ["vec_id", "vector", "pivot"])

    placed = cut_lineage(vectors.mapInArrow(nearest, "vec_id long, vector array<bigint>, pivot long"))
    # one row per pivot: MAX_PIVOTS at most
    sizes = placed.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / room).alias("chunks"))
    dealt = placed.join(F.broadcast(sizes), "pivot").withColumn("chunk", F.pmod(F.xxhash64("vec_id"), "chunks"))
    dealt = dealt.withColumn("tree", F.shiftleft(F.col("pivot"), 32) + F.col("chunk")).select("tree", "vec_id", "vector")

    def build(key: tuple, table: pa.Table) -> pa.Table:
        ids = table["vec_id"].to_numpy()
        root, radius, pages = build_pages(ids, _matrix(table["vector"], dims))
        columns = [
            [key[0].as_py()] * len(pages), [root.tobytes()] * len(pages), [radius] * len(pages),
            [p[0].tobytes() for p in pages], [p[1] for p in pages], [p[2] for p in pages],
            [p[3].tobytes() for p in pages], [p[4].tobytes() for p in pages], [p[5].tobytes() for p in pages],
        ]
        kinds = [pa.int64(), pa.binary(), pa.float64(), pa.binary(), pa.float64(), pa.float64(), *[pa.binary()] * 3]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], [c.split()[0] for c in _PAGE.split(", ")])

    return cut_lineage(dealt.groupBy("tree").applyInArrow(build, _PAGE))


def _search(pages: DataFrame, wanted: DataFrame, blocks: int, k: int, dims: int) -> DataFrame:
    """Best rows of each (query_id, query, tree, beat) in that tree; queries meet a tree in blocks."""
    schema = "query_id long, vec_id long, score long"

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple] = []
        if len(left) and len(right):
            tree = Subtree(np.frombuffer(left["root"].iloc[0], float), [
                (np.frombuffer(c, float), r, t, np.frombuffer(i, np.int64), np.frombuffer(v, np.int64).reshape(-1, dims), np.frombuffer(f, float))
                for c, r, t, i, v, f in zip(left["centre"], left["page_radius"], left["to_root"], left["ids"], left["rows"], left["far"])
            ])
            for query_id, query, beat in zip(right["query_id"], right["query"], right["beat"]):
                found += [(query_id, i, s) for s, i in tree.search(query_id, np.frombuffer(query, np.int64), k, beat)]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype("int64")

    wanted = wanted.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)))
    spread = pages.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    return spread.groupBy("tree", "block").cogroup(wanted.groupBy("tree", "block")).applyInPandas(search, schema)


def top_products(
    vectors: DataFrame, is_query: Callable[[Column], Column], k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score: each query's k best rows by integer inner product.

    ``is_query`` says of the id column which rows are queries.
    Components are taken as floor(256 * x).  Vectors that are null, or hold a null or non-finite
    component, and rows with a null id take no part; shorter vectors count as ending in zeros.
    Ties go to the smaller vec_id; with fewer than k other rows all are returned.  A query leaves
    out all rows of its own id.  Repeated rows are rows of their own among the candidates, and one
    query.  Other columns are not read; without queries there are no rows.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), scaled(F.col(vector_col)).alias("vector"))
    rows = cut_lineage(rows.where("vector is not null and vec_id is not null"))
    count, dims = rows.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    schema = "query_id long, rank int, vec_id long, score long"
    if not count:
        return vectors.sparkSession.createDataFrame([], schema)
    dims = max(1, dims)
    pages = build_index(rows, dims, count)
    # a root and a radius for each subtree: 3 * MAX_PIVOTS of them at most
    trees = pages.select("tree", "root", "radius").distinct().toPandas()
    roots = np.array([np.frombuffer(r, float) for r in trees["root"]])
    radii, names = trees["radius"].to_numpy(), trees["tree"].to_numpy()
    queries = rows.where(is_query(F.col("vec_id"))).dropDuplicates(["vec_id"])
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))

    def bounds(queries: np.ndarray) -> np.ndarray:
        length = np.sqrt((queries.astype(float) ** 2).sum(axis=1))
        bound = queries.astype(float) @ roots.T + length[:, None] * radii
        return bound + 1e-9 * abs(bound) + 1e-6

    def visits(first: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                step = max(1, 65_536 // len(names))
                for i in range(0, batch.num_rows, step):
                    part = batch.slice(i, step)
                    matrix = _matrix(part.column("vector"), dims)
                    bound = bounds(matrix)
                    best = bound.argmax(axis=1)
                    if first:
                        at, tree, beat = np.arange(len(matrix)), best, np.full(len(matrix), -np.inf)
                    else:
                        beats = np.array(part.column("beat").to_numpy(zero_copy_only=False), float)
                        bound[np.arange(len(matrix)), best] = -np.inf  # searched before
                        at, tree = np.nonzero(bound >= beats[:, None])
                        keep = tree != best[at]
                        at, tree = at[keep], tree[keep]
                        beat = beats[at]
                    raw = [matrix[j].tobytes() for j in range(len(matrix))]
                    yield pa.RecordBatch.from_arrays(
                        [part.column("vec_id").take(pa.array(at)), pa.array([raw[j] for j in at], pa.binary()), pa.array(names[tree]), pa.array(beat)],
                        ["query_id", "query", "tree", "beat"],
                    )

        return run

    visit = "query_id long, query binary, tree long, beat double"
    found = cut_lineage(_search(pages, queries.mapInArrow(visits(True), visit), blocks, k, dims))
    # the k-th best score so far is the one to beat; with fewer than k, anything does
    kth = found.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("kth"))
    again = queries.join(kth, queries["vec_id"] == kth["query_id"], "left").select(
        "vec_id", "vector", F.coalesce(F.col("kth").cast("double"), F.lit(float("-inf"))).alias("beat")
    )
    more = _search(pages, again.mapInArrow(visits(False), visit), blocks, k, dims)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.union(more).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
