"""Undirected weighted graphs as edge tables: degrees, clustering, exposure and spreading.

Edges are (a, b, w) with a < b; arcs are the same edges in both directions (src, dst, w).
"""

from __future__ import annotations

import math
import re
from collections.abc import Container, Iterable, Iterator
from itertools import batched, combinations
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tallgrass.plans.lineage import cut_lineage
from tallgrass.session import new_folder

#: Edges that one task of the triangle count takes, about.
TASK_EDGES = 1 << 22
#: Pairs of arcs that are looked up at a time.
WEDGES = 1 << 18
#: Sets of colours that one job counts, at least.
JOB_SETS = 64


def default_weight(edges: DataFrame) -> DataFrame:
    """A two-column edge table gets weight 1; a third column is taken as the weight."""
    if len(edges.columns) not in (2, 3):
        raise ValueError("an edge table has two or three columns")
    src, dst = edges.columns[:2]
    weight = F.col(edges.columns[2]) if len(edges.columns) == 3 else F.lit(1)
    return edges.select(F.col(src).alias("src"), F.col(dst).alias("dst"), weight.alias("w"))


def build(raw: DataFrame, position: Column | str = "pos") -> DataFrame:
    """Simple undirected edges from (src, dst, w) rows.

    Repeated pairs collapse to the row with the greatest ``position``; self-loops are dropped.
    """
    pair = [F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")]
    return raw.where(F.col("src") != F.col("dst")).groupBy(*pair).agg(F.max_by("w", position).alias("w"))


def mirror(edges: DataFrame) -> DataFrame:
    """Both directions of every edge, exploded from one row so the edges are read once."""
    forward = F.struct(F.col("a").alias("src"), F.col("b").alias("dst"))
    backward = F.struct(F.col("b").alias("src"), F.col("a").alias("dst"))
    return edges.select(F.explode(F.array(forward, backward)).alias("_arc"), "w").select("_arc.src", "_arc.dst", "w")


def degrees(edges: DataFrame) -> DataFrame:
    """Degree per node; each edge is exploded to its two ends, so the edges are read once."""
    return edges.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("degree"))


def degree_histogram(node_degrees: DataFrame) -> DataFrame:
    return node_degrees.groupBy("degree").agg(F.count(F.lit(1)).alias("n_nodes"))


def top_degree(node_degrees: DataFrame, k: int = 50) -> DataFrame:
    return node_degrees.orderBy(F.desc("degree"), "id").limit(k)


def _distinct(nodes: np.ndarray) -> np.ndarray:
    """The different ones in order, by sorting a copy: np.unique hashes numbers, which takes longer."""
    nodes = np.sort(nodes)
    return nodes[np.append(True, nodes[1:] != nodes[:-1])]


def _count_triple(table: pa.Table) -> pa.Table:
    """Triangles among the edges of one triple of colours whose corners have just these colours.

    Besides the table it holds about 30 bytes an edge: what is done with goes at once (the table too, if
    the caller keeps none), numbers of nodes take 4 bytes, and the batches of the table, one a block, are
    numbered one after the other.
    """
    one_colour, n_edges = table.column("one_colour")[0].as_py(), len(table)
    parts = [tuple(batch.column(c).to_numpy() for c in ("a", "b", "both")) for batch in table.to_batches()]
    del table
    names = _distinct(np.concatenate([_distinct(nodes) for a, b, _ in parts for nodes in (a, b)]))
    count = len(names)
    ends = np.empty((2, n_edges), np.int32)
    colour, degree = np.zeros(count, np.uint16), np.zeros(count, np.int64)
    start, several = 0, False
    while parts:
        a, b, both = parts.pop()
        for end, nodes, shift in ((ends[0], a, 16), (ends[1], b, 0)):
            numbers = end[start : start + len(nodes)]
            numbers[:] = np.searchsorted(names, nodes)
            colour[numbers] = (both >> shift) & 0xFFFF
            degree += np.bincount(numbers, minlength=count)
        start += len(a)
        # a triangle of one colour belongs to the triple that has only this colour
        several |= not one_colour and bool(((both >> 16) == (both & 0xFFFF)).any())
    del names, numbers, nodes, a, b, both
    # from low to high degree: no node keeps more than sqrt(2 x edges) outgoing arcs
    place = np.empty(count, np.int32)
    place[np.argsort(degree, kind="stable")] = np.arange(count, dtype=np.int32)
    shade = np.empty_like(colour)
    shade[place] = colour
    for end in ends:
        end[:] = place[end]
    del degree, colour, place
    arcs = np.minimum(*ends, dtype=np.int64)
    arcs *= count
    arcs += np.maximum(*ends)
    del end, ends
    arcs.sort()
    low, high = (arcs // count).astype(np.int32), (arcs % count).astype(np.int32)
    first = np.searchsorted(low, np.arange(count + 1, dtype=np.int32)).astype(np.int32)
    # arcs i < j of one source are a wedge; it is closed if an arc joins their ends
    behind = first[low + 1]
    behind -= np.arange(1, len(low) + 1, dtype=np.int32)
    # no arc starts where arc i ends: none of its wedges is closed
    behind[first[high] == first[high + 1]] = 0
    del first
    found = 0
    steps = np.zeros(len(low) + 1, np.int64)
    np.cumsum(behind, out=steps[1:])
    at = 0
    while at < len(low):
        # at least one arc, else as many as give WEDGES wedges
        end = max(at + 1, int(np.searchsorted(steps, steps[at] + WEDGES, side="right")) - 1)
        n = behind[at:end]
        i = np.repeat(np.arange(at, end), n)
        j = i + 1 + np.arange(len(i)) - np.repeat(steps[at:end] - steps[at], n)
        wanted = high[i].astype(np.int64) * count + high[j]
        if several:
            x, y, z = shade[low[i]], shade[high[i]], shade[high[j]]
            wanted = wanted[(x != y) | (y != z)]
        # in order the lookups stay in the cache
        wanted.sort()
        spot = np.minimum(np.searchsorted(arcs, wanted), len(arcs) - 1)
        found += int((arcs[spot] == wanted).sum())
        at = end
    return pa.table({"found": pa.array([found], pa.int64())})


def colours_for(n_edges: int, task_edges: int = TASK_EDGES) -> int:
    """So many colours that a triple of them gets about ``task_edges`` edges, four at least.

    A triple holds three of the colours x (colours + 1) / 2 kinds of edges.
    """
    return max(4, math.ceil(math.sqrt(6 * n_edges / task_edges)))


def _blocks(edges: DataFrame, colours: int) -> dict[int, list[str]]:
    """The edges written once, one folder for the edges between two colours: its files, by number.

    The number has the lower colour, which is that of ``a``, and 16 bits below it the other one.
    """

    def colour(node: str) -> Column:
        return F.pmod(F.xxhash64(node), F.lit(colours)).cast("int")

    turned = F.col("x") > F.col("y")
    dealt = edges.withColumns({"x": colour("a"), "y": colour("b")}).select(
        F.when(turned, F.col("b")).otherwise(F.col("a")).alias("a"),
        F.when(turned, F.col("a")).otherwise(F.col("b")).alias("b"),
        F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"),
    )
    # a task for each block
    place = (F.expr("y * (y + 1) div 2") + F.col("x")).cast("int")
    blocks = dealt.repartitionById(colours * (colours + 1) // 2, place).select(
        "a", "b", F.shiftleft("x", 16).bitwiseOR(F.col("y")).alias("both")
    )
    path = new_folder(edges.sparkSession, "blocks")
    blocks.sortWithinPartitions("both", "a", "b").write.partitionBy("both").parquet(path)
    files: dict[int, list[str]] = {}
    for file in map(unquote, edges.sparkSession.read.schema(blocks.schema).parquet(path).inputFiles()):
        files.setdefault(_number(file), []).append(file)
    return files


def _number(file: str) -> int:
    return int(re.search(r"/both=(\d+)/[^/]*$", file)[1])


def _read_set(files: Iterable[tuple[str, bytes]], one_colour: bool) -> pa.Table:
    """The edges in the files of one set of colours, as ``_count_triple`` takes them."""
    tables = []
    for file, content in files:
        rows = pq.ParquetFile(pa.BufferReader(content)).read(["a", "b"], use_threads=False)
        rows = rows.append_column("both", pa.array(np.full(len(rows), _number(file), np.int32)))
        tables.append(rows.append_column("one_colour", pa.repeat(one_colour, len(rows))))
    # what the reader is done with
    pa.default_memory_pool().release_unused()
    return pa.concat_tables(tables)


def _sets(colours: int, filled: Container[int]) -> Iterator[tuple[list[int], bool]]:
    """Blocks that hold all triangles of one set of one, two or three colours, and if it is of one.

    Sets that can have none, by the blocks that are filled, are left out.
    """

    def between(*pairs: tuple[int, int]) -> list[int]:
        return [x << 16 | y for x, y in pairs if x << 16 | y in filled]

    for x in range(colours):
        if own := between((x, x)):
            yield own, True
    for x, y in combinations(range(colours), 2):
        if (own := between((x, x), (y, y))) and (side := between((x, y))):
            yield own + side, False
    for three in combinations(range(colours), 3):
        if len(sides := between(*combinations(three, 2))) == 3:
            yield sides, False


def _count_blocks(spark: SparkSession, files: dict[int, list[str]], colours: int) -> int:
    """Triangles by set of colours: a task reads the blocks of its set as they lie, nothing is shuffled or written."""
    sc = spark.sparkContext
    blocks = {number: sc.binaryFiles(",".join(paths), 1) for number, paths in files.items()}
    found = 0
    for sets in batched(_sets(colours, files), max(JOB_SETS, 2 * sc.defaultParallelism)):
        # one partition for each set
        parts = sc.union([sc.union([blocks[number] for number in numbers]).coalesce(1) for numbers, _ in sets])
        alone = [one_colour for _, one_colour in sets]
        counts = parts.mapPartitionsWithIndex(lambda i, rows, alone=alone: _count_triple(_read_set(rows, alone[i]))["found"].to_pylist())
        found += sum(counts.collect())
    return found


def _with_hubs(edges: DataFrame, hubs: DataFrame) -> DataFrame:
    """For each edge between nodes with hubs behind them, how many hubs they share: its triangles with a hub.

    Hubs (id, degree) stand last in the order of (degree, id).  A node keeps the hubs behind itself
    as bits, so an edge is shuffled with 8 bytes for 64 hubs, not with a list.
    """
    placed = hubs.select("id", (F.row_number().over(Window.orderBy("degree", "id")) - 1).alias("place"))
    placed = F.broadcast(cut_lineage(placed))
    own = placed.select(F.col("id").alias("node"), F.col("place").alias("_own"))
    toward = mirror(edges.withColumn("w", F.lit(1))).select(F.col("src").alias("node"), F.col("dst").alias("id"))
    later = (
        toward.join(placed, "id").join(F.broadcast(own), "node", "left")
        .where(F.col("_own").isNull() | (F.col("_own") < F.col("place")))
    )
    words = range(math.ceil(hubs.count() / 64))
    masks = cut_lineage(later.groupBy("node").agg(*(
        F.expr(f"bit_or(if(place div 64 = {k}, shiftleft(1L, cast(place % 64 as int)), 0L))").alias(f"m{k}") for k in words
    )))
    left = masks.select(F.col("node").alias("a"), *(F.col(f"m{k}").alias(f"l{k}") for k in words))
    right = masks.select(F.col("node").alias("b"), *(F.col(f"m{k}").alias(f"r{k}") for k in words))
    shared = sum((F.bit_count(F.col(f"l{k}").bitwiseAND(F.col(f"r{k}"))) for k in words), F.lit(0).cast("long"))
    return edges.join(left, "a").join(right, "b").select(shared.alias("found"))


def triangles(edges: DataFrame, node_degrees: DataFrame, task_edges: int = TASK_EDGES) -> DataFrame:
    """Number of triangles, as one row.

    Nodes get one of c colours by hash.  The edges between two colours are written once, as a
    block, and each set of up to three colours is counted in one task, from its blocks: an edge is
    shuffled and written once and read c times, ids only, however skewed the degrees are.

    A node with more than edges / c neighbours would fill its blocks, so such hubs (2 c at
    most) are taken out first.  Every node keeps the hubs behind it; the triangles with a hub are
    the common later hubs of the two ends of an edge.  Both counts are exact.
    """
    n_edges = edges.count()
    colours = colours_for(n_edges, task_edges)
    # the degrees add up to 2 x edges: fewer than 2 x colours nodes can lie above this bound
    hubs = cut_lineage(node_degrees.where(F.col("degree") > n_edges / colours).select("id", "degree"))
    plain = light = edges.select("a", "b")
    some_hubs = not hubs.isEmpty()
    if some_hubs:
        for end in ("a", "b"):
            light = light.join(F.broadcast(hubs), F.col(end) == F.col("id"), "left_anti")
    found = F.lit(_count_blocks(edges.sparkSession, _blocks(light, colours), colours)).cast("long")
    if not some_hubs:
        return edges.sparkSession.range(1).select(found.alias("triangles"))
    return _with_hubs(plain, hubs).agg((found + F.coalesce(F.sum("found"), F.lit(0))).cast("long").alias("triangles"))


def clustering(edges: DataFrame) -> DataFrame:
    """Closed triples over connected triples of the whole graph; NULL if no triple is connected."""
    edges = cut_lineage(edges.select("a", "b"))
    node_degrees = cut_lineage(degrees(edges))
    triples = node_degrees.select(
        F.lit(0).cast("long").alias("triangles"), (F.col("degree") * (F.col("degree") - 1)).alias("connected_triples")
    )
    found = triangles(edges, node_degrees).select("triangles", F.lit(0).cast("long").alias("connected_triples"))
    both = triples.unionByName(found).agg(
        F.sum("triangles").alias("triangles"), F.sum("connected_triples").alias("connected_triples")
    )
    ratio = F.try_divide((6 * F.col("triangles")).cast("double"), F.col("connected_triples").cast("double"))
    return both.select("triangles", "connected_triples", ratio.alias("coefficient"))


def concern(edges: DataFrame, infected: DataFrame, removed: DataFrame | None = None, removed_weight: int = 3) -> DataFrame:
    """Share of each node's neighbours that are infected, with removed ones counted
    ``removed_weight`` times and the sum capped at 1; infected nodes get 0.

    Marks are looked up once per arc source, counts are combined before the shuffle.
    """
    marks = infected.select("id", F.lit(1).alias("_mark"))
    if removed is not None:
        marks = marks.unionByName(removed.select("id", F.lit(removed_weight).alias("_mark")))
    marks = marks.groupBy("id").agg(F.max("_mark").alias("_mark"))
    seen = (
        mirror(edges)
        .join(marks.withColumnRenamed("id", "src"), "src", "left")
        .groupBy(F.col("dst").alias("id"))
        .agg(F.sum(F.coalesce("_mark", F.lit(0))).alias("_sum"), F.count(F.lit(1)).alias("_degree"))
    )
    share = F.least(F.col("_sum") / F.col("_degree"), F.lit(1.0))
    own = marks.where("_mark = 1").select("id", F.lit(True).alias("_infected"))
    level = F.when(F.col("_infected"), F.lit(0.0)).otherwise(share)
    return seen.join(own, "id", "left").select("id", level.alias("concern"))


def frontier_exposure(edges: DataFrame, frontier: DataFrame, susceptible: DataFrame, concerns: DataFrame, contagion: float) -> DataFrame:
    """Probability that a susceptible node is reached by at least one frontier neighbour.

    1 - product(1 - min(1, contagion * w * (1 - concern))) over the frontier neighbours.
    """
    reach = (
        mirror(edges)
        .join(frontier.select(F.col("id").alias("src")), "src", "left_semi")
        .select(F.col("dst").alias("id"), "w")
        .join(susceptible.select("id"), "id", "left_semi")
        .join(concerns, "id", "left")
    )
    p = F.least(F.lit(1.0), F.lit(contagion) * F.col("w") * (1 - F.coalesce("concern", F.lit(0.0))))
    certain = F.max(F.when(p >= 1, 1).otherwise(0)) == 1
    missed = F.exp(F.sum(F.when(p < 1, F.log1p(-p))))
    return reach.groupBy("id").agg(F.when(certain, F.lit(1.0)).otherwise(1 - missed).alias("exposure"))


def threshold_spread(edges: DataFrame, seeds: DataFrame, contagion: float, rounds: int) -> DataFrame:
    """Nodes infected after ``rounds`` synchronous rounds: (id, round), seeds in round 0.

    A node joins when contagion x (weight to infected neighbours) >= 1 + its concern, the
    concern coming from the infected set at the start of the round before.  Weights and counts
    of infected neighbours are kept per node and grow by the arcs of the newly infected
    only, so each arc is used once over all rounds.
    """
    if rounds < 0:
        raise ValueError("rounds must not be negative")
    arcs = cut_lineage(mirror(edges))
    new = seeds.select("id").distinct()
    seed_marks = new.select("id", F.lit(0).alias("round"))
    state = cut_lineage(
        arcs.groupBy(F.col("src").alias("id"))
        .agg(F.count(F.lit(1)).alias("degree"))
        .join(seed_marks, "id", "full")
        .select(
            "id", "degree", "round",
            F.lit(0.0).alias("weight"), F.lit(0).cast("long").alias("n_infected"), F.lit(0.0).alias("concern"),
        )
    )
    for step in range(1, rounds + 1):
        gained = (
            arcs.join(state.where(F.col("round") == step - 1).select(F.col("id").alias("src")), "src", "left_semi")
            .groupBy(F.col("dst").alias("id"))
            .agg(F.sum("w").alias("_dw"), F.count(F.lit(1)).alias("_dn"))
        )
        weight = F.col("weight") + F.coalesce("_dw", F.lit(0.0))
        count = F.col("n_infected") + F.coalesce("_dn", F.lit(0))
        # rounded, as the order of summation must not decide a tie
        joins = F.col("round").isNull() & (F.round(F.lit(contagion) * weight, 9) >= F.round(1 + F.col("concern"), 9))
        state = cut_lineage(
            state.join(gained, "id", "left").select(
                "id", "degree",
                F.when(joins, F.lit(step)).otherwise(F.col("round")).alias("round"),
                weight.alias("weight"), count.alias("n_infected"), (count / F.col("degree")).alias("concern"),
            )
        )
        # concern never falls, so once nobody joins nobody will
        if state.where(F.col("round") == step).isEmpty():
            break
    return state.where(F.col("round").isNotNull()).select("id", "round")
