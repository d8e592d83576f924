from __future__ import annotations

import os
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallgrass.operators import graph as gr

RAW = "src long, dst long, w double, pos int"


def build(spark, edges):
    return gr.build(spark.createDataFrame([(a, b, w, i) for i, (a, b, w) in enumerate(edges)], RAW))


def ids(spark, values):
    return spark.createDataFrame([(v,) for v in values], "id long")


# a triangle 1-2-3 with a tail 3-4, a self-loop, and the pair 1-2 given twice
TAILED = [(1, 2, 0.5), (2, 3, 1.0), (3, 1, 1.0), (3, 4, 1.0), (4, 4, 1.0), (2, 1, 0.7)]


def test_build_keeps_the_last_weight_and_drops_loops(spark):
    edges = build(spark, TAILED)
    assert rows(edges) == [(1, 2, 0.7), (1, 3, 1.0), (2, 3, 1.0), (3, 4, 1.0)]
    assert gr.mirror(edges).count() == 8


def test_degrees_and_histogram(spark):
    degrees = gr.degrees(build(spark, TAILED))
    assert rows(degrees) == [(1, 2), (2, 2), (3, 3), (4, 1)]
    assert rows(gr.degree_histogram(degrees)) == [(1, 1), (2, 2), (3, 1)]
    assert [r["id"] for r in gr.top_degree(degrees, 2).collect()] == [3, 1]


def test_clustering_of_a_triangle_with_a_tail(spark):
    # trace(A^3) = 6, ordered pairs of edges at a node: 2 + 2 + 6 + 0
    assert tuple(gr.clustering(build(spark, TAILED)).first()) == (1, 10, 0.6)


def test_clustering_without_connected_triples_is_null(spark):
    assert tuple(gr.clustering(build(spark, [(1, 2, 1.0), (3, 4, 1.0)])).first()) == (0, 0, None)


def test_clustering_with_a_hub(spark):
    rng = random.Random(3)
    pairs = {(0, i) for i in range(1, 60)} | {tuple(sorted(rng.sample(range(1, 60), 2))) for _ in range(150)}
    near = {}
    for a, b in pairs:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    triangles = sum(len(near[a] & near[b]) for a, b in pairs) // 3
    got = gr.clustering(build(spark, [(a, b, 1.0) for a, b in pairs])).first()
    assert got["triangles"] == triangles
    assert got["connected_triples"] == sum(len(n) * (len(n) - 1) for n in near.values())


def test_default_weight(spark):
    assert rows(gr.default_weight(spark.createDataFrame([(1, 2)], "x long, y long"))) == [(1, 2, 1)]
    assert rows(gr.default_weight(spark.createDataFrame([(1, 2, 0.3)], "x long, y long, z double"))) == [(1, 2, 0.3)]
    with pytest.raises(ValueError):
        gr.default_weight(spark.createDataFrame([(1,)], "x long"))


def test_concern_and_its_weighted_form(spark):
    edges = build(spark, TAILED)
    assert rows(gr.concern(edges, ids(spark, [1]))) == [(1, 0.0), (2, 0.5), (3, 1 / 3), (4, 0.0)]
    # node 3 has one infected and one removed neighbour of three: (1 + 3) / 3, capped
    assert dict(rows(gr.concern(edges, ids(spark, [1]), ids(spark, [4]))))[3] == 1.0


def spread(edges, seeds, contagion, rounds):
    near = {}
    for a, b, w in edges:
        near.setdefault(a, {})[b] = w
        near.setdefault(b, {})[a] = w
    infected, level = {s: 0 for s in seeds}, dict.fromkeys(near, 0.0)
    for step in range(1, rounds + 1):
        start = dict(infected)
        for n in near:
            if n not in start and round(contagion * sum(w for m, w in near[n].items() if m in start), 9) >= round(1 + level[n], 9):
                infected[n] = step
        for n in near:
            if n not in start:
                level[n] = sum(m in start for m in near[n]) / len(near[n])
    return sorted(infected.items())


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_threshold_spread_equals_the_plain_loop(spark, seed):
    rng = random.Random(seed)
    pairs = {tuple(sorted(rng.sample(range(40), 2))) for _ in range(140)}
    edges = [(a, b, rng.choice([0.2, 0.5, 1.0])) for a, b in pairs]
    seeds = [0, 1, 2, 3, 99]  # 99 is not in the graph
    got = rows(gr.threshold_spread(build(spark, edges), ids(spark, seeds), 0.8, 6))
    assert sorted(got) == spread(edges, seeds, 0.8, 6)


def test_spread_of_no_rounds_is_the_seed_set(spark):
    assert rows(gr.threshold_spread(build(spark, TAILED), ids(spark, [4]), 1.0, 0)) == [(4, 0)]
    with pytest.raises(ValueError):
        gr.threshold_spread(build(spark, TAILED), ids(spark, [4]), 1.0, -1)


def test_exposure(spark):
    edges = build(spark, [(1, 3, 0.5), (2, 3, 0.25), (1, 4, 3.0)])
    concerns = spark.createDataFrame([(3, 0.2), (4, 0.0)], "id long, concern double")
    got = dict(rows(gr.frontier_exposure(edges, ids(spark, [1, 2]), ids(spark, [3, 4]), concerns, 1.0)))
    assert got[4] == 1.0
    assert got[3] == pytest.approx(1 - (1 - 0.5 * 0.8) * (1 - 0.25 * 0.8))


@pytest.mark.parametrize("task_edges", [3, 40, 1 << 20])
@pytest.mark.parametrize("hubs", [0, 1, 3])
def test_triangles_by_colours_equal_brute_force(spark, task_edges, hubs):
    rng = random.Random(hubs)
    pairs = {tuple(sorted(rng.sample(range(60), 2))) for _ in range(250)}
    # hubs know everybody and each other
    pairs |= {(n, 100 + h) for n in range(60) for h in range(hubs)} | {(100 + g, 100 + h) for g in range(hubs) for h in range(g + 1, hubs)}
    near = {}
    for a, b in pairs:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    want = sum(len(near[a] & near[b]) for a, b in pairs) // 3
    edges = build(spark, [(a, b, 1.0) for a, b in pairs])
    assert gr.triangles(edges, gr.degrees(edges), task_edges).first()[0] == want


def test_wedges_are_looked_up_in_slices(spark, monkeypatch):
    monkeypatch.setattr(gr, "WEDGES", 3)
    edges = build(spark, [(a, b, 1.0) for a in range(9) for b in range(a + 1, 9)])
    table = edges.select(gr.F.lit(0).alias("triple"), "a", "b", gr.F.lit(0).cast("long").alias("both"), gr.F.lit(True).alias("one_colour")).toArrow()
    assert gr._count_triple(table)["found"].to_pylist() == [84]


def test_an_edge_goes_to_as_many_triples_as_there_are_colours(spark):
    edges = build(spark, [(a, b, 1.0) for a in range(30) for b in range(a + 1, 30)])
    plan = gr.triangles(edges, gr.degrees(edges), 30)
    assert gr.colours_for(435, 30) == 10 and plan.first()[0] == 30 * 29 * 28 // 6
    assert gr.colours_for(0) == 4


def test_count_of_a_triple_holds_few_bytes_an_edge():
    rng = np.random.default_rng(6)
    codes = np.unique(rng.integers(0, 20_000, 300_000) * 20_000 + rng.integers(0, 20_000, 300_000))
    a, b = codes // 20_000, codes % 20_000
    a, b = a[a < b], b[a < b]
    table = pa.table({"triple": np.zeros(len(a), np.int64), "a": a, "b": b, "both": np.zeros(len(a), np.int32), "one_colour": np.ones(len(a), bool)})
    near = {}
    for x, y in zip(a.tolist(), b.tolist()):
        near.setdefault(x, set()).add(y)
    want = sum(len(near[x] & near.get(y, set())) for x, y in zip(a.tolist(), b.tolist()))
    tracemalloc.start()
    got = gr._count_triple(table)["found"].to_pylist()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got == [want]
    # most of it are the wedges of one step, however many edges there are
    assert peak < 24 << 20


def shuffle_files(spark):
    """Sizes of the shuffle files on the local disks, by path."""
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    paths = [os.path.join(at, name) for d in dirs for at, _, names in os.walk(d.getPath()) for name in names]
    return {path: os.path.getsize(path) for path in paths if path.endswith(".data")}


def test_an_edge_is_shuffled_once_however_many_colours(spark):
    rng = random.Random(8)
    pairs = {tuple(sorted(rng.sample(range(1500), 2))) for _ in range(40_000)}
    near = {}
    for a, b in pairs:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    want = sum(len(near[a] & near[b]) for a, b in pairs) // 3
    edges = gr.cut_lineage(build(spark, [(a, b, 1.0) for a, b in pairs]))
    node_degrees = gr.cut_lineage(gr.degrees(edges))
    task_edges = 6 * len(pairs) // 144
    assert gr.colours_for(len(pairs), task_edges) in (12, 13)
    before = shuffle_files(spark)
    assert gr.triangles(edges, node_degrees, task_edges).first()[0] == want
    assert sum(size for path, size in shuffle_files(spark).items() if path not in before) < 40 * len(pairs)


def test_triangles_of_more_hubs_than_a_word_has_bits(spark):
    # every node has more neighbours than edges / colours: no edge is left for the blocks
    edges = build(spark, [(a, b, 1.0) for a in range(80) for b in range(a + 1, 80)])
    assert gr.colours_for(3160, 11) == 42
    assert gr.triangles(edges, gr.degrees(edges), 11).first()[0] == 80 * 79 * 78 // 6


def test_triangles_of_no_edges(spark):
    edges = build(spark, [(1, 1, 1.0)])
    assert gr.triangles(edges, gr.degrees(edges)).first()[0] == 0
