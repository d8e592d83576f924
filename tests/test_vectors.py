from __future__ import annotations

import math
import tracemalloc

import numpy as np
import pytest
from conftest import rows
from hypothesis import given, settings, strategies as st

from tallgrass.functions import vectors as vec
from tallgrass.operators import clusters as cl
from tallgrass.operators import neighbours as nb


def frame(spark, x, key, labels=None):
    data = [(i, v.tolist(), *([int(labels[i])] if labels is not None else [])) for i, v in enumerate(x)]
    return spark.createDataFrame(data, f"{key} long, features array<double>" + (", label int" if labels is not None else ""))


def brute(queries, train, labels, k, p):
    out = []
    for q, x in enumerate(queries):
        d = (np.abs(train - x) ** p).sum(axis=1) ** (1 / p)
        order = sorted(range(len(train)), key=lambda i: (d[i], labels[i], i))[:k]
        out += [(q, r, i, labels[i]) for r, i in enumerate(order, 1)]
    return out


@pytest.mark.parametrize("p", [0.5, 1.0, 2.0, 3.0])
@pytest.mark.parametrize("rows_per_block", [7, 4096])
def test_nearest_equals_brute_force(spark, p, rows_per_block):
    rng = np.random.default_rng(int(p * 10))
    # whole numbers make ties frequent; a third of the rows are copies of one vector
    train = rng.integers(0, 4, (90, 3)).astype(float)
    train[:30] = [1.0, 1.0, 1.0]
    labels = rng.integers(0, 3, 90).tolist()
    queries = np.vstack([rng.integers(0, 4, (40, 3)).astype(float), np.ones((20, 3))])
    found = nb.nearest(
        frame(spark, queries, "query_id"), frame(spark, train, "train_id", labels), 5, p, rows_per_block=rows_per_block, max_pivots=6
    )
    got = sorted((r["query_id"], r["rank"], r["train_id"], r["label"]) for r in found.collect())
    assert got == brute(queries, train, labels, 5, p)


def test_nearest_with_fewer_rows_than_k(spark):
    train = frame(spark, np.eye(3), "train_id", [0, 1, 2])
    assert nb.nearest(frame(spark, np.eye(3)[:1], "query_id"), train, 10).count() == 3


def test_nearest_without_queries_is_empty(spark):
    train = frame(spark, np.eye(3), "train_id", [0, 1, 2])
    none = frame(spark, np.eye(3), "query_id").where("query_id < 0")
    assert nb.nearest(none, train, 2).count() == 0


def test_nearest_within_parts(spark):
    q = spark.createDataFrame([(1, 0, [0.0]), (2, 0, [0.0])], "part int, query_id long, features array<double>")
    t = spark.createDataFrame([(1, 5, [9.0], 0), (2, 6, [1.0], 1), (2, 7, [2.0], 1)], "part int, train_id long, features array<double>, label int")
    got = sorted((r["part"], r["train_id"]) for r in nb.nearest_by_part(q, t, 1).collect())
    assert got == [(1, 5), (2, 6)]


def test_one_neighbour_has_no_training_error(spark):
    x = np.random.default_rng(0).normal(size=(50, 2))
    labels = (x[:, 0] > 0).astype(int)
    votes = nb.vote(nb.nearest(frame(spark, x, "query_id"), frame(spark, x, "train_id", labels), 1))
    assert [r["prediction"] for r in votes.orderBy("query_id").collect()] == labels.tolist()


def test_vote_ties_go_to_the_closest_winner_then_the_smallest_label(spark):
    found = spark.createDataFrame(
        # query 0: label 9 is nearest but has one vote; 2 and 1 have two each, 2 is closer
        [(0, 1, 9, 0.1), (0, 2, 2, 0.2), (0, 3, 1, 0.3), (0, 4, 1, 0.4), (0, 5, 2, 0.5)]
        # query 1: 4 and 3 tie in votes and distance
        + [(1, 1, 4, 0.2), (1, 2, 3, 0.2)],
        "query_id long, rank int, label int, dist double",
    )
    assert rows(nb.vote(found)) == [(0, 2), (1, 3)]
    sweep = {(r["k"], r["query_id"]): r["prediction"] for r in nb.vote_for_each_k(found.where("query_id = 0"), 5).collect()}
    assert [sweep[k, 0] for k in range(1, 6)] == [9, 9, 9, 1, 2]


def test_bad_arguments(spark):
    x = frame(spark, np.eye(2), "query_id")
    t = frame(spark, np.eye(2), "train_id", [0, 1])
    for k, p in ((0, 2.0), (1, 0.0)):
        with pytest.raises(ValueError):
            nb.nearest(x, t, k, p)
    with pytest.raises(ValueError):
        nb.nearest(x, t.where("train_id < 0"), 1)
    with pytest.raises(ValueError):
        cl.trimmed_kmeans(x, np.eye(2), 0, 2)


def trimmed(x, centres, max_iter, q):
    centres = centres.copy()
    for _ in range(max_iter):
        d = np.sqrt(((x[:, None] - centres[None]) ** 2).sum(axis=2))
        own = d.argmin(axis=1)
        moved = centres.copy()
        for c in range(len(centres)):
            order = sorted(np.nonzero(own == c)[0], key=lambda i: (d[i, c], i))
            kept = [i for n, i in enumerate(order, 1) if n % q]
            if kept:
                moved[c] = x[kept].mean(axis=0)
        if np.abs(moved - centres).max() <= 1e-9:
            return moved
        centres = moved
    return centres


@pytest.mark.parametrize("q,k", [(5, 3), (2, 4), (1000, 2)])
def test_trimmed_kmeans_equals_the_plain_loop(spark, q, k):
    x = np.random.default_rng(q).normal(size=(80, 3)).round(2)
    points = frame(spark, x, "id")
    got = cl.trimmed_kmeans(points, cl.first_points(points, k), 4, q)
    assert np.allclose(got, trimmed(x, x[:k], 4, q))


def test_a_cluster_without_points_keeps_its_centre(spark):
    points = frame(spark, np.array([[0.0], [1.0]]), "id")
    assert cl.trimmed_kmeans(points, np.array([[0.5], [99.0]]), 3, 5).tolist() == [[0.5], [99.0]]


@settings(max_examples=6, deadline=None)
@given(st.integers(1, 30), st.integers(1, 4))
def test_moments_equal_numpy(spark, n, d):
    x = np.random.default_rng(n * 7 + d).normal(size=(n, d))
    df = frame(spark, x, "id").repartition(3)
    m = np.zeros((d, d))
    for r in vec.gram(df).collect():
        m[r["i"], r["j"]] = m[r["j"], r["i"]] = r["value"]
    c = x - x.mean(axis=0)
    assert np.allclose(m, c.T @ c)
    totals = {r["id"]: r["total"] for r in vec.squared_distance_totals(df, "id").collect()}
    want = ((x[:, None] - x[None]) ** 2).sum(axis=(1, 2))
    assert all(math.isclose(totals[i], want[i], rel_tol=1e-9, abs_tol=1e-9) for i in range(n))


def test_linear_class_ties_take_the_lowest_index(spark):
    df = frame(spark, np.array([[1.0], [-1.0]]), "id")
    weights = np.array([[0.0, 1.0], [0.0, 1.0], [0.0, -1.0]])
    assert [r["prediction"] for r in vec.linear_class(df, weights).orderBy("id").collect()] == [0, 2]


def test_the_matrix_product_finds_what_differences_find():
    rng = np.random.default_rng(8)
    for scale, shift in ((1.0, 0.0), (1e-3, 1e4), (1e6, -3.0)):
        # copies and near ties, far from the origin: the product alone would confuse them
        right = rng.normal(size=(300, 6)) * scale + shift
        right[100:140] = right[0]
        right[140:180] = right[0] + 1e-9 * scale
        left = np.vstack([rng.normal(size=(40, 6)) * scale + shift, right[:20]])
        gaps = vec.distances(left, right)
        for k in (1, 5, 60, 400):
            row, col, dist = vec.nearest_pairs(left, right, k)
            worst = np.sort(gaps, axis=1)[:, min(k, 300) - 1]
            want = np.nonzero(gaps <= worst[:, None])
            assert set(zip(row.tolist(), col.tolist())) == set(zip(*(w.tolist() for w in want)))
            assert (dist == gaps[row, col]).all()


def test_groups_are_joined_to_bins():
    pivots = np.array([[0.0], [10.0], [1.0], [11.0], [2.0]])
    bins = nb._bins(pivots, {(0, 0): 5, (0, 1): 4, (0, 2): 5, (0, 3): 4, (7, 4): 99}, 10)
    # neighbours share a bin, a group without rows has one too
    assert bins[0, 0] == bins[0, 2] != bins[0, 1] == bins[0, 3] and (0, 4) in bins and bins[7, 4] == 0


def test_vectors_stay_out_of_the_range_sort(spark, monkeypatch):
    seen = []
    real = cl.rank_in_group
    monkeypatch.setattr(cl, "rank_in_group", lambda df, *a, **k: (seen.append(df.columns), real(df, *a, **k))[1])
    x = np.random.default_rng(1).normal(size=(40, 3))
    got = cl.trimmed_kmeans(frame(spark, x, "id"), x[:2], 2, 3)
    assert np.allclose(got, trimmed(x, x[:2], 2, 3)) and seen[0] == ["id", "cluster", "dist"]
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("bucketed_")]


def test_a_join_on_buckets_leaves_them_in_place(spark):
    from tallgrass.plans.lineage import bucketed

    with bucketed(frame(spark, np.eye(40), "id"), "id", 40, bucket_rows=2) as placed:
        left_out = spark.range(0, 40, 3).hint("merge")
        kept = placed.join(left_out, "id", "left_anti")
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert kept.count() == 26 and "Bucketed: true" in plan and plan.count("hashpartitioning(id") == 1


@pytest.mark.parametrize("p", [1.0, 2.0, 1.5, 0.5])
def test_nearest_pairs_hold_few_distances(p):
    """The closest rows and all ties, in bounded memory."""
    rng = np.random.default_rng(8)
    right = np.vstack([rng.normal(size=(3900, 6)), rng.integers(0, 2, (100, 6))])
    left = np.vstack([rng.normal(size=(780, 6)), right[-20:]])
    tracemalloc.start()
    row, col, gaps = vec.nearest_pairs(left, right, 4, p)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # all distances at once would take 26 MB, and several times that for steps between
    assert peak < 25 << 20
    got = {}
    for r, c, g in zip(row.tolist(), col.tolist(), gaps.tolist()):
        got.setdefault(r, {})[c] = g
    for r, x in enumerate(left):
        want = ((np.abs(x - right) ** p).sum(axis=1)) ** (1 / p)
        worst = np.partition(want, 3)[3]
        assert {c for c in range(len(right)) if want[c] < worst - 1e-9} <= got[r].keys() <= {c for c in range(len(right)) if want[c] <= worst + 1e-9}
        assert len(got[r]) >= 4 and all(abs(want[c] - g) < 1e-9 for c, g in got[r].items())


def test_nearest_pairs_of_hostile_numbers():
    """Single precision only rules out: rows that it cannot tell apart, tiny and huge values."""
    rng = np.random.default_rng(9)
    for scale, base in ((1e-9, 1.0), (1e-300, 0.0), (1e35, 0.0), (1.0, 1e12)):
        right, left = base + scale * rng.normal(size=(500, 3)), base + scale * rng.normal(size=(40, 3))
        row, col, gaps = vec.nearest_pairs(left, right, 3, 1.0)
        want = np.sort(np.abs(left[:, None] - right[None]).sum(axis=2), axis=1)[:, :3]
        order = np.lexsort((gaps, row))
        firsts = np.searchsorted(row[order], np.arange(40))
        assert (gaps[order][firsts[:, None] + np.arange(3)] == want).all()
