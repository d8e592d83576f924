from __future__ import annotations

import random

import numpy as np
import pytest
from conftest import rows
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tallgrass.operators.selection import encode_labels, slice_rows, with_folds
from tallgrass.plans.ordering import fold_of, rank_in_group, row_index, sums_before
from tallgrass.plans.splits import exact_split, hash_split


def test_row_index_is_the_position_in_the_total_order(spark):
    ids = list(range(500))
    random.Random(1).shuffle(ids)
    df = spark.createDataFrame([(i, i % 3) for i in ids], "id long, k int").repartition(7)
    got = {r["id"]: r["idx"] for r in row_index(df, "k", "id").collect()}
    want = {i: p for p, i in enumerate(sorted(ids, key=lambda i: (i % 3, i)))}
    assert got == want


def test_row_index_without_order_is_refused(spark):
    with pytest.raises(ValueError):
        row_index(spark.range(3))


def test_row_index_of_an_empty_table(spark):
    assert row_index(spark.range(0), "id").count() == 0


def test_rank_in_group_with_one_hot_group(spark):
    # nine tenths of the rows in one group
    data = [(0 if i % 10 else i, (i * 37) % 101, i) for i in range(1000)]
    df = spark.createDataFrame(data, "g long, v long, id long")
    got = {r["id"]: r["rank"] for r in rank_in_group(df, ["g"], ["v", "id"]).collect()}
    want = {}
    for g in {d[0] for d in data}:
        for n, d in enumerate(sorted((d for d in data if d[0] == g), key=lambda d: (d[1], d[2])), 1):
            want[d[2]] = n
    assert got == want


@settings(max_examples=8, deadline=None)
@given(n=st.integers(1, 40), folds=st.integers(2, 7))
def test_folds_differ_by_at_most_one_and_the_first_are_larger(spark, n, folds):
    df = spark.range(n).select("id", fold_of(F.col("id"), n, folds).alias("fold"))
    got = np.bincount([r["fold"] for r in df.orderBy("id").collect()], minlength=folds)
    want = np.full(folds, n // folds)
    want[: n % folds] += 1
    assert got.tolist() == want.tolist()


def test_eleven_rows_in_three_folds(spark):
    df = with_folds(spark.range(11), ["id"], 3)
    assert [r["fold"] for r in df.orderBy("id").collect()] == [0] * 4 + [1] * 4 + [2] * 3


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_sums_before_is_the_exclusive_running_sum(spark, block):
    rng = random.Random(2)
    data = [(k, s, rng.randint(0, 9)) for k in range(3) for s in rng.sample(range(50), 20)]
    df = spark.createDataFrame(data, "k int, s long, v int")
    got = {(r["k"], r["s"]): (r["t"], r["n"]) for r in sums_before(df, ["k"], "s", {"t": F.col("v"), "n": F.lit(1)}, block).collect()}
    want = {
        (k, s): (sum(x for a, b, x in data if a == k and b < s), sum(1 for a, b, _ in data if a == k and b < s))
        for k, s, _ in data
    }
    assert got == want


def test_slice_marks_positions_half_open(spark):
    got = slice_rows(spark.range(10), ["id"], 2, 4)
    assert [r["id"] for r in got.where("part = 'validation'").orderBy("id").collect()] == [2, 3]


def test_label_codes_follow_first_appearance(spark):
    df = spark.createDataFrame([(0, "b"), (1, "a"), (2, "b"), (3, "c")], "pos long, label string")
    assert rows(encode_labels(df, "label", "pos").select("pos", "code")) == [(0, 0), (1, 1), (2, 0), (3, 2)]


def test_splits_are_repeatable_and_whole(spark):
    df = spark.range(300)
    first = rows(exact_split(df, "id", 200, seed=5))
    assert first == rows(exact_split(df.repartition(5), "id", 200, seed=5))
    assert sum(r[1] for r in first) == 200 and len(first) == 300
    assert first != rows(exact_split(df, "id", 200, seed=6))
    share = hash_split(df, "id", 0.7, seed=5).where("is_train").count() / 300
    assert 0.6 < share < 0.8
    with pytest.raises(ValueError):
        hash_split(df, "id", 1.5, seed=5)
