from __future__ import annotations

import math
import random

import numpy as np
import pytest
from conftest import rows

from tallgrass.operators import series as se


def test_closed_form_is_the_minimum():
    rng = random.Random(0)
    for _ in range(500):
        mu, s, a, b = rng.uniform(0.1, 3), rng.uniform(-2, 2), rng.uniform(-2, 2), rng.uniform(-2, 2)

        def cost(x):
            return mu * (x - s) ** 2 + abs(x - a) + abs(x - b)

        x = se.closest_value(mu, s, a, b)
        grid = np.linspace(min(s, a, b) - 1, max(s, a, b) + 1, 4001)
        assert cost(x) <= min(cost(g) for g in grid[::40]) + 1e-9
        assert cost(x) <= cost(x + 1e-4) + 1e-12 and cost(x) <= cost(x - 1e-4) + 1e-12


def test_denoise(spark):
    data = [("flat", i, 2.0) for i in range(6)] + [("spike", i, 5.0 if i == 2 else 0.0) for i in range(5)] + [("one", 0, 3.0)]
    df = spark.createDataFrame(data, "series string, pos int, value double").repartition(3)
    got = {(r["series"], r["pos"]): r["smooth"] for r in se.denoise(df, 0.5, 10).collect()}
    assert len(got) == len(data)
    assert all(got["flat", i] == 2.0 for i in range(6)) and got["one", 0] == 3.0
    # the spike moves by 1 / alpha towards its neighbours, which rise in turn
    assert got["spike", 2] == 3.0 and got["spike", 1] >= 0
    for alpha, sweeps in ((0, 1), (1, -1)):
        with pytest.raises(ValueError):
            se.denoise(df, alpha, sweeps)


def test_sweeps_go_from_first_to_last(spark):
    rng = np.random.default_rng(1)
    s = np.r_[np.ones(20), np.zeros(20)] + 0.1 * rng.normal(size=40)
    x = s.copy()
    for _ in range(8):  # 7 + 1 sweeps
        for k in range(40):
            left, right = x[k - 1 if k else 1], x[k + 1 if k < 39 else 38]
            x[k] = se.closest_value(0.5 if 0 < k < 39 else 1.0, s[k], left, right)
    df = spark.createDataFrame([("a", i, float(v)) for i, v in enumerate(s)], "series string, pos int, value double")
    got = [r["smooth"] for r in se.denoise(df, 0.5, 7).orderBy("pos").collect()]
    assert np.allclose(got, x)


def test_series_of_several_lengths_with_gaps(spark):
    rng = np.random.default_rng(2)
    data = [(f"s{i}", k, float(v)) for i, n in enumerate((2, 3, 3, 7, 30, 30)) for k, v in enumerate(rng.normal(size=n).round(2))]
    got = {(r["series"], r["pos"]): r["smooth"] for r in se.denoise(spark.createDataFrame(data, "series string, pos int, value double"), 0.8, 12).collect()}
    for name in {d[0] for d in data}:
        s = [v for a, _, v in data if a == name]
        x, last = list(s), len(s) - 1
        for _ in range(13):
            for k in range(last + 1):
                x[k] = float(se.closest_value(0.8 if 0 < k < last else 1.6, s[k], x[k - 1 if k else 1], x[k + 1 if k < last else last - 1]))
        assert [got[name, k] for k in range(last + 1)] == x
    gaps = spark.createDataFrame([("a", 0, 1.0), ("a", 1, None), ("a", 2, 5.0), (None, 0, 2.0)], "series string, pos int, value double")
    assert {(r["series"], r["pos"]): r["smooth"] for r in se.denoise(gaps, 0.5, 3).collect()} == {("a", 0): 1.0, ("a", 1): None, ("a", 2): 5.0, (None, 0): 2.0}
    assert se.denoise(gaps.limit(0), 0.5, 3).count() == 0


PRICES = [("A", "2016-01", 1.0), ("A", "2016-02", 2.0), ("B", "2016-01", 3.0), ("A", "2015-12", 9.0)]


def test_complete_series_and_sectors(spark):
    prices = spark.createDataFrame(PRICES, "symbol string, date string, close double")
    sectors = spark.createDataFrame([("A", "Energy"), ("C", "None")], "symbol string, sector string")
    assert rows(se.load_complete(prices, sectors, 2016, 2)) == [("A", "2016-01", 1.0, "Energy"), ("A", "2016-02", 2.0, "Energy")]
    assert se.of_year(prices, 2016, "B").count() == 1
    with pytest.raises(ValueError):
        se.complete(prices, 0)


def test_log_returns_and_vectors(spark):
    prices = spark.createDataFrame(PRICES, "symbol string, date string, close double")
    returns = se.log_returns(se.of_year(prices, 2016))
    assert rows(returns.select("symbol", "log_return")) == [("A", math.log(2.0))]
    vectors = se.as_vectors(prices, "close")
    assert rows(vectors) == [("A", [9.0, 1.0, 2.0]), ("B", [3.0])]
