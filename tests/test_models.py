from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression

from tallgrass.functions.vectors import linear_class
from tallgrass.operators import models as ml
from tallgrass.operators.margins import fit_machine
from tallgrass.operators.trees import grow_tree


def values(df):
    return {r["name"]: r["value"] for r in df.collect()}


def labelled(spark, x, y):
    return spark.createDataFrame([(i, float(v), Vectors.dense(r.tolist())) for i, (r, v) in enumerate(zip(x, y))], ["id", "label", "features"])


def test_metrics_equal_the_evaluator(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.5), (4.0, 3.0)], "label double, prediction double")
    got = ml.regression_metrics(df).first()
    for name in ("rmse", "r2"):
        assert got[name] == pytest.approx(RegressionEvaluator(metricName=name).evaluate(df))


def test_linear_regression_report(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 6))
    y = x @ np.array([3.0, 0, 0, -2.0, 0, 0]) + 1
    report, residuals = ml.linear_regression(labelled(spark, x[:150], y[:150]), labelled(spark, x[150:], y[150:]))
    got = values(report)
    assert got["coefficient TMAX"] > 2 and got["coefficient ONE_YEAR_PRCP"] < -1
    assert got["coefficient TMIN"] == pytest.approx(0, abs=0.05)
    assert got["test r2"] > 0.9 and residuals.count() == 150


def test_tree_importances_add_up(spark):
    x = np.random.default_rng(1).normal(size=(100, 6))
    got = values(ml.tree_regression(labelled(spark, x, x[:, 2] > 0), labelled(spark, x, x[:, 2] > 0)))
    assert sum(v for k, v in got.items() if k.startswith("importance")) == pytest.approx(1)
    assert got["importance SNWD"] > 0.9 and got["test rmse"] < 0.2


def batch_perceptron(x, y, classes, epochs):
    x = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros((classes, x.shape[1]))
    for _ in range(epochs):
        said = (x @ w.T).argmax(axis=1)
        moved = w.copy()
        for row, t, s in zip(x, y, said):
            if t != s:
                moved[t] += row
                moved[s] -= row
        if (moved == w).all():
            break
        w = moved
    return w


def test_perceptron_separates_and_equals_numpy(spark):
    rng = np.random.default_rng(2)
    y = rng.integers(0, 3, 60)
    x = rng.normal(size=(60, 2)) * 0.2 + np.array([[0, 0], [4, 0], [0, 4]])[y]
    df = spark.createDataFrame([(r.tolist(), int(v)) for r, v in zip(x, y)], "features array<double>, label int").repartition(4)
    assert np.allclose(ml.perceptron(df, 3, 2, 3), batch_perceptron(x, y, 3, 3))
    scored = linear_class(df, ml.perceptron(df, 3, 2, 100))
    assert scored.agg(ml.error_rate(scored)).first()[0] == 0
    with pytest.raises(ValueError):
        ml.perceptron(df, 3, 2, 0)


def test_projection_is_uncentred_and_on_the_principal_axes(spark):
    x = np.random.default_rng(3).normal(size=(50, 4)) * [5, 3, 1, 0.1] + 7
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id int, features array<double>")
    got = np.array([r["projection"] for r in ml.principal_projection(df, 2).orderBy("id").collect()])
    c = x - x.mean(axis=0)
    axes = np.linalg.eigh(c.T @ c)[1][:, ::-1][:, :2]
    axes = axes * [1 if a[np.abs(a).argmax()] > 0 else -1 for a in axes.T]
    assert np.allclose(got, x @ axes)


def test_rational_fits_find_the_curve(spark):
    x = np.linspace(-1, 1, 40)
    y = (1 + 2 * x + 3 * x**2) / (1 + 0.5 * x + 0.25 * x**2)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    got = values(ml.rational_fit(df))
    assert np.allclose([got[c] for c in "abcde"], [1, 2, 3, 0.5, 0.25])
    unit = values(ml.rational_fit_unit(df))
    v = np.array([unit[c] for c in "abcdef"])
    assert np.linalg.norm(v) == pytest.approx(1)
    assert np.allclose(v / v[3], [1, 2, 3, 1, 0.5, 0.25], atol=1e-6)


def blobs(spark, seed=4, n=60):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 2, n)
    return labelled(spark, rng.normal(size=(n, 2)) * 0.3 + np.array([[-2, -2], [2, 2]])[y], y)


def test_cross_validation_and_grid(spark):
    df = blobs(spark)
    table = ml.logistic_grid(df, blobs(spark, 5), ["id"], [1e-2, 1e4], folds=3, iterations=20)
    got = {r["strength"]: r for r in table.collect()}
    assert got[1e-2]["validation_error"] == 0 and got[1e-2]["test_error"] == 0
    assert got[1e4]["train_error"] >= got[1e-2]["train_error"]


def test_gradient_of_logistic_fits_equals_numpy_and_vanishes_at_the_optimum(spark):
    df = blobs(spark)
    x = np.array([r["features"].toArray() for r in df.collect()])
    y = np.array([int(r["label"]) for r in df.collect()])
    for iterations, bound in ((1, None), (ml.UNTIL_TOLERANCE, 1e-5)):
        model = ml.logistic(0.5, len(y), iterations).fit(df)
        score = x @ model.coefficientMatrix.toArray().T + model.interceptVector.toArray()
        p = np.exp(score - score.max(axis=1, keepdims=True))
        p = p / p.sum(axis=1, keepdims=True) - np.eye(2)[y]
        slope = np.hstack([p.T @ x / len(y) + 0.5 / len(y) * model.coefficientMatrix.toArray(), p.mean(axis=0)[:, None]])
        got = ml.logistic_gradient(model, df, 0.5 / len(y))
        assert got == pytest.approx(np.abs(slope).max(), abs=1e-12)
        assert bound is None or got < bound


def best_split(x, y, edges):
    """(gain, feature, bin) by trying every bin of every feature."""
    found = []
    for f in range(x.shape[1]):
        for b in range(len(edges[f]) - 2):
            left = x[:, f] < edges[f][b + 1]
            if left.any() and not left.all():
                gain = ((y - y.mean()) ** 2).sum() - sum(((s - s.mean()) ** 2).sum() for s in (y[left], y[~left]))
                found.append((gain, -f, -b))
    return max(found)


def test_tree_splits_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 3))
    y = np.where(x[:, 1] > 0.3, 4.0, 1.0) + (x[:, 2] > 0) * x[:, 1] + rng.normal(size=300) * 0.1
    tree = grow_tree(labelled(spark, x, y), 3, depth=3, bins=8)
    edges = [np.linspace(c.min(), c.max(), 9) for c in x.T]
    node = np.ones(300, int)
    for n in sorted(tree.splits):
        here, split = node == n, tree.splits[n]
        gain, f, b = best_split(x[here], y[here], edges)
        assert (split.feature, split.bin) == (-f, -b)
        assert split.gain == pytest.approx(gain / ((y - y.mean()) ** 2).sum(), abs=1e-8)
        node[here] = 2 * n + (x[here, split.feature] >= edges[split.feature][split.bin + 1])
    got = labelled(spark, x, y).select("id", tree.leaf().alias("leaf"), tree.prediction().alias("p")).orderBy("id").collect()
    assert [r["leaf"] for r in got] == node.tolist()
    assert [r["p"] for r in got] == pytest.approx([y[node == n].mean() for n in node])
    assert sum(tree.importances()) == pytest.approx(1) and tree.importances()[1] > 0.8


def test_trees_of_awkward_tables(spark):
    empty = labelled(spark, np.zeros((1, 2)), [1.0]).where("id < 0")
    tree = grow_tree(empty, 2)
    row = labelled(spark, np.zeros((1, 2)), [1.0])
    assert not tree.splits and row.select(tree.prediction()).first()[0] is None and tree.importances() == [0.0, 0.0]
    same = grow_tree(labelled(spark, np.ones((5, 2)), [1.0, 2, 3, 4, 5]), 2)
    assert not same.splits and row.select(same.prediction()).first()[0] == 3
    # ties go to the first feature; values beyond the ends fall into the end bins
    two = grow_tree(labelled(spark, np.array([[0.0, 0], [1, 1]] * 3), [1.0, 5] * 3), 2, depth=2, bins=2)
    assert [(s.feature, s.bin, s.threshold) for s in two.splits.values()] == [(0, 0, 0.5)]
    far = labelled(spark, np.array([[-9.0, 0], [9, 0]]), [0.0, 0])
    assert sorted(r[0] for r in far.select(two.prediction()).collect()) == [1, 5]
    with pytest.raises(ValueError):
        grow_tree(empty, 2, bins=1)


def test_svm_tables(spark):
    train, validation = blobs(spark), blobs(spark, 5)
    linear = ml.linear_svm(train, validation, [0.01, 0.1]).orderBy("cost").collect()
    # a higher cost never widens the margin
    assert linear[0]["margin"] > linear[1]["margin"] and linear[1]["validation_error"] == 0
    assert ml.hinge_svm(train, validation, [0.05, 0.5]).count() == 2
    assert [r["validation_error"] for r in ml.polynomial_svm(train, validation, [2, 3]).collect()] == [0, 0]


def objective(x, y, w, b, penalty):
    return penalty / 2 * w @ w + np.maximum(0, 1 - np.where(y > 0, 1, -1) * (x @ w + b)).mean()


@pytest.mark.parametrize("penalty", [1e-3, 0.1, 2.0])
def test_a_machine_lies_within_its_gap_of_the_optimum(spark, penalty):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(150, 3))
    y = (x[:, 0] + 0.5 * rng.normal(size=150) > 0.4).astype(int)
    got = fit_machine(labelled(spark, x, y).repartition(3), penalty, 1e-5)
    assert got.value == pytest.approx(objective(x, y, got.weights, got.intercept, penalty)) and 0 <= got.gap <= 1e-5
    # no other plane lies below the bound, near or far, and steps downhill find none
    bound = got.value - got.gap - 1e-12
    for scale in (1e-3, 1e-2, 0.1, 1.0, 5.0):
        for _ in range(200):
            assert objective(x, y, got.weights + scale * rng.normal(size=3), got.intercept + scale * rng.normal(), penalty) >= bound
    w, b, best = np.zeros(3), 0.0, 9.0
    for step in range(1, 20_001):
        short = (1 - np.where(y > 0, 1, -1) * (x @ w + b) > 0) * np.where(y > 0, 1, -1)
        w, b = w - (penalty * w - short @ x / 150) / (penalty + 1) / step**0.6, b + short.mean() / step**0.6
        best = min(best, objective(x, y, w, b, penalty))
    assert best >= bound and best - got.value < 5e-3


def test_machines_of_awkward_tables(spark):
    empty = spark.createDataFrame([], "id long, label double, features array<double>").select("label", array_to_vector("features").alias("features"))
    assert fit_machine(empty, 1.0).passes == 0
    one = fit_machine(labelled(spark, np.eye(3), [1, 1, 1]), 1.0)
    assert one.intercept > 0 and not one.weights.any() and one.gap == 0
    # copies of one point on both sides: half of them must be wrong
    same = fit_machine(labelled(spark, np.ones((8, 2)), [0, 1] * 4), 0.5)
    assert same.value == pytest.approx(1, abs=1e-3)
    rows = labelled(spark, np.array([[2.0, 0.0], [-2.0, 0.0]]), [1, 0])
    machine = fit_machine(rows, 0.01)
    assert [r[0] for r in rows.select(machine.prediction()).collect()] == [1.0, 0.0]
    for bad in ((-1.0, 1e-4), (1.0, 0.0)):
        with pytest.raises(ValueError):
            fit_machine(rows, *bad)


def test_polynomials_are_turned_into_uncorrelated_columns(spark):
    x = np.random.default_rng(9).normal(size=(80, 2)) + 5
    df = labelled(spark, np.hstack([x, x[:, :1] * 2, np.ones((80, 1))]), [0] * 80)
    turned = np.array([r[0].toArray() for r in ml.orthonormal(df, "features")(df).select("features").collect()])
    # a multiple and a constant add no direction
    assert turned.shape == (80, 2) and np.allclose(turned.mean(axis=0), 0) and np.allclose(turned.T @ turned / 80, np.eye(2))
    ring = (np.hypot(*(x - 5).T) > 1).astype(int)
    table = ml.polynomial_svm(labelled(spark, x, ring), labelled(spark, x, ring), [1, 2]).orderBy("degree").collect()
    assert table[0]["train_error"] > 0.2 > 0.1 > table[1]["train_error"] and all(r["gap"] <= ml.GAP for r in table)


def test_elastic_net_meets_the_conditions_and_equals_the_solver(spark):
    rng = np.random.default_rng(10)
    x = rng.normal(size=(200, 6)) * [1, 5, 0.1, 1, 1, 0] + [0, 9, 0, 0, 0, 3]
    y = x @ np.array([2.0, 0.3, 5.0, 0, 0, 0]) + rng.normal(size=200) + 4
    df = labelled(spark, x, y)
    fit = ml.elastic_net(df, 0.3, 0.8)
    assert fit.violation < 1e-12 and fit.coefficients[5] == 0
    solver = LinearRegression(maxIter=10_000, tol=1e-14, regParam=0.3, elasticNetParam=0.8).fit(df)
    assert np.allclose(fit.coefficients, solver.coefficients.toArray(), atol=1e-5) and fit.intercept == pytest.approx(solver.intercept, abs=1e-4)
    assert abs(fit.excess(solver.coefficients.toArray())) < 1e-8
    few = LinearRegression(maxIter=1, regParam=0.3, elasticNetParam=0.8).fit(df)
    assert fit.excess(few.coefficients.toArray()) > 1e-4
    rows = ml.residuals(df, fit).collect()
    assert len(rows) == 200 and all(r["residual"] == pytest.approx(r["label"] - r["prediction"]) for r in rows)
    want = x @ np.array(fit.coefficients) + fit.intercept
    assert np.allclose([r["prediction"] for r in sorted(rows, key=lambda r: r["id"])], want)
    assert ml.elastic_net(df.where("id < 0")).coefficients == (0.0,) * 6
    with pytest.raises(ValueError):
        ml.elastic_net(df, -1.0)


def test_perceptron_runs_until_nothing_is_wrong(spark):
    rng = np.random.default_rng(12)
    y = rng.integers(0, 4, 120)
    x = rng.normal(size=(120, 4)) * 0.2 + np.eye(4)[y] * 1.5
    df = spark.createDataFrame([(r.tolist(), int(v)) for r, v in zip(x, y)], "features array<double>, label int").repartition(3)
    weights = ml.perceptron(df, 4, 4)
    assert np.allclose(weights, batch_perceptron(x, y, 4, 100_000))
    assert ((np.hstack([np.ones((120, 1)), x]) @ weights.T).argmax(axis=1) == y).all()


def test_perceptron_needs_few_passes(spark, monkeypatch):
    rng = np.random.default_rng(5)
    y = rng.integers(0, 5, 3000)
    x = rng.normal(size=(3000, 5)).clip(-2.6, 2.6) * 0.15
    x[np.arange(3000), y] += 1
    df = spark.createDataFrame([(r.tolist(), int(v)) for r, v in zip(x, y)], "features array<double>, label int").repartition(3)
    made, passes = ml._pass, []
    monkeypatch.setattr(ml, "_pass", lambda *a: passes.append(0) or made(*a))
    want = [batch_perceptron(x, y, 5, n) for n in (7, 15, 100_000)]
    assert np.allclose(ml.perceptron(df, 5, 5, 7, near_rows=60), want[0])
    assert np.allclose(ml.perceptron(df, 5, 5, 15, near_rows=60), want[1])
    passes.clear()
    assert np.allclose(ml.perceptron(df, 5, 5, near_rows=60), want[2])
    # 31 epochs, of which most need no pass
    assert not np.allclose(want[1], want[2]) and len(passes) <= 8


def test_perceptron_of_no_rows(spark):
    df = spark.createDataFrame([], "features array<double>, label int")
    assert (ml.perceptron(df, 3, 2) == np.zeros((3, 3))).all()
