"""Models on tables: MLlib estimators, error measures, and linear fits from moments."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import PCA, PolynomialExpansion, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tallgrass.functions.vectors import block, gram, mean_vector, with_columns
from tallgrass.operators.margins import Machine, fit_machine
from tallgrass.operators.selection import with_folds

# fixed values: the features of the yearly rain model, in order
RAIN_FEATURES = ("TMAX", "TMIN", "SNWD", "ONE_YEAR_PRCP", "TWO_YEAR_PRCP", "FIVE_YEAR_PRCP")

# iterative fits end by the solver's tolerance; this many iterations only stop one that does not
UNTIL_TOLERANCE = 10_000
# relative change of the loss at which logistic fits end
LOGISTIC_TOL = 1e-8


def assemble(df: DataFrame, inputs: Sequence[str] = RAIN_FEATURES, label: str = "PRCP", keep: Sequence[str] = ()) -> DataFrame:
    """Pack the input columns to one vector; the target becomes ``label``."""
    packed = VectorAssembler(inputCols=list(inputs), outputCol="features").transform(df)
    return packed.select(*keep, F.col(label).cast("double").alias("label"), "features")


def named_values(spark: SparkSession, values: dict[str, float]) -> DataFrame:
    """A small report as a table of names and values."""
    return spark.createDataFrame([(k, float(v)) for k, v in values.items()], "name string, value double")


def regression_metrics(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """RMSE and R squared in one aggregate."""
    gap = F.col(label) - F.col(prediction)
    # var_pop is computed around the mean, so large labels do not cancel out
    return df.agg(
        F.sqrt(F.avg(gap * gap)).alias("rmse"), (1 - F.avg(gap * gap) / F.var_pop(label)).alias("r2")
    )


def error_rate(df: DataFrame, prediction: str = "prediction", label: str = "label") -> Column:
    return F.avg((F.col(prediction) != F.col(label)).cast("int"))


def _error(df: DataFrame) -> float:
    return df.agg(error_rate(df)).first()[0]


def linear_regression(
    train: DataFrame, test: DataFrame, iterations: int = 10, strength: float = 0.3, mix: float = 0.8,
    inputs: Sequence[str] = RAIN_FEATURES,
) -> tuple[DataFrame, DataFrame]:
    """Elastic-net fit: a report (coefficients, errors) and the residuals of the training rows."""
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = LinearRegression(maxIter=iterations, regParam=strength, elasticNetParam=mix).fit(train)
        summary = model.summary
        values = {f"coefficient {n}": c for n, c in zip(inputs, model.coefficients, strict=True)}
        values |= {"intercept": model.intercept, "iterations": summary.totalIterations}
        values |= {"train rmse": summary.rootMeanSquaredError, "train r2": summary.r2}
        values |= _test_metrics(model.transform(test))
    finally:
        train.unpersist()
    residuals = model.transform(train).select((F.col("label") - F.col("prediction")).alias("residual"))
    return named_values(train.sparkSession, values), residuals


@dataclass(frozen=True)
class _Moments:
    """Second moments of standardised inputs and a centred label, and the penalties on them."""

    mean: np.ndarray
    spread: np.ndarray
    gram: np.ndarray
    cross: np.ndarray
    label_mean: float
    variance: float
    l1: float
    l2: float

    def objective(self, g: np.ndarray) -> float:
        return (self.variance - 2 * self.cross @ g + g @ self.gram @ g) / 2 + self.l1 * np.abs(g).sum() + self.l2 / 2 * g @ g

    def violation(self, g: np.ndarray) -> float:
        """Largest distance of a coordinate from the optimality conditions, in units of the label's spread."""
        pull = self.cross - self.gram @ g - self.l2 * g
        off = np.where(g != 0, np.abs(pull - self.l1 * np.sign(g)), np.maximum(np.abs(pull) - self.l1, 0))
        return float(off.max(initial=0.0)) / math.sqrt(self.variance) if self.variance else 0.0


@dataclass(frozen=True)
class ElasticNet:
    """A linear fit at its optimum, and how far it is from meeting the conditions of one."""

    inputs: tuple[str, ...]
    coefficients: tuple[float, ...]
    intercept: float
    objective: float
    violation: float
    moments: _Moments

    def prediction(self, features: str = "features") -> Column:
        """The fitted value of a feature vector, as an expression."""
        x = vector_to_array(features)
        total = F.lit(self.intercept)
        for i, c in enumerate(self.coefficients):
            total = total + F.lit(c) * x[i]
        return total

    def excess(self, coefficients: Sequence[float]) -> float:
        """How far the objective of other coefficients lies above the optimum, as a share of the variance."""
        return (self.moments.objective(np.asarray(coefficients, float) * self.moments.spread) - self.objective) / self.moments.variance


def elastic_net(train: DataFrame, strength: float = 0.3, mix: float = 0.8, inputs: Sequence[str] = RAIN_FEATURES, tolerance: float = 1e-13) -> ElasticNet:
    """The elastic-net fit of (features, label) run to its optimum.

    The same function as ``LinearRegression`` minimises: half the mean squared error, plus the
    penalty on coefficients of inputs divided by their spread, the squared part also divided by the
    spread of the label.  One aggregate takes the moments of all pairs of columns; on these few
    numbers coordinates are set to their best value in turn until the conditions of an optimum hold.  An input
    without spread gets 0.  No rows, or a label without spread, give the mean.
    """
    if strength < 0 or not 0 <= mix <= 1:
        raise ValueError("strength must not be negative and mix must lie between 0 and 1")
    n = len(inputs)
    x = vector_to_array("features")
    columns = [x[i] for i in range(n)] + [F.col("label")]
    pairs = [(i, j) for i in range(n + 1) for j in range(i, n + 1)]
    row = train.agg(
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.covar_pop(columns[i], columns[j]).alias(f"c{i}_{j}") for i, j in pairs],
    ).first()
    mean = np.array([row[f"m{i}"] or 0.0 for i in range(n + 1)])
    scatter = np.zeros((n + 1, n + 1))
    for i, j in pairs:
        scatter[i, j] = scatter[j, i] = row[f"c{i}_{j}"] or 0.0
    spread = np.sqrt(np.diag(scatter))
    divisor = np.where(spread[:n] > 0, spread[:n], 1.0)
    label_spread = spread[n] or 1.0
    moments = _Moments(
        mean[:n], spread[:n], scatter[:n, :n] / np.outer(divisor, divisor), scatter[:n, n] / divisor, mean[n], scatter[n, n],
        strength * mix, strength * (1 - mix) / label_spread,
    )
    g = np.zeros(n)
    while moments.violation(g) > tolerance:
        before = g.copy()
        for i in np.flatnonzero(spread[:n] > 0):
            rest = moments.cross[i] - moments.gram[i] @ g + g[i] * moments.gram[i, i]
            g[i] = np.sign(rest) * max(abs(rest) - moments.l1, 0.0) / (moments.gram[i, i] + moments.l2)
        if np.array_equal(before, g):
            break
    coefficients = np.where(spread[:n] > 0, g / divisor, 0.0)
    return ElasticNet(
        tuple(inputs), tuple(coefficients.tolist()), float(mean[n] - coefficients @ mean[:n]), float(moments.objective(g)), moments.violation(g), moments
    )


def elastic_net_report(train: DataFrame, test: DataFrame, iterations: int = 10, strength: float = 0.3, mix: float = 0.8, inputs: Sequence[str] = RAIN_FEATURES) -> DataFrame:
    """The optimum (coefficients, errors on both sides, violation of the optimality conditions) and
    by how much a solver of ``iterations`` iterations misses it, as a share of the label's variance."""
    best = elastic_net(train, strength, mix, inputs)
    values = {f"coefficient {n}": c for n, c in zip(inputs, best.coefficients, strict=True)} | {"intercept": best.intercept}
    for side, rows in (("train", train), ("test", test)):
        found = regression_metrics(rows.select("label", best.prediction().alias("prediction"))).first()
        values |= {f"{side} {m}": found[m] if found[m] is not None else math.nan for m in ("rmse", "r2")}
    solver = LinearRegression(maxIter=iterations, regParam=strength, elasticNetParam=mix).fit(train)
    values |= {"violation": best.violation, f"excess after {iterations} iterations": best.excess(solver.coefficients.toArray())}
    return named_values(train.sparkSession, values)


def residuals(df: DataFrame, fit: ElasticNet) -> DataFrame:
    """Every row with its ``prediction`` and ``residual`` (label - prediction), in place of the features."""
    predicted = df.withColumn("prediction", fit.prediction())
    return predicted.withColumn("residual", F.col("label") - F.col("prediction")).drop("features")


def _test_metrics(predictions: DataFrame) -> dict[str, float]:
    return {f"test {m}": RegressionEvaluator(metricName=m).evaluate(predictions) for m in ("rmse", "r2")}


def tree_regression(train: DataFrame, test: DataFrame, inputs: Sequence[str] = RAIN_FEATURES) -> DataFrame:
    model = DecisionTreeRegressor(seed=0).fit(train)
    importances = model.featureImportances.toArray()
    values = {f"importance {n}": v for n, v in zip(inputs, importances, strict=True)}
    return named_values(train.sparkSession, values | _test_metrics(model.transform(test)))


def _in_parallel(jobs: list[Callable[[], object]], threads: int) -> list:
    """Run independent fits side by side, as the cluster has room for more than one small job."""
    spark = SparkSession.active()
    with ThreadPool(threads) as pool:
        return pool.map(lambda job: inheritable_thread_target(spark)(job)(), jobs)


def logistic_gradient(model: LogisticRegressionModel, rows: DataFrame, penalty: float) -> float:
    """Largest partial derivative of the mean loss with ``penalty`` / 2 |W|^2 at the fitted weights.

    Zero only at the optimum: the loss lies at most |gradient|^2 / (2 penalty) above it.  The products of
    class residuals and features are summed in one aggregate.  No rows give 0.
    """
    classes, width = model.numClasses, model.numFeatures
    shown = F.transform(vector_to_array("probability"), lambda p, c: p - (c == F.col("label").cast("int")).cast("double"))
    both = F.concat(shown, vector_to_array("features"), F.array(F.lit(1.0)))
    sums = np.zeros((classes + width + 1,) * 2)
    for i, j, value in gram(model.transform(rows).select(both.alias("both")), "both", centred=False).collect():
        sums[i, j] = value
    # the last product is the constant with itself: the number of rows
    if not sums[-1, -1]:
        return 0.0
    slope = sums[:classes, classes:] / sums[-1, -1]
    slope[:, :width] += penalty * model.coefficientMatrix.toArray()
    return float(np.abs(slope).max())


def cross_validation(df: DataFrame, order: list[str], estimators: Sequence, folds: int, threads: int = 4) -> list[tuple[float, float, float]]:
    """Mean training and validation error over contiguous folds, for each estimator, and the largest
    gradient that a fit of it ended with."""
    rows = with_folds(df, order, folds).select("fold", "features", "label").persist(StorageLevel.MEMORY_AND_DISK)

    def errors(estimator, fold: int) -> tuple[float, float, float]:
        inside, outside = rows.where(F.col("fold") != fold), rows.where(F.col("fold") == fold)
        model = estimator.fit(inside)
        return _error(model.transform(inside)), _error(model.transform(outside)), logistic_gradient(model, inside, estimator.getRegParam())

    try:
        jobs = [lambda e=e, f=f: errors(e, f) for e in estimators for f in range(folds)]
        found = np.asarray(_in_parallel(jobs, threads)).reshape(len(estimators), folds, 3)
    finally:
        rows.unpersist()
    return [(train, validation, worst) for (train, validation, _), worst in zip(found.mean(axis=1), found[:, :, 2].max(axis=1))]


def logistic(strength: float, rows: int, iterations: int = UNTIL_TOLERANCE) -> LogisticRegression:
    """Logistic regression for a penalty ``strength`` on the summed loss; Spark averages the loss."""
    return LogisticRegression(
        family="multinomial", regParam=strength / rows, elasticNetParam=0.0, standardization=False, maxIter=iterations, tol=LOGISTIC_TOL
    )


def logistic_grid(
    train: DataFrame, test: DataFrame, order: list[str], strengths: Sequence[float], folds: int = 5,
    iterations: int = UNTIL_TOLERANCE, threads: int = 4,
) -> DataFrame:
    """Cross-validation and test error for each penalty strength, and the largest gradient of its fits."""
    rows = train.count()
    inside = rows - rows // folds
    errors = cross_validation(train, order, [logistic(s, inside, iterations) for s in strengths], folds, threads)
    kept = train.select("features", "label").persist(StorageLevel.MEMORY_AND_DISK)

    def tested(strength: float) -> tuple[float, float]:
        model = logistic(strength, rows, iterations).fit(kept)
        return _error(model.transform(test)), logistic_gradient(model, kept, strength / rows)

    try:
        tests = _in_parallel([lambda s=s: tested(s) for s in strengths], threads)
    finally:
        kept.unpersist()
    table = [
        (float(s), float(a), float(b), float(c), float(max(inner, last)))
        for s, (a, b, inner), (c, last) in zip(strengths, errors, tests, strict=True)
    ]
    return train.sparkSession.createDataFrame(
        table, "strength double, train_error double, validation_error double, test_error double, gradient double"
    )


#: How far the value of a machine may lie above the optimum, in units of the mean hinge loss.
GAP = 1e-4


def _machine_table(found: list[tuple[float, DataFrame, DataFrame, Machine]], name: str, spark: SparkSession) -> DataFrame:
    """One row per setting: errors on both sides, margin 1 / |w|, the value reached and its certificate."""

    def measured(value: float, train: DataFrame, validation: DataFrame, machine: Machine) -> tuple:
        errors = [_error(rows.select("label", machine.prediction().alias("prediction"))) for rows in (train, validation)]
        return float(value), *errors, machine.margin, machine.value, machine.gap

    rows = [measured(*setting) for setting in found]
    return spark.createDataFrame(
        rows, f"{name} double, train_error double, validation_error double, margin double, objective double, gap double"
    )


def _machines(train: DataFrame, validation: DataFrame, penalties: dict[float, float], name: str, threads: int) -> DataFrame:
    jobs = [lambda v=v, p=p: (v, train, validation, fit_machine(train, p, GAP)) for v, p in penalties.items()]
    return _machine_table(_in_parallel(jobs, threads), name, train.sparkSession)


def linear_svm(train: DataFrame, validation: DataFrame, costs: Sequence[float], threads: int = 4) -> DataFrame:
    """Errors and margin 1/|w| for each cost of a summed hinge loss, fitted to a certified gap."""
    rows = train.count()
    return _machines(train, validation, {c: 1 / (c * rows) for c in costs}, "cost", threads)


def orthonormal(df: DataFrame, name: str, cutoff: float = 1e-10) -> Callable[[DataFrame], DataFrame]:
    """A transform that replaces the vector column ``name`` by uncorrelated columns of mean 0 and spread 1.

    The directions are those of the correlation matrix of ``df``; one with less than ``cutoff`` of the
    greatest share is rounding error and left out.  The mean and the matrix come from two passes; both are as small as a vector.
    """
    rows = df.select(vector_to_array(name).alias("v"))
    n, mean = mean_vector(rows, "v")
    scatter = np.zeros((len(mean), len(mean)))
    for r in gram(rows, "v").collect():
        scatter[r["i"], r["j"]] = scatter[r["j"], r["i"]] = r["value"] / n
    spread = np.sqrt(np.diag(scatter))
    scale = np.where(spread > 0, 1 / np.where(spread > 0, spread, 1.0), 0.0)
    share, axes = np.linalg.eigh(scatter * np.outer(scale, scale))
    kept = share > cutoff * share.max(initial=0.0)
    turn = scale[:, None] * axes[:, kept] / np.sqrt(share[kept])

    def compute(x: np.ndarray) -> list[pa.Array]:
        made = (x - mean) @ turn
        ends = np.arange(len(made) + 1, dtype=np.int32) * made.shape[1]
        return [pa.ListArray.from_arrays(pa.array(ends), pa.array(made.ravel()))]

    def transform(other: DataFrame) -> DataFrame:
        arrays = other.withColumn(name, vector_to_array(name))
        added = T.StructType().add("_turned", T.ArrayType(T.DoubleType()))
        return with_columns(arrays, name, added, compute).drop(name).withColumn(name, array_to_vector("_turned")).drop("_turned")

    return transform


def polynomial_svm(train: DataFrame, validation: DataFrame, degrees: Sequence[int], threads: int = 4) -> DataFrame:
    """Linear SVM on all monomials up to each degree; cost 1.

    Monomials of one degree and the next are all but equal, and a solver creeps along them.  So they are
    first turned into uncorrelated columns of spread 1 (``orthonormal``), which span the same polynomials;
    the penalty, and with it the margin, is measured on those columns.
    """
    rows = train.count()

    def fit(degree: int) -> tuple[float, DataFrame, DataFrame, Machine]:
        expand = PolynomialExpansion(degree=degree, inputCol="features", outputCol="expanded")

        def expanded(df: DataFrame) -> DataFrame:
            return expand.transform(df).select("label", F.col("expanded").alias("features"))

        turn = orthonormal(expanded(train), "features")
        ready = turn(expanded(train))
        return float(degree), ready, turn(expanded(validation)), fit_machine(ready, 1 / rows, GAP)

    found = _in_parallel([lambda d=d: fit(d) for d in degrees], threads)
    return _machine_table(found, "degree", train.sparkSession)


def hinge_svm(train: DataFrame, validation: DataFrame, penalties: Sequence[float], threads: int = 4) -> DataFrame:
    """Mean hinge loss + penalty |w|^2, fitted to a certified gap; the gap of penalty 0 is that of 5e-7."""
    return _machines(train, validation, {p: 2 * p for p in penalties}, "penalty", threads)


#: Rows closest to being misclassified that are kept between two passes of the perceptron.
NEAR_ROWS = 8192


def _said(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return (x @ weights.T).argmax(axis=1)


def _add_wrong(total: np.ndarray, x: np.ndarray, truth: np.ndarray, said: np.ndarray) -> None:
    wrong = said != truth
    np.add.at(total, truth[wrong], x[wrong])
    np.subtract.at(total, said[wrong], x[wrong])


def _margins(x: np.ndarray, truth: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """How far the true class leads, in units of the row's length: less rounding error, so a bound from below.

    While no difference of two classes' weights has moved that far, the row stays correct.
    """
    length = np.sqrt(np.einsum("ij,ij->i", x, x))
    scores = x @ weights.T
    own = scores[np.arange(len(x)), truth]
    scores[np.arange(len(x)), truth] = -np.inf
    rounding = 8 * np.finfo(np.float64).eps * (x.shape[1] + 2) * np.sqrt((weights**2).sum(axis=1)).max()
    return (own - scores.max(axis=1)) / length - rounding


def _pass(current: np.ndarray, kept: int):
    """Of one task: the correction of every class, the ``kept`` rows of least margin, and the least margin left out."""

    def run(batches):
        total = np.zeros_like(current)
        held = [np.zeros(0), np.zeros(0, np.int32), np.zeros((0, current.shape[1]))]
        beyond = np.inf
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = block(batch.column(0))
            x = np.hstack([np.ones((len(x), 1)), x])
            truth = batch.column(1).to_numpy()
            _add_wrong(total, x, truth, _said(x, current))
            held = [np.concatenate(c) for c in zip(held, (_margins(x, truth, current), truth, x))]
            if len(held[0]) > kept:
                order = np.argpartition(held[0], kept)
                beyond = min(beyond, held[0][order[kept]])
                held = [c[order[:kept]] for c in held]
        classes = len(current)
        vectors = np.vstack([total, held[2]])
        ends = np.arange(len(vectors) + 1, dtype=np.int32) * current.shape[1]
        columns = [
            pa.array(np.append(np.zeros(classes, bool), np.ones(len(held[0]), bool))),
            pa.array(np.append(np.arange(classes, dtype=np.int32), held[1].astype(np.int32))),
            pa.array(np.append(np.full(classes, beyond), held[0])), pa.ListArray.from_arrays(pa.array(ends), pa.array(vectors.ravel())),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["near", "label", "margin", "x"])

    return run


def perceptron(df: DataFrame, classes: int, size: int, max_epochs: int | None = None, near_rows: int = NEAR_ROWS) -> np.ndarray:
    """Multiclass perceptron in batch form: classes x (1 + size) weights.

    Each epoch adds up, over all misclassified rows, (1, x) for the true class and takes it off
    the predicted one, until no row is misclassified.  On classes that no weights can tell apart this
    never ends; ``max_epochs`` stops it there.
    df: (features, label) with labels 0 .. classes - 1.

    A pass over the table gives the correction of its epoch, each task's sums, and the about ``near_rows``
    rows whose margin is least.  A row can only become wrong once the weights have moved further than its margin:
    until they have moved as far as the least margin that was left out, the wrong rows of the epochs that
    follow are among those few, and these epochs need no pass.  They are the same epochs, none is left out.
    """
    if max_epochs is not None and max_epochs < 1:
        raise ValueError("max_epochs must be at least 1")
    weights = np.zeros((classes, size + 1))
    rows = df.select("features", F.col("label").cast("int").alias("label")).persist(StorageLevel.MEMORY_AND_DISK)
    left = math.inf if max_epochs is None else max_epochs
    try:
        # (from weights of 0 no epoch goes without a pass; the first one counts the tasks)
        kept = 1
        while left > 0:
            found = rows.mapInArrow(_pass(weights, kept), "near boolean, label int, margin double, x array<double>").toArrow()
            near = found.column("near").to_numpy(zero_copy_only=False)
            if near.all():
                return weights
            kept = max(1, near_rows * classes // int((~near).sum()))
            label, margin, x = found.column("label").to_numpy(), found.column("margin").to_numpy(), block(found.column("x"))
            # classes' sums come first, with the least margin that their task left out
            reach = margin[~near].min(initial=np.inf)
            moved = weights.copy()
            np.add.at(moved, label[~near], x[~near])
            left -= 1
            if np.array_equal(moved, weights):
                return weights
            start, weights = weights, moved
            truth, x = label[near], x[near]
            while left > 0:
                change = weights - start
                steps = change[:, None, :] - change[None, :, :]
                if np.sqrt((steps**2).sum(axis=2)).max() * (1 + 1e-9) >= reach:
                    break
                total = np.zeros_like(weights)
                _add_wrong(total, x, truth, _said(x, weights))
                moved = weights + total
                left -= 1
                if np.array_equal(moved, weights):
                    return weights
                weights = moved
    finally:
        rows.unpersist()
    return weights


def principal_projection(df: DataFrame, k: int, features: str = "features") -> DataFrame:
    """Rows projected, uncentred, on the first k principal directions of the centred data.

    The sign of a direction is free; it is set so that its largest component is positive.
    """
    ready = df.withColumn("_x", array_to_vector(F.col(features).cast("array<double>")))
    model = PCA(k=k, inputCol="_x", outputCol="_p").fit(ready)
    axes = model.pc.toArray()
    signs = [1.0 if axes[np.abs(axes[:, i]).argmax(), i] > 0 else -1.0 for i in range(k)]
    values = vector_to_array("_p")
    turned = F.array(*[values[i] * s for i, s in enumerate(signs)])
    return model.transform(ready).withColumn("projection", turned).drop("_x", "_p")


def moment_matrix(df: DataFrame, terms: Sequence[Column]) -> np.ndarray:
    """Sums of all products of the terms: one aggregate, a few numbers on the driver."""
    n = len(terms)
    pairs = [(i, j) for i in range(n) for j in range(i, n)]
    row = df.agg(*[F.sum(terms[i] * terms[j]).alias(f"m{i}_{j}") for i, j in pairs]).first()
    out = np.zeros((n, n))
    for (i, j), value in zip(pairs, row, strict=True):
        out[i, j] = out[j, i] = value
    return out


def rational_fit(df: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """y = (a + bx + cx^2) / (1 + dx + ex^2) by least squares on its linear form."""
    u, v = F.col(x), F.col(y)
    m = moment_matrix(df, [F.lit(1.0), u, u * u, -u * v, -u * u * v, v])
    found = np.linalg.lstsq(m[:5, :5], m[:5, 5], rcond=None)[0]
    return named_values(df.sparkSession, dict(zip("abcde", found, strict=True)))


def rational_fit_unit(df: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """(d + ex + fx^2) y = a + bx + cx^2 with coefficients of norm 1, their first one above zero
    being the largest: the direction in which the linear form varies least."""
    u, v = F.col(x), F.col(y)
    m = moment_matrix(df, [F.lit(-1.0), -u, -u * u, v, u * v, u * u * v])
    found = np.linalg.eigh(m)[1][:, 0]
    found = found * (1.0 if found[np.abs(found).argmax()] > 0 else -1.0)
    return named_values(df.sparkSession, dict(zip("abcdef", found, strict=True)))
