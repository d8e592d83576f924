"""Queries that fit models, and series queries."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F

from tallgrass.catalog import fixtures as fx
from tallgrass.catalog import linear_sql as la
from tallgrass.catalog.reading_queries import learning
from tallgrass.catalog.registry import Tables, query
from tallgrass.functions import vectors as vec
from tallgrass.operators import models as ml
from tallgrass.operators import series as se
from tallgrass.operators import trees as tr
from tallgrass.plans.lineage import cut_lineage
from tallgrass.plans.splits import hash_split

_WHOLE = " AND ".join(f'"{c}" IS NOT NULL' for c in ("PRCP", "Elevation", *ml.RAIN_FEATURES))
_FEATURE_ROWS = " UNION ALL ".join(
    f'SELECT "StationId", "Year_Rec", "Month_Rec", "PRCP" AS label, {i} AS pos, "{c}" AS value FROM learning WHERE {_WHOLE}'
    for i, c in enumerate(ml.RAIN_FEATURES)
)
_KEYS = ["StationId", "Year_Rec", "Month_Rec"]


def _rain(t: Tables) -> DataFrame:
    return ml.assemble(learning(t).na.drop("any"), keep=_KEYS)


def _split_rain(t: Tables) -> DataFrame:
    named = _rain(t).withColumn("row_id", F.concat_ws("/", *_KEYS))
    # written once: a fit and its evaluation go over the table many times
    return cut_lineage(hash_split(named, "row_id", 0.7, seed=11).select(*_KEYS, "label", "features", "is_train"))


def _rain_split(t: Tables) -> tuple[DataFrame, DataFrame]:
    parts = _split_rain(t).select("label", "features", "is_train")
    return parts.where("is_train").drop("is_train"), parts.where("NOT is_train").drop("is_train")


@query("ml_assemble", f"WITH {fx.LEARNING_SQL} {_FEATURE_ROWS}")
def ml_assemble(t: Tables) -> DataFrame:
    return _rain(t).select(*_KEYS, "label", F.posexplode(vector_to_array("features")).alias("pos", "value"))


STRENGTH, MIX = 0.3, 0.8


def _optimum_sql(sweeps: int) -> str:
    """The elastic-net optimum by coordinate descent on the moments, one coordinate a step: fit (b, intercept).

    ``rain`` holds the rows with their side of the split; ``moments`` the numbers of the training rows.
    """
    names = [f'"{c}"' for c in ml.RAIN_FEATURES]
    n = len(names)
    limit = format(int(0.7 * 2**32), "08x")
    spread = ", ".join(f"stddev_pop({c})" for c in names)
    gram = ", ".join("[" + ", ".join(f"covar_pop({a}, {b})" for b in names) + "]" for a in names)
    cross = ", ".join(f"covar_pop({c}, y)" for c in names)
    return f"""
rain AS (
  SELECT "StationId", "Year_Rec", "Month_Rec", "PRCP" AS y, {", ".join(names)},
         substr(md5('11:' || "StationId" || '/' || "Year_Rec" || '/' || "Month_Rec"), 1, 8) < '{limit}' AS is_train
  FROM learning WHERE {_WHOLE}
), raw AS (
  SELECT [{spread}] AS s, [{", ".join(f"avg({c})" for c in names)}] AS m, [{gram}] AS g, [{cross}] AS c, avg(y) AS ym, stddev_pop(y) AS ys
  FROM rain WHERE is_train
), moments AS (
  SELECT s, m, ym, {STRENGTH} * {MIX} AS l1, {STRENGTH} * (1 - {MIX}) / ys AS l2,
         list_transform(g, lambda r, i: list_transform(r, lambda v, j: CASE WHEN s[i] * s[j] > 0 THEN v / (s[i] * s[j]) ELSE 0 END)) AS g,
         list_transform(c, lambda v, i: CASE WHEN s[i] > 0 THEN v / s[i] ELSE 0 END) AS c
  FROM raw
), steps AS (
  SELECT 0 AS step, list_transform(range({n}), lambda i: 0.0::DOUBLE) AS w
  UNION ALL
  SELECT step + 1, list_transform(w, lambda v, i: CASE WHEN i - 1 = step % {n}
           THEN sign(c[i] - list_dot_product(g[i], w) + v * g[i][i]) * greatest(abs(c[i] - list_dot_product(g[i], w) + v * g[i][i]) - l1, 0) / (1 + l2)
           ELSE v END)
  FROM steps, moments WHERE step < {n * sweeps}
), fit AS (
  SELECT list_transform(w, lambda v, i: CASE WHEN s[i] > 0 THEN v / s[i] ELSE 0 END) AS b,
         ym - list_dot_product(list_transform(w, lambda v, i: CASE WHEN s[i] > 0 THEN v / s[i] ELSE 0 END), m) AS intercept
  FROM steps, moments WHERE step = {n * sweeps}
), fitted AS (
  SELECT "StationId", "Year_Rec", "Month_Rec", y, is_train, intercept + list_dot_product(b, [{", ".join(f"{c}::DOUBLE" for c in names)}]) AS p FROM rain, fit
)"""


_COEFFICIENT_ROWS = " UNION ALL ".join(f"SELECT 'coefficient {c}' AS name, b[{i}] AS value FROM fit" for i, c in enumerate(ml.RAIN_FEATURES, 1))
_ERROR_ROWS = " UNION ALL ".join(
    f"SELECT '{side} rmse', sqrt(avg((y - p) * (y - p))) FROM fitted WHERE {where} "
    f"UNION ALL SELECT '{side} r2', 1 - avg((y - p) * (y - p)) / var_pop(y) FROM fitted WHERE {where}"
    for side, where in (("train", "is_train"), ("test", "NOT is_train"))
)


@query("ml_linreg", f"""
WITH RECURSIVE {fx.LEARNING_SQL}, {_optimum_sql(200)}
SELECT name, round(value, 5) AS value FROM (
  {_COEFFICIENT_ROWS} UNION ALL SELECT 'intercept', intercept FROM fit UNION ALL {_ERROR_ROWS}
  UNION ALL SELECT 'violation', 0 UNION ALL SELECT 'excess after 10 iterations', 0)
""")
def ml_linreg(t: Tables) -> DataFrame:
    report = ml.elastic_net_report(*_rain_split(t), 10, STRENGTH, MIX)
    return report.withColumn("value", F.round("value", 5))


@query("ml_linreg_residuals", f"""
WITH RECURSIVE {fx.LEARNING_SQL}, {_optimum_sql(200)}
SELECT "StationId", "Year_Rec", "Month_Rec", is_train, y AS label, round(p, 4) AS prediction, round(y - p, 4) AS residual FROM fitted
""")
def ml_linreg_residuals(t: Tables) -> DataFrame:
    rows = _split_rain(t)
    fit = ml.elastic_net(rows.where("is_train"), STRENGTH, MIX)
    found = ml.residuals(rows, fit)
    return found.select(*_KEYS, "is_train", "label", F.round("prediction", 4).alias("prediction"), F.round("residual", 4).alias("residual"))


DEPTH, BINS = 5, 32


def _tree_sql(depth: int, bins: int) -> str:
    """CTEs that grow a tree one level a step: split0 .. split{depth - 1}, and fitted (every row with node and p)."""
    n = len(ml.RAIN_FEATURES)
    limit = format(int(0.7 * 2**32), "08x")
    ends = ", ".join(f"[{', '.join(f'{f}(x[{i}])' for i in range(1, n + 1))}] AS {name}" for name, f in (("lo", "min"), ("hi", "max")))
    steps = [f"""
rain AS (
  SELECT "StationId", "Year_Rec", "Month_Rec", "PRCP"::DOUBLE AS y, [{", ".join(f'"{c}"::DOUBLE' for c in ml.RAIN_FEATURES)}] AS x,
         substr(md5('11:' || "StationId" || '/' || "Year_Rec" || '/' || "Month_Rec"), 1, 8) < '{limit}' AS is_train
  FROM learning WHERE {_WHOLE}
), ends AS (SELECT {ends}, avg(y) AS mean, count(*) * var_pop(y) AS scatter FROM rain WHERE is_train
), node0 AS (
  SELECT rain.* EXCLUDE (x), y - mean AS z, 1 AS node, list_transform(x, lambda v, i: CASE WHEN hi[i] > lo[i]
    THEN greatest(0, least({bins - 1}, floor((v - lo[i]) * {bins} / (hi[i] - lo[i]))))::INT ELSE 0 END) AS b
  FROM rain, ends
)"""]
    for k in range(depth):
        steps.append(f"""sums{k} AS (
  SELECT node, f, b[f + 1] AS bin, count(*) AS n, sum(z) AS s FROM node{k}, range({n}) r(f)
  WHERE is_train AND node >= {1 << k} GROUP BY ALL
), sides{k} AS (
  SELECT node, f, bin, sum(n) OVER w AS nl, sum(s) OVER w AS sl, sum(n) OVER (PARTITION BY node, f) AS nt, sum(s) OVER (PARTITION BY node, f) AS st
  FROM sums{k} WINDOW w AS (PARTITION BY node, f ORDER BY bin)
), split{k} AS (
  SELECT * FROM (
    SELECT node, f, bin, round((sl * sl / nl + (st - sl) * (st - sl) / (nt - nl) - st * st / nt) / scatter, 9) AS gain
    FROM sides{k}, ends WHERE nl < nt AND scatter > 0
  ) WHERE gain > 0 QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, bin) = 1
), node{k + 1} AS (
  SELECT t.* REPLACE (CASE WHEN p.node IS NULL THEN t.node WHEN b[p.f + 1] > p.bin THEN 2 * t.node + 1 ELSE 2 * t.node END AS node)
  FROM node{k} t LEFT JOIN split{k} p ON t.node = p.node
)""")
    steps.append(f"""leaves AS (SELECT node, avg(z) AS p FROM node{depth} WHERE is_train GROUP BY node
), fitted AS (SELECT t.*, p + mean AS p FROM node{depth} t JOIN leaves USING (node), ends
), splits AS ({" UNION ALL ".join(f"SELECT * FROM split{k}" for k in range(depth))})""")
    return ",\n".join(steps)


def _grown(t: Tables) -> tuple[tr.Tree, DataFrame]:
    rows = _split_rain(t)
    return tr.grow_tree(rows.where("is_train"), len(ml.RAIN_FEATURES), DEPTH, BINS), rows


@query("ml_tree_reg", f"""
WITH {fx.LEARNING_SQL}, {_tree_sql(DEPTH, BINS)}, names AS (
  {" UNION ALL ".join(f"SELECT {i} AS f, 'importance {c}' AS name" for i, c in enumerate(ml.RAIN_FEATURES))}
)
SELECT name, round(value, 6) AS value FROM (
  SELECT name, coalesce(sum(gain) / (SELECT sum(gain) FROM splits), 0) AS value FROM names LEFT JOIN splits USING (f) GROUP BY name
  UNION ALL {_ERROR_ROWS})
""")
def ml_tree_reg(t: Tables) -> DataFrame:
    tree, rows = _grown(t)
    found = {f"importance {n}": v for n, v in zip(ml.RAIN_FEATURES, tree.importances(), strict=True)}
    scored = rows.select("is_train", "label", tree.prediction().alias("prediction"))
    for side, where in (("train", "is_train"), ("test", "NOT is_train")):
        errors = ml.regression_metrics(scored.where(where)).first()
        found |= {f"{side} {m}": errors[m] for m in ("rmse", "r2")}
    return ml.named_values(t.spark, found).withColumn("value", F.round("value", 6))


@query("ml_tree_splits", f"""
WITH {fx.LEARNING_SQL}, {_tree_sql(DEPTH, BINS)}
SELECT node, list_extract({list(ml.RAIN_FEATURES)}, f::INT + 1) AS feature, bin,
       round(lo[f + 1] + (bin + 1) * (hi[f + 1] - lo[f + 1]) / {BINS}, 6) AS threshold, round(gain, 6) AS gain
FROM splits, ends
""")
def ml_tree_splits(t: Tables) -> DataFrame:
    tree, _ = _grown(t)
    rows = [(s.node, ml.RAIN_FEATURES[s.feature], s.bin, s.threshold, s.gain) for s in tree.splits.values()]
    found = t.spark.createDataFrame(rows, "node int, feature string, bin int, threshold double, gain double")
    return found.select("node", "feature", "bin", F.round("threshold", 6).alias("threshold"), F.round("gain", 6).alias("gain"))


@query("ml_tree_predictions", f"""
WITH {fx.LEARNING_SQL}, {_tree_sql(DEPTH, BINS)}
SELECT "StationId", "Year_Rec", "Month_Rec", is_train, y AS label, node AS leaf, round(p, 4) AS prediction FROM fitted
""")
def ml_tree_predictions(t: Tables) -> DataFrame:
    tree, rows = _grown(t)
    return rows.select(*_KEYS, "is_train", "label", tree.leaf().alias("leaf"), F.round(tree.prediction(), 4).alias("prediction"))


@query("ml_reg_metrics", f"""
WITH {fx.LEARNING_SQL}, e AS (SELECT "PRCP" AS y, "ONE_YEAR_PRCP" AS p FROM learning WHERE {_WHOLE})
SELECT round(sqrt(avg((y - p) * (y - p))), 6) AS rmse, round(1 - avg((y - p) * (y - p)) / var_pop(y), 6) AS r2 FROM e
""")
def ml_reg_metrics(t: Tables) -> DataFrame:
    # the value of the year before as the prediction
    rows = learning(t).na.drop("any").withColumn("prediction", F.col("ONE_YEAR_PRCP"))
    found = ml.regression_metrics(rows, label="PRCP")
    return found.select(F.round("rmse", 6).alias("rmse"), F.round("r2", 6).alias("r2"))


def _labelled(t: Tables, label: str = "label", size: int | None = None) -> DataFrame:
    """Embeddings as model input; ``size`` chooses the first features, as the two-feature models do."""
    features = vec.to_doubles("embedding")
    features = F.slice(features, 1, size) if size else features
    return t.embeddings.select(
        F.col("vec_id").alias("id"), F.expr(label).cast("double").alias("label"), array_to_vector(features).alias("features")
    )


def _labelled_split(t: Tables, label: str = "label", size: int | None = None) -> tuple[DataFrame, DataFrame]:
    parts = hash_split(_labelled(t, label, size), "id", 0.7, seed=7)
    return parts.where("is_train").drop("is_train"), parts.where("NOT is_train").drop("is_train")


TWO_CLASSES = "label < 5"
# classes that the first two features tell apart but for a share of noise, which the third brings in
RING = "embedding[0] * embedding[0] + embedding[1] * embedding[1] + embedding[2] / 50 > 0.025"
SLOPE = "embedding[0] + embedding[1] / 2 + embedding[2] / 4 > 0"


@query("ml_cv_error")
def ml_cv_error(t: Tables) -> DataFrame:
    rows = _labelled(t)
    total = rows.count()
    train, validation, gradient = ml.cross_validation(rows, ["id"], [ml.logistic(1.0, total - total // 5)], 5)[0]
    return ml.named_values(t.spark, {"train error": train, "validation error": validation, "gradient": gradient})


@query("ml_logreg_grid")
def ml_logreg_grid(t: Tables) -> DataFrame:
    train, test = _labelled_split(t)
    return ml.logistic_grid(train, test, ["id"], [1e-4, 1e-2, 1, 1e2, 1e4], threads=8)


@query("ml_linear_svm")
def ml_linear_svm(t: Tables) -> DataFrame:
    return ml.linear_svm(*_labelled_split(t, TWO_CLASSES), costs=[0.01, 0.05, 0.1])


@query("ml_poly_svm")
def ml_poly_svm(t: Tables) -> DataFrame:
    return ml.polynomial_svm(*_labelled_split(t, RING, size=2), degrees=range(2, 9), threads=8)


@query("ml_hinge_svm")
def ml_hinge_svm(t: Tables) -> DataFrame:
    return ml.hinge_svm(*_labelled_split(t, SLOPE, size=2), penalties=[0, 0.05, 0.1, 0.2, 0.5], threads=8)


CLASSES = 10


def _perceptron_sql() -> str:
    """Epochs of scoring and correcting until no row is wrong; w holds one class after the other, x has a leading 1."""
    size = CLASSES + 1
    return f"""
WITH RECURSIVE x AS (
  SELECT label, list_prepend(1.0::DOUBLE, list_transform(embedding[1:{CLASSES}], lambda e, i: e::DOUBLE + CASE WHEN i - 1 = label THEN 1 ELSE 0 END)) AS v
  FROM embeddings
), t AS (
  SELECT 0 AS step, list_transform(range({CLASSES * size}), lambda i: 0.0::DOUBLE) AS w, 1::BIGINT AS wrong
  UNION ALL
  SELECT step + 1, list(w + change ORDER BY i), any_value(wrong) FROM (
    SELECT step, i, any_value(w[i + 1]) AS w, count(*) FILTER (WHERE said <> label) AS wrong,
           sum(CASE WHEN said = label THEN 0 WHEN i // {size} = label THEN v[i % {size} + 1] WHEN i // {size} = said THEN -v[i % {size} + 1] ELSE 0 END) AS change
    FROM (SELECT step, w, label, v, list_position(score, list_max(score)) - 1 AS said FROM (
            SELECT step, w, label, v, list_transform(range({CLASSES}), lambda c: list_dot_product(v, w[c * {size} + 1:(c + 1) * {size}])) AS score
            FROM t, x WHERE wrong > 0)), range({CLASSES * size}) r(i)
    GROUP BY step, i) GROUP BY step
)"""


@query("ml_perceptron", _perceptron_sql() + f"""
SELECT CAST(i // {CLASSES + 1} AS INTEGER) AS class, CAST(i % {CLASSES + 1} AS INTEGER) AS pos, round(w[i + 1], 6) AS value
FROM (SELECT w FROM t WHERE wrong = 0), range({CLASSES * (CLASSES + 1)}) r(i)
""")
def ml_perceptron(t: Tables) -> DataFrame:
    # the label's own feature stands out by 1, so the classes can be told apart and the epochs end
    lifted = F.transform(F.slice(vec.to_doubles("embedding"), 1, CLASSES), lambda e, i: e + (i == F.col("label")).cast("int"))
    weights = ml.perceptron(t.embeddings.select(lifted.alias("features"), "label"), CLASSES, CLASSES)
    frame = t.spark.createDataFrame([(i, w.tolist()) for i, w in enumerate(weights)], "class int, w array<double>")
    return frame.select("class", F.posexplode("w").alias("pos", "value")).withColumn("value", F.round("value", 6))


@query("ml_pca", f"""
WITH points AS (SELECT vec_id AS id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings),
{la.two_directions('points')}
SELECT id, 0 AS axis, round(sum(p.x * v.x), 4) AS value FROM points p JOIN d1v v ON v.i = p.pos GROUP BY id
UNION ALL SELECT id, 1, round(sum(p.x * v.x), 4) FROM points p JOIN d2v v ON v.i = p.pos GROUP BY id
""")
def ml_pca(t: Tables) -> DataFrame:
    rows = t.embeddings.select(F.col("vec_id").alias("id"), vec.to_doubles("embedding").alias("features"))
    return _rounded_axes(ml.principal_projection(rows, 2), "id")


def _rounded_axes(projected: DataFrame, *keys: str) -> DataFrame:
    axes = projected.select(*keys, F.posexplode("projection").alias("axis", "value"))
    return axes.withColumn("value", F.round("value", 4))


def _curve(t: Tables) -> DataFrame:
    return t.lineitem.select((F.col("l_quantity") / 50).alias("x"), (F.col("l_extendedprice") / 100000).alias("y"))


def _moments_sql(*terms: str) -> str:
    """Sums of all products of the terms as a matrix table ``m``."""
    cells = " UNION ALL ".join(
        f"SELECT {i} AS i, {j} AS j, sum(({a}) * ({b})) AS v FROM c" for i, a in enumerate(terms) for j, b in enumerate(terms)
    )
    return f"WITH c AS (SELECT l_quantity / 50 AS x, l_extendedprice / 100000 AS y FROM lineitem), m AS ({cells})"


@query("ml_least_squares", f"""
{_moments_sql('1.0', 'x', 'x * x', '-x * y', '-x * x * y', 'y')}, rows5 AS (SELECT * FROM m WHERE i < 5), {la.gauss_jordan('rows5', 5)}
SELECT chr(CAST(97 + i AS INTEGER)) AS name, round(v, 4) AS value FROM g5 WHERE j = 5
""")
def ml_least_squares(t: Tables) -> DataFrame:
    return ml.rational_fit(_curve(t)).withColumn("value", F.round("value", 4))


@query("ml_total_least_squares", f"""
{_moments_sql('-1.0', '-x', '-x * x', 'y', 'x * y', 'x * x * y')},
wide AS (SELECT * FROM m UNION ALL SELECT i, j + 6, CAST(i = j AS INTEGER) FROM m),
{la.gauss_jordan('wide', 6)},
inverse AS (SELECT i, j - 6 AS j, v FROM g6 WHERE j >= 6),
{la.leading_vector('inverse', 7, 'd1')}
SELECT chr(CAST(97 + i AS INTEGER)) AS name, round(x, 4) AS value FROM d1v
""")
def ml_total_least_squares(t: Tables) -> DataFrame:
    return ml.rational_fit_unit(_curve(t)).withColumn("value", F.round("value", 4))


YEAR, PERIODS = 1996, 12

_SERIES = f"""
WITH {fx.PRICES_SQL},
of_year AS (SELECT * FROM prices WHERE date LIKE '{YEAR}%'),
whole AS (SELECT symbol FROM of_year GROUP BY symbol HAVING count(*) = {PERIODS}),
complete AS (SELECT * FROM of_year WHERE symbol IN (SELECT symbol FROM whole))
"""


def _six(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.round(column, 6))


@query("flt_year_symbol", f"""
WITH {fx.PRICES_SQL} SELECT symbol, date, round(close, 6) AS close FROM prices WHERE date LIKE '{YEAR}%' AND symbol = '7'
""")
def flt_year_symbol(t: Tables) -> DataFrame:
    return _six(se.of_year(fx.prices(t), YEAR, "7"), "close")


@query("join_symbol_sector", f"""
{_SERIES} SELECT symbol, date, round(close, 6) AS close, sector FROM of_year JOIN securities USING (symbol)
""")
def join_symbol_sector(t: Tables) -> DataFrame:
    return _six(se.with_sector(se.of_year(fx.prices(t), YEAR), fx.securities(t)), "close")


@query("agg_complete_series", f"{_SERIES} SELECT symbol, date, round(close, 6) AS close FROM complete")
def agg_complete_series(t: Tables) -> DataFrame:
    return _six(se.complete(se.of_year(fx.prices(t), YEAR), PERIODS), "close")


@query("ser_load_complete", f"""
{_SERIES} SELECT symbol, date, round(close, 6) AS close, sector FROM complete JOIN securities USING (symbol)
""")
def ser_load_complete(t: Tables) -> DataFrame:
    return _six(se.load_complete(fx.prices(t), fx.securities(t), YEAR, PERIODS), "close")


@query("win_log_return", f"""
{_SERIES}
SELECT symbol, date, round(log_return, 6) AS log_return FROM (
  SELECT symbol, date, ln(close) - lag(ln(close)) OVER (PARTITION BY symbol ORDER BY date) AS log_return FROM complete)
WHERE log_return IS NOT NULL
""")
def win_log_return(t: Tables) -> DataFrame:
    returns = se.log_returns(se.complete(se.of_year(fx.prices(t), YEAR), PERIODS))
    return _six(returns, "log_return").select("symbol", "date", "log_return")


@query("ser_project_sector", f"""
{_SERIES},
points AS (
  SELECT symbol AS id, row_number() OVER (PARTITION BY symbol ORDER BY date) - 1 AS pos, x FROM (
    SELECT symbol, date, ln(close) - lag(ln(close)) OVER (PARTITION BY symbol ORDER BY date) AS x
    FROM complete JOIN securities USING (symbol)) WHERE x IS NOT NULL),
{la.two_directions('points')},
projected AS (
  SELECT id, 0 AS axis, sum(p.x * v.x) AS value FROM points p JOIN d1v v ON v.i = p.pos GROUP BY id
  UNION ALL SELECT id, 1, sum(p.x * v.x) FROM points p JOIN d2v v ON v.i = p.pos GROUP BY id)
SELECT id AS symbol, sector, axis, round(value, 4) AS value FROM projected JOIN securities ON symbol = id
WHERE sector IN ('NATION_3', 'NATION_4', 'NATION_5')
""")
def ser_project_sector(t: Tables) -> DataFrame:
    closes = se.load_complete(fx.prices(t), fx.securities(t), YEAR, PERIODS)
    vectors = se.as_vectors(se.log_returns(closes), "log_return", "sector")
    projected = ml.principal_projection(vectors, 2).where(F.col("sector").isin("NATION_3", "NATION_4", "NATION_5"))
    return _rounded_axes(projected, "symbol", "sector")


SWEEPS = 100

# One point of every series per step.  A series of n points is done after (SWEEPS + 1) * n steps,
# or when a whole sweep has changed nothing: prev holds x as it was when the sweep began.
_DENOISE = f"""
WITH RECURSIVE signal AS (
  SELECT series, list(pos ORDER BY pos) AS places, list(value ORDER BY pos) AS s FROM (
    SELECT l_suppkey AS series, CAST(strftime(l_shipdate, '%Y%m') AS INTEGER) AS pos, avg(l_quantity) AS value FROM lineitem GROUP BY ALL)
  GROUP BY series),
sweep(series, places, s, x, prev, step) USING KEY (series) AS (
  SELECT series, places, s, s, s, 0 FROM signal
  UNION
  SELECT series, places, s, x[:k - 1] || [CASE WHEN s[k] < low THEN least(s[k] + 1 / mu, low)
                                             WHEN s[k] > high THEN greatest(s[k] - 1 / mu, high) ELSE s[k] END] || x[k + 1:],
         CASE WHEN k = 1 THEN x ELSE prev END, step + 1
  FROM (
    SELECT *, least(x[lft], x[rgt]) AS low, greatest(x[lft], x[rgt]) AS high, CASE WHEN k IN (1, n) THEN 1.0 ELSE 0.5 END AS mu FROM (
      SELECT *, CASE WHEN k = 1 THEN 2 ELSE k - 1 END AS lft, CASE WHEN k = n THEN n - 1 ELSE k + 1 END AS rgt FROM (
        SELECT *, len(s) AS n, step % len(s) + 1 AS k FROM sweep)))
  WHERE n > 1 AND step < {SWEEPS + 1} * n AND NOT (k = 1 AND step > 0 AND x = prev))
SELECT series, unnest(places) AS pos, round(unnest(s), 6) AS value, round(unnest(x), 6) AS smooth FROM sweep
"""


@query("ser_denoise", _DENOISE)
def ser_denoise(t: Tables) -> DataFrame:
    monthly = t.lineitem.groupBy(
        F.col("l_suppkey").alias("series"), F.date_format("l_shipdate", "yyyyMM").cast("int").alias("pos")
    ).agg(F.avg("l_quantity").alias("value"))
    return _six(_six(se.denoise(monthly, alpha=0.5, sweeps=SWEEPS), "value"), "smooth")
