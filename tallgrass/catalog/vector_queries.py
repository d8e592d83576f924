"""Queries over labelled vectors: moments, neighbours, trimmed k-means."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tallgrass.catalog.registry import Tables, query
from tallgrass.functions import vectors as vec
from tallgrass.operators import clusters as cl
from tallgrass.operators import neighbours as nb
from tallgrass.plans.splits import shuffled

SEED = 42
K = 5
SWEEP = 20
CURVE = (20, 40, 60, 80)  # training share in percent

# e: rows in the seeded order; the first two thirds train, the rest asks
_SPLIT = f"""
WITH e AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v, count(*) OVER () AS total,
         row_number() OVER (ORDER BY md5('{SEED}:' || vec_id), vec_id) - 1 AS pos FROM embeddings),
train AS (SELECT * FROM e WHERE pos < total * 2 // 3),
test AS (SELECT * FROM e WHERE pos >= total * 2 // 3)
"""


def _ranked(p: int, k: int, asks: str = "test", train: str = "train", part: str = "0", on: str = "TRUE") -> str:
    gap = "list_sum(list_transform(list_zip(q.v, t.v), lambda x: {}))"
    dist = f"sqrt({gap.format('(x[1] - x[2]) * (x[1] - x[2])')})" if p == 2 else gap.format("abs(x[1] - x[2])")
    return f"""ranked AS (
  SELECT *, row_number() OVER (PARTITION BY part, query_id ORDER BY dist, label, train_id) AS rank FROM (
    SELECT {part} AS part, q.vec_id AS query_id, q.label AS truth, t.vec_id AS train_id, t.label AS label, {dist} AS dist
    FROM {asks} q JOIN {train} t ON {on})
  QUALIFY rank <= {k})"""


def _votes(keys: str, source: str) -> str:
    return f"""votes AS (
  SELECT {keys}, label AS prediction, truth FROM (
    SELECT {keys}, label, any_value(truth) AS truth, count(*) AS n, min(dist) AS d FROM {source} GROUP BY {keys}, label)
  QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY n DESC, d, label) = 1)"""


def _points(t: Tables) -> DataFrame:
    return t.embeddings.select(F.col("vec_id").alias("id"), vec.to_doubles("embedding").alias("features"), "label")


def _positions(t: Tables) -> tuple[DataFrame, int]:
    rows = _points(t)
    return shuffled(rows, "id", SEED), rows.count()


def _queries_of(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("id").alias("query_id"), "features")


def _train_of(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("id").alias("train_id"), "features", "label")


def _split(t: Tables) -> tuple[DataFrame, DataFrame]:
    rows, total = _positions(t)
    train = F.col("pos") < total * 2 // 3
    return rows.where(train), rows.where(~train)


def _rounded(found: DataFrame) -> DataFrame:
    return found.select("query_id", "rank", "train_id", "label", F.round("dist", 6).alias("dist"))


_RANK_COLUMNS = "SELECT query_id, rank, train_id, label, round(dist, 6) AS dist FROM ranked"


@query("join_knn_cross", f"{_SPLIT}, {_ranked(1, 3)} {_RANK_COLUMNS}")
def join_knn_cross(t: Tables) -> DataFrame:
    train, test = _split(t)
    return _rounded(nb.nearest(_queries_of(test), _train_of(train), 3, p=1.0))


@query("win_knn_rank", f"{_SPLIT}, {_ranked(2, K)} {_RANK_COLUMNS}")
def win_knn_rank(t: Tables) -> DataFrame:
    train, test = _split(t)
    return _rounded(nb.nearest(_queries_of(test), _train_of(train), K))


@query("ml_knn", f"{_SPLIT}, {_ranked(2, K)}, {_votes('query_id', 'ranked')} SELECT query_id, prediction FROM votes")
def ml_knn(t: Tables) -> DataFrame:
    train, test = _split(t)
    return nb.vote(nb.nearest(_queries_of(test), _train_of(train), K))


def _error(predictions: DataFrame, truth: DataFrame, *keys: str) -> DataFrame:
    scored = predictions.join(truth, "query_id")
    wrong = F.avg((F.col("prediction") != F.col("label")).cast("int"))
    return scored.groupBy(*keys).agg(F.round(wrong, 6).alias("error"))


@query("agg_error_rate", f"""
{_SPLIT}, {_ranked(2, K)}, {_votes('query_id', 'ranked')}
SELECT round(avg(CAST(prediction <> truth AS INTEGER)), 6) AS error FROM votes
""")
def agg_error_rate(t: Tables) -> DataFrame:
    train, test = _split(t)
    truth = test.select(F.col("id").alias("query_id"), "label")
    return _error(nb.vote(nb.nearest(_queries_of(test), _train_of(train), K)), truth)


@query("ml_knn_sweep", f"""
{_SPLIT}, {_ranked(2, SWEEP, asks='e')},
each AS (SELECT r.*, u.k FROM ranked r, LATERAL (SELECT unnest(range(rank, {SWEEP + 1})) AS k) u),
{_votes('k, query_id', 'each')}
SELECT k, CASE WHEN pos < total * 2 // 3 THEN 'train' ELSE 'test' END AS side,
       round(avg(CAST(prediction <> truth AS INTEGER)), 6) AS error
FROM votes JOIN e ON vec_id = query_id GROUP BY 1, 2
""")
def ml_knn_sweep(t: Tables) -> DataFrame:
    rows, total = _positions(t)
    is_train = F.col("pos") < total * 2 // 3
    found = nb.nearest(_queries_of(rows), _train_of(rows.where(is_train)), SWEEP)
    side = F.when(is_train, "train").otherwise("test").alias("side")
    truth = rows.select(F.col("id").alias("query_id"), "label", side)
    return _error(nb.vote_for_each_k(found, SWEEP), truth, "k", "side")


@query("ml_learning_curve", f"""
{_SPLIT}, sizes AS (SELECT unnest([{', '.join(map(str, CURVE))}]) AS share),
asked AS (SELECT e.*, share FROM e JOIN sizes ON pos >= total * share // 100),
known AS (SELECT e.*, share FROM e JOIN sizes ON pos < total * share // 100),
{_ranked(2, K, asks='asked', train='known', part='q.share', on='q.share = t.share')},
{_votes('part, query_id', 'ranked')}
SELECT CAST(part AS INTEGER) AS share, round(avg(CAST(prediction = truth AS INTEGER)), 6) AS accuracy FROM votes GROUP BY 1
""")
def ml_learning_curve(t: Tables) -> DataFrame:
    # all sizes in one search: a row appears once per size on the side it falls on
    rows, total = _positions(t)
    shares = F.array(*[F.lit(s) for s in CURVE])
    sized = rows.withColumn("part", F.explode(shares))
    known = F.col("pos") < F.floor(F.lit(total) * F.col("part") / 100)
    asked = sized.where(~known).select("part", F.col("id").alias("query_id"), "features", "label")
    train = sized.where(known).select("part", F.col("id").alias("train_id"), "features", "label")
    votes = nb.vote(nb.nearest_by_part(asked, train, K), ("part", "query_id"))
    right = F.avg((F.col("prediction") == F.col("label")).cast("int"))
    return (
        votes.join(asked.select("part", "query_id", "label"), ["part", "query_id"])
        .groupBy(F.col("part").alias("share"))
        .agg(F.round(right, 6).alias("accuracy"))
    )


@query("join_pairwise_distance", """
SELECT a.vec_id AS id, round(sum(list_sum(list_transform(list_zip(a.embedding, b.embedding),
       lambda x: (x[1]::DOUBLE - x[2]::DOUBLE) * (x[1]::DOUBLE - x[2]::DOUBLE)))), 6) AS total
FROM embeddings a, embeddings b GROUP BY 1
""")
def join_pairwise_distance(t: Tables) -> DataFrame:
    totals = vec.squared_distance_totals(_points(t), "id")
    return totals.select("id", F.round("total", 6).alias("total"))


_LONG = """
WITH points AS (SELECT vec_id AS id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings)
"""


@query("agg_vector_mean", _LONG + """
SELECT label, CAST(pos AS INTEGER) AS pos, round(avg(x), 6) AS value FROM points GROUP BY ALL
""")
def agg_vector_mean(t: Tables) -> DataFrame:
    means = vec.group_means(_points(t), "label")
    return means.select("label", F.posexplode("mean").alias("pos", "value")).withColumn("value", F.round("value", 6))


@query("agg_gram", _LONG + """
, centred AS (SELECT id, pos, x - avg(x) OVER (PARTITION BY pos) AS x FROM points)
SELECT CAST(a.pos AS INTEGER) AS i, CAST(b.pos AS INTEGER) AS j, round(sum(a.x * b.x), 6) AS value
FROM centred a JOIN centred b ON a.id = b.id AND a.pos <= b.pos GROUP BY ALL
""")
def agg_gram(t: Tables) -> DataFrame:
    return vec.gram(_points(t)).withColumn("value", F.round("value", 6))


CENTRES, ROUNDS, EVERY = 3, 4, 5


def _kmeans_sql(rounds: int) -> str:
    """Rounds of assignment, ranking and averaging; c0 holds the start centres."""
    parts = [
        "p AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)",
        f"c0 AS (SELECT row_number() OVER (ORDER BY id) - 1 AS cluster, v FROM (SELECT * FROM p ORDER BY id LIMIT {CENTRES}))",
    ]
    for i in range(1, rounds + 1):
        parts.append(f"""a{i} AS (
  SELECT p.id, p.v, c.cluster, sqrt(list_sum(list_transform(list_zip(p.v, c.v), lambda x: (x[1] - x[2]) * (x[1] - x[2])))) AS dist
  FROM p, c{i - 1} c QUALIFY row_number() OVER (PARTITION BY p.id ORDER BY dist, c.cluster) = 1)""")
        parts.append(f"r{i} AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY dist, id) AS rank FROM a{i})")
        parts.append(f"""m{i} AS (
  SELECT cluster, list(x ORDER BY pos) AS v FROM (
    SELECT cluster, pos, avg(x) AS x FROM (
      SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM r{i} WHERE rank % {EVERY} <> 0) GROUP BY ALL)
  GROUP BY cluster)""")
        parts.append(f"c{i} AS (SELECT c.cluster, coalesce(m.v, c.v) AS v FROM c{i - 1} c LEFT JOIN m{i} m ON m.cluster = c.cluster)")
    return "WITH " + ",\n".join(parts)


@query("win_every_qth", _kmeans_sql(1) + f"""
SELECT id, CAST(cluster AS INTEGER) AS cluster, rank, round(dist, 6) AS dist FROM r1 WHERE rank % {EVERY} <> 0
""")
def win_every_qth(t: Tables) -> DataFrame:
    points = _points(t)
    assigned = vec.nearest_centre(points, cl.first_points(points, CENTRES)).select("id", "cluster", "dist")
    kept = cl.without_every_qth(assigned, EVERY)
    return kept.select("id", "cluster", "rank", F.round("dist", 6).alias("dist"))


@query("ml_kmeans_trimmed", _kmeans_sql(ROUNDS) + f"""
SELECT CAST(cluster AS INTEGER) AS cluster, CAST(generate_subscripts(v, 1) - 1 AS INTEGER) AS pos, round(unnest(v), 6) AS value
FROM c{ROUNDS}
""")
def ml_kmeans_trimmed(t: Tables) -> DataFrame:
    points = _points(t).select("id", "features")
    centres = cl.trimmed_kmeans(points, cl.first_points(points, CENTRES), ROUNDS, EVERY)
    return _matrix(t, centres)


def _matrix(t: Tables, centres: np.ndarray) -> DataFrame:
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(centres)]
    frame = t.spark.createDataFrame(rows, "cluster int, centre array<double>")
    return frame.select("cluster", F.posexplode("centre").alias("pos", "value")).withColumn("value", F.round("value", 6))


@query("ml_linear_score", """
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
m AS (SELECT label, list(x ORDER BY pos) AS c FROM (
  SELECT label, pos, avg(x) AS x FROM (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM e) GROUP BY ALL) GROUP BY 1)
SELECT vec_id AS id, e.label, CAST(m.label AS INTEGER) AS prediction FROM e, m
QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY list_dot_product(v, c) - list_dot_product(c, c) / 2 DESC, m.label) = 1
""")
def ml_linear_score(t: Tables) -> DataFrame:
    # weights of the nearest class mean written as a linear score: w0 = -|m|^2 / 2, w = m
    points = _points(t)
    means = np.asarray([r["mean"] for r in vec.group_means(points, "label").orderBy("label").collect()])
    weights = np.hstack([-(means**2).sum(axis=1, keepdims=True) / 2, means])
    return vec.linear_class(points, weights).select("id", "label", "prediction")
