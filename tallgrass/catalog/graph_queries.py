"""Queries over the supplier-part graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallgrass.catalog import fixtures as fx
from tallgrass.catalog.registry import Tables, query
from tallgrass.operators import graph as gr
from tallgrass.plans.lineage import cut_lineage

CONTAGION = 1.5
ROUNDS = 6
SEEDS = 50


def _edges(t: Tables) -> DataFrame:
    return gr.build(fx.raw_edges(t))


def _kept_edges(t: Tables) -> DataFrame:
    """The edges as a written table, for queries that go over them more than once."""
    return cut_lineage(_edges(t))


def _seeds(edges: DataFrame) -> DataFrame:
    """The first nodes by number, as the seed list gives them."""
    return gr.degrees(edges).select("id").orderBy("id").limit(SEEDS)


def _removed(t: Tables, seeds: DataFrame) -> DataFrame:
    return t.supplier.where("s_acctbal < 0").select(F.col("s_suppkey").alias("id")).join(seeds, "id", "left_anti")


_STATE = f"""
WITH {fx.EDGES_SQL},
seeds AS (SELECT id FROM degrees ORDER BY id LIMIT {SEEDS}),
removed AS (SELECT s_suppkey AS id FROM supplier WHERE s_acctbal < 0 AND s_suppkey NOT IN (SELECT id FROM seeds))
"""
_CONCERN = """
SELECT dst AS id, CASE WHEN dst IN (SELECT id FROM seeds) THEN 0.0
       ELSE count(*) FILTER (WHERE src IN (SELECT id FROM seeds)) / count(*) END AS concern
FROM arcs GROUP BY dst
"""
_WEIGHTED = """
SELECT dst AS id, CASE WHEN dst IN (SELECT id FROM seeds) THEN 0.0
       ELSE least((count(*) FILTER (WHERE src IN (SELECT id FROM seeds))
                   + 3 * count(*) FILTER (WHERE src IN (SELECT id FROM removed))) / count(*), 1.0) END AS concern
FROM arcs GROUP BY dst
"""


@query("prj_default_weight", "SELECT l_suppkey AS src, l_partkey AS dst, 1 AS w FROM lineitem")
def prj_default_weight(t: Tables) -> DataFrame:
    return gr.default_weight(t.lineitem.select("l_suppkey", "l_partkey"))


@query("gr_build", f"WITH {fx.EDGES_SQL} SELECT * FROM arcs")
def gr_build(t: Tables) -> DataFrame:
    return gr.mirror(_edges(t))


@query("gr_degree", f"WITH {fx.EDGES_SQL} SELECT * FROM degrees")
def gr_degree(t: Tables) -> DataFrame:
    return gr.degrees(_edges(t))


@query("gr_degree_hist", f"WITH {fx.EDGES_SQL} SELECT degree, count(*) AS n_nodes FROM degrees GROUP BY 1")
def gr_degree_hist(t: Tables) -> DataFrame:
    return gr.degree_histogram(gr.degrees(_edges(t)))


@query("ord_topk_degree", f"WITH {fx.EDGES_SQL} SELECT * FROM degrees ORDER BY degree DESC, id LIMIT 50")
def ord_topk_degree(t: Tables) -> DataFrame:
    return gr.top_degree(gr.degrees(_edges(t)))


@query("gr_clustering", f"""
WITH {fx.EDGES_SQL},
tri AS (
  SELECT count(*) AS n FROM edges x JOIN edges y ON x.b = y.a JOIN edges z ON z.a = x.a AND z.b = y.b),
triples AS (SELECT sum(degree * (degree - 1)) AS n FROM degrees)
SELECT tri.n AS triangles, CAST(triples.n AS BIGINT) AS connected_triples, 6.0 * tri.n / triples.n AS coefficient FROM tri, triples
""")
def gr_clustering(t: Tables) -> DataFrame:
    return gr.clustering(_edges(t))


@query("gr_concern", _STATE + _CONCERN)
def gr_concern(t: Tables) -> DataFrame:
    edges = _kept_edges(t)
    return gr.concern(edges, _seeds(edges))


@query("gr_concern_weighted", _STATE + _WEIGHTED)
def gr_concern_weighted(t: Tables) -> DataFrame:
    edges = _kept_edges(t)
    seeds = _seeds(edges)
    return gr.concern(edges, seeds, _removed(t, seeds))


def _rounds_sql() -> str:
    """The spreading rounds, one group of tables per round: n0, c0 are the start."""
    parts = [
        "n0 AS (SELECT id, id IN (SELECT id FROM seeds) AS inf, CASE WHEN id IN (SELECT id FROM seeds) THEN 0 END AS round, "
        "0.0 AS concern FROM degrees)"
    ]
    for i in range(1, ROUNDS + 1):
        parts.append(
            f"s{i} AS (SELECT dst AS id, coalesce(sum(w) FILTER (WHERE inf), 0) AS wsum, "
            f"count(*) FILTER (WHERE inf) / count(*) AS share FROM arcs JOIN n{i - 1} ON src = id GROUP BY dst)"
        )
        joins = f"(NOT inf AND round({CONTAGION} * wsum, 9) >= round(1 + concern, 9))"
        parts.append(
            f"n{i} AS (SELECT id, inf OR {joins} AS inf, CASE WHEN {joins} THEN {i} ELSE round END AS round, "
            f"share AS concern FROM n{i - 1} JOIN s{i} USING (id))"
        )
    return ", ".join(parts)


@query("gr_threshold_propagation", f"{_STATE}, {_rounds_sql()} SELECT id, round FROM n{ROUNDS} WHERE inf")
def gr_threshold_propagation(t: Tables) -> DataFrame:
    edges = _kept_edges(t)
    return gr.threshold_spread(edges, _seeds(edges), CONTAGION, ROUNDS)


@query("gr_frontier_exposure", f"""
{_STATE}, concerns AS ({_WEIGHTED}),
reach AS (
  SELECT dst AS id, least(1.0, 8.0 * w * (1 - concern)) AS p FROM arcs JOIN concerns ON id = dst
  WHERE src IN (SELECT id FROM seeds) AND dst NOT IN (SELECT id FROM seeds) AND dst NOT IN (SELECT id FROM removed))
SELECT id, CASE WHEN max(p) >= 1 THEN 1.0 ELSE 1 - exp(sum(CASE WHEN p < 1 THEN ln(1 - p) END)) END AS exposure
FROM reach GROUP BY id
""")
def gr_frontier_exposure(t: Tables) -> DataFrame:
    edges = _kept_edges(t)
    seeds = _seeds(edges)
    removed = _removed(t, seeds)
    susceptible = gr.degrees(edges).join(seeds, "id", "left_anti").join(removed, "id", "left_anti")
    return gr.frontier_exposure(edges, seeds, susceptible, gr.concern(edges, seeds, removed), 8.0)


@query("join_set_diff", f"{_STATE} SELECT id FROM degrees WHERE id NOT IN (SELECT id FROM seeds)")
def join_set_diff(t: Tables) -> DataFrame:
    nodes = gr.degrees(_kept_edges(t)).select("id")
    return nodes.join(nodes.orderBy("id").limit(SEEDS), "id", "left_anti")


@query("set_union_distinct", f"""
{_STATE} SELECT id FROM seeds UNION SELECT dst FROM arcs WHERE src IN (SELECT id FROM seeds)
""")
def set_union_distinct(t: Tables) -> DataFrame:
    edges = _kept_edges(t)
    seeds = _seeds(edges)
    reached = gr.mirror(edges).join(seeds.withColumnRenamed("id", "src"), "src", "left_semi")
    return seeds.union(reached.select("dst")).distinct()
