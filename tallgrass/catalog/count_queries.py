"""Queries over incidents, trips, sorts, sets and row positions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallgrass.catalog import fixtures as fx
from tallgrass.catalog.registry import Tables, query
from tallgrass.operators import counts as ct
from tallgrass.operators import selection as sel
from tallgrass.plans.splits import hash_split, exact_split

FIRST, LAST = 1996, 1999
YEARS = LAST - FIRST + 1

_COUNTED = f"""
WITH {fx.INCIDENTS_SQL},
counted AS (
  SELECT region, country, count(*) AS cnt FROM incidents WHERE year BETWEEN {FIRST} AND {LAST} GROUP BY ALL),
best AS (
  SELECT region, country, cnt FROM counted QUALIFY row_number() OVER (PARTITION BY region ORDER BY cnt DESC, country) = 1)
"""
_RATES = f"""
WITH {fx.INCIDENTS_SQL},
rates AS (
  SELECT country, floor(count(*) * 10.0 / {YEARS} + 0.5) / 10 AS rate FROM incidents
  WHERE year BETWEEN {FIRST} AND {LAST} GROUP BY 1 HAVING floor(count(*) * 10.0 / {YEARS} + 0.5) / 10 > 10)
"""


def counted(t: Tables) -> DataFrame:
    return ct.count_by(ct.in_years(fx.incidents(t), FIRST, LAST), "region", "country")


def rates(t: Tables) -> DataFrame:
    return ct.rate_above(ct.count_by(ct.in_years(fx.incidents(t), FIRST, LAST), "country"), YEARS, 10).select("country", "rate")


@query("agg_count_two_keys", _COUNTED + "SELECT * FROM counted")
def agg_count_two_keys(t: Tables) -> DataFrame:
    return counted(t)


@query("agg_argmax_group", _COUNTED + "SELECT * FROM best")
def agg_argmax_group(t: Tables) -> DataFrame:
    return ct.winner_per_group(counted(t), "region", "country")


@query("ord_by_count_desc", _COUNTED + "SELECT region, country FROM best ORDER BY cnt DESC, region")
def ord_by_count_desc(t: Tables) -> DataFrame:
    return ct.winner_per_group(counted(t), "region", "country").orderBy(F.desc("cnt"), "region").select("region", "country")


@query("agg_rate_having", _RATES + "SELECT * FROM rates")
def agg_rate_having(t: Tables) -> DataFrame:
    return rates(t)


@query("ord_composite", _RATES + "SELECT country FROM rates ORDER BY rate DESC, country")
def ord_composite(t: Tables) -> DataFrame:
    return rates(t).orderBy(F.desc("rate"), F.asc("country")).select("country")


@query("prj_epoch_parts", f"""
SELECT event_id, strftime(ts, '%Y/%m/%d') AS day, strftime(ts, '%H:%M:%S') AS time_of_day FROM events
""")
def prj_epoch_parts(t: Tables) -> DataFrame:
    day, time_of_day = ct.calendar_parts(F.unix_seconds(F.col("ts").cast("timestamp")))
    return t.events.select("event_id", day.alias("day"), time_of_day.alias("time_of_day"))


@query("agg_daily_span", f"WITH {fx.TRIPS_SQL} SELECT * FROM spans")
def agg_daily_span(t: Tables) -> DataFrame:
    return ct.daily_spans(fx.trips(t))


_SUMMARY = f"""
WITH {fx.TRIPS_SQL},
summary AS (
  SELECT journey_id, mean_span, day AS closest_day FROM (
    SELECT *, avg(span) OVER (PARTITION BY journey_id) AS mean_span FROM spans)
  QUALIFY row_number() OVER (PARTITION BY journey_id ORDER BY abs(span - mean_span), day) = 1)
"""


@query("agg_closest_to_mean", _SUMMARY + "SELECT * FROM summary")
def agg_closest_to_mean(t: Tables) -> DataFrame:
    return ct.span_summary(ct.daily_spans(fx.trips(t)))


@query("set_tagged_union", _SUMMARY + """
SELECT journey_id, 'day' AS kind, day, CAST(span AS DOUBLE) AS seconds FROM spans
UNION ALL SELECT journey_id, 'summary', closest_day, mean_span FROM summary
""")
def set_tagged_union(t: Tables) -> DataFrame:
    return ct.spans_with_summary(ct.daily_spans(fx.trips(t)))


@query("ord_first_k", "SELECT vec_id, label FROM embeddings ORDER BY vec_id LIMIT 5")
def ord_first_k(t: Tables) -> DataFrame:
    return sel.first_rows(t.embeddings.select("vec_id", "label"), ["vec_id"], 5)


@query("agg_distinct_values", "SELECT DISTINCT c_mktsegment FROM customer")
def agg_distinct_values(t: Tables) -> DataFrame:
    return sel.distinct_values(t.customer, "c_mktsegment")


@query("prj_row_slice", """
SELECT vec_id, label, CASE WHEN pos BETWEEN 45 AND 74 THEN 'validation' ELSE 'train' END AS part
FROM (SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) - 1 AS pos FROM embeddings WHERE label <> 2)
""")
def prj_row_slice(t: Tables) -> DataFrame:
    # the label filter belongs to the operation: one of the classes is left out first
    return sel.slice_rows(t.embeddings.where("label <> 2").select("vec_id", "label"), ["vec_id"], 45, 75)


@query("prj_label_encode", """
SELECT c_custkey, c_mktsegment, CAST(dense_rank() OVER (ORDER BY first_seen) - 1 AS INTEGER) AS code
FROM (SELECT *, min(c_custkey) OVER (PARTITION BY c_mktsegment) AS first_seen FROM customer)
""")
def prj_label_encode(t: Tables) -> DataFrame:
    return sel.encode_labels(t.customer.select("c_custkey", "c_mktsegment"), "c_mktsegment", "c_custkey").select(
        "c_custkey", "c_mktsegment", "code"
    )


@query("win_kfold", "SELECT event_id, CAST(ntile(7) OVER (ORDER BY event_id) - 1 AS INTEGER) AS fold FROM events")
def win_kfold(t: Tables) -> DataFrame:
    return sel.with_folds(t.events.select("event_id"), ["event_id"], 7)


@query("win_shuffle_split", """
SELECT vec_id, label, row_number() OVER (ORDER BY md5('42:' || vec_id), vec_id)
         <= (SELECT count(*) * 2 // 3 FROM embeddings) AS is_train
FROM embeddings
""")
def win_shuffle_split(t: Tables) -> DataFrame:
    rows = t.embeddings.select("vec_id", "label")
    return exact_split(rows, "vec_id", rows.count() * 2 // 3, seed=42)


@query("ml_random_split", """
SELECT vec_id, label, substr(md5('7:' || vec_id), 1, 8) < 'b3333333' AS is_train FROM embeddings
""")
def ml_random_split(t: Tables) -> DataFrame:
    return hash_split(t.embeddings.select("vec_id", "label"), "vec_id", 0.7, seed=7)
