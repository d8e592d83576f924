"""Queries over readings: projections, filters, the two-stage aggregation, lags, joins."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from tallgrass.catalog import fixtures as fx
from tallgrass.catalog.registry import Tables, query
from tallgrass.operators import readings as rd

_MONTH_COLUMNS = '"StationId", "Year_Rec", "Month_Rec"'


@query("src_json_decode", """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events
""")
def src_json_decode(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.from_json("props", "k int").alias("json")).select("event_id", "json.*")


@query("src_parquet", "SELECT p_partkey, p_brand, p_size, p_retailprice FROM part")
def src_parquet(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", "p_brand", "p_size", "p_retailprice")


@query("prj_date_parts", f"""
WITH {fx.READINGS_SQL}
SELECT "StationId", "Variable", "Value", CAST(substr("Date", 1, 4) AS INTEGER) AS "Year_Rec",
       CAST(substr("Date", 5, 2) AS INTEGER) AS "Month_Rec", "ObsTime" FROM readings
""")
def prj_date_parts(t: Tables) -> DataFrame:
    return rd.with_date_parts(fx.readings(t)).select("StationId", "Variable", "Value", "Year_Rec", "Month_Rec", "ObsTime")


@query("prj_season", """
SELECT o_orderkey, month(o_orderdate) AS month_rec,
       CAST(floor((month(o_orderdate) % 12) / 3.0) + 1 AS INTEGER) AS season FROM orders
""")
def prj_season(t: Tables) -> DataFrame:
    month = F.month("o_orderdate")
    return t.orders.select("o_orderkey", month.alias("month_rec"), rd.season_of(month).alias("season"))


@query("flt_quality", f"""
WITH {fx.READINGS_SQL} SELECT "StationId", "Date", "Variable", "Value" FROM readings WHERE "Q_Flag" IS NULL
""")
def flt_quality(t: Tables) -> DataFrame:
    return rd.drop_flagged(fx.readings(t))


@query("flt_variable_rules", f"""
WITH {fx.READINGS_SQL}
SELECT "StationId", "Variable", "Value", CAST(substr("Date", 1, 4) AS INTEGER) AS "Year_Rec" FROM readings
WHERE CAST(substr("Date", 1, 4) AS INTEGER) >= 1997
  AND ("Variable" IN ('TMAX', 'TMIN') OR ("Variable" = 'PRCP' AND "Value" >= 0))
""")
def flt_variable_rules(t: Tables) -> DataFrame:
    kept = rd.keep_variables(
        rd.with_date_parts(fx.readings(t)), variables=("PRCP", "TMAX", "TMIN"), non_negative=("PRCP",), min_year=1997
    )
    return kept.select("StationId", "Variable", "Value", "Year_Rec")


@query("flt_prefix", """
SELECT c_custkey, c_mktsegment FROM customer WHERE starts_with(c_mktsegment, 'MA') OR starts_with(c_mktsegment, 'HO')
""")
def flt_prefix(t: Tables) -> DataFrame:
    return rd.station_prefix(t.customer.select("c_custkey", "c_mktsegment"), ["MA", "HO"], "c_mktsegment")


@query("flt_year_range", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1999
""")
def flt_year_range(t: Tables) -> DataFrame:
    # written on the date itself, so the range reaches the Parquet scan
    day = F.col("o_orderdate")
    inside = (day >= F.lit("1996-01-01").cast("timestamp_ntz")) & (day < F.lit("2000-01-01").cast("timestamp_ntz"))
    return t.orders.where(inside).select("o_orderkey", F.year(day).alias("year"))


@query("flt_drop_null", f"""
WITH {fx.LEARNING_SQL} SELECT * FROM learning
WHERE "PRCP" IS NOT NULL AND "TMAX" IS NOT NULL AND "TMIN" IS NOT NULL AND "SNWD" IS NOT NULL
  AND "ONE_YEAR_PRCP" IS NOT NULL AND "TWO_YEAR_PRCP" IS NOT NULL AND "FIVE_YEAR_PRCP" IS NOT NULL
  AND "Elevation" IS NOT NULL
""")
def flt_drop_null(t: Tables) -> DataFrame:
    return learning(t).na.drop("any")


@query("agg_partial_month", f"""
WITH {fx.CLEAN_SQL}
SELECT {_MONTH_COLUMNS}, "Variable", CAST(sum("Value") AS BIGINT) AS batch_sum, count(*) AS batch_count
FROM cleaned GROUP BY ALL
""")
def agg_partial_month(t: Tables) -> DataFrame:
    return rd.monthly_partials(rd.clean(fx.readings(t)))


def _wide_sql(variables: tuple[str, ...]) -> str:
    columns = ", ".join(
        f"""nullif(count(*) FILTER (WHERE "Variable" = '{v}'), 0) AS "{v}_batch_count",
            CAST(sum("Value") FILTER (WHERE "Variable" = '{v}') AS BIGINT) AS "{v}_batch_sum" """
        for v in variables
    )
    return f"WITH {fx.CLEAN_SQL} SELECT {_MONTH_COLUMNS}, {columns} FROM cleaned GROUP BY ALL"


@query("agg_pivot_variable", _wide_sql(rd.VARIABLES))
def agg_pivot_variable(t: Tables) -> DataFrame:
    return rd.pivot_partials(rd.monthly_partials(rd.clean(fx.readings(t))))


@query("prj_fill_missing_cols", f"""
SELECT *, CAST(NULL AS BIGINT) AS "WIND_batch_count", CAST(NULL AS BIGINT) AS "WIND_batch_sum" FROM ({_wide_sql(rd.VARIABLES)})
""")
def prj_fill_missing_cols(t: Tables) -> DataFrame:
    partials = rd.monthly_partials(rd.clean(fx.readings(t)))
    return rd.pivot_partials(partials, (*rd.VARIABLES, "WIND"))


def monthly(t: Tables) -> DataFrame:
    return rd.merge_partials(rd.stage_one(fx.readings(t)))


@query("agg_merge_partials", f"WITH {fx.MONTHLY_SQL} SELECT * FROM monthly")
def agg_merge_partials(t: Tables) -> DataFrame:
    return monthly(t)


@query("join_year_lag", f"WITH {fx.LAGS_SQL} SELECT * FROM lagged")
def join_year_lag(t: Tables) -> DataFrame:
    return rd.year_lags(monthly(t))


@query("view_register", f"WITH {fx.LAGS_SQL} SELECT * FROM lagged")
def view_register(t: Tables) -> DataFrame:
    # the same question asked in SQL over a named view: one scan, one frame per lag
    view = f"monthly_{uuid.uuid4().hex}"
    monthly(t).createOrReplaceTempView(view)
    try:
        return t.spark.sql(f"""
            SELECT * EXCEPT (lag_1, lag_2, lag_5), lag_1.p AS ONE_YEAR_PRCP, lag_2.p AS TWO_YEAR_PRCP, lag_5.p AS FIVE_YEAR_PRCP
            FROM (
              SELECT *, max(struct(1 AS known, PRCP AS p)) OVER (PARTITION BY StationId, Month_Rec ORDER BY Year_Rec RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING) AS lag_1,
                     max(struct(1 AS known, PRCP AS p)) OVER (PARTITION BY StationId, Month_Rec ORDER BY Year_Rec RANGE BETWEEN 2 PRECEDING AND 2 PRECEDING) AS lag_2,
                     max(struct(1 AS known, PRCP AS p)) OVER (PARTITION BY StationId, Month_Rec ORDER BY Year_Rec RANGE BETWEEN 5 PRECEDING AND 5 PRECEDING) AS lag_5
              FROM {view}
            )
            WHERE lag_1.p IS NOT NULL AND lag_2 IS NOT NULL AND lag_5.p IS NOT NULL
        """)
    finally:
        t.spark.catalog.dropTempView(view)


def learning(t: Tables) -> DataFrame:
    stations = fx.stations(t).select("StationId", "Elevation")
    return rd.learning_table(rd.year_lags(monthly(t)), stations)


@query("join_station", f"WITH {fx.LEARNING_SQL} SELECT * FROM learning")
def join_station(t: Tables) -> DataFrame:
    return learning(t)


@query("win_lag", f"""
WITH {fx.MONTHLY_SQL}
SELECT {_MONTH_COLUMNS}, "PRCP",
       lag("PRCP", 1) OVER (PARTITION BY "StationId", "Month_Rec" ORDER BY "Year_Rec") AS "PREV_PRCP" FROM monthly
""")
def win_lag(t: Tables) -> DataFrame:
    return rd.previous_row(monthly(t).select(*rd.MONTH_KEYS, "PRCP"))


@query("snk_align_schema", """
SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier
""")
def snk_align_schema(t: Tables) -> DataFrame:
    target = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    batch = t.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"),
    )
    return rd.align_columns(batch, target)


@query("set_except", """
SELECT n_name AS name FROM nation
EXCEPT SELECT n_name FROM nation JOIN supplier ON s_nationkey = n_nationkey WHERE s_acctbal > 9000
""")
def set_except(t: Tables) -> DataFrame:
    present = t.supplier.where("s_acctbal > 9000").join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return t.nation.select(F.col("n_name").alias("name")).subtract(present.select("n_name"))
