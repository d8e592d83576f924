"""The reference inputs, derived from the given tables, in DataFrame and in SQL form."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallgrass.catalog.registry import Tables

# A readings table from lineitem: one reading per line.
READINGS_SQL = """
readings AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS "StationId",
         strftime(l_shipdate, '%Y%m%d') AS "Date",
         CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'SNWD'
              WHEN l_returnflag = 'A' THEN 'PRCP'
              WHEN l_returnflag = 'N' THEN 'TMAX' ELSE 'TMIN' END AS "Variable",
         CAST(floor(l_quantity) AS INTEGER) - 5 AS "Value",
         CASE WHEN l_tax > 0.07 THEN 'M' END AS "M_Flag",
         CASE WHEN l_linenumber = 7 THEN 'X' END AS "Q_Flag",
         CAST(NULL AS VARCHAR) AS "S_Flag",
         CAST(l_linenumber AS VARCHAR) AS "ObsTime"
  FROM lineitem)
"""

CLEAN_SQL = (
    READINGS_SQL
    + """,
cleaned AS (
  SELECT "StationId", "Variable", "Value",
         CAST(substr("Date", 1, 4) AS INTEGER) AS "Year_Rec",
         CAST(substr("Date", 5, 2) AS INTEGER) AS "Month_Rec"
  FROM readings
  WHERE "Q_Flag" IS NULL
    AND CAST(substr("Date", 1, 4) AS INTEGER) >= 1950
    AND ("Variable" IN ('TMAX', 'TMIN') OR ("Variable" IN ('PRCP', 'SNWD') AND "Value" >= 0)))
"""
)

_AVERAGES = ", ".join(
    f"""sum("Value") FILTER (WHERE "Variable" = '{v}') / count(*) FILTER (WHERE "Variable" = '{v}') AS "{v}" """
    for v in ("PRCP", "TMAX", "TMIN", "SNWD")
)

# averages straight from the rows; the Spark side gets there through partial sums
MONTHLY_SQL = (
    CLEAN_SQL
    + f""",
monthly AS (
  SELECT "StationId", "Year_Rec", "Month_Rec",
         CAST(floor("Month_Rec" % 12 / 3.0) + 1 AS DOUBLE) AS "Season", {_AVERAGES}
  FROM cleaned GROUP BY "StationId", "Year_Rec", "Month_Rec")
"""
)

LAGS_SQL = (
    MONTHLY_SQL
    + """,
past AS (
  SELECT "StationId", "Month_Rec", "Year_Rec" + lag AS "Year_Rec", lag, "PRCP" AS p FROM monthly, (VALUES (1), (2), (5)) AS l(lag)),
known AS (
  SELECT "StationId", "Month_Rec", "Year_Rec", count(*) AS lags, max(p) FILTER (WHERE lag = 1) AS "ONE_YEAR_PRCP",
         max(p) FILTER (WHERE lag = 2) AS "TWO_YEAR_PRCP", max(p) FILTER (WHERE lag = 5) AS "FIVE_YEAR_PRCP"
  FROM past GROUP BY "StationId", "Month_Rec", "Year_Rec"),
lagged AS (
  SELECT monthly.*, "ONE_YEAR_PRCP", "TWO_YEAR_PRCP", "FIVE_YEAR_PRCP" FROM monthly JOIN known USING ("StationId", "Month_Rec", "Year_Rec")
  WHERE lags = 3 AND "ONE_YEAR_PRCP" IS NOT NULL AND "FIVE_YEAR_PRCP" IS NOT NULL),
stations AS (SELECT CAST(s_suppkey AS VARCHAR) AS "StationId", s_acctbal AS "Elevation", s_name FROM supplier)
"""
)

LEARNING_SQL = (
    LAGS_SQL
    + """,
learning AS (
  SELECT "StationId", "Year_Rec", "Month_Rec", "PRCP", "TMAX", "TMIN",
         "ONE_YEAR_PRCP", "TWO_YEAR_PRCP", "FIVE_YEAR_PRCP", "SNWD", "Elevation"
  FROM lagged JOIN stations USING ("StationId"))
"""
)


def readings(t: Tables) -> DataFrame:
    flag, status, day = F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_shipdate")
    return t.lineitem.select(
        F.col("l_suppkey").cast("string").alias("StationId"),
        # the digits of yyyyMMdd put together as a number: cheaper than formatting a timestamp
        (F.year(day) * 10000 + F.month(day) * 100 + F.day(day)).cast("string").alias("Date"),
        F.when((flag == "A") & (status == "F"), "SNWD")
        .when(flag == "A", "PRCP")
        .when(flag == "N", "TMAX")
        .otherwise("TMIN")
        .alias("Variable"),
        (F.floor("l_quantity").cast("int") - 5).alias("Value"),
        F.when(F.col("l_tax") > 0.07, "M").alias("M_Flag"),
        F.when(F.col("l_linenumber") == 7, "X").alias("Q_Flag"),
        F.lit(None).cast("string").alias("S_Flag"),
        F.col("l_linenumber").cast("string").alias("ObsTime"),
    )


def stations(t: Tables) -> DataFrame:
    return t.supplier.select(
        F.col("s_suppkey").cast("string").alias("StationId"), F.col("s_acctbal").alias("Elevation"), "s_name"
    )


# One incident per order: year, country and region of the customer.
INCIDENTS_SQL = """
incidents AS (
  SELECT o_orderkey AS incident_id, CAST(year(o_orderdate) AS INTEGER) AS year, n_name AS country, r_name AS region
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
"""


def incidents(t: Tables) -> DataFrame:
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("o_orderkey").alias("incident_id"),
            F.year("o_orderdate").alias("year"),
            F.col("n_name").alias("country"),
            F.col("r_name").alias("region"),
        )
    )


# One trip reading per event: the user is the journey.
TRIPS_SQL = """
trips AS (
  SELECT CAST(user_id AS VARCHAR) AS journey_id, CAST(floor(epoch(ts)) AS BIGINT) AS epoch FROM events),
spans AS (
  SELECT journey_id, strftime(make_timestamp(epoch * 1000000), '%Y/%m/%d') AS day,
         max(epoch) - min(epoch) AS span
  FROM trips GROUP BY 1, 2)
"""


def trips(t: Tables) -> DataFrame:
    return t.events.select(
        F.col("user_id").cast("string").alias("journey_id"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("epoch"),
    )


# Order lines: one line per lineitem row.
LINES_SQL = """
lines AS (
  SELECT l_orderkey AS order_id, l_suppkey AS site, l_partkey AS product, CAST(floor(l_quantity) AS INTEGER) AS amount
  FROM lineitem),
needs AS (
  SELECT order_id, site, product, CAST(sum(amount) AS BIGINT) AS amount FROM lines GROUP BY ALL),
stock AS (
  SELECT DISTINCT l_suppkey AS site, l_partkey AS product, CAST(20 + l_partkey % 31 AS BIGINT) AS inventory FROM lineitem),
sites AS (SELECT s_suppkey AS site, n_name AS owner FROM supplier JOIN nation ON s_nationkey = n_nationkey),
checked AS (
  SELECT order_id, bool_and(coalesce(inventory >= amount, FALSE)) AS accepted
  FROM needs LEFT JOIN stock USING (site, product) GROUP BY order_id),
accepted_lines AS (
  SELECT needs.* FROM needs JOIN checked USING (order_id) WHERE accepted),
reduced AS (
  SELECT s.site, s.product, CAST(s.inventory - coalesce(a.taken, 0) AS BIGINT) AS inventory
  FROM stock s LEFT JOIN (SELECT site, product, sum(amount) AS taken FROM accepted_lines GROUP BY 1, 2) a
    ON a.site = s.site AND a.product = s.product)
"""


def order_lines(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_suppkey").alias("site"),
        F.col("l_partkey").alias("product"),
        F.floor("l_quantity").cast("int").alias("amount"),
    )


def stock(t: Tables) -> DataFrame:
    return (
        t.lineitem.select(F.col("l_suppkey").alias("site"), F.col("l_partkey").alias("product"))
        .distinct()
        .withColumn("inventory", (20 + F.col("product") % 31).cast("long"))
    )


def sites(t: Tables) -> DataFrame:
    return t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("site"), F.col("n_name").alias("owner")
    )


# Edges: the supplier and the part of a line, both read as node numbers of one graph.
EDGES_SQL = """
raw_edges AS (
  SELECT l_suppkey AS src, l_partkey AS dst, l_discount AS w, l_orderkey AS o, l_linenumber AS n, l_quantity AS q
  FROM lineitem),
edges AS (
  SELECT least(src, dst) AS a, greatest(src, dst) AS b,
         arg_max(w, {'o': o, 'n': n, 'q': q, 'w': w}) AS w
  FROM raw_edges WHERE src <> dst GROUP BY 1, 2),
arcs AS (SELECT a AS src, b AS dst, w FROM edges UNION ALL SELECT b, a, w FROM edges),
degrees AS (SELECT src AS id, count(*) AS degree FROM arcs GROUP BY 1)
"""


def raw_edges(t: Tables) -> DataFrame:
    # (order, line, quantity, weight) as digits of one number: a long keeps the aggregate hash-based
    line = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    detail = line * 64 + F.col("l_quantity").cast("long")
    return t.lineitem.select(
        F.col("l_suppkey").alias("src"),
        F.col("l_partkey").alias("dst"),
        F.col("l_discount").alias("w"),
        (detail * 16 + F.round(F.col("l_discount") * 100).cast("long")).alias("pos"),
    )


# Prices: monthly average price of a supplier; its nation is the sector.
PRICES_SQL = """
prices AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS symbol, strftime(l_shipdate, '%Y-%m') AS date, avg(l_extendedprice) AS close
  FROM lineitem GROUP BY 1, 2),
securities AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS symbol, n_name AS sector FROM supplier JOIN nation ON s_nationkey = n_nationkey)
"""


def prices(t: Tables) -> DataFrame:
    return t.lineitem.groupBy(
        F.col("l_suppkey").cast("string").alias("symbol"), F.date_format("l_shipdate", "yyyy-MM").alias("date")
    ).agg(F.avg("l_extendedprice").alias("close"))


def securities(t: Tables) -> DataFrame:
    return t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").cast("string").alias("symbol"), F.col("n_name").alias("sector")
    )
