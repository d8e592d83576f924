"""Queries over order lines, stock and table constraints."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallgrass.catalog import fixtures as fx
from tallgrass.catalog.registry import Tables, query
from tallgrass.operators import audits as au
from tallgrass.operators import orders as od
from tallgrass.plans.lineage import cut_lineage


def _needs(t: Tables) -> DataFrame:
    return od.needs(fx.order_lines(t))


def _accepted(t: Tables) -> DataFrame:
    needs = _needs(t)
    return od.accepted_lines(needs, od.check_stock(needs, fx.stock(t)))


@query("agg_lines_by_site", f"""
WITH {fx.LINES_SQL}
SELECT order_id, site, CAST(floor(product / 10000.0) AS BIGINT) AS chunk,
       string_agg(product || ':' || amount, ',' ORDER BY product) AS lines
FROM needs GROUP BY ALL
""")
def agg_lines_by_site(t: Tables) -> DataFrame:
    text = F.transform("lines", lambda x: F.concat_ws(":", x["product"], x["amount"]))
    return od.lines_by_site(fx.order_lines(t)).withColumn("lines", F.array_join(text, ","))


@query("join_site_route", f"""
WITH {fx.LINES_SQL} SELECT order_id, site, product, amount, owner FROM lines JOIN sites USING (site)
""")
def join_site_route(t: Tables) -> DataFrame:
    return od.route(fx.order_lines(t), fx.sites(t))


@query("join_stock_check", f"WITH {fx.LINES_SQL} SELECT * FROM checked")
def join_stock_check(t: Tables) -> DataFrame:
    return od.check_stock(_needs(t), fx.stock(t))


@query("join_order_conflict", f"""
WITH {fx.LINES_SQL}
SELECT a.order_id, min(b.order_id) AS first_conflict, count(DISTINCT (a.site, a.product)) AS shared_keys
FROM needs a JOIN needs b ON a.site = b.site AND a.product = b.product AND b.order_id < a.order_id GROUP BY 1
""")
def join_order_conflict(t: Tables) -> DataFrame:
    return od.earlier_conflicts(_needs(t))


@query("set_intersect", f"""
WITH {fx.LINES_SQL}
SELECT l_suppkey AS site, l_partkey AS product FROM lineitem WHERE l_returnflag = 'A'
INTERSECT SELECT l_suppkey, l_partkey FROM lineitem WHERE l_returnflag = 'R'
""")
def set_intersect(t: Tables) -> DataFrame:
    keys = t.lineitem.select("l_returnflag", F.col("l_suppkey").alias("site"), F.col("l_partkey").alias("product"))
    return od.shared_keys(keys.where("l_returnflag = 'A'"), keys.where("l_returnflag = 'R'"))


@query("tbl_restock_upsert", f"""
WITH {fx.LINES_SQL},
targets AS (SELECT s_suppkey AS site, p_partkey AS product, CAST(CASE WHEN p_partkey % 11 = 1 THEN 60 ELSE 53 END AS BIGINT) AS target
            FROM part JOIN supplier ON s_suppkey = p_partkey % 97)
SELECT coalesce(s.site, x.site) AS site, coalesce(s.product, x.product) AS product, coalesce(target, inventory) AS inventory
FROM stock s FULL JOIN targets x ON s.site = x.site AND s.product = x.product
""")
def tbl_restock_upsert(t: Tables) -> DataFrame:
    owner = F.col("s_suppkey") == F.col("p_partkey") % 97
    targets = t.part.join(t.supplier, owner).select(
        F.col("s_suppkey").alias("site"), F.col("p_partkey").alias("product"),
        F.when(F.col("p_partkey") % 11 == 1, 60).otherwise(53).cast("long").alias("inventory"),
    )
    return od.restock(fx.stock(t), targets)


@query("tbl_apply_orders", f"WITH {fx.LINES_SQL} SELECT *, inventory < 0 AS below_zero FROM reduced")
def tbl_apply_orders(t: Tables) -> DataFrame:
    return od.apply_lines(fx.stock(t), _accepted(t))


@query("tbl_append_lines", f"WITH {fx.LINES_SQL} SELECT order_id, site, product, amount FROM accepted_lines")
def tbl_append_lines(t: Tables) -> DataFrame:
    return _accepted(t)


_UNDO = f"""
WITH {fx.LINES_SQL},
undone AS (SELECT a.* FROM accepted_lines a JOIN orders ON o_orderkey = order_id WHERE o_orderstatus = 'F'),
stock_after AS (
  SELECT r.site, r.product, CASE WHEN u.site IS NULL THEN r.inventory ELSE s.inventory END AS inventory
  FROM reduced r JOIN stock s ON s.site = r.site AND s.product = r.product
  LEFT JOIN (SELECT DISTINCT site, product FROM undone) u ON u.site = r.site AND u.product = r.product),
lines_after AS (SELECT * FROM accepted_lines WHERE order_id NOT IN (SELECT order_id FROM undone))
SELECT 'stock' AS kind, NULL AS order_id, site, product, inventory AS amount FROM stock_after
UNION ALL SELECT 'line', order_id, site, product, amount FROM lines_after
"""


@query("tbl_undo", _UNDO)
def tbl_undo(t: Tables) -> DataFrame:
    lines, stock = cut_lineage(_accepted(t)), fx.stock(t)
    failed = t.orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("order_id"))
    undone = lines.join(failed, "order_id", "left_semi")
    after = od.undo_stock(od.apply_lines(stock, lines).drop("below_zero"), stock, undone)
    return after.select(
        F.lit("stock").alias("kind"), F.lit(None).cast("long").alias("order_id"), *od.KEY, F.col("inventory").alias("amount")
    ).unionByName(od.undo_lines(lines, undone).select(F.lit("line").alias("kind"), "order_id", *od.KEY, "amount"))


def _waves_sql(rounds: int) -> str:
    """Serial service in rounds: what earlier orders take at least and at most decides an order.

    An order still open after the last round shows as NULL, so too few rounds cannot go unseen.
    """
    parts = [
        "w0 AS (SELECT order_id, site, product, amount, coalesce(inventory, -1) AS inventory, CAST(NULL AS BOOLEAN) AS done "
        "FROM needs LEFT JOIN stock USING (site, product))"
    ]
    for i in range(rounds):
        parts.append(f"""b{i} AS (
  SELECT *, coalesce(sum(amount) FILTER (WHERE done IS NULL OR done) OVER w, 0) AS most,
         coalesce(sum(amount) FILTER (WHERE done) OVER w, 0) AS least
  FROM w{i} WINDOW w AS (PARTITION BY site, product ORDER BY order_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))""")
        parts.append(f"""v{i} AS (
  SELECT order_id, CASE WHEN any_value(done) IS NOT NULL THEN any_value(done)
                        WHEN bool_and(most + amount <= inventory) THEN TRUE
                        WHEN bool_or(least + amount > inventory) THEN FALSE END AS now
  FROM b{i} GROUP BY order_id)""")
        parts.append(f"w{i + 1} AS MATERIALIZED (SELECT order_id, site, product, amount, inventory, now AS done FROM w{i} JOIN v{i} USING (order_id))")
    return ",\n".join(parts)


@query("tbl_fulfil_waves", f"WITH {fx.LINES_SQL}, {_waves_sql(12)} SELECT DISTINCT order_id, done AS accepted FROM w12")
def tbl_fulfil_waves(t: Tables) -> DataFrame:
    return od.fulfil(_needs(t), fx.stock(t))


@query("tbl_check_pk", """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
""")
def tbl_check_pk(t: Tables) -> DataFrame:
    return au.duplicate_keys(t.lineitem, "l_orderkey", "l_linenumber")


@query("tbl_check_domain", """
SELECT 'amount' AS rule, count(*) FILTER (WHERE NOT l_quantity >= 2) AS n_rows FROM lineitem
UNION ALL SELECT 'flag', count(*) FILTER (WHERE NOT l_returnflag IN ('A', 'R')) FROM lineitem
UNION ALL SELECT 'tax', count(*) FILTER (WHERE NOT l_tax >= 0) FROM lineitem
""")
def tbl_check_domain(t: Tables) -> DataFrame:
    rules = {
        "amount": F.col("l_quantity") >= 2,
        "flag": F.col("l_returnflag").isin("A", "R"),
        "tax": F.col("l_tax") >= 0,
    }
    return au.broken_rules(t.lineitem, rules)


@query("tbl_check_fk", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 40)
""")
def tbl_check_fk(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    return au.orphans(lines, t.part.where("p_size <= 40"), ["l_partkey"], ["p_partkey"])


@query("tbl_cascade_delete", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_brand = 'Brand#7')
""")
def tbl_cascade_delete(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    return au.cascade_delete(lines, t.part.where("p_brand = 'Brand#7'"), ["l_partkey"], ["p_partkey"])
