from __future__ import annotations

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallgrass.operators import audits as au
from tallgrass.operators import orders as od
from tallgrass.plans.lineage import cut_lineage
from tallgrass.catalog import QUERIES, fixtures
from tallgrass.catalog.registry import Tables

LINE = "order_id long, site long, product long, amount int"
STOCK = "site long, product long, inventory long"


def serial(needs: list[tuple], stock: dict) -> dict:
    """One order after the other, each filled whole or rejected."""
    left = dict(stock)
    by_order: dict = {}
    for order, site, product, amount in needs:
        by_order.setdefault(order, []).append(((site, product), amount))
    out = {}
    for order in sorted(by_order):
        out[order] = all(left.get(k, -1) >= a for k, a in by_order[order])
        if out[order]:
            for k, a in by_order[order]:
                left[k] -= a
    return out


def test_lines_of_one_product_are_summed(spark):
    lines = spark.createDataFrame([(1, 1, 5, 3), (1, 1, 5, 4), (1, 2, 5, 1)], LINE)
    assert rows(od.needs(lines)) == [(1, 1, 5, 7), (1, 2, 5, 1)]


def test_lists_per_site_are_cut_by_product_range(spark):
    lines = spark.createDataFrame([(1, 1, p, p + 1) for p in (0, 3, 4, 9)], LINE)
    got = {(r["chunk"], tuple(map(tuple, r["lines"]))) for r in od.lines_by_site(lines, span=4).collect()}
    assert got == {(0, ((0, 1), (3, 4))), (1, ((4, 5),)), (2, ((9, 10),))}
    with pytest.raises(ValueError):
        od.lines_by_site(lines, span=0)


def test_stock_check_exact_amount_and_unknown_product(spark):
    stock = spark.createDataFrame([(1, 5, 7), (1, 6, 1)], STOCK)
    needs = od.needs(spark.createDataFrame([(1, 1, 5, 7), (2, 1, 5, 8), (3, 1, 9, 1), (4, 1, 5, 1), (4, 1, 6, 2)], LINE))
    assert rows(od.check_stock(needs, stock)) == [(1, True), (2, False), (3, False), (4, False)]


def test_conflicts_name_the_first_earlier_order(spark):
    needs = od.needs(spark.createDataFrame([(1, 1, 5, 1), (2, 1, 5, 1), (3, 1, 5, 1), (3, 1, 6, 1), (4, 2, 5, 1)], LINE))
    assert rows(od.earlier_conflicts(needs)) == [(2, 1, 1), (3, 1, 1)]


def test_restock_updates_and_inserts(spark):
    stock = spark.createDataFrame([(1, 5, 7), (1, 6, 1)], STOCK)
    targets = spark.createDataFrame([(1, 6, 53), (1, 7, 60)], STOCK)
    assert rows(od.restock(stock, targets)) == [(1, 5, 7), (1, 6, 53), (1, 7, 60)]


def test_apply_and_undo(spark):
    stock = spark.createDataFrame([(1, 5, 7), (1, 6, 1)], STOCK)
    lines = spark.createDataFrame([(1, 1, 5, 3), (2, 1, 6, 2)], LINE)
    after = od.apply_lines(stock, lines)
    assert rows(after) == [(1, 5, 4, False), (1, 6, -1, True)]
    undone = lines.where("order_id = 2")
    assert rows(od.undo_stock(after.drop("below_zero"), stock, undone)) == [(1, 5, 4), (1, 6, 1)]
    assert rows(od.undo_lines(lines, undone)) == [(1, 1, 5, 3)]


@pytest.mark.parametrize("seed,hot", [(0, False), (1, True), (2, True)])
def test_fulfil_equals_the_serial_loop(spark, seed, hot):
    rng = random.Random(seed)
    stock = {(s, p): rng.randint(0, 60) for s in range(3) for p in range(6)}
    needs = []
    for order in range(60):
        keys = set(rng.sample(sorted(stock), rng.randint(1, 3)))
        if hot and order % 3:
            keys.add((0, 0))  # one product in two thirds of the orders
        if rng.random() < 0.05:
            keys.add((9, 9))  # not in stock
        needs += [(order, s, p, rng.randint(1, 12)) for s, p in keys]
    got = od.fulfil(
        od.needs(spark.createDataFrame(needs, LINE)),
        spark.createDataFrame([(s, p, n) for (s, p), n in stock.items()], STOCK),
        block=7,
    )
    assert {r["order_id"]: r["accepted"] for r in got.collect()} == serial(needs, stock)


def test_fulfil_on_the_test_tables_equals_the_serial_loop(spark):
    folder = "/root/testdata/sf0.001"
    t = Tables(spark, folder)
    needs = [tuple(r) for r in od.needs(fixtures.order_lines(t)).collect()]
    stock = {(r["site"], r["product"]): r["inventory"] for r in fixtures.stock(t).collect()}
    got = {r["order_id"]: r["accepted"] for r in QUERIES["tbl_fulfil_waves"](spark, folder).collect()}
    assert got == serial(needs, stock)
    assert 0 < sum(got.values()) < len(got)


def test_orders_are_numbered_by_name(spark):
    lines = spark.createDataFrame([("b", 1), ("a", 2), ("b", 3)], "order_id string, amount int")
    assert rows(od.number_orders(lines).select("order_name", "order_id", "amount")) == [("a", 0, 2), ("b", 1, 1), ("b", 1, 3)]


def test_audits(spark):
    df = spark.createDataFrame([(1, 5), (1, 6), (2, None)], "k int, v int")
    assert rows(au.duplicate_keys(df, "k")) == [(1, 2)]
    # NULL breaks no rule
    assert rows(au.broken_rules(df, {"small": F.col("v") < 6, "known": F.col("v").isNotNull()})) == [("known", 1), ("small", 1)]
    parent = spark.createDataFrame([(1,), (1,)], "id int")
    assert rows(au.orphans(df, parent, ["k"], ["id"])) == [(2, None)]
    assert rows(au.cascade_delete(df, parent, ["k"], ["id"])) == [(2, None)]
    with pytest.raises(ValueError):
        au.broken_rules(df, {})


def test_rounds_write_fewer_and_fewer_lines(spark, monkeypatch):
    """Only lines of open orders are written again; a verdict is written once."""
    rng = random.Random(3)
    stock = {(0, p): 40 for p in range(8)}
    needs = [(order, 0, p, rng.randint(1, 9)) for order in range(120) for p in rng.sample(range(8), 2)]
    written = []

    def counted(df):
        kept = cut_lineage(df)
        written.append((set(kept.columns), kept.count()))
        return kept

    monkeypatch.setattr(od, "cut_lineage", counted)
    got = od.fulfil(spark.createDataFrame(needs, LINE), spark.createDataFrame([(s, p, n) for (s, p), n in stock.items()], STOCK))
    verdicts = {r["order_id"]: r["accepted"] for r in got.collect()}
    assert got.count() == len(verdicts) == 120 and verdicts == serial(needs, stock)
    rounds = [n for columns, n in written if "taken" in columns]
    assert len(rounds) > 2 and rounds == sorted(rounds, reverse=True) and rounds[-1] < rounds[0] / 2
    # one scan of the verdicts' folder, however many rounds there were
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1
