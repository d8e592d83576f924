"""Audits of table constraints: keys, value rules, references, and cascading deletes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def broken_rules(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows breaking each named rule, counted in one pass; as in SQL, NULL does not break a rule."""
    if not rules:
        raise ValueError("at least one rule is needed")
    counts = [F.count(F.when(~rule, 1)).alias(f"r{i}") for i, rule in enumerate(rules.values())]
    pairs = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"r{i}").alias("n_rows")) for i, n in enumerate(rules)])
    return df.agg(*counts).select(F.explode(pairs).alias("_r")).select("_r.rule", "_r.n_rows")


def orphans(child: DataFrame, parent: DataFrame, child_key: list[str], parent_key: list[str]) -> DataFrame:
    """Child rows whose key is not in the parent table."""
    match = [F.col(f"c.{c}") == F.col(f"p.{p}") for c, p in zip(child_key, parent_key, strict=True)]
    return child.alias("c").join(parent.select(*parent_key).distinct().alias("p"), match, "left_anti")


def cascade_delete(child: DataFrame, deleted: DataFrame, child_key: list[str], deleted_key: list[str]) -> DataFrame:
    """What is left of the child table when the deleted parents take their rows with them."""
    return orphans(child, deleted, child_key, deleted_key)
