"""Repeatable pseudo-random order and splits from a hash of the row id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallgrass.plans.ordering import row_index


def shuffle_key(row_id: Column | str, seed: int) -> Column:
    """md5 of ``seed:id``; the same text on any engine, so a split can be checked elsewhere."""
    column = F.col(row_id) if isinstance(row_id, str) else row_id
    return F.md5(F.concat(F.lit(f"{seed}:"), column.cast("string")))


def hash_split(df: DataFrame, row_id: str, share: float, seed: int, name: str = "is_train") -> DataFrame:
    """Flag about ``share`` of the rows; a filter on the hash, so no shuffle and no state."""
    if not 0 < share < 1:
        raise ValueError("share must lie between 0 and 1")
    limit = format(int(share * 2**32), "08x")
    return df.withColumn(name, F.substring(shuffle_key(row_id, seed), 1, 8) < limit)


def shuffled(df: DataFrame, row_id: str, seed: int, name: str = "pos") -> DataFrame:
    """Add the position of each row in a seeded permutation of the whole table."""
    mixed = df.withColumn("_mix", shuffle_key(row_id, seed))
    return row_index(mixed, "_mix", row_id, name=name).drop("_mix")


def exact_split(df: DataFrame, row_id: str, train_rows: int, seed: int, name: str = "is_train") -> DataFrame:
    """The first ``train_rows`` of the permutation are training rows, the rest test rows."""
    return shuffled(df, row_id, seed, "_pos").withColumn(name, F.col("_pos") < train_rows).drop("_pos")
