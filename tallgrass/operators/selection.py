"""Row selection by position and label codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallgrass.plans.ordering import fold_of, row_index


def slice_rows(df: DataFrame, order: list[Column | str], first: int, last: int, name: str = "part") -> DataFrame:
    """Rows at positions [first, last) are marked "validation", all others "train"."""
    if not 0 <= first <= last:
        raise ValueError("0 <= first <= last is required")
    inside = (F.col("_pos") >= first) & (F.col("_pos") < last)
    marked = row_index(df, *order, name="_pos").withColumn(name, F.when(inside, "validation").otherwise("train"))
    return marked.drop("_pos")


def with_folds(df: DataFrame, order: list[Column | str], folds: int, name: str = "fold") -> DataFrame:
    """Contiguous folds along a total order; the first rows % folds of them are one row larger."""
    indexed = row_index(df, *order, name="_pos")
    return indexed.withColumn(name, fold_of(F.col("_pos"), df.count(), folds)).drop("_pos")


def encode_labels(df: DataFrame, label: str, position: str, name: str = "code") -> DataFrame:
    """Integer codes in order of first appearance along ``position`` (unique per row)."""
    firsts = df.groupBy(label).agg(F.min(position).alias("_first"))
    codes = row_index(firsts, "_first", name=name).withColumn(name, F.col(name).cast("int")).drop("_first")
    return df.join(codes, label)


def first_rows(df: DataFrame, order: list[Column | str], k: int) -> DataFrame:
    if k < 0:
        raise ValueError("k must not be negative")
    return df.orderBy(*order).limit(k)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()
