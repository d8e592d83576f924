"""Positions, ranks and running sums that never move a whole table or a hot group to one task.

``row_number`` over an unpartitioned window, or over a key that holds a third of the rows,
runs in a single task.  Here the rows are range-partitioned on the full order instead, so
every task gets an equal slice, and only per-slice counts are combined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallgrass.plans.lineage import cut_lineage

# monotonically_increasing_id() is (partition << 33) + row number in the partition
_PARTITION_SHIFT = 33


def row_index(df: DataFrame, *order: Column | str, name: str = "idx") -> DataFrame:
    """Add the 0-based position of each row under ``order``.

    ``order`` must be a total order (end it with a unique column); this also lets the range
    partitioner split a hot leading key over many tasks.
    """
    if not order:
        raise ValueError("row_index needs an order")
    if name in ("_slice", "_place", "_offset"):
        raise ValueError(f"{name} is used inside row_index")
    ranged = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    placed = cut_lineage(ranged).withColumn("_slice", F.shiftright("_place", _PARTITION_SHIFT))
    # one count per partition comes back, a few thousand numbers at most
    sizes = placed.groupBy("_slice").agg(F.count(F.lit(1)).alias("_rows")).collect()
    offsets, total = [], 0
    for part in sorted(sizes):
        offsets.append((part["_slice"], total))
        total += part["_rows"]
    offset = df.sparkSession.createDataFrame(offsets, "_slice long, _offset long")
    in_slice = F.col("_place") - F.shiftleft(F.col("_slice"), _PARTITION_SHIFT)
    return (
        placed.join(F.broadcast(offset), "_slice")
        .withColumn(name, F.col("_offset") + in_slice)
        .drop("_slice", "_place", "_offset")
    )


def rank_in_group(df: DataFrame, keys: list[str], order: list[Column | str], name: str = "rank") -> DataFrame:
    """Add the 1-based rank inside each group of ``keys``; equals row_number over the group.

    The global position minus the position of the group's first row; a group of any size is
    spread over as many tasks as its share of the rows asks for.
    """
    placed = row_index(df, *keys, *order, name="_at")
    starts = placed.groupBy(*keys).agg(F.min("_at").alias("_start"))
    return placed.join(starts, keys).withColumn(name, F.col("_at") - F.col("_start") + 1).drop("_at", "_start")


def fold_of(index: Column, rows: Column | int, folds: int) -> Column:
    """0-based fold of a row position: contiguous folds, the first ``rows % folds`` one larger."""
    if folds < 2:
        raise ValueError("folds must be at least 2")
    n = F.lit(rows) if isinstance(rows, int) else rows
    size = F.floor(n / folds)
    larger = n % folds
    boundary = larger * (size + 1)
    return F.when(index < boundary, F.floor(index / (size + 1))).otherwise(
        larger + F.floor((index - boundary) / F.greatest(size, F.lit(1)))
    ).cast("int")


def sums_before(df: DataFrame, keys: list[str], seq: str, values: dict[str, Column], block: int = 65536) -> DataFrame:
    """Exclusive running sums inside ``keys`` along the integer ``seq`` (one row per key and seq).

    Two levels: rows are cut into blocks of ``block`` consecutive sequence numbers, so one
    task never holds more than ``block`` rows of a key; block totals carry over.
    """
    blocked = df.withColumn("_block", F.floor(F.col(seq) / block))
    for name, value in values.items():
        blocked = blocked.withColumn(f"_v_{name}", value)
    names = list(values)
    totals = blocked.groupBy(*keys, "_block").agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in names])
    before_blocks = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        *keys, "_block", *[F.coalesce(F.sum(f"_t_{n}").over(before_blocks), F.lit(0)).alias(f"_c_{n}") for n in names]
    )
    before_rows = (
        Window.partitionBy(*keys, "_block").orderBy(seq).rowsBetween(Window.unboundedPreceding, -1)
    )
    inner = blocked.select(
        "*", *[F.coalesce(F.sum(f"_v_{n}").over(before_rows), F.lit(0)).alias(f"_i_{n}") for n in names]
    )
    joined = inner.join(carried, [*keys, "_block"])
    for n in names:
        joined = joined.withColumn(n, F.col(f"_c_{n}") + F.col(f"_i_{n}"))
    return joined.drop("_block", *[f"{p}{n}" for n in names for p in ("_v_", "_c_", "_i_")])
