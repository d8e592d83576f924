"""Cutting the plan of iterative jobs by writing an intermediate table."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame

from tallgrass.session import new_folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the written table.

    The rows survive the loss of executors, the plan of a loop does not grow, and the rows are
    computed once (a checkpoint would compute the last stage twice).  Later steps read only
    the columns they need, and Spark knows the true size when it chooses a join.
    """
    path = new_folder(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def bucketed(df: DataFrame, key: str, rows: int, bucket_rows: int = 1 << 19) -> Iterator[DataFrame]:
    """``df`` of ``rows`` rows written once to the shared folder in sorted buckets of ``key``.

    There are as many buckets as shuffle partitions, more if a bucket would pass ``bucket_rows`` rows.

    Joins on the key inside the block read the buckets as they lie and shuffle only the other side.
    The catalog entry goes at the end of the block; the files stay, as those of other cuts.
    """
    spark = df.sparkSession
    name = f"bucketed_{uuid.uuid4().hex}"
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // bucket_rows))
    # dealt by the key first: a file per bucket, not one per bucket and task
    dealt = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).format("parquet")
    dealt.option("path", new_folder(spark, "buckets")).saveAsTable(name)
    try:
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
