"""Streaming jobs: raw append, two-stage monthly aggregation, and a total row limit.

Every sink writes the rows of micro-batch N to the folder ``batch_id=N`` with overwrite, so a
batch that is replayed after a failure replaces itself and nothing is counted twice.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tallgrass.operators.readings import READING_SCHEMA, decode_json, stage_one

Handler = Callable[[DataFrame, int], None]


def batch_writer(target: str, transform: Callable[[DataFrame], DataFrame] = lambda df: df) -> Handler:
    """A foreachBatch handler that writes ``transform(batch)`` below ``target/batch_id=N``."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    return handle


def start(stream: DataFrame, handler: Handler, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Start a stream: each ``every`` (e.g. "120 seconds"), or once over all that is available."""
    writer = stream.writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def run_for(query: StreamingQuery, seconds: int) -> bool:
    """Wait up to ``seconds``, then stop; True if the stream ended by itself."""
    if seconds <= 0:
        raise ValueError("seconds must be positive")
    try:
        return bool(query.awaitTermination(seconds))
    finally:
        query.stop()


def run_available(stream: DataFrame, handler: Handler, checkpoint: str) -> None:
    query = start(stream, handler, checkpoint)
    try:
        query.awaitTermination()
    finally:
        query.stop()


def read_batches(spark: SparkSession, target: str) -> DataFrame:
    """All rows written so far, each with the ``batch_id`` it came in."""
    return spark.read.parquet(target)


def raw_append(payloads: DataFrame, target: str, checkpoint: str, schema: T.StructType | str = READING_SCHEMA) -> None:
    run_available(decode_json(payloads, schema), batch_writer(target), checkpoint)


def monthly_etl(payloads: DataFrame, target: str, checkpoint: str, min_year: int = 1950) -> None:
    """Decode, filter and aggregate each micro-batch; ``merge_partials`` finishes the job."""
    handler = batch_writer(target, lambda batch: stage_one(batch, min_year))
    run_available(decode_json(payloads, READING_SCHEMA), handler, checkpoint)


def limited_writer(target: str, total: int, reached: Callable[[], None] = lambda: None) -> Handler:
    """Pass rows on until ``total`` rows have been written over all batches, then call ``reached``.

    The running total travels with the batches: batch N leaves the rows written up to and with
    it in ``target/_totals/batch_id=N``, and batch N + 1 starts from there.  A replayed batch reads
    the total before it and writes both its rows and its total anew, so neither a replay nor a
    restart changes the result, and the rows in the sink are never listed or counted.  Batches
    behind the limit leave only their total, and no folder for rows.

    A streaming ``limit`` sends every row through one task.  Here the rows of each task of the
    batch are counted (one number a task comes back), and only in the batch that crosses the limit
    do the tasks keep prefixes of their rows.
    """
    if total < 0:
        raise ValueError("total must not be negative")

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = _written(spark, target, batch_id - 1)
        if before >= total and batch_id > 0:
            _set_written(spark, target, batch_id, before)
            reached()
            return
        placed = batch.withColumn("_place", F.monotonically_increasing_id()).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            task = F.shiftright("_place", 33)
            sizes = placed.groupBy(task.alias("_slice")).agg(F.count(F.lit(1)).alias("_rows")).collect()
            rows = sum(size["_rows"] for size in sizes)
            kept = placed
            if before + rows > total:
                room, quota = total - before, []
                for size in sorted(sizes):
                    take = min(room, size["_rows"])
                    quota.append((size["_slice"], take))
                    room -= take
                # one row per task of this batch
                share = F.broadcast(spark.createDataFrame(quota, "_slice long, _take long"))
                kept = placed.withColumn("_slice", task).join(share, "_slice").where(F.col("_place") - F.shiftleft("_slice", 33) < F.col("_take"))
            kept.drop("_slice", "_take", "_place").write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")
        finally:
            placed.unpersist()
        written = min(total, before + rows)
        # behind the rows: a total that can be read belongs to rows that are there
        _set_written(spark, target, batch_id, written)
        if written == total:
            reached()

    return handle


def _total_path(target: str, batch_id: int) -> str:
    return f"{target}/_totals/batch_id={batch_id}"


def _written(spark: SparkSession, target: str, batch_id: int) -> int:
    """Rows written up to and with the batch; 0 before the first one."""
    if batch_id < 0:
        return 0
    return spark.read.schema("written long").json(_total_path(target, batch_id)).first()["written"]


def _set_written(spark: SparkSession, target: str, batch_id: int, rows: int) -> None:
    total = spark.range(1).select(F.lit(rows).cast("long").alias("written"))
    total.coalesce(1).write.mode("overwrite").json(_total_path(target, batch_id))


def run_limited(stream: DataFrame, target: str, total: int, checkpoint: str) -> bool:
    """Write ``total`` rows of the stream and stop it; True if the limit was reached.

    The query stops as soon as a batch reports the limit, whatever the source still holds.
    """
    full = threading.Event()
    query = start(stream, limited_writer(target, total, full.set), checkpoint)
    try:
        # wakes up for either end
        while not full.is_set() and not query.awaitTermination(1):
            pass
    finally:
        query.stop()
    return full.is_set()
