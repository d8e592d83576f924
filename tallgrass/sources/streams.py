"""Streaming sources that deliver one text payload per row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def kafka_options(servers: str, topics: list[str], rows_per_trigger: int, start: str = "earliest") -> dict[str, str]:
    if rows_per_trigger < 1:
        raise ValueError("rows_per_trigger must be positive")
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "maxOffsetsPerTrigger": str(rows_per_trigger),
        "startingOffsets": start,
    }


def open_stream(spark: SparkSession, source: str, options: dict[str, str], path: str | None = None) -> DataFrame:
    """A stream of text payloads in one column ``value``, from Kafka or from text files."""
    reader = spark.readStream.format(source).options(**options)
    stream = reader.load(path) if path else reader.load()
    return stream.select(F.col("value").cast("string").alias("value"))
