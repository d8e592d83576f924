"""Group counts, per-group winners and journey spans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def in_years(df: DataFrame, first: int, last: int, year: str = "year") -> DataFrame:
    if last < first:
        raise ValueError("the year range is empty")
    return df.where(F.col(year).between(first, last))


def count_by(df: DataFrame, *keys: str, name: str = "cnt") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def winner_per_group(counts: DataFrame, group: str, member: str, count: str = "cnt") -> DataFrame:
    """The member with the highest count in each group; of equals the first by name.

    The least (-count, member) is a plain aggregate that combines before the shuffle; a
    rank window would sort each group in one task.
    """
    best = F.min(F.struct((-F.col(count)).alias("neg"), F.col(member).alias("member")))
    return counts.groupBy(group).agg(best.alias("_best")).select(
        group, F.col("_best.member").alias(member), (-F.col("_best.neg")).alias(count)
    )


def rate_above(counts: DataFrame, years: int, threshold: float, count: str = "cnt", name: str = "rate") -> DataFrame:
    """Average count per year, rounded to one place, kept where it exceeds ``threshold``."""
    if years < 1:
        raise ValueError("years must be at least 1")
    return counts.withColumn(name, F.round(F.col(count) / years, 1)).where(F.col(name) > threshold)


def calendar_parts(epoch: Column) -> tuple[Column, Column]:
    """Day ``yyyy/MM/dd`` and time of day ``HH:mm:ss`` of epoch seconds, in UTC."""
    moment = F.timestamp_seconds(epoch)
    return F.date_format(moment, "yyyy/MM/dd"), F.date_format(moment, "HH:mm:ss")


def daily_spans(trips: DataFrame) -> DataFrame:
    """Seconds between the first and the last reading of each journey and day."""
    day, _ = calendar_parts(F.col("epoch"))
    return trips.groupBy("journey_id", day.alias("day")).agg((F.max("epoch") - F.min("epoch")).alias("span"))


def span_summary(spans: DataFrame) -> DataFrame:
    """Mean span of each journey and the day closest to it; of equals the earlier day.

    Both steps are aggregates with partial combination, so a journey with very many days is
    not gathered in one task.
    """
    means = spans.groupBy("journey_id").agg(F.avg("span").alias("mean_span"))
    gap = F.struct(F.abs(F.col("span") - F.col("mean_span")).alias("gap"), F.col("day"))
    return (
        spans.join(means, "journey_id")
        .groupBy("journey_id")
        .agg(F.first("mean_span").alias("mean_span"), F.min(gap).alias("_closest"))
        .select("journey_id", "mean_span", F.col("_closest.day").alias("closest_day"))
    )


def spans_with_summary(spans: DataFrame) -> DataFrame:
    """Day rows and one summary row per journey in one frame, told apart by ``kind``."""
    detail = spans.select("journey_id", F.lit("day").alias("kind"), "day", F.col("span").cast("double").alias("seconds"))
    total = span_summary(spans).select(
        "journey_id", F.lit("summary").alias("kind"), F.col("closest_day").alias("day"), F.col("mean_span").alias("seconds")
    )
    return detail.unionByName(total)
