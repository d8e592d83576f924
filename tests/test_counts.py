from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallgrass.operators import counts as ct


def test_winner_of_equal_counts_is_the_first_by_name(spark):
    df = spark.createDataFrame([("r", "b", 3), ("r", "a", 3), ("r", "c", 1), ("s", "z", 1)], "region string, country string, cnt long")
    assert rows(ct.winner_per_group(df, "region", "country")) == [("r", "a", 3), ("s", "z", 1)]


def test_rates_are_rounded_before_they_are_compared(spark):
    df = spark.createDataFrame([("a", 311), ("b", 312), ("c", 310)], "country string, cnt long")
    # 311/31 = 10.03 rounds to 10.0 and is out, 312/31 = 10.06 rounds to 10.1
    assert rows(ct.rate_above(df, 31, 10).select("country", "rate")) == [("b", 10.1)]
    with pytest.raises(ValueError):
        ct.rate_above(df, 0, 10)


def test_year_range_is_inclusive(spark):
    df = spark.createDataFrame([(y,) for y in (1979, 1980, 2000, 2001)], "year int")
    assert rows(ct.in_years(df, 1980, 2000)) == [(1980,), (2000,)]
    with pytest.raises(ValueError):
        ct.in_years(df, 2000, 1980)


def test_spans_means_and_closest_day(spark):
    day = 86400
    trips = [("j", 0), ("j", 10), ("j", day), ("j", day + 30), ("j", 2 * day + 5), ("k", 7)]
    spans = ct.daily_spans(spark.createDataFrame(trips, "journey_id string, epoch long"))
    assert rows(spans) == [("j", "1970/01/01", 10), ("j", "1970/01/02", 30), ("j", "1970/01/03", 0), ("k", "1970/01/01", 0)]
    # mean 13.33: 10 is closest
    assert rows(ct.span_summary(spans))[1] == ("k", 0.0, "1970/01/01")
    assert ct.span_summary(spans).where("journey_id = 'j'").first()["closest_day"] == "1970/01/01"
    both = ct.spans_with_summary(spans)
    assert both.groupBy("kind").count().orderBy("kind").collect() == [("day", 4), ("summary", 2)]


def test_closest_day_of_equal_gaps_is_the_earlier(spark):
    spans = spark.createDataFrame([("j", "2020/01/02", 10), ("j", "2020/01/01", 20)], "journey_id string, day string, span long")
    assert ct.span_summary(spans).first()["closest_day"] == "2020/01/01"


def test_calendar_parts(spark):
    day, time_of_day = ct.calendar_parts(F.lit(86399))
    assert tuple(spark.range(1).select(day, time_of_day).first()) == ("1970/01/01", "23:59:59")
