from __future__ import annotations

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallgrass.operators import readings as rd

RAW = [
    ("SW1", "19500131", "PRCP", 4, None, None, None, None),
    ("SW1", "19500115", "PRCP", 6, None, None, None, None),
    ("SW1", "19500116", "PRCP", -1, None, None, None, None),  # negative rain
    ("SW1", "19491231", "TMAX", 9, None, None, None, None),  # too early
    ("SW1", "19501201", "TMAX", -5, None, None, None, None),
    ("GM2", "19501201", "TMIN", 3, None, "X", None, None),  # flagged
    ("GM2", "19501201", "SNWD", 2, None, None, None, None),
    ("GM2", "19501201", "WIND", 2, None, None, None, None),  # unknown variable
]


@pytest.fixture()
def raw(spark):
    return spark.createDataFrame(RAW, rd.READING_SCHEMA)


def test_stage_one_filters_and_aggregates(spark, raw):
    got = {tuple(r)[:3]: r for r in rd.stage_one(raw).collect()}
    assert set(got) == {("SW1", 1950, 1), ("SW1", 1950, 12), ("GM2", 1950, 12)}
    january = got[("SW1", 1950, 1)]
    assert (january["PRCP_batch_count"], january["PRCP_batch_sum"], january["Season"]) == (2, 10, 1)
    assert january["TMAX_batch_count"] is None and january["TMAX_batch_sum"] is None
    assert got[("SW1", 1950, 12)]["TMAX_batch_sum"] == -5


def test_stage_one_equals_the_long_form_and_its_pivot(spark, raw):
    direct = rd.stage_one(raw).drop("Season")
    pivoted = rd.pivot_partials(rd.monthly_partials(rd.clean(raw)))
    assert direct.columns == pivoted.columns and rows(direct) == rows(pivoted)


def test_a_malformed_payload_is_dropped(spark):
    payload = spark.createDataFrame(
        [('{"StationId":"SW1","Date":"19600101","Variable":"TMAX","Value":7}',), ("{broken",)], "value string"
    )
    decoded = rd.decode_json(payload, rd.READING_SCHEMA)
    assert decoded.count() == 2
    assert rd.clean(decoded).count() == 1


def test_merged_partials_do_not_depend_on_the_batches(spark, raw):
    whole = rows(rd.merge_partials(rd.stage_one(raw)))
    for seed in range(3):
        rng = random.Random(seed)
        batch_of = [rng.randint(0, 2) for _ in RAW]
        partials = None
        for batch in sorted(set(batch_of)):
            part = [r for r, b in zip(RAW, batch_of) if b == batch]
            stage = rd.stage_one(spark.createDataFrame(part, rd.READING_SCHEMA))
            partials = stage if partials is None else partials.unionByName(stage)
        assert rows(rd.merge_partials(partials)) == whole


def test_scales_divide_the_average(spark, raw):
    got = rd.merge_partials(rd.stage_one(raw), scales={"TMAX": 10}).where("Month_Rec = 12 and StationId = 'SW1'").first()
    assert got["TMAX"] == -0.5


@pytest.mark.parametrize("month,season", [(1, 1), (2, 1), (3, 2), (5, 2), (6, 3), (8, 3), (9, 4), (11, 4), (12, 1)])
def test_seasons(spark, month, season):
    assert spark.range(1).select(rd.season_of(F.lit(month))).first()[0] == season


def test_lags_need_all_three_rows(spark):
    data = [("S", y, 1, float(y)) for y in range(2000, 2008) if y != 2004]
    data += [("T", y, 1, None if y == 2003 else float(y)) for y in (2000, 2003, 2004, 2005)]
    data += [("U", y, 1, None if y == 2004 else float(y)) for y in (2000, 2003, 2004, 2005)]
    monthly = spark.createDataFrame(data, "StationId string, Year_Rec int, Month_Rec int, PRCP double")
    got = rows(rd.year_lags(monthly))
    # S: 2005 lacks the row of 2004, 2006 that of 2004, 2007 has 2006, 2005 and 2002
    assert ("S", 2007, 1, 2007.0, 2006.0, 2005.0, 2002.0) in got
    assert [r[:2] for r in got if r[0] == "S"] == [("S", 2007)]
    # the value two years back may be unknown, the one of a year back may not
    assert [r for r in got if r[0] == "T"] == [("T", 2005, 1, 2005.0, 2004.0, None, 2000.0)]
    assert not [r for r in got if r[0] == "U"]


def test_lag_window_equals_the_joins(spark):
    rng = random.Random(4)
    data = [
        (s, y, m, rng.choice([None, float(rng.randint(0, 9))]))
        for s in "ABC" for y in range(1990, 2003) for m in (1, 2) if rng.random() < 0.9
    ]
    monthly = spark.createDataFrame(data, "StationId string, Year_Rec int, Month_Rec int, PRCP double")
    monthly.createOrReplaceTempView("m_test")
    joined = spark.sql("""
        SELECT m.*, a.PRCP, b.PRCP, c.PRCP FROM m_test m, m_test a, m_test b, m_test c
        WHERE m.StationId = a.StationId AND m.Month_Rec = a.Month_Rec AND m.Year_Rec = a.Year_Rec + 1
          AND m.StationId = b.StationId AND m.Month_Rec = b.Month_Rec AND m.Year_Rec = b.Year_Rec + 2
          AND m.StationId = c.StationId AND m.Month_Rec = c.Month_Rec AND m.Year_Rec = c.Year_Rec + 5
          AND a.PRCP IS NOT NULL AND c.PRCP IS NOT NULL""")
    assert rows(rd.year_lags(monthly)) == rows(joined)


def test_previous_row_ignores_the_year_gap(spark):
    monthly = spark.createDataFrame([("S", 2000, 1, 1.0), ("S", 2005, 1, 2.0)], "StationId string, Year_Rec int, Month_Rec int, PRCP double")
    assert rows(rd.previous_row(monthly).select("Year_Rec", "PREV_PRCP")) == [(2000, None), (2005, 1.0)]


def test_aligned_union_fills_missing_columns(spark):
    got = rd.align_columns(spark.createDataFrame([(1, "x")], "a int, b string"), spark.createDataFrame([(2,)], "a int"))
    assert rows(got) == [(1, "x"), (2, None)]


def test_prefix_needs_at_least_one(spark, raw):
    assert rd.station_prefix(raw, ["GM"]).count() == 3
    with pytest.raises(ValueError):
        rd.station_prefix(raw, [])
