from __future__ import annotations

import json

import pytest
from conftest import rows

from tallgrass.operators import readings as rd
from tallgrass.sources import streams
from tallgrass.streaming import etl


def payload(station, date, variable, value, flag=None):
    return json.dumps({"StationId": station, "Date": date, "Variable": variable, "Value": value, "Q_Flag": flag})


@pytest.fixture()
def source(spark, tmp_path):
    """Three payload files: one micro-batch each; the first one has no PRCP at all."""
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.txt").write_text("\n".join([payload("S", "19600101", "TMAX", 4), "{broken"]))
    (folder / "b.txt").write_text("\n".join([payload("S", "19600102", "TMAX", 6), payload("S", "19600103", "PRCP", 2)]))
    (folder / "c.txt").write_text(payload("S", "19600104", "PRCP", 8, "X"))
    return str(folder)


def open_source(spark, source):
    return streams.open_stream(spark, "text", {"maxFilesPerTrigger": "1"}, source)


def test_etl_result_is_the_batch_result(spark, source, tmp_path):
    target = str(tmp_path / "out")
    etl.monthly_etl(open_source(spark, source), target, str(tmp_path / "cp"))
    batches = etl.read_batches(spark, target)
    whole = rd.stage_one(rd.decode_json(spark.read.text(source), rd.READING_SCHEMA))
    assert rows(rd.merge_partials(batches)) == rows(rd.merge_partials(whole))
    assert rd.merge_partials(batches).first()["TMAX"] == 5.0


def test_a_replayed_batch_replaces_itself(spark, source, tmp_path):
    target = str(tmp_path / "out")
    handler = etl.batch_writer(target)
    batch = spark.range(5)
    handler(batch, 0)
    handler(batch, 0)
    handler(batch, 1)
    assert etl.read_batches(spark, target).count() == 10


def test_restart_reads_only_what_is_new(spark, source, tmp_path):
    target, progress = str(tmp_path / "out"), str(tmp_path / "cp")
    etl.raw_append(open_source(spark, source), target, progress)
    etl.raw_append(open_source(spark, source), target, progress)
    assert etl.read_batches(spark, target).count() == 5
    (tmp_path / "in" / "d.txt").write_text(payload("S", "19600105", "TMIN", 1))
    etl.raw_append(open_source(spark, source), target, progress)
    assert etl.read_batches(spark, target).count() == 6


@pytest.mark.parametrize("total,kept", [(0, 0), (3, 3), (25, 25), (100, 60)])
def test_limit_over_all_batches(spark, tmp_path, total, kept):
    handler = etl.limited_writer(str(tmp_path / "out"), total)
    for i in range(3):
        handler(spark.range(i * 20, i * 20 + 20, numPartitions=4), i)
    handler(spark.range(20, 40, numPartitions=4), 1)  # a replay in the middle
    assert etl.read_batches(spark, str(tmp_path / "out")).count() == kept
    with pytest.raises(ValueError):
        etl.limited_writer("x", -1)


def test_bounded_run_stops_the_query(spark, source, tmp_path):
    query = etl.start(open_source(spark, source), etl.batch_writer(str(tmp_path / "out")), str(tmp_path / "cp"), every="1 second")
    query.processAllAvailable()
    assert etl.run_for(query, 1) is False
    assert not query.isActive
    with pytest.raises(ValueError):
        etl.run_for(query, 0)


def test_limit_keeps_its_total_with_the_batches(spark, tmp_path):
    target = tmp_path / "out"
    calls = []
    handler = etl.limited_writer(str(target), 30, lambda: calls.append(1))
    batches = [spark.range(i * 20, i * 20 + 20, numPartitions=4) for i in range(4)]
    for i in (0, 1, 2, 3):
        handler(batches[i], i)
    handler(batches[1], 1)  # a replay of the batch that crosses the limit
    kept = sorted(r["id"] for r in etl.read_batches(spark, str(target)).collect())
    assert len(kept) == len(set(kept)) == 30 and set(range(20)) < set(kept) <= set(range(40))
    # no folder for rows behind the limit, and the total is known without the rows
    assert sorted(p.name for p in target.iterdir()) == ["_totals", "batch_id=0", "batch_id=1"]
    assert [etl._written(spark, str(target), i) for i in range(-1, 4)] == [0, 20, 30, 30, 30]
    assert len(calls) == 4


def test_a_limited_run_stops_itself_and_stays_full(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for i in range(12):
        (folder / f"{i:02}.txt").write_text("\n".join(f"{i}-{j}" for j in range(10)))
    target, progress = str(tmp_path / "out"), str(tmp_path / "cp")
    assert etl.run_limited(open_source(spark, str(folder)), target, 25, progress) is True
    kept = [r["value"] for r in etl.read_batches(spark, target).collect()]
    assert len(kept) == len(set(kept)) == 25
    # started again, nothing is added
    assert etl.run_limited(open_source(spark, str(folder)), target, 25, progress) is True
    assert etl.read_batches(spark, target).count() == 25
    assert etl.run_limited(open_source(spark, str(folder)), str(tmp_path / "all"), 1000, str(tmp_path / "cp2")) is False
    assert etl.read_batches(spark, str(tmp_path / "all")).count() == 120
