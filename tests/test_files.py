from __future__ import annotations

import json

import pytest
from conftest import rows

from tallgrass.operators import nested
from tallgrass.sources import files, jdbc, streams

RECORDS = [
    {"id": 1, "a": {"b": [{"c": 1}, {"c": 2}]}, "empty": []},
    {"id": 2, "a": {"b": [{"d": "x"}]}, "list": [[1, 2], [3]]},
]


@pytest.mark.parametrize("multi_line", [False, True])
def test_flatten_names_leaves_by_path(spark, tmp_path, multi_line):
    path = tmp_path / "records.json"
    path.write_text(json.dumps(RECORDS) if multi_line else "\n".join(map(json.dumps, RECORDS)))
    flat = nested.flatten(files.read_nested_json(spark, str(path), multi_line=multi_line))
    assert flat.columns == ["a.b.0.c", "a.b.0.d", "a.b.1.c", "a.b.1.d", "id", "list.0.0", "list.0.1", "list.1.0"]
    filled = {r["id"]: r.asDict() for r in nested.fill_missing(flat).collect()}
    assert filled["1"]["a.b.1.c"] == "2" and filled["1"]["list.0.0"] == "" and filled["2"]["a.b.0.d"] == "x"
    assert rows(nested.to_paths(flat, "id").where("record = 2")) == [
        (2, "a.b.0.d", "x"), (2, "list.0.0", "1"), (2, "list.0.1", "2"), (2, "list.1.0", "3"),
    ]


def test_tsv_has_sorted_columns_and_empty_texts(spark, tmp_path):
    out = str(tmp_path / "tsv")
    files.write_tsv(spark.createDataFrame([(1, None, "x")], "b int, a string, c string").coalesce(1), out)
    (part,) = [p for p in (tmp_path / "tsv").iterdir() if p.suffix == ".csv"]
    assert part.read_text() == "a\tb\tc\n\t1\tx\n"


def test_fixed_width_lines(spark, tmp_path):
    line = "SW000000001" + " -12.5000" + " " + "  33.2500" + " " + " 123.4" + "  NAME"
    (tmp_path / "s.txt").write_text(line + "\nshort\n")
    assert rows(files.read_fixed_width(spark, str(tmp_path / "s.txt"))) == [
        ("SW000000001", -12.5, 33.25, 123.4), ("short", None, None, None),
    ]


@pytest.mark.parametrize("header", [True, False])
def test_positional_csv(spark, tmp_path, header):
    body = "1990,a,b,c,d,e,f,Peru,h,South,j\n1991,a,b,c,d,e,f,Chile,h,South,j\n"
    (tmp_path / "i.csv").write_text(("iyear,1,2,3,4,5,6,country,8,region,10\n" if header else "") + body)
    got = files.read_positional_csv(spark, str(tmp_path / "i.csv"), 11, header=header)
    assert rows(got) == [(1990, "Peru", "South"), (1991, "Chile", "South")]
    with pytest.raises(ValueError):
        files.positional_schema(5, files.INCIDENT_POSITIONS)


def test_order_files_take_the_id_from_the_file_name(spark, tmp_path):
    (tmp_path / "order_a.csv").write_text("﻿1,5,3\n1,6,2\n", encoding="utf-8")
    (tmp_path / "order_b.csv").write_text("2,5,1\n")
    got = files.read_order_files(spark, str(tmp_path))
    assert rows(got) == [("order_a", 1, 5, 3), ("order_a", 1, 6, 2), ("order_b", 2, 5, 1)]


def test_kv_lines(spark, tmp_path):
    (tmp_path / "t.txt").write_text('{"JourneyId":"5","Speed":"3","Timestamp":"1700000000"}\n')
    assert rows(files.trips_from_kv(files.read_kv_lines(spark, str(tmp_path / "t.txt")))) == [("5", 1700000000)]


def test_csv_with_and_without_header(spark, tmp_path):
    (tmp_path / "h.csv").write_text("a,b\n1,x\n")
    assert rows(files.read_csv(spark, str(tmp_path / "h.csv"), "a int, b string", header=True)) == [(1, "x")]
    assert files.read_csv(spark, str(tmp_path / "h.csv"), "a string, b string", header=False).count() == 2


def test_decades_are_folders(spark, tmp_path):
    df = spark.createDataFrame([(1989, 1), (1990, 2), (1999, 3)], "Year_Rec int, v int")
    files.write_by_decade(df, str(tmp_path / "d"))
    assert {p.name for p in (tmp_path / "d").iterdir() if p.is_dir()} == {"decade=1980", "decade=1990"}


def test_connection_options_come_from_the_caller():
    options = jdbc.jdbc_options("jdbc:x", "t", user="u", password="p", batchsize=500)
    assert options == {"url": "jdbc:x", "dbtable": "t", "user": "u", "password": "p", "batchsize": "500"}
    assert jdbc.split_options("id", 0, 10, 4)["numPartitions"] == "4"
    with pytest.raises(ValueError):
        jdbc.split_options("id", 0, 10, 0)
    assert streams.kafka_options("h:1", ["a", "b"], 1000)["subscribe"] == "a,b"
    with pytest.raises(ValueError):
        streams.kafka_options("h:1", ["a"], 0)


def test_flatten_refuses_two_leaves_of_one_name(spark):
    from tallgrass.operators.nested import flatten

    table = spark.sql("SELECT 'outer' AS a_b, named_struct('b', 'inner') AS a")
    with pytest.raises(ValueError, match="a_b"):
        flatten(table, "_")
    assert sorted(flatten(table, ".").columns) == ["a.b", "a_b"]


def test_paths_need_no_column_per_list_position(spark, tmp_path):
    path = tmp_path / "records.json"
    path.write_text("\n".join(map(json.dumps, RECORDS)))
    nest = files.read_nested_json(spark, str(path))
    by_path = rows(nested.to_paths(nest, "id"))
    assert by_path == rows(nested.to_paths(nested.flatten(nest), "id"))
    # a list of 1,000 entries changes neither the plan nor the order of the entries
    path.write_text(json.dumps({"id": 7, "a": {"b": [{"c": i} for i in range(1000)]}, "list": [[None, "x"], []]}))
    long = nested.to_paths(spark.read.schema(nest.schema).json(str(path)), "id")
    short = nested.to_paths(nest, "id")
    found = {r["path"]: r["value"] for r in long.collect()}
    assert found["a.b.999.c"] == "999" and len([p for p in found if p.startswith("a.b.")]) == 1000
    size = [len(df._jdf.queryExecution().optimizedPlan().toString().splitlines()) for df in (short, long)]
    assert size[0] == size[1] < 10


def test_paths_of_maps_nulls_and_odd_names(spark):
    table = spark.sql("""SELECT 1 AS id, map('k', array(named_struct('v', 1), NULL), 'n', NULL) AS m, CAST(NULL AS array<int>) AS a, named_struct('x.y', 2.5D) AS s
                         UNION ALL SELECT 2, map(), array(), NULL""")
    assert rows(nested.to_paths(table, "id")) == [(1, "m.k.0.v", "1"), (1, "s.x.y", "2.5")]
    assert nested.to_paths(spark.createDataFrame([], "id int, a array<int>"), "id").count() == 0


def test_a_reader_of_one_decade_skips_the_other_folders(spark, tmp_path):
    out = str(tmp_path / "d")
    files.write_by_decade(spark.createDataFrame([(y, y % 7) for y in range(1950, 2020)], "Year_Rec int, v int"), out)
    back = spark.read.parquet(out)
    assert rows(back.select("Year_Rec", "v", "decade")) == sorted((y, y % 7, y // 10 * 10) for y in range(1950, 2020))
    plan = back.where("decade = 1990")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(decade" in plan and "= 1990)" in plan
    assert {p.split("decade=")[1][:4] for p in (r[0] for r in back.where("decade = 1990").select("_metadata.file_path").collect())} == {"1990"}
