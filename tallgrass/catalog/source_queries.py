"""Queries that write derived rows to the shared folder and read them back."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallgrass.catalog import fixtures as fx
from tallgrass.catalog.registry import Tables, query
from tallgrass.operators import nested
from tallgrass.operators import readings as rd
from tallgrass.session import new_folder
from tallgrass.sources import files, streams
from tallgrass.streaming import etl


@query("src_fixed_width", """
SELECT CASE s_nationkey % 3 WHEN 0 THEN 'SW' WHEN 1 THEN 'GM' ELSE 'IS' END || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') AS "StationId",
       s_suppkey % 180 - 89.75 AS "Latitude", s_nationkey + 0.5 AS "Longitude", floor(s_acctbal) AS "Elevation"
FROM supplier WHERE s_nationkey % 3 < 2
""")
def src_fixed_width(t: Tables) -> DataFrame:
    prefix = F.element_at(F.array(F.lit("SW"), F.lit("GM"), F.lit("IS")), F.col("s_nationkey") % 3 + 1)
    line = F.format_string(
        "%s%s%9.4f %9.4f %6.0f  %s",
        prefix, F.lpad(F.col("s_suppkey").cast("string"), 9, "0"),
        F.col("s_suppkey") % 180 - 89.75, F.col("s_nationkey") + 0.5, F.floor("s_acctbal").cast("double"), F.col("s_name"),
    )
    folder = new_folder(t.spark, "stations")
    t.supplier.select(line.alias("value")).write.text(folder)
    return rd.station_prefix(files.read_fixed_width(t.spark, folder), ["SW", "GM"])


@query("src_csv_positional", f"WITH {fx.INCIDENTS_SQL} SELECT year, country, region FROM incidents")
def src_csv_positional(t: Tables) -> DataFrame:
    rows = fx.incidents(t)
    other = F.lit("x")
    folder = new_folder(t.spark, "incidents")
    rows.select(
        "year", *[other.alias(f"c{i}") for i in range(1, 7)], "country", other.alias("c8"), "region", "incident_id"
    ).write.csv(folder, header=True)
    return files.read_positional_csv(t.spark, folder, width=11)


@query("src_csv_frame", "SELECT p_partkey, p_name, p_size, p_retailprice FROM part")
def src_csv_frame(t: Tables) -> DataFrame:
    folder = new_folder(t.spark, "parts")
    t.part.select("p_partkey", "p_name", "p_size", "p_retailprice").write.csv(folder, header=False)
    schema = "p_partkey bigint, p_name string, p_size int, p_retailprice double"
    return files.read_csv(t.spark, folder, schema, header=False)


@query("src_csv_dir_orders", """
SELECT strftime(l_shipdate, '%Y-%m') AS order_id, l_suppkey AS site, l_partkey AS product, CAST(floor(l_quantity) AS INTEGER) AS amount
FROM lineitem
""")
def src_csv_dir_orders(t: Tables) -> DataFrame:
    # one folder of files per order: Spark names the files itself, so the id is the folder
    folder = new_folder(t.spark, "orders")
    lines = t.lineitem.select(
        F.date_format("l_shipdate", "yyyy-MM").alias("order_id"),
        F.col("l_suppkey").alias("site"), F.col("l_partkey").alias("product"), F.floor("l_quantity").cast("int").alias("amount"),
    )
    # REBALANCE gives few files per folder and splits a folder that is far larger than the rest
    lines.hint("rebalance", "order_id").write.partitionBy("order_id").csv(folder)
    by_folder = F.regexp_extract(F.col("_metadata.file_path"), r"order_id=([^/]*)/", 1)
    return files.read_order_files(t.spark, folder, order_id=by_folder)


@query("src_kv_lines", f"WITH {fx.TRIPS_SQL} SELECT * FROM trips")
def src_kv_lines(t: Tables) -> DataFrame:
    folder = new_folder(t.spark, "trips")
    fields = F.struct(F.col("journey_id").alias("JourneyId"), F.col("epoch").cast("string").alias("Timestamp"))
    fx.trips(t).select(F.to_json(fields).alias("value")).write.text(folder)
    return files.trips_from_kv(files.read_kv_lines(t.spark, folder))


def _nested_records(t: Tables) -> DataFrame:
    """One nested record per event; some records lack a key, lists have one or two elements."""
    step = F.struct(F.col("event_type").alias("name"), F.col("value").alias("amount"))
    odd = F.col("event_id") % 2 == 1
    record = F.struct(
        F.col("event_id").alias("id"),
        F.struct(F.col("user_id").alias("user"), F.when(odd, F.struct(F.lit("web").alias("kind"))).alias("via")).alias("who"),
        F.when(odd, F.array(step, step)).otherwise(F.array(step)).alias("steps"),
        F.array().cast("array<string>").alias("tags"),
    )
    folder = new_folder(t.spark, "nested")
    t.events.select(F.to_json(record).alias("value")).write.text(folder)
    return files.read_nested_json(t.spark, folder)


_PATHS = """
SELECT event_id AS record, 'steps.0.amount' AS path, CAST(value AS VARCHAR) AS value FROM events
UNION ALL SELECT event_id, 'steps.0.name', event_type FROM events
UNION ALL SELECT event_id, 'who.user', CAST(user_id AS VARCHAR) FROM events
UNION ALL SELECT event_id, 'steps.1.amount', CAST(value AS VARCHAR) FROM events WHERE event_id % 2 = 1
UNION ALL SELECT event_id, 'steps.1.name', event_type FROM events WHERE event_id % 2 = 1
UNION ALL SELECT event_id, 'who.via.kind', 'web' FROM events WHERE event_id % 2 = 1
"""


@query("src_json_nested", """
SELECT event_id AS id, user_id AS "user", CASE WHEN event_id % 2 = 1 THEN 2 ELSE 1 END AS n_steps, value AS first_amount FROM events
""")
def src_json_nested(t: Tables) -> DataFrame:
    return _nested_records(t).select(
        "id", "who.user", F.size("steps").alias("n_steps"), F.col("steps")[0]["amount"].alias("first_amount")
    )


@query("prj_flatten_json", _PATHS)
def prj_flatten_json(t: Tables) -> DataFrame:
    return nested.to_paths(_nested_records(t), "id")


_UNION_SQL = """
SELECT CAST(event_id AS VARCHAR) AS id, CAST(value AS VARCHAR) AS steps_0_amount, event_type AS steps_0_name,
       CASE WHEN event_id % 2 = 1 THEN CAST(value AS VARCHAR) ELSE '' END AS steps_1_amount,
       CASE WHEN event_id % 2 = 1 THEN event_type ELSE '' END AS steps_1_name,
       CAST(user_id AS VARCHAR) AS who_user, CASE WHEN event_id % 2 = 1 THEN 'web' ELSE '' END AS who_via_kind
FROM events
"""


@query("prj_header_union", _UNION_SQL)
def prj_header_union(t: Tables) -> DataFrame:
    return nested.fill_missing(nested.flatten(_nested_records(t), separator="_"))


@query("snk_tsv", _UNION_SQL)
def snk_tsv(t: Tables) -> DataFrame:
    flat = nested.flatten(_nested_records(t), separator="_")
    folder = new_folder(t.spark, "tsv")
    files.write_tsv(flat, folder)
    schema = ", ".join(f"{c} string" for c in sorted(flat.columns))
    return t.spark.read.csv(folder, schema=schema, sep="\t", header=True).na.fill("")


@query("snk_partition_decade", f"""
WITH {fx.MONTHLY_SQL} SELECT *, CAST(floor("Year_Rec" / 10.0) * 10 AS INTEGER) AS decade FROM monthly
""")
def snk_partition_decade(t: Tables) -> DataFrame:
    folder = new_folder(t.spark, "decades")
    files.write_by_decade(rd.merge_partials(rd.stage_one(fx.readings(t))), folder)
    # every decade is read back, each with the one its folder names
    return t.spark.read.parquet(folder)


STREAM_BATCHES = 5


def _payload_stream(t: Tables) -> DataFrame:
    """The readings as JSON payload files, read back as a stream of about five micro-batches."""
    folder = new_folder(t.spark, "payloads")
    rows = fx.readings(t)
    payload = F.to_json(F.struct(*rd.READING_FIELDS))
    per_file = rows.count() // STREAM_BATCHES + 1
    rows.select(payload.alias("value")).write.option("maxRecordsPerFile", per_file).text(folder)
    files_written = len(t.spark.read.text(folder).inputFiles())
    per_batch = -(-files_written // STREAM_BATCHES)
    return streams.open_stream(t.spark, "text", {"maxFilesPerTrigger": str(per_batch)}, folder)


_DECODED = f"""
WITH {fx.READINGS_SQL}
SELECT "StationId", "Date", "Variable", "Value", "M_Flag", "Q_Flag", "S_Flag", "ObsTime" FROM readings
"""


@query("src_stream_json", _DECODED)
def src_stream_json(t: Tables) -> DataFrame:
    # the source alone: payloads are kept as they came, and decoded from the table they went to
    target = new_folder(t.spark, "payload_rows")
    etl.run_available(_payload_stream(t), etl.batch_writer(target), new_folder(t.spark, "progress"))
    return rd.decode_json(etl.read_batches(t.spark, target).select("value"), rd.READING_SCHEMA)


@query("stm_raw_append", _DECODED)
def stm_raw_append(t: Tables) -> DataFrame:
    target = new_folder(t.spark, "raw")
    etl.raw_append(_payload_stream(t), target, new_folder(t.spark, "progress"))
    return etl.read_batches(t.spark, target).drop("batch_id")


@query("stm_etl", f"WITH {fx.MONTHLY_SQL} SELECT * FROM monthly")
def stm_etl(t: Tables) -> DataFrame:
    target = new_folder(t.spark, "partials")
    etl.monthly_etl(_payload_stream(t), target, new_folder(t.spark, "progress"))
    return rd.merge_partials(etl.read_batches(t.spark, target))


@query("snk_foreach_batch", f"""
WITH {fx.CLEAN_SQL}
SELECT "StationId", "Variable", "Value", "Year_Rec", "Month_Rec" FROM cleaned
""")
def snk_foreach_batch(t: Tables) -> DataFrame:
    target = new_folder(t.spark, "clean")
    stream = rd.decode_json(_payload_stream(t), rd.READING_SCHEMA)
    etl.run_available(stream, etl.batch_writer(target, rd.clean), new_folder(t.spark, "progress"))
    return etl.read_batches(t.spark, target).select("StationId", "Variable", "Value", "Year_Rec", "Month_Rec")


@query("stm_batch_id", """
SELECT count(*) AS n_rows, 0 AS first_batch, TRUE AS several, TRUE AS without_gap FROM lineitem
""")
def stm_batch_id(t: Tables) -> DataFrame:
    target = new_folder(t.spark, "stamped")
    etl.raw_append(_payload_stream(t), target, new_folder(t.spark, "progress"))
    per_batch = etl.read_batches(t.spark, target).groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"))
    batches = F.count(F.lit(1))
    return per_batch.agg(
        F.sum("n").alias("n_rows"), F.min("batch_id").alias("first_batch"),
        (batches > 1).alias("several"), (F.max("batch_id") + 1 == batches).alias("without_gap"),
    )


@query("stm_limit", """
SELECT count(*) * 3 // 5 - 7 AS n_rows, 0 AS n_foreign_or_repeated, TRUE AS reached, TRUE AS stopped_early FROM lineitem
""")
def stm_limit(t: Tables) -> DataFrame:
    total = t.lineitem.count() * 3 // 5 - 7
    target = new_folder(t.spark, "limited")
    stream = rd.decode_json(_payload_stream(t), rd.READING_SCHEMA)
    reached = etl.run_limited(stream, target, total, new_folder(t.spark, "progress"))
    kept = etl.read_batches(t.spark, target)
    columns = list(rd.READING_FIELDS)
    # rows beyond those of the source, counted with repetition
    strange = kept.select(*columns).exceptAll(fx.readings(t).select(*columns))
    counts = kept.agg(F.count(F.lit(1)).alias("n_rows"), F.max("batch_id").alias("_last"))
    return counts.crossJoin(strange.agg(F.count(F.lit(1)).alias("n_foreign_or_repeated"))).select(
        "n_rows", "n_foreign_or_repeated", F.lit(reached).alias("reached"), (F.col("_last") < STREAM_BATCHES - 1).alias("stopped_early")
    )


@query("stm_trigger_bounded", """
SELECT l_returnflag AS flag, count(*) AS n FROM lineitem GROUP BY 1
""")
def stm_trigger_bounded(t: Tables) -> DataFrame:
    folder, target = new_folder(t.spark, "flags"), new_folder(t.spark, "flagged")
    t.lineitem.select(F.col("l_returnflag").alias("value")).write.text(folder)
    stream = streams.open_stream(t.spark, "text", {}, folder)
    query = etl.start(stream, etl.batch_writer(target), new_folder(t.spark, "progress"), every="1 second")
    query.processAllAvailable()
    etl.run_for(query, 1)
    return etl.read_batches(t.spark, target).groupBy(F.col("value").alias("flag")).agg(F.count(F.lit(1)).alias("n"))
