"""File sources and sinks: delimited text, fixed-width text, JSON lines, Parquet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

# fixed values: (column, first character from 1, width, type) of a station line
STATION_FIELDS = (
    ("StationId", 1, 11, "string"),
    ("Latitude", 12, 9, "double"),
    ("Longitude", 22, 9, "double"),
    ("Elevation", 32, 6, "double"),
)

# fixed values: positions of the columns an incident file is read for
INCIDENT_POSITIONS = {0: ("year", "int"), 7: ("country", "string"), 9: ("region", "string")}

ORDER_LINE_SCHEMA = "site bigint, product bigint, amount int"


def read_fixed_width(spark: SparkSession, path: str, fields: tuple = STATION_FIELDS) -> DataFrame:
    """Cut lines of text into typed columns by position."""
    lines = spark.read.text(path)
    return lines.select(
        *[F.trim(F.substring("value", first, width)).try_cast(kind).alias(name) for name, first, width, kind in fields]
    )


def positional_schema(width: int, positions: dict[int, tuple[str, str]]) -> str:
    """Schema of a delimited file of which only some positions have a known name and type."""
    if max(positions) >= width:
        raise ValueError("a named position lies beyond the last column")
    fields = (positions.get(i, (f"_c{i}", "string")) for i in range(width))
    return ", ".join(f"`{name}` {kind}" for name, kind in fields)


def read_positional_csv(
    spark: SparkSession, path: str, width: int, positions: dict[int, tuple[str, str]] = INCIDENT_POSITIONS, header: bool = True
) -> DataFrame:
    """Columns of a delimited file chosen by position; only those are parsed."""
    schema = positional_schema(width, positions)
    frame = spark.read.csv(path, schema=schema, header=header, enforceSchema=True)
    return frame.select(*[name for name, _ in positions.values()])


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, header: bool) -> DataFrame:
    return spark.read.csv(path, schema=schema, header=header)


def read_order_files(spark: SparkSession, path: str, header: bool = False, order_id: Column | None = None) -> DataFrame:
    """Order lines of all files below ``path``; the file name without its ending is the order id.

    ``order_id`` may derive the id from ``_metadata`` in another way, e.g. from the folder.
    """
    name = order_id if order_id is not None else F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]*$", "")
    lines = spark.read.option("recursiveFileLookup", "true").csv(path, schema=ORDER_LINE_SCHEMA, header=header)
    return lines.select(name.alias("order_id"), "site", "product", "amount")


def read_kv_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines such as ``{"JourneyId":"5","Timestamp":"1700000000"}`` as one text map per line."""
    return spark.read.text(path).select(F.from_json("value", "map<string,string>").alias("fields"))


def trips_from_kv(lines: DataFrame) -> DataFrame:
    return lines.select(
        F.col("fields")["JourneyId"].alias("journey_id"), F.col("fields")["Timestamp"].cast("long").alias("epoch")
    )


def read_nested_json(
    spark: SparkSession, path: str, multi_line: bool = False, schema: T.StructType | str | None = None
) -> DataFrame:
    """Nested records; without a ``schema`` one pass over the data infers it.

    One record per line is split over tasks; a file that is one JSON array
    (``multi_line=True``) is read by one task per file.
    """
    reader = spark.read.option("multiLine", multi_line)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def write_tsv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Tab-separated text with a header, columns in name order, missing values empty."""
    columns = sorted(df.columns)
    texts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in columns]
    df.select(*texts).write.mode(mode).csv(path, sep="\t", header=True, emptyValue="")


def write_by_decade(df: DataFrame, path: str, year: str = "Year_Rec", mode: str = "errorifexists") -> None:
    """One folder per decade, so a reader of some decades skips the rest."""
    from tallgrass.operators.readings import decade_of

    df.withColumn("decade", decade_of(F.col(year))).write.mode(mode).partitionBy("decade").parquet(path)
