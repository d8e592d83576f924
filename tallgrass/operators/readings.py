"""Weather readings: cleaning, monthly partial sums, their merge, and year-over-year features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

# fixed values: field names of the incoming payload and of the stage tables
READING_FIELDS = {
    "StationId": "string",
    "Date": "string",
    "Variable": "string",
    "Value": "int",
    "M_Flag": "string",
    "Q_Flag": "string",
    "S_Flag": "string",
    "ObsTime": "string",
}
READING_SCHEMA = ", ".join(f"{name} {kind}" for name, kind in READING_FIELDS.items())
VARIABLES = ("PRCP", "TMAX", "TMIN", "SNWD")
NON_NEGATIVE = ("PRCP", "SNWD")
MONTH_KEYS = ["StationId", "Year_Rec", "Month_Rec"]
LAG_NAMES = {1: "ONE_YEAR_PRCP", 2: "TWO_YEAR_PRCP", 5: "FIVE_YEAR_PRCP"}


def decode_json(df: DataFrame, schema: T.StructType | str, value: str = "value") -> DataFrame:
    """Expand a JSON text column; an unreadable payload becomes a row of NULLs."""
    return df.select(F.from_json(F.col(value).cast("string"), schema).alias("_doc")).select("_doc.*")


def drop_flagged(df: DataFrame) -> DataFrame:
    """Keep readings without a quality flag and drop the columns no later step reads."""
    return df.where(F.col("Q_Flag").isNull()).drop("M_Flag", "Q_Flag", "S_Flag", "ObsTime")


def with_date_parts(df: DataFrame) -> DataFrame:
    """Year and month from a yyyyMMdd text."""
    return (
        df.withColumn("Year_Rec", F.substring("Date", 1, 4).cast("int"))
        .withColumn("Month_Rec", F.substring("Date", 5, 2).cast("int"))
        .drop("Date")
    )


def season_of(month: Column) -> Column:
    """1 for December to February, up to 4 for September to November."""
    return (F.floor(month % 12 / 3) + 1).cast("int")


def keep_variables(
    df: DataFrame,
    variables: Sequence[str] = VARIABLES,
    non_negative: Sequence[str] = NON_NEGATIVE,
    min_year: int = 1950,
) -> DataFrame:
    """Keep the known variables from ``min_year`` on; some of them may not be negative."""
    free = [v for v in variables if v not in non_negative]
    bounded = [v for v in variables if v in non_negative]
    rule = F.col("Variable").isin(free) | (F.col("Variable").isin(bounded) & (F.col("Value") >= 0))
    return df.where((F.col("Year_Rec") >= min_year) & rule)


def clean(df: DataFrame, min_year: int = 1950) -> DataFrame:
    """All row filters of stage one.  Malformed payloads (no station) are dropped by name."""
    readable = df.where(F.col("StationId").isNotNull())
    return keep_variables(with_date_parts(drop_flagged(readable)), min_year=min_year)


def monthly_partials(df: DataFrame) -> DataFrame:
    """Sum and count per station, month and variable, in long form."""
    return df.groupBy(*MONTH_KEYS, "Variable").agg(
        F.sum("Value").cast("long").alias("batch_sum"), F.count(F.lit(1)).alias("batch_count")
    )


def pivot_partials(partials: DataFrame, variables: Sequence[str] = VARIABLES) -> DataFrame:
    """Long partials to one row per month; variables without rows get NULL columns."""
    wide = (
        partials.groupBy(*MONTH_KEYS)
        .pivot("Variable", list(variables))
        .agg(F.first("batch_count").alias("batch_count"), F.first("batch_sum").alias("batch_sum"))
    )
    return wide.select(*MONTH_KEYS, *[f"{v}_batch_{part}" for v in variables for part in ("count", "sum")])


def stage_one(df: DataFrame, min_year: int = 1950, variables: Sequence[str] = VARIABLES) -> DataFrame:
    """Raw readings to wide monthly partials in a single shuffle.

    Same rows as ``pivot_partials(monthly_partials(clean(df)))``: each variable is a
    conditional sum, so partial aggregation runs before the one exchange and a station with
    a third of all readings still sends one row per month and task.
    """
    columns = []
    for v in variables:
        is_v = F.col("Variable") == v
        columns.append(F.nullif(F.count(F.when(is_v, 1)), F.lit(0)).cast("long").alias(f"{v}_batch_count"))
        columns.append(F.sum(F.when(is_v, F.col("Value"))).cast("long").alias(f"{v}_batch_sum"))
    wide = clean(df, min_year).groupBy(*MONTH_KEYS).agg(*columns)
    return wide.withColumn("Season", season_of(F.col("Month_Rec")))


def merge_partials(
    partials: DataFrame, variables: Sequence[str] = VARIABLES, scales: dict[str, float] | None = None
) -> DataFrame:
    """Stage two: merge the partials of all batches to monthly averages.

    ``scales`` divides the average of a variable, e.g. ``{"TMAX": 10}`` for tenths of a degree.
    """
    scales = scales or {}
    merged = partials.groupBy(*MONTH_KEYS).agg(
        F.avg("Season").alias("Season"),
        *[F.sum(f"{v}_batch_{part}").alias(f"_{v}_{part}") for v in variables for part in ("sum", "count")],
    )
    averages = [(F.col(f"_{v}_sum") / F.col(f"_{v}_count") / F.lit(scales.get(v, 1))).alias(v) for v in variables]
    return merged.select(*MONTH_KEYS, "Season", *averages)


def year_lags(monthly: DataFrame, lags: dict[int, str] = LAG_NAMES, value: str = "PRCP", nullable: Sequence[int] = (2,)) -> DataFrame:
    """Attach ``value`` of the same station and month some years back.

    Every lagged row must exist; its value must be known too, except for lags in
    ``nullable``.  One row per station, year and month is assumed, so a window holds at most
    one row per year: one shuffle on (station, month) instead of a join per lag.
    """
    base = Window.partitionBy("StationId", "Month_Rec").orderBy("Year_Rec")
    out = monthly
    keep = F.lit(True)
    for years, name in lags.items():
        frame = base.rangeBetween(-years, -years)
        found = F.max(F.struct(F.lit(1).alias("there"), F.col(value).alias("v"))).over(frame)
        out = out.withColumn(f"_lag_{years}", found)
        keep = keep & F.col(f"_lag_{years}").isNotNull()
        if years not in nullable:
            keep = keep & F.col(f"_lag_{years}.v").isNotNull()
    return out.where(keep).select(*monthly.columns, *[F.col(f"_lag_{y}.v").alias(n) for y, n in lags.items()])


def previous_row(monthly: DataFrame, value: str = "PRCP", name: str = "PREV_PRCP") -> DataFrame:
    """``value`` of the preceding row of the station and month, whatever its year."""
    order = Window.partitionBy("StationId", "Month_Rec").orderBy("Year_Rec")
    return monthly.withColumn(name, F.lag(value, 1).over(order))


def learning_table(lagged: DataFrame, stations: DataFrame) -> DataFrame:
    """Lag features with the station's elevation; Spark broadcasts the stations if they are small."""
    return lagged.join(stations, "StationId").select(
        *MONTH_KEYS, "PRCP", "TMAX", "TMIN", *LAG_NAMES.values(), "SNWD", "Elevation"
    )


def station_prefix(df: DataFrame, prefixes: Sequence[str], column: str = "StationId") -> DataFrame:
    if not prefixes:
        raise ValueError("at least one prefix is needed")
    rule = F.lit(False)
    for prefix in prefixes:
        rule = rule | F.col(column).startswith(prefix)
    return df.where(rule)


def align_columns(batch: DataFrame, target: DataFrame) -> DataFrame:
    """Union in which either side gets NULL for columns only the other one has."""
    return target.unionByName(batch, allowMissingColumns=True)


def decade_of(year: Column) -> Column:
    return (F.floor(year / 10) * 10).cast("int")
