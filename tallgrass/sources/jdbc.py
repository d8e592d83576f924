"""Database tables over JDBC.  Connection data always comes from the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None, **extra: str | int) -> dict[str, str]:
    options = {"url": url, "dbtable": table}
    if user is not None:
        options["user"] = user
    if password is not None:
        options["password"] = password
    options.update({k: str(v) for k, v in extra.items()})
    return options


def split_options(column: str, lower: int | str, upper: int | str, parts: int) -> dict[str, str]:
    """Options that make Spark read ranges of ``column`` in ``parts`` parallel connections."""
    if parts < 1:
        raise ValueError("parts must be at least 1")
    return {"partitionColumn": column, "lowerBound": str(lower), "upperBound": str(upper), "numPartitions": str(parts)}


def read_jdbc(spark: SparkSession, options: dict[str, str], split: dict[str, str] | None = None) -> DataFrame:
    """A database table; with ``split`` the scan is parallel, without it one task reads all."""
    return spark.read.format("jdbc").options(**options, **(split or {})).load()


def append_jdbc(df: DataFrame, options: dict[str, str]) -> None:
    df.write.format("jdbc").options(**options).mode("append").save()
