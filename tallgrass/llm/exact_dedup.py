"""Exact duplicates by content sort, with DataFrame functions only.

The rows are range-partitioned by sampled splitters on their normalised content, each partition
is sorted externally, and rows next to each other are compared in full.  What the splitters are
drawn from is a bounded key (the first bytes, then the digest), so the driver never holds whole
texts; equal texts have equal keys, so the order still puts them side by side, and only the full
comparison of the texts decides.

Groups of copies that are too large for one task get a third key, a salt of the row id and the part
of the input that the row comes from (ids may be null or repeat): the group is then cut over many tasks, each task hands on one row of it, and these few are compared
in full once more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallgrass.llm.names import free_names
from tallgrass.plans.lineage import cut_lineage

#: Copies of one text that one task may take without a salt; for tables of more than
#: HOT_ROWS * HOT_TEXTS rows the share 1 / HOT_TEXTS of all rows instead.
HOT_ROWS = 256
#: At most so many texts are salted, whatever the size of the table: their list is broadcast.
HOT_TEXTS = 100_000
#: Bytes of normalised text a partition of the sort is meant to hold.
PARTITION_BYTES = 64 << 20
#: Bytes of the content that take part in the splitters, before the digest.
KEY_CHARS = 16


def normalise_space(text: Column) -> Column:
    """Null is the empty text; every run of blank, tab, LF, VT, FF, CR is one blank."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: which row of its group of equal texts stays.

    Returns doc_id, keep_id (the smallest id of the group), group_size, kept, text_sha256.
    Null and empty texts are one group.  Rows with a null id come last in their group; of rows
    that repeat an id one is kept, the others are not.  An empty table gives no rows.  Other
    columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), normalise_space(F.col(text_col)).alias("norm"))
    rows = rows.withColumn("digest", F.sha2("norm", 256)).withColumn("dealt", F.xxhash64("doc_id", F.spark_partition_id()))

    # how many rows share a digest, and the volume of the table
    counts = cut_lineage(rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("norm")).alias("size")))
    total, volume = counts.agg(F.sum("n"), F.sum("size")).first()
    limit = max(HOT_ROWS, (total or 0) // HOT_TEXTS)
    # fewer than HOT_TEXTS digests can have more than total / HOT_TEXTS rows each
    hot = counts.where(F.col("n") > limit).select("digest", F.ceil(F.col("n") / limit).alias("salts"))
    salted = rows.join(F.broadcast(hot), "digest", "left").withColumn(
        "salt", F.when(F.col("salts").isNotNull(), F.pmod("dealt", "salts")).otherwise(F.lit(-1))
    ).drop("salts", "dealt")

    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(volume or 0) // PARTITION_BYTES))
    ranged = salted.withColumn("head", F.substring("norm", 1, KEY_CHARS)).repartitionByRange(parts, "head", "digest", "salt")
    # the range partitioning already holds a group together: the window sorts within the
    # partition (spilling to disk) and compares each row with the one before it in full
    run = Window.partitionBy("head", "digest", "salt", "norm").orderBy(F.col("doc_id").asc_nulls_last())
    whole = Window.partitionBy("head", "digest", "salt", "norm")
    placed = cut_lineage(
        ranged.select(
            "doc_id", "digest", "salt",
            F.first("doc_id").over(run).alias("first_id"),
            F.row_number().over(run).alias("place"),
            F.count(F.lit(1)).over(whole).alias("n"),
            "norm",
        ).withColumn("norm", F.when((F.col("salt") >= 0) & (F.col("place") == 1), F.col("norm")))
    )

    cold = placed.where("salt < 0").select(
        "doc_id", F.col("first_id").alias("keep_id"), F.col("n").alias("group_size"), F.col("place") == 1, "digest"
    )
    # one row per salt of a large group
    heads = placed.where(F.col("norm").isNotNull()).select("digest", "norm", "salt", "first_id", "n")
    # rows that repeat the smallest id can lie under several salts: one of them stays
    least = F.min(F.struct(F.col("first_id").isNull(), "first_id", "salt"))
    groups = heads.groupBy("digest", "norm").agg(least.alias("least"), F.sum("n").alias("group_size")).select(
        "digest", "norm", F.col("least.first_id").alias("keep_id"), F.col("least.salt").alias("keep_salt"), "group_size"
    )
    members = heads.join(groups, ["digest", "norm"]).select("digest", "salt", "first_id", "keep_id", "keep_salt", "group_size")
    warm = placed.where("salt >= 0").select("doc_id", "digest", "salt", "first_id", "place")
    warm = warm.join(
        members.select("digest", "salt", F.col("first_id").alias("head_id"), "keep_id", "keep_salt", "group_size"),
        (warm["digest"] == members["digest"]) & (warm["salt"] == members["salt"]) & warm["first_id"].eqNullSafe(F.col("head_id")),
    ).select(
        warm["doc_id"], "keep_id", "group_size",
        (F.col("place") == 1) & (warm["salt"] == F.col("keep_salt")), warm["digest"],
    )
    return cold.union(warm).toDF("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of rows that repeat an id and a text one."""
    judged = cut_lineage(exact_duplicates(docs, id_col, text_col))
    sha, kept_id, kept_sha = free_names(docs, "sha", "kept_id", "kept_sha")
    kept = judged.where("kept").select(F.col("doc_id").alias(kept_id), F.col("text_sha256").alias(kept_sha))
    keyed = docs.withColumn(sha, F.sha2(normalise_space(F.col(text_col)), 256))
    out = keyed.join(kept, F.col(id_col).cast("long").eqNullSafe(F.col(kept_id)) & (F.col(sha) == F.col(kept_sha)), "left_semi")
    # a dropped row that has the id of the row that stays: the id and the text occur twice
    if not judged.where(~F.col("kept") & F.col("doc_id").eqNullSafe(F.col("keep_id"))).isEmpty():
        out = out.dropDuplicates([id_col, sha])
    return out.drop(sha)
