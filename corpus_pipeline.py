"""From raw documents to packed training sequences: five stages, each written before the next reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallgrass.llm import exact_dedup, language, near_join, packing, toxicity
from tallgrass.llm.names import free_names
from tallgrass.llm.queries import fold, vocabulary
from tallgrass.plans.lineage import cut_lineage
from tallgrass.session import load_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the rows whose toxicity score is 0.5 or more, whatever their ids.

    Null and empty texts have a score like any other text; repeated rows have equal scores and go or stay
    together.  Columns of any name stay; an empty table stays empty.
    """
    model = toxicity.learn(docs, load_table(spark, sf_dir, "labels"), fold(F.col("doc_id"), 5) != 0)
    (score,) = free_names(docs, "score")
    return toxicity.with_score(docs, model, name=score).where(F.col(score) < 0.5).drop(score)


def drop_undetermined(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the rows that have no language, whatever their ids: no text, or no letters in it.

    The language itself decides nothing here, as clean documents of every language stay.  Columns of
    any name stay; an empty table stays empty.
    """
    samples = language.labelled_sample(docs.where(fold(F.col("doc_id"), 4) != 2))
    names = free_names(docs, "lang", "certainty")
    return language.with_language(docs, samples, names=names).where(F.col(names[0]) != language.UNDETERMINED).drop(*names)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the smallest id; null and empty texts are one group.

    A null id counts as the largest; of rows that repeat an id and a text one stays.  Columns of
    any name stay; an empty table stays empty.
    """
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies (five-word shingles, similarity 0.8), the one with the smallest id.

    Rows are told apart by a number of their own, so a row that repeats an id, or has none, goes only for
    its own text.  A null id counts as the smallest.  Texts without words are copies of nothing
    here and stay.  An empty table stays empty; columns of any name stay.
    """
    (row,) = free_names(docs, "row")
    # written: the numbers must be the same whenever the rows are read
    numbered = cut_lineage(docs.withColumn(row, F.monotonically_increasing_id()))
    groups = near_join.near_groups(numbered, width=5, num=80, den=100, id_col=row)
    several = groups.select(F.col("doc_id").alias(row), "component_id").join(
        groups.where("component_id <> doc_id").select("component_id").distinct(), "component_id"
    )
    # the rows of groups of two and more: the first of each group stays
    members = cut_lineage(numbered.select(row, "doc_id").join(several, row))
    first = members.groupBy("component_id").agg(F.min(F.struct("doc_id", row))[row].alias(row))
    return numbered.join(members.select(row).join(first, row, "left_anti"), row, "left_anti").select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents that are left, in sequences of 2048 tokens; an empty table gives none.

    A null or empty text is the end token alone; rows that repeat an id, or have none, are packed each for itself.
    """
    pieces = packing.pack_documents(docs, vocabulary(), size=2048, end_id=1)
    return pieces.select("doc_id", "start", "length", F.crc32("token_ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("language", drop_undetermined),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("packing", pack),
]

#: Compression lengths, cross parsing and tokens are not expressible in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = load_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
