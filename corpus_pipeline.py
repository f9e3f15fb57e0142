"""The training-corpus pipeline: quality, line dedup, near-dedup, decontamination, mixing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir),
works on every row of ``docs`` and returns a DataFrame, which is written as
Parquet and read again as the next one's ``docs``. All but the last return the
columns of ``documents``; the last returns one row per document that the mix
takes, with the words it takes of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pickwise.llm import decontam, lines, minhash, mixing, quality
from pickwise.llm.queries import table
from pickwise.llm.storage import prepare, stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
NEAR = (100, 80)  # 100 * shared shingles >= 80 * all: the stage has no contract of its own, so 0.8 holds
ORACLE_SQL = None  # a fitted model and a seeded selection have no SQL form


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores under 0.5 go."""
    prepare(spark)
    docs = docs.select(*COLUMNS)
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).filter(F.col("score") >= 0.5).select(*COLUMNS)


def drop_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found on many sources keep their first occurrence only; no document goes."""
    prepare(spark)
    out = lines.dedup_lines(docs.select(*COLUMNS), lines.sites_needed(docs))
    n_chars = F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", n_chars).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (similarity ``NEAR`` or more) the document with the smallest id stays.

    Texts of one id are documents of their own, ordered by a hash; equal rows stay
    or go together, and documents without an id all stay.
    """
    prepare(spark)
    # nodes are texts of an id, by a 64-bit hash, so that another text of the same id is another document
    node = F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", F.col("text")))
    found = minhash.near_duplicates(docs.select(node.alias("doc_id"), "text"), threshold=NEAR)
    found = stored(found.select(F.col("doc_id").alias("_node"), F.col("component_id").alias("_group"))
                   .filter("_node is not null").distinct(), "pipeline-found")
    groups = (found.groupBy("_group").agg(F.min("_node").alias("a"), F.max("_node").alias("b"))
              .filter("a < b").select("_group"))
    members = stored(docs.select("doc_id", node.alias("_node")).distinct()
                     .join(found.join(groups, "_group", "left_semi"), "_node"), "pipeline-members")
    first = members.groupBy("_group").agg(F.min(F.struct("doc_id", "_node")).alias("first"))
    gone = stored(members.join(first, "_group").filter(F.col("first") != F.struct("doc_id", "_node"))
                  .select("_node"), "pipeline-copies")
    return docs.select(*COLUMNS).join(gone, node == F.col("_node"), "left_anti")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with benchmark windows over at least one word in twenty go."""
    prepare(spark)
    return decontam.decontaminate(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words taken of each document so that the sources come to their target weights."""
    prepare(spark)
    plan = mixing.mix_sources(docs, F.array("source"))
    return plan.filter(F.col("taken") > 0).select(
        "doc_id", F.element_at("sources", 1).alias("source"), "size", "source_size", "target", "taken")


STAGES = [
    ("quality", drop_low_quality),
    ("line_dedup", drop_boilerplate_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
