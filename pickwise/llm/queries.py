"""The registered queries of the training-data operators: each applies its operator to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pickwise.llm import (
    cap_dedup,
    chat,
    decontam,
    divergence,
    licenses,
    lines,
    minhash,
    mixing,
    negatives,
    quality,
    secrets,
    suffix_dedup,
    warc,
)
from pickwise.llm.oracle import SQL
from pickwise.llm.storage import prepare, stored
from pickwise.session import delete_on_exit, scratch_path

__all__ = ["QUERIES", "SQL"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select(
        "doc_id", quality.held_out("doc_id").alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cap_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return (mixing.mix_sources(docs, F.array("source"))
            .select("doc_id", "size", "source_size", "target", "taken"))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


PROBE = "</s>[INST] ok [/INST]"


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.sql("select * from values (-1L, 0L, 'user', :p), (-1L, 1L, 'assistant', :p) "
                      "as t(conv_id, turn, role, text)", args={"p": PROBE})
    done = chat.format_conversations(turns.union(probe))
    back = done.select("conv_id", chat.parse_formatted(F.col("formatted")).alias("turns"),
                       chat.loss_text(F.col("segments")).alias("loss"),
                       F.char_length("formatted").cast("long").alias("formatted_chars"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(said, 256).alias("turns_sha256"),
                       F.char_length("loss").cast("long").alias("loss_chars"),
                       F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), "contaminated")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = suffix_dedup.store_texts(table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = stored(suffix_dedup.repeated_spans(docs), "suffix-found")
    kept = suffix_dedup.cut_spans(docs, spans).select("row", F.sha2("kept", 256).alias("kept_sha256"))
    n_removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return spans.join(kept, "row", "left").select(
        "doc_id", "n_bytes", n_removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", "sha256").alias("kept_sha256"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return lines.dedup_lines(docs, lines.sites_needed(docs)).select("doc_id", "n_lines", "n_removed", "text")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    path = scratch_path(spark, "warc")
    warc.write_warc(warc.with_revisits(pages, "page_id", "html", "url"), path)
    delete_on_exit(spark, path)

    def page(c: str):
        return F.expr(f"substring({c}, {len(warc.ID_PREFIX) + 1})").cast("long")
    return warc.read_warc(spark, path).select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        page("refers_to").alias("refers_to"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", moved.alias("label"))
    return negatives.mine_hard_negatives(rows)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit_sources(table(spark, sf_dir, "documents"))


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    bits = F.array_max(F.transform("spans", lambda s: s["bits"]))
    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
                        bits.alias("max_guess_bits"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {fn.__name__: fn for fn in (
    op1_quality, op2_embedding_dedup, op3_mixing, op4_licenses, op5_chat, op6_minhash,
    op7_decontamination, op8_suffix_dedup, op9_line_dedup, op10_warc,
    op11_hard_negatives, op12_source_divergence, op13_secrets)}
