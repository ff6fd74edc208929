"""The operators over their whole tables, with production parameters, and check SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from popscan.llm import (
    backoff_lm, block_anchors, chat_render, collocations, edit_lattice, line_rules, line_templates, partenum, piece_agenda,
    quality_convnet, string_tiling, suffix_merge, warc_zstd,
)
from popscan.llm.storage import fresh, stored

PIECES = "piece_bpe_32k.model"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_convnet(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = (F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "UTF-8")) % 5) == 0
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    net = quality_convnet.train(documents, labels.filter(~held_out), "quality")
    scored = quality_convnet.score(documents.select("doc_id", "text"), net)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


def op2_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = line_rules.judge(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_removed_words",
    )


def op3_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_templates.drop_recurring(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op4_chat_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"),
    )
    rows = table(spark, sf_dir, "conversations").select(*probe.columns).unionByName(probe)
    return chat_render.read_back(chat_render.render(rows, append_only=True))  # marks never change earlier output


def op5_backoff_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = backoff_lm.score(table(spark, sf_dir, "documents").select("doc_id", "text"), order=3)
    return scored.select("doc_id", "n_words", F.round("log_score", 4).alias("log_score"))


def op6_warc_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh(spark, "archives")
    index = stored(warc_zstd.write_archives(warc_zstd.roles(table(spark, sf_dir, "pages")), folder), "archive-index")
    return warc_zstd.read_archives(spark, folder, index, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op7_block_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_anchors.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), 35)


def op8_partenum(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = partenum.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), 4, 85)
    return groups.select("doc_id", "n_shingles", "component_id")


def op9_piece_agenda(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = piece_agenda.encode(documents, public_tokenizers.path(PIECES), digest=True)
    return coded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op10_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = string_tiling.contamination(documents, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "contaminated", "item_id", F.round("coverage", 6).alias("coverage"), "n_items")


def op11_suffix_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_merge.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), 50)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return cut.select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


def op12_phrase_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents").select("lang", "text"))


def op13_edit_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    hurt, copies = edit_lattice.damaged(table(spark, sf_dir, "conversations"))
    return edit_lattice.summaries(edit_lattice.repair(hurt, copies))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_quality_convnet, op2_line_rules, op3_line_templates, op4_chat_render, op5_backoff_lm, op6_warc_zstd,
            op7_block_anchors, op8_partenum, op9_piece_agenda, op10_string_tiling, op11_suffix_merge,
            op12_phrase_rollup, op13_edit_lattice,
        )
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_line_rules": line_rules.ORACLE,
        "op3_line_templates": line_templates.ORACLE,
        "op5_backoff_lm": backoff_lm.ORACLE,
        "op12_phrase_rollup": collocations.ORACLE,
    }
