"""Registered queries of the training-data operators: opN_<name>.

Each applies its operator to the whole table and derives the digest columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from . import (
    alignment,
    best_fit,
    chat,
    decontaminate,
    html_extract,
    langid,
    licenses,
    near_dedup,
    packing,
    quality_gam,
    quality_rules,
    repair,
    token_counts,
)
from .common import crc_mod, staged, table


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), width=2)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", "lang", (crc_mod("doc_id", 3) == 1).alias("held_out"))
    protos = langid.prototypes(docs.where(~F.col("held_out")))
    return langid.predict(docs, protos, keep=["doc_id", "held_out"])


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Histogram of the encoded lengths with its suffix sums, one row per length."""
    docs = table(spark, sf_dir, "documents").select("text")
    lens = token_counts.lengths(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"),
                                public_tokenizers.PATTERN)
    hist = staged(token_counts.histogram(lens), "token-histogram")
    return token_counts.suffix_sums(hist)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = quality_rules.apply_policy(quality_rules.ledger(docs))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                       "n_repeat_words", quality_rules.fails("base").alias("base_failed"),
                       "kept", "failures")


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    # conversation -1: its texts hold the template's control strings
    text = f"{chat.CLOSE_REPLY}{chat.OPEN_TURN} ok {chat.CLOSE_TURN}"
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                F.when(F.col("id") == 0, "user").otherwise(chat.ASSISTANT).alias("role"),
                                F.lit(text).alias("text"))
    rows = chat.examples(turns.unionByName(own)).withColumn(
        "loss", chat.loss_text(F.col("text"), F.col("loss_start"), F.col("loss_end")))
    # read back: the last example holds every turn, each example its own reply
    convs = rows.groupBy("conv_id").agg(
        F.max_by("text", "example").alias("text"), F.sum(F.char_length("text")).alias("formatted_chars"),
        F.sort_array(F.collect_list(F.struct("example", "loss"))).alias("losses"))
    read = convs.select("conv_id", "formatted_chars", chat.parse_turns(F.col("text")).alias("turns"),
                        F.array_join(F.transform("losses", lambda x: x["loss"]), "").alias("loss"))
    flat = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"],
                                                               F.lit("\n"))), "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(flat.cast("binary"), 256).alias("turns_sha256"),
                       F.char_length("loss").cast("long").alias("loss_chars"),
                       F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
                       "formatted_chars")


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    paths = html_extract.winners(html_extract.votes(pages))
    rows = html_extract.extract(pages, paths, keep=["page_id", "url"])
    return rows.withColumn("n_chars", F.char_length("text").cast("long"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = licenses.scan(docs, keep=["doc_id"])
    return rows.select("doc_id", F.size("licenses").cast("long").alias("n_licenses"),
                       F.array_join(F.transform("licenses", lambda m: m["license"]), ",").alias("licenses"),
                       F.array_join(F.transform("licenses", lambda m: F.concat_ws(
                           "-", m["start"], m["end"])), ",").alias("spans"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", (crc_mod("doc_id", 5) == 0).alias("held_out"))
    labels = table(spark, sf_dir, "labels").where(crc_mod("doc_id", 5) != 0)
    model = quality_gam.fit(docs, labels)
    rows = quality_gam.score(docs, model, keep=["doc_id", "held_out"])
    return rows.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = decontaminate.scan(docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return rows.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.concat_ws(",", F.array_sort("items")).cast("binary"), 256)
                       .alias("items_sha256"), decontaminate.contaminated().alias("contaminated"))


def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                           public_tokenizers.path("piece_bpe_32k.model"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    convs, rows = repair.repair(repair.damaged(turns))
    every = turns.select(F.struct("conv_id").alias("k")).distinct()
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    found = every.join(convs, "k", "left").join(repair.digests(rows), "k", "left")
    return found.select(F.col("k.conv_id").alias("conv_id"), *[F.coalesce(c, F.lit(0)).alias(c) for c in counts],
                        F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    # documents and attention cost may fill a sequence: as few sequences as the tokens allow
    return best_fit.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


QUERIES = {
    "op1_near_dedup": op1_near_dedup,
    "op2_packing": op2_packing,
    "op3_language_id": op3_language_id,
    "op4_token_counts": op4_token_counts,
    "op5_quality_rules": op5_quality_rules,
    "op6_chat_formatting": op6_chat_formatting,
    "op7_html_extraction": op7_html_extraction,
    "op8_license_scan": op8_license_scan,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_decontamination": op10_decontamination,
    "op11_cross_tokenizer_alignment": op11_cross_tokenizer_alignment,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_best_fit_packing": op13_best_fit_packing,
}
