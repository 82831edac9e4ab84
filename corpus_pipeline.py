"""Training-corpus pipeline: language ID, quality rules, near-dedup,
decontamination, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame, which is written as Parquet and read again as the
next stage's ``docs``.  All but the last return the columns of ``docs``.

Defined cases, beside those of the operators: an empty table passes through all
stages; the near-dedup stage leaves one row of each group of like texts, whatever
rows share an id or have none, and drops nothing else; further columns of any
name pass through.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicscope.llm import decontaminate, langid, near_dedup, packing, quality_rules
from topicscope.llm.common import final, staged, table

#: A text whose best cosine is below this has hardly a letter group of any known language.
MIN_LANGUAGE_SCORE = 0.1


def _wrapped(docs: DataFrame) -> DataFrame:
    """The whole row in one struct beside its text, so that no name clashes."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "text")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without letters (`und`) or of no learned language."""
    protos = langid.prototypes(docs)
    rows = langid.predict(_wrapped(docs), protos, keep=["_row"])
    return rows.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE)) \
        .select("_row.*")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects what breaks a rule of the current policy."""
    return quality_rules.ledger(_wrapped(docs)).where(~quality_rules.fails(quality_rules.CURRENT)) \
        .select("_row.*")


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group stays, that of smallest id."""
    fate = final(lambda: near_dedup.fates(docs.select("doc_id", "text")), "fates")
    return near_dedup.one_of_each(docs, fate)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents with benchmark passages by the contamination rule."""
    rows = decontaminate.scan(_wrapped(docs), table(spark, sf_dir, "benchmark"), keep=["_row"])
    return rows.where(~decontaminate.contaminated()).select("_row.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token windows of the documents that are left, one row per piece."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language_id", language), ("quality_rules", quality), ("near_dedup", dedup),
          ("decontamination", decontaminated), ("packing", packed)]

#: Tokenisation and retrieval have no SQL; the tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
