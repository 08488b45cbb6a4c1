"""The corpus pipeline: quality rules, near duplicates, personal data, source mix, tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthline.llm.block_mixing import mixed_documents
from hearthline.llm.common import DOCUMENT_COLUMNS, documents, table
from hearthline.llm.crf_pii import find_personal_data
from hearthline.llm.line_rules import line_rules
from hearthline.llm.queries import WORD_BPE
from hearthline.llm.signature_trees import document_key, near_groups
from hearthline.llm.speculative_bpe import bpe_encode
from hearthline.session import staged


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line rules keep."""
    judged = line_rules(docs, table(spark, sf_dir, "labels"), carry=DOCUMENT_COLUMNS)
    return judged.where("kept").select(DOCUMENT_COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id, a null id last. Rows that repeat
    id and text are one. Documents without a word are no group and all stay."""
    found = near_groups(docs).where("n_shingles > 0")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", -F.col("n_shingles"), "key"))
    heads = found.groupBy("component").agg(first.alias("head")).select(F.col("head.key").alias("_key"))
    kept = docs.withColumn("_key", document_key()).join(heads, "_key", "left_semi").dropDuplicates(["_key"]).drop("_key")
    wordless = docs.where(~F.coalesce("text", F.lit("")).rlike(r"[^\x20\x09-\x0D]"))
    return kept.where(F.col("text").rlike(r"[^\x20\x09-\x0D]")).unionByName(wordless).select(DOCUMENT_COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by the name of its kind."""
    found = find_personal_data(docs, carry=["doc_id", "lang", "source"], with_text=True)
    text = F.col("redacted_text")
    return found.select("doc_id", text.alias("text"), "lang", "source", F.length(text).cast("long").alias("n_chars"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes, a row per document and epoch."""
    return mixed_documents(docs).select(DOCUMENT_COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    return bpe_encode(docs, WORD_BPE)


STAGES = [("quality", quality), ("near_copies", near_copies), ("personal_data", personal_data), ("mix", mix), ("encode", encode)]

#: Trained models decide in three stages, so no SQL gives these rows; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written as Parquet and read again."""
    docs = documents(spark, sf_dir).select(DOCUMENT_COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
