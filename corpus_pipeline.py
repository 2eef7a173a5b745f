"""Documents to training tokens: each stage works on what the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.llm.bpe import round_trip
from claimloom.llm.decontaminate import clean_documents
from claimloom.llm.near_dedup import one_of_each
from claimloom.llm.quality_gam import ACCEPT, fit_quality, id_remainder, quality_score
from claimloom.llm.secrets import redact
from claimloom.llm.text import table
from claimloom.session import stage


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is 0.3 or more; rows without text are scored as empty texts."""
    labels = table(spark, sf_dir, "labels").where(id_remainder(F.col("doc_id"), 5) != 0)
    return docs.where(quality_score(fit_quality(docs, labels), F.col("text")) >= ACCEPT)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 on five-word shingles."""
    return one_of_each(docs, percent=80)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that have no benchmark item to 80 %."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark; n_chars is that of the new text."""
    clean = redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents, with digests of the ids and of the text that they decode to."""
    return round_trip(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", distinct_documents),
    ("decontamination", without_benchmark),
    ("secrets", without_secrets),
    ("tokens", tokens),
]

#: Fitted scores and token ids are beyond SQL; tests/llm holds the stages against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
