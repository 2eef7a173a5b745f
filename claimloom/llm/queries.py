"""One query per operator, over its whole table, and the same result as SQL where SQL can say it (``oracles``)."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.llm.bpe import round_trip
from claimloom.llm.chat import chat_windows, window_digests
from claimloom.llm.curriculum import curriculum, word_count
from claimloom.llm.decontaminate import contained_items
from claimloom.llm.fim import fim_documents, restore
from claimloom.llm.hard_negatives import hard_negatives
from claimloom.llm.html_text import extract
from claimloom.llm.line_rules import line_rules
from claimloom.llm.near_dedup import near_duplicates
from claimloom.llm.quality_gam import id_remainder, score_quality
from claimloom.llm.secrets import find_secrets
from claimloom.llm.sharding import histogram_shards
from claimloom.llm.text import table
from claimloom.llm.toxicity import score_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op9_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate components of all documents at a similarity of 0.85."""
    return near_duplicates(table(spark, folder, "documents"), percent=85)


@query
def op8_line_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Text statistics and the verdict of the line rules for all documents."""
    return line_rules(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "removed_words"
    )


@query
def op5_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 40 shards of near-equal bytes."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return histogram_shards(docs).select(
        "doc_id",
        "size",
        F.crc32(F.encode(F.coalesce("text", F.lit("")), "utf-8")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op10_html_text(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of all pages."""
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


@query
def op2_chat_windows(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations, and one made of control strings, as windows; what they say is read back."""
    given = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], given.schema)
    return window_digests(chat_windows(given.unionByName(extra)))


@query
def op7_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets in all documents."""
    found = find_secrets(table(spark, folder, "documents").select("doc_id", "text"))
    written = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    of = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    base = F.filter("secrets", lambda s: s["kind"] != "random")
    return found.select(
        "doc_id", of("assign"), of("access"), of("hex"), F.sha2(written(base), 256).alias("base_sha256"), written(F.col("secrets")).alias("spans")
    )


@query
def op6_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """All documents encoded with a public vocabulary, and decoded again."""
    return round_trip(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), keep_ids=False)


@query
def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality scores of all documents; a fifth of the ids never teaches."""
    held_out = id_remainder(F.col("doc_id"), 5) == 0
    scored = score_quality(table(spark, folder, "documents"), table(spark, folder, "labels"), held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query
def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity scores of all documents; a quarter of the ids never teaches."""
    held_out = id_remainder(F.col("doc_id"), 4) == 2
    scored = score_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"), held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query
def op3_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark items that documents have to 80 % or more."""
    return contained_items(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op11_curriculum(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in the order of a curriculum over their sources; position in billionths of the run."""
    docs = table(spark, folder, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size"))
    first = F.get("reads", F.lit(0))["position"]
    return curriculum(docs).select(
        "doc_id", "size", "source_size", "target", "taken", F.floor(first * 1e9).cast("bigint").alias("position"), F.size("reads").alias("n_reads")
    )


@query
def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every hundredth vector, after a known change of every seventh label."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, label)


@query
def op13_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    """All documents as fill-in-middle texts, and rebuilt from these."""
    done = restore(fim_documents(table(spark, folder, "documents").select("doc_id", "text")))
    digest = lambda c: F.sha2(F.encode(c, "utf-8"), 256).alias(f"{c}_sha256")
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest("output"), digest("restored"))
