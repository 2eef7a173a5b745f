"""Quality rules with the frequency of lines across the documents of a host, in SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.llm.text import SPACES
from claimloom.session import stage

SYMBOLS = "#*$%&|<>"
ASCII_SPACES = " \t\n\x0b\x0c\r"

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: A line in more documents of its host than this is boilerplate.
MAX_DOCS_PER_HOST = 30
#: A document that loses more than this share of its words to removed lines is rejected.
MAX_REMOVED_PERCENT = 50


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACES), "")


def line_key(line: Column) -> Column:
    """Hash of a line in lower case with single spaces."""
    return F.xxhash64(F.lower(F.array_join(words_of(line), " ")))


def _has_word(line: Column) -> Column:
    return F.btrim(line, F.lit(ASCII_SPACES)) != ""


def measure(docs: DataFrame, host: str = "source") -> DataFrame:
    """Counts of every row's whole text and the keys of its lines; texts themselves are left out."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"),
        F.xxhash64("text").alias("text_key"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        words_of(text).alias("words"),
        F.filter(F.split(text, "\n"), _has_word).alias("lines"),
    )
    n = F.size("words")
    at = lambda i: F.get("words", i)
    windows = F.when(
        n >= 3, F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.struct(F.xxhash64(at(i), at(i + 1), at(i + 2)).alias("h"), i.alias("p")))
    ).otherwise(F.array().cast("array<struct<h:bigint,p:int>>"))
    rows = rows.select(
        "doc_id",
        "host",
        "text_key",
        n.cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.transform("lines", lambda x: F.struct(line_key(x).alias("h"), F.size(words_of(x)).alias("n"))).alias("lines"),
        F.sort_array(windows).alias("windows"),
    )
    near = lambda j: F.get("windows", j)["h"]
    twice = F.transform("windows", lambda x, j: F.when((near(j - 1) == x["h"]) | (near(j + 1) == x["h"]), x["p"]))
    rows = rows.withColumn("starts", F.array_compact(twice))
    covered = F.array_distinct(F.flatten(F.transform("starts", lambda p: F.array(p, p + 1, p + 2))))
    return rows.select(*rows.columns[:7], "lines", F.size(covered).cast("bigint").alias("n_repeat_words"))


def frequent_lines(rows: DataFrame, max_docs: int = MAX_DOCS_PER_HOST) -> DataFrame:
    """(host, line) of the lines that more than ``max_docs`` distinct documents of the host have."""
    lines = rows.select("host", "doc_id", F.explode(F.array_distinct(F.transform("lines", lambda x: x["h"]))).alias("line"))
    docs = lines.distinct()  # a hot line is spread over its documents here
    return docs.groupBy("host", "line").agg(F.count("doc_id").alias("docs")).where(F.col("docs") > max_docs).drop("docs")


def line_rules(
    docs: DataFrame, host: str = "source", max_docs: int = MAX_DOCS_PER_HOST, max_removed_percent: int = MAX_REMOVED_PERCENT
) -> DataFrame:
    """Text statistics and verdict of every row.

    Columns: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, removed_words, host, text_key, removed (keys of the lines
    to take out, for ``remove_lines``).

    base_failed: under 50 words, or more than half of the words repeated in
    3-word windows. A row fails as depleted if the lines that more than
    ``max_docs`` documents of its host share hold over ``max_removed_percent``
    of its words. Null text counts as empty (no words: base_failed); a null host
    is a host of its own; a row without doc_id is judged but counts as no
    document; rows that repeat a doc_id count once for a line. An empty table
    gives no rows. Other columns are ignored.
    """
    rows = stage(measure(docs, host), "line_rules")
    hot = frequent_lines(rows, max_docs)
    id_text = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id_text")
    lines = rows.select("host", id_text, "text_key", F.explode("lines.h").alias("line"))
    removed = lines.join(hot, ["host", "line"]).groupBy("host", "id_text", "text_key").agg(F.collect_set("line").alias("removed"))
    judged = rows.withColumn("id_text", id_text).join(removed, ["host", "id_text", "text_key"], "left")
    judged = judged.withColumn("removed", F.coalesce("removed", F.array().cast("array<bigint>")))
    lost = F.aggregate(
        "lines", F.lit(0).cast("bigint"), lambda s, x: s + F.when(F.array_contains("removed", x["h"]), x["n"]).otherwise(0)
    )
    judged = judged.withColumn("removed_words", lost).withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
    )
    kept = ~F.col("base_failed") & (100 * F.col("removed_words") <= max_removed_percent * F.col("n_words"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"),
        "removed_words", "host", "text_key", "removed",
    )


def remove_lines(docs: DataFrame, verdicts: DataFrame, host: str = "source") -> DataFrame:
    """The kept rows of ``docs``, with all their columns and without the removed lines in ``text``.

    Lines without a word stay; a text that loses nothing is unchanged; repeated rows stay repeated.
    """
    kept = verdicts.where("kept").select(
        F.col("host").alias("_host"), F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), F.col("removed").alias("_removed")
    )
    kept = kept.groupBy("_host", "_id", "_key").agg(F.any_value("_removed").alias("_removed"))
    mine = F.coalesce(docs[host].cast("string"), F.lit(""))
    joined = docs.join(kept, (mine == kept["_host"]) & docs["doc_id"].eqNullSafe(kept["_id"]) & (F.xxhash64(docs["text"]) == kept["_key"]))
    stays = lambda x: ~F.array_contains("_removed", line_key(x))
    text = F.when(F.size("_removed") == 0, docs["text"]).otherwise(F.array_join(F.filter(F.split(docs["text"], "\n"), stays), "\n"))
    return joined.select(*[text.alias("text") if c == "text" else docs[c] for c in docs.columns])
