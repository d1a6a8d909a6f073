"""Registered queries of this package: name -> (Spark callable, DuckDB SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry.llm import bpe as B11
from telemetry.llm import chunk_dedup as C7
from telemetry.llm import decontaminate as D1
from telemetry.llm import jaccard as J2
from telemetry.llm import kdshards as K10
from telemetry.llm import line_rules as L9
from telemetry.llm import mixing as M5
from telemetry.llm import oracle as O
from telemetry.llm import page_text as H8
from telemetry.llm import periodic as P13
from telemetry.llm import quality_pu as Q4
from telemetry.llm import site_lines as S6
from telemetry.llm import spelling as V12
from telemetry.llm import token_scan as T3
from telemetry.llm.frames import table

QueryFn = Callable[[SparkSession, str], DataFrame]


def op1_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    """Benchmark words of every document."""
    return D1.match_table(table(spark, sf, "documents", "doc_id", "text"),
                          table(spark, sf, "benchmark", "item_id", "text")) \
        .drop("longest_match", "longest_at")


def op2_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    """Size, component and number of links of the 5-word shingle set of every document, linked at similarity 0.75."""
    return J2.similarity_classes(table(spark, sf, "documents", "doc_id", "text"))


def op4_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Quality score of every document."""
    return Q4.score_table(table(spark, sf, "documents", "doc_id", "text"),
                          table(spark, sf, "labels", "doc_id", "quality"))


def op5_mixing(spark: SparkSession, sf: str) -> DataFrame:
    """Copies of documents for a mix whose sources have shares proportional to size ** 0.7."""
    docs = table(spark, sf, "documents", "doc_id", "source", "text")
    return M5.replicate(docs, with_details=True).withColumn("rate", F.round("rate", 6))


def op10_sharding(spark: SparkSession, sf: str) -> DataFrame:
    """Shard and slot of every document in 40 shards of nearly equal bytes."""
    return K10.shard_table(table(spark, sf, "documents", "doc_id", "text", "source", "lang"))


def op6_site_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Text of every page without the lines that stand on over a tenth of the pages of its host."""
    pages = table(spark, sf, "pages", "page_id", "url", "html")
    return S6.drop_site_lines(pages, S6.html_lines(F.col("html"))).drop("html")


def op9_line_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Base counts and verdict of line-first cleaning of every document."""
    return L9.rule_table(table(spark, sf, "documents", "doc_id", "text"))


def op3_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens of every document, counted between the separators of flat token files."""
    return T3.token_counts(table(spark, sf, "documents", "doc_id", "text")).select("doc_id", "n_tokens")


def op7_chunk_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Every document without passages that an earlier place holds."""
    return C7.dedup_substrings(table(spark, sf, "documents", "doc_id", "text")).drop("spans")


def op8_page_text(spark: SparkSession, sf: str) -> DataFrame:
    """Main text of every page."""
    return H8.text_table(table(spark, sf, "pages", "page_id", "url", "html"))


def op11_bpe(spark: SparkSession, sf: str) -> DataFrame:
    """Number and digest of the token ids of every document, and digest of the text decoded from them."""
    tokens = B11.encode(table(spark, sf, "documents", "doc_id", "text")).drop("text")
    return B11.decode(tokens).select(
        "doc_id", F.expr("octet_length(tokens) div 4").cast("long").alias("n_tokens"),
        F.sha2("tokens", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_spelling(spark: SparkSession, sf: str) -> DataFrame:
    """Near words, form and root of every frequent word of documents into which typos are planted."""
    return V12.variants(V12.vocabulary(table(spark, sf, "documents", "doc_id", "text"), typo_every=97))


def op13_periodic(spark: SparkSession, sf: str) -> DataFrame:
    """Periodic runs of every document, the strongest one, and the text without repeats."""
    docs = P13.with_planted_runs(table(spark, sf, "documents", "doc_id", "text"))
    found = P13.find_runs(docs).withColumn("best", P13.strongest())
    line = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(line, F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES: dict[str, QueryFn] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_token_counts": op3_token_counts,
    "op4_quality": op4_quality,
    "op5_mixing": op5_mixing,
    "op6_site_lines": op6_site_lines,
    "op7_chunk_dedup": op7_chunk_dedup,
    "op8_page_text": op8_page_text,
    "op9_line_rules": op9_line_rules,
    "op10_sharding": op10_sharding,
    "op11_bpe": op11_bpe,
    "op12_spelling": op12_spelling,
    "op13_periodic": op13_periodic,
}

SQL: dict[str, str] = {
    "op1_decontaminate": O.DECONTAMINATE,
    "op2_jaccard_join": O.JACCARD,
    "op5_mixing": O.MIXING,
    "op6_site_lines": O.SITE_LINES,
    "op9_line_rules": O.LINE_RULES,
    "op12_spelling": O.SPELLING,
    "op13_periodic": O.PERIODIC,
}
