"""Queries over the tables of a folder, one for each operator, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm import chat, line_dedup, mixing, packing, quality, simhash, stream_dedup, url_filter, warc, wrappers

#: Domains of the synthetic pages that no corpus of general text should hold.
DOMAINS = tuple(f"{name}.example.{tld}" for name in ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm") for tld in ("com", "net", "org"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_filter(table(spark, sf_dir, "documents"))


def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract(table(spark, sf_dir, "pages"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), copy_column="copy_no")


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op3_warc_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.pages_through_warc(table(spark, sf_dir, "pages"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter.filter_urls(pages, url_filter.with_traps(pages, DOMAINS))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_dedup.dedup(spark, f"{sf_dir}/documents.parquet")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(table(spark, sf_dir, "documents"))


def op9_simhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document that goes, the one of its class that stays, and how many links to other texts were verified for it."""
    gone = simhash.duplicates(table(spark, sf_dir, "documents"))
    name = lambda c: F.nullif(c, F.lit((1 << 63) - 1))
    return gone.select(name(F.col("id")).alias("doc_id"), name(F.col("keep_id")).alias("duplicate_of"), "links")


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_html_extract, op2_mix_sources, op3_warc_read, op4_url_filter, op5_exact_dedup, op6_line_dedup, op7_chat_format, op8_quality_rules, op9_simhash_near_dup, op10_best_fit_packing)
}
ORACLES: dict[str, str] = {
    "op2_mix_sources": mixing.sql(),
    "op3_warc_read": warc.sql(),
    "op4_url_filter": url_filter.sql(DOMAINS),
    "op5_exact_dedup": stream_dedup.sql(),
    "op7_chat_format": chat.sql(),
    "op8_quality_rules": quality.sql(),
}
