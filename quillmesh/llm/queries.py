"""Registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .canonical import map_to_list
from .common import cut, table
from .leakage import find_leaks, remove_leaks
from .matching import matched_records
from .mixture import mix, with_token_counts
from .neardup import group_records, near_duplicates, record_pairs
from .residue import detect_residue
from .survivor import build_survivors, choose_survivors
from .variants import variant_pairs


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return variant_pairs(table(spark, d, "citations"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return record_pairs(*near_duplicates(table(spark, d, "book_citations")))


def p2_groups(spark: SparkSession, d: str) -> DataFrame:
    return group_records(*near_duplicates(table(spark, d, "book_citations")))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    found = matched_records(table(spark, d, "book_citations"), table(spark, d, "book_metadata"))
    return found.select("raw_id", "book_id")


def p3_confidence(spark: SparkSession, d: str) -> DataFrame:
    return matched_records(table(spark, d, "book_citations"), table(spark, d, "book_metadata"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    chosen = choose_survivors(table(spark, d, "book_metadata"))
    return chosen.where("clear_lead").select("work_id", F.col("base_id").alias("book_id"))


def p4_survivors(spark: SparkSession, d: str) -> DataFrame:
    return build_survivors(table(spark, d, "book_metadata"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return map_to_list(table(spark, d, "citations"), table(spark, d, "canonical_authors"))[0]


def p5_unmatched(spark: SparkSession, d: str) -> DataFrame:
    return map_to_list(table(spark, d, "citations"), table(spark, d, "canonical_authors"))[1]


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return find_leaks(table(spark, d, "documents"), table(spark, d, "eval_items")).select("doc_id", "item_id")


def p6_removed(spark: SparkSession, d: str) -> DataFrame:
    out = remove_leaks(table(spark, d, "documents").select("doc_id", "text"), table(spark, d, "eval_items"))
    return out.select("doc_id", F.length("text").alias("n_chars"), "removed")


def _mixture(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    docs = with_token_counts(table(spark, d, "documents").select("doc_id", "source", "text"))
    # Tokenised once: the counts, not the texts, go on.
    counts = cut(docs.select("doc_id", "source", "n_tokens"))
    return mix(counts, table(spark, d, "mix_targets"))


def p7_mixture(spark: SparkSession, d: str) -> DataFrame:
    return _mixture(spark, d)[0]


def p7_shares(spark: SparkSession, d: str) -> DataFrame:
    return _mixture(spark, d)[1]


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return detect_residue(table(spark, d, "documents")).select("doc_id").distinct()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p2_found, p2_groups, p3_found, p3_confidence, p4_found, p4_survivors, p5_found, p5_unmatched, p6_found, p6_removed, p7_mixture, p7_shares, p8_found)}
