"""Registration of queries with their SQL twins, and the tables they read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def keep(f: Query) -> Query:
            self.queries[name] = f
            if sql is not None:
                self.sql[name] = sql
            return f

        return keep


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d.rstrip('/')}/{name}.parquet")


def once(df: DataFrame, id_col: str) -> DataFrame:
    """One row per id: the first delivery (later ones repeat its values)."""
    cols = [c for c in df.columns if c not in (id_col, "ingested_at")]
    return df.groupBy(id_col).agg(F.min_by(F.struct(*cols), "ingested_at").alias("_r")).select(id_col, "_r.*")


def citations(spark: SparkSession, d: str, texts: bool = False) -> DataFrame:
    """Working citations: ``group, ord, title, author, canonical_author, cite_count``, with ``texts`` also ``contexts, commentaries``.

    Only the columns wanted are read and shuffled.
    """
    more = ("contexts", "commentaries") if texts else ()
    df = table(spark, d, "citations").select("cit_id", "source_book_id", "title", "author", "canonical_author", "cite_count", *more, "ingested_at")
    return once(df, "cit_id").select(
        F.col("source_book_id").alias("group"), F.col("cit_id").alias("ord"), F.coalesce("title", F.lit("")).alias("title"), "author", "canonical_author",
        F.col("cite_count").cast("bigint").alias("cite_count"), *more,
    )


def raw_rows(spark: SparkSession, d: str) -> DataFrame:
    df = table(spark, d, "book_citations").select("raw_id", "source_book_id", "chunk_index", "title", "author", "citation_excerpt", "commentary", "ingested_at")
    return once(df, "raw_id")


def books(spark: SparkSession, d: str, *cols: str) -> DataFrame:
    """Catalogue records with ``author`` and ``author_id`` of the first author."""
    want = cols or ("work_id", "title", "authors", "publication_year", "ratings_count", "description", "link")
    df = once(table(spark, d, "book_metadata").select("book_id", *want, "ingested_at"), "book_id")
    if "authors" not in want:
        return df
    first = F.try_element_at("authors", F.lit(1))
    return df.withColumns({"author": first["name"], "author_id": first["author_id"]})


# The same tables for the SQL twins.
CITATIONS = """
cites AS (
  SELECT source_book_id AS grp, cit_id AS ord, coalesce(title, '') AS title, author, canonical_author, cite_count::BIGINT AS cite_count, contexts, commentaries
  FROM citations QUALIFY row_number() OVER (PARTITION BY cit_id ORDER BY ingested_at) = 1
)"""
RAW = """
raw AS (SELECT * FROM book_citations QUALIFY row_number() OVER (PARTITION BY raw_id ORDER BY ingested_at) = 1)"""
BOOKS = """
books AS (
  SELECT *, authors[1].name AS author, authors[1].author_id AS author_id FROM book_metadata
  QUALIFY row_number() OVER (PARTITION BY book_id ORDER BY ingested_at) = 1
)"""
