"""Writers: stage tables, JSON lines, key-value maps, search index, dataset registry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import slug
from ..operators.enrich import upsert
from ..operators.search import postings


def stage_table(df: DataFrame, path: str, partition: str | None = None, fmt: str = "parquet", append: bool = False) -> None:
    """A stage's result; only the partitions written are replaced, with ``append`` none."""
    w = df.write.mode("append" if append else "overwrite").option("partitionOverwriteMode", "dynamic").format(fmt)
    (w.partitionBy(partition) if partition else w).save(path)


def key_values(df: DataFrame, path: str) -> None:
    """``(key, value)`` as sorted JSON lines."""
    df.orderBy("key").write.mode("overwrite").json(path)


def search_index(books: DataFrame, path: str, id_col: str = "book_id", fields: tuple[str, ...] = ("title",), parts: int = 200) -> None:
    """Postings clustered by token, beside a table of one row per id (of repeated ones the smallest)."""
    books = books.groupBy(id_col).agg(F.min(F.struct(*[c for c in books.columns if c != id_col])).alias("r")).select(id_col, "r.*")
    postings(books, id_col, list(fields)).repartition(parts, "token").sortWithinPartitions("token", "doc", "pos").write.mode("overwrite").parquet(f"{path}/postings")
    books.write.mode("overwrite").parquet(f"{path}/rows")


def register(spark: SparkSession, registry: DataFrame, name: str, path: str, covers: list[str]) -> DataFrame:
    """The registry with the dataset added or replaced by path."""
    row = spark.createDataFrame([(name, path, covers)], "name string, path string, covers array<string>")
    return upsert(registry, row, "path").withColumn("slug", slug(F.col("name")))


def metadata_lines(books: DataFrame, path: str) -> None:
    """Text dump of ``(year, title, authors, book_id)`` by year, unknown years last."""
    line = F.concat_ws(" | ", F.coalesce(F.col("year").cast("string"), F.lit("?")), "title", "authors", F.col("book_id").cast("string"))
    books.orderBy(F.coalesce("year", F.lit(9999)), "book_id").select(line.alias("value")).write.mode("overwrite").text(path)


def finished(spark: SparkSession, path: str) -> DataFrame | None:
    """``(book_id)`` of the books whose results stand at ``path``; None where nothing does."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return None
    return spark.read.parquet(path).select(F.col("group").alias("book_id")).distinct()
