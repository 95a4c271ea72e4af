"""The whole pipeline as one chain of DataFrames, and its command line."""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import PipelineConfig
from .functions.text import id_list
from .operators import chunking as C
from .operators import dedup as D
from .operators import document as N
from .operators import enrich as E
from .operators import graph as G
from .operators import preprocess as P
from .operators import resolve as S
from .operators.search import find_people
from .operators.tables import kept as stage
from .sources import readers, writers

Progress = Callable[[str, DataFrame], None]
NO_PEOPLE = "page_id bigint, title string, birth_year int, death_year int"


def mention_id() -> Column:
    """Number of a mention within its text: its chunk, then its place there."""
    return F.shiftleft(F.col("chunk_index").cast("bigint"), 32) + F.col("mention")


def one_record(catalog: DataFrame) -> DataFrame:
    """The catalogue with one row per id; ``authors`` as an array of names.

    ``catalog``: ``(book_id, work_id, title, author)`` or with ``authors array<string>``; of
    repeated deliveries the smallest row counts.
    """
    names = F.col("authors") if "authors" in catalog.columns else F.when(F.col("author").isNotNull(), F.array("author")).otherwise(F.array().cast("array<string>"))
    year = F.col("publication_year").cast("int") if "publication_year" in catalog.columns else F.lit(None).cast("int")
    row = F.struct("work_id", "title", names.alias("authors"), year.alias("publication_year"))
    return catalog.where("book_id IS NOT NULL").groupBy(F.col("book_id").cast("string").alias("book_id")).agg(F.min(row).alias("r")).select("book_id", "r.*")


class Engine:
    """Texts in, stage tables out.

    ``run`` returns the stages by name; each is checkpointed, so that later stages
    and retries start from it, and :meth:`write` stores them.  Providers (extractor,
    decider, rewriter, adjudicator) are plain callables; the defaults are
    deterministic.  ``progress`` is called with the name and table of each stage.
    """

    def __init__(
        self, spark: SparkSession, config: PipelineConfig = PipelineConfig(), extractor: C.Extractor = C.regex_extractor, decider: E.Decider | None = None,
        rewriter: S.Rewriter = S.basic_queries, adjudicator: S.Adjudicator = S.fuzzy_adjudicator, progress: Progress | None = None,
    ):
        self.spark, self.config, self.extractor, self.decider = spark, config, extractor, decider
        self.rewriter, self.adjudicator, self.progress = rewriter, adjudicator, progress

    def _done(self, name: str, df: DataFrame) -> DataFrame:
        if self.progress is not None:
            self.progress(name, df)
        return df

    def run(
        self, texts: DataFrame, catalog: DataFrame, aliases: DataFrame | None = None, done: DataFrame | None = None, authors: DataFrame | None = None,
        people: DataFrame | None = None, lives: DataFrame | None = None, max_chunks: int = 0,
    ) -> dict[str, DataFrame]:
        """``texts``: ``(book_id, title, author, text)``; ``catalog``: ``(book_id, work_id, title, author)``; ``done``: books to skip.

        ``authors``: ``(author_id, name)``, by default the catalogue's names; ``people``:
        ``(page_id, title, birth_year, death_year)``; ``lives``: known life dates ``(name,
        birth_year, death_year, nationality, main_genre)``.  A text without an author
        takes the catalogue's.  ``max_chunks`` ends a trial run early.
        """
        spark, config = self.spark, self.config
        books = stage(one_record(catalog))
        people = spark.createDataFrame([], NO_PEOPLE) if people is None else people
        lives = spark.createDataFrame([], "name string, birth_year int, death_year int, nationality string, main_genre string") if lives is None else lives
        listed = books.select(F.explode("authors").alias("name")).where("name IS NOT NULL").distinct()
        authors = listed.select(F.substring(F.md5("name"), 1, 12).alias("author_id"), "name") if authors is None else authors.select(F.col("author_id").cast("string").alias("author_id"), "name")
        if done is not None:
            texts = texts.join(done.select("book_id").distinct(), "book_id", "left_anti")
        given = texts.select("book_id", "title", F.when(F.col("author").isNotNull(), F.array("author")).otherwise(F.array().cast("array<string>")).alias("authors"), F.lit(None).cast("int").alias("publication_year"))
        sources = self._done("sources", stage(N.enrich_sources(given, books.withColumn("description", F.lit(None).cast("string")), lives)))
        who = sources.select(F.col("book_id").alias("group"), F.col("title").alias("source_title"), F.coalesce("authors", F.array().cast("array<string>")).alias("source_authors"))
        sents = texts.select(F.col("book_id").alias("doc"), C.sentences(F.col("text")).alias("sentences"))
        chunks = C.chunk_by_budget(sents, config)
        chunks = chunks.where(F.col("chunk_index") < max_chunks) if max_chunks else chunks
        extracted = self._done("extracted", stage(C.extract(C.excerpts(sents, chunks), self.extractor)))
        ok = extracted.where("status = 'ok'")
        raw = ok.select(F.col("doc").alias("source_book_id"), mention_id().alias("raw_id"), "title", "author", "citation_excerpt", "commentary")
        cleaned = stage(P.preprocess(P.flatten(raw), aliases, who))
        if self.decider is not None:
            said = E.validate(cleaned, self.decider, size=config.validation_batch)
            keyed = cleaned.withColumn("cit", F.col("ord"))
            decided = said.select("group", F.col("ord").alias("cit"), "ord", "status", "fixed_author", "fixed_title")
            cleaned = stage(E.apply_decisions(keyed, decided, ["group", "cit"]).drop("cit", "fixed"))
        self._done("citations", cleaned)
        ids = stage(cleaned.withColumn("cit_id", F.concat_ws(":", "group", "ord")))
        found = S.resolve(
            ids.select("cit_id", "title", "author", "canonical_author"), books.select("book_id", "title", "authors"), authors,
            people.select(F.col("page_id").cast("string").alias("page_id"), "title", "birth_year", "death_year"), aliases, None, config, self.rewriter, self.adjudicator,
        )
        hit = found.select("cit_id", "match_type", F.col("book_id").alias("b"), "author_id", "page_id", "score").join(books.select(F.col("book_id").alias("b"), "work_id"), "b", "left")
        made = F.concat(F.lit("web_"), F.substring(F.md5("title"), 1, 8))
        resolved = stage(ids.join(hit, "cit_id", "left").withColumn("book_id", F.coalesce("b", F.when(F.trim("title") != "", made))).drop("b"))
        merged = self._done("resolved", stage(D.dedup_by_author_title(D.dedup_by_work(resolved, scope="group").drop("merged"), scope="group").drop("merged")))
        # Life dates of everybody the edges point to: known ones, then the best people page.
        targets = merged.select(F.col("author").alias("name")).unionByName(listed).distinct()
        pages = find_people(targets.select(F.col("name").alias("q")), people.select(F.col("page_id").cast("string").alias("page_id"), "title", "birth_year", "death_year"), None, 1)
        dated, _ = E.enrich_authors(targets, lives.select("name", "birth_year", "death_year"), pages.select(F.col("q").alias("name"), "birth_year", "death_year"))
        dated = dated.where("origin IS NOT NULL").join(lives.select("name", "nationality", "main_genre").dropDuplicates(["name"]), "name", "left")
        shelf = books.select("book_id", "work_id", "title", F.transform("authors", lambda n: F.struct(F.lit(None).cast("string").alias("author_id"), n.alias("name"))).alias("authors"), "publication_year", F.lit(None).cast("int").alias("original_year"))
        edges = self._done("edges", stage(N.build_edges(
            merged.select("group", "ord", "cit_id", "title", "author", "canonical_author", "cite_count", "contexts", "commentaries").withColumnRenamed("ord", "place").withColumnRenamed("cit_id", "ord"),
            merged.select(F.col("cit_id").alias("ord"), "match_type", "book_id", "author_id", "page_id"), shelf, authors,
            people.select(F.col("page_id").cast("string").alias("page_id"), "title", "birth_year", "death_year"), dated,
        )))
        src = who.select("group", F.try_element_at("source_authors", F.lit(1)).alias("src"))
        links = self._done("links", G.author_links(merged.join(src, "group").select(F.col("group").alias("book"), "src", F.col("author").alias("dst"))))
        return {"sources": sources, "chunks": chunks, "extracted": extracted, "citations": cleaned, "resolved": merged, "edges": edges, "links": links}

    def write(self, stages: dict[str, DataFrame], path: str, append: bool = False) -> None:
        """The stages as tables; ``append`` keeps the books of earlier runs (links are those of this run)."""
        for name, df in stages.items():
            writers.stage_table(df, f"{path}/{name}", append=append and name != "links")


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="quillmesh", description="Citation graph of a folder of texts.")
    ap.add_argument("texts", help="folder of .txt files named Title_of_book_ID.txt, or one file")
    ap.add_argument("out", help="folder for the stage tables")
    ap.add_argument("--catalog", required=True, help="Parquet with book_id, work_id, title, author or authors")
    ap.add_argument("--authors", help="Parquet with author_id, name")
    ap.add_argument("--people", help="Parquet with page_id, title, birth_year, death_year")
    ap.add_argument("--lives", help="Parquet with name, birth_year, death_year, nationality, main_genre")
    ap.add_argument("--aliases", help="JSON object of variant to canonical name")
    ap.add_argument("--ids", help="allow-list of book ids, by commas or blanks")
    ap.add_argument("--pattern", default="*.txt")
    ap.add_argument("--chunk-size", type=int, default=PipelineConfig.chunk_size)
    ap.add_argument("--max-context", type=int, default=PipelineConfig.max_context)
    ap.add_argument("--max-completion", type=int, default=PipelineConfig.max_completion)
    ap.add_argument("--max-chunks", type=int, default=0, help="chunks of a text at most (trial runs)")
    ap.add_argument("--force", action="store_true", help="process books again whose results are there")
    ap.add_argument("--verbose", action="store_true")
    return ap


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    spark = SparkSession.builder.appName("quillmesh").getOrCreate()
    config = PipelineConfig(chunk_size=a.chunk_size, max_context=a.max_context, max_completion=a.max_completion)
    load = lambda path: spark.read.parquet(path) if path else None
    catalog = spark.read.parquet(a.catalog)
    texts = N.find_sources(readers.texts(spark, a.texts, a.pattern), one_record(catalog)).withColumn("author", F.lit(None).cast("string"))
    if a.ids:
        wanted = spark.createDataFrame([(a.ids,)], "ids string").select(F.explode(id_list(F.col("ids"))).alias("book_id"))
        texts = texts.join(wanted, "book_id", "left_semi")
    aliases = readers.key_values(spark, a.aliases).select(F.col("key").alias("variant_lower"), F.col("value").alias("canonical")) if a.aliases else None
    done = None if a.force else writers.finished(spark, f"{a.out}/citations")
    tell = (lambda name, df: print(name, df.count(), flush=True)) if a.verbose else None
    engine = Engine(spark, config, progress=tell)
    engine.write(engine.run(stage(texts), catalog, aliases, done, load(a.authors), load(a.people), load(a.lives), a.max_chunks), a.out, append=done is not None)


if __name__ == "__main__":
    main()
