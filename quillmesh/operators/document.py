"""Rows of the resolved graph: nested matches and edges, their enrichment and repair.

A row is one citation with the structs ``raw``, ``goodreads_match``,
``wikipedia_match`` and ``edge``; a book's document is the rows of its ``group``,
which are never gathered in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import checked_dates
from .search import record_hits


def _gap(c: Column) -> Column:
    """A year that is there: neither null nor 0."""
    return F.nullif(c, F.lit(0))


def build_edges(cites: DataFrame, found: DataFrame, books: DataFrame, authors: DataFrame, people: DataFrame, lives: DataFrame) -> DataFrame:
    """``(group, ord, raw, goodreads_match, wikipedia_match, edge)`` of resolved citations.

    ``found``: ``(ord, match_type, book_id string, author_id, page_id)``; ``books``: ``(book_id
    string, work_id, title, authors array<struct<author_id, name>>, publication_year,
    original_year)``; ``authors``: ``(author_id, name)``; ``people``: ``(page_id, title,
    birth_year, death_year)``; ``lives``: ``(name, birth_year, death_year, nationality,
    main_genre)``.  A book match stands in ``goodreads_match``; life dates of the target
    fill only what the person's page lacks.
    """
    b = books.select(F.col("book_id").alias("_b"), F.struct("work_id", "title", "authors", "publication_year", "original_year").alias("_book")).dropDuplicates(["_b"])
    a = authors.where("name IS NOT NULL").groupBy(F.col("author_id").alias("_a")).agg(F.min("name").alias("_name"))
    p = people.select(F.col("page_id").alias("_p"), F.struct(F.col("title"), F.col("page_id"), F.col("birth_year").cast("int").alias("birth_year"), F.col("death_year").cast("int").alias("death_year")).alias("_page")).dropDuplicates(["_p"])
    rows = cites.join(found, "ord", "left").join(b, F.col("book_id") == F.col("_b"), "left").join(a, F.col("author_id") == F.col("_a"), "left").join(p, F.col("page_id") == F.col("_p"), "left")
    kind = F.coalesce("match_type", F.lit("not_found"))
    rows = rows.withColumn("_target", F.coalesce(F.try_element_at("_book.authors", F.lit(1))["name"], "_name", "author"))
    told = [F.col("birth_year").cast("int").alias("birth_year"), F.col("death_year").cast("int").alias("death_year"), F.col("nationality"), F.col("main_genre")]
    # Of namesakes the least, what is unknown coming last.
    order = F.struct(*[x for c in told for x in (c.isNull(), c)])
    life = lives.where("name IS NOT NULL").groupBy(F.col("name").alias("_l")).agg(F.min_by(F.struct(*told), order).alias("_life"))
    rows = rows.join(life, F.col("_target") == F.col("_l"), "left")
    no_page, no_life = F.col("_page").isNull(), F.col("_life").isNull()
    person = F.when(~(no_page & no_life), F.struct(
        F.when(no_page, F.col("_target")).otherwise(F.col("_page.title")).alias("title"), F.col("_page.page_id").alias("page_id"),
        F.coalesce(_gap(F.col("_page.birth_year")), F.col("_life.birth_year")).alias("birth_year"), F.coalesce(_gap(F.col("_page.death_year")), F.col("_life.death_year")).alias("death_year"),
    ))
    names, ids = F.transform("_book.authors", lambda x: x["name"]), F.transform("_book.authors", lambda x: x["author_id"].cast("string"))
    match = F.when(kind == "book", F.struct(
        F.col("book_id").alias("book_id"), "_book.work_id", "_book.title", names.alias("authors"), ids.alias("author_ids"), "_book.publication_year", "_book.original_year", F.col("_life").alias("author_meta"),
    ))
    none = F.array().cast("array<string>")
    target_ids = F.when(kind == "book", F.coalesce(ids, none)).when(F.col("author_id").isNotNull(), F.array(F.col("author_id").cast("string"))).otherwise(none)
    edge = F.struct(kind.alias("target_type"), F.when(kind == "book", F.col("book_id")).alias("target_book_id"), target_ids.alias("target_author_ids"), person.alias("target_person"))
    raw = F.struct("title", "author", F.col("cite_count").alias("count"), "contexts", "commentaries", "canonical_author")
    return rows.select("group", "ord", raw.alias("raw"), match.alias("goodreads_match"), person.alias("wikipedia_match"), edge.alias("edge"))


#: Where a row holds life dates.
DATE_PATHS = ("goodreads_match.author_meta", "wikipedia_match", "edge.target_person")


def _repaired(dates: Column) -> Column:
    ok = checked_dates(dates["birth_year"], dates["death_year"])
    return F.when(dates.isNotNull(), dates.withField("birth_year", ok["birth_year"]).withField("death_year", ok["death_year"]))


def repair_dates(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(rows, fixes)``: life dates checked at every place of a row; ``fixes``: ``(group, ord, path, label)``."""
    labels = F.array(*[F.struct(F.lit(p).alias("path"), checked_dates(F.col(f"{p}.birth_year"), F.col(f"{p}.death_year"))["label"].alias("label")) for p in DATE_PATHS])
    fixes = rows.select("group", "ord", F.explode(labels).alias("f")).select("group", "ord", "f.path", "f.label").where("label IS NOT NULL")
    g, e = F.col("goodreads_match"), F.col("edge")
    fixed = rows.withColumns({
        "goodreads_match": F.when(g.isNotNull(), g.withField("author_meta", _repaired(g["author_meta"]))),
        "wikipedia_match": _repaired(F.col("wikipedia_match")), "edge": e.withField("target_person", _repaired(e["target_person"])),
    })
    return fixed, fixes


def enrich_sources(sources: DataFrame, books: DataFrame, lives: DataFrame, limit: int = 3) -> DataFrame:
    """Citing books with authors, year and more from the catalogue, and their first author's life.

    ``sources``: ``(book_id string, title, authors array<string>, publication_year)``;
    ``books``: ``(book_id string, title, authors array<string>, publication_year,
    description)``.  Of the first ``limit`` records under the title the one with the very
    id counts, else the first.  What a source has is kept.
    """
    open_ = F.coalesce(F.size("authors"), F.lit(0)).isin(0, -1) | F.col("publication_year").isNull()
    asked = sources.where(open_ & F.col("title").isNotNull()).select(F.col("book_id").alias("q"), F.col("title").alias("q_title"), F.lit(None).cast("string").alias("q_author"))
    hits = record_hits(asked, books.select(F.col("book_id").alias("doc"), F.col("title").alias("d_title"), F.col("authors").alias("d_authors")), limit)
    best = hits.groupBy("q").agg(F.min_by("doc", F.struct((F.col("doc") != F.col("q")).cast("int"), "rank")).alias("_doc"))
    known = books.select(F.col("book_id").alias("_doc"), F.col("authors").alias("_authors"), F.col("publication_year").alias("_year"), "description")
    out = sources.join(best.join(known, "_doc").withColumnRenamed("q", "_q"), F.col("book_id") == F.col("_q"), "left")
    has = F.coalesce(F.size("authors"), F.lit(0)) > 0
    out = out.select(*[c for c in sources.columns if c not in ("authors", "publication_year")], F.when(has, F.col("authors")).otherwise(F.col("_authors")).alias("authors"),
                     F.coalesce("publication_year", "_year").alias("publication_year"), "description", F.col("_doc").alias("catalogue_id"))
    life = lives.where("name IS NOT NULL").groupBy(F.col("name").alias("_l")).agg(F.min(F.struct("birth_year", "death_year")).alias("author_metadata"))
    return out.join(life, F.try_element_at("authors", F.lit(1)) == F.col("_l"), "left").drop("_l")


def find_sources(texts: DataFrame, books: DataFrame) -> DataFrame:
    """Texts without a number in their name get id and title of the first record under their title.

    ``texts``: ``(book_id, title, text, numbered)``; ``books``: ``(book_id string, title, authors)``.
    """
    asked = texts.where("NOT numbered").select(F.col("book_id").alias("q"), F.col("title").alias("q_title"), F.lit(None).cast("string").alias("q_author"))
    hit = record_hits(asked, books.select(F.col("book_id").alias("doc"), F.col("title").alias("d_title"), F.col("authors").alias("d_authors")), 1)
    named = hit.join(books.select(F.col("book_id").alias("doc"), F.col("title").alias("_t")).dropDuplicates(["doc"]), "doc").select(F.col("q").alias("_q"), "doc", "_t")
    return texts.join(named, F.col("book_id") == F.col("_q"), "left").select(F.coalesce("doc", "book_id").alias("book_id"), F.coalesce("_t", "title").alias("title"), "text")


def fall_back(rows: DataFrame, answers: DataFrame) -> DataFrame:
    """Unresolved rows ``(ord, match_type, book_id, ...)`` take the answers of a provider.

    ``answers``: ``(ord, match_type, title, original_year)``, books and persons only; a book
    without an id gets one made from its title and year.
    """
    a = answers.where("match_type IN ('book', 'person')").groupBy(F.col("ord").alias("_o")).agg(F.min(F.struct("match_type", "title", "original_year")).alias("_a"))
    made = F.concat(F.lit("web_"), F.substring(F.md5(F.concat(F.coalesce("_a.title", F.lit("")), F.coalesce(F.col("_a.original_year").cast("string"), F.lit("")))), 1, 8))
    out = rows.join(a, F.col("ord") == F.col("_o"), "left")
    take = F.col("_o").isNotNull() & F.coalesce(F.col("match_type").isin("not_found", "unknown", "error"), F.lit(True))
    return out.withColumns({
        "book_id": F.when(take & (F.col("_a.match_type") == "book"), made).otherwise(F.col("book_id")), "match_type": F.when(take, F.col("_a.match_type")).otherwise(F.col("match_type")),
    }).select(*rows.columns)
