"""Ground truth, comparison of runs, and the small stages of evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .search import find_people, record_hits, substring_lookup


def ground_truth(items: DataFrame, shelf: DataFrame, authors: DataFrame) -> DataFrame:
    """``(item_id, book_id, author_id, match_type)``: the best book of a titled item, else the first author its name is part of.

    ``items``: ``(item_id, title, author)``; ``shelf`` as for :func:`record_hits`; ``authors``: ``(author_id, name)``.
    """
    titled = items.where("trim(title) <> ''").select(F.col("item_id").alias("q"), F.col("title").alias("q_title"), F.col("author").alias("q_author"))
    book = record_hits(titled, shelf, 1).select(F.col("q").alias("item_id"), F.col("doc").alias("book_id"))
    names = authors.where("name IS NOT NULL").groupBy("name").agg(F.min("author_id").alias("ord"))
    named = substring_lookup(items.select(F.col("author").alias("q")).distinct(), names, 1).join(names, "name").select("q", F.col("ord").alias("_aid"))
    out = items.join(book, "item_id", "left").join(named, F.col("author") == F.col("q"), "left")
    author = F.when(F.col("book_id").isNull(), F.col("_aid"))
    return out.select("item_id", "book_id", author.alias("author_id"), F.when(F.col("book_id").isNotNull(), "book").when(author.isNotNull(), "author").alias("match_type"))


def enrichment_truth(items: DataFrame, people: DataFrame) -> DataFrame:
    """``(item_id, wiki_title, birth_year, death_year, note)``: the best people page of each item's author."""
    q = items.where("author IS NOT NULL").select(F.col("author").alias("q")).distinct()
    best = find_people(q, people, None, 1).select("q", F.col("title").alias("wiki_title"), "birth_year", "death_year")
    note = F.when(F.col("author").isNull(), F.lit("No author name in citation"))
    return items.join(best, F.col("author") == F.col("q"), "left").select("item_id", "wiki_title", "birth_year", "death_year", note.alias("note"))


def metrics(run: DataFrame, expected: DataFrame) -> DataFrame:
    """One row of counts: a run's hits and failures, and its enrichments against the expected people.

    ``run``: ``(item_id, match_type, found, birth_year)``; ``expected``: as :func:`enrichment_truth` makes it.
    """
    e = expected.select("item_id", "wiki_title", F.col("birth_year").alias("eb"))
    j = run.join(e, "item_id")
    want, got = F.col("wiki_title").isNotNull(), F.col("found").isNotNull()
    return j.agg(
        F.count("*").alias("total"), F.count_if(F.col("match_type").isNotNull()).alias("hits"), F.count_if(F.col("match_type").isNull()).alias("failures"),
        F.count_if(want & got).alias("enrichment_hits"), F.count_if(want & ~got).alias("enrichment_missed"),
        F.count_if(F.col("eb") == F.col("birth_year")).alias("births_right"), F.count_if(F.col("eb") != F.col("birth_year")).alias("births_wrong"),
    )


def compare(rows: DataFrame) -> DataFrame:
    """``rows`` with ``category``: how the rules' ids compare with a baseline's.

    ``rows``: ``(title, book_id, author_id, base_book, base_author)``; titled rows are
    compared by book, the others by author.
    """
    titled = F.trim(F.coalesce("title", F.lit(""))) != ""
    ours = F.when(titled, F.col("book_id")).otherwise(F.col("author_id"))
    base = F.when(titled, F.col("base_book")).otherwise(F.col("base_author"))
    category = (
        F.when(ours.isNull() & base.isNull(), "both_miss").when(base.isNull(), "det_found_extra").when(ours.isNull(), "det_miss").when(ours == base, "match").otherwise("different")
    )
    return rows.withColumn("category", category)


def effective_rate(compared: DataFrame) -> DataFrame:
    """One row: of what the baseline found, how much the rules found too, in percent."""
    both, base = F.count_if(F.col("category").isin("match", "different")), F.count_if(F.col("category").isin("match", "different", "det_miss"))
    return compared.agg(both.alias("found_both"), base.alias("base_found"), F.round(100.0 * both / F.greatest(F.lit(1), base), 4).alias("rate"))


def tool_calls(answers: DataFrame, shelf: DataFrame) -> DataFrame:
    """``(idx, doc, result)``: the best record of the tool call in each answer, in order; unreadable answers drop out.

    ``answers``: ``(idx, answer)``; a call is a JSON object with title and author after ``<tool_call>``.
    """
    call = F.regexp_extract("answer", r"(?s)<tool_call>\s*(\{.*\})", 1)
    read = answers.select("idx", F.from_json(F.nullif(call, F.lit("")), "title string, author string").alias("c")).where("c.title IS NOT NULL OR c.author IS NOT NULL")
    hits = record_hits(read.select(F.col("idx").alias("q"), F.col("c.title").alias("q_title"), F.col("c.author").alias("q_author")), shelf, 1)
    out = read.select("idx").join(hits.select(F.col("q").alias("idx"), "doc"), "idx", "left")
    return out.select("idx", "doc", F.when(F.col("doc").isNotNull(), "FOUND").otherwise("NOT_FOUND").alias("result")).orderBy("idx")


def first_pairs(cites: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` distinct ``(title, author)``, both given, in order; fewer are an error."""
    out = cites.where("title IS NOT NULL AND author IS NOT NULL").groupBy("title", "author").agg(F.min("ord").alias("ord")).orderBy("ord").limit(limit)
    if (n := out.count()) < limit:
        raise ValueError(f"only {n} of {limit} pairs of title and author")
    return out.select("title", "author")


def citation_prompts(cites: DataFrame) -> DataFrame:
    """``cites (title, author, source_title, ...)`` with ``prompt``: a source block, then the citation, gaps marked."""
    given = lambda c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("<not provided>"))
    return cites.withColumn("prompt", F.concat(F.lit("Source: "), given("source_title"), F.lit("\nBook title: "), given("title"), F.lit("\nAuthor: "), given("author")))
