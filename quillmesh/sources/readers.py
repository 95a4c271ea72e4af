"""Readers: texts, JSON documents and lines, key-value maps, XML dumps, web pages, databases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.text import squeeze, strip_marks

#: Files of a results folder that hold no graph.
NOT_GRAPHS = ("manifest.json", "datasets.json", "authors_metadata.json", "original_publication_dates.json")


def texts(spark: SparkSession, path: str, pattern: str = "*.txt") -> DataFrame:
    """``(book_id, title, text, numbered)`` of a folder or file; names like ``Title_of_book_123.txt``.

    Without a number the stem is the id, and its part before a double underscore,
    underscores as blanks, the title to look up.
    """
    raw = spark.read.option("wholetext", True).option("pathGlobFilter", pattern).text(path)
    stem = F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]*$", "")
    number = F.nullif(F.regexp_extract(stem, r"_(\d+)$", 1), F.lit(""))
    named = F.regexp_replace(stem, r"_\d+$", "")
    loose = F.trim(F.split_part(F.replace(stem, F.lit("_"), F.lit(" ")), F.lit("  "), F.lit(1)))
    title = F.when(number.isNotNull(), F.replace(named, F.lit("_"), F.lit(" "))).otherwise(loose)
    return raw.select(F.coalesce(number, stem).alias("book_id"), title.alias("title"), F.col("value").alias("text"), number.isNotNull().alias("numbered"))


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines under a stated schema; malformed lines are skipped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def json_documents(spark: SparkSession, path: str, schema: str = schemas.RAW_DOCUMENT, recursive: bool = True) -> DataFrame:
    """One row per JSON document, bookkeeping files left out."""
    docs = spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", recursive).option("pathGlobFilter", "*.json").json(path)
    return docs.withColumn("file_name", F.col("_metadata.file_name")).where(~F.col("file_name").isin(*NOT_GRAPHS))


def from_manifest(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """The documents that ``manifest.json`` lists."""
    listed = spark.read.option("wholetext", True).text(f"{folder}/manifest.json").select(F.explode(F.from_json("value", "array<string>")).alias("f"))
    docs = spark.read.schema(schema).option("multiLine", True).option("pathGlobFilter", "*.json").json(folder).withColumn("file_name", F.col("_metadata.file_name"))
    return docs.join(listed, F.col("file_name") == F.col("f"), "left_semi")


def key_values(spark: SparkSession, path: str, value: str = "string") -> DataFrame:
    """``(key, value)`` of a JSON object; unreadable files are empty."""
    raw = spark.read.option("wholetext", True).text(path)
    return raw.select(F.explode(F.from_json("value", f"map<string,{value}>")).alias("key", "value"))


def xml_pages(spark: SparkSession, path: str) -> DataFrame:
    """``(title, ns, page_id, redirect, text)`` of a wiki dump, latest revision of each page."""
    schema = "title string, ns int, id bigint, redirect struct<_title: string>, revision array<struct<id: bigint, text: string>>"
    raw = spark.read.format("xml").option("rowTag", "page").schema(schema).load(path)
    last = F.element_at("revision", -1)
    return raw.select("title", "ns", F.col("id").alias("page_id"), last["id"].alias("rev_id"), F.col("redirect").isNotNull().alias("redirect"), last["text"].alias("text"))


def jdbc_table(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """A database table (needs the driver on the class path)."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def library_books(books: DataFrame, identifiers: DataFrame, formats: DataFrame, comments: DataFrame, allowed: DataFrame | None = None) -> DataFrame:
    """Books of a personal library with a catalogue id and a text file.

    ``allowed``: ``(goodreads_id)`` restricts by a semi-join.
    """
    ids = identifiers.where("type = 'goodreads'").select(F.col("book").alias("id"), F.col("val").alias("goodreads_id"))
    out = books.join(ids, "id").join(formats.where("format = 'TXT'").select(F.col("book").alias("id"), F.col("name").alias("file")), "id")
    out = out.join(comments.select(F.col("book").alias("id"), F.col("text").alias("description")), "id", "left")
    return out if allowed is None else out.join(allowed.select("goodreads_id").distinct(), "goodreads_id", "left_semi")


# -- pages -------------------------------------------------------------------------


def plain(c: Column) -> Column:
    """Text of an HTML piece: tags and common entities resolved, marks dropped."""
    t = F.regexp_replace(c, r"(?s)<[^>]*>", "")
    for entity, char in (("&amp;", "&"), ("&quot;", '"'), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&nbsp;", " ")):
        t = F.replace(t, F.lit(entity), F.lit(char))
    return squeeze(strip_marks(t))


def paragraphs(html: Column, least: int = 30, within: int = 5, most: int = 3) -> Column:
    """The first ``most`` long paragraphs among the first ``within``."""
    found = F.transform(F.regexp_extract_all(html, F.lit(r"(?s)<p[^>]*>(.*?)</p>"), F.lit(1)), plain)
    return F.slice(F.filter(F.slice(found, 1, within), lambda p: F.length(p) > least), 1, most)


def infobox(html: Column) -> Column:
    """``map<string,string>`` of the table rows with a head and a value."""
    rows = F.regexp_extract_all(html, F.lit(r"(?s)<tr[^>]*>(.*?)</tr>"), F.lit(1))
    cells = F.transform(rows, lambda r: F.struct(plain(F.regexp_extract(r, r"(?s)<th[^>]*>(.*?)</th>", 1)).alias("key"), plain(F.regexp_extract(r, r"(?s)<td[^>]*>(.*?)</td>", 1)).alias("value")))
    kept = F.filter(cells, lambda x: (x["key"] != "") & (x["value"] != ""))
    # The last row of a head counts.
    keys = F.array_distinct(F.transform(kept, lambda x: x["key"]))
    return F.map_from_arrays(keys, F.transform(keys, lambda k: F.element_at(F.filter(kept, lambda x: x["key"] == k), -1)["value"]))


def headings(html: Column, most: int = 8) -> Column:
    """Result headings of a search page."""
    found = F.regexp_extract_all(html, F.lit(r'(?s)class="mw-search-result-heading"[^>]*>(.*?)</div>'), F.lit(1))
    return F.slice(F.transform(found, plain), 1, most)


def publication_ms(html: Column) -> Column:
    """``publicationTime`` of the first work in a page's state object."""
    state = F.regexp_extract(html, r'(?s)<script id="__NEXT_DATA__"[^>]*>(.*?)</script>', 1)
    parsed = F.from_json(state, "props struct<pageProps: struct<apolloState: map<string, struct<details: struct<publicationTime: bigint>>>>>")
    works = F.filter(F.map_entries(parsed["props"]["pageProps"]["apolloState"]), lambda e: e["key"].startswith("Work:"))
    return F.get(works, 0)["value"]["details"]["publicationTime"]


def categories(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"(?i)\[\[Category:([^\]]+)\]\]"), F.lit(1))


def infobox_names(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(r"(?i)\{\{Infobox\s*([^\n|]+)"), F.lit(1)), lambda x: F.trim(x))


#: What shows a page of namesakes, a person's category and a person's box (any case).
NAMESAKES = r"\{\{(?:disambiguation|hndis|geodis)"
PEOPLE_CATEGORIES = "births|living people|deaths"
PEOPLE_BOXES = "person|scientist|writer|artist|philosopher|biography|academic|politician"


def is_person(text: Column) -> Column:
    """A page about a person: by categories or boxes, and no list of namesakes."""
    named = F.exists(categories(text), lambda c: F.lower(c).rlike(PEOPLE_CATEGORIES)) | F.exists(infobox_names(text), lambda b: F.lower(b).rlike(PEOPLE_BOXES))
    return named & ~F.lower(text).rlike(NAMESAKES)


def category_year(text: Column, kind: str) -> Column:
    """Year of the last category that names 'births' or 'deaths' after a year; BC is negative."""
    pattern = rf"(?i)([0-9]{{1,4}})(?:\s+(BC))?\s+{kind}"
    years = F.transform(categories(text), lambda c: F.when(
        c.rlike(pattern), F.regexp_extract(c, pattern, 1).cast("int") * F.when(F.regexp_extract(c, pattern, 2) != "", -1).otherwise(1)
    ))
    return F.try_element_at(F.filter(years, lambda y: y.isNotNull()), F.lit(-1))


def people_pages(pages: DataFrame) -> DataFrame:
    """People of a wiki dump ``(title, ns, page_id, rev_id, redirect, text)``: articles with text that are no redirects."""
    text = F.col("text")
    return pages.where("ns = 0 AND NOT redirect AND text IS NOT NULL").where(is_person(text)).select(
        "title", "page_id", "rev_id", categories(text).alias("categories"), infobox_names(text).alias("infoboxes"),
        category_year(text, "births").alias("birth_year"), category_year(text, "deaths").alias("death_year"),
    )


def page_digest(html: Column, url: Column) -> Column:
    """Title, facts of under 500 letters and the first three paragraphs of over 50 letters among the first four."""
    title = F.nullif(plain(F.regexp_extract(html, r'(?s)id="firstHeading"[^>]*>(.*?)</h1>', 1)), F.lit(""))
    facts = F.filter(F.map_entries(infobox(html)), lambda e: F.length(e["value"]) < 500)
    return F.struct(F.coalesce(title, F.lit("Unknown")).alias("title"), url.alias("url"), facts.alias("facts"), paragraphs(html, 50, 4, 3).alias("summary"))


def search_page(html: Column, url: Column) -> Column:
    """``struct<direct, hits>``: whether the search went straight to an article, else the headings found."""
    direct = url.contains("/wiki/") & ~url.contains("Special:Search")
    return F.struct(direct.alias("direct"), F.when(direct, F.array().cast("array<string>")).otherwise(headings(html)).alias("hits"))


def all_libraries(spark: SparkSession, folders: list[str], schema: str = schemas.RAW_DOCUMENT) -> DataFrame:
    """The documents of several result folders in one table, each with its ``library``."""
    docs = spark.read.schema(schema).option("multiLine", True).option("pathGlobFilter", "*.json").json(folders)
    return docs.withColumns({"file_name": F.col("_metadata.file_name"), "library": F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1)}).where(~F.col("file_name").isin(*NOT_GRAPHS))
