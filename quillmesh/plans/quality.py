"""Quality scans and repairs of the catalogue and the resolved graph."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions.text import swapped_author
from ..operators import enrich as E
from ..sources import readers
from .cleaning import RESOLVED, resolved
from .functions import _YTEXT, PARSE, SQ, spelt_years
from .registry import BOOKS, CITATIONS, Registry, books, citations, table

R = Registry()

# Books with the life dates of their first author.
LIFE = f"""{BOOKS}, life AS (SELECT b.book_id, b.title, b.author, b.publication_year AS year, a.birth_year, a.death_year FROM books b LEFT JOIN (SELECT name, min(birth_year) AS birth_year, min(death_year) AS death_year FROM canonical_authors GROUP BY 1) a ON a.name = b.author)"""


def life(spark, d):
    a = table(spark, d, "canonical_authors").groupBy("name").agg(F.min("birth_year").alias("birth_year"), F.min("death_year").alias("death_year"))
    b = books(spark, d, "title", "authors", "publication_year").withColumnRenamed("publication_year", "year")
    return b.join(a, b["author"] == a["name"], "left").select("book_id", "title", "author", "year", "birth_year", "death_year")


def _scan(name: str, where: str, cols: str = "book_id, year", extra: str = "") -> None:
    """A filter over :data:`LIFE`; the condition is common to both dialects."""
    R.add(name, f"WITH {LIFE} SELECT {cols} FROM life WHERE {where}{extra}")(lambda spark, d: life(spark, d).where(where).selectExpr(*[c.strip() for c in cols.split(", ")]))


# Overriding years by book, spelt in six ways: the earliest of a work where a record is later.
OVER = f"""{BOOKS}, late AS (SELECT b.book_id, w.y AS publication_year FROM books b JOIN (SELECT work_id, min(publication_year) AS y FROM books WHERE publication_year <> 0 GROUP BY 1) w USING (work_id) WHERE w.y < b.publication_year),
ov AS (SELECT book_id, {_YTEXT} AS raw FROM late), wrote AS (SELECT b.book_id, b.title, CASE WHEN raw IS NOT NULL THEN {PARSE} ELSE b.publication_year END AS year, coalesce({PARSE}, b.publication_year) AS soft_year, unnest(authors).name AS author, unnest(range(len(authors))) AS pos FROM books b LEFT JOIN ov USING (book_id)),
lives AS (SELECT name, min(birth_year) AS birth_year, min(death_year) AS death_year FROM canonical_authors GROUP BY 1), aw AS (SELECT wrote.*, birth_year, death_year FROM wrote LEFT JOIN lives ON name = author)"""


def overrides(spark, d):
    b = books(spark, d, "work_id", "publication_year")
    w = b.where("publication_year <> 0 AND work_id IS NOT NULL").groupBy("work_id").agg(F.min("publication_year").alias("y"))
    return spelt_years(b.join(w, "work_id").where("y < publication_year").select("book_id", F.col("y").alias("publication_year")))


def wrote(spark, d):
    """``(book_id, title, year, soft_year, author, pos, birth_year, death_year)``: every author of every book.

    ``year``: the override wins even if it can't be read; ``soft_year``: then the book's own.
    """
    b = books(spark, d, "title", "authors", "publication_year").join(overrides(spark, d), "book_id", "left")
    read = D.parse_year(F.col("raw"))
    b = b.select("book_id", "title", F.when(F.col("raw").isNotNull(), read).otherwise(F.col("publication_year")).alias("year"), F.coalesce(read, "publication_year").alias("soft_year"), F.posexplode("authors.name").alias("pos", "author"))
    a = table(spark, d, "canonical_authors").groupBy("name").agg(F.min("birth_year").alias("birth_year"), F.min("death_year").alias("death_year"))
    return b.join(a, b["author"] == a["name"], "left").drop("name")


def _first(rows):
    """The first author of each book that was hit."""
    cols = [c for c in rows.columns if c != "book_id"]
    return rows.groupBy("book_id").agg(F.min_by(F.struct(*cols), "pos").alias("r")).select("book_id", "r.*")


_HIT = lambda cond: f"hit AS (SELECT * FROM aw WHERE {cond} QUALIFY row_number() OVER (PARTITION BY book_id ORDER BY pos) = 1)"
_REPRINT = "year <> 0 AND death_year <> 0 AND year > death_year + 20"
_AGGRESSIVE = "year >= 1900 AND birth_year < 1850"


@R.add("qs_reprints", f"WITH {OVER}, {_HIT(_REPRINT)} SELECT book_id, author, year, year - death_year AS diff FROM hit ORDER BY diff DESC, book_id LIMIT 50")
def qs_reprints(spark, d):
    hit = _first(wrote(spark, d).where(_REPRINT)).select("book_id", "author", "year", F.expr("year - death_year").alias("diff"))
    return hit.orderBy(F.desc("diff"), "book_id").limit(50)  # a top-50 report


@R.add("qs_aggressive_reprints", f"WITH {OVER}, {_HIT(_AGGRESSIVE)} SELECT book_id, author, year, birth_year FROM hit")
def qs_aggressive_reprints(spark, d):
    return _first(wrote(spark, d).where(_AGGRESSIVE)).select("book_id", "author", "year", "birth_year").orderBy("birth_year", "book_id")


@R.add("qs_early_years", f"WITH {OVER}, {_HIT('year < birth_year')} SELECT book_id, author, year, birth_year FROM hit")
def qs_early_years(spark, d):
    return _first(wrote(spark, d).where("year < birth_year")).select("book_id", "author", "year", "birth_year")


_scan("qs_negative_years", "year < 0")
_scan("qs_bad_dates", "year > 2100 OR (year BETWEEN 1 AND 99)")


@R.add("qs_missing_dates", f"WITH {OVER} SELECT b.book_id FROM books b LEFT JOIN ov USING (book_id) WHERE coalesce({PARSE}, nullif(publication_year, 0)) IS NULL")
def qs_missing_dates(spark, d):
    """Books without a year of their own or an overriding one."""
    b = books(spark, d, "publication_year").join(overrides(spark, d), "book_id", "left")
    return b.where(F.coalesce(D.parse_year(F.col("raw")), F.nullif("publication_year", F.lit(0))).isNull()).select("book_id")


@R.add("qs_anonymous", f"WITH {CITATIONS} SELECT ord FROM cites WHERE contains(lower(author), 'anonym') OR contains(lower(author), 'unknown')")
def qs_anonymous(spark, d):
    return citations(spark, d).where("contains(lower(author), 'anonym') OR contains(lower(author), 'unknown')").select("ord")


_PROBES = "'mirror', 'espejo', 'harbor'"


@R.add("qs_needle", f"WITH {BOOKS}, {CITATIONS} SELECT 'title' AS probe, book_id AS id FROM books WHERE len(list_filter([{_PROBES}], lambda w: contains(lower(title), w))) > 0 UNION ALL SELECT 'author', book_id FROM books WHERE len(list_filter(authors, lambda a: starts_with(lower(a.name), 'ada'))) > 0 UNION ALL SELECT 'target', ord FROM cites WHERE contains(lower(coalesce(canonical_author, author)), 'ander')")
def qs_needle(spark, d):
    """Three probes: words of a title, an author's name, a citation's target."""
    b = books(spark, d, "title", "authors")
    needles = F.array(*[F.lit(w.strip(" '")) for w in _PROBES.split(",")])
    one = lambda df, probe, col: df.select(F.lit(probe).alias("probe"), F.col(col).alias("id"))
    named = b.where(F.exists("authors", lambda a: F.lower(a["name"]).startswith("ada")))
    return one(b.where(F.exists(needles, lambda w: F.lower("title").contains(w))), "title", "book_id").unionByName(one(named, "author", "book_id")).unionByName(
        one(citations(spark, d).where("contains(lower(coalesce(canonical_author, author)), 'ander')"), "target", "ord")
    )


@R.add("qs_id_lookup", f"WITH {BOOKS} SELECT book_id, title FROM books WHERE book_id IN (SELECT max(book_id) FROM book_metadata)")
def qs_id_lookup(spark, d):
    top = table(spark, d, "book_metadata").agg(F.max("book_id").alias("top"))
    b = books(spark, d, "title")
    return b.join(F.broadcast(top), b["book_id"] == top["top"], "left_semi").select("book_id", "title")  # one row


@R.add("qs_lint", f"""WITH {OVER}, i AS (SELECT 'Date Format: GID ' || book_id || ' has suspicious format ' || chr(39) || raw || chr(39) AS issue FROM ov WHERE NOT regexp_matches(raw, '^[0-9][0-9][0-9][0-9]-[0-9][0-9]-[0-9][0-9]$|^-?[0-9][0-9]?[0-9]?[0-9]?$') AND NOT contains(raw, 'BC')
 UNION SELECT 'Anachronism (Before Birth): ' || coalesce(title, '') || ' (' || year || ') by ' || author || ' (b. ' || birth_year || ')' FROM aw WHERE year <> 0 AND birth_year <> 0 AND year < birth_year
 UNION SELECT 'Anachronism (After Death): ' || coalesce(title, '') || ' (' || year || ') by ' || author || ' (d. ' || death_year || ')' FROM aw WHERE year <> 0 AND death_year <> 0 AND year > death_year + 50) SELECT issue FROM i ORDER BY issue LIMIT 100""")
def qs_lint(spark, d):
    """Doubtful spellings of dates and anachronisms of any author, the first hundred in order."""
    bad = ~F.col("raw").rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$|^-?[0-9]{1,4}$") & ~F.col("raw").contains("BC")
    formats = overrides(spark, d).where(bad).select(F.concat(F.lit("Date Format: GID "), F.col("book_id").cast("string"), F.lit(" has suspicious format '"), "raw", F.lit("'")).alias("issue"))
    w = wrote(spark, d).where("year <> 0")
    text = lambda head, mark, col: F.concat(F.lit(head), F.coalesce("title", F.lit("")), F.lit(" ("), F.col("year").cast("string"), F.lit(") by "), "author", F.lit(f" ({mark}. "), F.col(col).cast("string"), F.lit(")"))
    found = F.array_compact(F.array(
        F.when(F.expr("birth_year <> 0 AND year < birth_year"), text("Anachronism (Before Birth): ", "b", "birth_year")), F.when(F.expr("death_year <> 0 AND year > death_year + 50"), text("Anachronism (After Death): ", "d", "death_year"))))
    return formats.unionByName(w.select(F.explode(found).alias("issue"))).distinct().orderBy("issue").limit(100)  # a top-100 report


@R.add("qs_future", f"""WITH {RESOLVED} SELECT r.ord, s.publication_year AS src_year, b.publication_year AS tgt_year, b.publication_year - s.publication_year AS diff FROM resolved r JOIN source_books s ON s.source_book_id = r.grp JOIN books b ON b.book_id = try_cast(r.book_id AS BIGINT) WHERE b.publication_year > s.publication_year + 5""")
def qs_future(spark, d):
    src = table(spark, d, "source_books").select(F.col("source_book_id").alias("group"), F.col("publication_year").alias("src_year"))
    tgt = books(spark, d, "publication_year").select(F.col("book_id").cast("string").alias("book_id"), F.col("publication_year").alias("tgt_year"))
    return resolved(spark, d).join(src, "group").join(tgt, "book_id").where("tgt_year > src_year + 5").select("ord", "src_year", "tgt_year", (F.col("tgt_year") - F.col("src_year")).alias("diff"))


@R.add("qs_unknown_targets", f"WITH {RESOLVED} SELECT grp AS source, count(*) AS n FROM resolved WHERE starts_with(book_id, 'web_') GROUP BY 1")
def qs_unknown_targets(spark, d):
    return resolved(spark, d).where(F.col("book_id").startswith("web_")).groupBy(F.col("group").alias("source")).agg(F.count("*").alias("n"))


_OLD = ("republic", "sermon", "psalm", "epic", "oath")


_OLD_AUTHORS = ("juno", "horatio", "ursin")


@R.add("qs_ancient_title", f"WITH {OVER} SELECT DISTINCT book_id, title, year FROM aw WHERE year > 1500 AND (" + " OR ".join([*(f"contains(lower(title), '{w}')" for w in _OLD), *(f"contains(lower(author), '{w}')" for w in _OLD_AUTHORS)]) + ")")
def qs_ancient_title(spark, d):
    """Old works by a word of the title or of any author, but with a modern year."""
    has = lambda col, words: F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.lower(col).contains(w))
    return wrote(spark, d).where("year > 1500").where(has("title", _OLD) | has("author", _OLD_AUTHORS)).select("book_id", "title", "year").distinct()


_ANCIENT = ("plato", "homer", "juno", "horatio", "virgil")


@R.add("qs_ancient_author", "SELECT author_id, name FROM canonical_authors WHERE birth_year > 1500 AND len(list_intersect(string_split(lower(name), ' '), [" + ", ".join(f"'{w}'" for w in _ANCIENT) + "])) > 0")
def qs_ancient_author(spark, d):
    words = F.split(F.lower("name"), " ")
    return table(spark, d, "canonical_authors").where("birth_year > 1500").where(F.arrays_overlap(words, F.array(*[F.lit(w) for w in _ANCIENT]))).select("author_id", "name")


_MENTIONS = "c AS (SELECT author, count(*) AS n FROM cites WHERE author IS NOT NULL GROUP BY 1)"


def _mentions(spark, d):
    return citations(spark, d).where("author IS NOT NULL").groupBy("author").agg(F.count("*").alias("n"))


@R.add("qs_missing_people", f"WITH {CITATIONS}, {_MENTIONS}, m AS (SELECT 'no person' AS issue, author, n FROM c WHERE NOT EXISTS (SELECT 1 FROM canonical_authors a WHERE a.name = c.author) UNION ALL SELECT DISTINCT 'no birth year', author, n FROM c JOIN canonical_authors a ON a.name = c.author WHERE birth_year IS NULL) SELECT issue, author, n FROM m QUALIFY row_number() OVER (PARTITION BY issue ORDER BY n DESC, author) <= 20")
def qs_missing_people(spark, d):
    """Cited authors without a person or without a birth year, the 20 most cited of each."""
    a = table(spark, d, "canonical_authors").groupBy("name").agg(F.bool_or(F.col("birth_year").isNull()).alias("undated"))
    j = _mentions(spark, d).join(a, F.col("author") == F.col("name"), "left")
    issue = F.when(F.col("name").isNull(), "no person").when(F.col("undated"), "no birth year")
    rank = F.row_number().over(W.partitionBy("issue").orderBy(F.desc("n"), "author"))
    return j.select(issue.alias("issue"), "author", "n").where("issue IS NOT NULL").withColumn("r", rank).where("r <= 20").drop("r")  # a top-20 report


_TURNED = ", ".join(f"trim(regexp_extract(author, '^([^,]*),(.*)$', {i}))" for i in (2, 1))
_SWAP = f"CASE WHEN contains(author, ',') THEN {SQ.format('concat_ws(chr(32), ' + _TURNED + ')')} ELSE {SQ.format('author')} END"


@R.add("qs_unknown_years", f"WITH {CITATIONS}, c AS (SELECT {_SWAP} AS author, count(*) AS n FROM cites WHERE author IS NOT NULL GROUP BY 1) SELECT author, n FROM c ANTI JOIN (SELECT name FROM canonical_authors WHERE birth_year IS NOT NULL) a ON a.name = c.author ORDER BY n DESC, author LIMIT 50")
def qs_unknown_years(spark, d):
    c = citations(spark, d).where("author IS NOT NULL").groupBy(swapped_author(F.col("author")).alias("author")).agg(F.count("*").alias("n"))
    dated = table(spark, d, "canonical_authors").where("birth_year IS NOT NULL").select(F.col("name").alias("author"))
    return c.join(dated, "author", "left_anti").orderBy(F.desc("n"), "author").limit(50)  # a top-50 report


@R.add("qs_final_unknowns", f"WITH {OVER} SELECT DISTINCT book_id FROM wrote WHERE nullif(soft_year, 0) IS NULL")
def qs_final_unknowns(spark, d):
    return wrote(spark, d).where("nullif(soft_year, 0) IS NULL").select("book_id").distinct()


@R.add("qs_partial", "SELECT author_id FROM canonical_authors WHERE birth_year IS NULL AND death_year IS NOT NULL")
def qs_partial(spark, d):
    return table(spark, d, "canonical_authors").where("birth_year IS NULL AND death_year IS NOT NULL").select("author_id")


@R.add("qs_structure", f"WITH {RESOLVED} SELECT grp AS source, count(*) FILTER (title <> '' AND work_id IS NULL) AS untraced, count(*) FILTER (author IS NULL OR trim(author, ' ') = '') AS unnamed FROM resolved GROUP BY 1")
def qs_structure(spark, d):
    return resolved(spark, d).groupBy(F.col("group").alias("source")).agg(F.count_if(F.expr("title <> '' AND work_id IS NULL")).alias("untraced"), F.count_if(F.expr("author IS NULL OR trim(author) = ''")).alias("unnamed"))


@R.add("qs_dump", f"WITH {BOOKS}, y AS (SELECT coalesce(work_id, '-' || book_id) AS w, arg_min(publication_year, book_id) FILTER (publication_year <> 0) AS year FROM books GROUP BY 1) SELECT concat_ws(' | ', coalesce(year::VARCHAR, '?'), title, author, book_id::VARCHAR) AS line FROM books b JOIN y ON w = coalesce(work_id, '-' || book_id)")
def qs_dump(spark, d):
    """All records by year, a record without one taking its work's first, unknown years last."""
    b = books(spark, d, "work_id", "title", "authors", "publication_year").withColumn("w", F.coalesce("work_id", F.concat(F.lit("-"), F.col("book_id").cast("string"))))
    y = b.groupBy("w").agg(F.min_by(F.nullif("publication_year", F.lit(0)), F.when(F.col("publication_year") != 0, F.col("book_id"))).alias("year"))
    out = b.join(y, "w").orderBy(F.coalesce("year", F.lit(9999)), "book_id")
    return out.select(F.concat_ws(" | ", F.coalesce(F.col("year").cast("string"), F.lit("?")), "title", "author", F.col("book_id").cast("string")).alias("line"))


@R.add("ids_distinct", f"WITH {RESOLVED} SELECT DISTINCT id FROM (SELECT book_id AS id FROM resolved UNION ALL SELECT book_id::VARCHAR FROM books UNION ALL SELECT source_book_id FROM source_books UNION ALL SELECT work_id FROM books) WHERE id IS NOT NULL")
def ids_distinct(spark, d):
    b = books(spark, d, "work_id")
    ids = resolved(spark, d).select(F.col("book_id").alias("id")).unionByName(b.select(F.col("book_id").cast("string").alias("id"))).unionByName(b.select(F.col("work_id").alias("id")))
    return ids.unionByName(table(spark, d, "source_books").select(F.col("source_book_id").alias("id"))).where("id IS NOT NULL").distinct()


# -- repairs ------------------------------------------------------------------------


@R.add("up_backfill_dates", f"WITH {LIFE}, k AS (SELECT book_id, author, birth_year AS tb, death_year AS td, CASE WHEN book_id % 3 = 0 THEN birth_year - 1 END AS ob, CASE WHEN book_id % 4 = 0 THEN death_year + 1 END AS od FROM life WHERE author IS NOT NULL) SELECT book_id, author, coalesce(ob, tb)::INT AS birth_year, coalesce(od, td)::INT AS death_year FROM k")
def up_backfill_dates(spark, d):
    """Life dates filled in only where a match has none of its own."""
    a = table(spark, d, "canonical_authors").groupBy(F.col("name").alias("author")).agg(F.min("birth_year").alias("birth_year"), F.min("death_year").alias("death_year"))
    b = books(spark, d, "authors").where("author IS NOT NULL").join(a, "author", "left").select(
        "book_id", "author", F.when(F.col("book_id") % 3 == 0, F.col("birth_year") - 1).alias("birth_year"), F.when(F.col("book_id") % 4 == 0, F.col("death_year") + 1).alias("death_year"))
    out = E.fill_missing(b, a, "author", ["birth_year", "death_year"])
    return out.select("book_id", "author", F.col("birth_year").cast("int").alias("birth_year"), F.col("death_year").cast("int").alias("death_year"))


_BC = "bc AS (SELECT author_id, name, -birth_year AS b, -death_year AS d FROM canonical_authors), manual AS (SELECT name, 1::INT AS mb, 2::INT AS md FROM canonical_authors WHERE author_id % 7 = 0), cached AS (SELECT name, birth_year AS cb, death_year AS cd FROM canonical_authors WHERE author_id % 2 = 0 AND birth_year > 0)"


@R.add("up_override_precedence", f"WITH {_BC} SELECT author_id, (CASE WHEN b >= 0 OR b IS NULL THEN b WHEN mb IS NOT NULL THEN mb WHEN cb IS NOT NULL THEN cb WHEN b BETWEEN -2025 AND -1000 THEN -b ELSE b END)::INT AS birth_year, (CASE WHEN b >= 0 OR b IS NULL THEN d WHEN mb IS NOT NULL THEN md WHEN cb IS NOT NULL THEN cd WHEN b BETWEEN -2025 AND -1000 THEN abs(d) ELSE d END)::INT AS death_year FROM bc LEFT JOIN manual USING (name) LEFT JOIN cached USING (name)")
def up_override_precedence(spark, d):
    """Negative births: repaired by hand, else from the cache, else by the sign."""
    a = table(spark, d, "canonical_authors").select("author_id", "name", F.col("birth_year").cast("int").alias("b"), F.col("death_year").cast("int").alias("d"))
    manual = a.where("author_id % 7 = 0").select("name", F.struct(F.lit(1).alias("birth_year"), F.lit(2).alias("death_year")).alias("m"))
    cached = a.where("author_id % 2 = 0 AND b > 0").select("name", F.struct(F.col("b").alias("birth_year"), F.col("d").alias("death_year")).alias("c"))
    bad = a.select("author_id", "name", (-F.col("b")).alias("b"), (-F.col("d")).alias("d")).join(manual, "name", "left").join(cached, "name", "left")
    own = F.struct(F.col("b").alias("birth_year"), F.col("d").alias("death_year"))
    fixed = F.when(F.col("b") < 0, F.coalesce("m", "c", D.flip_sign(F.col("b"), F.col("d")))).otherwise(own)
    return bad.select("author_id", fixed.alias("v")).select("author_id", "v.*")


@R.add("up_apply_metadata", f"""WITH {CITATIONS}, a AS (SELECT name, min(nationality) AS nationality, min(main_genre) AS genre FROM canonical_authors GROUP BY 1)
SELECT ord, coalesce(x.nationality, y.nationality) AS nationality, coalesce(x.genre, y.genre) AS genre FROM cites c LEFT JOIN a x ON x.name = c.canonical_author LEFT JOIN a y ON y.name = c.author""")
def up_apply_metadata(spark, d):
    a = table(spark, d, "canonical_authors").groupBy("name").agg(F.min("nationality").alias("nationality"), F.min("main_genre").alias("genre"))
    side = lambda p: a.select(*[F.col(c).alias(f"{p}_{c}") for c in a.columns])
    c = citations(spark, d).select("ord", "author", "canonical_author").join(side("x"), F.col("canonical_author") == F.col("x_name"), "left").join(side("y"), F.col("author") == F.col("y_name"), "left")
    return c.select("ord", F.coalesce("x_nationality", "y_nationality").alias("nationality"), F.coalesce("x_genre", "y_genre").alias("genre"))


@R.add("up_source_backfill", f"WITH {BOOKS}, t AS (SELECT title, min(publication_year) FILTER (publication_year <> 0) AS y FROM books GROUP BY 1) SELECT source_book_id, coalesce(s.publication_year, t.y)::INT AS publication_year FROM source_books s LEFT JOIN t USING (title)")
def up_source_backfill(spark, d):
    t = books(spark, d, "title", "publication_year").where("title IS NOT NULL").groupBy("title").agg(F.min(F.when(F.col("publication_year") != 0, F.col("publication_year"))).alias("publication_year"))
    s = table(spark, d, "source_books").select("source_book_id", "title", F.col("publication_year").cast("int").alias("publication_year"))
    return E.fill_missing(s, t, "title", ["publication_year"]).select("source_book_id", "publication_year")


@R.add("up_forced_overrides", f"WITH {BOOKS} SELECT book_id, (CASE WHEN publication_year IN (9999, 2991) THEN NULL WHEN publication_year BETWEEN -2025 AND -1000 THEN -publication_year ELSE publication_year END)::INT AS year FROM books")
def up_forced_overrides(spark, d):
    y = F.col("publication_year")
    return books(spark, d, "publication_year").select("book_id", F.when(y.isin(9999, 2991), None).when(y.between(-2025, -1000), -y).otherwise(y).cast("int").alias("year"))


@R.add("up_update_by_key", f"WITH {BOOKS}, n AS (SELECT book_id, CASE WHEN book_id % 2 = 0 THEN publication_year + 1 END AS y FROM books WHERE book_id % 5 = 0) SELECT b.book_id, coalesce(n.y, b.publication_year)::INT AS publication_year FROM books b LEFT JOIN n USING (book_id)")
def up_update_by_key(spark, d):
    """A column rewritten by key from a map; keys that the table lacks are not added."""
    b = books(spark, d, "publication_year").select("book_id", F.col("publication_year").cast("int").alias("publication_year"))
    new = b.where("book_id % 5 = 0").select("book_id", F.when(F.col("book_id") % 2 == 0, F.col("publication_year") + 1).alias("publication_year"))
    absent = b.sparkSession.createDataFrame([(-1, 1)], "book_id bigint, publication_year int")
    return E.update_present(b, new.unionByName(absent), "book_id")


# A library over the citing books: ids of catalogue records by their last digits, texts of books with a language.
_IDS = "ids AS (SELECT s.source_book_id AS book, min(b.book_id) AS gid FROM source_books s JOIN books b ON b.book_id % 100 = try_cast(right(s.source_book_id, 2) AS INT) GROUP BY 1)"


@R.add("library_lookup", f"WITH {BOOKS}, {_IDS} SELECT s.source_book_id AS id, gid::VARCHAR AS goodreads_id, CASE WHEN publication_year IS NOT NULL THEN lang END AS description FROM source_books s JOIN ids ON book = source_book_id WHERE lang IS NOT NULL AND gid % 3 <> 0")
def library_lookup(spark, d):
    """A personal library with catalogue ids on an allow-list, its files of the wanted format and comments where there are any."""
    s = table(spark, d, "source_books")
    b = books(spark, d, "work_id").select("book_id", (F.col("book_id") % 100).cast("int").alias("k"))
    ids = s.select("source_book_id", F.substring("source_book_id", -2, 2).try_cast("int").alias("k")).join(b, "k").groupBy(F.col("source_book_id").alias("book")).agg(F.min("book_id").cast("string").alias("val")).withColumn("type", F.lit("goodreads"))
    formats = s.select(F.col("source_book_id").alias("book"), F.when(F.col("lang").isNotNull(), "TXT").otherwise("PDF").alias("format"), F.col("title").alias("name"))
    comments = s.where("publication_year IS NOT NULL").select(F.col("source_book_id").alias("book"), F.col("lang").alias("text"))
    allowed = ids.where("CAST(val AS BIGINT) % 3 <> 0").select(F.col("val").alias("goodreads_id"))
    return readers.library_books(s.select(F.col("source_book_id").alias("id")), ids, formats, comments, allowed).select("id", "goodreads_id", "description")


_PROJECTED = """SELECT book_id::VARCHAR AS book_id, nullif(title, '') AS title, nullif(array_to_string(list_filter(list_transform(authors, lambda a: trim(a.name, ' ')), lambda n: n <> ''), ' | '), '') AS author_names,
  CASE WHEN length(trim(description, ' ')) > 512 THEN rtrim(substr(trim(description, ' '), 1, 512), ' ') || '...' ELSE nullif(trim(description, ' '), '') END AS description, publication_year::INT AS publication_year, average_rating, ratings_count, nullif(link, '') AS link FROM books"""


@R.add("catalogue_projection", f"WITH {BOOKS} {_PROJECTED}")
def catalogue_projection(spark, d):
    out = E.project_record(books(spark, d, "title", "authors", "publication_year", "average_rating", "ratings_count", "description", "link"))
    return out.withColumn("author_names", F.array_join("author_names", " | ")).select("book_id", "title", "author_names", "description", "publication_year", "average_rating", "ratings_count", "link")


@R.add("denormalised_authors", f"WITH {BOOKS}, x AS (SELECT book_id, unnest(authors) AS a, unnest(range(len(authors))) AS p FROM books), m AS (SELECT author_id, min(name) AS name FROM canonical_authors GROUP BY 1), n AS (SELECT book_id, a.name AS v, p * 2 AS p FROM x WHERE a.name IS NOT NULL UNION ALL SELECT book_id, m.name, p * 2 + 1 FROM x JOIN m ON m.author_id = a.author_id), o AS (SELECT book_id, v, min(p) AS p FROM n GROUP BY 1, 2) SELECT book_id, string_agg(v, ' ' ORDER BY p) AS authors_field FROM o GROUP BY 1")
def denormalised_authors(spark, d):
    out = E.denormalise_authors(books(spark, d, "authors").select("book_id", "authors"), table(spark, d, "canonical_authors").select("author_id", "name"))
    return out.select("book_id", F.array_join("author_names", " ").alias("authors_field"))
