"""Queries of the resolved graph's rows, of ground truth and evaluation."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import name_score, relevant_person
from ..operators import document as N
from ..operators import evaluation as V
from ..operators import search as X
from .cleaning import RESOLVED
from .functions import checked_sql
from .registry import BOOKS, CITATIONS, Registry, books, citations, table
from .text import _LINE, _TOK, SHELF, _authors, _people, _shelf, hits_sql

R = Registry()

# Life dates with the errors that repairs look for, by id.
LIVES = "lives AS (SELECT name, (CASE WHEN author_id % 5 = 1 THEN -birth_year ELSE birth_year END)::INT AS birth_year, (CASE WHEN author_id % 5 = 2 THEN -death_year ELSE death_year END)::INT AS death_year, nationality, main_genre FROM canonical_authors)"


def _lives(spark, d):
    k = F.col("author_id") % 5
    return table(spark, d, "canonical_authors").select(
        "name", F.when(k == 1, -F.col("birth_year")).otherwise(F.col("birth_year")).cast("int").alias("birth_year"),
        F.when(k == 2, -F.col("death_year")).otherwise(F.col("death_year")).cast("int").alias("death_year"), "nationality", "main_genre",
    )


# What each citation resolved to: a book by its very title; untitled ones an author, else a person, by name.
FOUND = f"""{CITATIONS}, {BOOKS}, t AS (SELECT title, min(book_id) AS bid FROM books WHERE title IS NOT NULL GROUP BY 1), an AS (SELECT x.name AS aname, min(x.author_id) AS aid FROM (SELECT unnest(authors) AS x FROM books) WHERE x.name IS NOT NULL AND x.author_id IS NOT NULL GROUP BY 1), p AS (SELECT name AS pname, min(author_id) AS pid FROM canonical_authors GROUP BY 1),
found AS (SELECT c.*, bid, CASE WHEN trim(c.title, ' ') = '' THEN aid END AS author_id, pid AS page_id, CASE WHEN trim(c.title, ' ') <> '' THEN CASE WHEN bid IS NOT NULL THEN 'book' ELSE 'not_found' END WHEN aid IS NOT NULL THEN 'author' WHEN pid IS NOT NULL THEN 'person' ELSE 'not_found' END AS match_type
  FROM cites c LEFT JOIN t ON t.title = c.title AND trim(c.title, ' ') <> '' LEFT JOIN an ON aname = c.author LEFT JOIN p ON pname = c.author)"""


def _edges(spark, d):
    b = books(spark, d, "work_id", "title", "authors", "publication_year")
    t = b.where("trim(title) <> ''").groupBy(F.col("title").alias("bt")).agg(F.min("book_id").cast("string").alias("book_id"))
    names = b.select(F.explode("authors").alias("x")).select("x.*").where("name IS NOT NULL AND author_id IS NOT NULL")
    a = names.groupBy(F.col("name").alias("aname")).agg(F.min("author_id").alias("aid"))
    p = table(spark, d, "canonical_authors").groupBy(F.col("name").alias("pname")).agg(F.min("author_id").alias("page_id"))
    c = citations(spark, d, texts=True)
    j = c.join(t, F.col("title") == F.col("bt"), "left").join(a, F.col("author") == F.col("aname"), "left").join(p, F.col("author") == F.col("pname"), "left")
    lone = F.trim("title") == ""
    kind = F.when(~lone & F.col("book_id").isNotNull(), "book").when(lone & F.col("aid").isNotNull(), "author").when(lone & F.col("page_id").isNotNull(), "person").otherwise("not_found")
    found = j.select("ord", kind.alias("match_type"), "book_id", F.when(lone, F.col("aid")).alias("author_id"), "page_id")
    shelf = b.select(F.col("book_id").cast("string").alias("book_id"), "work_id", "title", "authors", "publication_year", F.lit(None).cast("int").alias("original_year"))
    return N.build_edges(c, found, shelf, names, _people(spark, d), _lives(spark, d))


# Target, its life and the person's page of each citation.
EDGES = f"""{FOUND}, {LIVES}, lf AS (SELECT name AS lname, min({{'b': birth_year, 'd': death_year, 'n': nationality, 'g': main_genre}}) AS l FROM lives GROUP BY 1), am AS (SELECT x.author_id AS a_id, min(x.name) AS a_name FROM (SELECT unnest(authors) AS x FROM books) WHERE x.name IS NOT NULL GROUP BY 1),
e0 AS (SELECT f.*, b.work_id, b.title AS b_title, b.authors, b.publication_year, a_name, coalesce(CASE WHEN f.bid IS NOT NULL THEN b.authors[1].name END, a_name, f.author) AS target, ca.name AS p_title, ca.birth_year AS pb, ca.death_year AS pd
  FROM found f LEFT JOIN books b ON b.book_id = f.bid LEFT JOIN am ON a_id = f.author_id LEFT JOIN canonical_authors ca ON ca.author_id = f.page_id),
e AS (SELECT e0.*, l, CASE WHEN p_title IS NOT NULL THEN p_title WHEN l IS NOT NULL THEN target END AS person, CASE WHEN p_title IS NOT NULL OR l IS NOT NULL THEN coalesce(nullif(pb, 0), l.b) END::INT AS person_birth, CASE WHEN p_title IS NOT NULL OR l IS NOT NULL THEN coalesce(nullif(pd, 0), l.d) END::INT AS person_death FROM e0 LEFT JOIN lf ON lname = target)"""


@R.add("edges", f"WITH {EDGES} SELECT ord, match_type AS target_type, CASE WHEN match_type = 'book' THEN bid::VARCHAR END AS target_book_id, CASE WHEN match_type = 'book' THEN array_to_string(list_transform(authors, lambda a: a.author_id::VARCHAR), ',') ELSE coalesce(author_id::VARCHAR, '') END AS target_author_ids, person, person_birth, person_death, CASE WHEN match_type = 'book' THEN b_title END AS match_title, CASE WHEN match_type = 'book' THEN l.n END AS nationality FROM e")
def edges(spark, d):
    """Edges with the person they point to; life dates fill only what the page lacks."""
    p, g = F.col("edge.target_person"), F.col("goodreads_match")
    # Of a book, null tells that none of its authors' ids is known.
    ids = F.when(F.col("edge.target_type") == "book", g["author_ids"]).otherwise(F.col("edge.target_author_ids"))
    ids = F.when((F.size(ids) == 0) | F.exists(ids, lambda x: x.isNotNull()), F.array_join(ids, ","))
    return _edges(spark, d).select(
        "ord", "edge.target_type", "edge.target_book_id", ids.alias("target_author_ids"), p["title"].alias("person"), p["birth_year"].alias("person_birth"),
        p["death_year"].alias("person_death"), g["title"].alias("match_title"), g["author_meta"]["nationality"].alias("nationality"),
    )


_PLACES = """places AS (SELECT ord, 'goodreads_match.author_meta' AS path, l.b AS b0, l.d AS d0 FROM e WHERE match_type = 'book' UNION ALL SELECT ord, 'wikipedia_match', person_birth, person_death FROM e UNION ALL SELECT ord, 'edge.target_person', person_birth, person_death FROM e)"""


@R.add("up_nested_dates", f"WITH {EDGES}, {_PLACES} SELECT path, label, count(*) AS n FROM ({checked_sql('places', 'ord, path')}) WHERE label IS NOT NULL GROUP BY 1, 2")
def up_nested_dates(spark, d):
    """Fixes of life dates at every place of the rows, by place and rule."""
    return N.repair_dates(_edges(spark, d))[1].groupBy("path", "label").agg(F.count("*").alias("n"))


@R.add("up_repaired_edges", f"WITH {EDGES}, {_PLACES}, k AS ({checked_sql('places', 'ord, path')}) SELECT ord, birth_year AS person_birth, death_year AS person_death FROM k WHERE path = 'edge.target_person'")
def up_repaired_edges(spark, d):
    return N.repair_dates(_edges(spark, d))[0].select("ord", F.col("edge.target_person.birth_year").alias("person_birth"), F.col("edge.target_person.death_year").alias("person_death"))


_SRC = "src AS (SELECT source_book_id AS q, title AS q_title, NULL::VARCHAR AS q_author FROM source_books WHERE title IS NOT NULL AND (coalesce(len(authors), 0) = 0 OR publication_year IS NULL))"


@R.add("enrich_sources", f"WITH {BOOKS}, {SHELF}, {LIVES}, {_SRC}, {hits_sql('src', 'a_', 3)}, best AS (SELECT q, arg_min(doc, rank) AS doc FROM a_hits GROUP BY 1), o AS (SELECT s.source_book_id AS book_id, CASE WHEN len(s.authors) > 0 THEN s.authors ELSE list_transform(b.authors, lambda a: a.name) END AS authors, coalesce(s.publication_year, b.publication_year)::INT AS publication_year FROM source_books s LEFT JOIN best ON q = s.source_book_id LEFT JOIN books b ON b.book_id = doc), lf AS (SELECT name, min({{'b': birth_year, 'd': death_year}}) AS l FROM lives GROUP BY 1) SELECT book_id, array_to_string(authors, ' | ') AS authors, publication_year, l.b AS author_birth FROM o LEFT JOIN lf ON name = authors[1]")
def enrich_sources(spark, d):
    """Citing books with what the catalogue knows of them, and their first author's life."""
    s = table(spark, d, "source_books").select(F.col("source_book_id").alias("book_id"), "title", "authors", F.col("publication_year").cast("int").alias("publication_year"))
    b = books(spark, d, "title", "authors", "publication_year", "description").select(F.col("book_id").cast("string").alias("book_id"), "title", F.col("authors.name").alias("authors"), F.col("publication_year").cast("int").alias("publication_year"), "description")
    out = N.enrich_sources(s, b, _lives(spark, d))
    return out.select("book_id", F.array_join("authors", " | ").alias("authors"), "publication_year", F.col("author_metadata.birth_year").alias("author_birth"))


# -- ground truth and evaluation -----------------------------------------------------

_ITEMS = "items AS (SELECT item_id AS q, title AS q_title, author AS q_author FROM eval_items)"
_NAMED = f"named AS (SELECT i.q, n.name AS name, n.author_id, row_number() OVER (PARTITION BY i.q ORDER BY n.author_id, n.name) AS k FROM items i JOIN (SELECT DISTINCT author_id, name FROM canonical_authors) n ON contains(lower(trim(regexp_replace(n.name, '\\s+', ' ', 'g'), ' ')), lower(trim(regexp_replace(i.q_author, '\\s+', ' ', 'g'), ' '))) WHERE trim(regexp_replace(i.q_author, '\\s+', ' ', 'g'), ' ') <> '')"
TRUTH = f"{BOOKS}, {SHELF}, {_ITEMS}, titled AS (SELECT * FROM items WHERE trim(coalesce(q_title, ''), ' ') <> ''), {hits_sql('titled', 'a_', 1)}, {_NAMED}, truth AS (SELECT i.q AS item_id, h.doc AS book_id, CASE WHEN h.doc IS NULL THEN n.author_id END AS author_id, CASE WHEN h.doc IS NOT NULL THEN 'book' WHEN n.author_id IS NOT NULL THEN 'author' END AS match_type FROM items i LEFT JOIN a_hits h USING (q) LEFT JOIN named n ON n.q = i.q AND k = 1)"


def _truth(spark, d):
    items = table(spark, d, "eval_items").select("item_id", "title", "author")
    return V.ground_truth(items, _shelf(spark, d), table(spark, d, "canonical_authors").select("author_id", "name"))


@R.add("ground_truth", f"WITH {TRUTH} SELECT item_id, book_id, author_id, match_type FROM truth")
def ground_truth(spark, d):
    """Expected match of each held-out item: the best book, else the best author, else none."""
    return _truth(spark, d)


_EXPECTED = f"pq AS (SELECT DISTINCT author AS q FROM eval_items WHERE author IS NOT NULL), pl AS (SELECT q, name, author_id, birth_year, death_year, row_number() OVER (PARTITION BY q ORDER BY (lower(q) = lower(name))::INT DESC, author_id) AS k FROM pq JOIN canonical_authors c ON len({_TOK('q')}) > 0 AND contains({_LINE(_TOK('c.name'))}, {_LINE(_TOK('q'))})), expected AS (SELECT item_id, name AS wiki_title, birth_year::INT AS birth_year, death_year::INT AS death_year, CASE WHEN author IS NULL THEN 'No author name in citation' END AS note FROM eval_items LEFT JOIN pl ON q = author AND k = 1)"


def _expected(spark, d):
    return V.enrichment_truth(table(spark, d, "eval_items").select("item_id", "author"), _people(spark, d))


@R.add("enrichment_truth", f"WITH {_EXPECTED} SELECT item_id, wiki_title, birth_year, death_year, note FROM expected")
def enrichment_truth(spark, d):
    """Expected person of each item's author; items without an author say so."""
    return _expected(spark, d)


@R.add("eval_metrics", f"""WITH {TRUTH}, {_EXPECTED}, {LIVES}, got AS (SELECT t.item_id, t.match_type, e.wiki_title, e.birth_year AS eb, l.name AS found, l.birth_year AS gb FROM truth t JOIN expected e USING (item_id) JOIN eval_items i USING (item_id) LEFT JOIN (SELECT name, min(birth_year) AS birth_year FROM lives GROUP BY 1) l ON l.name = i.author)
SELECT count(*) AS total, count(*) FILTER (match_type IS NOT NULL) AS hits, count(*) FILTER (match_type IS NULL) AS failures, count(*) FILTER (wiki_title IS NOT NULL AND found IS NOT NULL) AS enrichment_hits, count(*) FILTER (wiki_title IS NOT NULL AND found IS NULL) AS enrichment_missed, count(*) FILTER (eb = gb) AS births_right, count(*) FILTER (eb <> gb) AS births_wrong FROM got""")
def eval_metrics(spark, d):
    """Hits, failures and missed enrichments of a run against the expected people."""
    items = table(spark, d, "eval_items").select("item_id", "author")
    lives = _lives(spark, d).groupBy("name").agg(F.min("birth_year").alias("birth_year"))
    run = _truth(spark, d).join(items, "item_id").join(lives, F.col("author") == F.col("name"), "left").select("item_id", "match_type", F.col("name").alias("found"), "birth_year")
    return V.metrics(run, _expected(spark, d))


_BASE = "base AS (SELECT item_id, match_type AS base_type, CASE WHEN item_id % 3 = 0 THEN NULL WHEN item_id % 3 = 1 THEN book_id ELSE book_id + 1 END AS base_id, CASE WHEN item_id % 4 = 0 THEN NULL ELSE author_id END AS base_author FROM truth)"
_CATEGORY = """CASE WHEN trim(coalesce(i.title, ''), ' ') <> '' THEN CASE WHEN base_id IS NULL AND t.book_id IS NULL THEN 'both_miss' WHEN base_id IS NULL AND base_type IS NULL THEN 'det_found_extra' WHEN base_id IS NULL THEN 'det_found_extra' WHEN t.book_id IS NULL THEN 'det_miss' WHEN t.book_id = base_id THEN 'match' ELSE 'different' END
 ELSE CASE WHEN base_author IS NULL AND t.author_id IS NULL THEN 'both_miss' WHEN base_author IS NULL THEN 'det_found_extra' WHEN t.author_id IS NULL THEN 'det_miss' WHEN t.author_id = base_author THEN 'match' ELSE 'different' END END"""


@R.add("det_vs_baseline_categories", f"WITH {TRUTH}, {_BASE} SELECT {_CATEGORY} AS category, count(*) AS n FROM truth t JOIN base USING (item_id) JOIN eval_items i USING (item_id) GROUP BY 1")
def det_vs_baseline_categories(spark, d):
    """How the rules' result compares with a baseline's, by item."""
    return _compared(spark, d).groupBy("category").agg(F.count("*").alias("n"))


def _compared(spark, d):
    t = _truth(spark, d)
    k3, k4 = F.col("item_id") % 3, F.col("item_id") % 4
    base = t.select("item_id", F.when(k3 == 1, F.col("book_id")).when(k3 == 2, F.col("book_id") + 1).alias("base_book"), F.when(k4 != 0, F.col("author_id")).alias("base_author"))
    items = table(spark, d, "eval_items").select("item_id", "title")
    return V.compare(t.join(items, "item_id").join(base, "item_id"))


@R.add("effective_rate", f"WITH {TRUTH}, {_BASE}, c AS (SELECT {_CATEGORY} AS category FROM truth t JOIN base USING (item_id) JOIN eval_items i USING (item_id)) SELECT count(*) FILTER (category IN ('match', 'different')) AS found_both, count(*) FILTER (category IN ('match', 'different', 'det_miss')) AS base_found, round(100.0 * count(*) FILTER (category IN ('match', 'different')) / greatest(1, count(*) FILTER (category IN ('match', 'different', 'det_miss'))), 4)::DOUBLE AS rate FROM c")
def effective_rate(spark, d):
    return V.effective_rate(_compared(spark, d))


_SAID = "said AS (SELECT item_id AS q, CASE WHEN item_id % 5 <> 0 THEN title END AS q_title, CASE WHEN item_id % 5 <> 0 THEN author END AS q_author, item_id % 5 <> 0 AND (title IS NOT NULL OR author IS NOT NULL) AS parsed FROM eval_items), asked AS (SELECT q, q_title, q_author FROM said WHERE parsed)"


@R.add("legacy_stage", f"WITH {BOOKS}, {SHELF}, {_SAID}, {hits_sql('asked', 'a_', 1)} SELECT q AS item_id, doc AS book_id, CASE WHEN doc IS NOT NULL THEN 'FOUND' ELSE 'NOT_FOUND' END AS result FROM asked LEFT JOIN a_hits USING (q)")
def legacy_stage(spark, d):
    """Tool calls in answers, searched for their best record; answers that can't be read drop out."""
    i = table(spark, d, "eval_items")
    call = F.concat(F.lit("<tool_call>"), F.to_json(F.struct("title", "author")), F.lit("</tool_call>"))
    answers = i.select(F.col("item_id").alias("idx"), F.when(F.col("item_id") % 5 == 0, "no call").otherwise(call).alias("answer"))
    return V.tool_calls(answers, _shelf(spark, d)).select(F.col("idx").alias("item_id"), F.col("doc").alias("book_id"), "result")


@R.add("first_pairs", f"WITH {CITATIONS}, p AS (SELECT title, author, min(ord) AS ord FROM cites WHERE title <> '' AND author IS NOT NULL GROUP BY 1, 2) SELECT title, author FROM p ORDER BY ord LIMIT 25")
def first_pairs(spark, d):
    """The first 25 distinct pairs of title and author, as a test run takes them."""
    c = citations(spark, d).where("title <> ''")
    return V.first_pairs(c, 25)


@R.add("citation_prompts", f"WITH {CITATIONS} SELECT ord, 'Source: ' || coalesce(s.title, '<not provided>') || chr(10) || 'Book title: ' || coalesce(nullif(c.title, ''), '<not provided>') || chr(10) || 'Author: ' || coalesce(nullif(author, ''), '<not provided>') AS prompt FROM cites c LEFT JOIN source_books s ON s.source_book_id = c.grp")
def citation_prompts(spark, d):
    src = table(spark, d, "source_books").select(F.col("source_book_id").alias("group"), F.col("title").alias("source_title"))
    return V.citation_prompts(citations(spark, d).join(src, "group", "left")).select("ord", "prompt")


@R.add("author_probe", f"WITH {BOOKS}, {SHELF}, {_ITEMS}, who AS (SELECT q, NULL::VARCHAR AS q_title, q_author FROM items WHERE trim(coalesce(q_author, ''), ' ') <> ''), {hits_sql('who', 'a_', 1000000)} SELECT q, doc FROM a_hits JOIN books ON book_id = doc WHERE contains(lower(title), 'the ')")
def author_probe(spark, d):
    """A loose search by author whose titles hold a fragment."""
    asked = table(spark, d, "eval_items").where("trim(author) <> ''").select(F.col("item_id").alias("q"), F.lit(None).cast("string").alias("q_title"), F.col("author").alias("q_author"))
    shelf = _shelf(spark, d)
    return X.record_hits(asked, shelf, 1_000_000).join(shelf.select("doc", "d_title"), "doc").where(F.lower("d_title").contains("the ")).select("q", "doc")


_SCORE = "CASE WHEN lower(name) = lower(q) THEN 3 WHEN starts_with(lower(name), lower(q)) OR starts_with(lower(q), lower(name)) THEN 2 WHEN contains(lower(name), lower(q)) OR contains(lower(q), lower(name)) THEN 1 ELSE 0 END"


@R.add("author_ranking", f"WITH pq AS (SELECT DISTINCT author AS q FROM eval_items WHERE author IS NOT NULL), h AS (SELECT q, author_id, name, regexp_matches(lower(coalesce(main_genre, '')), 'poet|histor|novel') AS rel FROM pq JOIN canonical_authors c ON len({_TOK('q')}) > 0 AND contains({_LINE(_TOK('c.name'))}, {_LINE(_TOK('q'))})), r AS (SELECT q, author_id, row_number() OVER (PARTITION BY q ORDER BY rel DESC, {_SCORE} DESC, author_id) AS k FROM h) SELECT q, author_id FROM r WHERE k = 1")
def author_ranking(spark, d):
    """The people page that a name most likely means: relevant ones first, then by the likeness of the name."""
    q = table(spark, d, "eval_items").where("author IS NOT NULL").select(F.col("author").alias("q")).distinct()
    a = table(spark, d, "canonical_authors")
    # Genres stand in for categories, with the ending that makes them occupations.
    cats = F.array(F.when(F.coalesce("main_genre", F.lit("")).rlike("poet"), "poet").when(F.coalesce("main_genre", F.lit("")).rlike("histor"), "historian").when(F.coalesce("main_genre", F.lit("")).rlike("novel"), "novelist").otherwise(""))
    hits = X.phrase_hits(q, a, "q", "q", "author_id", "name").join(a.select(F.col("author_id").alias("doc"), "name", relevant_person(F.array().cast("array<string>"), cats).alias("rel")), "doc")
    rank = F.row_number().over(W.partitionBy("q").orderBy(F.desc("rel"), F.desc(name_score(F.lower("name"), F.lower("q"))), "doc"))
    return hits.withColumn("k", rank).where("k = 1").select("q", F.col("doc").alias("author_id"))


@R.add("truth_edges", f"WITH {TRUTH}, {LIVES}, lf AS (SELECT name, min(birth_year) AS b FROM lives GROUP BY 1), n AS (SELECT author_id, min(name) AS name FROM canonical_authors GROUP BY 1) SELECT t.item_id, coalesce(t.match_type, 'not_found') AS target_type, b.title AS match_title, coalesce(b.authors[1].name, n.name) AS target_name, lf.b AS author_birth FROM truth t LEFT JOIN books b ON b.book_id = t.book_id LEFT JOIN n ON n.author_id = t.author_id LEFT JOIN lf ON lf.name = coalesce(b.authors[1].name, n.name)")
def truth_edges(spark, d):
    """A graph from the ground truth alone: books and authors with the life of their author."""
    b = books(spark, d, "title", "authors").select("book_id", "title", F.try_element_at("authors", F.lit(1))["name"].alias("first"))
    n = table(spark, d, "canonical_authors").groupBy("author_id").agg(F.min("name").alias("listed"))
    lives = _lives(spark, d).groupBy("name").agg(F.min("birth_year").alias("author_birth"))
    j = _truth(spark, d).join(b, "book_id", "left").join(n, "author_id", "left").withColumn("target_name", F.coalesce("first", "listed"))
    return j.join(lives, F.col("target_name") == F.col("name"), "left").select("item_id", F.coalesce("match_type", F.lit("not_found")).alias("target_type"), F.col("title").alias("match_title"), "target_name", "author_birth")
