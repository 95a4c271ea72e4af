"""Graph queries: links, nodes, years, neighbourhoods, panels, search."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions.text import slug
from ..operators import graph as G
from ..operators.dedup import dedup_by_work
from ..operators.tables import kept
from .cleaning import RESOLVED, _merge_sql, resolved
from .registry import BOOKS, CITATIONS, Registry, books, citations, table

R = Registry()

# One row per citation that names an author: citing book and its author, cited author, cited book.
MART = f"""{CITATIONS}, mart AS (
  SELECT c.grp AS book, s.authors[1] AS src, c.author AS dst, c.title, c.ord, c.cite_count, s.publication_year AS src_year FROM cites c JOIN source_books s ON s.source_book_id = c.grp
  WHERE c.author IS NOT NULL AND trim(c.author, ' ') <> ''), links AS (SELECT src, dst, count(DISTINCT book) AS n_books FROM mart WHERE src <> dst GROUP BY 1, 2)"""


def mart(spark, d):
    src = table(spark, d, "source_books").select(F.col("source_book_id").alias("book"), F.try_element_at("authors", F.lit(1)).alias("src"), F.col("publication_year").alias("src_year"))
    c = citations(spark, d).where("author IS NOT NULL AND trim(author) <> ''").select(F.col("group").alias("book"), F.col("author").alias("dst"), "title", "ord", "cite_count")
    return c.join(src, "book")


def links(spark, d):
    return G.author_links(mart(spark, d))


_TOP = "(SELECT src FROM links GROUP BY src ORDER BY count(*) DESC, src LIMIT 1)"


def busiest(links_df):
    """The author with most out-links (one row)."""
    return links_df.groupBy("src").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "src").limit(1).select(F.col("src").alias("who"))


_DEDUP = _merge_sql("nullif(work_id, '')")


@R.add("flagship_author_links", f"""WITH {RESOLVED}, merged AS (WITH {_DEDUP}),
l AS (SELECT s.authors[1] AS src, r.author AS dst, r.grp AS book, m.cite_count FROM merged m JOIN resolved r USING (ord) JOIN source_books s ON s.source_book_id = r.grp WHERE r.author IS NOT NULL AND trim(r.author, ' ') <> '' AND s.authors[1] <> r.author)
SELECT src, dst, count(DISTINCT book) AS n_books, sum(cite_count)::BIGINT AS n_mentions FROM l GROUP BY src, dst""")
def flagship_author_links(spark, d):
    """Which authors each source author cites, in how many books, after merging editions of a work."""
    m = dedup_by_work(resolved(spark, d), scope="group")
    src = table(spark, d, "source_books").select(F.col("source_book_id").alias("group"), F.try_element_at("authors", F.lit(1)).alias("src"))
    rows = m.where("author IS NOT NULL AND trim(author) <> ''").join(src, "group").where("src <> author")
    # Per book first: the second step then counts rows instead of distinct books.
    per = rows.groupBy("src", F.col("author").alias("dst"), "group").agg(F.sum("cite_count").alias("n"))
    return per.groupBy("src", "dst").agg(F.count("*").alias("n_books"), F.sum("n").alias("n_mentions"))


@R.add("author_links", f"WITH {MART} SELECT src, dst, count(DISTINCT book) AS n_books, string_agg(DISTINCT book, ',' ORDER BY book) AS source_books FROM mart WHERE src <> dst GROUP BY 1, 2")
def author_links(spark, d):
    return links(spark, d).withColumn("source_books", F.array_join("source_books", ","))


@R.add("book_edges", f"WITH {MART} SELECT book, dst, title, count(*) AS n, sum(cite_count)::BIGINT AS n_mentions FROM mart GROUP BY 1, 2, 3")
def book_edges(spark, d):
    return mart(spark, d).groupBy("book", "dst", "title").agg(F.count("*").alias("n"), F.sum("cite_count").alias("n_mentions"))


@R.add("graph_author_nodes", f"""WITH {MART}, c AS (SELECT dst AS name, count(*) AS n_cited, count(DISTINCT title) AS n_books FROM mart GROUP BY 1), s AS (SELECT DISTINCT authors[1] AS sname FROM source_books WHERE authors[1] IS NOT NULL)
SELECT coalesce(name, sname) AS name, sname IS NOT NULL AS is_source, coalesce(n_cited, 0) AS n_cited, coalesce(n_books, 0) AS n_books FROM c FULL JOIN s ON name = sname""")
def graph_author_nodes(spark, d):
    src = table(spark, d, "source_books").select(F.try_element_at("authors", F.lit(1)).alias("author"))
    return G.author_nodes(mart(spark, d).withColumnRenamed("title", "cited_id"), src)


@R.add("graph_book_nodes", f"""WITH {RESOLVED} SELECT book_id, arg_min(title, ord) AS title, count(*) AS n_citations, sum(cite_count)::BIGINT AS n_mentions, bool_or(work_id IS NOT NULL) AS in_catalogue FROM resolved WHERE title <> '' GROUP BY book_id""")
def graph_book_nodes(spark, d):
    return resolved(spark, d).where("title <> ''").groupBy("book_id").agg(
        F.min_by("title", "ord").alias("title"), F.count("*").alias("n_citations"), F.sum("cite_count").alias("n_mentions"), F.bool_or(F.col("work_id").isNotNull()).alias("in_catalogue")
    )


_NODES = """nodes AS (SELECT name, min(birth_year) AS birth_year, min(death_year) AS death_year, bool_or(s) AS is_source, CASE WHEN bool_or(s) THEN avg(y) END AS book_year FROM (
  SELECT m.dst AS name, a.birth_year, a.death_year, false AS s, NULL::DOUBLE AS y FROM (SELECT DISTINCT dst FROM mart) m LEFT JOIN canonical_authors a ON a.name = m.dst
  UNION ALL SELECT s.authors[1], a.birth_year, a.death_year, true, s.publication_year FROM source_books s LEFT JOIN canonical_authors a ON a.name = s.authors[1] WHERE s.authors[1] IS NOT NULL) GROUP BY name)"""


def _nodes(spark, d):
    """Everybody who cites or is cited, with the life dates the table has."""
    known = table(spark, d, "canonical_authors").groupBy(F.col("name").alias("kn")).agg(F.min("birth_year").cast("int").alias("birth_year"), F.min("death_year").cast("int").alias("death_year"))
    cited = mart(spark, d).select(F.col("dst").alias("name")).distinct().select("name", F.lit(False).alias("s"), F.lit(None).cast("double").alias("y"))
    src = table(spark, d, "source_books").select(F.try_element_at("authors", F.lit(1)).alias("name"), F.lit(True).alias("s"), F.col("publication_year").cast("double").alias("y")).where("name IS NOT NULL")
    nodes = cited.unionByName(src).groupBy("name").agg(F.bool_or("s").alias("is_source"), F.avg("y").alias("book_year"))
    return nodes.join(known, F.col("name") == F.col("kn"), "left").select("name", "birth_year", "death_year", "is_source", "book_year")


@R.add("graph_year_imputation", f"""WITH {MART}, {_NODES}, k AS (SELECT name, coalesce((birth_year + coalesce(death_year, birth_year + 60)) / 2.0, book_year, CASE WHEN is_source THEN 2000.0 END) AS y0,
  CASE WHEN birth_year IS NOT NULL THEN 'life' WHEN book_year IS NOT NULL THEN 'books' WHEN is_source THEN 'source' END AS how0 FROM nodes),
b AS (SELECT src AS a, dst AS b FROM links UNION SELECT dst, src FROM links), n AS (SELECT a, floor(avg(y0) - 40 + 0.5) AS ny FROM b JOIN k ON k.name = b.b WHERE y0 IS NOT NULL GROUP BY a),
y AS (SELECT k.*, ny, coalesce(y0, ny) AS y1 FROM k LEFT JOIN n ON n.a = k.name), m AS (SELECT list_sort(list(y1))[floor(count(y1) / 2)::INT + 1] AS med FROM y WHERE y1 IS NOT NULL)
SELECT name, round(coalesce(y1, med), 4)::DOUBLE AS year, coalesce(how0, CASE WHEN ny IS NOT NULL THEN 'neighbours' ELSE 'median' END) AS how FROM y, m""")
def graph_year_imputation(spark, d):
    return G.impute_years(_nodes(spark, d), links(spark, d)).withColumn("year", F.round("year", 4))


@R.add("upper_median", "SELECT list_sort(list(birth_year))[floor(count(birth_year) / 2)::INT + 1] AS median FROM canonical_authors WHERE birth_year IS NOT NULL")
def upper_median(spark, d):
    return G.upper_median(table(spark, d, "canonical_authors"), "birth_year")


@R.add("distribution_top7", "WITH c AS (SELECT main_genre AS bucket, count(*) AS n FROM canonical_authors WHERE main_genre IS NOT NULL GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY n DESC, bucket) AS rn, count(*) OVER () AS size FROM c) SELECT CASE WHEN size <= 7 OR rn < 7 THEN bucket ELSE 'Other' END AS bucket, sum(n)::BIGINT AS n, (CASE WHEN size <= 7 OR rn < 7 THEN rn ELSE 7 END)::INT AS pos FROM r GROUP BY 1, 3")
def distribution_top7(spark, d):
    return G.distribution(table(spark, d, "canonical_authors"), "main_genre")


@R.add("distribution_epochs", "WITH e AS (SELECT CASE " + " ".join(f"WHEN birth_year < {b} THEN '{n}'" for b, n in D.EPOCHS) + " ELSE 'Contemporary' END AS bucket FROM canonical_authors WHERE birth_year IS NOT NULL), c AS (SELECT bucket, count(*) AS n FROM e GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY n DESC, bucket) AS rn, count(*) OVER () AS size FROM c) SELECT CASE WHEN size <= 7 OR rn < 7 THEN bucket ELSE 'Other' END AS bucket, sum(n)::BIGINT AS n, (CASE WHEN size <= 7 OR rn < 7 THEN rn ELSE 7 END)::INT AS pos FROM r GROUP BY 1, 3")
def distribution_epochs(spark, d):
    return G.distribution(table(spark, d, "canonical_authors").select(D.epoch_of(F.col("birth_year")).alias("epoch")), "epoch")


@R.add("neighbourhood", f"WITH {MART} SELECT dst AS name, n_books FROM links WHERE src = {_TOP}")
def neighbourhood(spark, d):
    ls = kept(links(spark, d))
    return ls.join(F.broadcast(busiest(ls)), F.col("src") == F.col("who")).select(F.col("dst").alias("name"), "n_books")


@R.add("focus_by_book", f"WITH {MART}, h AS (SELECT grp AS book FROM cites GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) SELECT src, dst FROM mart JOIN h USING (book) WHERE src <> dst GROUP BY 1, 2")
def focus_by_book(spark, d):
    hot = citations(spark, d).groupBy("group").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "group").limit(1).select(F.col("group").alias("hot"))
    one = mart(spark, d).join(F.broadcast(hot), F.col("book") == F.col("hot"))  # one row; filtered before the links are built
    return G.author_links(one).select("src", "dst")


@R.add("dim_sets", f"WITH {MART}, who AS (SELECT {_TOP} AS w), lit AS (SELECT dst AS n FROM links, who WHERE src = w UNION SELECT src FROM links, who WHERE dst = w UNION SELECT w FROM who), everyone AS (SELECT src AS name FROM links UNION SELECT dst FROM links) SELECT name FROM everyone WHERE name NOT IN (SELECT n FROM lit)")
def dim_sets(spark, d):
    ls = kept(links(spark, d))
    who = kept(busiest(ls))
    lit = ls.join(F.broadcast(who), F.col("who").isin(F.col("src"), F.col("dst"))).select(F.explode(F.array("src", "dst")).alias("l")).distinct()
    return ls.select(F.explode(F.array("src", "dst")).alias("name")).distinct().join(lit, F.col("name") == F.col("l"), "left_anti")


@R.add("dim_links", f"WITH {MART} SELECT src, dst, src = {_TOP} AS lit FROM links")
def dim_links(spark, d):
    """Links that the focus leaves lit, and the others."""
    ls = kept(links(spark, d))
    return G.out_links(ls, busiest(ls).withColumnRenamed("who", "name"))


@R.add("panel_donut", f"WITH {MART}, b AS (SELECT CASE " + " ".join(f"WHEN birth_year < {b} THEN '{n}'" for b, n in D.EPOCHS) + f" ELSE 'Contemporary' END AS bucket FROM (SELECT DISTINCT dst FROM links WHERE src = {_TOP}) JOIN canonical_authors ON name = dst WHERE birth_year IS NOT NULL), c AS (SELECT bucket, count(*) AS n FROM b GROUP BY 1) SELECT bucket, n FROM c WHERE (SELECT count(*) FROM c) >= 3")
def panel_donut(spark, d):
    """Epochs of the authors that the busiest one cites; shown with three buckets or more."""
    ls = kept(links(spark, d))
    a = table(spark, d, "canonical_authors").where("birth_year IS NOT NULL").select(F.col("name").alias("dst"), D.epoch_of(F.col("birth_year")).alias("bucket"))
    c = ls.join(F.broadcast(busiest(ls)), F.col("src") == F.col("who")).select("dst").distinct().join(a, "dst").groupBy("bucket").agg(F.count("*").alias("n"))
    return c.withColumn("k", F.count("*").over(W.partitionBy(F.lit(1)))).where("k >= 3").drop("k")  # at most nine rows


@R.add("panel_works", f"WITH {MART}, {BOOKS}, w AS (SELECT DISTINCT dst, title FROM mart WHERE src = {_TOP} AND title <> ''), y AS (SELECT title, min(publication_year) FILTER (publication_year <> 0) AS year FROM books GROUP BY 1) SELECT dst, w.title, year::INT AS year FROM w LEFT JOIN y ON y.title = w.title")
def panel_works(spark, d):
    """Works that the busiest author cites, by year, unknown years last."""
    m = kept(mart(spark, d))
    y = books(spark, d, "title", "publication_year").where("title IS NOT NULL").groupBy("title").agg(F.min(F.nullif("publication_year", F.lit(0))).cast("int").alias("year"))
    w = m.join(F.broadcast(busiest(G.author_links(m))), F.col("src") == F.col("who")).where("title <> ''").select("dst", "title").distinct()
    return w.join(y, "title", "left").select("dst", "title", "year").orderBy(F.asc_nulls_last("year"), "dst", "title")


@R.add("citation_panel", f"WITH {MART}, p AS (SELECT dst, count(DISTINCT title) AS works, sum(cite_count)::BIGINT AS mentions FROM mart WHERE src = {_TOP} GROUP BY dst), b AS (SELECT name, min(birth_year) AS birth_year FROM canonical_authors GROUP BY 1) SELECT dst, works, mentions, birth_year, row_number() OVER (ORDER BY birth_year ASC NULLS LAST, dst)::INT AS pos FROM p LEFT JOIN b ON b.name = dst")
def citation_panel(spark, d):
    m = kept(mart(spark, d))
    p = m.join(F.broadcast(busiest(G.author_links(m))), F.col("src") == F.col("who")).groupBy("dst").agg(F.countDistinct("title").alias("works"), F.sum("cite_count").alias("mentions"))
    b = table(spark, d, "canonical_authors").groupBy("name").agg(F.min("birth_year").alias("birth_year"))
    # The panel of one author: its rows are the feature, so one sorted window is enough.
    return p.join(b, p["dst"] == b["name"], "left").select("dst", "works", "mentions", "birth_year").withColumn("pos", F.row_number().over(W.orderBy(F.asc_nulls_last("birth_year"), "dst")))


_SEARCH = "CASE WHEN lower(name) = 'mary' THEN 100 WHEN starts_with(lower(name), 'mary') THEN 80 WHEN contains(lower(name), 'mary') THEN 60 WHEN len(list_filter(titles, lambda t: contains(lower(t), 'mary'))) > 0 THEN 40 END"


@R.add("viewer_search", f"WITH {MART}, n AS (SELECT dst AS name, list(DISTINCT title) AS titles FROM mart GROUP BY 1) SELECT name, {_SEARCH} AS score FROM n WHERE ({_SEARCH}) IS NOT NULL")
def viewer_search(spark, d):
    titles = mart(spark, d).select("dst", "title").distinct().groupBy(F.col("dst").alias("name")).agg(F.collect_list("title").alias("titles"))
    return G.viewer_search(titles, "mary")


@R.add("source_book_map", "SELECT trim(regexp_replace(lower(title), '[^a-z0-9]+', '_', 'g'), '_') AS slug, max(source_book_id) AS book FROM source_books WHERE title IS NOT NULL GROUP BY 1")
def source_book_map(spark, d):
    return G.source_book_map(table(spark, d, "source_books").select("title", F.col("source_book_id").alias("book"), F.col("source_book_id").alias("ord")))


_CIRCLES = "SELECT book_id AS cid, book_id AS ord, (book_id % 1000)::DOUBLE AS x, (book_id // 1000 % 1000)::DOUBLE AS y, (3 + book_id % 5)::DOUBLE AS r FROM books"


@R.add("hit_test", f"WITH {BOOKS}, c AS ({_CIRCLES}), p AS (SELECT cit_id AS pid, (cit_id % 997)::DOUBLE AS px, (cit_id * 7 % 211)::DOUBLE AS py FROM citations GROUP BY cit_id) SELECT pid, arg_max(cid, ord) AS cid FROM p JOIN c ON (px - x) * (px - x) + (py - y) * (py - y) <= r * r GROUP BY pid")
def hit_test(spark, d):
    b = F.col("book_id")
    c = books(spark, d, "work_id").select(b.alias("cid"), b.alias("ord"), (b % 1000).cast("double").alias("x"), (F.floor(b / 1000) % 1000).cast("double").alias("y"), (3 + b % 5).cast("double").alias("r"))
    p = table(spark, d, "citations").select(F.col("cit_id").alias("pid")).distinct().select("pid", (F.col("pid") % 997).cast("double").alias("x"), (F.col("pid") * 7 % 211).cast("double").alias("y"))
    return G.hit_test(c, p, cell=10.0)


@R.add("author_mean_years", f"WITH {BOOKS} SELECT author_id, round(avg(publication_year), 6) AS mean_year, count(*) AS n FROM books WHERE author_id IS NOT NULL AND publication_year <> 0 GROUP BY 1")
def author_mean_years(spark, d):
    return books(spark, d, "authors", "publication_year").where("author_id IS NOT NULL AND publication_year <> 0").groupBy("author_id").agg(F.round(F.avg("publication_year"), 6).alias("mean_year"), F.count("*").alias("n"))


@R.add("dataset_slugs", "SELECT source_book_id, trim(regexp_replace(lower(title), '[^a-z0-9]+', '_', 'g'), '_') AS slug FROM source_books")
def dataset_slugs(spark, d):
    return table(spark, d, "source_books").select("source_book_id", slug(F.col("title")).alias("slug"))


@R.add("cover_paths", "SELECT source_book_id || '/' || unnest(authors) AS cover FROM source_books")
def cover_paths(spark, d):
    """Paths of what a registry lists under each dataset (the authors stand in for covers)."""
    return G.cover_paths(table(spark, d, "source_books").select(F.col("source_book_id").alias("path"), F.col("authors").alias("covers")))
