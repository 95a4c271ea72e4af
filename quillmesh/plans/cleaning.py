"""Queries of flattening, cleaning, merging, validation and resumption."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import author_key
from ..operators import dedup as DD
from ..operators import enrich as E
from ..operators import preprocess as P
from ..operators.tables import kept
from .functions import SQ, _article, _fold, _main, _viewer
from .registry import BOOKS, CITATIONS, RAW, Registry, books, citations, raw_rows, table

R = Registry()

# Extraction rows as working citations.
FLAT = rf"""{RAW}, flat AS (
  SELECT source_book_id AS grp, raw_id AS ord, trim(coalesce(title, ''), ' ') AS title, trim(author, ' ') AS author,
    CASE WHEN coalesce(citation_excerpt, '') <> '' THEN [citation_excerpt] ELSE []::VARCHAR[] END AS contexts,
    CASE WHEN coalesce(commentary, '') <> '' THEN [commentary] ELSE []::VARCHAR[] END AS commentaries, 1 AS cite_count
  FROM raw WHERE trim(author, ' ') <> '')"""
_EXACT_KEY = f"grp, {_fold('title')}, {_fold('author')}"


def _flat(spark, d):
    return P.flatten(raw_rows(spark, d))


def _show(df):
    """Comparable form: arrays as joined text."""
    j = lambda c: F.array_join(c, " ~ ").alias(c)
    return df.select(F.col("group").alias("source"), "ord", "title", "author", "cite_count", j("contexts"), j("commentaries"))


def _united(src: str, key: str) -> str:
    """SQL of the ordered-distinct union of the arrays per key."""
    part = lambda c: f"""{c}_e AS (SELECT k, v, min(spot) AS spot FROM (SELECT k, ord * 1000 + p AS spot, v FROM (SELECT k, ord, unnest({c}) AS v, unnest(range(len({c}))) AS p FROM keyed)) GROUP BY k, v),
  {c}_u AS (SELECT k, string_agg(v, ' ~ ' ORDER BY spot) AS {c} FROM {c}_e GROUP BY k)"""  # noqa: E731
    return f"""keyed AS (SELECT *, concat_ws('|', {key}) AS k FROM {src}), {part('contexts')}, {part('commentaries')},
  head AS (SELECT k, min(ord) AS ord, sum(cite_count)::BIGINT AS cite_count, arg_min(title, ord) AS title, arg_min(author, ord) AS author, arg_min(grp, ord) AS source FROM keyed GROUP BY k)"""


_MERGED = "SELECT source, ord, title, author, cite_count, coalesce(contexts, '') AS contexts, coalesce(commentaries, '') AS commentaries FROM head LEFT JOIN contexts_u USING (k) LEFT JOIN commentaries_u USING (k)"


@R.add("citation_flatten", f"WITH {FLAT} SELECT grp AS source, ord, title, author, cite_count::BIGINT AS cite_count, array_to_string(contexts, ' ~ ') AS contexts, array_to_string(commentaries, ' ~ ') AS commentaries FROM flat")
def citation_flatten(spark, d):
    return _show(_flat(spark, d))


@R.add("exact_dedup", f"WITH {FLAT}, {_united('flat', _EXACT_KEY)} {_MERGED}")
def exact_dedup(spark, d):
    return _show(P.exact_dedup(_flat(spark, d)))


_VKEY = f"grp, {_fold(SQ.format('author'))}, CASE WHEN {_main} <> '' THEN {_main} ELSE {_fold('title')} END"


@R.add("variant_title_collapse", f"WITH {FLAT}, {_united('flat', _VKEY)} {_MERGED}")
def variant_title_collapse(spark, d):
    return _show(P.collapse_variant_titles(_flat(spark, d)))


@R.add("author_only_collapse", f"""WITH {FLAT}, lone AS (SELECT * FROM flat WHERE trim(title, ' ') = ''), {_united('lone', f"grp, {_fold('author')}")}
{_MERGED} UNION ALL SELECT grp, ord, title, author, cite_count::BIGINT, array_to_string(contexts, ' ~ '), array_to_string(commentaries, ' ~ ') FROM flat WHERE trim(title, ' ') <> ''""")
def author_only_collapse(spark, d):
    return _show(P.collapse_author_only(_flat(spark, d)))


_LISTED = ", ".join("'" + a.replace("'", "''") + "'" for a in P.NOT_PERSONS)
_NOBODY = rf"""lower(trim(author, ' ')) IN ({_LISTED})
  OR (len(regexp_split_to_array(trim(author, ' '), '\s+')) = 1 AND author = upper(author) AND author <> lower(author)) OR length(trim(author, ' ')) <= 2
  OR regexp_matches(lower(trim(author, ' ')), '\bet\s+al\.?\s*$')
  OR (NOT (len(regexp_split_to_array(trim(author, ' '), '\s+')) >= 2 AND NOT starts_with(lower(trim(author, ' ')), 'the ')) AND regexp_matches(lower(trim(author, ' ')), '{P.GROUP_NOUN}'))"""


@R.add("non_person_filter", f"WITH {FLAT} SELECT ord, author FROM flat WHERE NOT ({_NOBODY})")
def non_person_filter(spark, d):
    return P.drop_non_persons(_flat(spark, d)).select("ord", "author")


_ALIAS = "SELECT lower(variant) AS v, min(canonical) AS c FROM (SELECT name AS canonical, unnest([split_part(name, ' ', -1), substr(name, 1, 1) || '. ' || split_part(name, ' ', -1)]) AS variant FROM canonical_authors) GROUP BY 1"


def _aliases(spark, d):
    last = F.element_at(F.split("name", " "), -1)
    return table(spark, d, "canonical_authors").select(
        F.col("name").alias("canonical"), F.explode(F.array(last, F.concat(F.substring("name", 1, 1), F.lit(". "), last))).alias("variant_lower")
    ).withColumn("variant_lower", F.lower("variant_lower"))


@R.add("alias_canonicalise", f"WITH {FLAT}, al AS ({_ALIAS}) SELECT ord, coalesce(CASE WHEN c <> author THEN c END, author) AS author, CASE WHEN c <> author THEN c END AS canonical_author FROM flat LEFT JOIN al ON lower(trim(author, ' ')) = v")
def alias_canonicalise(spark, d):
    return P.canonicalise(_flat(spark, d), _aliases(spark, d)).select("ord", "author", "canonical_author")


_NT = lambda c: _fold(SQ.format(c))


@R.add("self_reference_drop", f"""WITH {FLAT}, s AS (SELECT source_book_id AS grp, {_NT('title')} AS st, list_transform(authors, lambda a: {_NT('a')}) AS sa FROM source_books)
SELECT f.ord FROM flat f LEFT JOIN s USING (grp) WHERE NOT (coalesce(list_contains(sa, {_NT('author')}), false) AND (coalesce({_NT('title')} = st AND st <> '', false) OR trim(title, ' ') = ''))""")
def self_reference_drop(spark, d):
    src = table(spark, d, "source_books").select(F.col("source_book_id").alias("group"), F.col("title").alias("source_title"), F.col("authors").alias("source_authors"))
    return P.drop_self_references(_flat(spark, d), src).select("ord")


@R.add("fuzzy_cluster")
def fuzzy_cluster(spark, d):
    df = kept(_flat(spark, d))
    for step in (P.exact_dedup, P.collapse_variant_titles):
        df = kept(step(df))
    return P.fuzzy_merge(df).select(F.col("group").alias("source"), "ord", "title", "author", "cite_count")


@R.add("preprocess_chain")
def preprocess_chain(spark, d):
    src = table(spark, d, "source_books").select(F.col("source_book_id").alias("group"), F.col("title").alias("source_title"), F.col("authors").alias("source_authors"))
    return P.preprocess(_flat(spark, d), _aliases(spark, d), src).select(F.col("group").alias("source"), "ord", "title", "author", "canonical_author", "cite_count")


# -- validation -----------------------------------------------------------------

_DECIDED = "CASE ord % 5 WHEN 0 THEN 'remove' WHEN 1 THEN 'fix' ELSE 'keep' END"


def _decisions(df):
    s = F.when(F.col("ord") % 5 == 0, "remove").when(F.col("ord") % 5 == 1, "fix").otherwise("keep")
    return df.select(F.col("ord").alias("cit"), "ord", s.alias("status"), F.when(F.col("ord") % 2 == 0, F.upper("author")).alias("fixed_author"), F.lit("").alias("fixed_title"))


@R.add("validation_apply", f"WITH {CITATIONS} SELECT ord, CASE WHEN ord % 5 = 1 AND ord % 2 = 0 THEN coalesce(nullif(trim(upper(author), ' '), ''), author) ELSE author END AS author, title, ord % 5 = 1 AS fixed FROM cites WHERE ord % 5 <> 0")
def validation_apply(spark, d):
    c = citations(spark, d)
    return E.apply_decisions(c.withColumn("cit", F.col("ord")), _decisions(c), ["cit"]).select("ord", "author", "title", "fixed")


@R.add("validation_stats", f"""WITH {CITATIONS} SELECT grp AS source, count(*) AS total, count(*) FILTER ({_DECIDED} = 'keep') AS kept, count(*) FILTER ({_DECIDED} = 'fix') AS fixed, count(*) FILTER ({_DECIDED} = 'remove') AS removed,
  floor(100 * count(*) FILTER ({_DECIDED} = 'keep') / greatest(1, count(*)))::BIGINT AS kept_pct FROM cites GROUP BY grp""")
def validation_stats(spark, d):
    c = citations(spark, d)
    s = c.join(_decisions(c).select("cit", "status"), c["ord"] == F.col("cit"))
    n = lambda v: F.count_if(F.col("status") == v)
    return s.groupBy(F.col("group").alias("source")).agg(F.count("*").alias("total"), n("keep").alias("kept"), n("fix").alias("fixed"), n("remove").alias("removed"), F.floor(100 * n("keep") / F.greatest(F.lit(1), F.count("*"))).alias("kept_pct"))


@R.add("validation_batches", f"WITH {CITATIONS} SELECT ord, floor((rn - 1) / 30)::INT AS batch, ((rn - 1) % 30)::INT AS index FROM (SELECT ord, row_number() OVER (PARTITION BY grp ORDER BY ord) AS rn FROM cites)")
def validation_batches(spark, d):
    return E.batch_numbers(citations(spark, d), "group", "ord").select("ord", "batch", "index")


@R.add("checkpoint_resume", f"WITH {CITATIONS}, done AS (SELECT DISTINCT author, title FROM cites WHERE ord % 3 = 0) SELECT ord FROM cites c WHERE NOT EXISTS (SELECT 1 FROM done d WHERE d.author IS NOT DISTINCT FROM c.author AND d.title IS NOT DISTINCT FROM c.title)")
def checkpoint_resume(spark, d):
    c = citations(spark, d).select("ord", "author", "title")
    return E.resume(c, c.where("ord % 3 = 0")).select("ord")


@R.add("author_cache", rf"""WITH {CITATIONS}, r AS (SELECT ord, title, lower(trim(author, ' ')) AS k FROM cites WHERE trim(author, ' ') <> ''),
  e AS (SELECT DISTINCT ord, title, unnest([k, regexp_split_to_array(k, '\s+')[-1]]) AS key FROM r) SELECT key, arg_max(title, ord) AS value FROM e GROUP BY key""")
def author_cache(spark, d):
    return E.author_cache(citations(spark, d).select("ord", "author", F.col("title").alias("value")))


# -- de-duplication of resolved citations --------------------------------------------

# A citation resolved to the catalogue record of its very title, the earliest id.
RESOLVED = f"""{CITATIONS}, {BOOKS}, best AS (SELECT title, min(book_id) AS book_id FROM books WHERE title IS NOT NULL GROUP BY title),
resolved AS (SELECT c.*, coalesce(b.book_id::VARCHAR, 'web_' || c.ord) AS book_id, k.work_id FROM cites c LEFT JOIN best b ON c.title = b.title LEFT JOIN books k ON k.book_id = b.book_id)"""


def resolved(spark, d, texts=False):
    b = books(spark, d, "work_id", "title")
    best = b.where("title IS NOT NULL").groupBy(F.col("title").alias("bt")).agg(F.min("book_id").alias("bid"))
    c = citations(spark, d, texts)
    return c.join(best, c["title"] == best["bt"], "left").join(b.select(F.col("book_id").alias("kb"), "work_id"), F.col("bid") == F.col("kb"), "left").select(
        *c.columns, F.coalesce(F.col("bid").cast("string"), F.concat(F.lit("web_"), F.col("ord").cast("string"))).alias("book_id"), "work_id"
    )


def _merge_sql(key: str, scoped: bool = True, src: str = "resolved") -> str:
    """Rows after merging, without their texts."""
    k = f"CASE WHEN {key} IS NOT NULL THEN grp || '|' || {key} END" if scoped else key
    return f"""keyed AS (SELECT *, {k} AS k FROM {src}), st AS (
  SELECT k, count(*) AS n, sum(cite_count)::BIGINT AS s, arg_max(ord, {{'a': (NOT starts_with(book_id, 'web_'))::INT, 'b': cite_count, 'c': -ord}}) AS keep FROM keyed WHERE k IS NOT NULL
  GROUP BY k HAVING count(*) >= 2 AND count(DISTINCT book_id) + max((book_id IS NULL)::INT) >= 2)
SELECT ord, book_id, CASE WHEN st.k IS NULL THEN cite_count ELSE s END AS cite_count, coalesce(n, 1) AS merged FROM keyed LEFT JOIN st USING (k) WHERE st.k IS NULL OR ord = keep"""


def _merge_steps(key: str, src: str, p: str) -> str:
    """CTEs ending in ``{p}out``: the merged rows with all columns, their contexts and commentaries united, and ``merged``."""
    part = lambda c: f"""{p}{c}_e AS (SELECT k, v, min(spot) AS spot FROM (SELECT k, (ord <> keep)::BIGINT * 1000000000000000 + ord * 1000 + unnest(range(len({c}))) AS spot, unnest({c}) AS v FROM {p}keyed JOIN {p}st USING (k)) GROUP BY k, v),
  {p}{c}_u AS (SELECT k, list(v ORDER BY spot) AS {c}_u FROM {p}{c}_e GROUP BY k)"""  # noqa: E731
    return f"""{p}keyed AS (SELECT *, CASE WHEN {key} IS NOT NULL THEN grp || '|' || {key} END AS k FROM {src}), {p}st AS (
  SELECT k, count(*) AS n, sum(cite_count)::BIGINT AS s, arg_max(ord, {{'a': (NOT starts_with(book_id, 'web_'))::INT, 'b': cite_count, 'c': -ord}}) AS keep FROM {p}keyed WHERE k IS NOT NULL
  GROUP BY k HAVING count(*) >= 2 AND count(DISTINCT book_id) + max((book_id IS NULL)::INT) >= 2), {part('contexts')}, {part('commentaries')},
{p}out AS (SELECT grp, ord, title, author, canonical_author, book_id, work_id, CASE WHEN {p}st.k IS NULL THEN cite_count ELSE s END AS cite_count, coalesce(n, 1) AS merged,
  CASE WHEN {p}st.k IS NULL THEN contexts ELSE coalesce(contexts_u, []) END AS contexts, CASE WHEN {p}st.k IS NULL THEN commentaries ELSE coalesce(commentaries_u, []) END AS commentaries
  FROM {p}keyed LEFT JOIN {p}st USING (k) LEFT JOIN {p}contexts_u USING (k) LEFT JOIN {p}commentaries_u USING (k) WHERE {p}st.k IS NULL OR ord = keep)"""


_TEXTS = "array_to_string(contexts, ' ~ ') AS contexts, array_to_string(commentaries, ' ~ ') AS commentaries"
_SHOWN = f"SELECT ord, book_id, cite_count, merged, {_TEXTS} FROM "


def _shown(df):
    return df.select("ord", "book_id", "cite_count", "merged", F.array_join("contexts", " ~ ").alias("contexts"), F.array_join("commentaries", " ~ ").alias("commentaries"))


_WORK = "nullif(work_id, '')"
_AK = f"regexp_replace(regexp_replace({SQ.format('regexp_replace(lower(strip_accents(%s)), %s, %s, %s)')} , '^st ', ''), '^saint ', '')"
_WHO = _AK % ("coalesce(nullif(canonical_author, ''), nullif(author, ''), '?')", "'[.,]'", "''", "'g'")
_AT = f"CASE WHEN {_article('title')} <> '' THEN {_WHO} || '|' || {_article('title')} END"
_RT = f"CASE WHEN {_article('title')} <> '' THEN concat_ws('|', lower(trim(author, ' ')), {_article('title')}) END"


@R.add("dedup_work_id", f"WITH {RESOLVED}, {_merge_steps(_WORK, 'resolved', 'a_')} {_SHOWN} a_out")
def dedup_work_id(spark, d):
    return _shown(DD.dedup_by_work(resolved(spark, d, texts=True), scope="group"))


@R.add("dedup_author_title", f"WITH {RESOLVED}, {_merge_steps(_AT, 'resolved', 'a_')} {_SHOWN} a_out")
def dedup_author_title(spark, d):
    return _shown(DD.dedup_by_author_title(resolved(spark, d, texts=True), scope="group"))


@R.add("retro_dedup", f"WITH {RESOLVED}, {_merge_steps(_RT, 'resolved', 'a_')} {_SHOWN} a_out")
def retro_dedup(spark, d):
    return _shown(DD.retro_dedup(resolved(spark, d, texts=True), scope="group"))


@R.add("dedup_two_passes", f"WITH {RESOLVED}, {_merge_steps(_WORK, 'resolved', 'a_')}, {_merge_steps(_AT, 'a_out', 'b_')} {_SHOWN} b_out")
def dedup_two_passes(spark, d):
    once_ = DD.dedup_by_work(resolved(spark, d, texts=True), scope="group").drop("merged")
    return _shown(DD.dedup_by_author_title(once_, scope="group"))


_K0 = lambda c: SQ.format(f"regexp_replace(lower(strip_accents({c})), '[.,]', '', 'g')")
_TYPED = "t AS (SELECT *, CASE WHEN work_id IS NOT NULL THEN 'book' WHEN title = '' THEN 'author' ELSE 'not_found' END AS match_type FROM resolved WHERE author IS NOT NULL)"


def _cleanup_sql(src: str) -> str:
    part = lambda c: f"""{c}_e AS (SELECT a, t, v, min(spot) AS spot FROM (SELECT a, t, r::BIGINT * 1000000000000000 + ord * 1000 + unnest(range(len({c}))) AS spot, unnest({c}) AS v FROM ranked) GROUP BY a, t, v),
  {c}_u AS (SELECT a, t, string_agg(v, ' ~ ' ORDER BY spot) AS {c} FROM {c}_e GROUP BY a, t)"""  # noqa: E731
    return f"""ranked AS (SELECT *, {_K0('author')} AS a, {_K0('title')} AS t, CASE match_type WHEN 'book' THEN 1 WHEN 'author' THEN 2 ELSE 4 END AS r FROM {src}),
g AS (SELECT a, t, arg_min({{'author': author, 'title': title, 'm': match_type}}, {{'r': r, 'o': ord}}) AS b,
  sum(cite_count)::BIGINT AS cite_count, count(*) AS merged, list_sort(list(DISTINCT title) FILTER (title <> '')) AS titles FROM ranked GROUP BY 1, 2), {part('contexts')}, {part('commentaries')}
SELECT b.author AS author, b.title AS title, b.m AS match_type, cite_count, merged, CASE WHEN len(titles) > 1 THEN array_to_string(list_filter(titles, lambda x: x <> b.title), ' | ') ELSE '' END AS other_titles,
  coalesce(contexts, '') AS contexts, coalesce(commentaries, '') AS commentaries FROM g LEFT JOIN contexts_u USING (a, t) LEFT JOIN commentaries_u USING (a, t)"""


def _cleaned(df):
    j = lambda c, sep=" ~ ": F.array_join(c, sep).alias(c)
    return DD.cleanup_merge(df).select("author", "title", "match_type", "cite_count", "merged", j("other_titles", " | "), j("contexts"), j("commentaries"))


def _typed(spark, d):
    return resolved(spark, d, texts=True).where("author IS NOT NULL").withColumn("match_type", F.when(F.col("work_id").isNotNull(), "book").when(F.col("title") == "", "author").otherwise("not_found"))


@R.add("cleanup_merge", f"WITH {RESOLVED}, {_TYPED}, {_cleanup_sql('t')}")
def cleanup_merge(spark, d):
    return _cleaned(_typed(spark, d))


# Clean-up maps made from the list: initials to full names, ampersands spelt out, one entry misattributed, one removed.
_FIXES = "fixes AS (SELECT lower(substr(name, 1, 1) || '. ' || split_part(name, ' ', -1)) AS v, min(name) AS c FROM canonical_authors GROUP BY 1), wrong AS (SELECT lower(split_part(name, ' ', -1)) AS ma, 'the' AS mt, 'Somebody Else' AS fa FROM canonical_authors WHERE author_id = 1), gone AS (SELECT lower(name) AS g FROM canonical_authors WHERE author_id = 2)"
_ACTED = f"""acted AS (SELECT t.* EXCLUDE (author), coalesce(fa, c, trim(author, ' ')) AS author, CASE WHEN g IS NOT NULL OR trim(author, ' ') = '' THEN 'removed' WHEN fa IS NOT NULL THEN 'misattributed' WHEN coalesce(c, trim(author, ' ')) <> author THEN 'renamed' ELSE 'kept' END AS action
  FROM t LEFT JOIN gone ON g = lower(trim(author, ' ')) LEFT JOIN fixes ON v = lower(trim(author, ' ')) LEFT JOIN wrong ON contains(lower(trim(author, ' ')), ma) AND contains(lower(title), mt))"""


def _maps(spark, d):
    a = table(spark, d, "canonical_authors")
    last = F.element_at(F.split("name", " "), -1)
    fixes = a.select(F.concat(F.substring("name", 1, 1), F.lit(". "), last).alias("variant"), F.col("name").alias("canonical"))
    titles = a.limit(0).select(F.col("name").alias("typed"), F.col("name").alias("right"))
    wrong = a.where("author_id = 1").select(F.lower(last).alias("match_author"), F.lit("the").alias("match_title"), F.lit("Somebody Else").alias("fix_author"), F.lit(False).alias("remove"))
    return fixes, titles, wrong, a.where("author_id = 2").select("name")


@R.add("up_cleanup", f"WITH {RESOLVED}, {_TYPED}, {_FIXES}, {_ACTED}, s AS (SELECT * FROM acted WHERE action <> 'removed'), {_cleanup_sql('s')}")
def up_cleanup(spark, d):
    acted = DD.clean_up(_typed(spark, d), *_maps(spark, d))
    return _cleaned(acted.where("action <> 'removed'"))


@R.add("up_cleanup_stats", f"WITH {RESOLVED}, {_TYPED}, {_FIXES}, {_ACTED} SELECT action, count(*) AS n FROM acted GROUP BY 1")
def up_cleanup_stats(spark, d):
    return DD.clean_up(_typed(spark, d), *_maps(spark, d)).groupBy("action").agg(F.count("*").alias("n"))


_VT = _viewer("title")


_META = ("title", "title_without_series", "authors", "publication_year", "publication_month", "publication_day", "publisher", "num_pages", "book_format", "isbn", "isbn13", "average_rating", "ratings_count", "text_reviews_count", "description", "link", "catalog_source")
_RICH = " + ".join(f"({f} IS NOT NULL)::INT" for f in _META)


@R.add("book_redirects", f"""WITH {BOOKS}, k AS (SELECT author, book_id, coalesce('work:' || nullif(work_id, ''), 'title:' || {_VT}) AS k,
  {_RICH} AS rich FROM books WHERE author IS NOT NULL),
kept AS (SELECT author, k, arg_max(book_id, {{'r': rich, 'o': -book_id}}) AS kept_id FROM k WHERE k IS NOT NULL GROUP BY 1, 2)
SELECT k.author, k.book_id, kept_id FROM k JOIN kept USING (author, k) WHERE k.book_id <> kept_id""")
def book_redirects(spark, d):
    b = books(spark, d, "work_id", *_META).where("author IS NOT NULL")
    return DD.editions(b.select("author", "book_id", "work_id", "title", DD.richness(b, list(_META)).alias("richness"), F.col("book_id").alias("ord")))[1]


@R.add("author_key_groups", f"WITH {CITATIONS} SELECT {_AK % ('author', chr(39) + '[.,]' + chr(39), chr(39) * 2, chr(39) + 'g' + chr(39))} AS key, count(*) AS n, count(DISTINCT author) AS spellings FROM cites WHERE author IS NOT NULL GROUP BY 1")
def author_key_groups(spark, d):
    return citations(spark, d).where("author IS NOT NULL").groupBy(author_key(F.col("author")).alias("key")).agg(F.count("*").alias("n"), F.countDistinct("author").alias("spellings"))
