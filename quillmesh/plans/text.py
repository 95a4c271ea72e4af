"""Queries of sentences, chunks, prompts, search, resolution and enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import PipelineConfig
from ..functions.text import LEADING_ARTICLES, SUBTITLE_MARKS, author_key, contains_either, squeeze
from ..operators import chunking as C
from ..operators import enrich as E
from ..operators import resolve as S
from ..operators import search as X
from ..operators.tables import kept, scratch
from ..streaming import resume as ST
from .functions import PARTICLE_SQL, SQ, checked_sql
from .registry import BOOKS, CITATIONS, RAW, Registry, books, citations, raw_rows, table

R = Registry()

_SENT = r"list_filter(list_transform(string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda s: trim(s, ' ')), lambda s: s <> '')"


def _sents(spark, d):
    return table(spark, d, "documents").select(F.col("doc_id").alias("doc"), C.sentences(F.col("text")).alias("sentences"))


@R.add("sentences", f"SELECT doc_id AS doc, len(s) AS n, array_to_string(s, ' # ') AS joined FROM (SELECT doc_id, {_SENT} AS s FROM documents)")
def sentences(spark, d):
    return _sents(spark, d).select("doc", F.size("sentences").cast("bigint").alias("n"), F.array_join("sentences", " # ").alias("joined"))


@R.add("chunk_by_count", f"SELECT doc, i::INT AS chunk_index, (i * 5 + 1)::INT AS start_sentence, least((i + 1) * 5, n)::INT AS end_sentence FROM (SELECT doc, n, unnest(range((n - 1) // 5 + 1)) AS i FROM (SELECT doc_id AS doc, len({_SENT}) AS n FROM documents) WHERE n > 0)")
def chunk_by_count(spark, d):
    return C.chunk_by_count(_sents(spark, d), 5)


@R.add("chunk_by_budget")
def chunk_by_budget(spark, d):
    return C.chunk_by_budget(_sents(spark, d), PipelineConfig(chunk_size=8, max_context=160, max_completion=60))


@R.add("extract_mentions")
def extract_mentions(spark, d):
    s = _sents(spark, d)
    return C.extract(C.excerpts(s, C.chunk_by_count(s, 5))).where("status = 'ok'").select("doc", "chunk_index", "title", "author", "citation_excerpt")


@R.add("prompt_render", f"WITH {RAW} SELECT raw_id, replace(replace('Book: {{{{book_title}}}}' || chr(10) || '{{{{sentences_block}}}}', '{{{{book_title}}}}', coalesce(title, '<not provided>')), '{{{{sentences_block}}}}', coalesce(citation_excerpt, '')) AS prompt FROM raw")
def prompt_render(spark, d):
    return raw_rows(spark, d).select("raw_id", C.render("Book: {{book_title}}\n{{sentences_block}}", book_title=F.coalesce("title", F.lit("<not provided>")), sentences_block=F.coalesce("citation_excerpt", F.lit(""))).alias("prompt"))


_JS = lambda c: f"CASE WHEN {c} IS NULL THEN 'null' ELSE '\"' || replace(replace(replace(replace(replace({c}, '\\', '\\\\'), '\"', '\\\"'), chr(10), '\\n'), chr(9), '\\t'), chr(13), '\\r') || '\"' END"


@R.add("prompt_json", f"WITH {CITATIONS} SELECT ord, '{{\"index\":' || ord || ',\"author\":' || {_JS('author')} || ',\"title\":' || {_JS('title')} || ',\"count\":' || cite_count || '}}' AS line FROM cites")
def prompt_json(spark, d):
    """One line per citation."""
    line = F.struct(F.col("ord").alias("index"), "author", "title", F.col("cite_count").alias("count"))
    return citations(spark, d).select("ord", F.to_json(line, {"ignoreNullFields": "false"}).alias("line"))


@R.add("debug_chunks", f"SELECT doc, i::INT AS chunk_index FROM (SELECT doc, unnest(range((n - 1) // 5 + 1)) AS i FROM (SELECT doc_id AS doc, len({_SENT}) AS n FROM documents) WHERE n > 0) WHERE i < 2")
def debug_chunks(spark, d):
    """The first two chunks of every document, as a trial run takes them."""
    return C.chunk_by_count(_sents(spark, d), 5).where("chunk_index < 2").select("doc", "chunk_index")


@R.add("prompt_tokens", f"SELECT doc_id AS doc, (length(p) // 4 + 1)::INT AS tokens FROM (SELECT doc_id, 'Find citations.' || chr(10) || 'Book: ' || coalesce(source, '') || chr(10) || array_to_string(list_transform({_SENT}, lambda x: {SQ.format('x')}), chr(10)) AS p FROM documents)")
def prompt_tokens(spark, d):
    """Tokens of the whole prompt, system text and frame included, by the four-letters rule."""
    docs = table(spark, d, "documents").select("doc_id", "source", C.sentences(F.col("text")).alias("s"))
    prompt = C.render("Find citations.\nBook: {{book_title}}\n{{sentences_block}}", book_title=F.coalesce("source", F.lit("")), sentences_block=F.array_join(F.transform("s", squeeze), "\n"))
    return docs.select(F.col("doc_id").alias("doc"), C.prompt_tokens(prompt).alias("tokens"))


# -- search ------------------------------------------------------------------------

_TOK = lambda c: rf"list_filter(regexp_split_to_array(lower(strip_accents({c})), '[^\p{{L}}\p{{N}}]+'), lambda t: t <> '')"
# Queries are the titles as cited, documents the catalogue's titles.
_QD = f"""{CITATIONS}, {BOOKS}, q AS (SELECT min(ord) AS q, title AS qt FROM cites WHERE title <> '' GROUP BY title),
qt AS (SELECT q, ' ' || array_to_string({_TOK('qt')}, ' ') || ' ' AS ql FROM q WHERE len({_TOK('qt')}) > 0), bt AS (SELECT book_id, ' ' || array_to_string({_TOK('title')}, ' ') || ' ' AS bl FROM books WHERE title IS NOT NULL),
hits AS (SELECT q, book_id AS doc FROM qt JOIN bt ON contains(bl, ql))"""


def _search_sides(spark, d):
    q = citations(spark, d).where("title <> ''").groupBy("title").agg(F.min("ord").alias("item_id"))
    return q, books(spark, d, "title").where("title IS NOT NULL").select("book_id", F.col("title").alias("b_title"))


@R.add("phrase_search", f"WITH {_QD} SELECT q, doc FROM hits")
def phrase_search(spark, d):
    q, b = _search_sides(spark, d)
    return X.phrase_hits(q, b, "item_id", "title", "book_id", "b_title")


@R.add("phrase_search_fallback", f"""WITH {_QD}, rest AS (SELECT * FROM q WHERE q NOT IN (SELECT q FROM hits)), w AS (SELECT DISTINCT q, unnest({_TOK('qt')}) AS t FROM rest), n AS (SELECT q, count(*) AS need FROM w WHERE length(t) >= 2 GROUP BY q),
b AS (SELECT DISTINCT book_id, unnest({_TOK('title')}) AS t FROM books WHERE title IS NOT NULL), h AS (SELECT q, book_id, count(*) AS have FROM w JOIN b USING (t) WHERE length(t) >= 2 GROUP BY 1, 2)
SELECT q, book_id AS doc FROM h JOIN n USING (q) WHERE have = need""")
def phrase_search_fallback(spark, d):
    q, b = map(kept, _search_sides(spark, d))
    hit = X.phrase_hits(q, b, "item_id", "title", "book_id", "b_title").select("q").distinct()
    rest = q.join(hit, q["item_id"] == hit["q"], "left_anti")
    return X.all_words_hits(rest, b, "item_id", "title", "book_id", "b_title")


# BM25 ranks for the held-out titles, a fixed set of queries.
_EQ = f"{BOOKS}, q AS (SELECT item_id AS q, title AS qt FROM eval_items WHERE title IS NOT NULL)"


@R.add("bm25_rank", f"""WITH {_EQ}, tf AS (SELECT doc, t, count(*) AS tf FROM (SELECT book_id AS doc, unnest({_TOK('title')}) AS t FROM books WHERE title IS NOT NULL) GROUP BY 1, 2),
dl AS (SELECT doc, sum(tf) AS dl FROM tf GROUP BY 1), n AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM dl), df AS (SELECT t, count(*) AS df FROM tf GROUP BY 1), w AS (SELECT DISTINCT q, unnest({_TOK('qt')}) AS t FROM q),
s AS (SELECT q, doc, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl))), 6) AS score FROM w JOIN tf USING (t) JOIN df USING (t) JOIN dl USING (doc), n GROUP BY 1, 2)
SELECT q, doc, score, rank::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc) AS rank FROM s) WHERE rank <= 5""")
def bm25_rank(spark, d):
    q = table(spark, d, "eval_items").where("title IS NOT NULL").select("item_id", "title")
    b = books(spark, d, "title").where("title IS NOT NULL").select("book_id", F.col("title").alias("b_title"))
    s = X.bm25(q, b, "item_id", "title", "book_id", "b_title").withColumn("score", F.round("score", 6))
    return X.top_k(s, 5)


_NAMES = "SELECT author_id AS ord, name FROM canonical_authors"


@R.add("author_substring_lookup", f"WITH q AS (SELECT DISTINCT split_part(name, ' ', -1) AS q FROM canonical_authors UNION SELECT DISTINCT substr(name, 1, 2) FROM canonical_authors), n AS ({_NAMES}) SELECT q, name, rank::INT AS rank FROM (SELECT q, name, row_number() OVER (PARTITION BY q ORDER BY ord) AS rank FROM q JOIN n ON contains(lower(name), lower(trim(q, ' '))) WHERE trim(q, ' ') <> '') WHERE rank <= 5")
def author_substring_lookup(spark, d):
    n = table(spark, d, "canonical_authors").select(F.col("author_id").alias("ord"), "name")
    q = n.select(F.element_at(F.split("name", " "), -1).alias("q")).unionByName(n.select(F.substring("name", 1, 2).alias("q"))).distinct()
    return X.substring_lookup(q, n)


@R.add("people_lookup_rerank", rf"""WITH q AS (SELECT DISTINCT split_part(name, ' ', -1) AS q FROM canonical_authors), h AS (SELECT q, name AS title, author_id AS page_id FROM q JOIN canonical_authors c ON contains(' ' || array_to_string({_TOK('c.name')}, ' ') || ' ', ' ' || array_to_string({_TOK('q')}, ' ') || ' '))
SELECT q, title, page_id, rank::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY (lower(q) = lower(title))::INT DESC, page_id) AS rank FROM h) WHERE rank <= 3""")
def people_lookup_rerank(spark, d):
    n = table(spark, d, "canonical_authors").select("author_id", "name")
    q = n.select(F.element_at(F.split("name", " "), -1).alias("q")).distinct()
    h = X.phrase_hits(q, n, "q", "q", "author_id", "name").join(n.select(F.col("author_id").alias("doc"), F.col("name").alias("title")), "doc").withColumnRenamed("doc", "page_id")
    return X.person_rerank(h).where("rank <= 3").select("q", "title", "page_id", "rank")


def _eval_queries(spark, d):
    return table(spark, d, "eval_items").select(F.col("item_id").alias("q"), F.col("title").alias("q_title"), F.col("author").alias("q_author"))


def _shelf(spark, d):
    return books(spark, d, "title", "authors").select(F.col("book_id").alias("doc"), F.col("title").alias("d_title"), F.col("authors.name").alias("d_authors"))


_LINE = lambda c: f"' ' || array_to_string({c}, ' ') || ' '"
SHELF = f"shelf AS (SELECT book_id AS doc, {_LINE('dt')} AS dl, {_LINE('da')} AS al, len(dt) + len(da) AS len FROM (SELECT book_id, {_TOK("coalesce(title, '')")} AS dt, {_TOK("coalesce(array_to_string(list_transform(authors, lambda a: a.name), ' | '), '')")} AS da FROM books))"


def hits_sql(src: str, p: str, limit: int) -> str:
    """CTEs ending in ``{p}hits (q, doc, rank)``: the twin of :func:`record_hits` for ``src (q, q_title, q_author)``."""
    return f"""{p}q AS (SELECT q, trim(coalesce(q_title, ''), ' ') <> '' AS ht, trim(coalesce(q_author, ''), ' ') <> '' AS ha, {_TOK("coalesce(q_title, '')")} AS qt, {_TOK("coalesce(q_author, '')")} AS qa, regexp_split_to_array(trim(coalesce(q_author, ''), ' '), '\\s+') AS w FROM {src}),
{p}ok AS (SELECT * FROM {p}q WHERE (NOT ht OR len(qt) > 0) AND (ht OR ha)),
{p}f0 AS (SELECT q, doc, row_number() OVER (PARTITION BY q ORDER BY len, doc) AS rank FROM {p}ok JOIN shelf ON (NOT ht OR contains(dl, {_LINE('qt')})) AND (NOT ha OR contains(al, {_LINE('qa')})) WHERE NOT ha OR len(qa) > 0),
{p}ph AS (SELECT q, ht, qt, list_filter(list_transform(list_filter(w, lambda x: length(x) > 1), lambda x: ' ' || array_to_string({_TOK('x')}, ' ') || ' '), lambda x: trim(x) <> '') AS ps FROM {p}ok WHERE ha AND len(w) > 1 AND q NOT IN (SELECT q FROM {p}f0)),
{p}f1 AS (SELECT q, doc, row_number() OVER (PARTITION BY q ORDER BY len, doc) AS rank FROM {p}ph JOIN shelf ON (NOT ht OR contains(dl, {_LINE('qt')})) AND len(list_filter(ps, lambda x: NOT contains(al, x))) = 0 WHERE len(ps) > 0),
{p}hits AS (SELECT q, doc, rank::INT AS rank FROM (SELECT * FROM {p}f0 UNION ALL SELECT * FROM {p}f1) WHERE rank <= {limit})"""


_ITEMS = "items AS (SELECT item_id AS q, title AS q_title, author AS q_author FROM eval_items)"


@R.add("find_books", f"WITH {BOOKS}, {SHELF}, {_ITEMS}, {hits_sql('items', 'a_', 5)} SELECT q, doc, rank FROM a_hits")
def find_books(spark, d):
    """Records with the title phrase and the author phrase, else the words of the author, of each held-out item."""
    return X.record_hits(_eval_queries(spark, d), _shelf(spark, d), 5)


@R.add("lookup_books", f"""WITH {BOOKS}, {SHELF}, {_ITEMS}, one AS (SELECT q, q_title, NULL::VARCHAR AS q_author FROM items WHERE trim(coalesce(q_title, ''), ' ') <> ''), two AS (SELECT q, NULL::VARCHAR AS q_title, q_author FROM items WHERE trim(coalesce(q_author, ''), ' ') <> ''),
{hits_sql('one', 'a_', 20)}, {hits_sql('two', 'b_', 20)}, u AS (SELECT q, doc, min(spot) AS spot FROM (SELECT q, doc, rank AS spot FROM a_hits UNION ALL SELECT q, doc, 1000 + rank FROM b_hits) GROUP BY 1, 2)
SELECT q, doc, rank::INT AS rank FROM (SELECT q, doc, row_number() OVER (PARTITION BY q ORDER BY spot, doc) AS rank FROM u) WHERE rank <= 20""")
def lookup_books(spark, d):
    """As a tool call: title alone, then author alone, asked for 100 and capped."""
    return X.lookup_books(_eval_queries(spark, d), _shelf(spark, d), 100)


_PEOPLE = f"""pq AS (SELECT DISTINCT author AS q FROM eval_items WHERE author IS NOT NULL), ph AS (SELECT q, author_id AS page_id, name AS title, birth_year, death_year FROM pq JOIN canonical_authors c ON len({_TOK('q')}) > 0 AND contains({_LINE(_TOK('c.name'))}, {_LINE(_TOK('q'))})),
po AS (SELECT lower(name) AS t, birth_year + 1 AS ob, NULL::INT AS od FROM canonical_authors WHERE author_id % 3 = 0),
pr AS (SELECT q, page_id, title, (CASE WHEN t IS NOT NULL THEN ob ELSE birth_year END)::INT AS birth_year, (CASE WHEN t IS NOT NULL THEN od ELSE death_year END)::INT AS death_year FROM ph LEFT JOIN po ON t = lower(title)),
pl AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY (lower(q) = lower(title))::INT DESC, page_id)::INT AS rank FROM pr)"""


def _found_people(spark, d, limit):
    q = table(spark, d, "eval_items").where("author IS NOT NULL").select(F.col("author").alias("q")).distinct()
    over = table(spark, d, "canonical_authors").where("author_id % 3 = 0").select(F.col("name").alias("title"), (F.col("birth_year") + 1).cast("int").alias("birth_year"), F.lit(None).cast("int").alias("death_year"))
    return X.find_people(q, _people(spark, d), over, limit)


@R.add("find_people", f"WITH {_PEOPLE} SELECT q, page_id, title, birth_year, death_year, rank FROM pl WHERE rank <= 5")
def find_people(spark, d):
    """People pages of each author asked for, dates of every third overridden by title."""
    return _found_people(spark, d, 5)


@R.add("person_tool", f"WITH {_PEOPLE} SELECT q, count(title) AS matches_found, coalesce(string_agg(title, ' | ' ORDER BY rank), '') AS titles FROM pq LEFT JOIN (SELECT * FROM pl WHERE rank <= 5) USING (q) GROUP BY q")
def person_tool(spark, d):
    """The same as the tool call returns it: one row per query."""
    q = table(spark, d, "eval_items").where("author IS NOT NULL").select(F.col("author").alias("q")).distinct()
    out = X.answer(q, _found_people(spark, d, 5), ["page_id", "title"])
    return out.select("q", F.col("matches_found").cast("bigint").alias("matches_found"), F.coalesce(F.array_join(F.transform("matches", lambda m: m["title"]), " | "), F.lit("")).alias("titles"))


# -- resolution --------------------------------------------------------------------


_ALIAS = "al AS (SELECT lower(variant) AS v, min(canonical) AS c FROM (SELECT name AS canonical, unnest([split_part(name, ' ', -1), substr(name, 1, 1) || '. ' || split_part(name, ' ', -1)]) AS variant FROM canonical_authors) GROUP BY 1)"
_TC = "array_to_string(list_transform(range(1, length(v)::INT + 1), lambda i: CASE WHEN i = 1 OR NOT regexp_matches(v[i - 1], '\\p{L}') THEN upper(v[i]) ELSE v[i] END), '')"
VARIANTS = f"""{_ALIAS}, nm AS (SELECT DISTINCT author, lower(author) AS low FROM cites WHERE author <> ''), nd AS (SELECT nm.*, c AS canon FROM nm LEFT JOIN al ON v = low),
ea AS (SELECT author, canon AS name, '' AS spot FROM nd WHERE canon IS NOT NULL AND lower(canon) <> low UNION ALL SELECT author, {_TC}, '1' || v FROM nd JOIN al ON lower(c) = lower(coalesce(canon, author)) WHERE v <> low),
eb AS (SELECT author, lower(name) AS l, min(spot) AS spot, arg_min(name, spot) AS name FROM ea WHERE lower(name) <> lower(author) GROUP BY 1, 2), va AS (SELECT author AS va_author, list(name ORDER BY spot) AS variants FROM eb GROUP BY 1)"""


def _aliases(spark, d):
    last = F.element_at(F.split("name", " "), -1)
    return table(spark, d, "canonical_authors").select(F.explode(F.array(last, F.concat(F.substring("name", 1, 1), F.lit(". "), last))).alias("variant_lower"), F.col("name").alias("canonical"))


def _with_variants(spark, d):
    c = citations(spark, d).select(F.col("ord").alias("cit_id"), "title", "author", "canonical_author")
    return S.alias_variants(c, _aliases(spark, d))


@R.add("alias_variants", f"WITH {CITATIONS}, {VARIANTS} SELECT ord AS cit_id, array_to_string(coalesce(variants, []), ' ~ ') AS variants FROM cites LEFT JOIN va ON va_author = author")
def alias_variants(spark, d):
    return _with_variants(spark, d).select("cit_id", F.array_join("variants", " ~ ").alias("variants"))


_SUB = lambda t: "CASE " + " ".join(f"WHEN instr({t}, '{m}') > 1 THEN trim(string_split({t}, '{m}')[1], ' ')" for m in SUBTITLE_MARKS) + " END"
_ART = lambda t: "nullif(CASE " + " ".join("WHEN starts_with(lower({0}), '{1}') THEN trim(substr({0}, {2}), ' ')".format(t, a.replace("'", "''"), len(a) + 1) for a in LEADING_ARTICLES) + " END, '')"
_Q = lambda cond, t, a: f"CASE WHEN {cond} THEN {{'t': nullif({t}, ''), 'a': nullif({a}, '')}} END"
_LN = SQ.format("regexp_extract(a, '^([^,]*),(.*)$', 1)")
_FN = SQ.format("regexp_extract(a, '^([^,]*),(.*)$', 2)")


@R.add("query_expansion", f"""WITH {CITATIONS}, {VARIANTS}, b0 AS (SELECT ord, trim(title, ' ') AS t, trim(coalesce(author, ''), ' ') AS a, trim(coalesce(canonical_author, ''), ' ') AS c, coalesce(variants, []::VARCHAR[]) AS v FROM cites LEFT JOIN va ON va_author = author),
b1 AS (SELECT *, {_SUB('t')} AS t2, {_ART('t')} AS t3, CASE WHEN len(string_split({SQ.format('a')}, ' ')) >= 2 THEN string_split({SQ.format('a')}, ' ')[-1] END AS l, CASE WHEN contains(a, ',') AND {_LN} <> '' AND {_FN} <> '' THEN {_FN} || ' ' || {_LN} END AS s, {PARTICLE_SQL} AS p FROM b0),
b2 AS (SELECT *, {_ART('t2')} AS t4 FROM b1),
qs AS (SELECT ord, CASE WHEN t <> '' THEN list_concat([{_Q('true', 't', 'a')}, {_Q('t2 IS NOT NULL', 't2', 'a')}, {_Q('t3 IS NOT NULL', 't3', 'a')}, {_Q('t2 IS NOT NULL AND t3 IS NOT NULL AND t4 IS NOT NULL', 't4', 'a')}, {_Q('l IS NOT NULL', 't', 'l')}, {_Q('l IS NOT NULL AND t2 IS NOT NULL', 't2', 'l')}],
   list_transform(v, lambda x: {{'t': nullif(t, ''), 'a': x}}), [{_Q('s IS NOT NULL', 't', 's')}, {_Q('p IS NOT NULL', 't', 'p')}, {_Q("c <> '' AND lower(c) <> lower(a)", 't', 'c')}])
 ELSE list_concat([{_Q('true', 'NULL', 'a')}, {_Q('l IS NOT NULL', 'NULL', 'l')}], list_transform(v, lambda x: {{'t': NULL, 'a': x}}), [{_Q('p IS NOT NULL', 'NULL', 'p')}, {_Q('s IS NOT NULL', 'NULL', 's')}, {_Q("c <> '' AND lower(c) <> lower(a)", 'NULL', 'c')}]) END AS q FROM b2),
e AS (SELECT ord, q.t AS q_title, q.a AS q_author, pos FROM (SELECT ord, unnest(q) AS q, unnest(range(len(q))) AS pos FROM qs) WHERE q IS NOT NULL AND (q.t IS NOT NULL OR q.a IS NOT NULL)),
f AS (SELECT ord, min(pos) AS pos, arg_min({{'t': q_title, 'a': q_author}}, pos) AS b FROM e GROUP BY ord, lower(trim(coalesce(q_title, ''), ' ')), lower(trim(coalesce(q_author, ''), ' ')))
SELECT ord AS cit_id, row_number() OVER (PARTITION BY ord ORDER BY pos)::INT AS query_no, b.t AS q_title, b.a AS q_author FROM f""")
def query_expansion(spark, d):
    return S.expand_queries(_with_variants(spark, d))


def _authors(spark, d):
    """Every author id with each of its names."""
    listed = books(spark, d, "authors").select(F.explode("authors").alias("a")).select("a.author_id", "a.name")
    return listed.unionByName(table(spark, d, "canonical_authors").select("author_id", "name")).distinct()


def _candidates(spark, d):
    b = books(spark, d, "title", "authors").select("book_id", "title", F.col("authors.name").alias("authors"))
    c = citations(spark, d).select(F.col("ord").alias("id"), "title", "author", "canonical_author", F.array().cast("array<string>").alias("variants"))
    return S.search_candidates(c, b, _authors(spark, d))


def _ids(df):
    """The id of a candidate under the kind it has."""
    return df.withColumns({"book_id": F.when(F.col("mode") == "book", F.col("ord")), "author_id": F.when(F.col("mode") == "author", F.col("ord"))})


@R.add("token_sort_score")
def token_sort_score(spark, d):
    return _ids(_candidates(spark, d)).select("id", "book_id", "author_id", "score")


@R.add("top5_candidates")
def top5_candidates(spark, d):
    return _ids(S.best_candidates(_candidates(spark, d))).select("id", "book_id", "author_id", "score", "rank")


@R.add("confidence_gate")
def confidence_gate(spark, d):
    """A decision for every citation; those without candidates get none."""
    found = _candidates(spark, d)
    top = S.best_candidates(found).select("id", "mode", "ord", "score")
    modes = top.select("id", "mode").distinct()
    decided = _ids(S.gate(top).join(modes, "id")).select("id", "book_id", "author_id", "score", "decision")
    return citations(spark, d).select(F.col("ord").alias("id")).join(decided, "id", "left").withColumns({"score": F.coalesce("score", F.lit(0)), "decision": F.coalesce("decision", F.lit("none"))})


def _people(spark, d):
    return table(spark, d, "canonical_authors").select(F.col("author_id").alias("page_id"), F.col("name").alias("title"), F.col("birth_year").cast("int").alias("birth_year"), F.col("death_year").cast("int").alias("death_year"))


@R.add("resolve_passes")
def resolve_passes(spark, d):
    c = citations(spark, d).select(F.col("ord").alias("cit_id"), "title", "author", "canonical_author")
    b = books(spark, d, "title", "authors").select("book_id", "title", F.col("authors.name").alias("authors"))
    return S.resolve(c, b, _authors(spark, d), _people(spark, d), _aliases(spark, d))


@R.add("match_type_decision", f"""WITH {CITATIONS}, {BOOKS}, t AS (SELECT title, min(book_id) AS bid FROM books WHERE title IS NOT NULL GROUP BY 1), a AS (SELECT x.name AS aname, min(x.author_id) AS aid FROM (SELECT unnest(authors) AS x FROM books) WHERE x.name IS NOT NULL AND x.author_id IS NOT NULL GROUP BY 1), p AS (SELECT name, min(author_id) AS pid FROM canonical_authors GROUP BY 1)
SELECT ord, bid AS book_id, CASE WHEN trim(c.title, ' ') = '' THEN aid END AS author_id, pid AS person_id, CASE WHEN trim(c.title, ' ') <> '' THEN CASE WHEN bid IS NOT NULL THEN 'book' ELSE 'not_found' END WHEN aid IS NOT NULL THEN 'author' WHEN pid IS NOT NULL THEN 'person' ELSE 'not_found' END AS match_type
FROM cites c LEFT JOIN t ON t.title = c.title AND trim(c.title, ' ') <> '' LEFT JOIN a ON aname = c.author LEFT JOIN p ON p.name = c.author""")
def match_type_decision(spark, d):
    """Both sources side by side: books by title for titled citations, authors by name for the others, people for all."""
    b = books(spark, d, "title", "authors")
    t = b.where("trim(title) <> ''").groupBy(F.col("title").alias("bt")).agg(F.min("book_id").alias("book_id"))
    a = b.select(F.explode("authors").alias("x")).where("x.name IS NOT NULL AND x.author_id IS NOT NULL").groupBy(F.col("x.name").alias("aname")).agg(F.min("x.author_id").alias("aid"))
    p = table(spark, d, "canonical_authors").groupBy("name").agg(F.min("author_id").alias("person_id"))
    c = citations(spark, d)
    j = c.join(t, c["title"] == t["bt"], "left").join(a, c["author"] == a["aname"], "left").join(p, c["author"] == p["name"], "left")
    j = j.withColumn("author_id", F.when(F.trim("title") == "", F.col("aid")))
    return j.select("ord", "book_id", "author_id", "person_id", S.match_type(F.col("title"), F.coalesce("book_id", "author_id"), F.col("person_id")).alias("match_type"))


@R.add("ground_truth_loose_match", f"""WITH {BOOKS}, g AS (SELECT book_id, lower(title) AS gt, lower(author) AS ga FROM books WHERE title IS NOT NULL AND author IS NOT NULL), c AS (SELECT cit_id, min(lower(title)) AS t, min(lower(author)) AS a FROM citations WHERE title IS NOT NULL AND author IS NOT NULL GROUP BY 1)
SELECT cit_id, min(book_id) AS book_id FROM c JOIN g ON c.t = g.gt AND (contains(a, ga) OR contains(ga, a)) GROUP BY cit_id""")
def ground_truth_loose_match(spark, d):
    g = books(spark, d, "title", "authors").where("title IS NOT NULL AND author IS NOT NULL").select("book_id", F.lower("title").alias("t"), F.lower("author").alias("ga"))
    c = table(spark, d, "citations").where("title IS NOT NULL AND author IS NOT NULL").groupBy("cit_id").agg(F.min(F.lower("title")).alias("t"), F.min(F.lower("author")).alias("a"))
    return c.join(g, "t").where(contains_either(F.col("a"), F.col("ga"))).groupBy("cit_id").agg(F.min("book_id").alias("book_id"))


# -- enrichment --------------------------------------------------------------------


# A cache of every second author (some as misses), the list as people pages, checked dates; both overlap.
_CACHE = "cache AS (SELECT name, CASE WHEN author_id % 8 = 0 THEN NULL ELSE birth_year + 1 END AS birth_year, CASE WHEN author_id % 8 <> 0 THEN -death_year END AS death_year FROM canonical_authors WHERE author_id % 2 = 0)"


def _author_cache(spark, d):
    a = table(spark, d, "canonical_authors").where("author_id % 2 = 0")
    hit = F.col("author_id") % 8 != 0
    return a.select("name", F.when(hit, F.col("birth_year") + 1).cast("int").alias("birth_year"), F.when(hit, -F.col("death_year")).cast("int").alias("death_year"))


_ENRICHED = f"""n AS (SELECT DISTINCT author AS name FROM cites WHERE author IS NOT NULL), {_CACHE}, j AS (SELECT n.name, coalesce(c.birth_year, p.birth_year)::INT AS b0, coalesce(c.death_year, p.death_year)::INT AS d0,
  CASE WHEN c.name IS NOT NULL THEN 'cache' WHEN p.name IS NOT NULL THEN 'people' END AS origin FROM n LEFT JOIN cache c ON c.name = n.name LEFT JOIN canonical_authors p ON p.name = n.name)"""


@R.add("enrich_authors", f"WITH {CITATIONS}, {_ENRICHED} SELECT name, birth_year, death_year, origin FROM ({checked_sql('j', 'name, origin')})")
def enrich_authors(spark, d):
    names = citations(spark, d).select(F.col("author").alias("name"))
    return E.enrich_authors(names, _author_cache(spark, d), table(spark, d, "canonical_authors").select("name", "birth_year", "death_year"))[0]


@R.add("enrich_authors_cache", f"WITH {CITATIONS}, {_ENRICHED}, k AS ({checked_sql('j', 'name, origin')}) SELECT name, birth_year, death_year FROM k WHERE origin IS NULL OR origin <> 'cache' UNION ALL SELECT name, birth_year::INT, death_year::INT FROM cache WHERE name NOT IN (SELECT name FROM k WHERE origin IS NULL OR origin <> 'cache')")
def enrich_authors_cache(spark, d):
    """The cache after the run: new finds and misses written back."""
    names = citations(spark, d).select(F.col("author").alias("name"))
    return E.enrich_authors(names, _author_cache(spark, d), table(spark, d, "canonical_authors").select("name", "birth_year", "death_year"))[1]


_YEARS = "cache AS (SELECT book_id, min(publication_year) AS year FROM books WHERE book_id % 3 = 0 AND publication_year IS NOT NULL GROUP BY 1), web AS (SELECT b.book_id, w.y AS year FROM books b JOIN (SELECT work_id, min(publication_year) AS y FROM books WHERE publication_year <> 0 GROUP BY 1) w USING (work_id) WHERE b.book_id % 2 = 0)"


def _book_years(spark, d):
    b = books(spark, d, "work_id", "publication_year")
    w = b.where("publication_year <> 0 AND work_id IS NOT NULL").groupBy("work_id").agg(F.min("publication_year").alias("year"))
    cache = b.where("book_id % 3 = 0 AND publication_year IS NOT NULL").select("book_id", F.col("publication_year").alias("year"))
    return E.enrich_books(b.select("book_id"), cache, [("web", b.where("book_id % 2 = 0").join(w, "work_id").select("book_id", "year"))])


@R.add("enrich_books", f"WITH {BOOKS}, {_YEARS} SELECT b.book_id, coalesce(c.year, w.year)::INT AS original_year, CASE WHEN c.year IS NOT NULL THEN 'cache' WHEN w.year IS NOT NULL THEN 'web' END AS origin FROM books b LEFT JOIN cache c USING (book_id) LEFT JOIN web w USING (book_id)")
def enrich_books(spark, d):
    return _book_years(spark, d)[0]


@R.add("enrich_books_cache", f"WITH {BOOKS}, {_YEARS} SELECT book_id, year::INT AS year FROM cache UNION ALL SELECT book_id, year::INT FROM web WHERE book_id NOT IN (SELECT book_id FROM cache)")
def enrich_books_cache(spark, d):
    return _book_years(spark, d)[1]


@R.add("cache_probe")
def cache_probe(spark, d):
    """The list's entry for each cited author: the equal key, else the first that is similar enough."""
    names = citations(spark, d).select(F.col("author").alias("name"))
    cache = table(spark, d, "canonical_authors").select(author_key(F.col("name")).alias("key"), F.col("author_id").alias("ord"), F.col("name").alias("value"))
    return E.cache_probe(names, cache)


@R.add("fetch_missing", f"WITH {BOOKS} SELECT DISTINCT work_id FROM books WHERE work_id IS NOT NULL AND work_id NOT IN (SELECT work_id FROM books WHERE publication_year < 1900 AND work_id IS NOT NULL)")
def fetch_missing(spark, d):
    """Works still to fetch: those without a record before 1900 stand for the ones not done."""
    b = books(spark, d, "work_id", "publication_year")
    return E.missing(b, b.where("publication_year < 1900 AND work_id IS NOT NULL"), "work_id")


_KV = "o AS (SELECT source_book_id AS key, publication_year AS value FROM source_books), n AS (SELECT source_book_id AS key, publication_year + 1 AS value FROM source_books WHERE right(source_book_id, 1) IN ('0', '1') UNION ALL SELECT 'x' || source_book_id, 1 FROM source_books WHERE right(source_book_id, 1) = '2')"


def _kv(spark, d):
    s = table(spark, d, "source_books").select(F.col("source_book_id").alias("key"), F.col("publication_year").cast("int").alias("value"))
    last = F.substring("key", -1, 1)
    new = s.where(last.isin("0", "1")).withColumn("value", F.col("value") + 1).unionByName(s.where(last == "2").select(F.concat(F.lit("x"), "key").alias("key"), F.lit(1).alias("value")))
    return s, new


@R.add("kv_upsert", f"WITH {_KV} SELECT key, value::INT AS value FROM n UNION ALL SELECT key, value::INT FROM o WHERE key NOT IN (SELECT key FROM n)")
def kv_upsert(spark, d):
    return E.upsert(*_kv(spark, d), "key")


@R.add("present_only_update", f"WITH {_KV} SELECT o.key, coalesce(n.value, o.value)::INT AS value FROM o LEFT JOIN n ON n.key = o.key")
def present_only_update(spark, d):
    return E.update_present(*_kv(spark, d), "key")


@R.add("stream_available_now_dedup", "SELECT user_id, event_type, count(*) AS n FROM (SELECT DISTINCT user_id, event_type, event_id FROM events) GROUP BY 1, 2")
def stream_available_now_dedup(spark, d):
    """The events as a stream, each once, processed by what is there now."""
    base = scratch(spark)
    out = f"{base}/stream-{spark.sparkContext.applicationId}-{abs(hash(d))}-{spark._jvm.java.util.UUID.randomUUID().toString()}"
    src = spark.readStream.schema("event_id bigint, user_id bigint, event_type string").format("parquet").option("pathGlobFilter", "*.parquet").load(f"{d.rstrip('/')}/events.parquet*")
    seen = ST.first_seen(src, ["event_id"])
    ST.run_available(seen, lambda df, _: df.write.mode("append").parquet(f"{out}/rows"), f"{out}/state")
    return spark.read.parquet(f"{out}/rows").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))


@R.add("event_props", "SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k FROM events")
def event_props(spark, d):
    return table(spark, d, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))
