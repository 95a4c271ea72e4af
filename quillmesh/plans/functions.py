"""Queries of the scalar functions, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import text as X
from ..operators import graph as G
from .registry import BOOKS, CITATIONS, RAW, Registry, books, citations, raw_rows, table

R = Registry()
SQ = r"trim(regexp_replace({}, '[\s\p{{Z}}]+', ' ', 'g'))"


def _norm(name: str, expr: Callable[[], Column], sql: str) -> None:
    """``(ord, value)`` of an expression over all titles or authors; made late, as columns need a session."""
    query = f"WITH {CITATIONS} SELECT ord, {sql} AS value FROM cites"
    R.add(name, query)(lambda spark, d: citations(spark, d).select("ord", expr().alias("value")))


_fold = lambda c: f"replace(lower({c}), 'ß', 'ss')"
_main = rf"trim(regexp_replace(regexp_extract({_fold('trim(title)')}, '^[^:\-_(\[]*', 0), '[^a-z0-9]+', ' ', 'g'))"
_akey0 = SQ.format("regexp_replace(lower(strip_accents(author)), '[.,]', '', 'g')")
_akey = f"regexp_replace(regexp_replace({_akey0}, '^st ', ''), '^saint ', '')"


def _article(c: str) -> str:
    t = f"trim(lower({c}))"
    for w in X.TITLE_PREFIXES:
        t = f"regexp_replace({t}, '^{w} ', '')"
    return SQ.format(rf"regexp_replace({t}, '[^\p{{L}}\p{{N}}_\s]', '', 'g')")


def _viewer(c: str) -> str:
    t = rf"regexp_replace(lower(strip_accents({c})), '^(?:{'|'.join(X.VIEWER_ARTICLES)})\s+', '')"
    return SQ.format(f"regexp_replace(regexp_replace({t}, '[‘’]', '''', 'g'), '[“”]', '\"', 'g')")


_norm("norm_text", lambda: X.normalize_text(F.col("title")), _fold(SQ.format("title")))
_norm("norm_title_main", lambda: X.main_title(F.col("title")), _main)
_norm("norm_author_accents", lambda: X.author_key(F.col("author")), _akey)
_norm("norm_key", lambda: X.author_key(F.col("author"), saint=False), _akey0)
_norm("norm_title_articles", lambda: X.article_title(F.col("title")), _article("title"))
_norm("norm_title_viewer", lambda: X.viewer_title(F.col("title")), _viewer("title"))
_norm(
    "norm_author_viewer", lambda: X.viewer_author(F.col("author")),
    f"CASE WHEN author IS NULL OR author = '' THEN 'Unknown' WHEN contains(author, ',') THEN {SQ.format('''concat_ws(' ', trim(split_part(author, ',', 2)), trim(split_part(author, ',', 1)))''')} ELSE {SQ.format('author')} END",
)
_norm(
    "norm_author_swapped", lambda: X.swapped_author(F.col("author")),
    f"CASE WHEN contains(author, ',') THEN {SQ.format('''concat_ws(' ', trim(regexp_extract(author, '^([^,]*),(.*)$', 2)), trim(regexp_extract(author, '^([^,]*),(.*)$', 1)))''')} ELSE {SQ.format('author')} END",
)
_norm("norm_slug", lambda: X.slug(F.col("title")), "trim(regexp_replace(lower(title), '[^a-z0-9]+', '_', 'g'), '_')")
_norm("norm_token_sort", lambda: X.token_sort(F.col("author")), r"array_to_string(list_sort(list_filter(string_split(regexp_replace(lower(author), '[^\p{L}\p{N}_]+', ' ', 'g'), ' '), lambda w: w <> '')), ' ')")
_norm("web_id", lambda: X.web_id(F.col("title"), F.col("cite_count")), "'web_' || substr(md5(title || cite_count::VARCHAR), 1, 8)")
_norm("query_subtitle", lambda: X.without_subtitle(F.col("title")), "CASE " + " ".join(f"WHEN instr(title, '{m}') > 1 THEN trim(string_split(title, '{m}')[1])" for m in X.SUBTITLE_MARKS) + " END")
_norm("query_article", lambda: X.without_article(F.col("title")), "nullif(CASE " + " ".join("WHEN starts_with(lower(title), '{0}') THEN trim(substr(title, {1}))".format(a.replace("'", "''"), len(a) + 1) for a in X.LEADING_ARTICLES) + " END, '')")
_norm("query_last_name", lambda: X.last_name(F.col("author")), f"CASE WHEN len(string_split({SQ.format('author')}, ' ')) >= 2 THEN string_split({SQ.format('author')}, ' ')[-1] END")
_norm("name_scores", lambda: X.name_score(F.lower(F.col("author")), F.lower(F.col("canonical_author"))), """CASE WHEN lower(author) = lower(canonical_author) THEN 3
  WHEN starts_with(lower(author), lower(canonical_author)) OR starts_with(lower(canonical_author), lower(author)) THEN 2
  WHEN contains(lower(author), lower(canonical_author)) OR contains(lower(canonical_author), lower(author)) THEN 1 ELSE 0 END""")
_norm("real_ids", lambda: X.is_real_id(F.when(F.col("ord") % 7 == 0, F.concat(F.lit("web_"), F.col("ord").cast("string"))).otherwise(F.col("ord").cast("string"))), "ord % 7 <> 0")


@R.add("the_author", rf"WITH {RAW} SELECT raw_id, replace(regexp_replace(commentary, '\b[Tt]he author\b', chr(1), 'g'), chr(1), coalesce(authors[1], 'the author')) AS value FROM raw JOIN source_books USING (source_book_id)")
def the_author(spark, d):
    src = table(spark, d, "source_books").select("source_book_id", F.coalesce(F.try_element_at("authors", F.lit(1)), F.lit("the author")).alias("src"))
    return raw_rows(spark, d).join(src, "source_book_id").select("raw_id", X.the_author(F.col("commentary"), F.col("src")).alias("value"))


_DATES = "SELECT author_id, birth_year AS b0, death_year AS d0 FROM canonical_authors UNION ALL SELECT author_id + 1000, -birth_year, death_year FROM canonical_authors UNION ALL SELECT author_id + 2000, birth_year, -death_year FROM canonical_authors UNION ALL SELECT author_id + 3000, -birth_year, -death_year FROM canonical_authors UNION ALL SELECT author_id + 4000, birth_year - 1700, death_year - 1700 FROM canonical_authors"


def _life_dates(spark, d):
    """Life dates with every kind of sign and era error."""
    a = table(spark, d, "canonical_authors").select("author_id", "birth_year", "death_year")
    row = lambda k, b, e: a.select((F.col("author_id") + k).alias("author_id"), b.cast("int").alias("b0"), e.cast("int").alias("d0"))
    b, e = F.col("birth_year"), F.col("death_year")
    out = row(0, b, e)
    for k, (x, y) in enumerate([(-b, e), (b, -e), (-b, -e), (b - 1700, e - 1700)], 1):
        out = out.unionByName(row(1000 * k, x, y))
    return out


_LABEL = """CASE WHEN b0 IS NULL OR d0 IS NULL THEN NULL
  WHEN b0 > 0 AND d0 < 0 THEN CASE WHEN abs(d0) - b0 BETWEEN 1 AND 119 THEN 'sign_error_death' ELSE 'wrong_person_death' END
  WHEN b0 < 0 AND d0 > 0 AND d0 - abs(b0) BETWEEN 1 AND 119 THEN 'sign_error_birth' WHEN b0 < 0 AND d0 > 0 AND NOT abs(b0) + d0 BETWEEN 1 AND 119 THEN 'wrong_person_birth'
  WHEN b0 < 0 AND d0 < 0 AND d0 < b0 THEN CASE WHEN abs(d0) - abs(b0) BETWEEN 1 AND 119 THEN 'sign_error_both' ELSE 'wrong_person_both_neg' END
  WHEN b0 > 0 AND d0 > 0 AND b0 > d0 THEN 'wrong_person_both' WHEN b0 > 0 AND d0 > 0 AND d0 - b0 > 200 THEN 'implausible_lifespan' END"""
_NO_BIRTH = "('wrong_person_birth', 'wrong_person_both_neg', 'wrong_person_both', 'implausible_lifespan')"
_NO_DEATH = "('wrong_person_death', 'wrong_person_both_neg', 'wrong_person_both', 'implausible_lifespan')"


def checked_sql(src: str, keys: str) -> str:
    """``keys, label, birth_year, death_year`` of ``b0, d0`` after the date rules."""
    return f"""SELECT {keys}, label,
  (CASE WHEN label IN {_NO_BIRTH} THEN NULL WHEN label IN ('sign_error_birth', 'sign_error_both') THEN abs(b0) ELSE b0 END)::INT AS birth_year,
  (CASE WHEN label IN {_NO_DEATH} THEN NULL WHEN label IN ('sign_error_death', 'sign_error_both') THEN abs(d0) ELSE d0 END)::INT AS death_year FROM (SELECT *, {_LABEL} AS label FROM {src})"""


@R.add("validate_dates", checked_sql(f"({_DATES})", "author_id"))
def validate_dates(spark, d):
    return _life_dates(spark, d).select("author_id", D.checked_dates(F.col("b0"), F.col("d0")).alias("v")).select("author_id", "v.label", "v.birth_year", "v.death_year")


@R.add("date_fix_counts", f"SELECT label, count(*) AS n FROM (SELECT {_LABEL} AS label FROM ({_DATES})) WHERE label IS NOT NULL GROUP BY label")
def date_fix_counts(spark, d):
    return _life_dates(spark, d).select(D.date_case(F.col("b0"), F.col("d0")).alias("label")).where("label IS NOT NULL").groupBy("label").agg(F.count("*").alias("n"))


@R.add("suspicious_dates", f"SELECT author_id FROM ({_DATES}) WHERE (b0 < 0 AND d0 < 0 AND d0 < b0) OR d0 - b0 > 200")
def suspicious_dates(spark, d):
    return _life_dates(spark, d).where(D.suspicious_dates(F.col("b0"), F.col("d0"))).select("author_id")


_YTEXT = """CASE book_id % 6 WHEN 0 THEN publication_year::VARCHAR WHEN 1 THEN abs(publication_year)::VARCHAR || ' BC' WHEN 2 THEN lpad(abs(publication_year)::VARCHAR, 4, '0') || '-01-01'
  WHEN 3 THEN '-' || lpad(abs(publication_year)::VARCHAR, 4, '0') WHEN 4 THEN lpad(abs(publication_year)::VARCHAR, 4, '0') || '-05-06T00:00:00' ELSE abs(publication_year)::VARCHAR || ' AD' END"""


def spelt_years(df):
    """``(book_id, raw)``: years in the six ways in which maps spell them."""
    y, a = F.col("publication_year"), F.abs("publication_year").cast("string")
    four, k = F.lpad(a, 4, "0"), F.col("book_id") % 6
    text = F.when(k == 0, y.cast("string")).when(k == 1, F.concat(a, F.lit(" BC"))).when(k == 2, F.concat(four, F.lit("-01-01"))).when(k == 3, F.concat(F.lit("-"), four)).when(
        k == 4, F.concat(four, F.lit("-05-06T00:00:00"))).otherwise(F.concat(a, F.lit(" AD")))
    return df.select("book_id", text.alias("raw"))


def _year_texts(spark, d):
    return spelt_years(books(spark, d, "publication_year"))


_YT = f"WITH {BOOKS}, y AS (SELECT book_id, {_YTEXT} AS raw FROM books)"


PARSE = r"""(CASE WHEN contains(raw, 'BC') THEN -try_cast(nullif(regexp_replace(raw, '[^0-9]', '', 'g'), '') AS INT)
  WHEN regexp_extract(raw, '^-?([0-9]{4})', 1) <> '' THEN try_cast(regexp_extract(raw, '^-?([0-9]{4})', 1) AS INT) ELSE try_cast(nullif(regexp_extract(raw, '^(-?[0-9]+)', 1), '') AS INT) END)::INT"""


@R.add("parse_year", rf"""{_YT} SELECT book_id, (CASE WHEN contains(raw, 'BC') THEN -try_cast(nullif(regexp_replace(raw, '[^0-9]', '', 'g'), '') AS INT)
  WHEN regexp_extract(raw, '^-?([0-9]{{4}})', 1) <> '' THEN try_cast(regexp_extract(raw, '^-?([0-9]{{4}})', 1) AS INT) ELSE try_cast(nullif(regexp_extract(raw, '^(-?[0-9]+)', 1), '') AS INT) END)::INT AS year FROM y""")
def parse_year(spark, d):
    return _year_texts(spark, d).select("book_id", D.parse_year(F.col("raw")).alias("year"))


@R.add("parse_to_integer", rf"""{_YT} SELECT book_id, CASE WHEN regexp_matches(trim(raw), '^[0-9]+ *BCE?$') THEN (-(regexp_extract(trim(raw), '^([0-9]+)', 1)::INT))::VARCHAR
  WHEN regexp_matches(trim(raw), '^[0-9]+ *(AD|CE)$') THEN (regexp_extract(trim(raw), '^([0-9]+)', 1)::INT)::VARCHAR
  WHEN regexp_matches(trim(raw), '^-?[0-9]{{1,4}}-[0-9]{{2}}-[0-9]{{2}}') THEN (regexp_extract(trim(raw), '^(-?[0-9]{{1,4}})-', 1)::INT)::VARCHAR
  WHEN regexp_matches(trim(raw), '^-?[0-9]+$') THEN (trim(raw)::INT)::VARCHAR ELSE raw END AS value FROM y""")
def parse_to_integer(spark, d):
    return _year_texts(spark, d).select("book_id", D.parse_to_integer(F.col("raw")).alias("value"))


@R.add("drop_time_part", f"{_YT} SELECT book_id, split_part(raw, 'T', 1) AS value FROM y")
def drop_time_part(spark, d):
    return _year_texts(spark, d).select("book_id", D.drop_time(F.col("raw")).alias("value"))


@R.add("date_format_lint", rf"{_YT} SELECT book_id, raw FROM y WHERE raw IS NOT NULL AND NOT regexp_matches(raw, '^-?[0-9]{{1,4}}$|^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$|^[0-9]+ BC$')")
def date_format_lint(spark, d):
    return _year_texts(spark, d).where(D.is_bad_date(F.col("raw"))).select("book_id", "raw")


@R.add("epoch_year", "SELECT event_id, (1970 + CASE WHEN s < 0 THEN ceil(s / 31556926.0) ELSE floor(s / 31556926.0) END)::INT AS year FROM (SELECT event_id, floor((epoch_ms(ts) - 70000000000000) / 1000.0) AS s FROM events)")
def epoch_year(spark, d):
    ms = (F.unix_micros("ts") / 1000).cast("bigint") - 70_000_000_000_000
    return table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp")).select("event_id", D.epoch_year(ms).alias("year"))


_EPOCH = "CASE WHEN birth_year IS NULL THEN NULL " + " ".join(f"WHEN birth_year < {b} THEN '{n}'" for b, n in D.EPOCHS) + " ELSE 'Contemporary' END"


@R.add("epoch_class", f"SELECT author_id, {_EPOCH} AS epoch FROM canonical_authors")
def epoch_class(spark, d):
    return table(spark, d, "canonical_authors").select("author_id", D.epoch_of(F.col("birth_year")).alias("epoch"))


@R.add("timeline_scale", "SELECT author_id, round(CASE WHEN birth_year < 1800 THEN birth_year * 0.3 ELSE 540.0 + (birth_year - 1800) * 8.0 END, 4)::DOUBLE AS x FROM canonical_authors")
def timeline_scale(spark, d):
    return table(spark, d, "canonical_authors").select("author_id", F.round(D.timeline_x(F.col("birth_year")), 4).alias("x"))


@R.add("timeline_ticks", """WITH e AS (SELECT min(birth_year) AS lo, max(birth_year) AS hi FROM canonical_authors)
SELECT unnest(range((ceil(lo / 100.0) * 100)::INT, 1701, 100))::INT AS tick FROM e WHERE lo < 1800
UNION ALL SELECT unnest(range(greatest(1800, (ceil(lo / 10.0) * 10)::INT), hi::INT + 1, 10))::INT FROM e WHERE hi >= 1800""")
def timeline_ticks(spark, d):
    e = table(spark, d, "canonical_authors").agg(F.min("birth_year").alias("lo"), F.max("birth_year").alias("hi"))
    return e.select(F.explode(G.ticks(F.col("lo"), F.col("hi"))).alias("tick"))


@R.add("excerpt_years", rf"WITH {RAW} SELECT raw_id, regexp_extract(citation_excerpt, '([0-9]{{4}})', 1)::INT AS year FROM raw WHERE regexp_matches(citation_excerpt, '[0-9]{{4}}')")
def excerpt_years(spark, d):
    return raw_rows(spark, d).select("raw_id", D.year_in_text(F.col("citation_excerpt")).alias("year")).where("year IS NOT NULL")


@R.add("citation_marks", r"SELECT doc_id, regexp_replace(text, '\[[A-Za-z0-9_]+\]', '', 'g') AS value FROM documents")
def citation_marks(spark, d):
    return table(spark, d, "documents").select("doc_id", X.strip_marks(F.col("text")).alias("value"))


@R.add("get_year", f"{_YT} SELECT book_id, nullif(CASE WHEN contains(raw, 'BC') THEN -try_cast(nullif(regexp_replace(raw, '[^0-9]', '', 'g'), '') AS INT) WHEN regexp_extract(raw, '^-?([0-9]{{4}})', 1) <> '' THEN try_cast(regexp_extract(raw, '^-?([0-9]{{4}})', 1) AS INT) ELSE try_cast(nullif(regexp_extract(raw, '^(-?[0-9]+)', 1), '') AS INT) END, 0)::INT AS year FROM y".replace("{{", "{").replace("}}", "}"))
def get_year(spark, d):
    return _year_texts(spark, d).select("book_id", D.get_year(F.col("raw")).alias("year"))


@R.add("viewer_year", f"{_YT} SELECT book_id, (CASE WHEN contains(raw, 'BC') THEN -try_cast(nullif(regexp_replace(raw, '[^0-9]', '', 'g'), '') AS INT) ELSE try_cast(nullif(regexp_extract(raw, '^(-?[0-9]+)(-[0-9][0-9](-[0-9][0-9](T.*)?)?)?$', 1), '') AS INT) END)::INT AS year FROM y")
def viewer_year(spark, d):
    return _year_texts(spark, d).select("book_id", D.viewer_year(F.col("raw")).alias("year"))


@R.add("person_years", rf"WITH {RAW} SELECT raw_id, nullif(regexp_extract(citation_excerpt, '([0-9][0-9][0-9][0-9]?)', 1), '')::INT * CASE WHEN regexp_matches(citation_excerpt, '[0-9][0-9][0-9][0-9]? *BCE?') THEN -1 ELSE 1 END AS year, nullif(regexp_extract(citation_excerpt, '(-?[0-9][0-9][0-9][0-9]?)', 1), '')::INT AS answered FROM raw WHERE regexp_matches(citation_excerpt, '[0-9][0-9][0-9]')")
def person_years(spark, d):
    e = F.col("citation_excerpt")
    return raw_rows(spark, d).select("raw_id", D.person_year_in_text(e).alias("year"), D.answered_year(e).alias("answered")).where("year IS NOT NULL")


@R.add("flip_sign", f"SELECT author_id, abs(b0)::INT AS birth_year, abs(d0)::INT AS death_year FROM ({_DATES}) WHERE b0 BETWEEN -2025 AND -1000 UNION ALL SELECT author_id, b0::INT, d0::INT FROM ({_DATES}) WHERE b0 IS NULL OR NOT b0 BETWEEN -2025 AND -1000")
def flip_sign(spark, d):
    return _life_dates(spark, d).select("author_id", D.flip_sign(F.col("b0"), F.col("d0")).alias("v")).select("author_id", "v.*")


_NAT = "CASE " + " ".join(f"WHEN contains(c, '{n}') THEN '{n}'" for n in X.NATIONALITIES) + " END"


@R.add("nationality", f"SELECT author_id, coalesce(nullif(nationality, ''), list_filter(list_transform(cats, lambda c: {_NAT}), lambda n: n IS NOT NULL)[1]) AS value FROM (SELECT author_id, nationality, [coalesce(main_genre, ''), CASE author_id % 4 WHEN 0 THEN 'Greek and Roman poets' WHEN 1 THEN '20th-century Irish writers' ELSE '1900 births' END, 'French people'] AS cats FROM canonical_authors)")
def nationality(spark, d):
    k = F.col("author_id") % 4
    cats = F.array(F.coalesce("main_genre", F.lit("")), F.when(k == 0, "Greek and Roman poets").when(k == 1, "20th-century Irish writers").otherwise("1900 births"), F.lit("French people"))
    return table(spark, d, "canonical_authors").select("author_id", X.nationality(F.col("nationality"), cats).alias("value"))


_KIND = "CASE " + " ".join(f"WHEN {{0}} {{1}} '{w}' {{2}} THEN '{k}'" for w, k in G.BOX_KINDS) + " END"
_BOX = "CASE author_id % 5 WHEN 0 THEN ['Writer <!-- novelist -->'] WHEN 1 THEN ['infobox x', 'medical person'] WHEN 2 THEN ['philosopher of science'] WHEN 3 THEN ['settlement'] END"
_BOXES = "list_transform(b, lambda x: lower(trim(regexp_replace(x, '<!--.*?-->', '', 'g'))))"
_EXACT = "CASE " + " ".join(f"WHEN x = '{w}' THEN '{k}'" for w, k in G.BOX_KINDS) + " END"
_PART = "CASE " + " ".join(f"WHEN contains(x, '{w}') THEN '{k}'" for w, k in G.BOX_KINDS) + " END"


@R.add("box_kinds", f"SELECT author_id, CASE WHEN b IS NOT NULL THEN coalesce(list_filter(list_transform({_BOXES}, lambda x: {_EXACT}), lambda k: k IS NOT NULL)[1], list_filter(list_transform({_BOXES}, lambda x: {_PART}), lambda k: k IS NOT NULL)[1], 'Other') END AS kind FROM (SELECT author_id, {_BOX} AS b FROM canonical_authors)")
def box_kinds(spark, d):
    k, one = F.col("author_id") % 5, lambda *x: F.array(*[F.lit(v) for v in x])
    boxes = F.when(k == 0, one("Writer <!-- novelist -->")).when(k == 1, one("infobox x", "medical person")).when(k == 2, one("philosopher of science")).when(k == 3, one("settlement"))
    return table(spark, d, "canonical_authors").select("author_id", G.box_kind(boxes).alias("kind"))


@R.add("relevant_people", "SELECT author_id FROM canonical_authors WHERE regexp_matches(lower(coalesce(main_genre, '') || ' ' || CASE author_id % 3 WHEN 0 THEN 'American novelists' WHEN 1 THEN 'Painters' ELSE 'Historians of art' END), '" + "|".join(X.OCCUPATIONS) + "')")
def relevant_people(spark, d):
    cats = F.array(F.when(F.col("author_id") % 3 == 0, "American novelists").when(F.col("author_id") % 3 == 1, "Painters").otherwise("Historians of art"))
    return table(spark, d, "canonical_authors").where(X.relevant_person(F.array_compact(F.array("main_genre")), cats)).select("author_id")


_FENCE = "```"
_ANSWER = f"CASE event_id % 6 WHEN 0 THEN props WHEN 1 THEN 'Sure: {_FENCE}json ' || props || ' {_FENCE} done' WHEN 2 THEN 'the answer is ' || props || ' .' WHEN 3 THEN '<tool_call>' || props WHEN 4 THEN '  ' ELSE 'no json here' END"


@R.add("salvage_json", f"SELECT event_id, CASE event_id % 6 WHEN 3 THEN '<tool_call>' || props WHEN 4 THEN '{{}}' WHEN 5 THEN '{{\"result\":\"UNPARSEABLE\",\"raw_response\":\"no json here\"}}' ELSE props END AS value FROM events")
def salvage_json(spark, d):
    k, p = F.col("event_id") % 6, F.col("props")
    said = F.when(k == 0, p).when(k == 1, F.concat(F.lit(f"Sure: {_FENCE}json "), p, F.lit(f" {_FENCE} done"))).when(k == 2, F.concat(F.lit("the answer is "), p, F.lit(" ."))).when(k == 3, F.concat(F.lit("<tool_call>"), p)).when(k == 4, "  ").otherwise("no json here")
    return table(spark, d, "events").select("event_id", X.salvage_json(said).alias("value"))


@R.add("fact_lines", "SELECT author_id, 'b' || coalesce(birth_year, 0) AS born, 'd' || coalesce(death_year, 0) || ': x' AS died FROM canonical_authors")
def fact_lines(spark, d):
    """Born and died of the lines of an infobox; lines of no fact and earlier lines do not count."""
    text = F.concat(F.lit("Born: earlier\nOccupation: poet\nbirth_date: b"), F.coalesce("birth_year", F.lit(0)).cast("string"), F.lit("\nDied: d"), F.coalesce("death_year", F.lit(0)).cast("string"), F.lit(": x"))
    return table(spark, d, "canonical_authors").select("author_id", X.fact_lines(text, X.PERSON_LINES).alias("f")).select("author_id", "f.born", "f.died")


@R.add("prompt_fields", f"WITH {RAW} SELECT raw_id, CASE WHEN contains(coalesce(title, ''), chr(10)) THEN NULL ELSE trim(trim(coalesce(title, ''), ' '), '\"') END AS title, trim(coalesce(author, ''), ' ') AS author FROM raw WHERE NOT contains(coalesce(title, '') || coalesce(author, ''), chr(10))")
def prompt_fields(spark, d):
    r = raw_rows(spark, d).where(~F.concat(F.coalesce("title", F.lit("")), F.coalesce("author", F.lit(""))).contains("\n"))
    text = F.concat(F.lit("Find it.\nBook title: first\nBook title: "), F.coalesce("title", F.lit("")), F.lit("\nAuthor: "), F.coalesce("author", F.lit("")))
    return r.select("raw_id", X.prompt_fields(text).alias("f")).select("raw_id", "f.title", "f.author")


@R.add("id_list", "SELECT r_regionkey, unnest(list_filter(regexp_split_to_array(trim(replace(r_name || ', 12 7,' || r_regionkey, ',', ' ')), '\\s+'), lambda x: x <> '')) AS id FROM region")
def id_list(spark, d):
    text = F.concat(F.col("r_name"), F.lit(", 12 7,"), F.col("r_regionkey").cast("string"))
    return table(spark, d, "region").select("r_regionkey", F.explode(X.id_list(text)).alias("id"))


@R.add("in_view", "SELECT author_id, (x * 2.0 + 10.0) AS sx, (y * 2.0 - 20.0) AS sy FROM (SELECT author_id, (birth_year % 700)::DOUBLE AS x, (author_id % 97)::DOUBLE AS y FROM canonical_authors) WHERE x * 2.0 + 10.0 + 12.0 >= 0 AND x * 2.0 + 10.0 - 12.0 <= 800 AND y * 2.0 - 20.0 + 12.0 >= 0 AND y * 2.0 - 20.0 - 12.0 <= 100")
def in_view(spark, d):
    a = table(spark, d, "canonical_authors").select("author_id", (F.col("birth_year") % 700).cast("double").alias("x"), (F.col("author_id") % 97).cast("double").alias("y"))
    sx, sy = G.to_screen(F.col("x"), F.col("y"), 2.0, 10.0, -20.0)
    return a.where(G.in_view(F.col("x"), F.col("y"), F.lit(5.0), (2.0, 10.0, -20.0), (800.0, 100.0), 2.0)).select("author_id", sx.alias("sx"), sy.alias("sy"))


@R.add("title_case", f"WITH {CITATIONS} SELECT ord, array_to_string(list_transform(range(1, length(author)::INT + 1), lambda i: CASE WHEN i = 1 OR NOT regexp_matches(lower(author)[i - 1], '\\p{{L}}') THEN upper(lower(author)[i]) ELSE lower(author)[i] END), '') AS value FROM cites WHERE author IS NOT NULL".replace("{{", "{").replace("}}", "}"))
def title_case(spark, d):
    return citations(spark, d).where("author IS NOT NULL").select("ord", X.title_case(F.col("author")).alias("value"))


_LAST, _FIRST = (SQ.format(f"regexp_extract(author, '^([^,]*),(.*)$', {i})") for i in (1, 2))


@R.add("query_uncomma", f"WITH {CITATIONS} SELECT ord, CASE WHEN contains(author, ',') AND {_LAST} <> '' AND {_FIRST} <> '' THEN {_FIRST} || ' ' || {_LAST} END AS value FROM cites")
def query_uncomma(spark, d):
    return citations(spark, d).select("ord", X.uncomma(F.col("author")).alias("value"))


PARTICLE_SQL = "nullif(" + SQ.format("CASE " + " ".join(f"WHEN instr(lower(a), ' {p}') > 0 THEN substr(a, 1, instr(lower(a), ' {p}')) || substr(a, instr(lower(a), ' {p}') + {len(p) + 1})" for p in X.NAME_PARTICLES) + " " + " ".join(f"WHEN starts_with(lower(a), '{p}') THEN substr(a, {len(p) + 1})" for p in X.NAME_PARTICLES) + " END") + ", '')"


@R.add("query_particle", f"WITH {CITATIONS} SELECT ord, {PARTICLE_SQL} AS value FROM (SELECT ord, author AS a FROM cites)")
def query_particle(spark, d):
    return citations(spark, d).select("ord", X.without_particle(F.col("author")).alias("value"))
