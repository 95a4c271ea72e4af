"""Full-text search over catalogues: tokens, postings, phrases, BM25, lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import PipelineConfig
from ..functions.text import strip_accents
from .tables import kept


def tokens(c: Column) -> Column:
    """Folded words of a text in order."""
    return F.filter(F.split(F.lower(strip_accents(c)), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def postings(docs: DataFrame, id_col: str, fields: list[str]) -> DataFrame:
    """Inverted index ``(token, field, doc, pos)``."""
    parts = [docs.select(F.lit(f).alias("field"), F.col(id_col).alias("doc"), F.posexplode(tokens(F.col(f))).alias("pos", "token")) for f in fields]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("token", "field", "doc", "pos")


#: Fixed value: a word that more documents hold is looked up with a second one.
FEW = 64


def meetings(asked: DataFrame, docs: DataFrame) -> DataFrame:
    """``(q, doc)``: documents that hold the rarest word of a query and, if more than :data:`FEW` do, its second rarest too.

    ``asked``: ``(q, words)``, ``docs``: ``(doc, words)``, each word of a text once.  Queries
    with a word that no document holds meet none.
    """
    wanted = asked.select("q", F.explode("words").alias("token"))
    held = docs.select("doc", F.explode("words").alias("token")).join(wanted.select("token").distinct(), "token", "left_semi")
    freq = held.groupBy("token").agg(F.count("*").alias("df"))
    rare = wanted.join(freq, "token", "left").groupBy("q").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "token"))).alias("r")).where("r[0].df > 0")
    both = (F.col("r")[0]["df"] > FEW) & (F.size("r") > 1)
    one, two = F.col("r")[0]["token"], F.try_element_at("r", F.lit(2))["token"]
    keys = kept(rare.select("q", F.when(both, F.least(one, two)).otherwise(one).alias("a"), F.when(both, F.greatest(one, two)).alias("b")))
    alone = keys.where("b IS NULL").select("q", F.col("a").alias("token")).join(held, "token").select("q", "doc")
    pairs = keys.where("b IS NOT NULL")
    used = pairs.select(F.explode(F.array("a", "b")).alias("token")).distinct()
    words = held.join(used, "token", "left_semi").groupBy("doc").agg(F.array_sort(F.collect_list("token")).alias("w")).where("size(w) > 1")
    later = words.select("doc", "w", F.posexplode("w").alias("i", "a")).select("doc", "a", F.explode(F.slice("w", F.col("i") + 2, F.size("w"))).alias("b"))
    return alone.unionByName(pairs.join(later, ["a", "b"]).select("q", "doc"))


def phrase_hits(queries: DataFrame, docs: DataFrame, q_id: str, q_text: str, d_id: str, d_text: str) -> DataFrame:
    """``(q, doc)``: documents that hold the words of a query in a row.

    The rarest words of a query, by document frequency, are joined with the postings;
    the whole phrase is then verified on the candidates.  Queries without words
    match nothing.
    """
    q = queries.select(F.col(q_id).alias("q"), tokens(F.col(q_text)).alias("qt")).where(F.size("qt") > 0).dropDuplicates(["q"])
    d = docs.select(F.col(d_id).alias("doc"), tokens(F.col(d_text)).alias("dt"))
    cand = meetings(q.select("q", F.array_distinct("qt").alias("words")), d.select("doc", F.array_distinct("dt").alias("words")))
    line = lambda c: F.concat(F.lit(" "), F.array_join(c, " "), F.lit(" "))
    return cand.join(q, "q").join(d, "doc").where(line("dt").contains(line("qt"))).select("q", "doc")


def all_words_hits(queries: DataFrame, docs: DataFrame, q_id: str, q_text: str, d_id: str, d_text: str, min_len: int = 2) -> DataFrame:
    """``(q, doc)``: documents that hold every word of a query of at least ``min_len`` letters.

    Candidates are found as for phrases, so that words most documents hold are not
    looked up; the other words are then verified.
    """
    long = lambda c: F.filter(F.array_distinct(tokens(F.col(c))), lambda t: F.length(t) >= min_len)
    asked = queries.select(F.col(q_id).alias("q"), F.explode(long(q_text)).alias("token")).groupBy("q").agg(F.collect_set("token").alias("words"))
    held = docs.select(F.col(d_id).alias("doc"), long(d_text).alias("words"))
    whole = F.forall("words", lambda t: F.array_contains("held", t))
    return meetings(asked, held).join(asked, "q").join(held.withColumnRenamed("words", "held"), "doc").where(whole).select("q", "doc")


def record_hits(queries: DataFrame, docs: DataFrame, limit: int = 5) -> DataFrame:
    """``(q, doc, rank)``: records that hold the title phrase and the author phrase of a query, the ``limit`` shortest records first.

    A query with an author that meets nothing is asked again with the words of
    the author one by one, but for single letters.  ``queries``: ``(q, q_title,
    q_author)``; ``docs``: ``(doc, d_title, d_authors array<string>)``.  The rarest
    word of both fields together is joined with the postings.
    """
    blank = F.lit("")
    line = lambda c: F.concat(F.lit(" "), F.array_join(c, " "), F.lit(" "))
    marked = lambda t, a: F.array_distinct(F.concat(F.transform(t, lambda x: F.concat(F.lit("t"), x)), F.transform(a, lambda x: F.concat(F.lit("a"), x))))
    has_title, has_author = F.trim(F.coalesce("q_title", blank)) != "", F.trim(F.coalesce("q_author", blank)) != ""
    q = queries.select("q", has_title.alias("ht"), has_author.alias("ha"), tokens(F.coalesce("q_title", blank)).alias("qt"), tokens(F.coalesce("q_author", blank)).alias("qa"), F.split(F.trim(F.coalesce("q_author", blank)), r"\s+").alias("w"))
    q = q.where((~F.col("ht") | (F.size("qt") > 0)) & (F.col("ht") | F.col("ha")))
    d = docs.select("doc", tokens(F.coalesce("d_title", blank)).alias("dt"), tokens(F.array_join("d_authors", " | ")).alias("da"))
    d = kept(d.select("doc", marked("dt", "da").alias("words"), line("dt").alias("dt"), line("da").alias("da"), (F.size("dt") + F.size("da")).alias("len")))
    held = d.select("doc", F.explode("words").alias("token"))

    def found(asked: DataFrame) -> DataFrame:
        """``asked``: ``(q, qt, phrases)``, each phrase a line of words of the author."""
        names = F.flatten(F.transform("phrases", lambda p: F.filter(F.split(p, " "), lambda x: x != "")))
        words = asked.select("q", F.explode(marked(F.col("qt"), names)).alias("token"))
        freq = held.join(words.select("token").distinct(), "token", "left_semi").groupBy("token").agg(F.count("*").alias("df"))
        rare = words.join(freq, "token", "left").groupBy("q").agg(F.min_by(F.struct("token", "df"), F.struct(F.coalesce("df", F.lit(0)), "token")).alias("r")).where("r.df IS NOT NULL").select("q", "r.token")
        cand = rare.join(held, "token").select("q", "doc").join(asked, "q").join(d.drop("words"), "doc")
        whole = F.when(F.size("qt") > 0, F.col("dt").contains(line("qt"))).otherwise(True) & F.forall("phrases", lambda p: F.col("da").contains(p))
        rank = F.row_number().over(W.partitionBy("q").orderBy("len", "doc"))
        return cand.where(whole).withColumn("rank", rank).where(F.col("rank") <= limit).select("q", "doc", "rank")

    first = kept(found(q.where(~F.col("ha") | (F.size("qa") > 0)).select("q", "qt", F.when(F.col("ha"), F.array(line("qa"))).otherwise(F.array().cast("array<string>")).alias("phrases"))))
    parts = F.filter(F.transform(F.filter("w", lambda x: F.length(x) > 1), lambda x: line(tokens(x))), lambda p: F.trim(p) != "")
    again = q.where(F.col("ha") & (F.size("w") > 1)).join(first.select("q"), "q", "left_anti").select("q", "qt", parts.alias("phrases")).where(F.size("phrases") > 0)
    return first.unionByName(found(again))


def bm25(queries: DataFrame, docs: DataFrame, q_id: str, q_text: str, d_id: str, d_text: str, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """``(q, doc, score)`` of every document that shares a word with the query (Robertson and Zaragoza 2009)."""
    words = docs.select(F.col(d_id).alias("doc"), F.explode(tokens(F.col(d_text))).alias("token"))
    tf = words.groupBy("doc", "token").agg(F.count("*").alias("tf"))
    dl = tf.groupBy("doc").agg(F.sum("tf").alias("dl"))
    size = dl.agg(F.count("*").alias("n"), F.avg("dl").alias("avgdl"))
    asked = queries.select(F.col(q_id).alias("q"), F.explode(F.array_distinct(tokens(F.col(q_text)))).alias("token")).distinct()
    hit = tf.join(asked.select("token").distinct(), "token", "left_semi")
    df_ = hit.groupBy("token").agg(F.count("*").alias("df"))
    idf = F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    part = idf * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("dl") / F.col("avgdl")))
    rows = asked.join(hit, "token").join(df_, "token").join(dl, "doc").crossJoin(F.broadcast(size))  # one row
    return rows.groupBy("q", "doc").agg(F.sum(part).alias("score"))


def top_k(scored: DataFrame, k: int, by: str = "q", order: list | None = None) -> DataFrame:
    """The first ``k`` rows of every query."""
    w = W.partitionBy(by).orderBy(*(order or [F.desc("score"), F.asc("doc")]))
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def substring_lookup(queries: DataFrame, names: DataFrame, limit: int = 5) -> DataFrame:
    """``(q, name, rank)``: names that contain a query anywhere, in file order.

    Both sides are cut into letter triples; the rarest triple of a query is an
    equality join with the names that hold it.  Queries of one or two letters use
    what they have.  ``queries``: ``(q)``; ``names``: ``(ord, name)``.
    """
    norm = lambda c: F.lower(F.trim(F.regexp_replace(c, r"\s+", " ")))
    grams = lambda c, n: F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - n + 1, F.lit(1))), lambda i: F.substring(c, i, F.lit(n)))
    q = queries.select(F.col("q"), norm(F.col("q")).alias("qn")).where("qn <> ''").distinct()
    d = names.select("ord", "name", norm(F.col("name")).alias("dn"))
    found = None
    for n, cond in ((3, F.length("qn") >= 3), (2, F.length("qn") == 2), (1, F.length("qn") == 1)):
        asked = q.where(cond).select("q", "qn", F.explode(F.array_distinct(grams(F.col("qn"), n))).alias("g"))
        held = d.select("ord", F.explode(F.array_distinct(grams(F.col("dn"), n))).alias("g")).join(asked.select("g").distinct(), "g", "left_semi")
        freq = held.groupBy("g").agg(F.count("*").alias("df"))
        rare = asked.join(freq, "g", "left").groupBy("q", "qn").agg(F.min_by("g", F.struct(F.coalesce("df", F.lit(0)), "g")).alias("g"))
        part = rare.join(held, "g").join(d, "ord").where(F.col("dn").contains(F.col("qn"))).select("q", "ord", "name")
        found = part if found is None else found.unionByName(part)
    return found.withColumn("rank", F.row_number().over(W.partitionBy("q").orderBy("ord"))).where(F.col("rank") <= limit).select("q", "name", "rank")


#: Most matches that a lookup gives, whatever is asked for.
LOOKUP_CAP = PipelineConfig.lookup_cap


def lookup_books(queries: DataFrame, docs: DataFrame, limit: int = 5) -> DataFrame:
    """``(q, doc, rank)``: records by title alone, then by author alone, each once, up to ``limit`` in all.

    ``queries``: ``(q, q_title, q_author)``; ``docs`` as for :func:`record_hits`.
    """
    none, most = F.lit(None).cast("string"), min(limit, LOOKUP_CAP)
    ways = queries.select("q", F.explode(F.array(
        F.struct(F.lit(0).alias("way"), F.col("q_title").alias("t"), none.alias("a")), F.struct(F.lit(1).alias("way"), none.alias("t"), F.col("q_author").alias("a")))).alias("w"))
    asked = ways.select("q", "w.way", F.col("w.t").alias("q_title"), F.col("w.a").alias("q_author")).where("trim(coalesce(q_title, q_author, '')) <> ''")
    found = record_hits(asked.select(F.struct("q", "way").alias("q"), "q_title", "q_author"), docs, most)
    first = found.select("q.q", "q.way", "doc", "rank").groupBy("q", "doc").agg(F.min(F.struct("way", "rank")).alias("at"))
    ranked = first.withColumn("rank", F.row_number().over(W.partitionBy("q").orderBy("at", "doc")))
    return ranked.where(F.col("rank") <= most).select("q", "doc", "rank")


def find_people(queries: DataFrame, people: DataFrame, overrides: DataFrame | None = None, limit: int = 5) -> DataFrame:
    """``(q, page_id, title, birth_year, death_year, rank)``: pages whose title holds the phrase.

    Ten times as many as wanted, fifty at least, are fetched by the length of their
    titles, then ranked: the very title first, then the lowest page id.  ``overrides``:
    ``(title, birth_year, death_year)`` replaces dates by title, any case.
    """
    hits = phrase_hits(queries, people, "q", "q", "page_id", "title").withColumnRenamed("doc", "page_id").join(people.select("page_id", "title", "birth_year", "death_year"), "page_id")
    near = F.row_number().over(W.partitionBy("q").orderBy(F.length("title"), "page_id"))
    hits = hits.withColumn("near", near).where(F.col("near") <= max(limit * 10, 50)).drop("near")
    if overrides is not None:
        o = overrides.groupBy(F.lower("title").alias("_t")).agg(F.max_by(F.struct("birth_year", "death_year"), F.struct("birth_year", "death_year")).alias("_o"))
        hits = hits.join(o, F.lower("title") == F.col("_t"), "left")
        hits = hits.withColumns({c: F.when(F.col("_t").isNotNull(), F.col(f"_o.{c}")).otherwise(F.col(c)) for c in ("birth_year", "death_year")}).drop("_t", "_o")
    return person_rerank(hits).where(F.col("rank") <= limit).select("q", "page_id", "title", "birth_year", "death_year", "rank")


def answer(queries: DataFrame, hits: DataFrame, fields: list[str]) -> DataFrame:
    """``(q, matches_found, matches)``: one row per query, as a tool call returns it; hits are few by their limit."""
    packed = hits.groupBy("q").agg(F.array_sort(F.collect_list(F.struct("rank", *fields))).alias("matches"))
    return queries.select("q").distinct().join(packed, "q", "left").select("q", F.coalesce(F.size("matches"), F.lit(0)).alias("matches_found"), "matches")


def person_rerank(hits: DataFrame) -> DataFrame:
    """Best page of each query: exact title first, then the lowest page id."""
    w = W.partitionBy("q").orderBy(F.desc((F.lower("q") == F.lower("title")).cast("int")), F.asc_nulls_last("page_id"))
    return hits.withColumn("rank", F.row_number().over(w))
