"""Resolution of citations: query expansion, scores, the confidence gate, match types."""

from __future__ import annotations

from collections.abc import Callable
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import PipelineConfig
from ..functions.text import last_name, title_case, token_sort, uncomma, without_article, without_particle, without_subtitle
from .search import find_people, record_hits, substring_lookup
from .tables import kept


def _pairs(rules: list[tuple[Column, Column, Column]]) -> Column:
    """Rules (condition, title, author) as one array; failed rules drop out."""
    made = [F.when(cond, F.struct(F.nullif(t, F.lit("")).alias("title"), F.nullif(a, F.lit("")).alias("author"))) for cond, t, a in rules]
    return F.filter(F.array(*made), lambda x: x.isNotNull() & (x["title"].isNotNull() | x["author"].isNotNull()))


def expand_queries(cites: DataFrame, id_col: str = "cit_id") -> DataFrame:
    """``(id, query_no, q_title, q_author)``: search queries of each citation, best first.

    Needs ``title, author, canonical_author`` and ``variants array<string>`` (other
    names of the author).  Pairs equal but for case count once, at their first place.
    """
    blank = F.lit("")
    t, a = F.trim(F.coalesce("title", blank)), F.trim(F.coalesce("author", blank))
    base = cites.select(F.col(id_col).alias("id"), t.alias("t"), a.alias("a"), F.trim(F.coalesce("canonical_author", blank)).alias("c"), F.coalesce("variants", F.array().cast("array<string>")).alias("v"))
    base = base.withColumns({"t2": without_subtitle(F.col("t")), "t3": without_article(F.col("t")), "l": last_name(F.col("a")), "s": uncomma(F.col("a")), "p": without_particle(F.col("a"))})
    base = base.withColumn("t4", without_article(F.col("t2")))
    T, A, T2, T3, T4, L, S, P, C = (F.col(x) for x in ("t", "a", "t2", "t3", "t4", "l", "s", "p", "c"))
    yes, other = F.lit(True), (C != "") & (F.lower(C) != F.lower(A))
    none = F.lit(None).cast("string")
    by_alias = F.transform("v", lambda v: F.struct(F.nullif(T, blank).alias("title"), v.alias("author")))
    book = F.concat(
        _pairs([(yes, T, A), (T2.isNotNull(), T2, A), (T3.isNotNull(), T3, A), (T2.isNotNull() & T3.isNotNull() & T4.isNotNull(), T4, A), (L.isNotNull(), T, L), (L.isNotNull() & T2.isNotNull(), T2, L)]),
        by_alias, _pairs([(S.isNotNull(), T, S), (P.isNotNull(), T, P), (other, T, C)]),
    )
    alone = F.concat(
        _pairs([(yes, none, A), (L.isNotNull(), none, L)]), F.transform("v", lambda v: F.struct(none.alias("title"), v.alias("author"))),
        _pairs([(P.isNotNull(), none, P), (S.isNotNull(), none, S), (other, none, C)]),
    )
    rows = base.select("id", F.posexplode(F.when(T != "", book).otherwise(alone)).alias("pos", "q")).select("id", "pos", F.col("q.title").alias("q_title"), F.col("q.author").alias("q_author"))
    key = [F.lower(F.trim(F.coalesce("q_title", blank))).alias("kt"), F.lower(F.trim(F.coalesce("q_author", blank))).alias("ka")]
    kept = rows.groupBy("id", *key).agg(F.min(F.struct("pos", "q_title", "q_author")).alias("b")).select("id", "b.*")
    return kept.withColumn("query_no", F.row_number().over(W.partitionBy("id").orderBy("pos"))).select(F.col("id").alias(id_col), "query_no", "q_title", "q_author")


def search_candidates(cites: DataFrame, books: DataFrame, names: DataFrame, limit: int = PipelineConfig.search_limit) -> DataFrame:
    """``(id, mode, ord, score)``: what the search queries of each citation meet, scored.

    Titled citations search the records by title and author (mode book), and
    titles are compared; untitled ones look their author up in the names (mode
    author).  ``cites``: ``(id, title, author, canonical_author, variants)``;
    ``books``: ``(book_id, title, authors array<string>)``; ``names``:
    ``(author_id, name)``; ``ord`` is the id of the record or author.  Equal
    citations are searched and scored once.
    """
    blank, kind = F.lit(""), dict(books.dtypes)["book_id"]
    key = F.struct(*[F.coalesce(c, blank).alias(c) for c in ("title", "author", "canonical_author")], F.coalesce("variants", F.array().cast("array<string>")).alias("variants"))
    same = cites.select("id", key.alias("k"))
    one = kept(same.groupBy("k").agg(F.min("id").alias("one")))
    fold = lambda c: F.lower(F.trim(F.coalesce(c, blank)))
    asked = kept(expand_queries(one.select("one", "k.*"), "one").select("one", fold("q_title").alias("q_title"), fold("q_author").alias("q_author")).distinct())
    texts = asked.where("q_title <> ''").select("q_title", "q_author").distinct()
    hits = record_hits(texts.withColumn("q", F.struct("q_title", "q_author")), books.select(F.col("book_id").alias("doc"), F.col("title").alias("d_title"), F.col("authors").alias("d_authors")), limit)
    met = hits.select("q.*", F.col("doc").alias("book_id")).join(asked, ["q_title", "q_author"]).select("one", "book_id").distinct()
    met = met.join(books.select("book_id", F.col("title").alias("found")), "book_id").select("one", F.lit("book").alias("mode"), F.col("book_id").alias("ord"), "found")
    alone = asked.where("q_title = ''").select("one", F.col("q_author").alias("q"))
    known = names.where("name IS NOT NULL AND author_id IS NOT NULL").distinct()
    looked = substring_lookup(alone.select("q").distinct(), known.groupBy("name").agg(F.min("author_id").alias("ord")), limit)
    people = alone.join(looked, "q").select("one", "name").distinct().join(known, "name").select("one", F.lit("author").alias("mode"), F.col("author_id").cast(kind).alias("ord"), F.col("name").alias("found"))
    cited = F.when(F.trim("k.title") != "", F.col("k.title")).when(F.trim("k.author") != "", F.col("k.author")).otherwise(F.col("k.canonical_author"))
    scored = score_expr(met.unionByName(people).join(one.select("one", cited.alias("cited")), "one"), "cited", "found")
    # An author may be listed under several names.
    best = kept(scored.groupBy("one", "mode", "ord").agg(F.max("score").alias("score")))
    return same.join(one, "k").select("id", "one").join(best, "one").drop("one")


def score_expr(df: DataFrame, a: str, b: str, out: str = "score") -> DataFrame:
    """``out``: 0..100, similarity of two texts with their words in alphabetical order."""

    @F.pandas_udf("int")
    def scored(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([(100 if p == q else int(100 * SequenceMatcher(None, p, q).ratio())) if p and q else 0 for p, q in zip(x, y)], dtype="int32")

    return df.withColumn(out, scored(token_sort(F.coalesce(F.col(a), F.lit(""))), token_sort(F.coalesce(F.col(b), F.lit("")))))


def best_candidates(scored: DataFrame, k: int = 5) -> DataFrame:
    """At most ``k`` candidates of a citation; in score order only if there are more."""
    n = F.count("*").over(W.partitionBy("id"))
    rank = F.row_number().over(W.partitionBy("id").orderBy(F.desc("score"), "ord"))
    return scored.withColumns({"n": n, "rank": rank}).where(F.col("rank") <= k).drop("n")


def gate(scored: DataFrame, config: PipelineConfig = PipelineConfig()) -> DataFrame:
    """``(id, ord, decision)``: accepted outright, as the only good one, by the default adjudicator, or none."""
    w = W.partitionBy("id").orderBy(F.desc("score"), "ord")
    ranked = scored.withColumns({
        "rn": F.row_number().over(w), "second": F.lead("score", 1, 0).over(w),
        "good": F.sum((F.col("score") > config.single_score).cast("int")).over(W.partitionBy("id")),
    }).where("rn = 1")
    decision = (
        F.when(F.col("score") > config.accept_score, "accepted")
        .when((F.col("good") == 1) & (F.col("score") - F.col("second") > config.single_gap), "single")
        .when(F.col("score") > config.single_score, "adjudicated")
        .otherwise("none")
    )
    return ranked.select("id", F.when(decision != "none", F.col("ord")).alias("ord"), "score", decision.alias("decision"))


def match_type(title: Column, catalog: Column, person: Column) -> Column:
    """Kind of the match from what either source found."""
    book = F.trim(F.coalesce(title, F.lit(""))) != ""
    return F.when(book & catalog.isNotNull(), "book").when(~book & catalog.isNotNull(), "author").when(~book & person.isNotNull(), "person").otherwise("not_found")


def alias_variants(cites: DataFrame, aliases: DataFrame, id_col: str = "cit_id") -> DataFrame:
    """``cites`` with ``variants``: the author's canonical name, then its other variants, title-cased, each once.

    ``aliases``: ``(variant_lower, canonical)``.  The author itself is no variant.
    """
    dim = aliases.groupBy(F.lower("variant_lower").alias("v")).agg(F.min("canonical").alias("c"))
    names = cites.select("author").where("author <> ''").distinct().withColumn("low", F.lower("author"))
    named = names.join(dim.select(F.col("v").alias("low"), F.col("c").alias("canon")), "low", "left")
    main = named.where("canon IS NOT NULL AND lower(canon) <> low").select("author", F.col("canon").alias("name"), F.lit("").alias("at"))
    others = named.withColumn("k", F.lower(F.coalesce("canon", "author"))).join(dim.select(F.lower("c").alias("k"), "v"), "k").where("v <> low").select("author", title_case(F.col("v")).alias("name"), F.concat(F.lit("1"), "v").alias("at"))
    each = main.unionByName(others).where(F.lower("name") != F.lower("author")).groupBy("author", F.lower("name").alias("l")).agg(F.min(F.struct("at", "name")).alias("b"))
    packed = each.groupBy(F.col("author").alias("_a")).agg(F.transform(F.array_sort(F.collect_list("b")), lambda b: b["name"]).alias("variants"))
    return cites.join(packed, F.col("author") == F.col("_a"), "left").drop("_a").withColumn("variants", F.coalesce("variants", F.array().cast("array<string>")))


def basic_queries(cites: DataFrame, attempt: int) -> DataFrame:
    """Default of the retry: the full author, then the last name, the title with both."""
    t, a = F.trim(F.coalesce("title", F.lit(""))), F.trim(F.coalesce("author", F.lit("")))
    rules = F.array(F.struct(F.lit(1).alias("n"), a.alias("a")), F.struct(F.lit(2).alias("n"), last_name(a).alias("a")))
    rows = cites.select("cit_id", F.nullif(t, F.lit("")).alias("q_title"), F.explode(rules).alias("r")).where("r.a <> ''")
    return rows.select("cit_id", F.col("r.n").alias("query_no"), "q_title", F.col("r.a").alias("q_author"))


def fuzzy_adjudicator(ambiguous: DataFrame, config: PipelineConfig) -> DataFrame:
    """Default of the choice between near candidates ``(id, ord, score, pos)``: the best one above the score of a single winner."""
    best = F.row_number().over(W.partitionBy("id").orderBy(F.desc("score"), "pos"))
    return ambiguous.withColumn("_b", best).where((F.col("_b") == 1) & (F.col("score") > config.single_score)).select("id", "ord", "score")


Rewriter = Callable[[DataFrame, int], DataFrame]
Adjudicator = Callable[[DataFrame, PipelineConfig], DataFrame]


def choose(cands: DataFrame, config: PipelineConfig, adjudicator: Adjudicator) -> DataFrame:
    """``(id, ord, score, decision)`` of candidates ``(id, ord, pos, score)``: the five best, the gate, then the adjudicator.

    Up to five candidates keep their order; of more the five of highest score remain.
    """
    by = W.partitionBy("id")
    top = cands.withColumns({"n": F.count("*").over(by), "r": F.row_number().over(by.orderBy(F.desc("score"), "pos"))}).where("n <= 5 OR r <= 5")
    ranked = top.withColumns({
        "r": F.row_number().over(by.orderBy(F.desc("score"), "pos")), "second": F.lead("score", 1, 0).over(by.orderBy(F.desc("score"), "pos")),
        "good": F.sum((F.col("score") > config.single_score).cast("int")).over(by),
    })
    clear = F.when(F.col("score") > config.accept_score, "accepted").when((F.col("good") == 1) & (F.col("score") > config.single_score) & (F.col("score") - F.col("second") > config.single_gap), "single")
    first = kept(ranked.withColumn("decision", F.when(F.col("r") == 1, clear)))
    sure = first.where("decision IS NOT NULL").select("id", "ord", "score", "decision")
    rest = first.join(sure.select("id"), "id", "left_anti").select("id", "ord", "score", "pos")
    return sure.unionByName(adjudicator(rest, config).withColumn("decision", F.lit("adjudicated")))


def resolve(
    cites: DataFrame, books: DataFrame, authors: DataFrame, people: DataFrame, aliases: DataFrame | None = None, overrides: DataFrame | None = None,
    config: PipelineConfig = PipelineConfig(), rewriter: Rewriter = basic_queries, adjudicator: Adjudicator = fuzzy_adjudicator,
) -> DataFrame:
    """``(cit_id, match_type, book_id, author_id, page_id, score, decision, pass_no)``: one row per citation.

    Every citation is searched with its expanded queries: titled ones among the
    books, untitled ones among the authors, both among the people pages.  The five
    best candidates of a source go through the gate, what is not clear to the
    ``adjudicator``.  Citations that find no book (titled) or nothing (untitled) are
    searched again with the queries of the ``rewriter``, ``config.retries`` times at most.

    ``cites``: ``(cit_id, title, author, canonical_author)``; ``books``: ``(book_id,
    title, authors array<string>)``; ``authors``: ``(author_id, name)``; ``people``:
    ``(page_id, title, birth_year, death_year)``.
    """
    blank = F.lit("")
    base = cites.select("cit_id", F.coalesce("title", blank).alias("title"), F.coalesce("author", blank).alias("author"), "canonical_author")
    base = kept(alias_variants(base, aliases) if aliases is not None else base.withColumn("variants", F.array().cast("array<string>")))
    todo, out, attempt = base, None, 0
    names = kept(authors.where("name IS NOT NULL AND author_id IS NOT NULL").groupBy("name").agg(F.min("author_id").alias("ord")))
    shelf = books.select(F.col("book_id").alias("doc"), F.col("title").alias("d_title"), F.col("authors").alias("d_authors"))
    while True:
        asked = expand_queries(todo) if attempt == 0 else rewriter(todo, attempt)
        asked = kept(asked.join(todo.select("cit_id", (F.trim("title") != "").alias("titled")), "cit_id"))
        # Equal queries of many citations are searched once.
        texts = asked.where("titled").select(F.struct("q_title", "q_author").alias("q"), "q_title", "q_author").distinct()
        by_title = asked.where("titled").withColumn("q", F.struct("q_title", "q_author")).join(record_hits(texts, shelf, config.search_limit), "q").select("cit_id", "query_no", "rank", F.col("doc").alias("ord"))
        by_title = by_title.join(books.select(F.col("book_id").alias("ord"), F.col("title").alias("found")), "ord").withColumn("source", F.lit("books"))
        lone = asked.where("NOT titled").withColumn("q", F.coalesce("q_author", "q_title"))
        by_name = lone.join(substring_lookup(lone.select("q").distinct(), names, config.search_limit), "q").join(names, "name").select("ord", "cit_id", "query_no", "rank", F.col("name").alias("found")).withColumn("source", F.lit("authors"))
        who = asked.where("q_author <> ''").withColumnRenamed("q_author", "q")
        pages = find_people(who.select("q").distinct(), people, overrides, config.search_limit)
        by_page = who.join(pages, "q").select(F.col("page_id").alias("ord"), "cit_id", "query_no", "rank", F.col("title").alias("found")).withColumn("source", F.lit("people"))
        # Each candidate once, at its first place; scored against the cited title, or the author.
        hits = by_title.unionByName(by_name).unionByName(by_page).groupBy("cit_id", "source", "ord").agg(F.min(F.struct("query_no", "rank", "found")).alias("at"))
        hits = hits.join(todo.select("cit_id", F.when(F.trim("title") != "", F.col("title")).otherwise(F.col("author")).alias("cited")), "cit_id").select("cit_id", "source", "ord", "cited", "at.*")
        place = F.row_number().over(W.partitionBy("cit_id", "source").orderBy("query_no", "rank", "ord"))
        scored = kept(score_expr(hits, "cited", "found").select(F.struct("cit_id", "source").alias("id"), "ord", "score", place.alias("pos")))
        got = choose(scored, config, adjudicator).select("id.cit_id", "id.source", "ord", "score", "decision")
        pick = lambda src, c: F.max(F.when(F.col("source") == src, F.col(c)))
        per = got.groupBy("cit_id").agg(
            pick("books", "ord").alias("book_id"), pick("authors", "ord").alias("author_id"), pick("people", "ord").alias("page_id"),
            F.coalesce(pick("books", "score"), pick("authors", "score"), pick("people", "score")).alias("score"),
            F.coalesce(pick("books", "decision"), pick("authors", "decision"), pick("people", "decision")).alias("decision"),
        )
        kind = match_type(F.col("title"), F.coalesce("book_id", "author_id"), F.col("page_id")).alias("match_type")
        now = kept(todo.join(per, "cit_id", "left").select("cit_id", kind, "book_id", "author_id", "page_id", "score", "decision", F.lit(attempt + 1).alias("pass_no")))
        last = attempt >= (min(config.retries, 1) if rewriter is basic_queries else config.retries)
        done = now if last else now.where("match_type <> 'not_found'")
        out = done if out is None else out.unionByName(done)
        if last:
            return out
        todo, attempt = kept(todo.join(done.select("cit_id"), "cit_id", "left_anti")), attempt + 1
