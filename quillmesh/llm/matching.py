"""Problem 3: matching mentions to catalogue works without a common key.

A mention is a distinct pair of a parsed author and a title key; works are the
catalogue's ``work_id`` groups plus records without one.  A mention and a work
are candidates if the author stems are within edit distance (trie join) and the
titles share a word.  Each candidate pair is a binary variable with prior odds from
title, author and year; factors tie the variables together:

* a mention refers to at most one work;
* a work answers to one author identity: mentions under different surnames
  compete for it (softly, as a misspelt surname is not another person).

Loopy belief propagation: variables and factors exchange odds through grouped sums
and joins until no marginal moves by more than ``TOLERANCE``.  Messages that no
loop can change are computed once; only the mentions that have a choice and
compete for a work take part in the rounds.  The marginal probability is the
confidence of the match.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Stages, blank
from .names import parse_name
from .titles import title_key
from .triejoin import EXACT, trie_match

TOLERANCE = 1e-3
ACCEPT = 0.5
#: How strongly mentions under other surnames compete for a work.
COMPETITION = 0.02
#: Surnames under which two given names must share a title to count as short for one another.
ALIAS_SUPPORT = 2
#: Titles in reach of one surname that all its mentions are compared with; more are met by their words.
SHELF = 1024


def readings(name: str | None, listed: bool = False) -> str:
    """The readings of a name, one a line: kind, stem and lead, separated by tabs.

    A cited name whose word order is open has a reading for either order, which
    between them meet a ``listed`` one in whatever order that is; capitals are
    read as an acronym too, and organisations have their initials.
    """
    n = parse_name(name)
    if n.kind == "none":
        return ""
    out = [(n.kind, n.stem, n.lead)]
    if n.kind == "org":
        out += [("letters", EXACT + a, n.stem) for a in n.acro.split()]
    else:
        if n.ostem and not listed:
            out.append(("person", n.ostem, n.olead))
        if n.acro:
            out.append(("letters", EXACT + n.acro, n.place))
    return "\n".join("\t".join(r) for r in out)


def with_readings(df: DataFrame, col: str, listed: bool = False, out: str = "forms") -> DataFrame:
    """``df`` with the :func:`readings` of a column; '' for names of nobody."""

    @F.pandas_udf("string")
    def read(names: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in names:
            known = {x: readings(x, listed) for x in s.dropna().unique()}
            yield s.map(known).fillna("")

    return df.withColumn(out, read(F.col(col)))


def _spread(df: DataFrame, *cols: str) -> DataFrame:
    """``cols, kind, stem, lead``: a row for each reading in ``forms``."""
    parts = F.split(F.col("r"), "\t")
    return df.where("forms <> ''").select(*cols, F.explode(F.split("forms", "\n")).alias("r")).select(
        *cols, parts.getItem(0).alias("kind"), parts.getItem(1).alias("stem"), parts.getItem(2).alias("lead")
    )


def _words(c: Column) -> Column:
    """Hashes of the words of a title key that can bring a pair together, and of the key itself.

    Words of four letters and more; all words of a title with fewer than two such.
    """
    words = F.split(c, " ")
    long_ = F.filter(words, lambda w: F.length(w) >= 4)
    return F.array_distinct(F.transform(F.array_append(F.when(F.size(long_) >= 2, long_).otherwise(words), c), lambda w: F.hash(w)))


def catalogue_works(st: Stages, meta: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(records, authors, titles)`` of the catalogue.

    ``records``: ``(work, book_id)``, repeats left in; ``authors``: ``(work, l_kind, l_stem, l_lead)``,
    all forms under which the first author is listed anywhere; ``titles``: ``(work,
    wkey)``.  A record without ``work_id`` goes to the one work with its
    title and author, else records with equal title and author form a work.
    """
    rec = meta.where(F.col("book_id").isNotNull()).select(
        "book_id", "work_id", title_key(F.coalesce(F.when(~blank(F.col("title")), F.col("title")), F.col("title_without_series"))).alias("wkey"), F.expr("try_element_at(authors, 1)").alias("first"),
    )
    rec = st.cut(with_readings(rec.select("book_id", "work_id", "wkey", F.col("first.author_id").alias("aid"), F.col("first.name").alias("name")), "name", listed=True).drop("name"))
    lone = rec.where("work_id IS NULL")
    named = _spread(lone.where("wkey IS NOT NULL"), "book_id", "wkey").distinct()
    known = _spread(rec.where("work_id IS NOT NULL").join(named.select("wkey").distinct(), "wkey", "left_semi"), "work_id", "wkey").withColumnRenamed("lead", "l").distinct()
    home = named.join(known, ["wkey", "kind", "stem"]).where("l = lead OR substring(l, 1, 1) = lead OR l = substring(lead, 1, 1)")
    home = home.groupBy("book_id").agg(F.countDistinct("work_id").alias("n"), F.min("work_id").alias("home")).where("n = 1").select("book_id", "home")
    own = named.groupBy("book_id").agg(F.min(F.concat_ws("|", F.lit("-"), "wkey", "kind", "stem", "lead")).alias("own"))
    lone = lone.join(home, "book_id", "left").join(own, "book_id", "left").withColumn("work", F.coalesce("home", "own", F.concat(F.lit("-"), F.col("book_id").cast("string"))))
    cols = ("work", "book_id", "wkey", "aid", "forms")
    rec = rec.where("work_id IS NOT NULL").withColumn("work", F.col("work_id")).select(*cols).unionByName(st.cut(lone.select(*cols)))
    # An author id lends every form that it is listed under.
    by_id = rec.where("aid IS NOT NULL AND forms <> ''").select("aid", "forms").distinct()
    lent = rec.where("aid IS NOT NULL").select("work", "aid").distinct().join(by_id, "aid").select("work", "forms")
    authors = _spread(rec.select("work", "forms").unionByName(lent), "work").select("work", F.col("kind").alias("l_kind"), F.col("stem").alias("l_stem"), F.col("lead").alias("l_lead")).distinct()
    titles = rec.where("wkey IS NOT NULL").select("work", "wkey").distinct()
    return rec.select("work", "book_id"), st.cut(authors), st.cut(titles)


def _scored_titles(pairs: DataFrame) -> DataFrame:
    """``pairs (key, wkey, ...)`` with ``t``, the evidence of the titles; null if they contradict."""
    a, b, padded = F.split("key", " "), F.split("wkey", " "), lambda c: F.concat(F.lit(" "), F.col(c), F.lit(" "))
    pairs = pairs.withColumns({
        "close": 1 - F.levenshtein("key", "wkey") / F.greatest(F.length("key"), F.length("wkey")),
        # One title within the other, if it has two words or more.
        "part": ((F.instr("key", " ") > 0) & (F.instr("wkey", " ") > 0)) & (padded("wkey").contains(padded("key")) | padded("key").contains(padded("wkey"))),
        # The same words in another order, or all but one of the words.
        "common": F.size(F.array_intersect(a, b)) / F.greatest(F.size(F.array_distinct(a)), F.size(F.array_distinct(b))),
    })
    c = F.col("close")
    return pairs.withColumn("t", F.when(F.col("key") == F.col("wkey"), 3.5).when(c >= 0.9, 2.5).when(F.col("part"), 1.5).when(c >= 0.8, 1.5).when((c >= 0.7) | (F.col("common") >= 0.75), 0.5))


def _lead_score() -> Column:
    """Evidence of the given name, or of the place of an acronym; null if it contradicts."""
    typed, listed = F.col("lead"), F.col("l_lead")
    short = (F.length(typed) == 1) | (F.length(listed) == 1)
    near = F.when(F.least(F.length(typed), F.length(listed)) < 5, 1).otherwise(2)
    apart = F.levenshtein(typed, listed)
    letters = F.col("kind") == "letters"
    return (
        F.when(letters & ((typed == "") | (apart <= 2)), 2.0).when(letters, None)
        .when((typed == "") | (listed == ""), 0.0).when(typed == listed, 2.0)
        .when(short & (F.substring(typed, 1, 1) == F.substring(listed, 1, 1)), 1.0)
        .when(~short & (apart <= near), 1.0).when(~short & (F.col("kind") == "org") & (apart <= 4), 0.5).when(F.col("alias").isNotNull(), 1.0)
    )


def propagate(st: Stages, edges: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """``(m, w, p)``: marginal probabilities of ``edges (m, w, slot, odds)``, each pair once.

    Messages are odds ratios.  To a mention's variable: ``1 / (1 + sum of its other
    candidates)``.  To a work's: ``1 / (1 + COMPETITION * sum over the other slots of
    their best)``.  The second is one for works with a single slot, the first for
    mentions with a single candidate, so only edges of mentions with a choice among
    competed works change from round to round.  The weight of the old message grows
    with the rounds, so that the messages settle even where plain updates would swing.
    """
    slots = edges.groupBy("w", "slot").agg(F.max("odds").alias("top")).groupBy("w").agg(F.count("*").alias("k")).where("k > 1").select("w", F.lit(True).alias("many"))
    of_m = W.partitionBy("m")
    base = edges.join(slots, "w", "left").withColumns({"many": F.col("many").isNotNull(), "n": F.count("*").over(of_m), "rest": F.sum("odds").over(of_m) - F.col("odds")})
    base = st.cut(base.withColumn("live", (F.col("n") > 1) & F.max("many").over(of_m)))
    fixed = base.where("NOT live AND many").groupBy("w", "slot").agg(F.max("odds").alias("best"))
    state = st.cut(base.where("live").select("m", "w", "slot", "many", "odds", F.lit(1.0).alias("from_m"), F.lit(1.0).alias("from_w"), (F.col("odds") / (1 + F.col("odds"))).alias("p")))
    # The fixed part of the works that live edges touch.
    held = st.cut(fixed.join(state.where("many").select("w").distinct(), "w", "left_semi"))

    def to_works(v: Column, now: DataFrame) -> DataFrame:
        """``(w, slot, from_w)`` for the messages ``v`` of the live edges ``now`` and the fixed ones."""
        best = now.where("many").select("w", "slot", v.alias("best")).unionByName(held).groupBy("w", "slot").agg(F.max("best").alias("best"))
        others = F.sum("best").over(W.partitionBy("w")) - F.col("best")
        return best.select("w", "slot", (1 / (1 + COMPETITION * F.greatest(others, F.lit(0.0)))).alias("new_w"))

    rounds = 0
    while True:
        keep = min(0.5, 0.1 * rounds)
        mixed = lambda old, new: F.pow(F.col(old), F.lit(keep)) * F.pow(new, F.lit(1 - keep))
        u = F.col("odds") * F.col("from_w")
        heard = state.join(to_works(F.col("odds") * F.col("from_m"), state), ["w", "slot"], "left").withColumn("new_m", 1 / (1 + F.greatest(F.sum(u).over(of_m) - u, F.lit(0.0))))
        nxt = heard.select("m", "w", "slot", "many", "odds", mixed("from_m", F.col("new_m")).alias("from_m"), mixed("from_w", F.coalesce("new_w", F.lit(1.0))).alias("from_w"), F.col("p").alias("old"))
        belief = F.col("odds") * F.col("from_m") * F.col("from_w")
        nxt = st.cut(nxt.withColumn("p", belief / (1 + belief)))
        moved = nxt.agg(F.max(F.abs(F.col("p") - F.col("old")))).first()[0]
        st.drop(state)
        state, rounds = nxt, rounds + 1
        if moved is None or moved < tolerance:
            break
    final = to_works(F.col("odds") * F.col("from_m"), state).unionByName(
        # Works that no live edge touches.
        fixed.join(held.select("w").distinct(), "w", "left_anti").withColumn("new_w", 1 / (1 + COMPETITION * F.greatest(F.sum("best").over(W.partitionBy("w")) - F.col("best"), F.lit(0.0)))).drop("best")
    )
    calm = base.where("NOT live").select("m", "w", "slot", (F.col("odds") / (1 + F.greatest("rest", F.lit(0.0)))).alias("b")).join(final, ["w", "slot"], "left")
    calm = calm.withColumn("b", F.col("b") * F.coalesce("new_w", F.lit(1.0))).select("m", "w", (F.col("b") / (1 + F.col("b"))).alias("p"))
    return calm.unionByName(state.select("m", "w", "p"))


def match_mentions(cites: DataFrame, meta: DataFrame, accept: float = ACCEPT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(rows, matches, records)``.

    ``rows``: ``(raw_id, m)``; ``matches``: ``(m, work, confidence)`` with confidence of
    at least ``accept``; ``records``: ``(work, book_id)``.  Null or blank titles and
    authors match nothing; equal mentions share one result; repeated deliveries
    change nothing; an empty table on either side gives no matches.
    """
    st = Stages(cites.sparkSession)
    told = F.regexp_extract("citation_excerpt", r"[\(\[, ](\d{3,4})[\)\]]?$", 1)
    rows = cites.where(F.col("raw_id").isNotNull() & ~blank(F.col("author")) & ~blank(F.col("title"))).select("raw_id", "author", title_key(F.col("title")).alias("key"), told.alias("y"))
    rows = with_readings(rows, "author")
    m = F.unhex(F.md5(F.concat_ws("\x01", "key", "forms"))).alias("m")
    rows = st.cut(rows.select("raw_id", "key", "y", "forms")).where("key IS NOT NULL AND forms <> ''")
    mentions = st.cut(_spread(rows.select("key", "forms").distinct().select(m, "key", "forms"), "m", "key"))
    rows = rows.select("raw_id", "y", m)
    records, authors, titles = catalogue_works(st, meta)
    # -- stems in reach ------------------------------------------------------------------------
    cited, listed = mentions.select("stem").distinct(), authors.select(F.col("l_stem").alias("stem")).distinct()
    near = trie_match(cited, listed).select(F.col("a").alias("stem"), F.col("b").alias("l_stem"), "d")
    near = near.unionByName(cited.join(listed, "stem").select("stem", F.col("stem").alias("l_stem"), F.lit(0).alias("d")))
    near = st.cut(near)
    # -- pairs of (stem, title): scored once for all mentions that have them ------------------
    shelf = near.join(authors.select("l_stem", "work").distinct(), "l_stem").select("stem", "work").distinct().join(titles.withColumn("ww", _words(F.col("wkey"))), "work")
    shelf = st.cut(shelf.withColumn("hot", F.count("*").over(W.partitionBy("stem")) > SHELF))
    # Readings without a listed stem in reach end here.
    mentions = st.cut(mentions.join(shelf.groupBy("stem").agg(F.max("hot").alias("hot")), "stem"))
    asked = mentions.select("stem", "key", "hot").distinct().withColumn("kw", _words(F.col("key")))
    few = asked.where("NOT hot").drop("hot").join(shelf.where("NOT hot").drop("hot"), "stem").where(F.arrays_overlap("kw", "ww"))
    # Stems with more titles in reach: the titles meet by the words, each pair at the first it shares.
    by_word = asked.where("hot").withColumn("word", F.explode("kw")).join(shelf.where("hot").drop("hot").withColumn("word", F.explode("ww")), ["stem", "word"])
    by_word = by_word.where(F.col("word") == F.array_min(F.array_intersect("kw", "ww")))
    met = _scored_titles(few.unionByName(by_word.select(*few.columns)).drop("kw", "ww")).where("t IS NOT NULL").groupBy("stem", "key", "work").agg(F.max("t").alias("t"))
    # -- mentions and works: the names ------------------------------------------------------------
    cand = mentions.join(met, ["stem", "key"]).select("m", "kind", "stem", "lead", "work", "t").join(near, "stem")
    cand = st.cut(cand.join(authors.withColumnRenamed("l_kind", "kind"), ["l_stem", "work", "kind"]).drop("l_stem"))
    for done in (shelf, near, authors, titles, mentions):
        st.drop(done)
    # Given names that are short for one another share surnames and titles.
    alias = cand.where("kind = 'person' AND d = 0 AND t >= 2.5 AND length(lead) > 1 AND length(l_lead) > 1 AND levenshtein(lead, l_lead) > 2").groupBy("lead", "l_lead").agg(F.countDistinct("stem").alias("k"))
    alias = st.cut(alias.where(F.col("k") >= ALIAS_SUPPORT).select("lead", "l_lead", F.lit(True).alias("alias")))
    score = 1.0 - 1.5 * F.col("d") + _lead_score() + F.col("t")
    scored = cand.join(alias, ["lead", "l_lead"], "left").select("m", "work", "stem", score.alias("score")).where("score IS NOT NULL")
    edges = st.cut(scored.groupBy("m", "work").agg(F.max("score").alias("score"), F.max_by("stem", F.struct("score", "stem")).alias("slot")))
    st.drop(cand)
    # The year a row gives is worth little, as it may be another edition's; it breaks ties.
    torn = edges.withColumn("n", F.count("*").over(W.partitionBy("m"))).where("n > 1").select("m", "work")
    said = rows.where("y <> ''").select("m", F.col("y").cast("int").alias("y")).distinct().join(torn, "m")
    years = meta.where("publication_year BETWEEN -3000 AND 2100 AND publication_year <> 0").select("book_id", F.col("publication_year").alias("y")).join(records, "book_id").select("work", "y").distinct()
    agree = said.join(years, ["work", "y"]).select("m", "work").distinct().withColumn("year", F.lit(1.0))
    odds = edges.join(agree, ["m", "work"], "left").select("m", F.col("work").alias("w"), "slot", F.exp(F.col("score") + F.coalesce("year", F.lit(0.0))).alias("odds"))
    marginals = propagate(st, st.cut(odds))
    matches = marginals.where(F.col("p") >= accept).select("m", F.col("w").alias("work"), F.col("p").alias("confidence"))
    return rows.select("raw_id", "m"), matches, records


def matched_records(cites: DataFrame, meta: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """``(raw_id, book_id, confidence)``: every record of the work that a row cites."""
    rows, matches, records = match_mentions(cites, meta, accept)
    return rows.join(matches, "m").join(records, "work").groupBy("raw_id", "book_id").agg(F.max("confidence").alias("confidence"))
