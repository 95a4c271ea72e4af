"""Problem 1: spellings of one person or organisation.

1. Distinct spellings are parsed (:mod:`names`) into *cores*: stem, lead and how
   much of the lead is given.  Word order that the form leaves open is settled by
   the corpus: which of the two words is more often a surname, which a given name.
   Capitals are an acronym if an organisation written out somewhere has these initials.
2. A trie join (:mod:`triejoin`) over the distinct stems and leads enumerates
   neighbours within edit distance.
3. Given names that are short for one another are learned: two leads that stand
   with one and the same surname and work under several surnames.
4. Full cores are linked where a row names both, where they share works, or where
   a rarer one is a slip of a more frequent one and nothing speaks against it.
   Connected cores are an entity.
5. Cores with an initial, without a lead, or with an acronym join the entities
   they share works with, else the only entity in reach.

All weights compare two cores with one another, so that they don't shift with the
size of the corpus.  All steps are joins of distinct values, so a name that a third
of all rows use costs as much as any other.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Stages
from .names import SOUND, Name, parse_name
from .titles import title_key
from .triejoin import EXACT, neighbours

_FIELDS = ["spelling", *Name._fields]
_FORM = ", ".join(f"{f} {'int' if f == 'level' else 'string'}" for f in _FIELDS)
#: Surnames under which two given names must share a work to count as short for one another.
ALIAS_SUPPORT = 2
#: Times as many rows and shapes a name must have for another to pass as its slip.
SLIP = 4


def parse_spellings(spellings: DataFrame, col: str = "spelling") -> DataFrame:
    """The parsed form of each distinct spelling; values that name nobody are left out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(s, *n) for s in pdf["spelling"] if (n := parse_name(s)).kind != "none"]
            yield pd.DataFrame(rows, columns=_FIELDS)

    return spellings.select(F.col(col).alias("spelling")).where(F.col("spelling").isNotNull()).distinct().mapInPandas(run, _FORM)


def vocabulary(forms: DataFrame) -> DataFrame:
    """``(s)``: every string that may be a stem, a lead or the place of an acronym."""
    lead = F.when(F.col("level") == 2, F.col("lead"))
    strings = F.array_distinct(F.array("stem", lead, sounded(lead), "ostem", "olead", sounded(F.col("olead")), "place"))
    return forms.select(F.explode(strings).alias("s")).where("s <> ''").distinct()


def sounded(c: Column) -> Column:
    """As :func:`names.sound`."""
    for group, alike in SOUND:
        c = F.replace(c, F.lit(group), F.lit(alike))
    return F.regexp_replace(c, r"(.)\1+", "$1")


def settle(forms: DataFrame, near: DataFrame, listed: DataFrame) -> DataFrame:
    """Forms with their word order and kind settled: ``spelling, kind, stem, lead, level, shape, acro``.

    ``listed``: parsed names that count as written out besides the forms.
    """
    full = forms.where("kind = 'person' AND level = 2").withColumns({"lead": sounded(F.col("lead")), "olead": sounded(F.col("olead"))})
    # How often a word is a surname or a given name; forms of one reading count threefold.
    sure = F.when(F.col("ostem") == "", 3).otherwise(1)
    roles = full.select("shape", F.explode(F.array(F.struct(F.col("stem").alias("t"), sure.alias("s"), F.lit(0).alias("l")), F.struct(F.col("lead").alias("t"), F.lit(0).alias("s"), sure.alias("l")))).alias("r"))
    roles = roles.groupBy("r.t").agg(F.sum("r.s").alias("s"), F.sum("r.l").alias("l"))
    smooth = near.where("d <= 1").join(roles, F.col("b") == F.col("t")).groupBy("a").agg(((F.sum("s") + 0.5) / (F.sum("l") + 0.5)).alias("odds"))
    asked = full.where("ostem <> ''").select("spelling", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(c).alias("a")) for i, c in enumerate(("stem", "lead", "ostem", "olead"))])).alias("q")).select("spelling", "q.*")
    # The odds that a word is a surname, for the stems; against it, for the leads.
    pick = lambda i: F.coalesce(F.max(F.when(F.col("i") == i, F.col("odds"))), F.lit(1.0))
    swap = asked.join(smooth, "a", "left").groupBy("spelling").agg((pick(2) / pick(3) > 2 * pick(0) / pick(1)).alias("swap")).where("swap").select("spelling", "swap")
    # Acronyms of organisations that are written out, near the place if one is named.
    orgs = forms.unionByName(listed).where("kind = 'org'").select("stem", F.explode(F.split("acro", " ")).alias("acro")).distinct()
    caps = forms.where("kind = 'person' AND acro <> ''").select("spelling", "acro", "place").join(orgs, "acro").join(near.select(F.col("a").alias("place"), F.col("b").alias("stem"), "d"), ["place", "stem"], "left")
    short = caps.where("place = '' OR d IS NOT NULL").select("spelling", F.lit(True).alias("short")).distinct()
    is_short, swapped = F.col("short").isNotNull(), F.col("swap").isNotNull()
    return forms.join(swap, "spelling", "left").join(short, "spelling", "left").select(
        "spelling",
        F.when(is_short, "short").otherwise(F.col("kind")).alias("kind"),
        F.when(is_short, F.col("place")).when(swapped, F.col("ostem")).otherwise(F.col("stem")).alias("stem"),
        F.when(is_short, F.col("acro")).when(swapped, F.col("olead")).otherwise(F.col("lead")).alias("lead"),
        F.when(is_short, 1).otherwise(F.col("level")).alias("level"), "shape",
        F.when(is_short | (F.col("kind") == "org"), F.col("acro")).alias("acro"),
    )


class Resolved(NamedTuple):
    forms: DataFrame  # spelling, kind, stem, lead, level, shape, acro, core
    cores: DataFrame  # core, kind, stem, lead, level, acro, shapes, rows, n_works
    members: DataFrame  # core, entity
    seen: DataFrame  # core, work, n: works cited more than once


def connected(st: Stages, nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``(x, root)``: the smallest node each node ``x`` is connected with by ``links (x, y)``.

    Labels spread over the links and jump along pointers until none moves.
    """
    both = st.cut(links.select(F.explode(F.array(F.struct("x", "y"), F.struct(F.col("y").alias("x"), F.col("x").alias("y")))).alias("l")).select("l.*").distinct())
    # Nodes without links are their own roots and take no part in the rounds.
    label = both.groupBy("x").agg(F.min("y").alias("y")).select("x", F.least("x", "y").alias("root"))
    made: list[DataFrame] = []
    while True:
        label = st.cut(label)
        made.append(label)
        heard = both.join(label.select(F.col("x").alias("y"), F.col("root").alias("h")), "y").groupBy("x").agg(F.min("h").alias("h"))
        step = label.join(heard, "x").select("x", F.col("root").alias("was"), F.least("root", "h").alias("root"))
        hop = label.select(F.col("x").alias("root"), F.col("root").alias("top"))
        nxt = st.cut(step.join(hop, "root", "left").select("x", "was", F.least("root", F.coalesce("top", "root")).alias("root")))
        if not nxt.where("was <> root").take(1):
            break
        label = nxt.drop("was")
    return nodes.join(nxt.select("x", "root"), "x", "left").select("x", F.coalesce("root", "x").alias("root"))


def resolve(st: Stages, spellings: DataFrame, works: DataFrame, links: DataFrame, listed: DataFrame | None = None) -> Resolved:
    """Parsed spellings with their core, and the entities of the cores.

    ``spellings``: ``(spelling, n)`` with the rows of each; ``works``: ``(spelling,
    work, n)``, what rows cite under a spelling; ``links``: ``(a, b)``, spellings that one
    row uses for the same entity; ``listed``: parsed names of a reference list, whose
    organisations give acronyms too.  A core may be a member of several entities
    ("J. Smith"); cores without any stay their own.
    """
    parsed = st.cut(parse_spellings(spellings))
    listed = parsed.limit(0) if listed is None else listed
    near = st.cut(neighbours(vocabulary(parsed.unionByName(listed)), "s"))
    forms = st.cut(settle(parsed, near, listed).withColumn("core", F.concat_ws("|", "kind", "stem", "lead")))
    core_of = forms.select("spelling", "core")
    seen = works.join(core_of, "spelling").groupBy("core", "work").agg(F.sum("n").alias("n"))
    # A title typed once anywhere says nothing about whose it is.
    common = seen.groupBy("work").agg(F.sum("n").alias("m")).where("m > 1").select("work")
    seen = st.cut(seen.join(common, "work", "left_semi"))
    weight = seen.groupBy("core").agg(F.sum("n").alias("mass"), F.count("*").alias("n_works"))
    cores = forms.join(spellings, "spelling").groupBy("core", "kind", "stem", "lead", "level").agg(
        F.countDistinct("shape").alias("shapes"), F.first("acro").alias("acro"), F.sum("n").alias("rows")
    )
    cores = st.cut(cores.join(weight, "core", "left").fillna(0, ["mass", "n_works"]))
    side = lambda p, df, *cols: df.select(*[F.col(c).alias(p if c == "core" else f"{p}_{c}") for c in ("core", *cols)])
    nd = lambda a, b, d: near.select(F.col("a").alias(a), F.col("b").alias(b), F.col("d").alias(d))
    full = cores.where("level = 2")
    persons = full.where("kind = 'person'")
    stats = ("kind", "stem", "lead", "shapes", "rows", "mass", "n_works")

    # -- candidates: (x, y, how, d) ------------------------------------------------
    # Each kind is written by itself: all in one plan they hold the driver's memory at the same time.
    close = st.cut(side("x", full, "kind", "stem", "lead").join(nd("x_stem", "y_stem", "ds"), "x_stem").join(nd("x_lead", "y_lead", "dl"), "x_lead").where("ds + dl >= 1").join(
        side("y", full, "kind", "stem", "lead"), ["y_stem", "y_lead"]
    ).where("x_kind = y_kind").select("x", "y", F.lit("close").alias("how"), (F.col("ds") + F.col("dl")).alias("d")))
    # One surname and one work under different given names: each with the most frequent.
    cited = seen.join(persons.select("core", "stem"), "core")
    top = cited.groupBy("stem", "work").agg(F.max_by(F.col("core"), F.struct("n", "core")).alias("y"), F.count("*").alias("k")).where("k > 1")
    star = st.cut(cited.join(top, ["stem", "work"]).where("core <> y").select(F.col("core").alias("x"), "y", "stem").distinct())
    leads = star.join(side("x", persons, "lead"), "x").join(side("y", persons, "lead"), "y").select(F.least("x_lead", "y_lead").alias("u"), F.greatest("x_lead", "y_lead").alias("v"), "stem")
    learned = leads.groupBy("u", "v").agg(F.countDistinct("stem").alias("k")).where(F.col("k") >= ALIAS_SUPPORT).join(near.select(F.col("a").alias("u"), F.col("b").alias("v")), ["u", "v"], "left_anti")
    alias = st.cut(learned.select(F.explode(F.array(F.struct(F.col("u").alias("a"), F.col("v").alias("b")), F.struct(F.col("v").alias("a"), F.col("u").alias("b")))).alias("p")).select("p.*"))
    by_alias = side("x", persons, "stem", "lead").join(alias.select(F.col("a").alias("x_lead"), F.col("b").alias("y_lead")), "x_lead").join(
        side("y", persons, "stem", "lead").withColumnRenamed("y_stem", "x_stem"), ["x_stem", "y_lead"]
    ).select("x", "y", F.lit("alias").alias("how"), F.lit(1).alias("d"))
    # Contractions: letters of the longer name in their order, the first one included ("Saml").
    led = lambda p: side(p, persons, "stem", "lead").select(p, F.col(f"{p}_stem").alias("stem"), F.col(f"{p}_lead").alias(f"{p}_lead"), F.substring(f"{p}_lead", 1, 1).alias("i"))
    letters = F.concat(F.lit("^"), F.regexp_replace("x_lead", "(.)", "$1.*"))
    cut_short = led("x").join(led("y"), ["stem", "i"]).where((F.length("x_lead") >= 2) & (F.length("x_lead") + 1 < F.length("y_lead")) & F.regexp_like("y_lead", letters))
    cut_short = cut_short.select(F.explode(F.array(F.struct("x", "y"), F.struct(F.col("y").alias("x"), F.col("x").alias("y")))).alias("p")).select("p.*", F.lit("alias").alias("how"), F.lit(1).alias("d"))
    short_for = st.cut(by_alias.unionByName(cut_short))
    # Initials: of the given name, or of a name it is short for.
    initials = cores.where("kind = 'person' AND level = 1")
    heads = persons.select("core", "stem", F.substring("lead", 1, 1).alias("i")).unionByName(persons.select("core", "stem", F.col("lead").alias("a")).join(alias, "a").select("core", "stem", F.substring("b", 1, 1).alias("i"))).distinct()
    by_initial = initials.select(F.col("core").alias("x"), F.col("stem").alias("xs"), F.col("lead").alias("i")).join(nd("xs", "ys", "d"), "xs").join(heads.select(F.col("core").alias("y"), F.col("stem").alias("ys"), "i"), ["ys", "i"]).select("x", "y", F.lit("initial").alias("how"), "d")
    short = cores.where("kind = 'short'")
    orgs = full.where("kind = 'org'").select(F.col("core").alias("y"), F.col("stem").alias("ys"), F.explode(F.split("acro", " ")).alias("acro"))
    by_letters = short.select(F.col("core").alias("x"), F.col("stem").alias("xs"), "acro").join(orgs, "acro").join(nd("xs", "ys", "d"), ["xs", "ys"], "left").where("xs = '' OR d IS NOT NULL").select(
        "x", "y", F.lit("initial").alias("how"), F.coalesce("d", F.lit(0)).alias("d")
    )
    bare = cores.where("kind = 'person' AND level = 0")
    by_stem = bare.select(F.col("core").alias("x"), F.col("stem").alias("xs")).join(nd("xs", "ys", "d"), "xs").join(
        persons.unionByName(initials).select(F.col("core").alias("y"), F.col("stem").alias("ys")), "ys"
    ).select("x", "y", F.lit("bare").alias("how"), "d")
    by_initial, lesser = st.cut(by_initial), st.cut(by_letters.unionByName(by_stem))
    told = links.join(core_of.select(F.col("spelling").alias("a"), F.col("core").alias("x")), "a").join(core_of.select(F.col("spelling").alias("b"), F.col("core").alias("y")), "b").where("x <> y")
    gold = told.select(F.explode(F.array(F.struct("x", "y"), F.struct(F.col("y").alias("x"), F.col("x").alias("y")))).alias("l")).select("l.*").groupBy("x", "y").agg(F.count("*").alias("gold"))
    cands = close.unionByName(star.select("x", "y", F.lit("star").alias("how"), F.lit(3).alias("d"))).unionByName(short_for).unionByName(by_initial).unionByName(lesser)
    pairs = st.cut(cands.groupBy("x", "y").agg(F.min_by("how", "d").alias("how"), F.min("d").alias("d")).join(gold, ["x", "y"], "full_outer").fillna({"gold": 0, "how": "told", "d": 4}))
    for done in (close, short_for, by_initial, lesser):
        st.drop(done)
    # -- evidence: works that both are cited for ---------------------------------------
    shared = pairs.select("x", "y").join(seen.select(F.col("core").alias("x"), "work", F.col("n").alias("nx")), "x").join(
        seen.select(F.col("core").alias("y"), "work"), ["y", "work"]
    ).groupBy("x", "y").agg(F.count("*").alias("shared"), F.sum("nx").alias("common"))
    judged = st.cut(
        pairs.join(shared, ["x", "y"], "left").fillna(0, ["shared", "common"]).join(side("x", cores, "level", *stats), "x").join(side("y", cores, "level", *stats), "y")
    )
    # -- full cores: links to names of more weight -----------------------------------------
    rank = lambda p: F.struct(F.col(f"{p}_shapes"), F.col(f"{p}_rows"), F.col(p))
    both_full = judged.where("x_level = 2 AND y_level = 2 AND x_kind = y_kind").where(rank("y") > rank("x"))
    clash = (F.col("x_n_works") > 0) & (F.col("y_n_works") > 0) & (F.col("shared") == 0)
    half = 2 * F.col("common") >= F.col("x_mass")
    proof = (F.col("gold") > 0) | ((F.col("shared") > 0) & (F.col("how").isin("close", "alias") | ((F.col("how") == "star") & half)))
    rare = (F.col("x_shapes") == 1) | ((F.col("x_shapes") * SLIP <= F.col("y_shapes")) & (F.col("x_rows") * SLIP <= F.col("y_rows")))
    slip = (F.col("how") == "close") & (F.col("d") <= 2) & rare & ~clash
    only = F.count(F.when((F.col("how") == "alias") & ~clash, 1)).over(W.partitionBy("x")) == 1
    nick = (F.col("how") == "alias") & ~clash & F.col("only")
    voted = both_full.withColumn("only", only).withColumn("proof", proof).where(F.col("proof") | slip | nick)
    best = F.row_number().over(W.partitionBy("x").orderBy(F.desc("proof"), F.asc("d"), F.desc(F.col("gold") + F.col("shared")), F.desc(rank("y"))))
    # Every link with proof of its own counts; without, the best one.
    strong = (F.col("gold") > 0) | (F.col("proof") & half)
    taken = voted.withColumn("best", best).where((F.col("best") == 1) | strong).select("x", "y")
    members = st.cut(connected(st, full.select(F.col("core").alias("x")), taken).select(F.col("x").alias("core"), F.col("root").alias("entity")))

    # -- cores with less than a full lead ---------------------------------------------------
    def attach(lesser: DataFrame, cands: DataFrame, members: DataFrame) -> DataFrame:
        """``lesser`` cores to the entities of their candidates, else on their own."""
        roots = members.select(F.col("core").alias("y"), "entity")
        scored = cands.join(roots, "y").groupBy("x", "entity").agg(
            F.max((F.col("gold") + F.col("shared") > 0).cast("int")).alias("proof"), F.min("d").alias("d"), F.max("x_n_works").alias("n_works"), F.max("y_n_works").alias("y_works")
        )
        w = W.partitionBy("x")
        scored = scored.withColumns({"any": F.max("proof").over(w), "least": F.min("d").over(w)})
        scored = scored.withColumn("n_least", F.sum((F.col("d") == F.col("least")).cast("int")).over(w))
        got = st.cut(scored.where("(any = 1 AND proof = 1) OR (any = 0 AND d = least AND n_least = 1 AND (d = 0 OR n_works = 0 OR y_works = 0))").select(F.col("x").alias("core"), "entity"))
        alone = lesser.select("core").join(got, "core", "left_anti").select("core", F.col("core").alias("entity"))
        return st.cut(got.unionByName(alone))

    low = judged.where("x_level = 1 AND y_level = 2")
    first = attach(initials.unionByName(short), low, members)
    loose = first.where("core = entity")
    last = attach(bare, judged.where("x_level = 0 AND y_level > 0"), members.unionByName(loose))
    return Resolved(forms, cores, st.cut(members.unionByName(first).unionByName(last)), seen)


def citation_evidence(st: Stages, cit: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(spellings, works, links)`` of a citations table for :func:`resolve`."""
    rows = cit.select("author", "canonical_author", title_key(F.col("title")).alias("work")).groupBy("author", "canonical_author", "work").agg(F.count("*").alias("n"))
    rows = st.cut(rows)
    used = rows.select(F.explode(F.array("author", "canonical_author")).alias("spelling"), "work", "n").where(F.col("spelling").isNotNull()).groupBy("spelling", "work").agg(F.sum("n").alias("n"))
    used = st.cut(used)
    links = rows.where("author <> canonical_author").select(F.col("author").alias("a"), F.col("canonical_author").alias("b")).distinct()
    return used.groupBy("spelling").agg(F.sum("n").alias("n")), used.where(F.col("work").isNotNull()), links


def variant_pairs(cit: DataFrame) -> DataFrame:
    """``(spelling_a, spelling_b)``, ``a < b``: spellings used for the same entity.

    Spellings are the distinct values of ``author`` and ``canonical_author`` as
    stored.  Null and blank values and values that name nobody are in no pair;
    repeated rows change nothing; extra columns are ignored; an empty table gives
    no pairs.  Every pair within an entity is listed, as the result asks for.
    """
    st = Stages(cit.sparkSession)
    r = resolve(st, *citation_evidence(st, cit))
    who = st.cut(r.forms.select("spelling", "core").join(r.members, "core").select("entity", "spelling").distinct())
    st.clear(keep=who)
    a, b = who.select("entity", F.col("spelling").alias("spelling_a")), who.select("entity", F.col("spelling").alias("spelling_b"))
    return a.join(b, "entity").where("spelling_a < spelling_b").select("spelling_a", "spelling_b").distinct()
