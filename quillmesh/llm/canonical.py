"""Problem 5: freely typed values mapped to a reference list.

The stems, given names and initials of the reference entries form BK-trees under
the Levenshtein distance, sharded by blocks of entries; for a query the triangle
inequality leaves out every subtree that cannot hold an entry within the
threshold.  Each distinct typed string visits every block and the hits merge.

Which of the entries in reach is meant, if any, is decided per entity: typed
values are first linked with one another (:mod:`variants`), so that a person
outside the list whose name differs by a letter from a listed one is seen in
shapes and works of their own and maps to none.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Stages
from .titles import title_key
from .triejoin import reach
from .variants import citation_evidence, parse_spellings, resolve

#: Entries of the reference list in one tree, and queries that visit one copy of it.
BLOCK = 20_000
QUERIES = 50_000


def distance(a: str, b: str) -> int:
    """Levenshtein distance (a true metric)."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


class Queries:
    """Strings as a matrix of letter codes, for distances to one string at a time."""

    def __init__(self, strings: list[str]):
        self.strings = strings
        self.lengths = np.array([len(s) for s in strings], dtype=np.int64)
        self.codes: dict[str, int] = {}
        width = int(self.lengths.max()) if strings else 0
        self.letters = np.zeros((len(strings), width), dtype=np.int32)
        for i, s in enumerate(strings):
            for j, c in enumerate(s):
                self.letters[i, j] = self.codes.setdefault(c, len(self.codes) + 1)

    def distances(self, s: str, which: np.ndarray) -> np.ndarray:
        """Distances of ``s`` to the queries ``which`` (bit-parallel, Myers 1999)."""
        m = len(s)
        if m == 0:
            return self.lengths[which]
        if m > 63:
            return np.array([distance(s, self.strings[i]) for i in which], dtype=np.int64)
        masks = np.zeros(len(self.codes) + 1, dtype=np.uint64)
        for i, c in enumerate(s):
            if c in self.codes:
                masks[self.codes[c]] |= np.uint64(1 << i)
        one, top = np.uint64(1), np.uint64(1 << (m - 1))
        up = np.full(len(which), np.iinfo(np.uint64).max, dtype=np.uint64)
        down = np.zeros(len(which), dtype=np.uint64)
        score = np.full(len(which), m, dtype=np.int64)
        lengths = self.lengths[which]
        for j in range(int(lengths.max()) if len(which) else 0):
            eq = masks[self.letters[which, j]]
            vert = eq | down
            horiz = (((eq & up) + up) ^ up) | eq
            plus, minus = down | ~(horiz | up), up & horiz
            live = j < lengths
            score += live & ((plus & top) != 0)
            score -= live & ((minus & top) != 0)
            plus, minus = (plus << one) | one, minus << one
            up, down = minus | ~(vert | plus), plus & vert
        return score


class BKTree:
    """Strings by their distance to the string of each node."""

    def __init__(self, strings: Iterable[str] = ()):
        self.root: tuple[str, dict] | None = None
        for s in strings:
            self.add(s)

    def add(self, s: str) -> None:
        if self.root is None:
            self.root = (s, {})
            return
        node = self.root
        while True:
            d = distance(s, node[0])
            if d == 0:
                return
            child = node[1].get(d)
            if child is None:
                node[1][d] = (s, {})
                return
            node = child

    def within(self, queries: list[str], radius: Callable[[int], int]) -> list[tuple[str, str, int]]:
        """``(query, string, d)`` for every string at most ``radius(len(query))`` from a query.

        All queries walk the tree together; a subtree under edge ``e`` is entered
        only by those whose distance to its parent is within their radius of ``e``.
        """
        q = Queries(queries)
        reach_ = np.array([radius(len(s)) for s in queries], dtype=np.int64)
        out: list[tuple[str, str, int]] = []
        stack = [(self.root, np.arange(len(queries)))] if self.root and queries else []
        while stack:
            (s, children), which = stack.pop()
            d = q.distances(s, which)
            near = d <= reach_[which]
            out += [(queries[i], s, int(x)) for i, x in zip(which[near], d[near])]
            for e, child in children.items():
                go = which[np.abs(d - e) <= reach_[which]]
                if len(go):
                    stack.append((child, go))
        return out


def in_reach(queries: DataFrame, entries: DataFrame) -> DataFrame:
    """``(space, q, s, d)``: entries ``s`` within :func:`reach` of each query ``q`` of the same space.

    Both tables: ``(space, s)``; strings of the space ``acronym`` meet only their
    equals.  Blocks of entries and blocks of queries form a grid, each part of
    which builds one tree.
    """
    rows = entries.where("s <> ''").distinct().withColumn("role", F.lit(0)).unionByName(queries.where("s <> ''").distinct().withColumn("role", F.lit(1)))
    sizes = rows.groupBy("space").agg(
        F.ceil(F.count_if(F.col("role") == 0) / BLOCK).cast("int").alias("parts"), F.ceil(F.count_if(F.col("role") == 1) / QUERIES).cast("int").alias("qs")
    ).where("parts > 0 AND qs > 0")
    mine = lambda n: F.array(F.pmod(F.xxhash64("s"), F.col(n)).cast("int"))
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    entry = F.col("role") == 0
    placed = rows.join(F.broadcast(sizes), "space")  # one row a space, three in all
    placed = placed.withColumn("part", F.explode(F.when(entry, mine("parts")).otherwise(every("parts"))))
    placed = placed.withColumn("block", F.explode(F.when(entry, every("qs")).otherwise(mine("qs")))).select("space", "part", "block", "role", "s")

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, tree = None, BKTree()
        for pdf in batches:
            found: list[tuple] = []
            for key, g in pdf.groupby(["space", "part", "block"], sort=False):
                if key != at:
                    at, tree = key, BKTree()
                for s in g["s"][g["role"] == 0]:
                    tree.add(s)
                radius = (lambda n: 0) if key[0] == "acronym" else reach
                found += [(key[0], *hit) for hit in tree.within(list(g["s"][g["role"] == 1]), radius)]
            yield pd.DataFrame(found, columns=["space", "q", "s", "d"])

    ordered = placed.repartition("space", "part", "block").sortWithinPartitions("space", "part", "block", "role")
    return ordered.mapInPandas(visit, "space string, q string, s string, d int")


def _strings(df: DataFrame, stem: str, lead: str, level: str, acros) -> DataFrame:
    """``(space, s)`` of parsed names: stems, full given names, acronyms."""
    one = lambda space, c: F.struct(F.lit(space).alias("space"), c.alias("s"))
    plain = F.array(one("stem", F.col(stem)), one("lead", F.when(F.col(level) == 2, F.col(lead))))
    letters = F.transform(F.coalesce(acros, F.array().cast("array<string>")), lambda a: one("acronym", a))
    return df.select(F.explode(F.concat(plain, letters)).alias("x")).select("x.*").where("s IS NOT NULL")


def map_to_list(cit: DataFrame, refs: DataFrame, id_col: str = "cit_id", ref_id: str = "author_id", ref_name: str = "name") -> tuple[DataFrame, DataFrame]:
    """``(matches, unmatched)``.

    ``matches``: distinct ``(id_col, ref_id)`` - the entry that the record's
    ``author`` denotes; ``unmatched``: ``(author, n)`` - the typed values (null
    included) no record of which denotes an entry, with their records.  Blank
    values and values that name nobody are unmatched.  A name that fits two
    entries equally well denotes neither unless the cited work tells.  Reference
    entries with null names are ignored; entries with one and the same name are
    both denoted.
    """
    st = Stages(cit.sparkSession)
    listed = st.cut(parse_spellings(refs, ref_name))
    res = resolve(st, *citation_evidence(st, cit), listed)
    parsed = listed.select("spelling", "kind", "stem", "lead", "level", F.when(F.col("kind") == "org", F.split("acro", " ")).alias("acros"))
    entries = st.cut(refs.where(F.col(ref_name).isNotNull()).select(F.col(ref_id).alias("ref"), F.col(ref_name).alias("spelling")).distinct().join(parsed, "spelling").select(
        "ref", F.col("kind").alias("r_kind"), F.col("stem").alias("r_stem"), F.col("lead").alias("r_lead"), F.col("level").alias("r_level"), "acros"
    ))
    typed = _strings(res.cores, "stem", "lead", "level", F.when(F.col("kind") == "short", F.array("acro")))
    near = st.cut(in_reach(typed, _strings(entries, "r_stem", "r_lead", "r_level", F.col("acros"))))
    of = lambda space, q, s, d: near.where(F.col("space") == space).select(F.col("q").alias(q), F.col("s").alias(s), F.col("d").alias(d))
    hits = st.cut(res.cores.where("kind <> 'short'").join(of("stem", "stem", "r_stem", "ds"), "stem").join(entries.drop("acros"), "r_stem").where("kind = r_kind"))
    # -- entities with a full name -------------------------------------------
    full = hits.where("level = 2").join(of("lead", "lead", "r_lead", "dl"), ["lead", "r_lead"])
    full = full.join(res.members, "core").select("core", "entity", "ref", "shapes", "rows", (F.col("ds") + F.col("dl")).alias("d"))
    w = W.partitionBy("entity")
    per = st.cut(full.groupBy("entity", "ref").agg(F.min("d").alias("d"), F.max(F.struct("shapes", "rows")).alias("support")).withColumn("least", F.min("d").over(w)))
    # Among several entries met exactly the entity stands for the one with most support.
    exact = per.where("d = 0").withColumn("top", F.max("support").over(w)).where(F.col("support") == F.col("top")).select("entity", "ref")
    # Without an exact form: only a name seen in one shape, for an entry nobody writes exactly.
    shapes = res.cores.where("level = 2").join(res.members, "core").groupBy("entity").agg(F.max("shapes").alias("most_shapes"))
    loose = per.where("least > 0 AND least <= 2 AND d = least").withColumn("n", F.count("*").over(w)).where("n = 1")
    loose = loose.join(shapes, "entity").where("most_shapes = 1").join(exact.select("ref").distinct(), "ref", "left_anti").select("entity", "ref")
    denotes = st.cut(exact.unionByName(loose).distinct())
    # -- cores ----------------------------------------------------------------
    belongs = res.members.join(denotes, "entity", "left")
    # Members of one entity, and those of several only some of which are listed.
    share = belongs.groupBy("core").agg(F.countDistinct("entity").alias("n_entities"), F.count("ref").alias("refs")).where("refs > 0")
    belongs = st.cut(belongs.join(share, "core").where("ref IS NOT NULL").select("core", "entity", "ref", "n_entities"))
    clear = belongs.where("n_entities = 1").select("core", "ref")
    # A short form of nobody who is written out: the only entry that fits.
    alone = res.members.where("core = entity").select("core").join(res.cores.where("level < 2"), "core")
    fits = hits.where("ds = 0 AND level < 2 AND kind = 'person' AND (lead = '' OR lead = substring(r_lead, 1, 1))").select("core", "ref", "stem").join(alone.select("core"), "core", "left_semi")
    # People of that name who are written out and are not the entry speak against it.
    rivals = res.cores.where("level = 2 AND kind = 'person'").join(res.members, "core").join(denotes, "entity", "left_anti").select("stem").distinct()
    fits = st.cut(fits.join(st.cut(rivals), "stem", "left_anti").select("core", "ref"))
    letters = alone.where("kind = 'short'").join(of("acronym", "acro", "letters", "da"), "acro").join(
        entries.select("ref", "r_stem", F.explode("acros").alias("letters")), "letters"
    ).join(of("stem", "stem", "r_stem", "ds"), ["stem", "r_stem"], "left").where("stem = '' OR ds IS NOT NULL").select("core", "ref")
    fits = fits.unionByName(letters).distinct()
    only = fits.withColumn("n", F.count("*").over(W.partitionBy("core"))).where("n = 1").select("core", "ref")
    by_core = res.forms.select("spelling", "core").join(st.cut(clear.unionByName(only)), "core").select("spelling", "ref")
    # -- records ----------------------------------------------------------------
    said = cit.select(F.col(id_col).alias("id"), F.col("author").alias("spelling"), "title")
    plain = said.select("id", "spelling").join(by_core, "spelling").select("id", "ref")
    # A short form of several people: the cited work tells who is meant.
    unsure = belongs.where("n_entities > 1")
    cited = st.cut(res.seen.join(res.cores.where("level = 2").select("core"), "core").join(res.members, "core").select("entity", "work").distinct().join(unsure, "entity").select("core", "work", "ref").distinct())
    told = said.join(res.forms.select("spelling", "core").join(unsure.select("core").distinct(), "core", "left_semi"), "spelling")
    by_work = told.select("id", "core", title_key(F.col("title")).alias("work")).join(cited, ["core", "work"]).select("id", "ref")
    matches = st.cut(plain.unionByName(by_work).distinct())
    st.clear(keep=matches)
    given = cit.select(F.col(id_col).alias("id"), "author").distinct()
    meant = given.join(matches.select("id").distinct(), "id", "left_semi").select(F.col("author").alias("m")).distinct()
    unmatched = given.groupBy("author").agg(F.count("*").alias("n")).join(meant, F.col("author").eqNullSafe(F.col("m")), "left_anti")
    return matches.select(F.col("id").alias(id_col), F.col("ref").alias(ref_id)), unmatched
