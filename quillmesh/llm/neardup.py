"""Problem 2: near-duplicate records with small edits.

Similarity of two values is the Dice agreement of their letter pairs.  A pair of
sets with agreement ``theta`` differs in at most ``k = (1 - theta) (n1 + n2)``
elements ("bits").  Cut into ``k // 2 + 1`` segments by element hash, one segment
differs by at most one bit: it is equal, or one side's is the other's with one
element deleted.  Every set therefore indexes each whole segment and each
segment with one element deleted; an equality join of whole against whole and
whole against deleted segments finds every such pair, and the agreement is then
verified.  As ``k`` depends on the sizes, sets are indexed per level of the size sum.

Records are joined in two steps: distinct authors once for all books, then, per
book, the titles of records with agreeing authors.  Where an author has more
records in a book than ``CELL``, the titles go through the same signatures, so that
no hot book or author is ever compared pair by pair.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Sequence

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stages, blank, cut

THETA = 0.75
#: Records of one author in one book that are compared directly at most.
CELL = 32

_COMBINING = re.compile("[̀-ͯ᪰-᫿᷀-᷿⃐-⃿︠-︯]+")
_WORD = re.compile(r"[^\W_]+")


def letter_pairs(text: str | None) -> list[int]:
    """Distinct adjacent letter or digit pairs inside words, hashed, sorted."""
    if not text:
        return []
    low = text.lower()
    if not low.isascii():
        low = _COMBINING.sub("", unicodedata.normalize("NFKD", low))
    found = {w[i:i + 2] for w in _WORD.findall(low) for i in range(len(w) - 1)}
    return sorted(xxhash.xxh64_intdigest(p) >> 2 for p in found)


def with_letter_pairs(df: DataFrame, col: str, out: str) -> DataFrame:
    @F.pandas_udf("array<long>")
    def pairs_of(values: pd.Series) -> pd.Series:
        return values.map(letter_pairs)

    return df.withColumn(out, pairs_of(F.col(col)))


def _levels(theta: float, longest: int) -> list[tuple[int, int, int]]:
    """(low, high, segments): a level serves size sums in (low, high]."""
    out, lo = [], 1
    while lo < 2 * longest + 2:
        hi = max(lo + 1, int(lo * 1.2))
        out.append((lo, hi, int((1 - theta) * hi + 1e-9) // 2 + 1))
        lo = hi
    return out


def similar_sets(sets: DataFrame, within: Sequence[str], id_col: str, theta: float = THETA, longest: int | None = None) -> DataFrame:
    """``(within..., x, y)`` with ``x < y``: sets ``elems`` of the same ``within`` that agree to ``theta``.

    ``sets``: ``within``, ``id_col`` (unique within), ``elems array<long>`` of distinct
    hashes.  Empty sets agree with nothing.  ``longest``: the size of the largest
    set, by default counted; the levels reach as far.
    """
    if longest is None:
        longest = sets.agg(F.max(F.size("elems"))).first()[0] or 1
    spread = (2 - theta) / theta  # the larger set has at most so many times the elements
    levels = F.array(*[F.struct(F.lit(a).alias("lo"), F.lit(b).alias("hi"), F.lit(m).alias("m")) for a, b, m in _levels(theta, longest)])
    bits = lambda shift: F.expr(f"aggregate(elems, 0L, (a, e) -> a | shiftleft(1L, cast(pmod(shiftright(e, {shift}), 64) as int)))")
    base = sets.where(F.size("elems") > 0).select(*within, F.col(id_col).alias("id"), "elems", F.size("elems").alias("n"))
    base = base.withColumns({"b1": bits(3), "b2": bits(23)})
    per_level = base.withColumn(
        "lv", F.explode(F.filter(levels, lambda v: (F.col("n") * (1 + 1 / spread) <= v["hi"]) & (F.col("n") * (1 + spread) > v["lo"])))
    )
    seg = per_level.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("lv.m") - 1))).withColumn(
        "part", F.expr("filter(elems, e -> pmod(shiftright(e, 9), lv.m) = i)")
    ).withColumn("h", F.expr("aggregate(part, 0L, (a, e) -> a ^ e)"))
    cols = [*within, "id", "n", "b1", "b2", F.col("lv.lo").alias("lo"), F.col("lv.hi").alias("hi")]
    whole = seg.select(*cols, F.xxhash64(*within, "lv.lo", "i", "h").alias("key"))
    short = seg.select(*cols, F.explode("part").alias("e"), "i", "h").select(
        *within, "id", "n", "b1", "b2", "lo", "hi", F.xxhash64(*within, "lo", "i", F.col("h").bitwiseXOR(F.col("e"))).alias("key")
    )
    a = whole.select(*[F.col(c).alias(f"a_{c}") for c in whole.columns])
    b = whole.withColumn("w", F.lit(True)).unionByName(short.withColumn("w", F.lit(False)))
    s = F.col("a_n") + F.col("n")
    far = F.expr("bit_count(a_b1 ^ b1)")
    far2 = F.expr("bit_count(a_b2 ^ b2)")
    same_group = [F.col(f"a_{c}").eqNullSafe(F.col(c)) for c in within]
    cond = (F.col("a_key") == F.col("key")) & (F.col("a_id") != F.col("id")) & (F.col("a_lo") == F.col("lo"))
    cond &= (s > F.col("lo")) & (s <= F.col("hi")) & (far <= F.floor(s * (1 - theta) + 1e-9)) & (far2 <= F.floor(s * (1 - theta) + 1e-9))
    cond &= ~F.col("w") | (F.col("a_id") < F.col("id"))
    for c in same_group:
        cond &= c
    cand = a.join(b, cond).select(*within, F.least("a_id", "id").alias("x"), F.greatest("a_id", "id").alias("y")).distinct()
    e = base.select(*within, "id", "elems", "n")
    on = lambda p, q: [*[p[c].eqNullSafe(q[f"_{c}"]) for c in within]]
    ex = e.select(*[F.col(c).alias(f"_{c}") for c in within], F.col("id").alias("x"), F.col("elems").alias("ex"), F.col("n").alias("nx"))
    ey = e.select(*[F.col(c).alias(f"_{c}") for c in within], F.col("id").alias("y"), F.col("elems").alias("ey"), F.col("n").alias("ny"))

    def with_side(p: DataFrame, q: DataFrame, k: str) -> DataFrame:
        cond = p[k] == q[k]
        for c in on(p, q):
            cond &= c
        return p.join(q, cond).drop(q[k]).drop(*[q[f"_{c}"] for c in within])

    out = with_side(with_side(cand, ex, "x"), ey, "y")
    return out.where(2 * F.size(F.array_intersect("ex", "ey")) >= theta * (F.col("nx") + F.col("ny")) - 1e-9).select(*within, "x", "y")


def near_duplicates(
    df: DataFrame, group: str = "source_book_id", id_col: str = "raw_id", title: str = "title", author: str = "author", theta: float = THETA
) -> tuple[DataFrame, DataFrame]:
    """``(links, members)``: links between record classes, and the class of each record.

    A class holds the records of one group whose title and author have the same
    letter pairs; ``links(x, y)`` joins different classes whose titles and whose
    authors both agree to ``theta``.  Null groups, null ids and blank titles or
    authors are left out, as are values without letter pairs, which agree with
    nothing.  Repeated deliveries of an id count once per distinct content.
    """
    rows = df.where(~blank(F.col(title)) & ~blank(F.col(author)) & F.col(group).isNotNull() & F.col(id_col).isNotNull()).select(
        F.col(group).alias("g"), F.col(id_col).alias("id"), F.col(title).alias("title"), F.col(author).alias("author")
    ).distinct()
    authors = cut(with_letter_pairs(rows.select("author").distinct(), "author", "ae"))
    titles = cut(with_letter_pairs(rows.select("title").distinct(), "title", "te"))
    keyed = rows.join(authors.where(F.size("ae") > 0).select("author", F.xxhash64("ae").alias("a")), "author").join(
        titles.where(F.size("te") > 0).select("title", F.xxhash64("te").alias("t")), "title"
    )
    members = cut(keyed.select("g", "id", "a", "t", F.xxhash64("g", "a", "t").alias("class")).distinct())
    classes = members.select("g", "a", "t", "class").distinct()
    sets = authors.select(F.xxhash64("ae").alias("a"), F.col("ae").alias("elems")).dropDuplicates(["a"])
    linked = similar_sets(sets, [], "a", theta)
    pairs = cut(linked.unionByName(sets.select(F.col("a").alias("x"), F.col("a").alias("y")).where(F.size(sets["elems"]) > 0)))
    # Cells: one author of one book.  A pair of cells is taken in one direction only.
    cells = classes.groupBy("g", "a").agg(F.count("*").alias("size"))
    left = cells.select("g", F.col("a").alias("x"), F.col("size").alias("sx"))
    right = cells.select("g", F.col("a").alias("y"), F.col("size").alias("sy"))
    met = cut(left.join(pairs, "x").join(right, ["g", "y"]).select("g", "x", "y", (F.greatest("sx", "sy") > CELL).alias("hot")))
    tset = titles.select(F.xxhash64("te").alias("t"), F.col("te").alias("elems")).dropDuplicates(["t"])
    c1 = classes.select("g", F.col("a").alias("x"), F.col("t").alias("t1"), F.col("class").alias("cx"))
    c2 = classes.select("g", F.col("a").alias("y"), F.col("t").alias("t2"), F.col("class").alias("cy"))
    direct = met.where("NOT hot").join(c1, ["g", "x"]).join(c2, ["g", "y"]).where("cx <> cy AND (x <> y OR cx < cy)")
    direct = direct.join(tset.select(F.col("t").alias("t1"), F.col("elems").alias("e1")), "t1").join(
        tset.select(F.col("t").alias("t2"), F.col("elems").alias("e2")), "t2"
    ).where(2 * F.size(F.array_intersect("e1", "e2")) >= theta * (F.size("e1") + F.size("e2")) - 1e-9).select("cx", "cy")
    hot = met.where("hot")
    sides = hot.join(c1, ["g", "x"]).select("g", "x", "y", F.col("t1").alias("t"), F.col("cx").alias("class")).unionByName(
        hot.where("x <> y").join(c2, ["g", "y"]).select("g", "x", "y", F.col("t2").alias("t"), F.col("cy").alias("class"))
    ).join(tset, "t").withColumnsRenamed({"x": "ax", "y": "ay"})
    through = similar_sets(sides, ["g", "ax", "ay"], "class", theta, titles.agg(F.max(F.size("te"))).first()[0] or 1)
    # Of different authors' cells only links across count here; links inside a cell come from the cell itself.
    own = classes.select(F.col("class"), "a")
    through = through.join(own.select(F.col("class").alias("x"), F.col("a").alias("x_a")), "x").join(
        own.select(F.col("class").alias("y"), F.col("a").alias("y_a")), "y"
    ).where("ax = ay OR x_a <> y_a").select(F.col("x").alias("cx"), F.col("y").alias("cy"))
    links = direct.unionByName(through).select(F.least("cx", "cy").alias("x"), F.greatest("cx", "cy").alias("y")).distinct()
    return links, members.select(F.col("g").alias(group), F.col("id").alias(id_col), "class").distinct()


def record_pairs(links: DataFrame, members: DataFrame, id_col: str = "raw_id") -> DataFrame:
    """``(<id>_a, <id>_b)``: the links and classes of :func:`near_duplicates` as pairs of records."""
    m = members.select("class", F.col(id_col).alias("r"))
    a, b = m.select(F.col("class").alias("x"), F.col("r").alias("ra")), m.select(F.col("class").alias("y"), F.col("r").alias("rb"))
    across = links.join(a, "x").join(b, "y").where("ra <> rb").select("ra", "rb")
    inside = a.join(b, F.col("x") == F.col("y")).where("ra < rb").select("ra", "rb")
    both = across.unionByName(inside)
    return both.select(F.least("ra", "rb").alias(f"{id_col}_a"), F.greatest("ra", "rb").alias(f"{id_col}_b")).distinct()


def group_records(links: DataFrame, members: DataFrame, id_col: str = "raw_id") -> DataFrame:
    """``(id, group_id, n_links)``: connected groups; the id is the smallest class of the group.

    Smallest labels spread over the links and jump along pointers until nothing
    moves; each round is checkpointed.
    """
    both = cut(links.unionByName(links.select(F.col("y").alias("x"), F.col("x").alias("y"))))
    label = cut(members.select(F.col("class").alias("x"), F.col("class").alias("l")).distinct())
    while True:
        heard = both.join(label.select(F.col("x").alias("y"), F.col("l").alias("h")), "y").groupBy("x").agg(F.min("h").alias("h"))
        step = label.join(heard, "x", "left").select("x", "l", F.least("l", F.coalesce("h", "l")).alias("n"))
        hop = step.select(F.col("x").alias("n"), F.col("n").alias("m"))
        step = cut(step.join(hop, "n").select("x", "l", F.least("n", "m").alias("n")))
        done = step.where("l <> n").limit(1).count() == 0
        label = step.select("x", F.col("n").alias("l"))
        if done:
            break
    degree = both.groupBy("x").agg(F.count("*").alias("n_links"))
    return members.join(label, F.col("class") == F.col("x")).drop("x").join(degree, F.col("class") == degree["x"], "left").select(
        *[c for c in members.columns if c != "class"], F.col("l").alias("group_id"), F.coalesce("n_links", F.lit(0)).alias("n_links")
    )
