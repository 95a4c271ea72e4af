"""From raw extraction rows to working citations: flatten, clean, merge.

A working citation has ``group`` (the citing book), ``ord`` (position, decides
"first wins"), ``title`` ('' for author only), ``author``, ``canonical_author``,
``cite_count``, ``contexts`` and ``commentaries``.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from difflib import SequenceMatcher
from functools import reduce
from operator import or_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import casefold, main_title, normalize_text, title_case
from .dedup import united
from .tables import kept

# Authors that are no persons, lower case.
NOT_PERSONS = (
    "unknown", "anonymous", "various authors", "various", "editor", "editors", "the author", "the editor", "narrator", "compiler",
    "thinkers", "poets", "philosophers", "scholars", "scientists", "writers", "critics", "historians", "theologians", "mystics", "commentators",
    "epicureans", "stoics", "pythagorean sect", "greek philosophers", "ancient authors", "jewish authors", "christian authors",
    "elders of zion", "church fathers", "scholastics", "pre-socratics", "cynics", "skeptics", "peripatetics", "neoplatonists", "atomists",
    "hamlet", "faust", "don quixote", "zarathustra", "meursault", "dionysus", "zeus", "athena", "apollo", "prometheus", "hermes",
    "odysseus", "achilles", "oedipus", "antigone", "electra", "satan", "god", "christ", "jesus", "allah", "buddha",
    "lord", "the bible", "the quran", "the torah", "the talmud", "the koran", "the vedas", "the upanishads",
)
# Fixed value: endings of group nouns.
GROUP_NOUN = r"^the\s+\w+s$|ists$|ians$|ers$|ites$|ics$"


def flatten(raw: DataFrame, group: str = "source_book_id", ord_: str = "raw_id") -> DataFrame:
    """Extraction rows as working citations; rows with a blank author drop out."""
    one = lambda c: F.when(F.coalesce(F.col(c), F.lit("")) != "", F.array(c)).otherwise(F.array().cast("array<string>"))
    return raw.where(F.trim("author") != "").select(
        F.col(group).alias("group"), F.col(ord_).alias("ord"), F.trim(F.coalesce("title", F.lit(""))).alias("title"), F.trim("author").alias("author"),
        F.lit(None).cast("string").alias("canonical_author"), F.lit(1).cast("bigint").alias("cite_count"),
        one("citation_excerpt").alias("contexts"), one("commentary").alias("commentaries"),
    )


def flatten_documents(docs: DataFrame) -> DataFrame:
    """Nested extraction documents (one per book) as extraction rows."""
    chunks = docs.select("source_path", F.posexplode("chunks").alias("ci", "c"))
    cits = chunks.select("source_path", "ci", F.col("c.chunk_index").alias("chunk_index"), F.posexplode("c.citations").alias("k", "r"))
    return cits.select(F.col("source_path").alias("source_book_id"), (F.col("ci") * 100_000 + F.col("k")).alias("raw_id"), "chunk_index", "r.*")


def _merged(df: DataFrame, keys: dict[str, Column], first: Sequence[str]) -> DataFrame:
    """Rows of equal keys as one: the first row's values, counts added, arrays united in order.

    Array elements are reduced to their first position per key before they are
    collected, so a hot key costs what its result holds, not what its rows hold.
    """
    keyed = df.withColumns({k: c for k, c in keys.items()})
    names = list(keys)
    head = keyed.groupBy(*names).agg(
        F.min_by(F.struct(*first), "ord").alias("_f"), F.min("ord").alias("ord"), F.sum("cite_count").alias("cite_count"), F.count("*").alias("merged")
    )

    out = head
    for col in ("contexts", "commentaries"):
        u = united(keyed, names, col, ["ord"]).withColumnsRenamed({n: f"_{n}" for n in names})
        cond = None
        for n in names:
            e = out[n].eqNullSafe(u[f"_{n}"])
            cond = e if cond is None else cond & e
        out = out.join(u, cond, "left").drop(*[f"_{n}" for n in names])
    empty = F.array().cast("array<string>")
    return out.select(*names, "_f.*", "ord", "cite_count", "merged", F.coalesce("contexts", empty).alias("contexts"), F.coalesce("commentaries", empty).alias("commentaries"))


_COLS = ("group", "ord", "title", "author", "canonical_author", "cite_count", "contexts", "commentaries")


def exact_dedup(df: DataFrame) -> DataFrame:
    """One row per book and case-folded title and author."""
    keys = {"_g": F.col("group"), "_t": casefold(F.col("title")), "_a": casefold(F.col("author"))}
    return _merged(df, keys, ["group", "title", "author", "canonical_author"]).select(*_COLS)


def drop_non_persons(df: DataFrame) -> DataFrame:
    """Authors that are no persons: listed, all-caps words, two letters, et al., group nouns."""
    a = F.col("author")
    low = F.lower(F.trim(a))
    words = F.size(F.split(F.trim(a), r"\s+"))
    caps = (words == 1) & (a == F.upper(a)) & (a != F.lower(a))
    named = (words >= 2) & ~low.startswith("the ")
    group = ~named & low.rlike(f"(?i){GROUP_NOUN}")
    return df.where(~(low.isin(*NOT_PERSONS) | caps | (F.length(F.trim(a)) <= 2) | low.rlike(r"\bet\s+al\.?\s*$") | group))


def canonicalise(df: DataFrame, aliases: DataFrame, keep_variant: bool = False) -> DataFrame:
    """Authors replaced by their canonical name.

    ``aliases``: ``(variant_lower, canonical)``, a dimension of stated size.  By
    default later steps see the canonical name in ``canonical_author`` too;
    ``keep_variant`` puts the replaced variant there.
    """
    dim = aliases.groupBy(F.lower("variant_lower").alias("_v")).agg(F.min("canonical").alias("_c"))
    hit = F.col("_c").isNotNull() & (F.col("_c") != F.col("author"))
    out = df.join(dim, F.lower(F.trim("author")) == F.col("_v"), "left")
    return out.withColumns({
        "canonical_author": F.when(hit, F.col("author") if keep_variant else F.col("_c")).otherwise(F.col("canonical_author")),
        "author": F.when(hit, F.col("_c")).otherwise(F.col("author")),
    }).drop("_v", "_c")


def collapse_author_only(df: DataFrame) -> DataFrame:
    """Author-only citations of one author as one, counts added."""
    lone = df.where(F.trim("title") == "")
    keys = {"_g": F.col("group"), "_a": casefold(F.col("author"))}
    one = _merged(lone, keys, ["group", "title", "author"]).withColumn("canonical_author", title_case(F.col("author")))
    return df.where(F.trim("title") != "").select(*_COLS).unionByName(one.select(*_COLS))


def collapse_variant_titles(df: DataFrame) -> DataFrame:
    """Titles with the same main part by the same author as one."""
    t = F.col("title")
    key = F.when(main_title(t) != "", main_title(t)).otherwise(casefold(t))
    keys = {"_g": F.col("group"), "_a": normalize_text(F.col("author")), "_t": key}
    return _merged(df, keys, ["group", "title", "author", "canonical_author"]).select(*_COLS)


def drop_self_references(df: DataFrame, sources: DataFrame) -> DataFrame:
    """Citations of the citing book itself, and author-only ones of its own author.

    ``sources``: ``(group, source_title, source_authors)``, one row per book.
    """
    src = sources.select(
        F.col("group").alias("_sg"), normalize_text(F.col("source_title")).alias("_st"), F.transform("source_authors", normalize_text).alias("_sa")
    )
    own = F.coalesce(F.array_contains("_sa", normalize_text(F.col("author"))), F.lit(False))
    same = (normalize_text(F.col("title")) == F.col("_st")) & (F.col("_st") != "")
    return df.join(src, df["group"] == src["_sg"], "left").where(~(own & (F.coalesce(same, F.lit(False)) | (F.trim("title") == "")))).select(*df.columns)


def ratio(a: str, b: str) -> float:
    """Ratcliff-Obershelp similarity of two texts."""
    return SequenceMatcher(None, a, b).ratio()


#: Fixed value: books of up to so many rows are compared all with all, larger ones by letter triples.
FEW_ROWS = 1000


class _Letters:
    """Bounds of the letters that texts have in common.

    The n-th occurrence of a letter is a bit of 128, rare ones share the last.
    ``lost`` counts what shares a bit, so that a bound is never too low.
    """

    def __init__(self, texts: list[str]) -> None:
        self.size = np.array([len(t) for t in texts], dtype=np.int32)
        self.low, self.high = np.zeros(len(texts), dtype=np.uint64), np.zeros(len(texts), dtype=np.uint64)
        text = np.repeat(np.arange(len(texts), dtype=np.int64), self.size)
        letter = np.sort(text << 21 | np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32))
        if len(letter):
            first = np.flatnonzero(np.diff(letter, prepend=-1))
            nth = np.arange(len(letter)) - np.repeat(first, np.diff(first, append=len(letter)))
            _, kind, often = np.unique((letter & (1 << 21) - 1) << 32 | nth, return_inverse=True, return_counts=True)
            rank = np.empty(len(often), dtype=np.int64)
            rank[np.argsort(-often, kind="stable")] = np.arange(len(often))
            at = np.minimum(rank[kind], 127)
            starts, has = (np.cumsum(self.size) - self.size)[self.size > 0], self.size > 0
            for half, mine in ((self.low, at < 64), (self.high, at >= 64)):
                half[has] = np.bitwise_or.reduceat(np.where(mine, np.uint64(1) << (at & 63).astype(np.uint64), np.uint64(0)), starts)
        self.often = np.bitwise_count(self.low).astype(np.int32)
        self.lost = self.size - self.often - np.bitwise_count(self.high)

    def common(self, i, j) -> np.ndarray:
        met = np.bitwise_count(self.low[i] & self.low[j]).astype(np.int32) + np.bitwise_count(self.high[i] & self.high[j])
        return met + np.minimum(self.lost[i], self.lost[j])


def _triples(a: str) -> set[str]:
    """Letter triples of a text; repeated ones are numbered by blanks."""
    found: set[str] = set()
    for k in range(len(a) - 2):
        t = a[k:k + 3]
        while t in found:
            t += " "
        found.add(t)
    return found


def _lost_triples(n: int, threshold: float) -> tuple[int, int]:
    """Letter triples a text of ``n`` letters may lose at most in a text of a ratio over ``threshold``, and the longest such text.

    A letter without a partner takes three triples with it, a letter put in takes two.
    """
    lost, longest, m = 0, 0, 0
    while m <= n:
        m = int(threshold * (n + longest + 1) / 2)
        while m <= n and not 2.0 * m / (n + longest + 1) > threshold:
            m += 1
        if m > n:
            break
        longest += 1
        if m <= longest:
            lost = max(lost, 3 * (n - m) + 2 * (longest - m))
    return lost, longest


def _meetings(authors: list[str], threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows, in ascending order, and rows they may meet by their authors: one within the other, or of a ratio over ``threshold``.

    A name within another has all its letter triples there, so its rarest one.  Two
    names of a high ratio have so many in common that one is among the rarest of
    both.  Names too short for that meet all that are as short.
    """
    rows: dict[str, list[int]] = {}
    for i, a in enumerate(authors):
        rows.setdefault(a, []).append(i)
    grams = {a: _triples(a) for a in rows}
    df = Counter(t for ts in grams.values() for t in ts)
    bounds = {n: _lost_triples(n, threshold) for n in {len(a) for a in rows}}
    every: dict[str, list[int]] = {}
    rare: dict[str, list[int]] = {}
    rarest: dict[str, list[int]] = {}
    reach, tiny = 0, []
    for a, ts in grams.items():
        lost, longest = bounds[len(a)]
        if len(ts) <= lost:
            reach = max(reach, longest)
        order = sorted(ts, key=lambda t: (df[t], t))
        for k, t in enumerate(order):
            every.setdefault(t, []).extend(rows[a])
            if k <= lost:
                rare.setdefault(t, []).extend(rows[a])
        if order:
            rarest.setdefault(order[0], []).extend(rows[a])
        else:
            tiny += rows[a]
    listed = lambda at: np.array(sorted(at), dtype=np.int64)
    for t in rare:
        at = listed(rare[t])
        yield at, at
        if t in rarest and len(every[t]) > len(at):
            yield listed(rarest[t]), listed(every[t])
    short = listed(i for i, a in enumerate(authors) if len(a) <= reach)
    yield short, short
    yield listed(tiny), np.arange(len(authors))


def _main_part(t: str) -> str:
    return re.sub(r"[^a-z0-9]+", " ", re.split(r"[:\-_(\[]", t.strip().casefold())[0]).strip()


def cluster_rows(rows: Sequence[dict], threshold: float = 0.85) -> list[tuple[int, int]]:
    """``(ord, ord of seed)``: greedy star clusters around the longest rows.

    Two texts share at most the letters they have in common, which bounds their
    ratio; only rows within the bounds are compared.  In a large book the bounds are
    taken for rows that have letter triples of their authors in common.
    """
    order = sorted(rows, key=lambda r: (-(len(r["title"]) + len(r["author"])), r["ord"]))
    ords = [r["ord"] for r in order]
    authors = [" ".join(r["author"].split()).casefold() for r in order]
    titled = np.array([bool(r["title"].strip()) for r in order], dtype=bool)
    mains = [_main_part(r["title"]) for r in order]
    a_, t_ = _Letters(authors), _Letters(mains)
    n = len(order)
    every = np.arange(n)
    # Twice the common letters of titles are over the threshold only if those of the frequent letters are over this.
    share = (threshold / 2 * t_.size).astype(np.int32)
    need = share - (t_.size - t_.often) - (t_.size == 0)

    def alike(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether the letters of two rows allow for one cluster; of authors, all of the shorter must be shared for one to contain the other."""
        total, common = t_.size[i] + t_.size[j], a_.common(i, j)
        fits = (titled[i] == titled[j]) & (~titled[i] | (2 * t_.common(i, j) > threshold * total) | (total == 0))
        return fits & ((2 * common > threshold * (a_.size[i] + a_.size[j])) | (common >= np.minimum(a_.size[i], a_.size[j])))

    found = [np.empty(0, dtype=np.int64)]
    for left, right in _meetings(authors, threshold) if n > FEW_ROWS and threshold > 0 else [(every, every)]:
        same, low, least, step = left is right, t_.low[right], share[right], max(1, 250_000 // max(len(right), 1))
        for k in range(0, len(left), step):
            some, off = left[k:k + step], k if same else 0
            x, y = np.nonzero(np.bitwise_count(t_.low[some][:, None] & low[None, off:]) - least[None, off:] > need[some][:, None])
            i, j = np.minimum(some[x], right[off + y]), np.maximum(some[x], right[off + y])
            i, j = i[i < j], j[i < j]
            fits = alike(i, j)
            found.append(i[fits] * n + j[fits])
    met = np.unique(np.concatenate(found))
    starts = np.searchsorted(met, np.arange(n + 1) * n)
    open_ = np.ones(n, dtype=bool)
    out = []
    for i in range(n):
        if not open_[i]:
            continue
        open_[i] = False
        out.append((ords[i], ords[i]))
        rest = met[starts[i]:starts[i + 1]] - i * n
        for j in rest[open_[rest]]:
            a, b = authors[i], authors[j]
            if not (a in b or b in a or ratio(a, b) > threshold):
                continue
            if titled[i] and mains[i] != mains[j] and not ratio(mains[i], mains[j]) > threshold:
                continue
            open_[j] = False
            out.append((ords[j], ords[i]))
    return out


def fuzzy_merge(df: DataFrame, threshold: float = 0.85) -> DataFrame:
    """Near-equal citations of one book merged into the longest.

    The clusters depend on order, so a book is one unit; only distinct titles and
    authors of a book (after the exact steps) reach it.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for g, rows in zip(pdf["group"], pdf["rows"]):
                out += [(g, o, s) for o, s in cluster_rows([{"ord": r["ord"], "title": r["title"], "author": r["author"]} for r in rows], threshold)]
            yield pd.DataFrame(out, columns=["_g", "_o", "_seed"])

    kinds = dict(df.dtypes)
    # Rows with and without a title are never in one cluster.
    packed = df.groupBy("group", (F.trim("title") != "").alias("titled")).agg(F.collect_list(F.struct("ord", "title", "author")).alias("rows")).drop("titled")
    seeds = packed.mapInPandas(run, f"_g {kinds['group']}, _o {kinds['ord']}, _seed {kinds['ord']}")
    seeds = kept(seeds)
    joined = df.join(seeds, (df["group"] == seeds["_g"]) & (df["ord"] == seeds["_o"]))
    heads = df.select(F.col("group").alias("_hg"), F.col("ord").alias("_ho"), "title", "author", "canonical_author")
    body = joined.select("group", "_seed", "ord", "cite_count", "contexts", "commentaries")
    merged = _merged(body.withColumnRenamed("group", "g0"), {"_g": F.col("g0"), "_s": F.col("_seed")}, ["g0"]).select(
        F.col("_g").alias("group"), F.col("_s").alias("seed"), "cite_count", "contexts", "commentaries"
    )
    return merged.join(heads, (F.col("group") == F.col("_hg")) & (F.col("seed") == F.col("_ho"))).select(
        "group", F.col("seed").alias("ord"), "title", "author", "canonical_author", "cite_count", "contexts", "commentaries"
    )


Step = Callable[[DataFrame], DataFrame]


def preprocess(df: DataFrame, aliases: DataFrame | None = None, sources: DataFrame | None = None) -> DataFrame:
    """The steps in order; aliases and sources are optional."""
    steps: list[Step] = [exact_dedup, drop_non_persons]
    if aliases is not None:
        steps.append(lambda d: canonicalise(d, aliases))
    steps += [collapse_author_only, collapse_variant_titles, fuzzy_merge]
    if sources is not None:
        steps.append(lambda d: drop_self_references(d, sources))
    # A merging step reads its input several times: each is a table of its own, the first one too.
    df = kept(df)
    for step in steps:
        df = kept(df.transform(step))
    return df
