"""Trie join: all pairs of strings within a small edit distance.

With ``k`` edits, one of ``k + 1`` segments of the shorter string stands unchanged
in the longer one, near its own place.  Strings are therefore sharded by
(length, segment number, segment); a query visits only the shards whose segment
it contains.  In a shard the strings form a trie, which the Levenshtein automaton
of the query traverses, leaving a branch as soon as no state is within reach.

The automaton is the universal one: its states are the distances around the
diagonal, its letters the places of a character in a window of the query.  Its
table depends on ``k`` only and is made once.

Shards with very many strings or queries are cut into a grid of parts, each of
bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Strings in one trie, and queries to it, in one part of a shard.
SHARD = 20_000
QUERIES = 50_000
#: Strings that begin so are met only by their equals (acronyms, see :mod:`names`).
EXACT = "#"


def reach(length: int) -> int:
    """Edits allowed for a string of this length: shorter than three letters none."""
    return 0 if length < 3 else 1 if length < 6 else 2


def _segments(length: int, k: int) -> list[tuple[int, int]]:
    """(start, length) of ``k + 1`` even segments."""
    base, extra = divmod(length, k + 1)
    out, at = [], 0
    for i in range(k + 1):
        n = base + (i >= k + 1 - extra)
        out.append((at, n))
        at += n
    return out


def _keys(s: str) -> list[tuple[str, int]]:
    """Shard keys of ``s``: role 0 as member, role 1 as query for shorter or equal strings."""
    m, out = len(s), []
    if k := reach(m):
        out = [(f"{m}|{i}|{s[p:p + n]}", 0) for i, (p, n) in enumerate(_segments(m, k))]
    for length in range(max(3, m - 2), m + 1):
        k, gap = reach(length), m - length
        if gap > k:
            continue
        for i, (p, n) in enumerate(_segments(length, k)):
            lo, hi = max(0, p - i, p + gap - (k - i)), min(m - n, p + i, p + gap + (k - i))
            out += [(f"{length}|{i}|{x}", 1) for x in {s[at:at + n] for at in range(lo, hi + 1)}]
    return out


@lru_cache(maxsize=None)
def universal(k: int) -> tuple[list[tuple[int, ...]], list[list[int]]]:
    """States and transitions of the universal Levenshtein automaton for ``k`` edits.

    A state holds, for a prefix of length ``i`` read, the distances to the query's
    prefixes of lengths ``i - k .. i + k``, cut off at ``k + 1``.  Bit ``o`` of a
    letter says that the query has the character read at place ``i + o - k``.
    Transition -1: no distance is within reach any more.
    """
    width, far = 2 * k + 1, k + 1
    states: list[tuple[int, ...]] = [tuple(o - k if o >= k else far for o in range(width))]
    number, table = {states[0]: 0}, []
    for state in states:  # grows while it is walked
        row = []
        for bits in range(1 << width):
            new: list[int] = []
            for o in range(width):
                d = state[o] + (not bits >> o & 1)
                if o + 1 < width:
                    d = min(d, state[o + 1] + 1)
                if o:
                    d = min(d, new[o - 1] + 1)
                new.append(min(d, far))
            to = tuple(new)
            if min(to) >= far:
                row.append(-1)
                continue
            if to not in number:
                number[to] = len(states)
                states.append(to)
            row.append(number[to])
        table.append(row)
    return states, table


class Trie:
    """Strings; ``near`` runs the automaton of a query over them."""

    def __init__(self) -> None:
        self.root: dict = {}
        self.size = 0

    def add(self, s: str) -> None:
        node = self.root
        for c in s:
            node = node.setdefault(c, {})
        if "" not in node:
            node[""] = s
            self.size += 1

    def near(self, q: str, k: int) -> list[tuple[str, int]]:
        """``(string, distance)`` of the strings within ``k`` edits of ``q``."""
        states, table = universal(k)
        places: dict[str, int] = {}
        for p, c in enumerate(q):
            places[c] = places.get(c, 0) | 1 << (p + k)
        window, shift, out = (1 << (2 * k + 1)) - 1, len(q) + k, []
        get, stack = places.get, [(self.root, 0, 0)]
        while stack:
            node, i, state = stack.pop()
            row = table[state]
            for c, child in node.items():
                if c == "":
                    o = shift - i
                    if 0 <= o <= 2 * k and states[state][o] <= k:
                        out.append((child, states[state][o]))
                    continue
                to = row[get(c, 0) >> i & window]
                if to >= 0:
                    stack.append((child, i + 1, to))
        return out


def _placed(strings: DataFrame) -> DataFrame:
    """``(key, part, q, role, side, s)``: strings at every part of a shard they have to visit."""

    def shard(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(k, r, side, s) for s, side in zip(pdf["s"], pdf["side"]) for k, r in _keys(s)]
            yield pd.DataFrame(rows, columns=["key", "role", "side", "s"])

    rows = strings.mapInPandas(shard, "key string, role int, side int, s string")
    # Only shards beyond the size of a part are cut.
    sizes = rows.groupBy("key").agg(F.count_if(F.col("role") == 0).alias("n"), F.count_if(F.col("role") == 1).alias("asked")).where((F.col("n") > SHARD) | (F.col("asked") > QUERIES))
    grid = lambda n, size: F.ceil(F.col(n) / size).cast("int")
    large = sizes.select("key", F.greatest(grid("n", SHARD), F.lit(1)).alias("parts"), F.greatest(grid("asked", QUERIES), F.lit(1)).alias("qs"))
    one = F.array(F.lit(0))
    mine = lambda n: F.when(F.col(n) > 1, F.array(F.pmod(F.xxhash64("s"), F.col(n)).cast("int"))).otherwise(one)
    every = lambda n: F.when(F.col(n) > 1, F.sequence(F.lit(0), F.col(n) - 1)).otherwise(one)
    member = F.col("role") == 0
    placed = rows.join(large, "key", "left").withColumn("part", F.explode(F.when(member, mine("parts")).otherwise(every("parts"))))
    return placed.withColumn("q", F.explode(F.when(member, every("qs")).otherwise(mine("qs")))).select("key", "part", "q", "role", "side", "s")


def trie_match(left: DataFrame, right: DataFrame) -> DataFrame:
    """``(a, b, d)``: every ``a`` of ``left`` and other ``b`` of ``right`` in reach of each other.

    Both tables have one column of strings.  The shorter string's :func:`reach`
    applies.  Null strings and those that begin with :data:`EXACT` are in no pair.
    """
    one = lambda df, side: df.select(F.col(df.columns[0]).alias("s")).where(~F.col("s").startswith(EXACT)).distinct().withColumn("side", F.lit(side))
    both = one(left, 1).unionByName(one(right, 2)).groupBy("s").agg(F.sum("side").cast("int").alias("side"))

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, k, tries = None, 0, {1: Trie(), 2: Trie()}
        for pdf in batches:
            found = []
            for key, part, q, role, side, s in zip(pdf["key"], pdf["part"], pdf["q"], pdf["role"], pdf["side"], pdf["s"]):
                if at != (key, part, q):
                    at, k, tries = (key, part, q), reach(int(key[: key.index("|")])), {1: Trie(), 2: Trie()}
                for own, other in ((1, 2), (2, 1)):
                    if not side & own:
                        continue
                    if role == 0:
                        tries[own].add(s)
                    elif tries[other].size:
                        hits = tries[other].near(s, k)
                        found += [(s, x, d) if own == 1 else (x, s, d) for x, d in hits if x != s]
            yield pd.DataFrame(found, columns=["a", "b", "d"])

    ordered = _placed(both).repartition("key", "part", "q").sortWithinPartitions("key", "part", "q", "role")
    return ordered.mapInPandas(walk, "a string, b string, d int").groupBy("a", "b").agg(F.min("d").alias("d"))


def trie_join(strings: DataFrame, col: str) -> DataFrame:
    """``(a, b, d)`` with ``a < b``: every pair of distinct strings in reach of each other.

    As :func:`trie_match` of the strings with themselves, each pair once.
    """
    vocab = strings.select(F.col(col).alias("s")).where(~F.col("s").startswith(EXACT) & (F.length("s") >= 3)).distinct().withColumn("side", F.lit(1))

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, k, trie = None, 0, Trie()
        for pdf in batches:
            found = []
            for key, part, q, role, s in zip(pdf["key"], pdf["part"], pdf["q"], pdf["role"], pdf["s"]):
                if at != (key, part, q):
                    at, k, trie = (key, part, q), reach(int(key[: key.index("|")])), Trie()
                if role == 0:
                    trie.add(s)
                elif trie.size:
                    found += [(min(s, x), max(s, x), d) for x, d in trie.near(s, k) if x != s]
            yield pd.DataFrame(found, columns=["a", "b", "d"])

    ordered = _placed(vocab).repartition("key", "part", "q").sortWithinPartitions("key", "part", "q", "role")
    return ordered.mapInPandas(walk, "a string, b string, d int").groupBy("a", "b").agg(F.min("d").alias("d"))


def neighbours(strings: DataFrame, col: str) -> DataFrame:
    """``(a, b, d)`` both ways, every string being its own neighbour at 0."""
    pairs = trie_join(strings, col)
    own = strings.select(F.col(col).alias("a")).where(F.col("a").isNotNull()).distinct().select("a", F.col("a").alias("b"), F.lit(0).alias("d"))
    both = pairs.select(F.explode(F.array(F.struct("a", "b", "d"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), "d"))).alias("p")).select("p.*")
    return both.unionByName(own)
