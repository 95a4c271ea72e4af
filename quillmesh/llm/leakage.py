"""Problem 6: evaluation passages inside a training corpus.

The normalised test items form one generalised suffix automaton over words.
Every document streams through it once; the automaton tracks the longest match
that ends at each word, and whenever a match of ``MIN_RUN`` words or more ends,
it is kept as a run (document position, item, item position, length).  Runs of an
item are chained in order; small gaps on both sides (a changed, misspelt,
inserted or dropped word, a page number) are bridged.  A document leaks an item
when the chain covers ``coverage`` of its words in at most ``max_stretches``
stretches.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold

MIN_RUN = 3
COVERAGE = 0.5
MAX_STRETCHES = 4
#: Words of test items in one automaton; more items are taken in blocks.
BLOCK_WORDS = 2_000_000

_HYPHENED = re.compile(r"(?<=[^\W\d_])[-‐­]\s*\n\s*(?=[^\W\d_])")
_MARKS = re.compile(r"[­​‌‍﻿]")
_WORD = re.compile(r"[^\W_]+")


def normal_words(text: str | None) -> list[str]:
    """Folded words; words divided at a line end are joined again."""
    if not text:
        return []
    if not text.isascii():
        text = _MARKS.sub("", text)
    if "-\n" in text or "- \n" in text or "‐" in text:
        text = _HYPHENED.sub("", text)
    return _WORD.findall(text.lower() if text.isascii() else fold(text))


class SuffixAutomaton:
    """Generalised suffix automaton over integer words of many items."""

    def __init__(self, items: list[tuple[int, list[str]]]):
        self.vocab: dict[str, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link: list[int] = [-1]
        self.len: list[int] = [0]
        self.ends: list[list[tuple[int, int]]] = [[]]
        self.items = [(i, w) for i, w in items]
        for k, (_, ws) in enumerate(self.items):
            last = 0
            for at, word in enumerate(ws):
                last = self._extend(last, self.vocab.setdefault(word, len(self.vocab)))
                self.ends[last].append((k, at))
        self.children: list[list[int]] = [[] for _ in self.next]
        for v, p in enumerate(self.link):
            if p >= 0:
                self.children[p].append(v)
        self.shortest = min((len(w) for _, w in self.items), default=0)

    def _state(self, length: int, link: int, nxt: dict[int, int]) -> int:
        self.next.append(nxt)
        self.len.append(length)
        self.link.append(link)
        self.ends.append([])
        return len(self.next) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        clone = self._state(self.len[p] + 1, self.link[q], dict(self.next[q]))
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def _extend(self, last: int, c: int) -> int:
        q = self.next[last].get(c)
        if q is not None:
            return q if self.len[q] == self.len[last] + 1 else self._split(last, c, q)
        cur = self._state(self.len[last] + 1, 0, {})
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = cur
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[cur] = q if self.len[q] == self.len[p] + 1 else self._split(p, c, q)
        return cur

    def occurrences(self, state: int) -> list[tuple[int, int]]:
        """(item, last position) of every place where the state's words stand."""
        found, todo = [], [state]
        while todo:
            v = todo.pop()
            found.extend(self.ends[v])
            todo.extend(self.children[v])
        return found

    def matches(self, ws: list[str], min_run: int) -> list[tuple[int, int, int]]:
        """Maximal matches ``(document end, state, length)`` of a document."""
        out = []
        nxt, link, length, get = self.next, self.link, self.len, self.vocab.get
        v = n = 0
        for pos, word in enumerate(ws):
            c = get(word)
            if c is None:
                if n >= min_run:
                    out.append((pos, v, n))
                v = n = 0
                continue
            u = nxt[v].get(c)
            if u is not None:
                v, n = u, n + 1
                continue
            if n >= min_run:
                out.append((pos, v, n))
            while v > 0 and c not in nxt[v]:
                v = link[v]
                n = length[v]
            u = nxt[v].get(c)
            if u is None:
                v = n = 0
            else:
                v, n = u, n + 1
        if n >= min_run:
            out.append((len(ws), v, n))
        return out

    def runs(self, ws: list[str], min_run: int, coverage: float) -> dict[int, list[tuple[int, int, int]]]:
        """item -> [(document start, item start, length)] of the items in reach.

        In reach are items with runs of ``min_run`` words that add up to half the
        coverage wanted; bridged gaps cannot supply more.
        """
        found = self.matches(ws, min_run)
        if 2 * sum(n for _, _, n in found) < coverage * self.shortest:
            return {}
        total: dict[int, int] = defaultdict(int)
        for _, v, n in found:
            for k in {k for k, _ in self.occurrences(v)}:
                total[k] += n
        near = {k for k, n in total.items() if 2 * n >= coverage * len(self.items[k][1])}
        out: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        for end, v, n in found if near else ():
            for k, at in self.occurrences(v):
                if k in near:
                    out[k].append((end - n, at - n + 1, n))
        return out


def _alike(a: str, b: str) -> bool:
    """Equal but for one letter in four or so."""
    if a == b:
        return True
    if min(len(a), len(b)) < 4 or abs(len(a) - len(b)) > 2:
        return False
    most, row = max(1, max(len(a), len(b)) // 4), list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1] <= most


def _between(doc: list[str], item: list[str]) -> int:
    """Words of ``item`` that stand in ``doc`` in order, spelling aside."""
    row = [0] * (len(item) + 1)
    for d in doc:
        prev = 0
        for j, w in enumerate(item, 1):
            prev, row[j] = row[j], (prev + 1 if _alike(d, w) else max(row[j], row[j - 1]))
    return row[-1]


#: Words between two runs of one stretch at most, in the item and in the document; words of a stretch that counts at
#: least; words that a stretch may be prolonged by, spelling aside, at either end.
GAP_ITEM, GAP_DOC, MIN_STRETCH, EDGE = 8, 14, 5, 12


def stretches(doc: list[str], item: list[str], runs: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """``(words, document start, document end)`` of the stretches of the best chain of runs."""
    runs = sorted(set(runs))
    best: list[tuple[float, int, int]] = []  # (score, previous, words new to the chain)
    for i, (d, t, n) in enumerate(runs):
        score, back, new = float(n), -1, n
        # Runs farther back than the item is long and the gaps are wide belong to another copy.
        for j in range(i - 1, -1, -1):
            pd_, pt, pn = runs[j]
            if d - pd_ - pn > 4 * (len(item) + GAP_DOC):
                break
            over = max(0, pd_ + pn - d, pt + pn - t)
            if t < pt or over >= n:
                continue
            gd, gt = d + over - pd_ - pn, t + over - pt - pn
            near = gd <= GAP_DOC and gt <= GAP_ITEM
            s = best[j][0] + (n - over) - (0.2 if near else 2.5) - 0.05 * abs(gd - gt if near else 0)
            if s > score:
                score, back, new = s, j, n - over
        best.append((score, back, new))
    at = max(range(len(best)), key=lambda k: best[k][0])
    chain = []
    while at >= 0:
        chain.append((runs[at], best[at][2]))
        at = best[at][1]
    chain.reverse()
    out: list[list[int]] = []
    end_d = end_t = 0
    for (d, t, n), new in chain:
        d, t = d + n - new, t + n - new
        if out and d - end_d <= GAP_DOC and t - end_t <= GAP_ITEM:
            gap = t - end_t
            got = _between(doc[end_d:d], item[end_t:t]) if gap else 0
            out[-1][0] += new + (gap if gap <= 2 and d - end_d <= 4 else got)
        else:
            if out:
                more = _edge(doc, item, end_d, end_t, 1)
                out[-1][0], out[-1][2] = out[-1][0] + more, out[-1][2] + more
            more = _edge(doc, item, d, t, -1)
            out.append([new + more, d - more, d])
        end_d, end_t = d + new, t + new
        out[-1][2] = end_d
    more = _edge(doc, item, end_d, end_t, 1)
    out[-1][0], out[-1][2] = out[-1][0] + more, out[-1][2] + more
    return [(n, a, b) for n, a, b in out if n >= MIN_STRETCH]


def covered(doc: list[str], item: list[str], runs: list[tuple[int, int, int]], max_stretches: int = MAX_STRETCHES) -> float:
    """Share of the item's words that the best chain of runs reproduces."""
    kept = sorted((n for n, _, _ in stretches(doc, item, runs)), reverse=True)[:max_stretches]
    return min(1.0, sum(kept) / len(item))


def _edge(doc: list[str], item: list[str], d: int, t: int, step: int) -> int:
    """Words that go on matching, spelling aside, before or after a stretch."""
    n = miss = gained = 0
    while miss < 2 and n < EDGE:
        i, j = (d + n, t + n) if step > 0 else (d - 1 - n, t - 1 - n)
        if not (0 <= i < len(doc) and 0 <= j < len(item)):
            break
        if _alike(doc[i], item[j]):
            gained, miss = gained + 1, 0
        else:
            miss += 1
        n += 1
    return gained


class Items:
    """One block of test items: long ones in an automaton, short ones as phrases that count only whole."""

    def __init__(self, block: list[tuple[int, list[str]]], min_run: int):
        self.min_run = min_run
        self.long = SuffixAutomaton([(i, w) for i, w in block if len(w) >= 2 * min_run])
        self.short: dict[tuple[str, ...], list] = defaultdict(list)
        for i, w in block:
            if min_run <= len(w) < 2 * min_run:
                self.short[tuple(w)].append(i)
        self.lengths = sorted({len(w) for w in self.short})

    def leaks(self, ws: list[str], coverage: float, max_stretches: int) -> Iterator[tuple[object, float, list[tuple[int, int]]]]:
        """``(item, share, word ranges)`` of the items that a document holds."""
        for k, runs in self.long.runs(ws, self.min_run, coverage).items():
            item, words = self.long.items[k]
            found = sorted(stretches(ws, words, runs), reverse=True)[:max_stretches]
            share = min(1.0, sum(n for n, _, _ in found) / len(words))
            if share >= coverage:
                yield item, share, [(a, b) for _, a, b in found]
        for n in self.lengths:
            for at in range(len(ws) - n + 1):
                for item in self.short.get(tuple(ws[at:at + n]), ()):
                    yield item, 1.0, [(at, at + n)]


_ORIGINAL = re.compile(r"[^\W_](?:[^\W_]|[­​‌‍﻿]|[-‐­]\s*\n\s*(?=[^\W\d_]))*")


def placed_words(text: str) -> tuple[list[str], list[tuple[int, int]]]:
    """The words of a text and where each stands in it."""
    words: list[str] = []
    at: list[tuple[int, int]] = []
    for m in _ORIGINAL.finditer(text):
        for w in normal_words(m.group()):
            words.append(w)
            at.append(m.span())
    return words, at


def _blocks(items: DataFrame, item_id: str, item_text: str, min_run: int) -> Iterator[list[tuple[int, list[str]]]]:
    """Items as words, block by block; never all at once on the driver."""
    block, held = [], 0
    for row in items.select(item_id, item_text).where(F.col(item_id).isNotNull() & F.col(item_text).isNotNull()).toLocalIterator():
        ws = normal_words(row[1])
        if len(ws) >= min_run:
            block.append((row[0], ws))
            held += len(ws)
        if held >= BLOCK_WORDS:
            yield block
            block, held = [], 0
    yield block


def remove_leaks(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "citation_excerpt",
    coverage: float = COVERAGE, min_run: int = MIN_RUN, max_stretches: int = MAX_STRETCHES,
) -> DataFrame:
    """``(id_col, text_col, removed)``: texts without the passages of items they hold; ``removed`` counts the characters cut.

    Every document comes out, one row for each row given; a null text stays null.
    What is cut are the stretches that make a document leak, from their first word
    to their last.  Items as for :func:`find_leaks`.
    """
    spark = docs.sparkSession
    out = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.lit(0).cast("long").alias("_cut"))
    for block in _blocks(items, item_id, item_text, min_run):
        shared = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            held = Items(shared.value, min_run)
            for pdf in batches:
                texts, cuts = [], []
                for text, cut in zip(pdf["_text"], pdf["_cut"]):
                    if text:
                        ws, at = placed_words(text)
                        ranges = sorted((at[a][0], at[b - 1][1]) for _, _, spans in held.leaks(ws, coverage, max_stretches) for a, b in spans)
                        end, parts = 0, []
                        for a, b in ranges:
                            if b > end:
                                parts.append(text[end:max(a, end)])
                                cut += b - max(a, end)
                                end = b
                        text = "".join(parts) + text[end:]
                    texts.append(text)
                    cuts.append(cut)
                yield pd.DataFrame({"_id": pdf["_id"], "_text": texts, "_cut": cuts})

        out = out.mapInPandas(run, f"_id {dict(out.dtypes)['_id']}, _text string, _cut long")
    return out.select(F.col("_id").alias(id_col), F.col("_text").alias(text_col), F.col("_cut").alias("removed"))


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "citation_excerpt",
    coverage: float = COVERAGE,
    min_run: int = MIN_RUN,
    max_stretches: int = MAX_STRETCHES,
) -> DataFrame:
    """``(id_col, item_id, coverage)`` for every document that holds an item.

    The items are the stated query set; they go to the tasks in blocks of at
    most ``BLOCK_WORDS`` words, however many there are, and all documents are
    scanned whole against each block.  Items of fewer than ``2 * min_run`` words leak
    only whole; items of fewer than ``min_run`` words are no passages, and null or empty
    texts match nothing.  Repeated rows give one result row.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).where(F.col("_text").isNotNull())
    schema = f"_id {dict(slim.dtypes)['_id']}, _item {dict(items.dtypes)[item_id]}, coverage double"
    found = None
    for block in _blocks(items, item_id, item_text, min_run):
        shared = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            held = Items(shared.value, min_run)
            for pdf in batches:
                out = [(i, item, share) for i, text in zip(pdf["_id"], pdf["_text"]) for item, share, _ in held.leaks(normal_words(text), coverage, max_stretches)]
                yield pd.DataFrame(out, columns=["_id", "_item", "coverage"])

        part = slim.mapInPandas(run, schema)
        found = part if found is None else found.unionByName(part)
    return found.groupBy(F.col("_id").alias(id_col), F.col("_item").alias(item_id)).agg(F.max("coverage").alias("coverage"))
