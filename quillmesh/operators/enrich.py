"""Enrichment cascades, key-value upserts, edges, validation decisions, checkpoints."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import PipelineConfig
from ..functions.dates import validate_dates
from ..functions.text import author_key

#: Width of the slices of an order that are ranked in one task.
SLICE = 100_000


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """All keys of both sides; where both have a row, the new one counts."""
    return old.join(new.select(key), key, "left_anti").unionByName(new)


def update_present(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Only keys that are there already get the new values; nulls do not overwrite."""
    n = new.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_n_{c}") for c in new.columns if c != key])
    out = old.join(n, old[key] == n["_k"], "left")
    return out.select(*[F.coalesce(f"_n_{c}", c).alias(c) if f"_n_{c}" in out.columns else F.col(c) for c in old.columns])


def cascade(base: DataFrame, key: str, layers: Sequence[tuple[str, DataFrame]], fields: Sequence[str]) -> DataFrame:
    """``base`` with ``fields`` from the first layer that has each, and ``origin`` of the first layer that answers.

    Layers are ``(name, table with key and fields)``, one row per key.
    """
    out, got = base, {f: [] for f in fields}
    origin: list[Column] = []
    for name, layer in layers:
        cols = [F.col(f).alias(f"_{name}_{f}") for f in fields]
        out = out.join(layer.select(F.col(key).alias(f"_{name}_key"), *cols), out[key] == F.col(f"_{name}_key"), "left")
        for f in fields:
            got[f].append(F.col(f"_{name}_{f}"))
        origin.append(F.when(F.col(f"_{name}_key").isNotNull(), name))
    return out.select(*base.columns, *[F.coalesce(*got[f]).alias(f) for f in fields], F.coalesce(*origin).alias("origin"))


def enrich_authors(names: DataFrame, cache: DataFrame, people: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(authors, new_cache)``: life dates of distinct names, checked; misses are cached as nulls.

    ``names``: ``(name)``; ``cache`` and ``people``: ``(name, birth_year, death_year)``.
    """
    distinct = names.where("name IS NOT NULL").select("name").distinct()
    found = cascade(distinct, "name", [("cache", cache), ("people", people)], ["birth_year", "death_year"])
    ok = validate_dates(F.col("birth_year"), F.col("death_year"))
    authors = found.select("name", ok["birth_year"].alias("birth_year"), ok["death_year"].alias("death_year"), "origin")
    fresh = authors.where("origin IS NULL OR origin <> 'cache'").select("name", "birth_year", "death_year")
    return authors, upsert(cache.select("name", "birth_year", "death_year"), fresh, "name")


def enrich_books(books: DataFrame, cache: DataFrame, layers: Sequence[tuple[str, DataFrame]]) -> tuple[DataFrame, DataFrame]:
    """``(books, new_cache)``: the original year of books ``(book_id, ...)`` from the cache, else the first layer that has one.

    ``cache`` and the layers: ``(book_id, year)``.  Years found are written back to the cache.
    """
    one = lambda df: df.where("book_id IS NOT NULL AND year IS NOT NULL").groupBy("book_id").agg(F.min("year").alias("year"))
    found = cascade(books, "book_id", [("cache", one(cache)), *[(n, one(df)) for n, df in layers]], ["year"])
    fresh = found.where("year IS NOT NULL AND origin <> 'cache'").select("book_id", "year").distinct()
    return found.withColumnRenamed("year", "original_year"), upsert(cache.select("book_id", "year"), fresh, "book_id")


def cache_probe(names: DataFrame, cache: DataFrame, threshold: float = PipelineConfig.cache_similarity) -> DataFrame:
    """``(name, key, value)``: the cache entry of each name: the equal key, else the first that is similar enough.

    ``names``: ``(name)``; ``cache``: ``(key, ord, value)``, keys as :func:`author_key` makes
    them.  Texts as similar as 0.9 share a run of three letters (one letter in five is
    lost at most); pairs meet by such runs, and a bound on the lengths leaves
    few to be compared in full.
    """
    asked = names.where("name IS NOT NULL").select("name").distinct().withColumn("k", author_key(F.col("name")))
    first = cache.groupBy("key").agg(F.min_by(F.struct("ord", "value"), "ord").alias("e"))
    exact = asked.join(first, F.col("k") == F.col("key")).select("name", "key", "e.value")
    rest = asked.join(exact.select("name"), "name", "left_anti")
    runs = lambda c: F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - 2, F.lit(1))), lambda i: F.substring(c, i, F.lit(3))))
    left = rest.select("k").distinct().withColumn("g", F.explode(runs(F.col("k"))))
    right = first.select("key").withColumn("g", F.explode(runs(F.col("key"))))
    most = 2 * F.least(F.length("k"), F.length("key"))
    pairs = left.join(right, "g").where(most >= threshold * (F.length("k") + F.length("key"))).select("k", "key").distinct()

    @F.pandas_udf("boolean")
    def alike(x: pd.Series, y: pd.Series) -> pd.Series:
        def near(p: str, q: str) -> bool:
            m = SequenceMatcher(None, p, q)
            return m.quick_ratio() >= threshold and m.ratio() >= threshold

        return pd.Series([near(p, q) for p, q in zip(x, y)], dtype=bool)

    got = pairs.where(alike("k", "key")).join(first, "key").groupBy("k").agg(F.min_by(F.struct("key", "e.value"), "e.ord").alias("b"))
    return exact.unionByName(rest.join(got, "k").select("name", "b.key", "b.value"))


def project_record(books: DataFrame) -> DataFrame:
    """Catalogue records as lookups return them: blanks dropped, numbers read leniently, names trimmed, descriptions capped.

    The resolved names count, where there are any (``author_names_resolved``), else
    those of ``authors``; ``url`` stands in for a missing ``link``.
    """
    text = lambda c: F.nullif(F.col(c).cast("string"), F.lit(""))
    names = F.filter(F.transform("authors", lambda a: F.trim(a["name"])), lambda n: n != "")
    if "author_names_resolved" in books.columns:
        names = F.when(F.size("author_names_resolved") > 0, F.col("author_names_resolved")).otherwise(names)
    about, cap = F.trim("description"), PipelineConfig.description_cap
    link = F.coalesce(text("link"), text("url")) if "url" in books.columns else text("link")
    kinds = {"publication_year": "int", "publication_month": "int", "publication_day": "int", "num_pages": "int", "average_rating": "double", "ratings_count": "bigint", "text_reviews_count": "bigint"}
    return books.select(
        text("book_id").alias("book_id"), text("title").alias("title"), F.when(F.size(names) > 0, names).alias("author_names"),
        F.when(F.length(about) > cap, F.concat(F.rtrim(F.substring(about, 1, cap)), F.lit("..."))).otherwise(F.nullif(about, F.lit(""))).alias("description"),
        *[text(c).try_cast(k).alias(c) for c, k in kinds.items() if c in books.columns], *[text(c).alias(c) for c in ("work_id", "publisher") if c in books.columns], link.alias("link"),
    )


def denormalise_authors(books: DataFrame, authors: DataFrame) -> DataFrame:
    """``(book_id, author_names)``: names of a record in order, each followed by the one its id is listed under, each once.

    ``books``: ``(book_id, authors array<struct<author_id, name>>)``; ``authors``: ``(author_id, name)``.
    """
    each = books.select("book_id", F.posexplode("authors").alias("p", "a")).select("book_id", "p", "a.*")
    listed = authors.groupBy("author_id").agg(F.min("name").alias("listed"))
    named = each.select("book_id", (F.col("p") * 2).alias("p"), "name").unionByName(each.join(listed, "author_id").select("book_id", (F.col("p") * 2 + 1).alias("p"), F.col("listed").alias("name")))
    first = named.where("name IS NOT NULL").groupBy("book_id", "name").agg(F.min("p").alias("p"))
    return first.groupBy("book_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("p", "name"))), lambda x: x["name"]).alias("author_names"))


Decider = Callable[[list[dict]], list[dict]]


def validate(cites: DataFrame, decider: Decider, group: str = "group", ord_: str = "ord", size: int = PipelineConfig.validation_batch, attempts: int = 3) -> DataFrame:
    """``(group, ord, status, reason, fixed_author, fixed_title)`` by a provider asked with batches of ``size``.

    The provider gets ``index, author, title, count`` of a batch and returns decisions
    with ``index``.  A batch whose provider fails every attempt gets none, so its
    citations are kept.
    """
    kinds = dict(cites.dtypes)
    packed = batch_numbers(cites, group, ord_, size).groupBy(group, "batch").agg(F.array_sort(F.collect_list(F.struct("index", ord_, "author", "title", F.col("cite_count").alias("count")))).alias("rows"))
    schema = f"{group} {kinds[group]}, {ord_} {kinds[ord_]}, status string, reason string, fixed_author string, fixed_title string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for g, rows in zip(pdf[group], pdf["rows"]):
                ords = {r["index"]: r[ord_] for r in rows}
                for _ in range(attempts):
                    try:
                        made = decider([{k: r[k] for k in ("index", "author", "title", "count")} for r in rows])
                        out += [(g, ords[d["index"]], d.get("status", "keep"), d.get("reason"), d.get("fixed_author"), d.get("fixed_title")) for d in made if d.get("index") in ords]
                        break
                    except Exception:  # a provider may raise anything; its batch is kept whole
                        continue
            yield pd.DataFrame(out, columns=[group, ord_, "status", "reason", "fixed_author", "fixed_title"])

    return packed.select(group, "rows").mapInPandas(run, schema)


def missing(wanted: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Keys still to fetch: wanted, not null, each once, and not done."""
    return wanted.where(F.col(key).isNotNull()).select(key).distinct().join(done.select(key), key, "left_anti")


def apply_decisions(cites: DataFrame, decisions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Citations after keep, fix and remove; undecided ones stay.

    The last decision of a key counts.  Blank fixes do not overwrite.
    """
    last = decisions.groupBy(*keys).agg(F.max_by(F.struct("status", "fixed_author", "fixed_title"), "ord").alias("_d"))
    out = cites.join(last, list(keys), "left")
    fix = F.coalesce(F.col("_d.status") == "fix", F.lit(False))
    take = lambda new, old: F.when(fix, F.coalesce(F.nullif(F.trim(new), F.lit("")), F.col(old))).otherwise(F.col(old))
    return out.where(F.coalesce(F.col("_d.status"), F.lit("keep")) != "remove").withColumns(
        {"author": take(F.col("_d.fixed_author"), "author"), "title": take(F.col("_d.fixed_title"), "title"), "fixed": fix}
    ).drop("_d")


def batch_numbers(df: DataFrame, group: str, ord_: str, size: int = 30) -> DataFrame:
    """``batch`` and ``index`` of each row within its book.

    Rows are ranked within slices of the order, and the slices' sizes summed, so that
    a book with very many rows is not one task.
    """
    cut = F.floor(F.col(ord_) / SLICE)
    sized = df.groupBy(F.col(group).alias("_g"), cut.alias("_s")).agg(F.count("*").alias("_n"))
    before = sized.withColumn("_before", F.coalesce(F.sum("_n").over(W.partitionBy("_g").orderBy("_s").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    rows = df.withColumn("_cut", cut).join(before, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_cut") == F.col("_s")))
    rn = F.col("_before") + F.row_number().over(W.partitionBy(group, "_cut").orderBy(ord_)) - 1
    return rows.withColumn("_rn", rn).select(*df.columns, F.floor(F.col("_rn") / size).cast("int").alias("batch"), (F.col("_rn") % size).cast("int").alias("index"))


def resume(todo: DataFrame, done: DataFrame, keys: Sequence[str] = ("author", "title")) -> DataFrame:
    """Rows whose keys are not done yet; null equals null."""
    d = done.select(*[F.col(k).alias(f"_d_{k}") for k in keys]).distinct()
    cond = None
    for k in keys:
        c = todo[k].eqNullSafe(d[f"_d_{k}"])
        cond = c if cond is None else cond & c
    return todo.join(d, cond, "left_anti")


def author_cache(rows: DataFrame) -> DataFrame:
    """``(key, value)``: entries under the full and the last name, later rows winning.

    ``rows``: ``(ord, author, value)``.
    """
    low = F.lower(F.trim("author"))
    return rows.where("trim(author) <> ''").select("ord", "value", F.explode(F.array_distinct(F.array(low, F.element_at(F.split(low, r"\s+"), -1)))).alias("key")).groupBy("key").agg(
        F.max_by("value", "ord").alias("value")
    )


def fill_missing(base: DataFrame, other: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Fields that are null in ``base`` come from ``other``."""
    o = other.select(F.col(key).alias("_k"), *[F.col(f).alias(f"_o_{f}") for f in fields])
    return base.join(o, base[key] == o["_k"], "left").select(*[F.coalesce(c, f"_o_{c}").alias(c) if c in fields else F.col(c) for c in base.columns])
