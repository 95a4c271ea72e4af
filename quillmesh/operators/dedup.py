"""Merging resolved citations by work, and editions inside the graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import article_title, author_key, is_real_id, viewer_title


TEXTS = ("contexts", "commentaries")


def united(rows: DataFrame, keys: list[str], col: str, rank: list[str]) -> DataFrame:
    """``(keys, col)``: the distinct elements of an array column per key, by their first place.

    Rows come in the order of ``rank``.  Elements are reduced to their first place per
    key before they are collected, so a key costs what its result holds.
    """
    each = rows.select(*keys, *rank, F.posexplode(col).alias("_p", "_v")).groupBy(*keys, "_v").agg(F.min(F.struct(*rank, "_p")).alias("_at"))
    return each.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("_at", "_v"))), lambda x: x["_v"]).alias(col))


def merge_groups(df: DataFrame, key: Column, id_col: str = "book_id", ord_: str = "ord", count: str = "cite_count", scope: str | None = None) -> DataFrame:
    """Groups of two or more rows with two or more ids (null is one) become their keeper.

    The keeper is real before made up, then of highest count, then earliest; it gets
    the counts of the group and, where there are such columns, the contexts and
    commentaries of the other rows after its own.  Other rows stay as they are.
    Null keys form no group.  Columns added: ``merged`` (rows in it).
    """
    k = F.when(key.isNotNull(), F.to_json(F.struct(F.col(scope) if scope else F.lit(""), key)) if scope else key.cast("string"))
    keyed = df.withColumn("_k", k)
    stats = keyed.where("_k IS NOT NULL").groupBy("_k").agg(
        F.count("*").alias("_n"), (F.countDistinct(id_col) + F.max(F.col(id_col).isNull().cast("int"))).alias("_ids"),
        F.max_by(ord_, F.struct(is_real_id(F.col(id_col).cast("string")).cast("int"), F.col(count), -F.col(ord_))).alias("_keep"), F.sum(count).alias("_sum"),
    ).where("_n >= 2 AND _ids >= 2").withColumnRenamed("_k", "_gk")
    out = keyed.join(stats, F.col("_k") == F.col("_gk"), "left")
    merged, keeps = F.col("_gk").isNotNull(), F.col(ord_) == F.col("_keep")
    result = out.where(~merged | keeps).withColumns({
        count: F.when(merged, F.col("_sum")).otherwise(F.col(count)), "merged": F.when(merged, F.col("_n")).otherwise(F.lit(1).cast("bigint"))
    })
    groups = out.where(merged).withColumns({"_late": (~keeps).cast("int"), "_o": F.col(ord_)})
    for col in (c for c in TEXTS if c in df.columns):
        texts = united(groups.select("_gk", "_late", "_o", col), ["_gk"], col, ["_late", "_o"]).select(F.col("_gk").alias("_tk"), F.col(col).alias("_t"))
        result = result.join(texts, F.col("_gk") == F.col("_tk"), "left").withColumn(col, F.when(merged, F.coalesce("_t", F.array().cast("array<string>"))).otherwise(F.col(col))).drop("_tk", "_t")
    return result.select(*df.columns, "merged")


def dedup_by_work(df: DataFrame, scope: str | None = None) -> DataFrame:
    """First pass: by the work of the catalogue match."""
    return merge_groups(df, F.nullif(F.col("work_id"), F.lit("")), scope=scope)


def dedup_by_author_title(df: DataFrame, scope: str | None = None) -> DataFrame:
    """Second pass: by normalised author and title of what is left."""
    who = author_key(F.coalesce(F.nullif("canonical_author", F.lit("")), F.nullif("author", F.lit("")), F.lit("?")))
    what = article_title(F.coalesce("title", F.lit("")))
    return merge_groups(df, F.when(what != "", F.concat_ws("|", who, what)), scope=scope)


def retro_dedup(df: DataFrame, scope: str | None = None) -> DataFrame:
    """Second pass for stored graphs: the author only lower-cased."""
    what = article_title(F.coalesce("title", F.lit("")))
    return merge_groups(df, F.when(what != "", F.concat_ws("|", F.lower(F.trim("author")), what)), scope=scope)


#: Match types from best to worst.
MATCH_ORDER = ("book", "author", "person", "not_found", "unknown", "error")


def cleanup_merge(df: DataFrame, ord_: str = "ord") -> DataFrame:
    """Rows of one author and title as one: best match type first, counts and texts of all, the other titles listed.

    Other titles are listed only where a group has more than one that is not blank.
    """
    place = F.array_position(F.array(*[F.lit(m) for m in MATCH_ORDER]), F.coalesce("match_type", F.lit("error")))
    rank = F.when(place == 0, len(MATCH_ORDER)).otherwise(place).cast("int")
    keyed = df.withColumns({"_a": author_key(F.col("author"), saint=False), "_t": author_key(F.col("title"), saint=False), "_rank": rank, "_o": F.col(ord_)})
    g = keyed.groupBy("_a", "_t").agg(
        F.min_by(F.struct("author", "title", "match_type"), F.struct("_rank", "_o")).alias("_b"),
        F.sum(F.coalesce("cite_count", F.lit(1))).alias("cite_count"), F.count("*").alias("merged"), F.array_sort(F.collect_set(F.nullif("title", F.lit("")))).alias("_titles"),
    )
    for col in (c for c in TEXTS if c in df.columns):
        texts = united(keyed, ["_a", "_t"], col, ["_rank", "_o"]).withColumnsRenamed({"_a": "_ta", "_t": "_tt"})
        g = g.join(texts, F.col("_a").eqNullSafe(F.col("_ta")) & F.col("_t").eqNullSafe(F.col("_tt")), "left").drop("_ta", "_tt")
    others = F.when(F.size("_titles") > 1, F.array_except("_titles", F.array("_b.title"))).otherwise(F.array().cast("array<string>"))
    empty = F.array().cast("array<string>")
    return g.select("_b.author", "_b.title", "_b.match_type", "cite_count", "merged", others.alias("other_titles"), *[F.coalesce(c, empty).alias(c) for c in TEXTS if c in df.columns])


def clean_up(df: DataFrame, fixes: DataFrame, titles: DataFrame, misattributed: DataFrame, removed: DataFrame) -> DataFrame:
    """Citations after the clean-up maps: ``author``, ``title`` replaced and ``action`` added.

    ``fixes``: ``(variant, canonical)`` by lower case; ``titles``: ``(typed, right)``;
    ``misattributed``: ``(match_author, match_title, fix_author, remove)``, parts of
    author and title, the first that fits counts; ``removed``: ``(name)``.  All four
    are short lists kept by hand.  Blank authors are removed.  Actions: removed,
    misattributed, retitled, renamed, kept.
    """
    low = F.lower(F.trim(F.coalesce("author", F.lit(""))))
    gone = df.sparkSession.createDataFrame([("",)], "name string").unionByName(removed.select(F.lower("name").alias("name"))).distinct()
    out = df.withColumns({"_ord": F.monotonically_increasing_id(), "_low": low})
    out = out.join(gone.select(F.col("name").alias("_g")), F.col("_low") == F.col("_g"), "left")
    wrong = misattributed.select("match_author", "match_title", "fix_author", F.coalesce("remove", F.lit(False)).alias("_rm"))
    parts = F.col("_low").contains(F.col("match_author")) & F.lower(F.coalesce("title", F.lit(""))).contains(F.col("match_title"))
    hit = out.join(F.broadcast(wrong), parts).groupBy("_ord").agg(F.min(F.struct("match_author", "match_title", "fix_author", "_rm")).alias("_m")).withColumnRenamed("_ord", "_mo")
    out = out.join(hit, F.col("_ord") == F.col("_mo"), "left")
    one = fixes.groupBy(F.lower("variant").alias("_v")).agg(F.min("canonical").alias("_c"))
    out = out.join(one, F.col("_low") == F.col("_v"), "left").join(titles.groupBy(F.col("typed").alias("_ty")).agg(F.min("right").alias("_ri")), F.col("title") == F.col("_ty"), "left")
    author = F.coalesce("_m.fix_author", "_c", F.trim("author"))
    action = (
        F.when(F.col("_g").isNotNull() | F.coalesce(F.col("_m._rm"), F.lit(False)), "removed").when(F.col("_m.fix_author").isNotNull(), "misattributed")
        .when(F.col("_ri").isNotNull(), "retitled").when(author != F.col("author"), "renamed").otherwise("kept")
    )
    cols = [c for c in df.columns if c not in ("author", "title")]
    return out.select(*cols, author.alias("author"), F.coalesce("_ri", "title").alias("title"), action.alias("action"))


def richness(df: DataFrame, fields: list[str] | None = None) -> Column:
    """Number of fields that are not null."""
    total = F.lit(0)
    for f in fields or df.columns:
        total = total + F.col(f).isNotNull().cast("int")
    return total


def editions(books: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(kept, redirects)``: one book per author and work (else title).

    Keeper: most filled metadata, then the earliest.  ``redirects``: old id to kept id.
    """
    key = F.coalesce(F.concat(F.lit("work:"), F.nullif("work_id", F.lit(""))), F.concat(F.lit("title:"), viewer_title(F.col("title"))))
    keyed = books.withColumn("_k", key)
    kept = keyed.groupBy("author", "_k").agg(F.max_by("book_id", F.struct("richness", -F.col("ord"))).alias("kept_id"), F.count("*").alias("n"))
    redirects = keyed.join(kept, ["author", "_k"]).where(F.col("book_id") != F.col("kept_id")).select("author", "book_id", "kept_id").distinct()
    return kept.select("author", "kept_id", "n"), redirects


