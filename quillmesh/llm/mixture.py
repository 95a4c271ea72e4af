"""Problem 7: a mixture of sources with target shares of the total size.

Every document gets a random key from a hash of its id; within a source the
keys are cut into ranges.  Token counts are summed per source and range (map-side
combined), exclusive prefix sums over the ranges give the range in which the
budget of the source ends, and only that range is sorted to cut exactly.  A
budget above the size of the source is met by whole epochs first.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

TOKENIZER = os.environ.get("QUILLMESH_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.tiktoken")
#: Fixed value: the public split pattern of the byte-level BPE vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
RANGES = 4096


@lru_cache(maxsize=4)
def _encoder(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def with_token_counts(df: DataFrame, text_col: str = "text", out: str = "n_tokens", tokenizer: str = TOKENIZER) -> DataFrame:
    """``df`` with the number of tokens of the whole text; null text has 0."""

    @F.pandas_udf("long")
    def count(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = _encoder(tokenizer)
        for s in texts:
            yield pd.Series([len(enc.encode_ordinary(t)) if t else 0 for t in s], dtype="int64")

    return df.withColumn(out, count(F.col(text_col)))


def mix(
    docs: DataFrame,
    targets: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    tokens_col: str = "n_tokens",
    total: int | None = None,
    seed: int = 7,
    ranges: int = RANGES,
) -> tuple[DataFrame, DataFrame]:
    """``(selection, report)``.

    ``targets``: ``source, target_share, max_repeats``.  The size of the mixture
    is ``total`` tokens, by default the tokens of all documents.  Selection: ``id_col, source, n_tokens, copies`` for every document
    used; ``copies`` never exceeds ``max_repeats``.  Report: one row per source in
    either input with its budget, tokens used and actual share; sources that
    are not targets have share 0, targets without documents stay short.

    Null sources belong to no target.  Documents with the same id are separate
    rows.  Null or non-positive shares and repeats mean 0.  The cut keeps the
    document that crosses the budget if this comes closer to it.
    """
    key = F.xxhash64(F.lit(seed), F.col(id_col).cast("string"))
    rows = docs.select(
        F.col(id_col).alias("_id"), F.col(source_col).alias("_source"), F.col(tokens_col).cast("long").alias("_n"),
        F.floor((key.cast("double") / F.lit(2.0**64) + 0.5) * ranges).cast("int").alias("_range"), key.alias("_key"),
    )
    want = targets.groupBy(F.col("source").alias("_ts")).agg(
        F.max(F.greatest(F.coalesce(F.col("target_share").cast("double"), F.lit(0.0)), F.lit(0.0))).alias("_share"),
        F.max(F.greatest(F.coalesce(F.col("max_repeats").cast("int"), F.lit(0)), F.lit(0))).alias("_rep"),
    )
    # At most ranges * sources rows from here on, whatever the corpus holds.
    sums = rows.groupBy("_source", "_range").agg(F.sum("_n").alias("_sum"), F.count("*").alias("_docs"))
    size = sums.groupBy("_source").agg(F.sum("_sum").alias("_size"), F.sum("_docs").alias("_docs"))
    plan = size.join(want, size["_source"] == want["_ts"], "full_outer").select(
        F.coalesce("_source", "_ts").alias("_source"), F.col("_ts").isNotNull().alias("_is_target"),
        F.coalesce("_size", F.lit(0)).alias("_size"), F.coalesce("_docs", F.lit(0)).alias("_docs"),
        F.coalesce("_share", F.lit(0.0)).alias("_share"), F.coalesce("_rep", F.lit(0)).alias("_rep"),
    )
    if total is None:
        totals = plan.agg(F.coalesce(F.sum("_size"), F.lit(0)).alias("_total"))
        plan = plan.crossJoin(F.broadcast(totals))  # one row
    else:
        plan = plan.withColumn("_total", F.lit(int(total)).cast("long"))
    plan = plan.withColumn("_budget", F.floor(F.col("_share") * F.col("_total"))).withColumn(
        "_epochs", F.when(F.col("_size") > 0, F.least(F.floor(F.col("_budget") / F.col("_size")), F.col("_rep").cast("long"))).otherwise(F.lit(0).cast("long"))
    ).withColumn(
        "_rest", F.when(F.col("_epochs") < F.col("_rep"), F.col("_budget") - F.col("_epochs") * F.col("_size")).otherwise(F.lit(0))
    )
    before = F.coalesce(F.sum("_sum").over(W.partitionBy("_source").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    edges = sums.withColumn("_before", before).join(plan, sums["_source"] == plan["_source"]).drop(plan["_source"]).select(
        F.col("_source").alias("_es"), F.col("_range").alias("_er"), "_before", "_sum", "_epochs", "_rest"
    ).where((F.col("_epochs") > 0) | (F.col("_before") < F.col("_rest")))
    placed = rows.join(edges, (rows["_source"] == edges["_es"]) & (rows["_range"] == edges["_er"]))
    inside = placed.where(F.col("_before") + F.col("_sum") <= F.col("_rest")).withColumn("_last", F.lit(1))
    outside = placed.where(F.col("_before") >= F.col("_rest")).withColumn("_last", F.lit(0))
    border = placed.where((F.col("_before") < F.col("_rest")) & (F.col("_before") + F.col("_sum") > F.col("_rest")))
    upto = F.sum("_n").over(W.partitionBy("_source", "_range").orderBy("_key", "_id").rowsBetween(W.unboundedPreceding, 0))
    border = border.withColumn("_upto", F.col("_before") + upto).withColumn(
        "_last", (F.col("_upto") - F.col("_rest") <= F.floor(F.col("_n") / 2)).cast("int")
    ).drop("_upto")
    used = inside.unionByName(outside).unionByName(border).withColumn("_copies", (F.col("_epochs") + F.col("_last")).cast("int"))
    selection = used.where("_copies > 0").select(
        F.col("_id").alias(id_col), F.col("_source").alias(source_col), F.col("_n").alias("n_tokens"), F.col("_copies").alias("copies")
    )
    got = used.groupBy(F.col("_source").alias("_us")).agg(
        F.sum(F.col("_n") * F.col("_copies")).alias("_used"), F.sum(F.when(F.col("_copies") > 0, 1).otherwise(0)).alias("_ud"), F.max("_copies").alias("_mc")
    )
    report = plan.join(got, plan["_source"].eqNullSafe(got["_us"]), "left")
    all_used = F.sum(F.coalesce("_used", F.lit(0))).over(W.partitionBy(F.lit(1)))  # one row per source
    report = report.select(
        F.col("_source").alias("source"), F.col("_share").alias("target_share"), F.col("_rep").alias("max_repeats"),
        F.col("_docs").alias("n_docs"), F.col("_size").alias("source_tokens"), F.col("_budget").cast("long").alias("budget_tokens"),
        F.coalesce("_used", F.lit(0)).cast("long").alias("used_tokens"), F.coalesce("_ud", F.lit(0)).cast("long").alias("used_docs"),
        F.coalesce("_mc", F.lit(0)).alias("most_copies"),
        F.when(all_used > 0, F.coalesce("_used", F.lit(0)) / all_used).otherwise(F.lit(0.0)).alias("actual_share"),
    )
    return selection, report
