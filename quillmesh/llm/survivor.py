"""Problem 4: the best representative of each group of duplicate records.

Skyline selection.  Every record of a group gets three criteria: completeness
(number of filled fields), recency (``updated_at``) and trust
(``ratings_count``).  Layer 1 of a group are its Pareto-undominated records,
layer 2 those undominated once layer 1 is gone, and so on.  The base of the
surviving record is the lexicographically best record (completeness, recency,
trust, then the smallest id), which always lies in layer 1; its empty fields are
filled from the best record of the first later layer that has them.

Groups of up to ``GROUP_BOUND`` records travel as one bounded array.  Larger
groups are peeled in rounds: skylines of salted parts are merged into the
skyline of the group, the layer is taken off, and a round is added only while a
field is open that a remaining record could fill.  No task ever holds an
unbounded group.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut

#: Fixed values that stand for "no value" in catalogue text fields.
PLACEHOLDERS = ("", "n/a", "na", "unknown", "none", "null", "nan", "-", "--", "?", "tbd", "untitled", "no title")
#: Fixed values that stand for "no value" in year fields.
YEAR_PLACEHOLDERS = (0, 9999)
GROUP_BOUND = 256
SALTS = 64

FIELDS = (
    "title", "title_without_series", "authors", "publication_year", "publication_month", "publication_day",
    "publisher", "num_pages", "book_format", "isbn", "isbn13", "average_rating", "ratings_count",
    "text_reviews_count", "description", "link", "catalog_source",
)


def filled(df: DataFrame, name: str) -> Column:
    """True where the field holds a value that is no placeholder."""
    c, kind = F.col(name), df.schema[name].dataType
    if isinstance(kind, T.StringType):
        v = F.lower(F.trim(c))
        return F.coalesce(~v.isin(*PLACEHOLDERS) & ~v.rlike(r"^0+$") & v.rlike(r"\S"), F.lit(False))
    if isinstance(kind, (T.ArrayType, T.MapType)):
        return F.coalesce(F.size(c) > 0, F.lit(False))
    if name.endswith("year"):
        return F.coalesce(~c.isin(*YEAR_PLACEHOLDERS), F.lit(False))
    return c.isNotNull()


def latest(df: DataFrame, id_col: str, order: Sequence[str]) -> DataFrame:
    """One row per id: of repeated deliveries the last by ``order``."""
    cols = [c for c in df.columns if c != id_col]
    rank = F.struct(*[F.col(c) for c in order], F.xxhash64(*[F.col(c).cast("string") for c in cols]))
    return df.groupBy(id_col).agg(F.max_by(F.struct(*cols), rank).alias("_r")).select(id_col, "_r.*")


def _scored(df: DataFrame, group: str, id_col: str, fields: Sequence[str], recency: str, trust: str) -> DataFrame:
    marks = [filled(df, f).cast("int") for f in fields]
    return df.where(F.col(group).isNotNull() & F.col(id_col).isNotNull()).select(
        F.col(group).alias("_g"),
        F.col(id_col).alias("_id"),
        reduce(lambda a, b: a + b, marks).alias("_c"),
        F.coalesce(F.col(recency).cast("timestamp").cast("double"), F.lit(float("-inf"))).alias("_t"),
        F.coalesce(F.col(trust).cast("double"), F.lit(float("-inf"))).alias("_r"),
        F.array(*marks).alias("_f"),
    )


_KEY = ("_c", "_t", "_r")


def _undominated(rows: list) -> list:
    """Pareto-undominated rows of ``[(c, t, r, id, f), ...]``."""
    out: list = []
    for x in sorted(rows, key=lambda x: (-x[0], -x[1], -x[2], x[3])):
        if not any(y[0] >= x[0] and y[1] >= x[1] and y[2] >= x[2] and y[:3] != x[:3] for y in out):
            out.append(x)
    return out


def _layers(rows: list) -> Iterator[list]:
    rest = rows
    while rest:
        top = _undominated(rest)
        yield top
        gone = {x[3] for x in top}
        rest = [x for x in rest if x[3] not in gone]


def _choose(rows: list, n_fields: int) -> tuple:
    """(base id, skyline size, clear lead, source id of each field)."""
    from_id: list = [None] * n_fields
    base, width = None, 0
    for depth, layer in enumerate(_layers(rows)):
        if depth == 0:
            base, width = layer[0], len(layer)
        for x in layer:  # in lexicographic order
            for i, has in enumerate(x[4]):
                if has and from_id[i] is None:
                    from_id[i] = x[3]
        if all(v is not None for v in from_id):
            break
    lead = len(rows) > 1 and all(
        base[0] > y[0] and base[1] > y[1] and base[2] > y[2] for y in rows if y[3] != base[3]
    )
    return base[3], width, lead, from_id


def _small(groups: DataFrame, id_type: str, group_type: str, n: int) -> DataFrame:
    packed = groups.groupBy("_g").agg(F.collect_list(F.struct("_c", "_t", "_r", "_id", "_f")).alias("rows"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for g, rows in zip(pdf["_g"], pdf["rows"]):
                recs = [(r["_c"], r["_t"], r["_r"], r["_id"], list(r["_f"])) for r in rows]
                base, width, lead, src = _choose(recs, n)
                out.append((g, len(recs), base, width, lead, src))
            yield pd.DataFrame(out, columns=["_g", "_n", "_base", "_width", "_lead", "_src"])

    schema = f"_g {group_type}, _n long, _base {id_type}, _width int, _lead boolean, _src array<{id_type}>"
    return packed.mapInPandas(run, schema)


def _skyline_of(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Undominated rows per ``keys``; groups are salted to a bounded size first.

    Within a part the candidates come in lexicographic order, so a row is
    dominated only by earlier ones; a running maximum of trust per completeness
    level would need the whole group, hence the array form on bounded parts.
    """
    packed = df.groupBy(*keys).agg(F.collect_list(F.struct("_c", "_t", "_r", "_id", "_f")).alias("rows"))
    dominated = lambda x, y: (
        (y["_c"] >= x["_c"]) & (y["_t"] >= x["_t"]) & (y["_r"] >= x["_r"])
        & ((y["_c"] > x["_c"]) | (y["_t"] > x["_t"]) | (y["_r"] > x["_r"]))
    )
    kept = F.filter("rows", lambda x: ~F.exists("rows", lambda y: dominated(x, y)))
    return packed.select(*keys, F.explode(kept).alias("_x")).select(*keys, "_x.*")


def _large(groups: DataFrame, n: int) -> DataFrame:
    """The choice of :func:`_choose` for groups of any size, layer by layer."""
    stats = groups.groupBy("_g").agg(
        F.count("*").alias("_n"),
        *[F.max(F.col("_f")[i]).alias(f"_any{i}") for i in range(n)],
        F.max("_c").alias("_mc"), F.max("_t").alias("_mt"), F.max("_r").alias("_mr"),
    )
    rest = groups
    # The highest criteria, then the smallest id, of whatever type it is.
    order = F.struct(-F.col("_c"), -F.col("_t"), -F.col("_r"), F.col("_id"))
    best = lambda i: F.min_by(F.when(F.col("_f")[i] == 1, F.col("_id")), F.when(F.col("_f")[i] == 1, order))
    state, depth = None, 0
    while True:
        # Merge skylines of parts until each group is one part again.
        front, parts = rest, SALTS * SALTS
        while parts >= 1:
            salt = F.pmod(F.xxhash64("_id"), F.lit(parts)).alias("_s")
            front = _skyline_of(front.select("*", salt), ["_g", "_s"]).drop("_s")
            parts = parts // SALTS if parts > 1 else 0
        front = cut(front)
        layer = front.groupBy("_g").agg(
            F.count("*").cast("int").alias("_w"),
            F.min_by("_id", order).alias("_b"),
            F.max(F.struct("_c", "_t", "_r")).alias("_top"),
            *[best(i).alias(f"_s{i}") for i in range(n)],
        )
        if state is None:
            state = stats.join(layer, "_g").select(
                "_g", "_n", F.col("_b").alias("_base"), F.col("_w").alias("_width"),
                F.col("_top"), "_mc", "_mt", "_mr", *[f"_any{i}" for i in range(n)], *[f"_s{i}" for i in range(n)],
            )
        else:
            layer = layer.select(F.col("_g").alias("_lg"), *[F.col(f"_s{i}").alias(f"_l{i}") for i in range(n)])
            state = state.join(layer, F.col("_g") == F.col("_lg"), "left").select(
                *[c for c in state.columns if not c.startswith("_s")],
                *[F.coalesce(f"_s{i}", f"_l{i}").alias(f"_s{i}") for i in range(n)],
            )
        state = cut(state)
        depth += 1
        opened = reduce(lambda a, b: a | b, [(F.col(f"_any{i}") == 1) & F.col(f"_s{i}").isNull() for i in range(n)])
        todo = state.where(opened).select("_g")
        if not todo.take(1):
            break
        rest = cut(rest.join(todo, "_g", "left_semi").join(front.select("_g", "_id"), ["_g", "_id"], "left_anti"))
    # The base leads clearly if it alone reaches the maximum of every criterion.
    ties = groups.join(state.select("_g", "_base", "_mc", "_mt", "_mr"), "_g").groupBy("_g").agg(
        F.max(F.when(F.col("_id") != F.col("_base"), (F.col("_c") == F.col("_mc")) | (F.col("_t") == F.col("_mt")) | (F.col("_r") == F.col("_mr")))).alias("_tie")
    )
    reaches = (F.col("_top._c") == F.col("_mc")) & (F.col("_top._t") == F.col("_mt")) & (F.col("_top._r") == F.col("_mr"))
    return state.join(ties, "_g").select(
        "_g", "_n", "_base", "_width", (reaches & ~F.col("_tie")).alias("_lead"), F.array(*[f"_s{i}" for i in range(n)]).alias("_src")
    )


def choose_survivors(
    df: DataFrame,
    group: str = "work_id",
    id_col: str = "book_id",
    fields: Sequence[str] = FIELDS,
    recency: str = "updated_at",
    trust: str = "ratings_count",
    delivered: str = "ingested_at",
) -> DataFrame:
    """``(group, n_records, base_id, skyline_size, clear_lead, field_sources)`` per group.

    ``field_sources[i]`` is the id of the record that supplies ``fields[i]``, null
    where no record of the group has it.  Records delivered more than once count
    once (the last delivery).  Null groups and null ids are left out; null
    criteria rank lowest; ties in all criteria go to the smallest id and are no
    clear lead; a group of one record has no lead.  Empty input, empty output.
    """
    have = [f for f in fields if f in df.columns]
    cols = list(dict.fromkeys([group, id_col, *have, recency, trust, delivered]))
    one = latest(df.select(*cols), id_col, [delivered, recency])
    rows = _scored(one, group, id_col, have, recency, trust)
    sizes = rows.groupBy("_g").agg(F.count("*").alias("_size"))
    big = cut(sizes.where(F.col("_size") > GROUP_BOUND).select("_g"))
    kinds = dict(rows.dtypes)
    if big.take(1):
        few = _small(rows.join(big, "_g", "left_anti"), kinds["_id"], kinds["_g"], len(have))
        chosen = few.unionByName(_large(rows.join(big, "_g", "left_semi"), len(have)))
    else:
        chosen = _small(rows, kinds["_id"], kinds["_g"], len(have))
    return chosen.select(
        F.col("_g").alias(group), F.col("_n").alias("n_records"), F.col("_base").alias("base_id"),
        F.col("_width").alias("skyline_size"), F.col("_lead").alias("clear_lead"), F.col("_src").alias("field_sources"),
    )


def build_survivors(df: DataFrame, group: str = "work_id", id_col: str = "book_id", fields: Sequence[str] = FIELDS, **kw) -> DataFrame:
    """One record per group, built field by field from ``field_sources``."""
    have = [f for f in fields if f in df.columns]
    chosen = choose_survivors(df, group, id_col, have, **kw)
    one = latest(df.select(*dict.fromkeys([group, id_col, *have, kw.get("recency", "updated_at"), kw.get("delivered", "ingested_at")])), id_col, [kw.get("delivered", "ingested_at"), kw.get("recency", "updated_at")])
    wanted = chosen.select(group, F.posexplode("field_sources").alias("_i", "_src")).where(F.col("_src").isNotNull())
    values = one.select(F.col(id_col).alias("_src"), F.col(group).alias("_vg"), *[F.col(f).alias(f"_v_{f}") for f in have])
    got = wanted.join(values, (wanted["_src"] == values["_src"]) & (wanted[group] == values["_vg"])).groupBy(group).agg(
        *[F.max_by(f"_v_{f}", F.when(F.col("_i") == i, 1)).alias(f) for i, f in enumerate(have)]
    )
    return chosen.join(got, group, "left").select(group, F.col("base_id").alias(id_col), "n_records", "skyline_size", *have)
