"""Citation graph: nodes, links, years, neighbourhoods, distributions, search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import first_listed, slug


def author_links(cites: DataFrame) -> DataFrame:
    """``(src, dst, n_books, source_books)`` of ``(book, src, dst)``; no self loops, null ends drop out.

    Pairs and books are made distinct first, so partial aggregation takes the
    repeats off before the shuffle.
    """
    pairs = cites.where("src <> dst").select("src", "dst", "book").distinct()
    return pairs.groupBy("src", "dst").agg(F.count("book").alias("n_books"), F.array_sort(F.collect_list("book")).alias("source_books"))


def author_nodes(cites: DataFrame, sources: DataFrame) -> DataFrame:
    """``(name, is_source, n_cited, n_books)``: everybody who cites or is cited.

    ``sources``: ``(book, author)``; ``cites``: ``(book, src, dst, cited_id)``.
    """
    cited = cites.where("dst IS NOT NULL").groupBy(F.col("dst").alias("name")).agg(F.count("*").alias("n_cited"), F.countDistinct("cited_id").alias("n_books"))
    citing = sources.where("author IS NOT NULL").select(F.col("author").alias("sname")).distinct()
    return cited.join(citing, F.col("name") == F.col("sname"), "full_outer").select(
        F.coalesce("name", "sname").alias("name"), F.col("sname").isNotNull().alias("is_source"), F.coalesce("n_cited", F.lit(0)).alias("n_cited"), F.coalesce("n_books", F.lit(0)).alias("n_books")
    )


def life_midpoint(birth: Column, death: Column) -> Column:
    """Middle of a life; sixty years assumed where the death is unknown."""
    return (birth + F.coalesce(death, birth + 60)) / 2


def impute_years(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``(name, year, how)``: life, mean of books, 2000 for sources, neighbours less 40, upper median.

    ``nodes``: ``(name, birth_year, death_year, book_year, is_source)``.  Neighbour
    years are those known before this step, so the result has no order.
    """
    known = nodes.withColumns({
        "y0": F.coalesce(life_midpoint(F.col("birth_year"), F.col("death_year")), F.col("book_year"), F.when(F.col("is_source"), F.lit(2000.0))),
        "how0": F.when(F.col("birth_year").isNotNull(), "life").when(F.col("book_year").isNotNull(), "books").when(F.col("is_source"), "source"),
    })
    both = links.select(F.col("src").alias("a"), F.col("dst").alias("b")).unionByName(links.select(F.col("dst").alias("a"), F.col("src").alias("b"))).distinct()
    near = both.join(known.where("y0 IS NOT NULL").select(F.col("name").alias("b"), "y0"), "b").groupBy("a").agg(F.floor(F.avg("y0") - 40 + 0.5).cast("double").alias("ny"))
    withn = known.join(near, known["name"] == near["a"], "left").withColumn("y1", F.coalesce("y0", "ny"))
    med = upper_median(withn.where("y1 IS NOT NULL"), "y1")
    return withn.crossJoin(F.broadcast(med)).select(  # one row
        "name", F.coalesce("y1", "median").alias("year"), F.coalesce("how0", F.when(F.col("ny").isNotNull(), "neighbours"), F.lit("median")).alias("how")
    )


def upper_median(df: DataFrame, col: str) -> DataFrame:
    """One row ``median``: the element after the middle of the sorted values.

    Values are counted first; only the distinct values are ranked.
    """
    counts = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("v")).agg(F.count("*").alias("c"))
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"))
    run = counts.withColumn("upto", F.sum("c").over(W.orderBy("v").rowsBetween(W.unboundedPreceding, 0)))
    return run.crossJoin(F.broadcast(total)).where("upto > floor(n / 2)").agg(F.min("v").alias("median"))


def distribution(df: DataFrame, col: str, top: int = 7) -> DataFrame:
    """``(bucket, n, pos)``: counts of a column, all but the ``top - 1`` largest as Other, last."""
    counts = df.where(F.col(col).isNotNull()).groupBy(F.col(col).cast("string").alias("bucket")).agg(F.count("*").alias("n"))
    # The ranking runs over distinct buckets, after the counts.
    ranked = counts.withColumns({"rn": F.row_number().over(W.orderBy(F.desc("n"), "bucket")), "size": F.count("*").over(W.partitionBy())})
    few = F.col("size") <= top
    return ranked.withColumn("pos", F.when(few | (F.col("rn") < top), F.col("rn")).otherwise(top)).withColumn(
        "bucket", F.when(few | (F.col("rn") < top), F.col("bucket")).otherwise("Other")
    ).groupBy("bucket", "pos").agg(F.sum("n").alias("n")).select("bucket", F.col("n").cast("bigint").alias("n"), F.col("pos").cast("int").alias("pos"))


def viewer_search(nodes: DataFrame, query: str) -> DataFrame:
    """``(name, score)``: 100 equal, 80 prefix, 60 name contains, 40 a book title contains.

    ``nodes``: ``(name, titles)``.
    """
    n, q = F.lower("name"), F.lit(query.lower())
    score = F.when(n == q, 100).when(n.startswith(q), 80).when(n.contains(q), 60).when(F.exists("titles", lambda t: F.lower(t).contains(q)), 40)
    return nodes.select("name", score.alias("score")).where("score IS NOT NULL").orderBy(F.desc("score"), "name")


def source_book_map(books: DataFrame) -> DataFrame:
    """``(slug, book)``: the last book of each title slug."""
    return books.where("title IS NOT NULL").groupBy(slug(F.col("title")).alias("slug")).agg(F.max_by("book", "ord").alias("book"))


def hit_test(circles: DataFrame, points: DataFrame, cell: float) -> DataFrame:
    """``(pid, cid)``: for each point the front-most circle it lies in.

    Circles are entered into every grid cell they touch; points look only into
    their own cell, an equality join instead of all pairs.  ``cell`` should be
    near the usual diameter.
    """
    lo = lambda c: F.floor((F.col(c) - F.col("r")) / cell).cast("bigint")
    hi = lambda c: F.floor((F.col(c) + F.col("r")) / cell).cast("bigint")
    grid = circles.withColumn("gx", F.explode(F.sequence(lo("x"), hi("x")))).withColumn("gy", F.explode(F.sequence(lo("y"), hi("y"))))
    at = points.select("pid", F.col("x").alias("px"), F.col("y").alias("py"), F.floor(F.col("x") / cell).cast("bigint").alias("gx"), F.floor(F.col("y") / cell).cast("bigint").alias("gy"))
    inside = at.join(grid, ["gx", "gy"]).where("(px - x) * (px - x) + (py - y) * (py - y) <= r * r")
    return inside.groupBy("pid").agg(F.max_by("cid", "ord").alias("cid"))


def ticks(lo: Column, hi: Column) -> Column:
    """Timeline ticks: centuries before 1800, decades from then on."""
    old = F.when(lo < 1800, F.sequence((F.ceil(lo / 100) * 100).cast("int"), F.lit(1700), F.lit(100))).otherwise(F.array().cast("array<int>"))
    new = F.when(hi >= 1800, F.sequence(F.greatest(F.lit(1800), (F.ceil(lo / 10) * 10).cast("int")), hi.cast("int"), F.lit(10))).otherwise(F.array().cast("array<int>"))
    return F.concat(old, new)


#: Kinds of people boxes, in the order in which parts of a name are tried.
BOX_KINDS = (
    ("philosopher", "Philosophy"), ("theologian", "Philosophy"), ("writer", "Literature"), ("poet", "Literature"), ("author", "Literature"),
    ("scientist", "Science"), ("academic", "Science"), ("scholar", "Science"), ("medical person", "Science"), ("engineer", "Science"), ("economist", "Science"),
    ("officeholder", "Politics"), ("royalty", "Politics"), ("military person", "Politics"), ("saint", "Religion"), ("christian leader", "Religion"),
    ("clergy", "Religion"), ("religious biography", "Religion"), ("artist", "Arts"), ("classical composer", "Arts"), ("musical artist", "Arts"), ("architect", "Arts"),
)


def box_kind(boxes: Column) -> Column:
    """Kind of a person: of the first box listed, else of the first that contains a listed name, else Other; null without an array."""
    clean = F.transform(boxes, lambda b: F.lower(F.trim(F.regexp_replace(b, r"(?s)<!--.*?-->", ""))))
    kinds = F.create_map(*[F.lit(x) for pair in BOX_KINDS for x in pair])
    told = lambda f: F.get(F.filter(F.transform(clean, f), lambda k: k.isNotNull()), 0)
    part = lambda b: F.try_element_at(kinds, first_listed(b, tuple(w for w, _ in BOX_KINDS)))
    return F.when(boxes.isNotNull(), F.coalesce(told(lambda b: F.try_element_at(kinds, b)), told(part), F.lit("Other")))


def to_screen(x: Column, y: Column, scale: float, dx: float, dy: float) -> tuple[Column, Column]:
    """World to screen coordinates."""
    return x * scale + dx, y * scale + dy


def to_world(x: Column, y: Column, scale: float, dx: float, dy: float) -> tuple[Column, Column]:
    """Screen to world coordinates."""
    return (x - dx) / scale, (y - dy) / scale


def in_view(x: Column, y: Column, r: Column, view: tuple[float, float, float], size: tuple[float, float], margin: float = 0.0) -> Column:
    """Circles that a screen of ``size`` shows under ``view (scale, dx, dy)``, a margin around it included."""
    sx, sy = to_screen(x, y, *view)
    reach = r * view[0] + margin
    return (sx + reach >= 0) & (sx - reach <= size[0]) & (sy + reach >= 0) & (sy - reach <= size[1])


def cover_paths(registry: DataFrame) -> DataFrame:
    """``(cover)``: the paths of all covers of the datasets ``(path, covers)``."""
    return registry.select("path", F.explode("covers").alias("c")).select(F.concat_ws("/", "path", "c").alias("cover"))


def out_links(links: DataFrame, who: DataFrame, book: str | None = None) -> DataFrame:
    """``(src, dst, lit)``: whether a link leaves an author of ``who (name)``, if wanted through one book only."""
    hit = links.join(who.select(F.col("name").alias("_w")).distinct(), F.col("src") == F.col("_w"), "left")
    lit = F.col("_w").isNotNull()
    return hit.select("src", "dst", (lit if book is None else lit & F.array_contains("source_books", book)).alias("lit"))
