"""Resolution, edges, merging of texts and the command line on a handful of rows."""

import random

import pytest
from pyspark.sql import functions as F

from quillmesh.config import PipelineConfig
from quillmesh.engine import main
from quillmesh.functions import dates as D
from quillmesh.operators import dedup as DD
from quillmesh.operators import enrich as E
from quillmesh.operators import graph as G
from quillmesh.operators import resolve as S
from quillmesh.operators import search as Q
from quillmesh.plans import catalog
from quillmesh.sources import readers


def rows(df):
    return {tuple(r) for r in df.collect()}


def test_every_match_type_and_a_retry(spark):
    cites = spark.createDataFrame([("a", "The Hobbit", "Tolkien", None), ("b", "", "Hannah Arendt", None), ("c", None, "Ada Person", None), ("d", "Lost Title", "Nobody", None), ("e", "Odd Name", "Known Writer", None)], "cit_id string, title string, author string, canonical_author string")
    books = spark.createDataFrame([(123, "The Hobbit", ["J. R. R. Tolkien"]), (5, "Strange Work", ["Known Writer"])], "book_id bigint, title string, authors array<string>")
    authors = spark.createDataFrame([(999, "Hannah Arendt")], "author_id bigint, name string")
    people = spark.createDataFrame([(111, "Hannah Arendt", 1906, 1975), (7, "Ada Person", 1815, None)], "page_id bigint, title string, birth_year int, death_year int")

    def rewriter(todo, attempt):
        return todo.where("cit_id = 'e'").select("cit_id", F.lit(1).alias("query_no"), F.lit("Strange Work").alias("q_title"), F.lit(None).cast("string").alias("q_author"))

    anything = lambda amb, config: amb.where("pos = 1").select("id", "ord", "score")
    got = {r["cit_id"]: (r["match_type"], r["book_id"], r["author_id"], r["page_id"], r["pass_no"]) for r in S.resolve(cites, books, authors, people, config=PipelineConfig(retries=1), rewriter=rewriter, adjudicator=anything).collect()}
    assert got["a"] == ("book", 123, None, None, 1) and got["b"] == ("author", None, 999, 111, 1) and got["c"] == ("person", None, None, 7, 1)
    assert got["e"][:2] == ("book", 5) and got["e"][4] == 2 and got["d"][0] == "not_found" and len(got) == 5


def test_alias_variants(spark):
    c = spark.createDataFrame([(1, "Schopenhauer"), (2, "Simone de Beauvoir"), (3, "Nobody"), (4, None)], "cit_id int, author string")
    a = spark.createDataFrame([("schopenhauer", "Arthur Schopenhauer"), ("de beauvoir", "Simone de Beauvoir"), ("beauvoir", "Simone de Beauvoir")], "variant_lower string, canonical string")
    got = {r["cit_id"]: r["variants"] for r in S.alias_variants(c, a).collect()}
    assert got == {1: ["Arthur Schopenhauer"], 2: ["Beauvoir", "De Beauvoir"], 3: [], 4: []}


def test_merging_keeps_texts_in_order(spark):
    df = spark.createDataFrame([("g", 1, "web_1", "w", 9, ["a"], ["x"]), ("g", 2, "20", "w", 3, ["b", "a"], []), ("g", 3, "30", "w", 3, ["c"], ["y", "x"]), ("g", 4, "40", None, 1, ["z"], [])], "group string, ord bigint, book_id string, work_id string, cite_count bigint, contexts array<string>, commentaries array<string>")
    got = {r["ord"]: (r["cite_count"], r["contexts"], r["commentaries"]) for r in DD.dedup_by_work(df, scope="group").collect()}
    assert got == {2: (15, ["b", "a", "c"], ["x", "y"]), 4: (1, ["z"], [])}


def test_validation_keeps_what_fails(spark):
    cites = spark.createDataFrame([("g", i, f"A{i}", f"T{i}", 1) for i in range(5)] + [("h", 9, "B", "T", 1)], "group string, ord bigint, author string, title string, cite_count bigint")

    def decider(batch):
        if batch[0]["author"] == "B":
            raise RuntimeError("down")
        return [{"index": r["index"], "status": "remove"} for r in batch if r["author"] in ("A1", "A4")]

    assert rows(E.validate(cites, decider, size=2).select("group", "ord", "status")) == {("g", 1, "remove"), ("g", 4, "remove")}


def test_cache_probe_takes_the_first_similar_key(spark):
    names = spark.createDataFrame([("Ada Lovelace",), ("Ada Lovelacee",), ("Charles Babbage",), ("X",), (None,)], "name string")
    cache = spark.createDataFrame([("ada lovelace", 2, "v2"), ("adaa lovelace", 1, "v1")], "key string, ord int, value string")
    assert rows(E.cache_probe(names, cache)) == {("Ada Lovelace", "ada lovelace", "v2"), ("Ada Lovelacee", "adaa lovelace", "v1")}


@pytest.mark.parametrize("b, d, label", [(1564, -1616, "sign_error_death"), (1900, -30, "wrong_person_death"), (-4, 65, "sign_error_birth"), (-800, 1900, "wrong_person_birth"), (-1564, -1616, "sign_error_both"), (-100, -800, "wrong_person_both_neg"), (1900, 1850, "wrong_person_both"), (1500, 1800, "implausible_lifespan"), (-43, 17, None)])
def test_labels_of_the_date_rules(spark, b, d, label):
    assert spark.createDataFrame([(b, d)], "b int, d int").select(D.date_case(F.col("b"), F.col("d"))).first()[0] == label


def test_plans_stay_small(spark):
    df = spark.range(1).select(F.col("id").cast("int").alias("b"), F.col("id").cast("int").alias("d"), F.col("id").cast("string").alias("t"))
    assert len(df.select(D.validate_dates(F.col("b"), F.col("d")))._jdf.queryExecution().optimizedPlan().toString()) < 12_000


def test_exact_values_of_pages(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    boxes = lambda *b: F.array(*[F.lit(x) for x in b])
    assert one(G.box_kind(boxes("settlement", "Military person"))) == "Politics" and one(G.box_kind(boxes("writer <!-- x -->"))) == "Literature" and one(G.box_kind(boxes("town"))) == "Other" and one(G.box_kind(F.lit(None).cast("array<string>"))) is None
    page = "{{Hndis|x}} [[Category:1900 births]]"
    assert not one(readers.is_person(F.lit(page))) and one(readers.is_person(F.lit("{{Infobox politician\n}}"))) and one(readers.category_year(F.lit("[[Category:People, 384 BC births in Stagira]]"), "births")) == -384


def test_command_line_links_books_without_number_and_repeated_records(spark, tmp_path):
    texts = tmp_path / "in"
    texts.mkdir()
    (texts / "My_Essays_77.txt").write_text('Ada Lovelace wrote in "Notes on the Engine" much. Ada Lovelace claimed it again!')
    (texts / "Letters_Home.txt").write_text('Ada Lovelace wrote in "Notes on the Engine" early.')
    cat = [("77", "w0", "My Essays", "Jane Roe"), ("88", "w8", "Letters Home", "John Doe"), ("10", "w1", "Notes on the Engine", "Ada Lovelace"), ("10", "w1", "Notes on the Engine", "Ada Lovelace")]
    spark.createDataFrame(cat, "book_id string, work_id string, title string, author string").write.parquet(str(tmp_path / "cat"))
    main([str(texts), str(tmp_path / "out"), "--catalog", str(tmp_path / "cat"), "--max-chunks", "5"])
    links = rows(spark.read.parquet(str(tmp_path / "out/links")).select("src", "dst", "n_books"))
    assert links == {("Jane Roe", "Ada Lovelace", 1), ("John Doe", "Ada Lovelace", 1)}
    got = rows(spark.read.parquet(str(tmp_path / "out/resolved")).where("title <> ''").select("group", "book_id", "match_type", "cite_count"))
    assert {g[:3] for g in got} == {("77", "10", "book"), ("88", "10", "book")}


def test_edges_of_books_without_author_ids_and_of_namesakes(spark, tmp_path):
    author = "array<struct<author_id bigint, name string>>"
    write = lambda name, data, schema: spark.createDataFrame(data, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    books = [(1, "All", [(7, "A"), (8, "B")]), (2, "Some", [(None, "A"), (8, "B")]), (3, "No Ids", [(None, "Z"), (None, "B")]), (4, "Nobody", []), (5, "Unknown", None)]
    write("book_metadata", [(b, "w", t, a, 1900, 0) for b, t, a in books], f"book_id bigint, work_id string, title string, authors {author}, publication_year int, ingested_at int")
    cited = [*((i, t, "X") for i, t, _ in books), (6, "", "A"), (7, "Lost", "X")]
    write("citations", [(i, "s", t, a, None, 1, [], [], 0) for i, t, a in cited], "cit_id bigint, source_book_id string, title string, author string, canonical_author string, cite_count int, contexts array<string>, commentaries array<string>, ingested_at int")
    people = [(10, "Z", None, None, None, None), (15, "Z", 1800, None, None, "g"), (20, "Z", 1800, 1850, None, None)]
    write("canonical_authors", people, "author_id bigint, name string, birth_year int, death_year int, nationality string, main_genre string")
    got = {r["ord"]: r for r in catalog.queries()["edges"](spark, str(tmp_path)).collect()}
    assert {i: r["target_author_ids"] for i, r in got.items()} == {1: "7,8", 2: "8", 3: None, 4: "", 5: None, 6: "7", 7: ""}
    assert (got[3]["person"], got[3]["person_birth"], got[3]["person_death"]) == ("Z", 1800, 1850)


@pytest.mark.parametrize("few", [1, 64])
def test_common_words_do_not_multiply(spark, monkeypatch, few):
    monkeypatch.setattr(Q, "FEW", few)
    rng = random.Random(3)
    text = lambda: " ".join(["the", rng.choice(["ash", "elm", "oak", "fir", "yew"]), "of", "a", f"w{rng.randrange(60)}"][rng.randrange(2):])
    qs, ds = [(i, text()) for i in range(300)], [(i, text()) for i in range(400)]
    q, d = spark.createDataFrame(qs, "q int, w string"), spark.createDataFrame(ds, "d int, t string")
    assert rows(Q.all_words_hits(q, d, "q", "w", "d", "t")) == {(i, j) for i, w in qs for j, t in ds if {x for x in w.split() if len(x) > 1} <= set(t.split())}
    assert rows(Q.phrase_hits(q, d, "q", "w", "d", "t")) == {(i, j) for i, w in qs for j, t in ds if f" {w} " in f" {t} "}
    split = lambda df, k, c: df.select(k, F.split(c, " ").alias("words"))
    # All texts share a word; a query still meets only those with its rare ones.
    assert Q.meetings(split(q, F.col("q"), "w"), split(d, F.col("d").alias("doc"), "t")).count() < 300 * 400 / 20
