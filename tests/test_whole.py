"""Queries that must answer for every row, on small tables written for the test."""

import json
from datetime import datetime

from quillmesh.plans import graph, text

CITES = "cit_id bigint, source_book_id string, title string, author string, canonical_author string, cite_count int, contexts array<string>, commentaries array<string>, ingested_at timestamp"


def write(spark, path, name, data, schema):
    spark.createDataFrame(data, schema).write.parquet(f"{path}/{name}.parquet")


def cited(spark, path, data):
    """``data``: ``(cit_id, book, title, author)``."""
    write(spark, path, "citations", [(i, b, t, a, None, 2, [], [], datetime(2024, 1, 1)) for i, b, t, a in data], CITES)


def test_every_citation_has_a_json_line(spark, tmp_path):
    data = [(1, "s", "Plain Title", "Plain Author"), (2, "s", "Été à Łódź", "José Ño"), (3, "s", 'The "So-called" \\ Title', "A/B O'Neil"), (4, "s", "No author", None), (5, "s", None, "Untitled"), (6, "s", "Tab\there\nline", "道")]
    cited(spark, tmp_path, data)
    got = {r["ord"]: r["line"] for r in text.prompt_json(spark, str(tmp_path)).collect()}
    assert got == {i: json.dumps({"index": i, "author": a, "title": t or "", "count": 2}, ensure_ascii=False, separators=(",", ":")) for i, _, t, a in data}


def test_every_known_life_date_counts(spark, tmp_path):
    cited(spark, tmp_path, [(1, "s1", "A", "Known One"), (2, "s1", "B", "Known Two"), (3, "s1", "C", "Known Three"), (4, "s1", "D", "Dateless"), (5, "s2", "E", "Dateless"), (6, "s3", "F", "Alone")])
    write(spark, tmp_path, "source_books", [("s1", ["Writer"], 1990), ("s2", ["Undated"], None), ("s3", ["Alone"], None), ("s4", ["Known Writer"], 1990)], "source_book_id string, authors array<string>, publication_year int")
    write(spark, tmp_path, "canonical_authors", [(1, "Known One", 1900, 1980), (2, "Known Two", 1800, None), (3, "Known Three", 1700, 1750), (4, "Dateless", None, None), (5, "Known Writer", 1900, 1960)], "author_id bigint, name string, birth_year int, death_year int")
    got = {r["name"]: (r["year"], r["how"]) for r in graph.graph_year_imputation(spark, str(tmp_path)).collect()}
    assert got == {
        "Known One": (1940.0, "life"), "Known Two": (1830.0, "life"), "Known Three": (1725.0, "life"), "Dateless": (1955.0, "neighbours"),
        "Writer": (1990.0, "books"), "Undated": (2000.0, "source"), "Alone": (2000.0, "source"), "Known Writer": (1930.0, "life"),
    }


def test_the_median_is_left_for_who_has_no_dated_neighbour(spark, tmp_path):
    cited(spark, tmp_path, [(1, "s1", "A", "Known One"), (2, "s0", "B", "Lost")])
    write(spark, tmp_path, "source_books", [("s1", ["Writer"], 1990), ("s0", [None], 1500)], "source_book_id string, authors array<string>, publication_year int")
    write(spark, tmp_path, "canonical_authors", [(1, "Known One", 1900, 1980)], "author_id bigint, name string, birth_year int, death_year int")
    got = {r["name"]: (r["year"], r["how"]) for r in graph.graph_year_imputation(spark, str(tmp_path)).collect()}
    assert got == {"Known One": (1940.0, "life"), "Writer": (1990.0, "books"), "Lost": (1990.0, "median")}


def test_candidates_come_from_the_search(spark, tmp_path):
    cited(spark, tmp_path, [
        (1, "s", "The Two Cultures: And a Second Look", "C.P. Snow"), (2, "s", "Second Sex", "Beauvoir, Simone de"), (3, "s", "", "Hannah Arendt"), (4, "s", None, "Nobody Known"),
        (5, "s", "Poems", "Jane Q. Roe"), (6, "s", "Poems", None), (7, "s", "two cultures", "c p snow"), (8, "s", "", "Woolf"), (9, "s", "The Two Cultures: And a Second Look", "C.P. Snow"),
    ])
    author = lambda i, n: {"author_id": i, "name": n}
    at = datetime(2024, 1, 1)
    write(spark, tmp_path, "book_metadata", [(10, "The Two Cultures", [author(1, "C. P. Snow")], at), (11, "The Second Sex", [author(9, "Ed Itor"), author(2, "Simone de Beauvoir")], at), (12, "Poems", [author(3, "Roe, Jane")], at), (13, "The Two Cultures", [author(4, "Someone Else"), author(None, "Hannah Arendt")], at)],
          "book_id bigint, title string, authors array<struct<author_id:bigint,name:string>>, ingested_at timestamp")
    write(spark, tmp_path, "canonical_authors", [(5, "Hannah Arendt"), (6, "Virginia Woolf"), (7, "Leonard Woolf")], "author_id bigint, name string")
    got = {(r["id"], r["book_id"], r["author_id"]) for r in text.token_sort_score(spark, str(tmp_path)).collect()}
    assert got == {(1, 10, None), (9, 10, None), (7, 10, None), (2, 11, None), (3, None, 5), (5, 12, None), (6, 12, None), (8, None, 6), (8, None, 7)}
    ranks = {(r["id"], r["author_id"], r["rank"]) for r in text.top5_candidates(spark, str(tmp_path)).where("id IN (3, 8)").collect()}
    assert {r[:2] for r in ranks} == {(3, 5), (8, 6), (8, 7)} and {r[2] for r in ranks if r[0] == 8} == {1, 2}
    gate = {r["id"]: (r["book_id"], r["author_id"], r["decision"]) for r in text.confidence_gate(spark, str(tmp_path)).collect()}
    assert set(gate) == set(range(1, 10)) and gate[3] == (None, 5, "accepted") and gate[4] == (None, None, "none") and gate[5] == (12, None, "accepted") and gate[8][2] == "none"
