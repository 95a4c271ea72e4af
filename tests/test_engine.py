"""The pipeline from texts to links on a handful of books."""

from pyspark.sql import functions as F

from quillmesh.engine import Engine


def test_texts_to_links(spark, tmp_path):
    texts = spark.createDataFrame([
        ("1", "Essays", "Jane Roe", 'Ada Lovelace wrote in "Notes on the Engine" much. Later Ada Lovelace claimed it again! Charles Babbage argued otherwise.'),
        ("2", "Letters", "John Doe", 'Ada Lovelace wrote in "Notes on the Engine" early on. Jane Roe noted it.'), ("3", "Empty", "Nobody Here", ""),
    ], "book_id string, title string, author string, text string")
    catalog = spark.createDataFrame([(10, "w1", "Notes on the Engine", "Ada Lovelace"), (11, "w2", "Other", "Someone")], "book_id bigint, work_id string, title string, author string")
    stages = Engine(spark).run(texts, catalog)
    cites = {(r["group"], r["title"], r["author"], r["book_id"], r["match_type"]) for r in stages["resolved"].where("title <> ''").collect()}
    assert cites == {("1", "Notes on the Engine", "Ada Lovelace", "10", "book"), ("2", "Notes on the Engine", "Ada Lovelace", "10", "book")}
    links = {(r["src"], r["dst"], r["n_books"]) for r in stages["links"].collect()}
    assert links == {("Jane Roe", "Ada Lovelace", 1), ("Jane Roe", "Charles Babbage", 1), ("John Doe", "Ada Lovelace", 1), ("John Doe", "Jane Roe", 1)}
    assert stages["extracted"].where(F.col("status") == "failed").count() == 0
    done = spark.createDataFrame([("1",), ("2",), ("3",)], "book_id string")
    assert Engine(spark).run(texts, catalog, done=done)["links"].count() == 0


def test_queries_are_listed_without_a_session():
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parents[1]
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()) >= len(e.oracle_sql()) > 90)"], cwd=root, capture_output=True, text=True, timeout=120)
    assert out.stdout.strip() == "True", out.stderr
