"""Core operators against small independent models."""

import random

import pytest
from pyspark.sql import functions as F

from quillmesh.config import PipelineConfig
from quillmesh.functions import dates as D
from quillmesh.functions import text as X
from quillmesh.operators import chunking as C
from quillmesh.operators import dedup as DD
from quillmesh.operators import enrich as E
from quillmesh.operators import graph as G
from quillmesh.operators import preprocess as P
from quillmesh.operators import resolve as S
from quillmesh.operators import search as Q
from quillmesh.sources import readers


def rows(df):
    return {tuple(r) for r in df.collect()}


def one(spark, expr, **cols):
    df = spark.createDataFrame([tuple(cols.values())], ", ".join(f"{k} {'int' if isinstance(v, int) else 'string'}" for k, v in cols.items()))
    return df.select(expr).first()[0]


@pytest.mark.parametrize("f, value, want", [
    (X.normalize_text, "  Straße \t X ", "strasse x"), (X.main_title, "The Two Cultures: A Look", "the two cultures"), (X.author_key, "St. Augustine, of Hippo", "augustine of hippo"),
    (X.article_title, "On the Road", "the road"), (X.article_title, "The A Tale!", "tale"), (X.viewer_title, "L’Été  Der “Tod”", "l'ete der \"tod\""), (X.viewer_author, "Chomsky, Noam, Jr", "Noam Chomsky"),
    (X.swapped_author, "Chomsky, Noam, Jr", "Noam, Jr Chomsky"), (X.viewer_author, "", "Unknown"), (X.slug, "A  Title -- 2!", "a_title_2"), (X.title_case, "o'neil von-x", "O'Neil Von-X"),
    (X.without_subtitle, "Cultures: And A Look", "Cultures"), (X.without_subtitle, "No mark", None), (X.without_article, "L'Homme", "Homme"), (X.last_name, "Plato", None), (X.last_name, "Benjamin Jowett", "Jowett"),
    (X.uncomma, "Chomsky, Noam", "Noam Chomsky"), (X.without_particle, "Simone de Beauvoir", "Simone Beauvoir"), (X.without_particle, "Arthur Schopenhauer", None), (X.without_particle, "de Beauvoir", "Beauvoir"),
    (X.without_particle, "Johann Wolfgang von Goethe", "Johann Wolfgang Goethe"), (X.unfence, "```json\n{}\n```", "{}"), (X.strip_marks, "born[12] here[a]", "born here"),
])
def test_text_functions(spark, f, value, want):
    assert one(spark, f(F.col("v")), v=value) == want


@pytest.mark.parametrize("b, d, want", [
    (-43, 17, (-43, 17)), (-63, 24, (-63, 24)), (-4, 65, (4, 65)), (-428, -348, (-428, -348)), (-1564, -1616, (1564, 1616)), (1564, -1616, (1564, 1616)), (1900, 1850, (None, None)), (-800, -100, (-800, -100)), (0, 300, (0, 300)),
])
def test_life_dates(spark, b, d, want):
    assert tuple(one(spark, D.validate_dates(F.col("b"), F.col("d")), b=b, d=d)) == want


@pytest.mark.parametrize("text, want", [("1951-01-01", 1951), ("386 BC", -386), ("64", 64), ("-398", -398), ("-0399", 399), ("428-427 BC", -428427), ("x", None)])
def test_years_of_text(spark, text, want):
    assert one(spark, D.parse_year(F.col("v")), v=text) == want


WORK = "group string, ord bigint, title string, author string, canonical_author string, cite_count bigint, contexts array<string>, commentaries array<string>"


def working(spark, data):
    return spark.createDataFrame([(g, o, t, a, None, n, c, []) for g, o, t, a, n, c in data], WORK)


def test_exact_dedup_equals_a_model(spark):
    rng = random.Random(1)
    data = [(rng.choice("gh"), i, rng.choice(["A", "a", "B", ""]), rng.choice(["X", "x", "Y"]), rng.randint(1, 3), rng.sample(["c1", "c2", "c3"], 2)) for i in range(60)]
    model = {}
    for g, o, t, a, n, c in data:
        m = model.setdefault((g, t.lower(), a.lower()), [t, a, 0, []])
        m[2] += n
        m[3] += [x for x in c if x not in m[3]]
    got = {(r["group"], r["title"].lower(), r["author"].lower()): [r["title"], r["author"], r["cite_count"], r["contexts"]] for r in P.exact_dedup(working(spark, data)).collect()}
    assert got == model
    assert P.exact_dedup(working(spark, [])).count() == 0


def test_non_persons_leave(spark):
    names = ["Plato", "the Stoics", "MARXISTS", "Anonymous", "PLATO", "Li", "Smith et al.", "Karl Rogers", "Rogers", "the Bible", "J. L. Austin"]
    got = {r["author"] for r in P.drop_non_persons(working(spark, [("g", i, "", a, 1, []) for i, a in enumerate(names)])).collect()}
    assert got == {"Plato", "Karl Rogers", "J. L. Austin"}


def test_fuzzy_clusters(spark):
    data = [("g", 1, "The World as Will", "Arthur Schopenhauer", 1, ["a"]), ("g", 2, "The World as Wil", "Schopenhauer", 2, ["b"]), ("g", 3, "Parerga", "Arthur Schopenhauer", 1, []), ("h", 4, "The World as Will", "Schopenhauer", 1, [])]
    got = {(r["ord"], r["cite_count"], tuple(r["contexts"])) for r in P.fuzzy_merge(working(spark, data)).collect()}
    assert got == {(1, 3, ("a", "b")), (3, 1, ()), (4, 1, ())}


def test_cluster_bound_loses_nothing():
    rng = random.Random(7)
    base = ["Silent Harbor of Dreams", "Second Loom", "Letters on Sleep"]
    rows_ = [{"ord": i, "title": "".join(c for c in rng.choice(base) if rng.random() > 0.06), "author": "".join(c for c in rng.choice(["Ada Lovelace", "Charles Babbage"]) if rng.random() > 0.06)} for i in range(80)]
    order = sorted(rows_, key=lambda r: (-(len(r["title"]) + len(r["author"])), r["ord"]))
    used, want = set(), []
    for i, s in enumerate(order):
        if s["ord"] in used:
            continue
        used.add(s["ord"])
        want.append((s["ord"], s["ord"]))
        for r in order[i + 1:]:
            a, b = s["author"].lower(), r["author"].lower()
            t, u = P._main_part(s["title"]), P._main_part(r["title"])
            if r["ord"] not in used and (a in b or b in a or P.ratio(a, b) > 0.85) and (t == u or P.ratio(t, u) > 0.85):
                used.add(r["ord"])
                want.append((r["ord"], s["ord"]))
    assert sorted(P.cluster_rows(rows_)) == sorted(want)


@pytest.mark.parametrize("threshold", [0.7, 0.85])
def test_large_book_equals_all_pairs(monkeypatch, threshold):
    rng = random.Random(5)
    slip = lambda t: "".join(c for c in t if rng.random() > 0.04)
    people = ["Ada Lovelace", "Lovelace", "A. de la Cruz", "Li", "Ō", "Zoë Straße", "nananana nana", "Charles Babbage", "Babbage, Charles", "Anna Nanna"]
    rows_ = [{"ord": i, "title": slip(rng.choice(["Silent Harbor of Dreams", "Second Loom", "Letters on Sleep", "((", "Новый мир", ""])), "author": slip(rng.choice(people)) or "x"} for i in range(400)]
    whole = P.cluster_rows(rows_, threshold)
    monkeypatch.setattr(P, "FEW_ROWS", 0)
    assert P.cluster_rows(rows_, threshold) == whole


def test_large_book_compares_few_rows():
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9))
    authors = [f"{word()} {word()}" for _ in range(1500)]
    met = sum(len(a) * len(b) for a, b in P._meetings(authors, 0.85))
    assert met < len(authors) ** 2 / 20


def test_preprocess_reads_its_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def told(author):
        seen.add(1)
        return author

    data = [("g", i, f"Work {i}", f"Ada Lovelace {i % 3}", 1, ["a"]) for i in range(20)]
    assert P.preprocess(working(spark, data).withColumn("author", told("author"))).count() > 0
    assert seen.value == len(data)


def test_keeper_of_a_work(spark):
    df = spark.createDataFrame([(1, "web_1", "w", 9), (2, "20", "w", 3), (3, "30", "w", 3), (4, "40", "v", 1), (5, "40", "v", 1), (6, None, "u", 1), (7, "70", "u", 1), (8, "80", None, 1), (9, "90", "", 1)], "ord bigint, book_id string, work_id string, cite_count bigint")
    got = rows(DD.dedup_by_work(df).select("ord", "cite_count", "merged"))
    assert got == {(2, 15, 3), (4, 1, 1), (5, 1, 1), (7, 2, 2), (8, 1, 1), (9, 1, 1)}


@pytest.mark.parametrize("config, n", [(PipelineConfig(chunk_size=0, max_context=20, max_completion=8), 30), (PipelineConfig(chunk_size=10, max_context=12, max_completion=4), 5)])
def test_budgeted_chunks(config, n):
    sents = [f"Sentence number {i}." for i in range(n)]
    count = lambda s: 4 + 3 * len(s)
    got = C.budget_chunks(sents, config.chunk_size, config, count)
    assert len(got) > 1 and got[0][1] == 1 and got[-1][2] == n
    assert all(b[1] == a[2] + 1 for a, b in zip(got, got[1:]))
    assert all(count(sents[s - 1:e]) <= config.max_context - config.max_completion for _, s, e in got)


def test_bad_budgets():
    for kw in ({"max_context": 0}, {"max_completion": 0}, {"max_context": 5, "max_completion": 5}):
        with pytest.raises(ValueError):
            PipelineConfig(**kw)


def test_extraction_and_failures(spark):
    ch = spark.createDataFrame([(1, 0, 1, 1, 'As Ada Lovelace wrote in "Notes", it runs.'), (2, 0, 1, 1, "boom")], "doc bigint, chunk_index int, start_sentence int, end_sentence int, excerpt string")

    def provider(text):
        if text == "boom":
            raise RuntimeError("no answer")
        return C.regex_extractor(text)

    got = rows(C.extract(ch, provider).select("doc", "status", "author", "title", "error"))
    assert got == {(1, "ok", "Ada Lovelace", "Notes", None), (2, "failed", None, None, "no answer")}


def test_query_expansion(spark):
    cols = "cit_id int, title string, author string, canonical_author string, variants array<string>"
    data = [(1, "The Republic", "Plato", None, []), (2, "The Two Cultures: And A Second Look", "C.P. Snow", None, []), (3, "The Republic", "Benjamin Jowett", None, []), (4, "The World as Will", "Schopenhauer", None, ["Arthur Schopenhauer"]),
            (5, "Syntactic Structures", "Chomsky, Noam", None, []), (6, "The Second Sex", "Simone de Beauvoir", None, []), (7, "Fractals", "B. Mandelbrot", "Benoit Mandelbrot", []), (8, "", "Aristotle", None, []), (9, None, None, None, []), (10, "The Republic", "", None, [])]
    got = {}
    for r in S.expand_queries(spark.createDataFrame(data, cols)).orderBy("cit_id", "query_no").collect():
        got.setdefault(r["cit_id"], []).append((r["q_title"], r["q_author"]))
    assert got[1] == [("The Republic", "Plato"), ("Republic", "Plato")]
    assert ("The Two Cultures", "C.P. Snow") in got[2] and ("Two Cultures", "C.P. Snow") in got[2]
    assert ("The Republic", "Jowett") in got[3] and ("The World as Will", "Arthur Schopenhauer") in got[4] and ("Syntactic Structures", "Noam Chomsky") in got[5]
    assert ("The Second Sex", "Simone Beauvoir") in got[6] and ("Fractals", "Benoit Mandelbrot") in got[7] and got[8] == [(None, "Aristotle")] and 9 not in got
    assert got[10][0] == ("The Republic", None)
    assert all(len({(str(t).lower(), str(a).lower()) for t, a in v}) == len(v) for v in got.values())


def test_gate(spark):
    data = [("a", 1, 95), ("a", 2, 94), ("b", 1, 80), ("b", 2, 60), ("c", 1, 80), ("c", 2, 75), ("d", 1, 60), ("e", 1, 75)]
    got = rows(S.gate(spark.createDataFrame(data, "id string, ord bigint, score int")).select("id", "ord", "decision"))
    assert got == {("a", 1, "accepted"), ("b", 1, "single"), ("c", 1, "adjudicated"), ("d", None, "none"), ("e", 1, "single")}


def test_searches_equal_brute_force(spark):
    rng = random.Random(3)
    words = ["sea", "loom", "Mémoire", "sky", "the"]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 6)))) for i in range(60)] + [(100, None), (101, "")]
    asked = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 3)))) for i in range(30)] + [(50, ""), (51, None), (52, "absent word")]
    d, q = spark.createDataFrame(docs, "d int, t string"), spark.createDataFrame(asked, "q int, w string")
    fold = lambda s: (s or "").lower().replace("é", "e").split()
    want = {(a, b) for a, w in asked for b, t in docs if fold(w) and f" {' '.join(fold(w))} " in f" {' '.join(fold(t))} "}
    assert rows(Q.phrase_hits(q, d, "q", "w", "d", "t")) == want
    want = {(a, b) for a, w in asked for b, t in docs if fold(w) and set(fold(w)) <= set(fold(t))}
    assert rows(Q.all_words_hits(q, d, "q", "w", "d", "t")) == want
    names = spark.createDataFrame([(i, t) for i, t in docs if t], "ord int, name string")
    q2 = spark.createDataFrame([("oom",), ("s",), ("sk",), ("zzz",)], "q string")
    got = rows(Q.substring_lookup(q2, names, 1000).select("q", "name"))
    assert got == {(x, t) for (x,) in [("oom",), ("s",), ("sk",), ("zzz",)] for _, t in docs if t and x in t.lower()}


def test_years_spread_over_the_graph(spark):
    nodes = spark.createDataFrame([("a", 1900, 1980, None, False), ("b", None, None, 1950.0, False), ("c", None, None, None, True), ("d", None, None, None, False), ("e", None, None, None, False)], "name string, birth_year int, death_year int, book_year double, is_source boolean")
    links = spark.createDataFrame([("c", "d"), ("a", "d")], "src string, dst string")
    assert rows(G.impute_years(nodes, links)) == {("a", 1940.0, "life"), ("b", 1950.0, "books"), ("c", 2000.0, "source"), ("d", 1930.0, "neighbours"), ("e", 1950.0, "median")}


def test_distribution_other_is_last(spark):
    df = spark.createDataFrame([(c,) for c in "aaaabbbccdefghijk"] + [(None,)], "v string")
    got = {r["pos"]: (r["bucket"], r["n"]) for r in G.distribution(df, "v").collect()}
    assert got[1] == ("a", 4) and got[7] == ("Other", 17 - 4 - 3 - 2 - 3) and len(got) == 7


def test_hit_test_equals_brute_force(spark):
    rng = random.Random(2)
    cs = [(i, i, rng.uniform(0, 50), rng.uniform(0, 50), rng.uniform(1, 6)) for i in range(40)]
    ps = [(i, rng.uniform(0, 50), rng.uniform(0, 50)) for i in range(60)]
    got = rows(G.hit_test(spark.createDataFrame(cs, "cid int, ord int, x double, y double, r double"), spark.createDataFrame(ps, "pid int, x double, y double"), 8.0))
    want = {}
    for p, x, y in ps:
        for c, o, cx, cy, r in cs:
            if (x - cx) ** 2 + (y - cy) ** 2 <= r * r:
                want[p] = c
    assert got == set(want.items())


def test_upsert_decisions_resume(spark):
    old, new = spark.createDataFrame([(1, 1), (2, 2)], "k int, v int"), spark.createDataFrame([(2, 9), (3, None)], "k int, v int")
    assert rows(E.upsert(old, new, "k")) == {(1, 1), (2, 9), (3, None)}
    assert rows(E.update_present(old, new, "k")) == {(1, 1), (2, 9)}
    cites = spark.createDataFrame([(1, "a", "t"), (2, "b", "t"), (3, "c", "t"), (4, "d", None)], "cit int, author string, title string")
    dec = spark.createDataFrame([(1, 1, "remove", None, None), (2, 2, "fix", "B", ""), (2, 3, "fix", "BB", " "), (3, 4, "keep", "X", "Y")], "cit int, ord int, status string, fixed_author string, fixed_title string")
    assert rows(E.apply_decisions(cites, dec, ["cit"]).select("cit", "author", "title")) == {(2, "BB", "t"), (3, "c", "t"), (4, "d", None)}
    done = spark.createDataFrame([("d", None)], "author string, title string")
    assert rows(E.resume(cites, done).select("cit")) == {(1,), (2,), (3,)}


def test_pages(spark, tmp_path):
    html = (
        '<script id="__NEXT_DATA__" type="x">{"props":{"pageProps":{"apolloState":{"Book:1":{},"Work:2":{"details":{"publicationTime":-70000000000000}}}}}}</script>'
        "<table><tr><th>Born</th><td>1 May 1900[1]</td></tr><tr><th>Died</th><td>1980 &amp; later</td></tr><tr><td>x</td></tr></table>"
        "<p>short</p><p>A paragraph that is certainly long enough to be kept.[2]</p>"
    )
    df = spark.createDataFrame([(html,), ("",)], "h string")
    r = df.select(readers.publication_ms(F.col("h")).alias("ms"), readers.infobox(F.col("h")).alias("box"), readers.paragraphs(F.col("h")).alias("p")).collect()
    assert r[0]["ms"] == -70000000000000 and r[0]["box"] == {"Born": "1 May 1900", "Died": "1980 & later"} and r[0]["p"] == ["A paragraph that is certainly long enough to be kept."]
    assert r[1]["ms"] is None and r[1]["p"] == []
    assert one(spark, D.epoch_year(F.lit(-70000000000000)), v="x") == -248
    wiki = "{{Infobox philosopher\n|x}} [[Category:428 BC births]] [[Category:348 BC deaths]] [[Category:Greeks]]"
    assert one(spark, readers.is_person(F.col("v")), v=wiki) and one(spark, readers.category_year(F.col("v"), "births"), v=wiki) == -428
    (tmp_path / "The_Republic_123.txt").write_text("Text.")
    (tmp_path / "Loose.txt").write_text("Other.")
    (tmp_path / "skip.md").write_text("no")
    assert rows(readers.texts(spark, str(tmp_path))) == {("123", "The Republic", "Text.", True), ("Loose", "Loose", "Other.", False)}


def test_stream_resumes(spark, tmp_path):
    from quillmesh.streaming.resume import first_seen, run_available, stream

    spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, v string").write.parquet(str(tmp_path / "in/1"))
    schema, out = "k int, v string", str(tmp_path / "out")

    def go():
        run_available(first_seen(stream(spark, str(tmp_path / "in/*"), schema), ["k"]), lambda df, _: df.write.mode("append").parquet(out), str(tmp_path / "state"))
        return sorted(r["k"] for r in spark.read.parquet(out).collect())

    assert go() == [1, 2]
    spark.createDataFrame([(2, "b"), (3, "c")], "k int, v string").write.parquet(str(tmp_path / "in/2"))
    assert go() == [1, 2, 3]


def test_every_oracle_has_a_query():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
