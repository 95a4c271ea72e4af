"""The training-data operators on small tables: results, and nulls, blanks, ties, repeats, empty tables, clashing names."""

import datetime as dt
import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from quillmesh.llm import neardup, survivor
from quillmesh.llm.canonical import map_to_list
from quillmesh.llm.leakage import find_leaks
from quillmesh.llm.matching import matched_records
from quillmesh.llm.mixture import mix, with_token_counts
from quillmesh.llm.neardup import group_records, near_duplicates, record_pairs, similar_sets
from quillmesh.llm.residue import detect_residue, drop_residue
from quillmesh.llm.survivor import build_survivors, choose_survivors
from quillmesh.llm.triejoin import trie_join
from quillmesh.llm.variants import variant_pairs

CIT = "cit_id bigint, author string, canonical_author string, title string, spelling string"


def rows(df):
    return {tuple(r) for r in df.collect()}


def test_variants(spark):
    data = [
        (1, "Wilhelmina Zoloth", None, "Honest Engine of Prierra", "x"), (2, "Zoloth, Wilhelmina", None, "Honest Engine of Prierra", "x"), (3, "W. Zoloth", None, "Honest Engine of Prierra", "x"),
        (4, "WILHELMINA ZOLOTT", None, "Honest Engine of Prierra: A Study", "x"), (5, "Laszlo Zoloth", None, "Another Work", "x"), (6, "Dr. Laszlo Zoloth", "Laszlo Zoloth", "Another Work", "x"),
        (7, "et al.", None, "Honest Engine of Prierra", "x"), (8, None, None, None, None), (9, "", None, "", "x"), (10, "  ", "N/A", "Another Work", "x"),
        (11, "Academy of Skeune Sleep and Trade", None, None, "x"), (12, "AOSSAT (Skeune)", None, None, "x"), (13, "x" * 5000, None, None, "x"), (1, "Wilhelmina Zoloth", None, "Honest Engine of Prierra", "x"),
    ]
    got = rows(variant_pairs(spark.createDataFrame(data, CIT)))
    z = sorted(["Wilhelmina Zoloth", "Zoloth, Wilhelmina", "W. Zoloth", "WILHELMINA ZOLOTT"])
    want = {(a, b) for a in z for b in z if a < b} | {("Dr. Laszlo Zoloth", "Laszlo Zoloth"), ("AOSSAT (Skeune)", "Academy of Skeune Sleep and Trade")}
    assert got == want


def test_short_names_are_learned_from_shared_works(spark):
    data = []
    for i, stem in enumerate(["Zoloth", "Kanison", "Drisso"]):
        data += [(f"Rebecca {stem}", f"Work Number {i}"), (f"{stem}, Rebecca", f"Work Number {i}"), (f"Bex {stem}", f"Work Number {i}"), (f"Ann {stem}", f"Elsewhere {i}"), (f"Ann {stem}", f"Elsewhere {i}")]
    # Nothing but the learned pair speaks for these two; Ann is somebody else.
    data += [("Rebecca Marvel", "Own Work"), ("Bex Marvel", None), ("Ann Marvel", "Other Work"), ("Saml. Butler", None), ("Samuel Butler", "A Way"), ("Li", None), ("LI", None), ("Wu", None)]
    got = rows(variant_pairs(spark.createDataFrame([(i, a, None, t, "x") for i, (a, t) in enumerate(data)], CIT)))
    assert {("Bex Zoloth", "Rebecca Zoloth"), ("Bex Marvel", "Rebecca Marvel"), ("Saml. Butler", "Samuel Butler"), ("LI", "Li")} <= got
    assert not any("Ann" in a or "Ann" in b or "Wu" in (a, b) for a, b in got)


def test_slips_link_however_large_the_corpus(spark):
    data = [("Dorothy Dendard", "A Work"), ("Dendard, Dorothy", "A Work"), ("dorothy dendard", "A Work"), ("DENDARD, DOROTHY", "A Work")] * 5 + [("Dorothy Dendrd", None), ("Dendrd, Dorothy", None)]
    want = {tuple(sorted((a, b))) for a in {x for x, _ in data} for b in {x for x, _ in data} if a != b}
    # Shapes fold case and punctuation: four of the frequent name are two shapes, so the slip needs one.
    data = [x for x in data if x[0] != "Dendrd, Dorothy"]
    got = rows(variant_pairs(spark.createDataFrame([(i, a, None, t, "x") for i, (a, t) in enumerate(data)], CIT)))
    assert got == {p for p in want if "Dendrd, Dorothy" not in p}


def test_rows_that_name_both_link_beyond_the_trie(spark):
    data = [(1, "Mark Twain", "Samuel Clemens", "Tom", "x"), (2, "Mark Twain", None, "Huck", "x"), (3, "Twain, Mark", None, "Huck", "x"), (4, "Mark Rothko", None, "Red", "x")]
    got = rows(variant_pairs(spark.createDataFrame(data, CIT)))
    assert got == {("Mark Twain", "Samuel Clemens"), ("Mark Twain", "Twain, Mark"), ("Samuel Clemens", "Twain, Mark")}


@pytest.mark.parametrize("size", [1, 20_000])
def test_trie_match_equals_brute_force(spark, monkeypatch, size):
    import quillmesh.llm.triejoin as T
    from quillmesh.llm.canonical import distance

    monkeypatch.setattr(T, "SHARD", size)
    monkeypatch.setattr(T, "QUERIES", size)
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcd") for _ in range(rng.randint(1, 8)))
    left, right = sorted({word() for _ in range(70)}), sorted({word() for _ in range(70)})
    got = rows(T.trie_match(spark.createDataFrame([(w,) for w in left] + [(None,), ("#abc",)], "x string"), spark.createDataFrame([(w,) for w in right] + [("",), ("#abc",)], "y string")))
    assert got == {(a, b, distance(a, b)) for a in left for b in right if a != b and distance(a, b) <= T.reach(min(len(a), len(b)))}


@pytest.mark.parametrize("block", [3, 20_000])
def test_bk_trees_in_blocks_equal_brute_force(spark, monkeypatch, block):
    import quillmesh.llm.canonical as K
    from quillmesh.llm.triejoin import reach

    monkeypatch.setattr(K, "BLOCK", block)
    monkeypatch.setattr(K, "QUERIES", block)
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcd") for _ in range(rng.randint(1, 8)))
    q, e = [(rng.choice(["stem", "acronym"]), word()) for _ in range(60)], [(rng.choice(["stem", "acronym"]), word()) for _ in range(60)]
    got = rows(K.in_reach(spark.createDataFrame(q + [("lead", "x")], "space string, s string"), spark.createDataFrame(e + [("stem", "")], "space string, s string")))
    near = lambda s, a, b: K.distance(a, b) <= (0 if s == "acronym" else reach(len(a)))
    assert got == {(s, a, b, K.distance(a, b)) for s, a in q for t, b in e if s == t and near(s, a, b)}


@pytest.mark.parametrize("shelf", [0, 1024])
def test_matching_by_words_equals_matching_by_surname(spark, monkeypatch, shelf):
    import quillmesh.llm.matching as M

    monkeypatch.setattr(M, "SHELF", shelf)
    m = meta(spark, [(1, "w1", "Emma", "Jane Austen", 1815, 1, 1), (2, "w2", "It", "Stephen King", 1986, 1, 1), (3, "w3", "The Long Night of Drarkast", "Jane Austen", 1820, 1, 1)])
    c = spark.createDataFrame([(1, "Emma", "Austen", ""), (2, "IT", "King, S.", ""), (3, "Long Nigt of Drarkast", "Jane Austin", ""), (4, "Persuasion", "Jane Austen", "")], "raw_id bigint, title string, author string, citation_excerpt string")
    assert rows(matched_records(c, m).select("raw_id", "book_id")) == {(1, 1), (2, 2), (3, 3)}


def test_propagation_equals_a_model(spark):
    from quillmesh.llm.common import Stages
    from quillmesh.llm.matching import COMPETITION, propagate

    rng = random.Random(4)
    edges = {}
    for _ in range(60):
        edges[(f"m{rng.randrange(18)}", f"w{rng.randrange(12)}")] = (rng.choice("abc"), rng.choice([0.2, 1.0, 5.0, 40.0]))
    edges = [(m, w, s, o) for (m, w), (s, o) in edges.items()] + [("alone", "only", "a", 3.0)]
    fm, fw = [1.0] * len(edges), [1.0] * len(edges)
    for _ in range(400):
        best = {}
        for i, (m, w, s, o) in enumerate(edges):
            best[(w, s)] = max(best.get((w, s), 0.0), o * fm[i])
        nm = [1 / (1 + sum(edges[j][3] * fw[j] for j in range(len(edges)) if j != i and edges[j][0] == m)) for i, (m, *_) in enumerate(edges)]
        nw = [1 / (1 + COMPETITION * sum(b for (x, t), b in best.items() if x == w and t != s)) for _, w, s, _ in edges]
        fm, fw = [(a * b) ** 0.5 for a, b in zip(fm, nm)], [(a * b) ** 0.5 for a, b in zip(fw, nw)]
    want = {(m, w): o * fm[i] * fw[i] / (1 + o * fm[i] * fw[i]) for i, (m, w, s, o) in enumerate(edges)}
    got = {(r["m"], r["w"]): r["p"] for r in propagate(Stages(spark), spark.createDataFrame(edges, "m string, w string, slot string, odds double"), 1e-6).collect()}
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-3 for k in want)


def test_variants_of_nothing(spark):
    assert rows(variant_pairs(spark.createDataFrame([], CIT))) == set()


def test_trie_join_equals_brute_force(spark):
    from quillmesh.llm.canonical import distance
    from quillmesh.llm.triejoin import reach

    rng = random.Random(4)
    words = sorted({"".join(rng.choice("abcd") for _ in range(rng.randint(1, 9))) for _ in range(150)})
    got = rows(trie_join(spark.createDataFrame([(w,) for w in words] + [(None,), ("",)], "w string"), "w"))
    want = {(a, b, distance(a, b)) for a in words for b in words if a < b and min(len(a), len(b)) >= 3 and distance(a, b) <= reach(min(len(a), len(b)))}
    assert got == want


def _pairs(s):
    s = "".join(c for c in unicodedata.normalize("NFKD", s.lower()) if not unicodedata.combining(c))
    return {w[i:i + 2] for w in re.findall(r"[^\W_]+", s) for i in range(len(w) - 1)}


def _agree(a, b):
    a, b = _pairs(a), _pairs(b)
    return bool(a and b) and 2 * len(a & b) >= 0.75 * (len(a) + len(b))


RAW = "raw_id bigint, source_book_id string, title string, author string, g string, class string"


@pytest.mark.parametrize("cell", [1, 32])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, cell):
    monkeypatch.setattr(neardup, "CELL", cell)
    rng = random.Random(6)
    titles = ["The Silent Harbor of Drarkast", "On Memory and the Second Loom", "Letters from Stewyn on Sleep", "Él Molino Sereno"]
    authors = ["Ada Lovelace", "Charles Babbage", "Émilie du Châtelet"]

    def noisy(s):
        s = list(s)
        for _ in range(rng.randint(0, 3)):
            i = rng.randrange(len(s))
            s[i:i + rng.randint(0, 2)] = rng.choice(["", "x", "ee"])
        return "".join(s)

    data = [(i, rng.choice(["b1", "b1", "b1", "b2"]), noisy(rng.choice(titles)), noisy(rng.choice(authors)), "g", "c") for i in range(90)]
    data += [(200, "b1", None, "Ada Lovelace", "g", "c"), (201, "b1", " ", "Ada Lovelace", "g", "c"), (202, None, titles[0], authors[0], "g", "c"), (203, "b1", "?", "!", "g", "c"), data[0], data[1]]
    df = spark.createDataFrame(data, RAW)
    links, members = near_duplicates(df)
    got = rows(record_pairs(links, members))
    ok = {d[0]: d for d in data if d[1] and d[2] and d[2].strip() and d[3]}
    want = {(a, b) for a in ok for b in ok if a < b and ok[a][1] == ok[b][1] and _agree(ok[a][2], ok[b][2]) and _agree(ok[a][3], ok[b][3])}
    assert got == want
    groups = {r["raw_id"]: r["group_id"] for r in group_records(links, members).collect()}
    assert all(groups[a] == groups[b] for a, b in got)


def test_similar_sets_of_any_size(spark):
    rng = random.Random(9)
    sets = [(i, sorted(rng.sample(range(1, 5000), rng.choice([1, 2, 3, 8, 40, 300])))) for i in range(40)]
    sets += [(100 + i, sorted(set(s[: max(1, int(len(s) * 0.9))] + [7000 + i]))) for i, s in sets]
    sets += [(900, [])]
    big = [(i, [e * 2654435761 % (1 << 61) for e in s]) for i, s in sets]
    got = rows(similar_sets(spark.createDataFrame(big, "id bigint, elems array<bigint>"), [], "id"))
    d = dict(sets)
    assert got == {(a, b) for a in d for b in d if a < b and d[a] and d[b] and 2 * len(set(d[a]) & set(d[b])) >= 0.75 * (len(d[a]) + len(d[b]))}


def test_near_duplicates_of_nothing(spark):
    links, members = near_duplicates(spark.createDataFrame([], RAW))
    assert rows(record_pairs(links, members)) == set() and rows(members) == set()


META = (
    "book_id bigint, work_id string, title string, title_without_series string, authors array<struct<author_id: bigint, name: string>>, publication_year int, "
    "ratings_count bigint, updated_at timestamp, ingested_at timestamp, work string"
)
T0 = dt.datetime(2025, 1, 1)


def meta(spark, data):
    return spark.createDataFrame([(b, w, t, None, [(1, a)] if a else None, y, r, T0 + dt.timedelta(days=u) if u is not None else None, T0, "x") for b, w, t, a, y, r, u in data], META)


def test_matching(spark):
    m = meta(spark, [
        (1, "w1", "The Silent Harbor", "Ada Lovelace", 1900, 1, 1), (2, "w1", "The Silent Harbor (Sea, #2)", "A. Lovelace", None, 1, 1), (3, None, "The Silent Harbor", "Ada Lovelace", None, 1, 1),
        (4, "w2", "The Silent Harbor", "Charles Babbage", 1800, 1, 1), (5, "w3", None, None, None, None, None), (6, None, None, "Ada Lovelace", None, None, None), (7, "w4", "Loom and Light", "Ada Lovelace", 1, 1, 1),
    ])
    cols = "raw_id bigint, title string, author string, citation_excerpt string, m string, work string"
    c = spark.createDataFrame([
        (1, "Silent Harbor, The", "Lovelace, Ada", "x", "", ""), (2, "The Silent Harbr: A Story", "Prof. A. Lovelacce", None, "", ""), (3, "The Silent Harbor", "Babbage", "(1800)", "", ""), (4, "The Silent Harbor", "Nobody Else", "", "", ""),
        (5, None, "Ada Lovelace", "", "", ""), (6, "The Silent Harbor", "  ", "", "", ""), (7, "The Silent Harbor", None, "", "", ""), (1, "Silent Harbor, The", "Lovelace, Ada", "x", "", ""),
    ], cols)
    got = matched_records(c, m)
    assert rows(got.select("raw_id", "book_id")) == {(1, 1), (1, 2), (1, 3), (2, 1), (2, 2), (2, 3), (3, 4)}
    assert all(0.5 <= r["confidence"] <= 1 for r in got.collect())
    assert rows(matched_records(spark.createDataFrame([], cols), m)) == set()
    assert rows(matched_records(c, spark.createDataFrame([], META))) == set()


def _lead(recs):
    best = [r for r in recs if all(r[1] > o[1] and r[2] > o[2] and r[3] > o[3] for o in recs if o[0] != r[0])]
    return best[0][0] if len(best) == 1 and len(recs) > 1 else None


@pytest.mark.parametrize("bound", [256, 2])
def test_survivors(spark, monkeypatch, bound):
    monkeypatch.setattr(survivor, "GROUP_BOUND", bound)
    rng = random.Random(1)
    data = [(i, f"w{rng.randrange(8)}", rng.choice(["Title", None, "n/a"]), rng.choice(["A", None]), rng.choice([1900, None, 9999]), rng.choice([None, 1, 2, 3, 50]), rng.choice([None, 1, 2, 3, 9])) for i in range(40)]
    data += [(100, "lead", "T", "A", 1900, 9, 9), (101, "lead", None, "A", None, 3, 3), (102, "tie", "T", "A", 1900, 9, 9), (103, "tie", "T", "A", 1900, 9, 9), (104, None, "T", "A", 1, 1, 1)]
    df = meta(spark, data + data[:3])
    got = {r["work_id"]: r for r in choose_survivors(df, fields=("title", "authors", "publication_year", "ratings_count")).collect()}
    by = {}
    for b, w, t, a, y, r, u in data:
        if w:
            by.setdefault(w, []).append((b, (t == "Title" or t == "T") + (a is not None) + (y == 1900 or y == 1) + (r is not None), -1 if u is None else u, -1 if r is None else r))
    for w, recs in by.items():
        assert got[w]["n_records"] == len(recs)
        assert (got[w]["base_id"] if got[w]["clear_lead"] else None) == _lead(recs), w
    assert got["lead"]["base_id"] == 100 and got["lead"]["clear_lead"] and not got["tie"]["clear_lead"] and got["tie"]["base_id"] == 102
    built = {r["work_id"]: r for r in build_survivors(df, fields=("title", "authors", "publication_year", "ratings_count")).collect()}
    for w in by:
        if any(t in ("Title", "T") for b, w2, t, *_ in data if w2 == w):
            assert built[w]["title"] in ("Title", "T")


def test_layers_are_the_same_by_either_way(spark, monkeypatch):
    rng = random.Random(12)
    data = [(i, "w", rng.choice(["T%d" % i, None]), rng.choice(["A", None]), rng.choice([1900 + i, None]), rng.choice([None, 1, 2, 3]), rng.choice([None, 1, 2, 3])) for i in range(30)]
    fields = ("title", "authors", "publication_year", "ratings_count")
    one = rows(choose_survivors(meta(spark, data), fields=fields).select("work_id", "base_id", "skyline_size", "clear_lead", F.to_json("field_sources")))
    monkeypatch.setattr(survivor, "GROUP_BOUND", 4)
    assert one == rows(choose_survivors(meta(spark, data), fields=fields).select("work_id", "base_id", "skyline_size", "clear_lead", F.to_json("field_sources")))


def test_survivors_of_nothing(spark):
    assert rows(choose_survivors(spark.createDataFrame([], META), fields=("title",))) == set()


def test_mapping_to_a_list(spark):
    refs = spark.createDataFrame([(1, "Dorothy Dendard"), (2, "Ada Lovelace"), (3, "Academy of Skeune Sleep and Trade"), (4, None)], "author_id bigint, name string")
    data = [
        (1, "Dorothy Dendard", None, "A Work", ""), (2, "Dendard, D.", None, "A Work", ""), (3, "Dr. Dorothy Dendart", None, "Other Work", ""), (4, "Dorothy Dendart", None, "Other Work", ""), (5, "dendart, dorothy", None, "Other Work", ""),
        (6, "ADA LOVELACE", None, "", ""), (7, "Ada Lovelacee", None, "", ""), (8, "AOSSAT (Skeune)", None, None, ""), (9, "Unknown", None, None, ""), (10, None, None, None, ""), (11, "", None, None, ""), (12, "Someone Different", None, None, ""), (1, "Dorothy Dendard", None, "A Work", ""),
    ]
    got, rest = map_to_list(spark.createDataFrame(data, CIT), refs)
    assert rows(got) == {(1, 1), (2, 1), (6, 2), (7, 2), (8, 3)}
    assert rows(rest.select("author")) == {("Dr. Dorothy Dendart",), ("Dorothy Dendart",), ("dendart, dorothy",), ("Unknown",), (None,), ("",), ("Someone Different",)}
    got, rest = map_to_list(spark.createDataFrame(data, CIT), spark.createDataFrame([], "author_id bigint, name string"))
    assert rows(got) == set()
    assert rows(map_to_list(spark.createDataFrame([], CIT), refs)[0]) == set()


def test_leaks(spark, monkeypatch):
    text = "The kiln of vanity led back to one orphaned memory while seven masons kept their ledgers shut and every harbor slept under a secular moon until dawn"
    items = spark.createDataFrame([(1, text), (2, None), (3, ""), (4, "too short")], "item_id bigint, citation_excerpt string")
    half = " ".join(text.split()[:16])
    docs = spark.createDataFrame([
        (1, "Before. " + text.upper() + " After.", "a"), (2, half + " and more", "a"), (3, " ".join(text.split()[:8]) + " is a short quotation", "a"), (4, None, "a"), (5, "", "a"),
        (6, "word " * 300_000 + text, "a"), (7, text.replace("seven", "sevn").replace("ledgers", "led-\ngers"), "a"), (1, "Before. " + text.upper() + " After.", "a"), (8, "too short", "a"),
    ], "doc_id bigint, text string, _id string")
    want = {(1, 1), (2, 1), (6, 1), (7, 1)}
    assert rows(find_leaks(docs, items).select("doc_id", "item_id")) == want
    import quillmesh.llm.leakage as L

    monkeypatch.setattr(L, "BLOCK_WORDS", 1)  # one item a block
    assert rows(find_leaks(docs, items).select("doc_id", "item_id")) == want
    assert rows(find_leaks(docs.limit(0), items)) == set() and rows(find_leaks(docs, items.limit(0))) == set()


def test_short_items_leak_whole_and_typos_do_not_hide_a_passage(spark):
    text = "The kiln of vanity led back to one orphaned memory while seven masons kept their ledgers shut and every harbor slept under a secular moon until dawn"
    broken = " ".join("zzz" if i % 5 == 4 else w for i, w in enumerate(text.split()))
    items = spark.createDataFrame([(1, text), (2, "one orphaned memory kept"), (3, "two words")], "item_id bigint, citation_excerpt string")
    docs = spark.createDataFrame([(1, "So " + broken + " it ends."), (2, "Then ONE orphaned memory, kept apart."), (3, "one orphaned memory"), (4, "two words")], "doc_id bigint, text string")
    assert rows(find_leaks(docs, items).select("doc_id", "item_id")) == {(1, 1), (2, 2)}


def test_leaks_are_cut_out(spark):
    from quillmesh.llm.leakage import remove_leaks

    text = "The kiln of vanity led back to one orphaned memory while seven masons kept their ledgers shut"
    items = spark.createDataFrame([(1, text)], "item_id bigint, citation_excerpt string")
    docs = spark.createDataFrame([(1, f"Before it. {text.upper()}. After it."), (2, "Nothing here."), (3, None), (4, ""), (5, "A. " + text.replace("masons", "ma\u00adsons").replace("ledgers", "led-\ngers") + "; B.")], "doc_id bigint, text string")
    got = {r["doc_id"]: (r["text"], r["removed"]) for r in remove_leaks(docs, items).collect()}
    assert got[1] == ("Before it. . After it.", len(text)) and got[2] == ("Nothing here.", 0) and got[3] == (None, 0) and got[4] == ("", 0) and got[5][0] == "A. ; B."
    assert rows(find_leaks(remove_leaks(docs, items), items)) == set()


@pytest.mark.parametrize("bound", [256, 4])
def test_survivors_with_text_ids(spark, monkeypatch, bound):
    monkeypatch.setattr(survivor, "GROUP_BOUND", bound)
    data = [(f"id{i:02d}", "w", "T" if i % 3 else None, i % 4, T0, T0) for i in range(12)]
    df = spark.createDataFrame(data, "book_id string, work_id string, title string, ratings_count bigint, updated_at timestamp, ingested_at timestamp")
    r = choose_survivors(df, fields=("title", "ratings_count")).first()
    assert (r["base_id"], r["n_records"], r["clear_lead"]) == ("id07", 12, False)


def test_mixture_cuts_and_repeats(spark):
    rng = random.Random(0)
    docs = [(i, rng.choice(["a", "a", "a", "b"]), rng.randint(0, 50)) for i in range(400)] + [(1000, None, 5), (1001, "c", 7)]
    targets = [("a", 0.5, 1), ("b", 0.45, 3), ("d", 0.05, 2)]
    df = spark.createDataFrame(docs, "doc_id bigint, source string, n_tokens bigint")
    tg = spark.createDataFrame(targets, "source string, target_share double, max_repeats int")
    for ranges in (1, 16):
        sel, rep = mix(df, tg, ranges=ranges)
        rep = {r["source"]: r for r in rep.collect()}
        total = sum(n for *_, n in docs)
        size = {s: sum(n for _, x, n in docs if x == s) for s in ("a", "b")}
        for s, share, reps in targets[:2]:
            budget, used = int(share * total), rep[s]["used_tokens"]
            assert abs(used - min(budget, reps * size[s])) <= 25 + 1
            assert used == sum(r["n_tokens"] * r["copies"] for r in sel.where(F.col("source") == s).collect())
        assert max(r["copies"] for r in sel.collect()) <= 3 and rep["d"]["used_tokens"] == 0 and rep["c"]["target_share"] == 0
        assert abs(sum(r["actual_share"] for r in rep.values()) - 1) < 1e-9
    assert mix(df.limit(0), tg)[0].count() == 0 and mix(df, tg.limit(0))[0].count() == 0


def test_token_counts(spark):
    got = with_token_counts(spark.createDataFrame([(1, "hello world"), (2, ""), (3, None), (4, "word " * 50_000)], "id int, text string"))
    assert [r["n_tokens"] for r in got.orderBy("id").collect()][:3] == [2, 0, 0]
    assert got.where("id = 4").first()["n_tokens"] >= 50_000


def test_residue_in_tables(spark):
    docs = spark.createDataFrame([(1, "Dear {{name}},", "x"), (2, "Fine text.", "y"), (3, None, "z"), (4, "", "z"), (1, "Dear {{name}},", "x"), (5, "Error 404", "k")], "doc_id bigint, text string, kind string")
    assert rows(detect_residue(docs)) == {(1, "placeholder"), (5, "error")}
    assert rows(drop_residue(docs).select("doc_id")) == {(2,), (3,), (4,)}
    assert rows(detect_residue(docs.limit(0))) == set()


def test_written_plans_of_the_list_mapping_stay_small(spark, monkeypatch):
    from quillmesh.llm.common import Stages

    cit = spark.createDataFrame([(1, "Smith, John", None, "A Long Title"), (2, "J. Smith", "John Smith", "A Long Title"), (3, "Smyth, John", None, "Other Words"), (4, "Nobody Else", None, None)], "cit_id int, author string, canonical_author string, title string")
    refs = spark.createDataFrame([(10, "John Smith"), (11, "Jane Roe")], "author_id int, name string")
    joins, cut = [], Stages.cut

    def counted(self, df):
        joins.append(df._jdf.queryExecution().optimizedPlan().toString().count("Join "))
        return cut(self, df)

    monkeypatch.setattr(Stages, "cut", counted)
    matches, _ = map_to_list(cit, refs)
    assert {(r["cit_id"], r["author_id"]) for r in matches.collect()} >= {(1, 10), (2, 10)}
    assert max(joins) <= 10, joins
