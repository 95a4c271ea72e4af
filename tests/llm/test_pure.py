"""Parts of the training-data operators that need no Spark."""

import random

import pytest

from quillmesh.llm.canonical import BKTree, distance
from quillmesh.llm.leakage import SuffixAutomaton, covered, normal_words
from quillmesh.llm.names import parse_name
from quillmesh.llm.residue import residue_kind
from quillmesh.llm.triejoin import Trie, _keys, reach


@pytest.mark.parametrize(
    "text",
    [
        "Dear {{first_name}}, welcome.", "Hello ${user},", "Price: <%= item.price %>", "Published by [[insert publisher here]].", "@@title@@", "Hi %FIRST_NAME%,",
        "Author: __AUTHOR__", "<<genre>> by readers", "Rated #rating# by readers.", "Hi {title},", "Hello [READER],", "[TODO: quote]", "<!-- include: body -->",
        "Lorem ipsum dolor sit amet consectetur adipiscing elit", "Good text. " + "blah " * 6, "TBD", "description coming soon.", "Texte à venir.", "Author: undefined",
        "[object Object] by NaN.", "Error 404", "404 Not Found", "Service unavailable (503): This record cannot be displayed.", "Access denied.", "Too many requests from your network.",
        "Traceback (most recent call last):\n  File \"a.py\", line 3, in f", "Please enable JavaScript to read this page.", "Your browser has disabled scripts; the book cannot open.",
        "Seite nicht gefunden (Fehler 404).", "Real prose here.\nYour session has timed out. Sign in again.",
    ],
)
def test_residue_is_found(text):
    assert residue_kind(text)


@pytest.mark.parametrize(
    "text",
    [
        None, "", "  \n ", "A plain sentence about a book.", "The manual explains how a template with fields such as [AUTHOR] and [TITLE] was completed by hand.",
        "One greets the reader, Dear [name], as form letters did before 1949, and then mocks the greeting.", "Her essay treats the error page as a small elegy.",
        "Critics wrote that access was denied to travel itself.", "Shelf mark 404 was not found missing until 1950, when the room moved.", "He taught printers: enable JavaScript last, the notes say.",
        "Let {x, y} stand for two archives.", "The survey lists <i>winters</i> and [sic] notebooks; 76% of readers agreed.", "Use `{{name}}` for the name.", "```\n{{ code }}\n```\nA tutorial.",
        "Menu  Search  Sign in\n\nThe manuscripts of the north were described in 1502.",
    ],
)
def test_prose_is_no_residue(text):
    assert residue_kind(text) is None


def test_residue_far_into_a_long_text():
    assert residue_kind("word and another " * 200_000 + "\n{{ title }}\n") == "placeholder"


def _runs(words, item, k):
    return {(i, j, k) for i in range(len(words) - k + 1) for j in range(len(item) - k + 1) if words[i:i + k] == item[j:j + k]}


def test_suffix_automaton_finds_every_maximal_match():
    rng = random.Random(3)
    items = [(n, [rng.choice("abcd") for _ in range(12)]) for n in range(6)]
    sam = SuffixAutomaton(items)
    for _ in range(60):
        doc = [rng.choice("abcde") for _ in range(20)]
        got = set()
        for end, state, n in sam.matches(doc, 2):
            for k, at in sam.occurrences(state):
                assert doc[end - n:end] == items[k][1][at - n + 1:at + 1]
                got |= {(k, end - n + i, at - n + 1 + i) for i in range(n)}
        want = {(k, i + x, j + x) for k, (_, it) in enumerate(items) for i, j, m in _runs(doc, it, 2) for x in range(m)}
        longest = {(i) for _, i, _ in got}
        assert {i for _, i, _ in want} == longest  # every position that some item covers is covered


def test_coverage_bridges_small_differences():
    item = normal_words("the quick brown fox jumps over the lazy dog while seven grey geese watch from the quiet river bank at dawn")
    sam = SuffixAutomaton([(1, item)])
    noisy = normal_words("He wrote: THE quick brown fox jumps (p. 34) over the lazy dog while sevn grey geese watch from the qui-\net river bank at dawn. End.")
    runs = sam.runs(noisy, 3, 0.5)
    assert covered(noisy, item, runs[0]) > 0.9
    short = normal_words("the quick brown fox jumps over and nothing else of it")
    assert not sam.runs(short, 3, 0.5).get(0) or covered(short, item, sam.runs(short, 3, 0.5)[0]) < 0.5


def test_trie_automaton_equals_brute_force():
    rng = random.Random(5)
    words = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 7))) for _ in range(120)}
    trie = Trie()
    for w in words:
        trie.add(w)
    for _ in range(60):
        q = "".join(rng.choice("abc") for _ in range(rng.randint(0, 7)))
        for k in (0, 1, 2):
            assert sorted(trie.near(q, k)) == sorted((w, distance(q, w)) for w in words if distance(q, w) <= k)


def test_segments_meet_for_every_pair_in_reach():
    rng = random.Random(8)
    for _ in range(3000):
        a = "".join(rng.choice("abcd") for _ in range(rng.randint(3, 10)))
        b = list(a)
        for _ in range(rng.randint(1, 2)):
            i = rng.randrange(len(b) + 1)
            b = b[:i] + ([rng.choice("abcd")] if rng.random() < 0.5 else []) + b[i + (rng.random() < 0.5):]
        b = "".join(b)
        s, t = sorted((a, b), key=len)
        if len(s) >= 3 and a != b and distance(a, b) <= reach(len(s)):
            members, asked = {k for k, r in _keys(s) if r == 0}, {k for k, r in _keys(t) if r == 1}
            assert members & asked, (a, b)


def test_bk_tree_equals_brute_force():
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdef") for _ in range(rng.randint(1, 9))) for _ in range(200)]
    asked = ["".join(rng.choice("abcdefg") for _ in range(rng.randint(0, 9))) for _ in range(150)]
    got = set(BKTree(words).within(asked, lambda n: 1 + n // 5))
    assert got == {(q, w, distance(q, w)) for q in asked for w in set(words) if distance(q, w) <= 1 + len(q) // 5}
    assert BKTree().within(["a"], lambda n: 2) == []
    long = "x" * 80
    assert BKTree([long]).within([long[:-1]], lambda n: 2) == [(long[:-1], long, 1)]


@pytest.mark.parametrize(
    "raw, stem, lead, level",
    [
        ("Ada Lovelace", "lovelace", "ada", 2), ("LOVELACE, ADA", "lovelace", "ada", 2), ("Prof. A. Lovelace, PhD", "lovelace", "a", 1), ("Lovelace A", "lovelace", "a", 1),
        ("Simone de Beauvoir", "beauvoir", "simone", 2), ("de Beauvoir", "beauvoir", "", 0), ("Tony Hope", "hope", "tony", 2), ("  Ada\xa0 Lovelace (ed.)", "lovelace", "ada", 2),
    ],
)
def test_person_forms(raw, stem, lead, level):
    n = parse_name(raw)
    assert (n.kind, n.stem, n.lead, n.level) == ("person", stem, lead, level)


@pytest.mark.parametrize("raw", [None, "", "  ", "N/A", "et al.", "Various Authors", "the narrator", "...", "123"])
def test_nobody(raw):
    assert parse_name(raw).kind == "none"


def test_organisations_meet_their_acronym():
    full, short = parse_name("The League of Fammandia Guilt & Attention (Research Dept.)"), parse_name("LOFGAA Fammandia")
    assert (full.kind, full.stem, full.lead) == ("org", "fammandia", "league guilt attention")
    assert short.acro in full.acro.split() and short.place == "fammandia"
    assert parse_name("Fammandia Guilt and Attention, League of").lead == full.lead
    assert parse_name("UNESCO").acro == "unesco" and parse_name("ADA LOVELACE").acro == "" and parse_name("Ada Lovelace").acro == ""


def test_open_word_order_has_two_readings():
    n = parse_name("Zoloth Wilhelmina Petra")
    assert (n.stem, n.lead, n.ostem, n.olead) == ("petra", "zoloth", "zoloth", "wilhelmina")
    assert parse_name("Zoloth, Wilhelmina").ostem == "" and parse_name("W. Zoloth").ostem == ""


def test_universal_automaton_equals_the_distance():
    rng = random.Random(8)
    strings = sorted({"".join(rng.choice("abcd") for _ in range(rng.randint(1, 8))) for _ in range(300)})
    trie = Trie()
    for s in strings:
        trie.add(s)
    for k in (1, 2, 3):
        for _ in range(60):
            q = "".join(rng.choice("abcde") for _ in range(rng.randint(0, 9)))
            assert sorted(trie.near(q, k)) == sorted((s, d) for s in strings if (d := distance(s, q)) <= k)
