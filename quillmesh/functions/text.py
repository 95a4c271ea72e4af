"""Normalisers of titles and names as Column expressions.

Every function takes a column and returns a column; null in, null out unless
said otherwise.  They stay inside whole-stage code generation; none needs Python.
"""

from __future__ import annotations

import unicodedata
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _accent_table() -> tuple[str, str]:
    """Latin letters with marks and their base letters, by canonical decomposition."""
    marked = [(chr(c), unicodedata.normalize("NFD", chr(c))[0]) for c in range(0xC0, 0x250)]
    marked += [(chr(c), unicodedata.normalize("NFD", chr(c))[0]) for c in range(0x1E00, 0x1F00)]
    pairs = [(a, b) for a, b in marked if a != b and b.isascii()]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


_ACCENTED, _BASE = _accent_table()


def strip_accents(c: Column) -> Column:
    """Latin accents removed; loose combining marks dropped."""
    return F.regexp_replace(F.translate(c, _ACCENTED, _BASE), r"\p{Mn}+", "")


def squeeze(c: Column) -> Column:
    """Runs of white space become one blank, ends trimmed."""
    return F.trim(F.regexp_replace(c, r"[\s\p{Z}]+", " "))


def casefold(c: Column) -> Column:
    """Lower case; sharp s spelt out, as case folding does."""
    return F.replace(F.lower(c), F.lit("ß"), F.lit("ss"))


def normalize_text(c: Column) -> Column:
    """White space squeezed, case folded."""
    return casefold(squeeze(c))


def main_title(c: Column) -> Column:
    """Folded title before the first of ``: - _ ( [``, other marks as blanks."""
    head = F.regexp_extract(casefold(F.trim(c)), r"^[^:\-_(\[]*", 0)
    return F.trim(F.regexp_replace(head, r"[^a-z0-9]+", " "))


def author_key(c: Column, saint: bool = True) -> Column:
    """Author without accents, case, full stops and commas; a leading saint dropped."""
    key = squeeze(F.regexp_replace(F.lower(strip_accents(c)), r"[.,]", ""))
    if not saint:
        return key
    for prefix in ("st ", "saint "):
        key = F.regexp_replace(key, f"^{prefix}", "")
    return key


#: Words tried in this order, each once, at the start of a title.
TITLE_PREFIXES = ("the", "a", "an", "de", "on", "les", "la", "le", "il", "el")


def article_title(c: Column) -> Column:
    """Lower-case title, each leading word of :data:`TITLE_PREFIXES` tried once in order, marks dropped."""
    t = reduce(lambda x, w: F.regexp_replace(x, f"^{w} ", ""), TITLE_PREFIXES, F.trim(F.lower(c)))
    return squeeze(F.regexp_replace(t, r"[^\p{L}\p{N}_\s]", ""))


#: Articles of which the viewer drops one.
VIEWER_ARTICLES = ("the", "a", "an", "la", "le", "les", "el", "los", "las", "der", "die", "das")


def viewer_title(c: Column) -> Column:
    """Title key of the graph: accents and one article dropped, quotes unified."""
    t = F.lower(strip_accents(c))
    t = F.regexp_replace(t, rf"^(?:{'|'.join(VIEWER_ARTICLES)})\s+", "")
    t = F.regexp_replace(F.regexp_replace(t, "[‘’]", "'"), "[“”]", '"')
    return squeeze(t)


def viewer_author(c: Column) -> Column:
    """'Last, First' turned round (text after a second comma is lost); empty is 'Unknown'."""
    parts = F.split(c, ",")
    turned = F.concat_ws(" ", F.trim(F.get(parts, 1)), F.trim(F.get(parts, 0)))
    return F.when(c.isNull() | (c == ""), F.lit("Unknown")).when(c.contains(","), squeeze(turned)).otherwise(squeeze(c))


def swapped_author(c: Column) -> Column:
    """'Last, First' turned round, everything after the first comma kept."""
    turned = F.concat_ws(" ", F.trim(F.regexp_extract(c, r"^([^,]*),(.*)$", 2)), F.trim(F.regexp_extract(c, r"^([^,]*),(.*)$", 1)))
    return F.when(c.contains(","), squeeze(turned)).otherwise(squeeze(c))


def slug(c: Column) -> Column:
    """Lower case, every run of other characters an underscore, ends trimmed."""
    return F.btrim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "_"), F.lit("_"))


def title_case(c: Column) -> Column:
    """A capital after every character that is no letter, small letters else."""
    chars = F.split(F.lower(c), "")
    lifted = F.transform(chars, lambda x, i: F.when((i == 0) | ~F.get(chars, i - 1).rlike(r"\p{L}"), F.upper(x)).otherwise(x))
    return F.array_join(lifted, "")


def web_id(title: Column, year: Column) -> Column:
    """Id of a work known from the web only: a hash of title and year."""
    text = F.concat(F.coalesce(title, F.lit("")), F.coalesce(year.cast("string"), F.lit("")))
    return F.concat(F.lit("web_"), F.substring(F.md5(text), 1, 8))


def is_real_id(c: Column) -> Column:
    """An id of the catalogue, not one made from the web."""
    return c.isNotNull() & ~c.startswith("web_")


def token_sort(c: Column) -> Column:
    """Lower-case words in alphabetical order."""
    words = F.filter(F.split(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}_]+", " "), " "), lambda w: w != "")
    return F.array_join(F.array_sort(words), " ")


def contains_either(a: Column, b: Column) -> Column:
    """One of two strings contains the other."""
    return a.contains(b) | b.contains(a)


def name_score(a: Column, b: Column) -> Column:
    """3 equal, 2 a prefix, 1 contained, 0 else, whichever way round."""
    return F.when(a == b, 3).when(a.startswith(b) | b.startswith(a), 2).when(contains_either(a, b), 1).otherwise(0)


def the_author(text: Column, author: Column) -> Column:
    """'the author' replaced by the name of the source's author."""
    marked = F.regexp_replace(text, r"\b[Tt]he author\b", "\x01")
    return F.replace(marked, F.lit("\x01"), author)


def strip_marks(c: Column) -> Column:
    """Citation marks such as ``[12]`` dropped."""
    return F.regexp_replace(c, r"\[[\d\w]+\]", "")


def unfence(c: Column) -> Column:
    """Text inside a Markdown fence: the first and last fence lines dropped."""
    fence = "`" * 3
    body = F.regexp_replace(F.trim(c), rf"^{fence}[^\n]*\n?", "")
    return F.trim(F.regexp_replace(body, rf"\s*{fence}\s*$", ""))


# -- parts of names and titles that query expansion uses -----------------------

#: Fixed values, tried in this order.
SUBTITLE_MARKS = (": ", " — ", " – ", " - ")
LEADING_ARTICLES = (
    "the ", "a ", "an ", "le ", "la ", "les ", "l'", "un ", "une ", "der ", "die ", "das ", "ein ", "eine ", "el ", "los ", "las ",
    "il ", "lo ", "i ", "gli ", "o ", "os ", "as ",
)
NAME_PARTICLES = ("von ", "de ", "la ", "van ", "du ", "di ", "del ", "della ", "al-", "ibn ")


def _first_of(*options: tuple[Column, Column]) -> Column:
    out = F.lit(None).cast("string")
    for cond, value in reversed(options):
        out = F.when(cond, value).otherwise(out)
    return out


def without_subtitle(t: Column) -> Column:
    """The title before the first listed mark found in it, else null."""
    return _first_of(*[(F.instr(t, m) > 1, F.trim(F.substring_index(t, m, 1))) for m in SUBTITLE_MARKS])


def without_article(t: Column) -> Column:
    """The title without the first listed article it starts with, else null."""
    low = F.lower(t)
    cut = _first_of(*[(low.startswith(a), F.trim(F.substring(t, len(a) + 1, 1_000_000))) for a in LEADING_ARTICLES])
    return F.nullif(cut, F.lit(""))


def last_name(a: Column) -> Column:
    """The last of two or more words, else null."""
    words = F.split(squeeze(a), " ")
    return F.when(F.size(words) >= 2, F.element_at(words, -1))


def uncomma(a: Column) -> Column:
    """'Last, First' as 'First Last'; null without a comma or with an empty side."""
    last, first = squeeze(F.regexp_extract(a, r"^([^,]*),(.*)$", 1)), squeeze(F.regexp_extract(a, r"^([^,]*),(.*)$", 2))
    return F.when(a.contains(",") & (last != "") & (first != ""), F.concat_ws(" ", first, last))


def without_particle(a: Column) -> Column:
    """The name without the first listed particle inside it, else at its start; null without any."""
    low = F.lower(a)
    inside = [
        (F.instr(low, " " + p) > 0, F.concat(F.substring(a, F.lit(1), F.instr(low, " " + p)), F.substring(a, F.instr(low, " " + p) + len(p) + 1, F.length(a))))
        for p in NAME_PARTICLES
    ]
    ahead = [(low.startswith(p), F.substring(a, F.lit(len(p) + 1), F.length(a))) for p in NAME_PARTICLES]
    return F.nullif(squeeze(_first_of(*inside, *ahead)), F.lit(""))


# -- people pages ----------------------------------------------------------------

#: Nationalities, looked for in this order.
NATIONALITIES = (
    "German", "French", "English", "British", "Russian", "Italian", "American", "Greek", "Roman", "Spanish", "Austrian", "Polish", "Dutch", "Swiss",
    "Japanese", "Chinese", "Irish", "Scottish", "Czech", "Swedish", "Norwegian", "Danish", "Hungarian", "Portuguese", "Indian", "Persian", "Turkish",
    "Belgian", "Finnish", "Romanian", "Canadian", "Australian", "Argentine", "Brazilian", "Mexican", "Colombian", "Egyptian", "Korean", "Arab",
)
#: Occupations that make a person relevant.
OCCUPATIONS = ("writer", "author", "novelist", "poet", "journalist", "screenwriter", "scientist", "biologist", "philosopher", "mathematician", "historian")


def first_listed(c: Column, words: tuple[str, ...]) -> Column:
    """The first of ``words`` that ``c`` contains."""
    return F.get(F.filter(F.array(*[F.lit(w) for w in words]), lambda w: c.contains(w)), 0)


def nationality(stated: Column, categories: Column) -> Column:
    """The stated nationality, else the one that the first telling category names."""
    told = F.filter(F.transform(categories, lambda c: first_listed(c, NATIONALITIES)), lambda n: n.isNotNull())
    return F.coalesce(F.nullif(stated, F.lit("")), F.get(told, 0))


def relevant_person(infoboxes: Column, categories: Column) -> Column:
    """An occupation of :data:`OCCUPATIONS` stands in a box or category."""
    empty = F.array().cast("array<string>")
    return F.lower(F.concat_ws(" ", F.coalesce(infoboxes, empty), F.coalesce(categories, empty))).rlike("|".join(OCCUPATIONS))


# -- answers of providers -----------------------------------------------------------


def salvage_json(c: Column) -> Column:
    """JSON text of an answer: as it is, else its fenced part, else its outermost braces, else an error.

    Empty answers are ``{}``; tool calls pass unchanged.
    """
    s = F.regexp_replace(c, r"^\s+|\s+$", "")
    fence = "`" * 3
    valid = lambda t: F.when(F.try_parse_json(t).isNotNull(), t)
    inside = lambda pattern: F.nullif(F.regexp_extract(s, pattern, 1), F.lit(""))
    error = F.to_json(F.struct(F.lit("UNPARSEABLE").alias("result"), s.alias("raw_response")))
    return F.when(s == "", "{}").when(s.startswith("<tool_call>"), s).otherwise(
        F.coalesce(valid(s), valid(inside(rf"(?s){fence}json\s*(\{{.*?\}})\s*{fence}")), valid(inside(r"(?s)(\{.*\})")), error)
    )


#: Words that show what a fact line is about; the first rule that fits counts.
PERSON_LINES = ((("born",), "born"), (("died",), "died"), (("birth_date",), "born"), (("death_date",), "died"))
BOOK_LINES = ((("published", "publication date", "release date", "first published"), "published"), (("author",), "author"), (("publisher",), "publisher"))


def fact_lines(c: Column, rules: tuple[tuple[tuple[str, ...], str], ...]) -> Column:
    """Struct of facts of ``key: value`` lines; the last line of a fact counts."""

    def kind(line: Column) -> Column:
        out = F.lit(None).cast("string")
        for words, name in reversed(rules):
            out = F.when(F.lower(line).rlike("|".join(words)), name).otherwise(out)
        return out

    marked = F.transform(F.split(c, "\n"), lambda x: F.struct(kind(x).alias("k"), F.when(x.contains(":"), F.trim(F.regexp_extract(x, r"^[^:]*:(.*)$", 1))).otherwise(x).alias("v")))
    names = list(dict.fromkeys(n for _, n in rules))

    def last(name: str) -> Column:
        return F.try_element_at(F.filter(marked, lambda m: m["k"] == name), F.lit(-1))["v"].alias(name)

    return F.struct(*[last(n) for n in names])


def prompt_fields(c: Column) -> Column:
    """``struct<title, author>`` of a prompt's ``Book title:`` and ``Author:`` lines, the last of each."""
    lines = F.split(c, "\n")

    def last(word: str) -> Column:
        hit = F.try_element_at(F.filter(lines, lambda x: F.lower(x).startswith(word) & x.contains(":")), F.lit(-1))
        return F.trim(F.regexp_extract(hit, r"^[^:]*:(.*)$", 1))

    return F.struct(F.btrim(last("book title"), F.lit('"')).alias("title"), last("author").alias("author"))


def id_list(c: Column) -> Column:
    """Ids of an allow-list separated by commas or blanks."""
    return F.filter(F.split(F.trim(F.replace(c, F.lit(","), F.lit(" "))), r"\s+"), lambda x: x != "")
