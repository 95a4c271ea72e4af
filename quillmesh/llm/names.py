"""Names as people type them: one parse for persons and organisations.

``parse_name`` gives a :class:`Name` with a *stem* (the surname of a person, the
distinguishing word of an organisation) and a *lead* (given name, or type and
topics).  What the form does not settle is left open and settled from the corpus
by :mod:`variants`: the word order ("Cojal Viggo"), whether capitals are an
acronym, and which given names are short for one another.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from .common import fold

# Fixed values -------------------------------------------------------------
#: Values that name nobody in particular.
NOBODY = frozenset(
    "anonymous|anon|unknown|unknown author|author unknown|n a|na|none|null|various|various authors|various artists|"
    "multiple authors|et al|and others|others|editors|the editors|editor|staff|speaker|the speaker|narrator|the narrator|"
    "the author|author|the authors|authors|ancient philosophers|the ancients|philosophers|the philosophers|scholars|critics|the poet|"
    "a poet|someone|somebody|nobody|no author|not available|not provided|unnamed|tba|tbd|traditional|folk|ibid|"
    "idem|several authors|several|many|unbekannt|anonyme|anonimo|desconocido|inconnu|diverse|collective|the press|reader|readers|"
    "the reader|historians|scientists|economists|poets|writers|ancient writers|ancient authors|early christians|the greeks|the romans".split("|")
)
HONORIFICS = frozenset("sir dame lord lady dr doctor prof professor mr mrs ms miss mx rev reverend fr hon judge capt captain col gen st saint herr frau mme mlle don dona".split())
SUFFIXES = frozenset("jr sr esq esquire phd md ma ba msc dphil ii iii iv ed eds editor editors trans transl translator obe cbe kbe mbe frs".split())
PARTICLES = frozenset("van der den de la le di da du del della dello dei von zu zum zur al el ter ten bin ibn ap af av dos das do los las".split())
ORG_TYPES = {
    short: full
    for full, shorts in {
        "academy": "academy acad", "association": "association assoc assn ass", "society": "society soc", "committee": "committee comm cttee cmte",
        "institute": "institute inst institution", "centre": "centre center ctr cent", "council": "council counc coun cncl", "league": "league lge lg leag",
        "university": "university univ", "college": "college coll", "department": "department dept", "foundation": "foundation found fdn", "union": "union", "guild": "guild", "museum": "museum mus",
        "library": "library libr", "bureau": "bureau bur", "board": "board", "office": "office", "commission": "commission", "federation": "federation fed", "group": "group", "ministry": "ministry min",
    }.items()
    for short in shorts.split()
}
_ORG_LINK = frozenset("of for on in the".split())
# ---------------------------------------------------------------------------

_TOKEN = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")
_SPACE = re.compile(r"[\s​﻿]+")


#: Letter groups that are heard alike.
SOUND = (("ee", "i"), ("ph", "f"), ("kw", "qu"), ("ck", "k"), ("tsch", "ch"), ("sch", "sh"))
_TWICE = re.compile(r"(.)\1+")


def sound(stem: str) -> str:
    """A surname with letter groups that are heard alike written alike."""
    for group, alike in SOUND:
        stem = stem.replace(group, alike)
    return _TWICE.sub(r"\1", stem)


class Name(NamedTuple):
    kind: str  # none, person, org
    stem: str  # surname, or the word that sets an organisation apart
    lead: str  # given name or initial, or type and topics
    level: int  # 2 full lead, 1 initial, 0 no lead
    ostem: str  # stem and lead of the other reading, if the word order is open
    olead: str
    shape: str  # folded spelling without punctuation
    acro: str  # letters that may be an organisation's initials; of an organisation the initials it may have
    place: str  # word beside such letters


NONE = Name("none", "", "", 0, "", "", "", "", "")


def _plain(token: str) -> str:
    return token.replace("'", "").replace("’", "")


def _org(tokens: list[str], shape: str) -> Name | None:
    """Tokens of an organisation's name, type first."""
    at = next((i for i, t in enumerate(tokens) if t in ORG_TYPES), None)
    if at is None:
        return None
    named = tokens[at:]
    rest = [t for t in named[1:] if t not in _ORG_LINK]
    if len(rest) < 2:
        return None
    # Initials with and without the linking words.
    initials = {"".join(t[0] for t in named), "".join(t[0] for t in named if t not in _ORG_LINK and t != "and")}
    return Name("org", rest[0], " ".join([ORG_TYPES[named[0]], *[t for t in rest[1:] if t != "and"]]), 2, "", "", shape, " ".join(sorted(initials)), "")


#: Letters of an acronym: any run of capitals of this length.  Whether it stands for an
#: organisation is settled by the organisations that the corpus writes out.
_ACRONYM = re.compile(r"([A-Z]{3,12})(?:,?\s+\(?([^\W\d_][^()\s,]*)\)?)?")


def _letters(text: str) -> tuple[str, str]:
    """(letters, place) where ``text`` is a run of capitals, maybe beside one word that isn't."""
    m = _ACRONYM.fullmatch(text)
    if not m or m.group(2) and (m.group(2).isupper() or not m.group(2)[0].isupper()):
        return "", ""
    return m.group(1).lower(), _plain(fold(m.group(2) or ""))


def parse_name(raw: str | None) -> Name:
    """The parts of a typed name; kind ``none`` for values that name nobody."""
    if raw is None:
        return NONE
    text = _SPACE.sub(" ", raw.replace("\xa0", " ")).strip(" \"“”„«»'‘’")
    low = fold(text).replace("&", " and ")
    shape = " ".join(_TOKEN.findall(low))
    if not shape or shape in NOBODY or not any(c.isalpha() for c in shape):
        return NONE
    acro, place = _letters(text)
    # Remarks in brackets: "(ed.)", "(Research Dept.)".
    low = re.sub(r"[(\[][^)\]]*[)\]]", " ", low)
    # The place of an organisation first: "... and Sleep, League of".
    parts = [p.strip() for p in low.split(",")]
    parts = [p for p in parts if p]
    while len(parts) > 1 and all(t in SUFFIXES or t == "est" for t in _TOKEN.findall(parts[-1].replace(".", ""))):
        parts.pop()
    if not parts:
        return NONE
    tokens_by_part = [[_plain(t) for t in _TOKEN.findall(p)] for p in parts]
    flat = [t for p in tokens_by_part for t in p]
    if any(t in ORG_TYPES for t in flat):
        ordered = tokens_by_part
        if len(parts) == 2 and not any(t in ORG_TYPES for t in tokens_by_part[0]):
            ordered = [tokens_by_part[1], tokens_by_part[0]]
        org = _org([t for p in ordered for t in p if t != "est"], shape)
        if org is not None:
            return org

    def clean(tokens: list[str]) -> list[str]:
        while len(tokens) > 1 and tokens[0] in HONORIFICS:
            tokens = tokens[1:]
        while len(tokens) > 1 and tokens[-1] in SUFFIXES:
            tokens = tokens[:-1]
        return tokens

    def person(stem: list[str], lead: list[str], other: list[str] | None = None) -> Name:
        s = "".join(stem)
        if not s:
            return NONE
        first = next((t for t in lead if t not in PARTICLES), "")
        level = 0 if not first else 1 if len(first) == 1 else 2
        o = other if other and level == 2 and len(other[1]) > 1 else ["", ""]
        return Name("person", sound(s), first, level, sound(o[0]), o[1], shape, acro, place)

    if len(parts) >= 2:
        stem = [t for t in clean(tokens_by_part[0]) if t not in PARTICLES]
        lead = clean([t for p in tokens_by_part[1:] for t in p])
        if stem and len(stem[-1]) > 1:
            return person(stem[-1:], lead)
    tokens = clean(flat)
    if not tokens:
        return NONE
    particle = [i for i, t in enumerate(tokens) if t in PARTICLES and 0 <= i < len(tokens) - 1]
    if particle and particle[0] > 0:
        return person([tokens[particle[-1] + 1]], tokens[: particle[0]])
    if particle:  # the surname comes first
        rest = tokens[particle[-1] + 1:] if particle == list(range(len(particle))) else tokens[1:]
        rest = [t for t in rest if t not in PARTICLES]
        return person(rest[:1], rest[1:])
    if len(tokens) == 1:
        return person(tokens, []) if len(tokens[0]) > 1 else NONE
    if len(tokens[-1]) == 1 and len(tokens[0]) > 1:  # "Kanis F"
        return person(tokens[:1], tokens[1:])
    if len(tokens[-1]) == 1:
        return NONE
    if len(tokens[0]) == 1:
        return person(tokens[-1:], tokens[:-1])
    return person(tokens[-1:], tokens[:-1], other=[tokens[0], tokens[1]])
