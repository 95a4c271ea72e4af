"""Keys of work titles as cited."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _accents() -> tuple[str, str]:
    """Latin letters with marks and their base letters, by Unicode decomposition."""
    src, dst = [], []
    for code in range(0xC0, 0x250):
        base = unicodedata.normalize("NFD", chr(code))[0]
        if base != chr(code) and base.isascii():
            src.append(chr(code))
            dst.append(base)
    return "".join(src), "".join(dst)


_FROM, _TO = _accents()
#: Articles of the languages in use.
ARTICLES = "the|a|an|el|la|los|las|le|les|un|une|una|der|die|das|ein|eine|il|lo|gli|i"


def plain(c: Column) -> Column:
    """Lower case, accents of Latin letters removed."""
    return F.lower(F.translate(c, _FROM, _TO))


def title_key(c: Column) -> Column:
    """Main title without subtitle, series, brackets, article, case and marks.

    Null where nothing is left, so that blank titles are no evidence.
    """
    # Every step names the one before it once: the tree grows by a node a step.
    t = F.regexp_replace(plain(c), r"[\(\[\{][^\)\]\}]*[\)\]\}]", " ")
    t = F.regexp_replace(t, r"(?:\s+[-–—]+\s+|\s*[:;]\s+).*$", "")
    t = F.regexp_replace(t, r"[\p{Z}\s]+", " ")
    t = F.replace(t, F.lit("&"), F.lit(" and "))
    # Edition and volume remarks, "etc."
    remark = r"[ ,]+(?:(?:new|rev\.?|revised|first|second|third|[0-9]+(?:st|nd|rd|th))? ?(?:ed\.|edn\.?|edition)|vol\.? ?[0-9ivx]+|volume [0-9ivx]+|etc\.?)[^a-z0-9]*$"
    t = F.regexp_replace(t, remark, "")
    t = F.regexp_replace(t, rf"^[^a-z0-9]*(.*?),\s*(?:{ARTICLES})[^a-z0-9]*$", "$1")
    t = F.regexp_replace(t, r"[^\p{L}\p{N}]+", " ")
    return F.nullif(F.trim(F.regexp_replace(t, rf"^ ?(?:{ARTICLES}) ", "")), F.lit(""))
