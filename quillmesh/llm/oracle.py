"""SQL of the training-data queries that SQL can express."""

from __future__ import annotations

from .survivor import FIELDS, PLACEHOLDERS

_TEXT = ("title", "title_without_series", "publisher", "book_format", "isbn", "isbn13", "description", "link", "catalog_source")


def _filled(f: str) -> str:
    if f in _TEXT:
        listed = ", ".join(f"'{p}'" for p in PLACEHOLDERS)
        return (
            f"CASE WHEN {f} IS NOT NULL AND lower(trim({f})) NOT IN ({listed}) "
            f"AND NOT regexp_full_match(trim({f}), '0+') THEN 1 ELSE 0 END"
        )
    if f == "authors":
        return "CASE WHEN len(authors) > 0 THEN 1 ELSE 0 END"
    if f == "publication_year":
        return "CASE WHEN publication_year NOT IN (0, 9999) THEN 1 ELSE 0 END"
    return f"CASE WHEN {f} IS NOT NULL THEN 1 ELSE 0 END"


_P4 = f"""
WITH last AS (
  SELECT * FROM book_metadata WHERE work_id IS NOT NULL AND book_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY book_id ORDER BY ingested_at DESC) = 1
), scored AS (
  SELECT work_id, book_id, {" + ".join(_filled(f) for f in FIELDS)} AS c,
         coalesce(epoch_us(updated_at), -9000000000000000000) AS t, coalesce(ratings_count, -1) AS r
  FROM last
)
SELECT a.work_id, a.book_id FROM scored a JOIN scored b ON a.work_id = b.work_id AND a.book_id <> b.book_id
GROUP BY a.work_id, a.book_id
HAVING bool_and(a.c > b.c AND a.t > b.t AND a.r > b.r)
"""


def oracle_sql() -> dict[str, str]:
    return {"p4_found": _P4}
