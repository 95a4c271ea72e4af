"""Schemas of the documents that the pipeline stages exchange."""

BOOK_CITATION = "title string, author string, citation_excerpt string, commentary string"
RAW_DOCUMENT = (
    "source_path string, model string, chunk_size int, total_sentences int, "
    f"chunks array<struct<chunk_index: int, start_sentence: int, end_sentence: int, citations: array<struct<title: string, author: string, citation_excerpt: string, commentary: string>>>>, "
    "failures array<struct<chunk_index: int, start_sentence: int, end_sentence: int, error: string, raw_response: string>>"
)
WORKING_CITATION = "title string, author string, note string, count int, contexts array<string>, commentaries array<string>, canonical_author string"
PREPROCESSED = "source string, total int, citations array<struct<title: string, author: string, note: string, count: int, contexts: array<string>, commentaries: array<string>, canonical_author: string>>"
DECISION = "book_id string, batch int, index int, status string, reason string, fixed_author string, fixed_title string"
CATALOG_BOOK = (
    "book_id bigint, work_id string, title string, title_without_series string, authors array<struct<author_id: bigint, name: string>>, "
    "publication_year int, publication_month int, publication_day int, publisher string, num_pages int, format string, isbn string, isbn13 string, "
    "average_rating double, ratings_count bigint, text_reviews_count bigint, description string, link string"
)
CATALOG_AUTHOR = "author_id bigint, name string, average_rating double, works_count bigint, fans_count bigint, link string"
PERSON_PAGE = "title string, page_id bigint, rev_id bigint, categories array<string>, infoboxes array<string>, birth_year int, death_year int"
