"""Sentences, budgeted chunks, prompts and the extraction stage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import PipelineConfig
from ..functions.text import squeeze


def sentences(text: Column) -> Column:
    """Trimmed sentences of a text: cut after ``. ! ?`` and white space."""
    marked = F.regexp_replace(text, r"([.!?])\s+", "$1\x01")
    return F.filter(F.transform(F.split(marked, "\x01"), lambda s: F.trim(s)), lambda s: s != "")


def chunk_by_count(sents: DataFrame, size: int) -> DataFrame:
    """``(doc, chunk_index, start_sentence, end_sentence)`` of ``size`` sentences each."""
    n = F.size("sentences")
    idx = F.explode(F.sequence(F.lit(0), F.floor((n - 1) / size).cast("int")))
    return sents.where(n > 0).select("doc", n.alias("n"), idx.alias("chunk_index")).select(
        "doc", "chunk_index", (F.col("chunk_index") * size + 1).alias("start_sentence"), F.least((F.col("chunk_index") + 1) * size, F.col("n")).alias("end_sentence")
    )


def default_tokens(sents: list[str]) -> int:
    """Tokens of a prompt by the four-letters rule."""
    return sum(len(s) + 1 for s in sents) // 4 + 1


def prompt_tokens(prompt: Column) -> Column:
    """Tokens of a rendered prompt by the four-letters rule."""
    return (F.floor(F.length(prompt) / 4) + 1).cast("int")


def budget_chunks(sents: list[str], size: int, config: PipelineConfig, count: Callable[[list[str]], int] = default_tokens) -> list[tuple[int, int, int]]:
    """``(index, start, end)``, 1-based inclusive: chunks within the character and token budgets."""
    room = config.max_context - config.max_completion
    chars = room * config.chars_per_token
    out, at = [], 0
    while at < len(sents):
        used, end = 0, at
        while end < len(sents) and (not size or end - at < size):
            cost = len(sents[end]) + 1
            if end > at and used + cost > chars:
                break
            used, end = used + cost, end + 1
            if used >= chars:
                break
        while end - at > 1 and count(sents[at:end]) > room:
            end -= 1
        if end - at == 1 and count(sents[at:end]) > room:
            at += 1  # a sentence that fits nowhere is left out
            continue
        out.append((len(out), at + 1, end))
        at = end
    return out


def chunk_by_budget(sents: DataFrame, config: PipelineConfig = PipelineConfig(), count: Callable[[list[str]], int] = default_tokens) -> DataFrame:
    """``(doc, chunk_index, start_sentence, end_sentence)`` under the token budget."""
    kind = dict(sents.dtypes)["doc"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(d, *c) for d, s in zip(pdf["doc"], pdf["sentences"]) for c in budget_chunks(list(s), config.chunk_size, config, count)]
            yield pd.DataFrame(rows, columns=["doc", "chunk_index", "start_sentence", "end_sentence"])

    return sents.select("doc", "sentences").mapInPandas(run, f"doc {kind}, chunk_index int, start_sentence int, end_sentence int")


def render(template: str, **values: Column) -> Column:
    """A prompt with ``{{name}}`` replaced by columns."""
    out = F.lit(template)
    for name, c in values.items():
        out = F.replace(out, F.lit("{{" + name + "}}"), c)
    return out


Extractor = Callable[[str], list[dict]]


def regex_extractor(excerpt: str) -> list[dict]:
    """Deterministic default: capitalised names before 'wrote', 'argued' and the like, with quoted titles."""
    import re

    found = []
    for m in re.finditer(r"((?:[A-Z][\w'’-]+ ){1,3}[A-Z][\w'’-]+) (?:wrote|argued|claimed|noted|observed)(?: in [\"“]([^\"”]+)[\"”])?", excerpt):
        author = re.sub(r"^(?:As|When|While|If|Once|Where|Here|Later|Then) ", "", m.group(1))
        found.append({"title": m.group(2), "author": author, "citation_excerpt": m.group(0), "commentary": ""})
    return found


def extract(chunks: DataFrame, extractor: Extractor = regex_extractor, attempts: int = 3) -> DataFrame:
    """Extraction rows of ``(doc, chunk_index, start_sentence, end_sentence, excerpt)``.

    One row per citation with ``status`` ok and ``mention``, its place in the chunk; a chunk whose provider fails every
    attempt gives one row with ``status`` failed and the error.
    """
    kind = dict(chunks.dtypes)["doc"]
    schema = f"doc {kind}, chunk_index int, start_sentence int, end_sentence int, status string, error string, title string, author string, citation_excerpt string, commentary string, mention int"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cols = [c.split()[0] for c in schema.split(", ")]
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                head, error, got = (r.doc, r.chunk_index, r.start_sentence, r.end_sentence), None, None
                for _ in range(attempts):
                    try:
                        got, error = extractor(r.excerpt), None
                        break
                    except Exception as e:  # a provider may raise anything
                        error = str(e)
                if error is not None:
                    rows.append((*head, "failed", error, None, None, None, None, None))
                for no, c in enumerate(got or []):
                    rows.append((*head, "ok", None, c.get("title"), c["author"], c["citation_excerpt"], c["commentary"], no))
            out = pd.DataFrame(rows, columns=cols)
            yield out.assign(mention=out["mention"].astype("Int32"))

    return chunks.mapInPandas(run, schema)


def excerpts(sents: DataFrame, chunks: DataFrame) -> DataFrame:
    """Chunks with their sentences, squeezed, one a line."""
    return chunks.join(sents, "doc").withColumn(
        "excerpt", F.array_join(F.transform(F.slice("sentences", F.col("start_sentence"), F.col("end_sentence") - F.col("start_sentence") + 1), squeeze), "\n")
    ).drop("sentences")
