"""Mentions keep their own ids."""

from quillmesh.engine import mention_id
from quillmesh.operators import chunking as C


def test_mentions_of_a_chunk_have_distinct_ids(spark):
    chunks = spark.createDataFrame([("a", i, 1, 1, "x") for i in range(2)] + [("b", 0, 1, 1, "bad")], "doc string, chunk_index int, start_sentence int, end_sentence int, excerpt string")

    def many(text):
        if text == "bad":
            raise ValueError("no")
        return [{"title": f"T{i}", "author": "A", "citation_excerpt": "", "commentary": ""} for i in range(300)] * 2

    found = C.extract(chunks, many)
    ids = [r[0] for r in found.where("status = 'ok'").select(mention_id()).collect()]
    assert len(ids) == len(set(ids)) == 2 * 600 and max(ids) == 2**32 + 599
    assert [(r["status"], r["mention"]) for r in found.where("doc = 'b'").collect()] == [("failed", None)]
