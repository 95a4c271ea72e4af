"""Messages count whatever ordinary words they hold."""

import pytest

from quillmesh.llm.residue import residue_kind


@pytest.mark.parametrize("text, want", [
    ("Page not found: the essay you asked for", "error"), ("Sorry, this treatise cannot be displayed, something went wrong.", "error"), ("Your browser does not support scripting, which this treatise needs.", "script"),
    ("Shelf mark 404 was not found missing.", None), ("She taught scripting to printers.", None),
    ("The old novelist told her readers at length, in the last of many letters from the coast, how your browser has disabled JavaScript became a proverb among all the clerks of the town.", None),
])
def test_context(text, want):
    assert residue_kind(text) == want
