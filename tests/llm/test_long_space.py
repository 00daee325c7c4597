"""Runs of white space above a million characters, on which the rank-based encoder panics."""

from __future__ import annotations

import pytest

from chronoweave.llm import packing, queries


@pytest.mark.parametrize("text", [" " * 1_000_001 + "a", "a" + "\n" * 1_000_001, "a" + " \t\r\n" * 260_000 + "b"])
def test_long_space(text):
    from tokenizers import Tokenizer

    want = Tokenizer.from_file(queries.vocabulary()).encode(text, add_special_tokens=False).ids
    ranked = packing.ranks_of(queries.vocabulary())
    assert ranked and packing.encoder(queries.vocabulary(), ranked)(text) == want


def test_which_space_is_long():
    n = packing.LONG_SPACE
    assert packing.has_long_space("a" + " " * n) and packing.has_long_space(" " * n + "a")
    assert not packing.has_long_space("a " * n) and not packing.has_long_space(" " * (n - 1) + "a" + " " * (n - 1))
