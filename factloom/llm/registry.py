"""Imports every operator's module, which registers its query."""

from factloom.llm import (  # noqa: F401
    byte_pieces,
    exact_dedup,
    hard_negatives,
    imatch,
    language_id,
    line_dedup,
    ngram_join,
    packing,
    phrases,
    sentence_pieces,
    token_counts,
    toxicity,
    url_filter,
)
from factloom.llm.common import ORACLES as oracles
from factloom.llm.common import QUERIES as queries

__all__ = ["oracles", "queries"]
