"""Operators for corpora of training data, and their queries."""

from countertide.llm import (  # noqa: F401
    cotraining,
    decontaminate,
    host_quality,
    html_text,
    importance,
    jaccard_join,
    licences,
    packing,
    private_terms,
    sentencepiece_bpe,
    trie_counts,
    warc_zstd,
    whitening,
)
from countertide.llm.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
