"""Every query of this subpackage: importing the operators registers them."""

from __future__ import annotations

from starloom.llm import conversation_repair, fingerprints, hard_negatives, langid, ngram_join, packing, pieces, quality, quotations, suffix_tree_lm, toxicity, vector_dups, warc  # noqa: F401
from starloom.llm.registry import ORACLES, QUERIES  # noqa: F401
