"""The operators of this package as queries on the test tables."""

from tidemark.llm import conversations, forest, hard_negatives, language, language_model, licenses, mixing, near_duplicates, packing, personal, quality, repeated_spans, token_counts

_MODULES = (conversations, forest, hard_negatives, language, language_model, licenses, mixing, near_duplicates, packing, personal, quality, repeated_spans, token_counts)

QUERIES = {name: run for module in _MODULES for name, run in module.QUERIES.items()}
ORACLES = {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
