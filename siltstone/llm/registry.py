"""The queries of this subpackage, by name, and their SQL where SQL can express them."""

from __future__ import annotations

import corpus_pipeline

from . import ann, bpe, chat, exact_dedup, filter_audit, importance, langid, line_dedup, mixing, ngram_join, secrets, sharding, url_filter

QUERIES: dict = {}
ORACLE_SQL: dict = {}

for _module in (ann, bpe, chat, exact_dedup, filter_audit, importance, langid, line_dedup, mixing, ngram_join, secrets, sharding, url_filter):
    QUERIES |= _module.QUERIES
    ORACLE_SQL |= getattr(_module, "ORACLE_SQL", {})

QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    ORACLE_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
