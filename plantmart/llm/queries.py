"""All queries of this folder, and the pipeline."""

from __future__ import annotations

import corpus_pipeline

from . import (  # noqa: F401
    bpe,
    divergence,
    exact_dedup,
    jaccard,
    language_model,
    licenses,
    line_quality,
    packing,
    page_text,
    quality_rules,
    spelling,
    topk,
    toxicity,
)
from .registry import QUERIES, SQL

QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL

__all__ = ["QUERIES", "SQL"]
