"""Operators of a training-data pipeline. Nothing else in the library imports this package."""

from __future__ import annotations

from collections.abc import Callable

from tillhouse.llm import (
    bpe,
    decontamination,
    hard_negatives,
    html_text,
    lm_score,
    minhash,
    neighbours,
    personal_data,
    suffix_dedup,
    token_counts,
    toxicity,
    url_filter,
    variants,
)

_MODULES = (
    neighbours,
    bpe,
    lm_score,
    toxicity,
    suffix_dedup,
    token_counts,
    url_filter,
    decontamination,
    html_text,
    minhash,
    hard_negatives,
    personal_data,
    variants,
)


def queries() -> dict[str, Callable]:
    return {name: query for module in _MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in _MODULES for name, sql in getattr(module, "ORACLE_SQL", {}).items()}
