"""Registered queries of the operators of this package, by name."""

from __future__ import annotations

from tickvault.llm import (q_bpe, q_contamination, q_embedding, q_fim, q_html, q_jaccard, q_language, q_licence, q_merkle, q_mixing,
                           q_quality, q_substring, q_toxicity)

MODULES = (q_mixing, q_substring, q_jaccard, q_contamination, q_quality, q_embedding, q_licence, q_html, q_toxicity, q_language,
           q_merkle, q_bpe, q_fim)


def queries() -> dict:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
