"""Operators for preparing training text, and their registered queries.

Nothing else in the library imports this package.
"""

from __future__ import annotations

import functools
import importlib

from curbflow.llm.shipping import ship

_MODULES = ["token_counts", "toxicity", "embedding_dedup", "line_dedup", "packing", "decontam", "quality", "pii", "substring_dedup", "minhash", "piece_tokens", "source_audit", "vector_codes"]


def queries():
    """One query for each operator."""
    found = {}
    for name in _MODULES:
        module = importlib.import_module(f"curbflow.llm.{name}")
        found |= {k: _shipped(v) for k, v in vars(module).items() if k.startswith("op") and k[2].isdigit()}
    return found


def _shipped(query):
    @functools.wraps(query)
    def run(spark, sf_dir):
        return query(ship(spark), sf_dir)

    return run


def oracle_sql():
    found = {}
    for name in _MODULES:
        found |= getattr(importlib.import_module(f"curbflow.llm.{name}"), "ORACLES", {})
    return found
