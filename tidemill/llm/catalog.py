"""The registered queries of this package, and SQL for those that SQL can express."""

from __future__ import annotations

import importlib

#: One module per operator, in the order of their numbers.
OPERATORS = [
    "token_counts", "substring_dedup", "packing", "warc", "fingerprints", "html_extraction", "exact_dedup", "toxicity",
    "mixing", "ngram_join", "periodic_runs", "token_alignment", "decontamination",
]


def _modules() -> list:
    return [importlib.import_module(f"tidemill.llm.{name}") for name in OPERATORS]


def queries() -> dict:
    return {name: run for module in _modules() for name, run in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in _modules() for name, sql in module.ORACLE.items()}
