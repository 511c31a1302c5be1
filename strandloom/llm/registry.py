"""The corpus queries and their SQL, for the entry module."""

from __future__ import annotations

import importlib

#: query name -> (module, function)
QUERIES = {
    "op1_ogg_media": ("ogg", "op1"),
    "op5_bpe": ("bpe", "op5"),
    "op3_secrets": ("secrets", "op3"),
    "op10_toxicity": ("toxicity", "op10"),
    "op7_mixing": ("mixing", "op7"),
    "op9_url_reputation": ("urls", "op9"),
    "op2_licenses": ("licenses", "op2"),
    "op4_warc": ("warc", "op4"),
    "op6_jaccard": ("jaccard", "op6"),
    "op8_bm25": ("search", "op8"),
    "op11_decontamination": ("leaks", "op11"),
    "op12_filter_audit": ("audit", "op12"),
}


def _lazy(module: str, function: str):
    def run(spark, sf_dir):
        return getattr(importlib.import_module(f"strandloom.llm.{module}"), function)(spark, sf_dir)

    run.__name__ = function
    return run


def queries() -> dict:
    return {name: _lazy(*where) for name, where in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    found = {}
    for name, (module, function) in QUERIES.items():
        sql = getattr(importlib.import_module(f"strandloom.llm.{module}"), f"{function.upper()}_SQL", None)
        if sql:
            found[name] = sql
    return found
