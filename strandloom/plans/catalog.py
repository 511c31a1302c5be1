"""All queries of the engine, with the SQL that checks them."""

from __future__ import annotations

import importlib

MODULES = ("kmer_queries", "align_queries", "expr_queries", "more_queries", "io_queries")


def _modules():
    return [importlib.import_module(f"strandloom.plans.{m}") for m in MODULES]


def flagship(spark, sf_dir):
    from strandloom.plans.kmer_queries import flagship as plan

    return plan(spark, sf_dir)


def queries() -> dict:
    return {name: f for m in _modules() for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in _modules() for name, sql in m.SQL.items()}
