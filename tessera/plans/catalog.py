"""The registered queries: one module per family, each with Spark plans and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.plans import evidence, gating, graphs, parsing, scalars, storing

FLAGSHIP = "g3_count_independent_evidence"

#: Modules that export QUERIES and ORACLES.
FAMILIES = (evidence, scalars, parsing, gating, graphs, storing)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for family in FAMILIES for name, query in family.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for family in FAMILIES for name, sql in family.ORACLES.items()}
