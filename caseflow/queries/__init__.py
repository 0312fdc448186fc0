"""Registered queries over the given tables, each with the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from caseflow.queries import incremental, landing, mergeable, model, quality, reports, scalars

Query = Callable[[SparkSession, str], DataFrame]
GROUPS = [landing, scalars, incremental, model, mergeable, reports, quality]


def all_queries() -> dict[str, Query]:
    return {name: run for group in GROUPS for name, (run, _) in group.QUERIES.items()}


def all_oracles() -> dict[str, str]:
    return {
        name: sql for group in GROUPS for name, (_, sql) in group.QUERIES.items() if sql is not None
    }
