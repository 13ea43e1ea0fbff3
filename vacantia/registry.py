"""Queries by name, each with the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vacantia.plans.postings import EMPLOYERS_SQL, POSTINGS_SQL

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, run: Query, sql: str | None = None) -> None:
    """sql may name the common table expressions ``postings`` and ``employers``."""
    if name in QUERIES:
        raise ValueError(f"{name} is registered twice")
    QUERIES[name] = run
    if sql:
        ctes = [c for word, c in (("postings", POSTINGS_SQL), ("employers", EMPLOYERS_SQL)) if word in sql]
        if sql.lstrip().upper().startswith("WITH "):
            sql = sql.lstrip()[5:]
            ORACLES[name] = "WITH " + ",".join([*ctes, "\n" + sql])
        else:
            ORACLES[name] = ("WITH " + ",".join(ctes) + "\n" if ctes else "") + sql
