"""Registered queries, each next to the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from trackline.plans.views import SQL, Inputs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None, uses: str = ""):
    """Register ``fn(inputs)`` under ``name``; ``uses`` lists the views ``sql`` reads."""

    def register(fn: Callable[[Inputs], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(Inputs(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = _with_views(uses.split(), sql)
        return fn

    return register


def _with_views(names: list[str], body: str) -> str:
    ordered: list[str] = []

    def add(name: str) -> None:
        needs, _ = SQL[name]
        for need in needs.split():
            add(need)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    ctes = ",\n".join(f"{name} AS ({SQL[name][1]})" for name in ordered)
    body = body.strip()
    if not ctes:
        return body
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
