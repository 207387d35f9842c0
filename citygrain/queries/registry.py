"""The query registry: name -> Spark callable, name -> SQL text."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from citygrain.queries import tables

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under a name, with its SQL counterpart.

    Derived tables named in the SQL are put in front of it as common table expressions.
    """

    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(tables.Tables(spark, sf_dir))

        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = with_derived(sql)
        return fn

    return wrap


def with_derived(sql: str) -> str:
    """The SQL preceded by the derived tables it uses, in dependency order."""
    needed: list[str] = []

    def visit(text: str):
        for name, body in tables.DERIVED_SQL.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(body)
                if name not in needed:
                    needed.append(name)

    visit(sql)
    if not needed:
        return sql
    parts = ",\n".join(f"{n} AS ({tables.DERIVED_SQL[n]})" for n in needed)
    body = sql.strip()
    match = re.match(r"(?i)with\s+(recursive\s+)?", body)
    if match:
        # derived tables come first in the caller's own list
        return f"WITH {'RECURSIVE ' if match.group(1) else ''}{parts},\n{body[match.end():]}"
    return f"WITH {parts}\n{body}"
