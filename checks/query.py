"""A registered query: a Spark callable and, where SQL can say it, its oracle."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from checks.tables import VIEWS, Tables, duckdb_view
from headway.session import configure

REGISTRY: dict[str, "Query"] = {}
# Further common table expressions of the oracle side, by name.
CTES: dict[str, str] = {}


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(Tables(configure(spark), sf_dir))


def query(name: str, sql: str | None = None):
    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        assert name not in REGISTRY, name
        REGISTRY[name] = Query(name, build, sql)
        return build

    return register


def _definition(name: str) -> str:
    return duckdb_view(name) if name in VIEWS else CTES[name]


def with_ctes(sql: str) -> str:
    """Prefix the query with every view and expression it refers to."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\bg_\w+", text):
            if name not in ordered:
                visit(_definition(name))
                if name not in ordered:
                    ordered.append(name)

    visit(sql)
    if not ordered:
        return sql
    heads = ",\n".join(f"{name} AS (\n{_definition(name)}\n)" for name in ordered)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {heads},\n{body[5:]}"
    return f"WITH {heads}\n{body}"


def rounded(expression: str, digits: int) -> str:
    """Decimal half-up rounding of the shortest text of a double, as Spark rounds."""
    return f"CAST(CAST(CAST({expression} AS VARCHAR) AS DECIMAL(38,{digits})) AS DOUBLE)"


def case_chain(subject: str, limits: list[tuple[str, str]], other: str) -> str:
    whens = " ".join(f"WHEN {subject} {test} THEN '{label}'" for test, label in limits)
    return f"CASE {whens} ELSE '{other}' END"


def half_even(expression: str, digits: int) -> str:
    """Half-even rounding of the shortest text of a double, as a scaled whole number."""
    scaled = f"CAST(CAST({expression} AS VARCHAR) AS DECIMAL(34,18)) * {10**digits}"
    return (
        f"(CASE WHEN {scaled} - FLOOR({scaled}) = 0.5 THEN 2 * ROUND(FLOOR({scaled}) / 2.0 + 0.25)"
        f" ELSE FLOOR({scaled} + 0.5) END)"
    )


def percentile(expression: str, p: float) -> str:
    """Interpolated percentile in the form (upper - at) * low + (at - lower) * high."""
    values = f"list_sort(list({expression}) FILTER ({expression} IS NOT NULL))"
    at = f"({p}e0 * (COUNT({expression}) - 1))"
    low = f"{values}[CAST(FLOOR({at}) AS BIGINT) + 1]"
    high = f"{values}[CAST(CEIL({at}) AS BIGINT) + 1]"
    return (
        f"(CASE WHEN {low} = {high} THEN CAST({low} AS DOUBLE) ELSE"
        f" (CEIL({at}) - {at}) * {low} + ({at} - FLOOR({at})) * {high} END)"
    )
