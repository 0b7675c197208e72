"""Query registry: each entry is a (spark, sf_dir) -> DataFrame callable with,
where the operator is SQL-expressible, the equivalent DuckDB SQL text."""

from __future__ import annotations

from collections.abc import Callable

from tillcast.sources.fixtures import ORACLE_BASE_CTES

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        if key in QUERIES:
            raise KeyError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn
    return deco


def with_base(extra_ctes: str, final_select: str) -> str:
    """DuckDB SQL: the shared fixture CTEs, then ``extra_ctes`` (may be empty), then the query."""
    ctes = ORACLE_BASE_CTES + (",\n" + extra_ctes.strip().rstrip(",") if extra_ctes.strip() else "")
    return "WITH " + ctes.strip() + "\n" + final_select.strip()


def r4(expr: str, alias: str, places: int = 4) -> str:
    return f"ROUND({expr}, {places}) AS {alias}"


def load_all() -> None:
    # import for side effect: every plan module registers its queries
    from tillcast.plans import (eda_plans, feature_plans, forecast_plans,  # noqa: F401
                                model_plans, quality_plans)
