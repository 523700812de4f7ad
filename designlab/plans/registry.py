"""Named queries: a Spark builder plus, where SQL can express it, a DuckDB oracle text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from designlab.functions.numeric import round_doubles

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLE: dict[str, str] = {}
_HEADLINE: list[str] = []


def register(name: str, sql: str | None = None, headline: bool = False, digits: int | None = 6):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``.

    Double columns are rounded to ``digits`` decimals (sums depend on partition
    order); the oracle text rounds the same columns the same way.
    """
    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(spark, sf_dir)
            return round_doubles(df, digits) if digits is not None else df

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        _QUERIES[name] = run
        if sql is not None:
            _ORACLE[name] = sql.strip()
        if headline:
            _HEADLINE.append(name)
        return fn
    return deco


def _load_all() -> None:
    # import for side effects: each module registers its queries
    from designlab.plans import (q_board, q_checks, q_clean, q_design, q_dist,  # noqa: F401
                                 q_model, q_prep)


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(_ORACLE)


def headline() -> list[str]:
    _load_all()
    return list(_HEADLINE)
