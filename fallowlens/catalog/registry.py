"""Query registration and rounding rules shared by queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, date: str | None = None) -> Callable[[QueryFn], QueryFn]:
    """Register a query. A ``date`` column is put out as ``YYYY-MM-DD`` text."""

    def add(fn: QueryFn) -> QueryFn:
        def dated(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(spark, sf_dir).withColumn(date, F.date_format(date, "yyyy-MM-dd"))

        _QUERIES[name] = fn if date is None else dated
        if sql is not None:
            text = f'cast("{date}" as varchar) as "{date}"'
            _SQL[name] = sql if date is None else f"select * replace ({text}) from (\n{sql}\n)"
        return fn

    return add


def queries() -> dict[str, QueryFn]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def round_columns(df: DataFrame, names: Sequence[str], digits: int = 10) -> DataFrame:
    """Round the named columns and turn negative zero into zero."""
    chosen = set(names)
    return df.selectExpr(
        *[f"round(`{c}`, {digits}) + 0D as `{c}`" if c in chosen else f"`{c}`" for c in df.columns]
    )


def sql_rounded(expr: str, name: str, digits: int = 10) -> str:
    return f'round({expr}, {digits}) + 0e0 as "{name}"'
