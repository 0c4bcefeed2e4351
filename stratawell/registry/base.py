"""Registration of checked queries: a Spark builder and, where SQL can say it, its oracle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

Builder = Callable[[SparkSession, str], DataFrame]
DIGITS = 4
# Two engines round an exact half differently; a small shift on both sides moves values off it.
SHIFT = 1e-6


@dataclass(frozen=True)
class Query:
    build: Builder
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Builder], Builder]:
    def register(build: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = Query(build, sql)
        return build

    return register


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Doubles rounded, so that two engines can be compared."""
    return df.select(
        *[
            F.round(F.col(c) + SHIFT, digits).alias(c) if t == "double" else F.col(c)
            for c, t in df.dtypes
        ]
    )


def r(expression: str, alias: str | None = None, digits: int = DIGITS) -> str:
    """The same rounding in SQL."""
    return f"round({expression} + {SHIFT:.6f}, {digits}) AS {alias or expression}"


def plain_r(expression: str, alias: str, digits: int) -> str:
    """Rounding that is part of the operator itself."""
    return f"round({expression}, {digits}) AS {alias}"


def rs(*columns: str, digits: int = DIGITS) -> str:
    return ", ".join(r(c, digits=digits) for c in columns)
