"""Registered queries, each with the SQL that states the same result."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tierworks.functions.business import stable_round

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Build
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    """Register a function (session, folder) -> DataFrame under a name."""

    def register(build: Build) -> Build:
        if name in REGISTRY:
            raise ValueError(f"query registered twice: {name}")
        REGISTRY[name] = Query(name, build, sql)
        return build

    return register


def rounded(df: DataFrame, columns: list[str], places: int = 6) -> DataFrame:
    """Round for comparison between engines, whose sums differ in the last bits."""
    return df.withColumns({c: stable_round(c, places) for c in columns})
