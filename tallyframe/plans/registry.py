"""Registration of catalogue queries and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tallyframe.sources.tables import TableSet


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[TableSet], DataFrame]
    oracle: str | None
    doc: str


QUERIES: dict[str, Query] = {}


def query(name: str, oracle: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name`` with its oracle SQL."""

    def wrap(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = Query(name, fn, oracle, (fn.__doc__ or "").strip())
        return fn

    return wrap


def runner(name: str) -> Callable[[SparkSession, str], DataFrame]:
    q = QUERIES[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return q.build(TableSet(spark, sf_dir))

    run.__name__ = name
    run.__doc__ = q.doc
    return run
