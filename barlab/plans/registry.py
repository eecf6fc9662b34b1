"""Collects the registered queries and their SQL twins."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from barlab.session import bound_tasks, prepare

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, sf_dir: fn(bound_tasks(prepare(spark)), sf_dir)
        if oracle:
            ORACLES[name] = oracle
        return fn
    return add


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round doubles so that two engines' last bits do not matter; widen integers."""
    out = []
    for field in df.schema.fields:
        kind = field.dataType.simpleString()
        col = F.col(f"`{field.name}`")
        if kind in ("double", "float"):
            col = F.round(col.cast("double"), digits)
        elif kind in ("int", "smallint", "tinyint"):
            col = col.cast("bigint")
        out.append(col.alias(field.name))
    return df.select(*out)
