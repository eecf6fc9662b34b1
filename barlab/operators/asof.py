"""Values in force at a time."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def in_force(rows: DataFrame, states: DataFrame, keys: list[str], at: str, since: str, value: str) -> DataFrame:
    """Each row with the `value` of the last state of its key whose `since` is at or before
    `at`; a null `since` counts as before everything (JN13).

    Rows and states are laid on one timeline per key, so no pair is ever formed. Without keys
    everything would be one timeline: use in_force_by_day.
    """
    if not keys:
        raise ValueError("in_force needs keys; values of whole days go through in_force_by_day")
    return _in_force(rows, states, Window.partitionBy(*keys), keys, at, since, value)


def in_force_by_day(rows: DataFrame, states: DataFrame, at: str, since: str, value: str) -> DataFrame:
    """The same without keys, for rows and states that are at most one per calendar day or
    session: the one timeline is bounded by the number of days."""
    return _in_force(rows, states, Window.partitionBy(F.lit(0)), [], at, since, value)


def _in_force(rows: DataFrame, states: DataFrame, line_of: Window, keys: list[str], at: str, since: str, value: str) -> DataFrame:
    marks = states.select(*keys, F.col(since).alias(at), F.struct(F.col(value).alias("v")).alias("_state"))
    line = rows.withColumn("_row", F.lit(True)).unionByName(marks, allowMissingColumns=True)
    before = line_of.orderBy(
        F.asc_nulls_first(at), F.asc_nulls_first("_row")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (line.withColumn("_now", F.last("_state", ignorenulls=True).over(before))
            .filter("_row").withColumn(value, F.col("_now.v")).drop("_row", "_state", "_now"))
