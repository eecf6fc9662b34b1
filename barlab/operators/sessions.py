"""Sessions by number: lookups of a day's rank, and sets of sessions as words of 64 bits.

A calendar has one row per day at most, so the tables made from it alone (numbers, ranks, words) are
bounded by the number of days however many symbols there are; they are what is broadcast here.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from barlab.session import materialize

WORD = 64


def session_index(sessions: DataFrame) -> DataFrame:
    """Sessions numbered from 0; one row per calendar day at most."""
    return sessions.select("trading_date").distinct().withColumn(
        "idx", F.row_number().over(Window.orderBy("trading_date")) - 1)


def day_ranks(index: DataFrame) -> DataFrame:
    """Every calendar day from the one before the first session to the one after the last, with the
    number of the first session on or after it (`_first`) and of the last on or before it (`_last`).
    One row a day, written down once, as lookups read it several times."""
    ends = index.agg(F.date_sub(F.min("trading_date"), 1).alias("a"), F.date_add(F.max("trading_date"), 1).alias("b"))
    days = ends.filter("a is not null").select(F.explode(F.sequence("a", "b")).alias("_day"))
    held = F.col("trading_date").isNotNull().cast("long")
    through = F.sum(held).over(Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, 0))
    return materialize(days.join(index.select("trading_date"), F.col("_day") == F.col("trading_date"), "left").select(
        "_day", (through - held).alias("_first"), (through - 1).alias("_last")), "ranks")


def ranked(rows: DataFrame, day: str, ranks: DataFrame) -> DataFrame:
    """The rows with `_first` and `_last` of their day (see day_ranks). A day outside the calendar
    counts as the day before or after it; rows without a day are dropped, and so are all rows if there
    is no session."""
    held = F.least(F.greatest(F.col(day), ranks.agg(F.min("_day")).scalar()), ranks.agg(F.max("_day")).scalar())
    return rows.withColumn("_day", F.when(F.col(day).isNotNull(), held)).join(F.broadcast(ranks), "_day").drop("_day")


def between(rows: DataFrame, start: str, until: str, ranks: DataFrame) -> DataFrame:
    """The rows with `_from` and `_to`: their sessions on [start, until) have the numbers from `_from` up
    to, not including, `_to`."""
    opened = ranked(rows, start, ranks).withColumnRenamed("_first", "_from").drop("_last")
    return ranked(opened, until, ranks).withColumnRenamed("_first", "_to").drop("_last")


def unfold(rows: DataFrame, index: DataFrame) -> DataFrame:
    """One row for every session from `_from` to before `_to`, for callers that want the sessions themselves."""
    each = rows.filter("_from < _to").withColumn("idx", F.explode(F.sequence("_from", F.col("_to") - 1)))
    return each.join(F.broadcast(index), "idx").drop("_from", "_to")


# --- sets of sessions -------------------------------------------------------------------------

def _bit(idx: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), (idx % WORD).cast("int"))


def words(rows: DataFrame, keys: list[str], index: DataFrame) -> DataFrame:
    """keys, `_word`, `_held`: which sessions each key has, 64 to a word. Repeated days count once,
    days that are no session do not count."""
    return (rows.select(*keys, "trading_date").join(F.broadcast(index), "trading_date")
            .groupBy(*keys, F.floor(F.col("idx") / WORD).alias("_word")).agg(F.bit_or(_bit(F.col("idx"))).alias("_held")))


def compared_words(members: DataFrame, keys: list[str], held: DataFrame, index: DataFrame) -> DataFrame:
    """For every member and word of the calendar: `_held` and `_lacking`, what the member has and lacks.
    Members times sessions / 64 rows."""
    whole = index.groupBy(F.floor(F.col("idx") / WORD).alias("_word")).agg(F.bit_or(_bit(F.col("idx"))).alias("_all"))
    last = index.agg(F.floor(F.max("idx") / WORD)).scalar()
    rows = members.select(*keys).distinct().withColumn("_last", last).filter("_last is not null")
    rows = rows.withColumn("_word", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_last")))).drop("_last")
    rows = rows.join(F.broadcast(whole), "_word").join(held, [*keys, "_word"], "left")
    has = F.coalesce("_held", F.lit(0).cast("long"))
    return rows.select(*keys, "_word", has.alias("_held"), F.col("_all").bitwiseAND(F.bitwise_not(has)).alias("_lacking"))


def listed(rows: DataFrame, bits: str, index: DataFrame) -> DataFrame:
    """One row for every session in the words `bits`, as trading_date."""
    places = F.filter(F.sequence(F.lit(0), F.lit(WORD - 1)), lambda k: F.call_function("shiftrightunsigned", F.col(bits), k).bitwiseAND(F.lit(1)) == 1)
    each = rows.filter(F.col(bits) != 0).withColumn("_k", F.explode(places)).withColumn("idx", (F.col("_word") * WORD + F.col("_k")).cast("int"))
    return each.join(F.broadcast(index), "idx").drop("_k", "_word", "idx", "_held", "_lacking")
