"""Shaping daily bars: one row per (symbol, date), jumps and break truncation.

Every per-symbol window in the library runs after `one_per_day`. That reduction is a
map-side aggregate, so however many copies one symbol brings, its group afterwards holds
at most one row per calendar day.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

PRICE_COLUMNS = ("open", "high", "low", "close", "volume")


def by_symbol() -> Window:
    return Window.partitionBy("symbol").orderBy("trading_date")


def one_per_day(bars: DataFrame) -> DataFrame:
    """Collapse copies of a day to the largest value of each column (AG13)."""
    kept = [c for c in PRICE_COLUMNS if c in bars.columns]
    return bars.groupBy("symbol", "trading_date").agg(*[F.max(c).alias(c) for c in kept])


def latest_copy(bars: DataFrame, key: list[str], order: Column) -> DataFrame:
    """Insert-or-replace: of the rows sharing a key, the one written last stays (SNK1)."""
    others = [c for c in bars.columns if c not in key]
    packed = bars.groupBy(*key).agg(F.max_by(F.struct(*others), order).alias("_row"))
    return packed.select(*key, *[F.col("_row")[c].alias(c) for c in others])


def is_break(ratio: Column, low: float, high: float) -> Column:
    """Strict on both sides: exactly the threshold is no break."""
    return (ratio < F.lit(low)) | (ratio > F.lit(high))


def with_close_ratio(bars: DataFrame) -> DataFrame:
    """close / previous close; null when there is none or it is not positive."""
    prior = F.lag("close").over(by_symbol())
    return bars.withColumn("prior_close", prior).withColumn(
        "close_ratio", F.when(F.col("prior_close") > 0, F.try_divide("close", "prior_close")))


def with_last_break(bars: DataFrame, low: float, high: float) -> DataFrame:
    """Adds the symbol's most recent break date and ratio (IND10)."""
    whole = Window.partitionBy("symbol")
    when_broken = F.when(is_break(F.col("close_ratio"), low, high), F.col("trading_date"))
    return (with_close_ratio(bars)
            .withColumn("break_date", F.max(when_broken).over(whole))
            .withColumn("break_ratio", F.max(F.when(F.col("trading_date") == F.col("break_date"),
                                                    F.col("close_ratio"))).over(whole)))


def after_last_break(bars: DataFrame, low: float, high: float) -> DataFrame:
    """History cut so that the break bar becomes the first bar (IND10)."""
    marked = with_last_break(bars, low, high)
    return marked.filter(F.col("break_date").isNull() | (F.col("trading_date") >= F.col("break_date")))


def last_breaks(bars: DataFrame, low: float, high: float) -> DataFrame:
    """One row per symbol: bars held, bars from the break on, break date and ratio (IND10)."""
    marked = with_last_break(bars, low, high)
    kept = F.col("break_date").isNull() | (F.col("trading_date") >= F.col("break_date"))
    return marked.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("n_all"),
        F.count_if(kept).alias("n_bars"),
        F.max("break_date").alias("break_date"),
        F.max("break_ratio").alias("break_ratio"))


def close_jumps(bars: DataFrame, low: float, high: float) -> DataFrame:
    """Every close-to-close jump outside [low, high], at its own date (IND15)."""
    return (with_close_ratio(bars.filter(F.col("close") != 0))
            .filter(is_break(F.col("close_ratio"), low, high))
            .select("symbol", "trading_date", "close_ratio"))


def point_in_time_breaks(bars: DataFrame, low: float, high: float) -> DataFrame:
    """At every bar: the latest break known by then and the bars since it (IND16)."""
    so_far = by_symbol().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at_break = is_break(F.col("close_ratio"), low, high)
    numbered = with_close_ratio(bars).withColumn("_bar", F.row_number().over(by_symbol()))
    return (numbered
            .withColumn("last_break", F.last(F.when(at_break, F.col("trading_date")), ignorenulls=True).over(so_far))
            .withColumn("bars_since_break",
                        F.col("_bar") - F.last(F.when(at_break, F.col("_bar")), ignorenulls=True).over(so_far))
            .drop("_bar", "prior_close"))


def with_jump(closes: DataFrame, low: float, high: float) -> DataFrame:
    """Marks a 2dp close that jumps from the one before it; a prior of 0 is passed over.

    Compared as close against threshold * prior, so no decimal quotient is rounded.
    """
    low_d, high_d = F.lit(str(low)).cast("decimal(18,6)"), F.lit(str(high)).cast("decimal(18,6)")
    prior = F.col("_prior_2dp")
    jump = (F.col("close_2dp") < low_d * prior) | (F.col("close_2dp") > high_d * prior)
    return (closes.withColumn("_prior_2dp", F.lag("close_2dp").over(by_symbol()))
            .withColumn("jump", F.coalesce(F.when(prior != 0, jump), F.lit(False))).drop("_prior_2dp"))


def any_break(candles: DataFrame, low: float, high: float) -> DataFrame:
    """Per symbol, whether any two neighbouring valid 2dp closes jump (IND11).

    `candles` holds symbol, trading_date, close_2dp and valid.
    """
    closes = (candles.filter("valid").groupBy("symbol", "trading_date")
              .agg(F.max("close_2dp").alias("close_2dp")))
    return with_jump(closes, low, high).groupBy("symbol").agg(F.bool_or("jump").alias("price_break_detected"))


def once_a_day(bars: DataFrame) -> DataFrame:
    """The bars as they are; a day that a symbol holds twice raises when it is read."""
    again = F.lag("trading_date").over(by_symbol()).eqNullSafe(F.col("trading_date"))
    checked = F.when(again & F.col("trading_date").isNotNull(), F.raise_error(F.concat(F.lit("two bars on one day of "), F.col("symbol"))).cast("date"))
    return bars.withColumn("trading_date", checked.otherwise(F.col("trading_date")))


def last_n_if_enough(bars: DataFrame, n: int) -> DataFrame:
    """The last n bars of each symbol that holds at least n (TK4)."""
    newest_first = Window.partitionBy("symbol").orderBy(F.desc("trading_date"))
    whole = Window.partitionBy("symbol")
    return (bars.withColumn("_rank", F.row_number().over(newest_first))
            .withColumn("_held", F.count(F.lit(1)).over(whole))
            .filter((F.col("_held") >= n) & (F.col("_rank") <= n))
            .drop("_rank", "_held"))


def chart_bars(bars: DataFrame, limit: int) -> DataFrame:
    """The latest `limit` days of each symbol, copies collapsed (AG13)."""
    newest_first = Window.partitionBy("symbol").orderBy(F.desc("trading_date"))
    return (one_per_day(bars).withColumn("_rank", F.row_number().over(newest_first))
            .filter(F.col("_rank") <= limit).drop("_rank"))


def append_newer(held: DataFrame, refetched: DataFrame, expected_last: Column) -> DataFrame:
    """Held bars plus refetched bars strictly newer than the newest held one, and only for
    symbols whose newest held bar is older than expected (JN19, SET4)."""
    newest = held.groupBy("symbol").agg(F.max("trading_date").alias("_newest"))
    added = (refetched.join(newest, "symbol")
             .filter((F.col("_newest") < expected_last) & (F.col("trading_date") > F.col("_newest")))
             .drop("_newest"))
    return held.unionByName(added.select(*held.columns))
