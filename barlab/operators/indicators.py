"""Indicators over all symbols at once. Short history gives null, never zero.

Window forms answer at every bar; fold forms answer at the last bar.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from barlab.config import positive
from barlab.functions import folds
from barlab.operators.bars import by_symbol, chart_bars


def roc(close: Column, lookback: int) -> Column:
    prior = F.lag(close, positive("lookback", lookback)).over(by_symbol())
    return (F.try_divide(close, prior) - 1) * 100


def with_rolling_extreme(rows: DataFrame, value: str, n: int, name: str, *, exclude_current: bool = False,
                         lowest: bool = False, keys: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """Adds the highest (or lowest) of the last n values, null with fewer than n rows (IND6).

    A sliding frame would visit n rows for every row. Here each run of rows is cut into blocks
    of n; a window of n rows is the tail of one block and the head of the next, so a running
    extreme from either end of the blocks answers it at a cost that does not grow with n.
    """
    positive("window", n)
    pick, join = (F.min, F.least) if lowest else (F.max, F.greatest)
    line = Window.partitionBy(*keys).orderBy("trading_date")
    running = lambda order: Window.partitionBy(*keys, "_block").orderBy(order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    out = (rows.withColumn("_i", F.row_number().over(line) - 1).withColumn("_block", F.floor(F.col("_i") / n))
           .withColumn("_tail", pick(value).over(running(F.desc("trading_date"))))
           .withColumn("_head", pick(value).over(running(F.asc("trading_date")))))
    full = F.when(F.col("_i") >= n - 1, join(F.col("_head"), F.lag("_tail", n - 1).over(line)))
    out = out.withColumn(name, full)
    if exclude_current:
        out = out.withColumn(name, F.lag(name, 1).over(line))
    return out.drop("_i", "_block", "_tail", "_head")


def distance_from_high(close: Column, high: Column) -> Column:
    return F.when(high > 0, (high - close) / high * 100)


def relative_volume(volume: Column, n: int) -> Column:
    frame = by_symbol().rowsBetween(-positive("window", n), -1)
    return F.when(F.count(volume).over(frame) == n, F.try_divide(volume, F.avg(volume).over(frame)))


def volume_usable(volume: Column, window: int, positive_bars: int) -> Column:
    """The last `window` bars exist and at least `positive_bars` of them traded (IND12)."""
    frame = by_symbol().rowsBetween(-(window - 1), 0)
    return ((F.count(F.lit(1)).over(frame) == window)
            & (F.count(F.when(volume > 0, 1)).over(frame) >= positive_bars))


def relative_return(start: Column, end: Column, bench_start: Column, bench_end: Column) -> Column:
    return (F.try_divide(end, start) - 1) * 100 - (F.try_divide(bench_end, bench_start) - 1) * 100


def true_range(high: Column, low: Column, prior_close: Column) -> Column:
    return F.greatest(high - low, F.abs(high - prior_close), F.abs(low - prior_close))


def atr_percent(atr: Column, close: Column) -> Column:
    return F.try_divide(atr, close) * 100


def ordered(values: Column) -> Column:
    """The group's values by date, as an array."""
    pairs = F.sort_array(F.collect_list(F.struct("trading_date", values.alias("v"))))
    return F.transform(pairs, lambda p: p["v"])


# --- one job per indicator ---------------------------------------------------------------

def ema_latest(bars: DataFrame, period: int) -> DataFrame:
    packed = bars.groupBy("symbol").agg(ordered(F.col("close")).alias("c"))
    return packed.select("symbol", folds.ema_last(F.col("c"), period).alias("ema"))


def rsi_latest(bars: DataFrame, period: int) -> DataFrame:
    change = F.col("close") - F.lag("close").over(by_symbol())
    packed = (bars.withColumn("d", change).groupBy("symbol")
              .agg(F.array_compact(ordered(F.col("d"))).alias("d")))
    return packed.select("symbol", folds.rsi_last(F.col("d"), period).alias("rsi"))


def atr_latest(bars: DataFrame, period: int) -> DataFrame:
    """ATR and ATR as a share of the last close (IND4, IND5)."""
    prior = F.lag("close").over(by_symbol())
    tr = F.when(prior.isNotNull(), true_range(F.col("high"), F.col("low"), prior))
    packed = (bars.withColumn("tr", tr).groupBy("symbol")
              .agg(F.array_compact(ordered(F.col("tr"))).alias("tr"),
                   F.max_by("close", "trading_date").alias("close")))
    return (packed.withColumn("atr", folds.wilder_last(F.col("tr"), period))
            .select("symbol", "atr", atr_percent(F.col("atr"), F.col("close")).alias("atr_percent")))


def relative_return_latest(bars: DataFrame, benchmark: DataFrame, lookback: int) -> DataFrame:
    """Spread against the benchmark between the last bar and `lookback` bars before it.
    Null unless the benchmark holds both dates (IND9, JN15)."""
    newest_first = Window.partitionBy("symbol").orderBy(F.desc("trading_date"))
    ends = (bars.select("symbol", "trading_date", "close")
            .withColumn("_r", F.row_number().over(newest_first))
            .filter(F.col("_r").isin(1, lookback + 1)))
    priced = ends.join(benchmark.select("trading_date", F.col("close").alias("bench")), "trading_date", "left")
    end, start = F.col("_r") == 1, F.col("_r") == lookback + 1
    pick = lambda c, cond: F.max(F.when(cond, F.col(c)))
    return (priced.groupBy("symbol").agg(
                pick("trading_date", start).alias("start_date"), pick("trading_date", end).alias("end_date"),
                pick("close", start).alias("_s"), pick("close", end).alias("_e"),
                pick("bench", start).alias("_bs"), pick("bench", end).alias("_be"))
            .select("symbol", "start_date", "end_date",
                    relative_return(F.col("_s"), F.col("_e"), F.col("_bs"), F.col("_be")).alias("relative_return")))


def chart_ema(bars: DataFrame, breaks: DataFrame, periods: dict[str, int], limit: int) -> DataFrame:
    """Chart rows with EMA series from the break onward; earlier bars carry nulls (IND14).

    `limit` bounds the arrays, since a series fold copies its array at each step.
    """
    shown = (chart_bars(bars, limit).join(breaks.select("symbol", "break_date"), "symbol", "left")
             .withColumn("_live", F.col("break_date").isNull() | (F.col("trading_date") >= F.col("break_date"))))
    # a break later than the last shown bar does not hide anything
    anything = F.bool_or("_live").over(Window.partitionBy("symbol"))
    shown = shown.withColumn("_live", F.col("_live") | ~anything)
    packed = shown.groupBy("symbol").agg(
        F.sort_array(F.collect_list(F.struct("trading_date", "close", "_live"))).alias("rows"))
    live = F.filter(F.col("rows"), lambda r: r["_live"])
    packed = packed.withColumn("c", F.transform(live, lambda r: r["close"]))
    series = [folds.ema_series(F.col("c"), p).alias(name) for name, p in periods.items()]
    packed = packed.select("symbol", "rows", (F.size("rows") - F.size("c")).alias("_skip"), *series)
    out = packed.select("symbol", "_skip", *periods, F.posexplode("rows").alias("_pos", "_row"))
    at = lambda name: F.when(F.col("_pos") >= F.col("_skip"),
                             F.get(F.col(name), F.col("_pos") - F.col("_skip"))).alias(name)
    return out.select("symbol", F.col("_row.trading_date").alias("trading_date"),
                      F.col("_row.close").alias("close"), *[at(name) for name in periods])
