"""features-v1: every feature at every bar, from nothing later than that bar (IND17).

A break starts a new stretch. The break bar itself belongs to neither side, so a feature
reads only bars strictly after the latest break.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from barlab.functions.folds import Recursion, affine_scan, rsi_of
from barlab.functions.numeric import share_pct
from barlab.operators.bars import by_symbol, is_break, with_close_ratio
from barlab.operators.indicators import true_range, with_rolling_extreme


@dataclass(frozen=True)
class PointInTimeParams:
    emas: tuple[int, int, int]
    slope_lag: int
    rsi_period: int
    atr_period: int
    returns: tuple[int, ...]
    high_window: int
    volatility_window: int
    rvol_window: int
    relative: tuple[int, ...]
    break_low_ratio: float
    break_high_ratio: float


def _stretch() -> Window:
    return Window.partitionBy("symbol", "_stretch", "_at_break").orderBy("trading_date")


def _over(n: int, value: Column, pick) -> Column:
    frame = _stretch().rowsBetween(-(n - 1), 0)
    return F.when(F.count(value).over(frame) == n, pick(value).over(frame))


EMAS = ("ema_short", "ema_medium", "ema_long")
SERIES = ["symbol", "_stretch", "_at_break"]


def _recursions(p: PointInTimeParams) -> dict[str, Recursion]:
    """EMAs of the close and Wilder's means of gains, losses and ranges. Quotients of two means must
    agree even where both have faded, so the latter carry values down to the smallest double."""
    wilder = lambda value, period: Recursion(value, period, 1.0 / period, skip=1, negligible=1e-300)
    return {**{name: Recursion(F.col("close"), n, 2.0 / (n + 1)) for name, n in zip(EMAS, p.emas)},
            "_gain": wilder(F.greatest("_move", F.lit(0.0)), p.rsi_period), "_loss": wilder(F.greatest(-F.col("_move"), F.lit(0.0)), p.rsi_period),
            "_atr": wilder(F.col("_tr"), p.atr_period)}


def features_v1(bars: DataFrame, benchmark: DataFrame, p: PointInTimeParams) -> DataFrame:
    """Own features of every symbol at every bar, by windows and scans of one exchange on symbol."""
    broke = F.coalesce(is_break(F.col("close_ratio"), p.break_low_ratio, p.break_high_ratio), F.lit(False))
    upto = by_symbol().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = (with_close_ratio(bars.join(benchmark.select("trading_date", F.col("close").alias("_bench")), "trading_date", "left"))
            .withColumn("_at_break", broke).withColumn("_stretch", F.sum(broke.cast("int")).over(upto)))
    close = F.col("close")
    back = lambda c, k: F.lag(c, k).over(_stretch())
    pct = lambda now, then: (F.try_divide(now, then) - 1) * 100
    for name, column, lowest in (("_high", "high", False), ("_low", "low", True)):
        rows = with_rolling_extreme(rows, column, p.high_window, name, lowest=lowest, keys=("symbol", "_stretch", "_at_break"))
    # a full window of n bars holds n - 1 steps inside the stretch
    step = F.ln(F.try_divide(close, back("close", 1)))
    rows = rows.withColumn("_step", step).withColumn("_move", close - back("close", 1)).withColumn("_tr", true_range(F.col("high"), F.col("low"), back("close", 1)))
    prior = _stretch().rowsBetween(-p.rvol_window, -1)
    own = {
        **{f"return_{k}": pct(close, back("close", k)) for k in p.returns},
        "below_high": F.when(F.col("_high") > 0, (F.col("_high") - close) / F.col("_high") * 100),
        "above_low": F.when(F.col("_low") > 0, (close - F.col("_low")) / F.col("_low") * 100),
        "volatility": _over(p.volatility_window, F.col("_step"), F.stddev_samp),
        "rvol": F.when(F.count("volume").over(prior) == p.rvol_window, F.try_divide("volume", F.avg("volume").over(prior))),
        **{f"relative_{k}": pct(close, back("close", k)) - pct(F.col("_bench"), back("_bench", k)) for k in p.relative},
    }
    rows = rows.select("symbol", "trading_date", "close", "_stretch", "_at_break", "_move", "_tr", *[c.alias(n) for n, c in own.items()])
    rows = affine_scan(rows, _recursions(p), SERIES, "trading_date")
    rows = rows.withColumns({f"{n}_slope": pct(F.col(n), back(n, p.slope_lag)) for n in EMAS})
    return rows.select(
        "symbol", "trading_date", "close", *own, *[c for n in EMAS for c in (n, f"{n}_slope")], rsi_of(F.col("_gain"), F.col("_loss")).alias("rsi"),
        *[pct(close, F.col(n)).alias(f"{n}_distance") for n in EMAS], (F.try_divide("_atr", "close") * 100).alias("atr_percent"))


def breadth_at(features: DataFrame, sectors: DataFrame | None = None) -> DataFrame:
    """Share above each EMA on every date, over all symbols or per sector (IND17 context)."""
    rows, keys = features, ["trading_date"]
    if sectors is not None:
        rows = rows.join(sectors.select("symbol", F.coalesce("sector", F.lit("UNKNOWN")).alias("sector")), "symbol")
        keys = ["trading_date", "sector"]
    out = []
    for name in ("ema_short", "ema_medium", "ema_long"):
        above = F.count_if(F.col("close") > F.col(name))
        out.append(share_pct(above, F.count(name), 4).alias(f"above_{name}"))
    return rows.groupBy(*keys).agg(*out)


def benchmark_context(benchmark: DataFrame, p: PointInTimeParams) -> DataFrame:
    """Benchmark trend and volatility at every date; one series of days."""
    one = benchmark.select(F.lit("benchmark").alias("symbol"), "trading_date", "close", F.col("close").alias("high"),
                           F.col("close").alias("low"), F.lit(1.0).alias("volume"))
    rows = features_v1(one, benchmark, p)
    return rows.select("trading_date", F.col("ema_medium_distance").alias("benchmark_trend"),
                       F.col("volatility").alias("benchmark_volatility"))
