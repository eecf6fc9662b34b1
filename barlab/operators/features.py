"""One feature row and one quality row per symbol (IND13), and the run-level steps around them."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from barlab.config import IndicatorParams
from barlab.functions import folds
from barlab.operators import indicators as ind
from barlab.operators.bars import by_symbol, is_break, once_a_day, with_close_ratio

FEATURE_COLUMNS = ("ema_short", "ema_medium", "ema_long", "rsi", "roc", "relative_return", "relative_volume",
                   "distance_from_high", "prior_high_long", "atr_percent")


def _marked(bars: DataFrame, p: IndicatorParams) -> DataFrame:
    whole = Window.partitionBy("symbol")
    bad = sum(F.when(F.col(c).isNull() | (F.col(c) <= 0), 1).otherwise(0) for c in ("close", "high", "low"))
    broken = is_break(F.col("close_ratio"), p.break_low_ratio, p.break_high_ratio)
    return (with_close_ratio(once_a_day(bars))
            .withColumn("bad_values", F.sum(bad).over(whole))
            .withColumn("n_all", F.count(F.lit(1)).over(whole))
            .withColumn("break_date", F.max(F.when(broken, F.col("trading_date"))).over(whole))
            .withColumn("bar_index", F.row_number().over(by_symbol()) - 1))


def compute_features(bars: DataFrame, benchmark: DataFrame, p: IndicatorParams) -> DataFrame:
    """Quality and features of every symbol holding at least one bar.

    One exchange on symbol serves the windows and the grouping; the benchmark is joined on
    the two dates it is needed at, after the bars are reduced to one row per symbol. A day that a
    symbol holds twice is an error: copies are collapsed before (bars.one_per_day).
    """
    post = _marked(bars, p).filter((F.col("bad_values") > 0) | F.col("break_date").isNull()
                                   | (F.col("trading_date") >= F.col("break_date")))
    at_break = F.col("trading_date") == F.col("break_date")
    packed = post.groupBy("symbol").agg(
        F.first("bad_values").alias("bad_values"), F.first("n_all").alias("n_all"),
        F.max("break_date").alias("break_date"),
        F.max(F.when(at_break, F.col("close_ratio"))).alias("break_ratio"),
        F.max(F.when(at_break, F.col("bar_index"))).alias("break_index"),
        F.max("trading_date").alias("last_date"),
        F.sort_array(F.collect_list(F.struct("trading_date", "high", "low", "close", "volume", "prior_close"))).alias("b"))
    ok = F.col("bad_values") == 0
    field = lambda name: F.transform(F.col("b"), lambda r: r[name])
    later = F.slice(F.col("b"), 2, F.greatest(F.size("b") - 1, F.lit(0)))
    packed = (packed.filter(ok)
              .withColumn("n_bars", F.size("b"))
              .withColumn("c", field("close"))
              .withColumn("d", F.transform(later, lambda r: r["close"] - r["prior_close"]))
              .withColumn("tr", F.transform(later, lambda r: ind.true_range(r["high"], r["low"], r["prior_close"])))
              .unionByName(packed.filter(~ok).withColumn("n_bars", F.col("n_all").cast("int"))
                           .select("*", *[F.lit(None).cast("array<double>").alias(n) for n in ("c", "d", "tr")])))
    tail = lambda name, n: F.transform(F.slice(F.col("b"), -n, n), lambda r: r[name])
    has = lambda n: ok & (F.size("b") >= n)
    back = lambda name, k: F.when(has(k + 1), F.element_at(F.col("b"), -(k + 1))[name])
    close = back("close", 0)
    w, hw, look = p.volume_usable_window, p.high_window, p.relative_return_lookback
    recent = F.when(has(w), tail("volume", w))
    usable = F.coalesce(F.size(F.filter(recent, lambda v: v > 0)) >= p.volume_usable_bars, F.lit(False))
    prior_v = F.slice(F.slice(F.transform(F.col("b"), lambda r: r["volume"]), -(p.rvol_window + 1), p.rvol_window + 1),
                      1, p.rvol_window)
    prior_mean = F.when(~F.exists(prior_v, lambda v: v.isNull()),
                        F.aggregate(prior_v, F.lit(0.0), lambda a, v: a + v) / F.lit(float(p.rvol_window)))
    rows = packed.select(
        "symbol", "bad_values", "n_bars", "break_date", "break_ratio", "break_index", "last_date",
        (ok & (F.col("n_bars") >= hw)).alias("w52_complete"),
        (ok & has(w) & usable).alias("volume_usable"),
        folds.ema_last(F.col("c"), p.ema_short).alias("ema_short"),
        folds.ema_last(F.col("c"), p.ema_medium).alias("ema_medium"),
        folds.ema_last(F.col("c"), p.ema_long).alias("ema_long"),
        folds.rsi_last(F.col("d"), p.rsi_period).alias("rsi"),
        ((F.try_divide(close, back("close", p.roc_lookback)) - 1) * 100).alias("roc"),
        F.when(has(p.rvol_window + 1) & usable & has(w),
               F.try_divide(back("volume", 0), prior_mean)).alias("relative_volume"),
        F.when(has(hw), F.array_max(tail("high", hw))).alias("prior_high_long"),
        F.try_divide(folds.wilder_last(F.col("tr"), p.atr_period), close).alias("_atr"),
        close.alias("_close"), back("close", look).alias("_start"),
        back("trading_date", look).alias("_start_date"))
    bench = benchmark.select("trading_date", "close")
    rows = (rows.join(bench.toDF("_start_date", "_bs"), "_start_date", "left")
            .join(bench.toDF("last_date", "_be"), "last_date", "left"))
    status = (F.when(~ok, "FAILED").when(F.col("n_bars") < p.minimum_history_bars, "INSUFFICIENT_HISTORY")
              .otherwise("VALID"))
    need = F.lit(p.minimum_history_bars)
    short = F.when(F.col("break_date").isNotNull(), F.format_string("%d post-break bars; %d required", "n_bars", need)) \
        .otherwise(F.format_string("%d bars; %d required", "n_bars", need))
    note = F.format_string("possible corporate-action break at bar index %d, close ratio %.4f",
                           "break_index", "break_ratio")
    reason = (F.when(~ok, F.format_string("%d non-positive or missing price value(s)", "bad_values"))
              .otherwise(F.nullif(F.concat_ws("; ", F.when(status == "INSUFFICIENT_HISTORY", short),
                                              F.when(F.col("break_date").isNotNull(), note)), F.lit(""))))
    return rows.select(
        "symbol", status.alias("status"), reason.alias("reason"), "n_bars", "w52_complete",
        F.when(ok, F.col("break_date")).alias("break_date"), F.when(ok, F.col("break_ratio")).alias("break_ratio"),
        "volume_usable", "last_date", "ema_short", "ema_medium", "ema_long", "rsi", "roc",
        ind.relative_return(F.col("_start"), F.col("_close"), F.col("_bs"), F.col("_be")).alias("relative_return"),
        "relative_volume",
        ind.distance_from_high(F.col("_close"), F.col("prior_high_long")).alias("distance_from_high"),
        "prior_high_long", (F.col("_atr") * 100).alias("atr_percent"))


def mark_stale(quality: DataFrame, bars: DataFrame) -> DataFrame:
    """VALID rows older than the newest date of the run become STALE (TK10)."""
    asof = bars.agg(F.max("trading_date")).scalar()
    late = (F.col("status") == "VALID") & (F.col("last_date") < asof)
    reason = F.concat(F.lit("last observation "), F.col("last_date").cast("string"),
                      F.lit(", run as-of "), asof.cast("string"))
    return (quality.withColumn("reason", F.when(late, reason).otherwise(F.col("reason")))
            .withColumn("status", F.when(late, F.lit("STALE")).otherwise(F.col("status"))))


def without_bars(universe: DataFrame, bars: DataFrame, acquired: DataFrame) -> DataFrame:
    """Status of the universe members that hold no bar (CLS3)."""
    got = F.coalesce(F.col("acq_status"), F.lit("MISSING"))
    outcomes = acquired.select("symbol", F.col("status").alias("acq_status"), F.col("reason").alias("acq_reason"))
    return (universe.select("symbol").join(bars.select("symbol").distinct(), "symbol", "left_anti")
            .join(outcomes, "symbol", "left")
            .select("symbol",
                    F.when(got == "INSUFFICIENT_HISTORY", got).otherwise("FAILED").alias("status"),
                    F.concat(F.lit("acquisition "), got,
                             F.when(F.col("acq_reason") != "", F.concat(F.lit(": "), F.col("acq_reason")))
                             .otherwise("")).alias("reason"),
                    F.lit(0).alias("n_bars"), F.lit(False).alias("w52_complete")))


def feature_scan(universe: DataFrame, bars: DataFrame, benchmark: DataFrame, acquired: DataFrame,
                 p: IndicatorParams) -> DataFrame:
    """The quality table of a scan: every universe member exactly once (AG4 checks it)."""
    held = bars.join(universe.select("symbol"), "symbol", "left_semi")
    missing = without_bars(universe, held, acquired)
    return mark_stale(compute_features(held, benchmark, p), held).unionByName(missing, allowMissingColumns=True)


def scan_summary(quality: DataFrame) -> DataFrame:
    """Counts per status, flagged breaks and the as-of date (AG3)."""
    return quality.agg(
        *[F.count_if(F.col("status") == s).alias(s.lower()) for s in
          ("VALID", "INSUFFICIENT_HISTORY", "STALE", "FAILED")],
        F.count("break_date").alias("flagged_breaks"), F.max("last_date").alias("asof_date"))


def coverage(universe: DataFrame, quality: DataFrame) -> DataFrame:
    """Gate before a scan may be published: result rows against universe rows (AG4)."""
    n = universe.agg(F.count(F.lit(1))).scalar()
    return (quality.agg(F.count(F.lit(1)).alias("covered"), F.count_distinct("symbol").alias("symbols"))
            .withColumn("universe", n)
            .withColumn("complete", (F.col("covered") == F.col("universe")) & (F.col("symbols") == F.col("universe"))))
