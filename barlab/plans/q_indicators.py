"""Registered queries: breaks, indicators, features."""
from __future__ import annotations

from pyspark.sql import functions as F

from barlab.operators import bars as B
from barlab.operators import features as FT
from barlab.operators import indicators as I
from barlab.operators.bars import by_symbol
from barlab.plans import derived as D
from barlab.plans.derived import PARAMS as P
from barlab.plans.oracle_views import ema_sql, rsi_sql, sql, wilder_sql
from barlab.plans.registry import query, tidy

WIN = "window w as (partition by symbol order by trading_date)"


@query("ind01_ema", sql(f"""
select symbol, round({ema_sql('c', 20)}, 6) as ema from
(select symbol, list(close order by trading_date) as c from bars group by 1)""", "bars"))
def ind01(spark, sf):
    return tidy(I.ema_latest(D.bars(spark, sf), P.ema_short))


@query("ind02_rsi", sql(f"""
select symbol, round({rsi_sql('g', 'l', 14)}, 6) as rsi from
(select symbol, list(greatest(close - pc, 0.0) order by trading_date) filter (where pc is not null) as g,
        list(greatest(pc - close, 0.0) order by trading_date) filter (where pc is not null) as l from ratios group by 1)""", "ratios"))
def ind02(spark, sf):
    return tidy(I.rsi_latest(D.bars(spark, sf), P.rsi_period))


@query("ind03_roc", sql(f"""
select symbol, trading_date, round((close / nullif(lag(close, 10) over w, 0) - 1) * 100, 6) as roc from bars {WIN}""", "bars"))
def ind03(spark, sf):
    return tidy(D.bars(spark, sf).select("symbol", "trading_date", I.roc(F.col("close"), P.roc_lookback).alias("roc")))


ATR_ARR = """(select symbol, list(greatest(high - low, abs(high - pc), abs(low - pc)) order by trading_date) filter (where pc is not null) as tr,
        arg_max(close, trading_date) as close from ratios group by 1)"""


@query("ind04_atr", sql(f"select symbol, round({wilder_sql('tr', 14)}, 6) as atr from {ATR_ARR}", "ratios"))
def ind04(spark, sf):
    return tidy(I.atr_latest(D.bars(spark, sf), P.atr_period).select("symbol", "atr"))


@query("ind05_atr_percent", sql(f"select symbol, round({wilder_sql('tr', 14)} / nullif(close, 0) * 100, 6) as atr_percent from {ATR_ARR}", "ratios"))
def ind05(spark, sf):
    return tidy(I.atr_latest(D.bars(spark, sf), P.atr_period).select("symbol", "atr_percent"))


@query("ind06_rolling_high", sql("""
select symbol, trading_date,
  case when count(*) over a = 252 then round(max(high) over a, 6) end as high_incl,
  case when count(*) over b = 252 then round(max(high) over b, 6) end as high_excl from bars
window a as (partition by symbol order by trading_date rows between 251 preceding and current row),
       b as (partition by symbol order by trading_date rows between 252 preceding and 1 preceding)""", "bars"))
def ind06(spark, sf):
    b = I.with_rolling_extreme(D.bars(spark, sf), "high", P.high_window, "high_incl")
    return tidy(b.select("symbol", "trading_date", "high_incl", F.lag("high_incl").over(by_symbol()).alias("high_excl")))


@query("ind07_distance_from_high", sql("""
select symbol, trading_date, round(case when mx > 0 then (mx - close) / mx * 100 end, 6) as distance_from_high from
(select *, case when count(*) over a = 252 then max(high) over a end as mx from bars
 window a as (partition by symbol order by trading_date rows between 251 preceding and current row))""", "bars"))
def ind07(spark, sf):
    b = I.with_rolling_extreme(D.bars(spark, sf), "high", P.high_window, "mx")
    return tidy(b.select("symbol", "trading_date",
                         I.distance_from_high(F.col("close"), F.col("mx")).alias("distance_from_high")))


@query("ind08_relative_volume", sql("""
select symbol, trading_date, round(case when count(volume) over a = 20 then volume / nullif(avg(volume) over a, 0) end, 6) as relative_volume
from raw window a as (partition by symbol order by trading_date rows between 20 preceding and 1 preceding)""", "raw"))
def ind08(spark, sf):
    return tidy(D.raw_candles(spark, sf).select(
        "symbol", "trading_date", I.relative_volume(F.col("volume"), P.rvol_window).alias("relative_volume")))


REL = """
select symbol, sd as start_date, ed as end_date,
       round((ec / nullif(sc, 0) - 1) * 100 - (e.close / nullif(s.close, 0) - 1) * 100, 6) as relative_return
from (select symbol, max(case when z = 61 then trading_date end) as sd, max(case when z = 1 then trading_date end) as ed,
             max(case when z = 61 then close end) as sc, max(case when z = 1 then close end) as ec
      from (select *, row_number() over (partition by symbol order by trading_date desc) as z from bars) group by 1)
left join bench s on s.trading_date = sd left join bench e on e.trading_date = ed"""


@query("ind09_relative_return", sql(f"select symbol, relative_return from ({REL})", "bars", "bench"))
def ind09(spark, sf):
    b = D.bars(spark, sf)
    out = I.relative_return_latest(b, D.benchmark(spark, sf, b), P.relative_return_lookback)
    return tidy(out.select("symbol", "relative_return"))


@query("jn15_benchmark_dates", sql(REL, "bars", "bench"))
def jn15(spark, sf):
    b = D.bars(spark, sf)
    return tidy(I.relative_return_latest(b, D.benchmark(spark, sf, b), P.relative_return_lookback))


@query("ind10_last_break", sql("""
select symbol, any_value(n_all) as n_all, count(*) as n_bars, any_value(break_date) as break_date,
       round(max(case when trading_date = break_date then close / pc end), 6) as break_ratio from post group by 1""", "post"))
def ind10(spark, sf):
    return tidy(B.last_breaks(D.bars(spark, sf), P.break_low_ratio, P.break_high_ratio))


@query("ind12_volume_usable", sql("""
select symbol, trading_date, count(*) over a = 20 and count(case when volume > 0 then 1 end) over a >= 15 as volume_usable
from raw window a as (partition by symbol order by trading_date rows between 19 preceding and current row)""", "raw"))
def ind12(spark, sf):
    return D.raw_candles(spark, sf).select("symbol", "trading_date", I.volume_usable(
        F.col("volume"), P.volume_usable_window, P.volume_usable_bars).alias("volume_usable"))


FEATURE_SQL_COLS = ", ".join(f"round({c}, 6) as {c}" for c in (
    "break_ratio", "ema_short", "ema_medium", "ema_long", "rsi", "roc", "relative_return", "relative_volume",
    "distance_from_high", "prior_high_long", "atr_percent"))


@query("ind13_features", sql(f"""
select symbol, status, reason, n_bars, w52_complete, break_date, volume_usable, last_date, {FEATURE_SQL_COLS} from feat""", "feat"))
def ind13(spark, sf):
    return tidy(D.feature_quality(spark, sf))


@query("ind14_chart_ema", sql(f"""
, shown as (select b.*, break_date from (select *, row_number() over (partition by symbol order by trading_date desc) as z from bars) b
  join brk using (symbol) where z <= 400),
live as (select *, row_number() over (partition by symbol order by trading_date) as i from shown
  where break_date is null or trading_date >= break_date),
rec as (select symbol, list(close order by trading_date) as c from live group by 1),
ser as (select symbol, i, {ema_sql('c[1:i]', 20)} as ema_short, {ema_sql('c[1:i]', 50)} as ema_medium from rec join live using (symbol))
select s.symbol, s.trading_date, s.close, round(ema_short, 6) as ema_short, round(ema_medium, 6) as ema_medium
from shown s left join live l on l.symbol = s.symbol and l.trading_date = s.trading_date
left join ser on ser.symbol = s.symbol and ser.i = l.i""", "bars", "brk").replace("\n, shown as", ", shown as", 1))
def ind14(spark, sf):
    b = D.bars(spark, sf)
    breaks = B.last_breaks(b, P.break_low_ratio, P.break_high_ratio)
    return tidy(I.chart_ema(b, breaks, {"ema_short": P.ema_short, "ema_medium": P.ema_medium}, 400))


@query("ind15_close_jumps", sql("""
select symbol, trading_date, round(close / pc, 6) as close_ratio from ratios
where pc > 0 and (close / pc < 0.80 or close / pc > 1.25)""", "ratios"))
def ind15(spark, sf):
    return tidy(B.close_jumps(D.bars(spark, sf), P.break_low_ratio, P.break_high_ratio))


@query("ind16_point_in_time_break", sql("""
, f as (select *, case when pc > 0 and (close / pc < 0.80 or close / pc > 1.25) then trading_date end as bd,
        case when pc > 0 and (close / pc < 0.80 or close / pc > 1.25) then bar_index end as bi from ratios)
select symbol, trading_date, max(bd) over w as last_break, bar_index - max(bi) over w as bars_since_break from f
window w as (partition by symbol order by trading_date)""", "ratios").replace("\n, f as", ", f as", 1))
def ind16(spark, sf):
    out = B.point_in_time_breaks(D.bars(spark, sf), P.break_low_ratio, P.break_high_ratio)
    return tidy(out.select("symbol", "trading_date", "last_break", "bars_since_break"))


@query("ind18_prior_highs", sql("""
select symbol, trading_date, case when count(*) over a = 20 then round(max(high) over a, 6) end as prior_high_20,
  case when count(*) over b = 50 then round(max(high) over b, 6) end as prior_high_50 from bars
window a as (partition by symbol order by trading_date rows between 20 preceding and 1 preceding),
       b as (partition by symbol order by trading_date rows between 50 preceding and 1 preceding)""", "bars"))
def ind18(spark, sf):
    b = D.bars(spark, sf)
    for n in (20, 50):
        b = I.with_rolling_extreme(b, "high", n, f"prior_high_{n}", exclude_current=True)
    return tidy(b.select("symbol", "trading_date", "prior_high_20", "prior_high_50"))


@query("tk04_last_n", sql("""
select symbol, trading_date, close from (select *, row_number() over (partition by symbol order by trading_date desc) as z,
  count(*) over (partition by symbol) as n from bars) where n >= 530 and z <= 530""", "bars"))
def tk04(spark, sf):
    return B.last_n_if_enough(D.bars(spark, sf), 530).select("symbol", "trading_date", "close")


@query("tk10_stale_mark", sql("select symbol, status, reason from quality", "quality"))
def tk10(spark, sf):
    return FT.mark_stale(D.feature_quality(spark, sf), D.bars(spark, sf)).select("symbol", "status", "reason")


SCAN_VIEWS = """
scan as (select symbol, status, reason, break_date, last_date from (
  select q.* replace (case when status = 'VALID' and last_date < mx2 then 'STALE' else status end as status,
     case when status = 'VALID' and last_date < mx2 then concat('last observation ', cast(last_date as varchar), ', run as-of ', cast(mx2 as varchar)) else reason end as reason)
  from (select feat.*, max(last_date) over () as mx2 from feat join univ using (symbol)) q)
 union all
 select u.symbol, case when a.status = 'INSUFFICIENT_HISTORY' then a.status else 'FAILED' end,
   concat('acquisition ', coalesce(a.status, 'MISSING'), case when a.reason <> '' then concat(': ', a.reason) else '' end), null, null
 from univ u left join acq a using (symbol) where not exists (select 1 from bars b where b.symbol = u.symbol))"""


def scan_sql(text: str) -> str:
    head = sql("", "feat", "univ", "acq")
    return head.rstrip() + "," + SCAN_VIEWS + text


def _scan(spark, sf):
    b = D.bars(spark, sf)
    return FT.feature_scan(D.universe(spark, sf), b, D.benchmark(spark, sf, b), D.acquisition_results(spark, sf), P)


@query("cls03_symbols_without_bars", scan_sql("""
select symbol, status, reason, 0 as n_bars, false as w52_complete from scan where last_date is null"""))
def cls03(spark, sf):
    return FT.without_bars(D.universe(spark, sf), D.bars(spark, sf), D.acquisition_results(spark, sf))


@query("ag03_scan_summary", scan_sql("""
select count(*) filter (where status = 'VALID') as valid, count(*) filter (where status = 'INSUFFICIENT_HISTORY') as insufficient_history,
  count(*) filter (where status = 'STALE') as stale, count(*) filter (where status = 'FAILED') as failed,
  count(break_date) as flagged_breaks, max(last_date) as asof_date from scan"""))
def ag03(spark, sf):
    return FT.scan_summary(_scan(spark, sf))


@query("ag04_coverage", scan_sql("""
select count(*) as covered, count(distinct symbol) as symbols, (select count(*) from univ) as universe,
  count(*) = (select count(*) from univ) and count(distinct symbol) = (select count(*) from univ) as complete from scan"""))
def ag04(spark, sf):
    return FT.coverage(D.universe(spark, sf), _scan(spark, sf))
