"""Registered queries: calendars, classification, acquisition, runs."""
from __future__ import annotations

from pyspark.sql import functions as F

from barlab.operators import adjustment as A
from barlab.operators import bars as B
from barlab.operators import calendar as K
from barlab.operators import classify as C
from barlab.operators import runs as R
from barlab.operators import universe as U
from barlab.plans import derived as D
from barlab.plans.derived import PARAMS as P
from barlab.plans.oracle_views import sql
from barlab.plans.registry import query, tidy
from barlab.session import materialize

NOW = "2001-11-04 12:00:00"
WINDOW, REQUIRED = 100, 80
FETCHED = ("2001-06-01", "2001-07-31")


def day(text):
    return F.lit(text).cast("date")


def now():
    return F.lit(NOW).cast("timestamp")


def last_closed(spark, sf, weeks=None):
    weeks = D.weeks(spark, sf) if weeks is None else weeks
    return K.last_closed_session(weeks, now()).select("last_closed").scalar()


def window(spark, sf, weeks=None):
    weeks = D.weeks(spark, sf) if weeks is None else weeks
    return K.trailing_sessions(weeks, last_closed(spark, sf, weeks), WINDOW)


def sessions(spark, sf):
    cal = K.verified_calendar(D.span(spark, sf), D.holidays(spark, sf), D.resolutions(spark, sf))
    return cal.filter("is_session").select(F.col("date").alias("trading_date"))


@query("cal01_last_closed_session", sql("""
select count(distinct trading_date) as sessions, max(case when trading_date < date '2001-10-10' or trading_date = date '2001-10-10' and 19 >= 18 then trading_date end) as last_closed
from bench""", "bench"))
def cal01(spark, sf):
    bench = K.session_dates(D.benchmark(spark, sf))
    return K.last_closed_session(bench, F.lit("2001-10-10 19:00:00").cast("timestamp"))


@query("cal02_verified_calendar", sql("select * from cal", "cal"))
def cal02(spark, sf):
    return K.verified_calendar(D.span(spark, sf), D.holidays(spark, sf), D.resolutions(spark, sf))


@query("cal03_expected_session", """
select event_id, case isodow(d) when 7 then d - 2 when 6 then d - 1 else d end as expected_session
from (select event_id, cast(ts - interval 18 hour as date) as d from events)""")
def cal03(spark, sf):
    return K.with_expected_session(D.table(spark, sf, "events"), "ts").select("event_id", "expected_session")


@query("cal04_outdated", sql("""
select run_id, coalesce(latest_closed_session < case isodow(d) when 7 then d - 2 when 6 then d - 1 else d end, true) as outdated
from (select *, cast(started_at + interval 12 hour - interval 18 hour as date) as d from runs)""", "runs"))
def cal04(spark, sf):
    at = F.col("started_at") + F.expr("interval 12 hours")
    return D.scan_runs(spark, sf).select("run_id", K.outdated(F.col("latest_closed_session"), at).alias("outdated"))


@query("cal05_running_stale", sql("""
select run_id, status = 'RUNNING' and timestamp '1999-01-01 00:00:00' - started_at > interval 1 hour as running_stale from runs""", "runs"))
def cal05(spark, sf):
    at = F.lit("1999-01-01 00:00:00").cast("timestamp")
    return D.scan_runs(spark, sf).select("run_id", K.running_stale(F.col("status"), F.col("started_at"), at).alias("running_stale"))


@query("set02_calendar_differences", sql("select * from diffs", "diffs"))
def set02(spark, sf):
    open_days = materialize(sessions(spark, sf), "sessions")  # one row per day
    return K.calendar_differences(materialize(D.vendor_dates(spark, sf), "vendor"), open_days, materialize(D.span(spark, sf), "span"))


@query("jn16_reconciliation", sql("""
select d.*, d.date in (select date from res) or (d.date, d.instrument) in (select date, instrument from gaps) as resolved from diffs d""", "diffs", "gaps"))
def jn16(spark, sf):
    open_days = materialize(sessions(spark, sf), "sessions")  # one row per day
    return K.reconcile(materialize(D.vendor_dates(spark, sf), "vendor"), open_days, materialize(D.span(spark, sf), "span"), D.resolutions(spark, sf),
                       D.vendor_gaps(spark, sf))


@query("ag23_calendar_counts", sql("""
select 'total' as scope, '' as key, count(*) as sessions from cal where is_session
union all select 'type', session_type, count(*) from cal where is_session group by 2
union all select 'year', cast(year(date) as varchar), count(*) from cal where is_session group by 2""", "cal"))
def ag23(spark, sf):
    return K.calendar_counts(K.verified_calendar(D.span(spark, sf), D.holidays(spark, sf), D.resolutions(spark, sf)))


@query("snk3_calendar_manifest", sql("""
, f as (select count(*) as found, count(*) filter (where not (d.date in (select date from res) or (d.date, d.instrument) in (select date, instrument from gaps))) as unresolved from diffs d)
select 'sessions_total' as item, '' as key, cast(count(*) as varchar) as value from cal where is_session
union all select 'sessions_type', session_type, cast(count(*) as varchar) from cal where is_session group by 2
union all select 'sessions_year', cast(year(date) as varchar), cast(count(*) as varchar) from cal where is_session group by 2
union all select 'discrepancies', 'found', cast(found as varchar) from f union all select 'discrepancies', 'unresolved', cast(unresolved as varchar) from f
union all select 'status', '', case when unresolved = 0 then 'VALIDATED' else 'FAILED' end from f
union all select 'input_sha256', sha256(concat(coalesce(sector, 'none'), ',', count(*), ',', cast(sum(cast(balance as decimal(18,2))) as varchar), chr(10))), '1' from univ group by sector""",
    "cal", "diffs", "gaps", "res", "univ").replace("\n, f as", ", f as", 1))
def snk3_manifest(spark, sf):
    from barlab.plans.q_sources import src7
    cal = materialize(K.verified_calendar(D.span(spark, sf), D.holidays(spark, sf), D.resolutions(spark, sf)), "calendar")
    open_days = cal.filter("is_session").select(F.col("date").alias("trading_date"))
    found = K.reconcile(materialize(D.vendor_dates(spark, sf), "vendor"), open_days, materialize(D.span(spark, sf), "span"), D.resolutions(spark, sf), D.vendor_gaps(spark, sf))
    return K.calendar_manifest(K.calendar_counts(cal), found, src7(spark, sf))


@query("ag23_instrument_coverage", sql("""
select instrument, count(*) filter (where trading_date between first and last) as bars_in_span,
  (select count(*) from sess) - count(*) filter (where trading_date in (select date from sess)) as sessions_without_bar
from vend, span group by 1""", "vend", "span", "sess"))
def ag23_instruments(spark, sf):
    return K.instrument_coverage(D.vendor_dates(spark, sf), sessions(spark, sf), D.span(spark, sf))


@query("tk05_trailing_sessions", sql("select * from win", "win"))
def tk05(spark, sf):
    return window(spark, sf)


@query("set01_missing_sessions", sql("""
select symbol, available, m.trading_date as missing from (select symbol, count(*) filter (where trading_date in (select trading_date from win)) as available from wkv group by 1) a
left join (select s.symbol, w.trading_date from (select distinct symbol from wkv) s, win w where (s.symbol, w.trading_date) not in (select symbol, trading_date from wkv)) m using (symbol)""", "wkv", "win"))
def set01(spark, sf):
    from barlab.operators.quality import validate_candles
    valid = validate_candles(D.weekly_candles(spark, sf)).filter("status = 'VALID'")
    return tidy(K.missing_sessions(valid, window(spark, sf)))


@query("ag12_history_depth", sql("""
select min(trading_date) as first_date, max(trading_date) as last_date, count(distinct trading_date) as sessions,
  count(distinct symbol) as symbols, (select count(distinct trading_date) from bench) as benchmark_sessions from bars""", "bars", "bench"))
def ag12(spark, sf):
    b = D.bars(spark, sf)
    return K.history_depth(b, D.benchmark(spark, sf, b))


@query("ag15_date_fingerprint", sql("""
select symbol, min(trading_date) as first_bar, max(trading_date) as last_bar, count(*) as bars,
  sha256(string_agg(strftime(trading_date, '%Y-%m-%d'), chr(10) order by trading_date)) as dates_sha256 from bars group by 1""", "bars"))
def ag15(spark, sf):
    return tidy(K.date_fingerprint(D.bars(spark, sf)))


@query("ag25_depth_probe", sql("""
, g as (select *, lag(trading_date) over (partition by symbol order by trading_date) as pd from ratios),
gg as (select *, row_number() over (partition by symbol order by trading_date - pd desc nulls last, trading_date) as z from g)
select symbol, min(trading_date) as earliest, max(trading_date) as latest, count(*) as sessions, max(trading_date - pd) as largest_gap_days,
  max(case when z = 1 then pd end) as gap_from, max(case when z = 1 then trading_date end) as gap_to,
  count(*) filter (where isodow(trading_date) >= 6) as weekend_bars, count(*) filter (where pc > 0 and (close / pc < 0.80 or close / pc > 1.25)) as close_jumps
from gg group by 1""", "ratios").replace("\n, g as", ", g as", 1))
def ag25(spark, sf):
    return tidy(K.depth_probe(D.bars(spark, sf), P.break_low_ratio, P.break_high_ratio))


@query("jn07_under_review", sql("""
select distinct symbol from rev where review_state <> 'RESOLVED' and effective_date between date '2001-06-01' and date '2001-07-31'""", "rev"))
def jn07(spark, sf):
    return C.under_review(D.reviews(spark, sf), day(FETCHED[0]), day(FETCHED[1]))


@query("ind11_any_break", sql("select symbol, coalesce(jump, false) as price_break_detected from wkbrk", "wkbrk"))
def ind11(spark, sf):
    from barlab.functions.numeric import money2
    from barlab.operators.quality import validate_candles
    checked = validate_candles(D.weekly_candles(spark, sf)).select(
        "symbol", "trading_date", (F.col("status") == "VALID").alias("valid"), money2(F.col("close")).alias("close_2dp"))
    return B.any_break(checked, P.break_low_ratio, P.break_high_ratio)


@query("cls01_symbol_status", sql("select * from cls", "cls"))
def cls01(spark, sf):
    from barlab.operators.quality import validate_candles
    valid = validate_candles(D.weekly_candles(spark, sf)).filter("status = 'VALID'")
    symbols = D.universe(spark, sf).select("symbol")
    return C.classify(symbols, valid, window(spark, sf), last_closed(spark, sf), REQUIRED)


def scan(spark, sf, daily=None, symbol=None):
    """The calendar of weeks and its window are written once, a few hundred rows; the candles and the
    members of the universe too. With a symbol only its rows are read."""
    own = lambda df: df if symbol is None else df.filter(F.col("symbol") == symbol)
    weeks = materialize(D.weeks(spark, sf), "weeks")
    shown = materialize(window(spark, sf, weeks), "window")
    candles = materialize(own(D.weekly_candles(spark, sf, daily)), "candles")
    members = materialize(own(D.universe(spark, sf)), "members")
    master = D.instrument_master(spark, sf, members)
    return C.scan(U.eligible(members), U.isin_keys(master, F.col("listed")), D.fetch_failures(spark, sf, members),
                  candles, D.reviews(spark, sf), shown, last_closed(spark, sf, weeks),
                  day(FETCHED[0]), day(FETCHED[1]), REQUIRED, P.break_low_ratio, P.break_high_ratio)


@query("cls02_universe_scan", sql("select * from scanned", "scanned"))
def cls02(spark, sf):
    return scan(spark, sf)


@query("ag02_scan_counts", sql("""
select count(*) filter (where status <> 'FAILED') as successful, count(*) filter (where status = 'FAILED') as failed_symbols,
  count(*) filter (where status = 'VALID') as valid, count(*) filter (where status = 'INSUFFICIENT_HISTORY') as insufficient_history,
  count(*) filter (where status = 'STALE') as stale, count(*) filter (where status = 'FAILED') as failed,
  count(*) filter (where history_gaps) as history_gaps, count(*) filter (where corporate_action_review) as corporate_action_review,
  count(*) filter (where price_break_detected) as price_break_detected, count(*) filter (where non_eq_series) as non_eq_series from scanned""", "scanned"))
def ag02(spark, sf):
    return C.scan_counts(scan(spark, sf))


@query("cls04_acquisition_outcomes", sql("select * from outcomes", "outcomes"))
def cls04(spark, sf):
    return D.acquisition_outcomes(spark, sf)


@query("ag01_acquisition_report", sql("""
select count(*) filter (where status <> 'EXCLUDED') as universe_count, count(*) filter (where mapping_status = 'MAPPED') as mapped_count,
  count(*) filter (where mapping_status not in ('MAPPED', 'EXCLUDED_PLACEHOLDER')) as unmapped_count, count(*) filter (where status = 'EXCLUDED') as excluded_count,
  count(*) filter (where requested) as requested_count, count(*) filter (where status = 'SUCCESS') as successful_count,
  count(*) filter (where status = 'NO_DATA') as no_data_count, count(*) filter (where status = 'REQUEST_FAILED') as request_failed_count,
  count(*) filter (where status = 'VALIDATION_FAILED') as validation_failed_count, count(*) filter (where status = 'INSUFFICIENT_HISTORY') as insufficient_history_count,
  cast(sum(persisted_count) as bigint) as persisted_observation_count from outcomes""", "outcomes"))
def ag01(spark, sf):
    return C.acquisition_report(D.acquisition_outcomes(spark, sf))


EVENTS = """, ev as (select concat('run', cast(o_custkey as varchar)) as run_id, o_orderdate as ts_at, o_orderkey as seq,
  case o_orderstatus when 'F' then 'COMPLETE' when 'O' then 'RUNNING' else 'ABORTED' end as status,
  case when o_orderstatus = 'P' then 'CALENDAR_INVALID' end as abort_reason, case when o_orderstatus <> 'O' then o_orderdate end as finished_at,
  o_orderpriority as pr from orders)"""
EVENTS = "WITH" + EVENTS[1:]


@query("run01_run_state", EVENTS + """
select run_id, case when status = 'RUNNING' then 'ABORTED' else status end as status,
  case when status = 'RUNNING' then 'INTERRUPTED' else abort_reason end as abort_reason,
  cast(case when status = 'RUNNING' then timestamp '2002-01-01' else finished_at end as date) as finished
from (select *, row_number() over (partition by run_id order by ts_at desc, seq desc) as z from ev) where z = 1""")
def run01(spark, sf):
    state = R.run_state(D.run_events(spark, sf))
    out = R.interrupt_leftovers(state, F.lit("2002-01-01 00:00:00").cast("timestamp"))
    return out.select("run_id", "status", "abort_reason", F.to_date("finished_at").alias("finished"))


@query("run01_run_violations", EVENTS + """
, a as (select run_id, count(*) filter (where status = 'RUNNING') as s, count(*) filter (where status <> 'RUNNING') as e,
  count(*) filter (where status = 'COMPLETE' and pr in ('1-URGENT', '5-LOW')) as b,
  min(strftime(ts_at, '%Y%m%d') || lpad(cast(seq as varchar), 12, '0')) filter (where status = 'RUNNING') as fs,
  min(strftime(ts_at, '%Y%m%d') || lpad(cast(seq as varchar), 12, '0')) filter (where status <> 'RUNNING') as fe from ev group by 1)
select run_id, 'NOT_STARTED_ONCE' as violation from a where s <> 1 union all select run_id, 'FINISHED_TWICE' from a where e > 1
union all select run_id, 'FINISHED_BEFORE_START' from a where fe < fs union all select run_id, 'COMPLETE_WITHOUT_VERSIONS' from a where b > 0""")
def run01_violations(spark, sf):
    return R.run_violations(D.run_events(spark, sf))


@query("run02_feature_context", sql("""
select run_id, latest_closed_session as run_session, asof_date, coalesce(latest_closed_session = asof_date, false) as as_of_matches_run
from (select run_id, cast(started_at as date) - case when requested < 250000 then 1 else 2 end as asof_date from runs) left join runs using (run_id)""", "runs"))
def run02(spark, sf):
    runs = D.scan_runs(spark, sf)
    scans = runs.select("run_id", F.date_sub(F.to_date("started_at"), F.when(F.col("requested") < 250000, 1).otherwise(2)).alias("asof_date"))
    return R.feature_context(scans, runs).select("run_id", "run_session", "asof_date", "as_of_matches_run")


@query("run03_run_summary", """
select concat('run', o_orderkey) as run_id, case o_orderstatus when 'F' then 'COMPLETE' when 'O' then 'RUNNING' else 'ABORTED' end as status,
  case when o_orderpriority <> '1-URGENT' then 'FULL' else 'SMOKE (2 symbols)' end as scan_label, cast(floor(o_totalprice / 1000) as bigint) as valid, cast(o_custkey as bigint) as failed,
  case when o_orderstatus <> 'P' then cast(o_custkey % 10 as bigint) end as history_gaps, case when o_orderpriority = '2-HIGH' then 'DUMMY1,DUMMY2' end as excluded,
  case when o_orderstatus = 'P' then 'calendar: closed' end as errors, strftime(o_orderdate, '%Y-%m-%d') as calendar_date from orders""")
def run03(spark, sf):
    get = lambda column, key: F.try_element_at(column, F.lit(key))
    return R.summarize(D.scan_runs(spark, sf)).select(
        "run_id", "status", "scan_label", get("status_counts", "VALID").alias("valid"), get("status_counts", "FAILED").alias("failed"),
        get("flag_counts", "history_gaps").alias("history_gaps"), F.array_join("excluded_symbols", ",").alias("excluded"), F.array_join("errors", ",").alias("errors"),
        F.get("calendar_dates", F.lit(0)).alias("calendar_date"))


@query("tk01_latest_complete_run", sql("""
select run_id, cast(started_at as date) as started from runs where status = 'COMPLETE' and symbols_filter_json is null order by started_at desc, run_id limit 1""", "runs"))
def tk01(spark, sf):
    return R.latest_complete(D.scan_runs(spark, sf)).select("run_id", F.to_date("started_at").alias("started"))


@query("tk02_latest_feature_scan", sql("""
select run_id, cast(started_at as date) as started from runs where status = 'COMPLETE' order by started_at desc, run_id limit 1""", "runs"))
def tk02(spark, sf):
    return R.latest_complete(D.scan_runs(spark, sf), full_only=False).select("run_id", F.to_date("started_at").alias("started"))


@query("tk03_usable_acquisition", """
select concat('acq', o_orderkey) as run_id, cast(floor(o_totalprice / 1000) as bigint) as universe_count from orders
where o_orderstatus = 'F' and o_orderpriority not in ('1-URGENT', '2-HIGH') and floor(o_totalprice / 1000) >= 450
order by o_orderdate desc, 1 limit 1""")
def tk03(spark, sf):
    return R.usable_acquisition(D.acquisition_runs(spark, sf), 450).select("run_id", "universe_count")


@query("tk07_run_page", sql("""
select run_id, cast(started_at as date) as started, (select count(*) from runs) as total from runs order by started_at desc, run_id limit 25 offset 50""", "runs"))
def tk07(spark, sf):
    rows = D.scan_runs(spark, sf)
    return R.page(rows, [F.desc("started_at"), F.asc("run_id")], 3, 25).select("run_id", F.to_date("started_at").alias("started"), "total")


@query("flt19_point_lookup", sql("select run_id, status, requested from runs where run_id = 'run42'", "runs"))
def flt19(spark, sf):
    return D.scan_runs(spark, sf).filter(F.col("run_id") == "run42").select("run_id", "status", "requested")


@query("vw5_scan_history", sql("""
select run_id, status, case when symbols_filter_json is null then 'FULL' else 'SMOKE (2 symbols)' end as scan_label,
  status = 'RUNNING' and timestamp '2001-08-01 00:30:00' - started_at > interval 1 hour as running_stale_warning, (select count(*) from runs) as total
from runs order by started_at desc, run_id limit 25""", "runs"))
def vw5(spark, sf):
    at = F.lit("2001-08-01 00:30:00").cast("timestamp")
    paged = R.page(D.scan_runs(spark, sf), [F.desc("started_at"), F.asc("run_id")], 1, 25)
    return R.summarize(paged).select("run_id", "status", "scan_label",
                                     K.running_stale(F.col("status"), F.col("started_at"), at).alias("running_stale_warning"), "total")


@query("jn14_across_ex_date", sql("""
, e as (select concat('S', lpad(cast(o_custkey as varchar), 6, '0')) as symbol, cast(o_orderdate as date) as ex_date, case when o_orderpriority = '1-URGENT' then 2.0::double else 5.0::double end as price_divisor
  from orders group by 1, 2, 3),
x as (select e.*, (select max(trading_date) from bars b where b.symbol = e.symbol and trading_date < ex_date) as db, (select min(trading_date) from bars b where b.symbol = e.symbol and trading_date >= ex_date) as da from e)
select x.symbol, ex_date, price_divisor, db as date_before, b.close as close_before, da as date_on_or_after, a.close as close_on_or_after, round(a.close / b.close, 6) as observed_ratio,
  1 / price_divisor as unadjusted_expected_ratio, round(abs(a.close / b.close - 1), 6) as distance_to_adjusted, round(abs(a.close / b.close - 1 / price_divisor), 6) as distance_to_unadjusted,
  a.close is not null and b.close is not null as conclusive
from x left join bars b on b.symbol = x.symbol and b.trading_date = db left join bars a on a.symbol = x.symbol and a.trading_date = da""", "bars").replace("\n, e as", ", e as", 1))
def jn14(spark, sf):
    divisor = F.when(F.col("o_orderpriority") == "1-URGENT", 2.0).otherwise(5.0)
    events = D.table(spark, sf, "orders").select(D.symbol_of(F.col("o_custkey")).alias("symbol"), F.to_date("o_orderdate").alias("ex_date"),
                                                 divisor.alias("price_divisor")).distinct()
    return tidy(A.compare_across_events(D.bars(spark, sf), events))
