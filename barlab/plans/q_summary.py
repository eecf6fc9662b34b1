"""Registered queries: summaries, explorer, order statistics, composed views."""
from __future__ import annotations

from pyspark.sql import functions as F

from barlab.operators import bars as B
from barlab.operators import calendar as K
from barlab.operators import explorer as X
from barlab.operators import features as FT
from barlab.operators import indicators as I
from barlab.operators import quality as Q
from barlab.operators import ranking as RK
from barlab.operators import runs as R
from barlab.operators import summary as S
from barlab.plans import derived as D
from barlab.plans.derived import PARAMS as P
from barlab.plans.oracle_views import ema_sql, sql, view
from barlab.plans.q_calendar import scan
from barlab.plans.registry import query, tidy
from barlab.session import materialize

PERIODS = {"short": P.ema_short, "medium": P.ema_medium, "long": P.ema_long}
view("frow", "select f.*, s.sector from feat f left join scanned s using (symbol)", "feat", "scanned")


def rows(spark, sf, daily=None):
    daily = D.stored_bars(spark, sf) if daily is None else daily
    return S.feature_rows(D.feature_quality(spark, sf, daily), scan(spark, sf, daily), daily)


def plain_rows(spark, sf, daily=None):
    """Feature rows without the scan, where no sector is needed."""
    daily = D.stored_bars(spark, sf) if daily is None else daily
    closes = daily.groupBy("symbol", F.col("trading_date").alias("last_date")).agg(F.max("close").alias("close"))
    return D.feature_quality(spark, sf, daily).join(closes, ["symbol", "last_date"], "left")


@query("jn04_feature_rows", sql("""
select symbol, sector, last_date, close, round(rsi, 6) as rsi, round(ema_long, 6) as ema_long from frow""", "frow"))
def jn04(spark, sf):
    return tidy(rows(spark, sf).select("symbol", "sector", "last_date", "close", "rsi", "ema_long"))


@query("jn05_features_of_symbols", sql("""
select symbol, last_date, close, break_date, round(break_ratio, 6) as break_ratio, round(rsi, 6) as rsi from feat
where symbol in (select symbol from rev where review_state = 'OPEN')""", "feat", "rev"))
def jn05(spark, sf):
    daily = D.stored_bars(spark, sf)
    f = materialize(D.feature_quality(spark, sf, daily))
    wanted = D.reviews(spark, sf).filter("review_state = 'OPEN'")
    out = S.features_of(wanted, f.drop("break_date", "break_ratio"), f, daily)
    return tidy(out.select("symbol", "last_date", "close", "break_date", "break_ratio", "rsi"))


@query("ag05_breadth", sql(" union all ".join(f"""
select '{k}' as label, {p} as period, count(*) filter (where close > ema_{k}) as count, count(*) filter (where ema_{k} is not null and close is not null) as "of",
 round(count(*) filter (where close > ema_{k}) * 100.0::double / nullif(count(*) filter (where ema_{k} is not null and close is not null), 0), 1) as pct from feat""" for k, p in PERIODS.items()), "feat"))
def ag05(spark, sf):
    return tidy(S.breadth(plain_rows(spark, sf), PERIODS))


@query("ag06_rsi_histogram", sql("""
select i * 10 as lo, i * 10 + 10 as hi, (select count(*) from feat where least(floor(rsi / 10), 9) = i) as count from range(10) t(i)""", "feat"))
def ag06(spark, sf):
    return tidy(S.rsi_histogram(D.feature_quality(spark, sf)))


@query("ag06_rsi_summary", sql('select count(rsi) as "of", round(median(rsi), 4) as median from feat', "feat"))
def ag06_summary(spark, sf):
    return S.rsi_summary(materialize(D.feature_quality(spark, sf)))


@query("ag07_roc_summary", sql("""
select count(*) filter (where roc > 0) as positive, count(roc) as "of", round(median(roc), 4) as median,
  round(count(*) filter (where roc > 0) * 100.0::double / count(roc), 1) as pct from feat""", "feat"))
def ag07(spark, sf):
    return S.roc_summary(materialize(D.feature_quality(spark, sf)))


@query("ag08_high_proximity", sql("""
select count(distance_from_high) as "of", count(*) filter (where distance_from_high <= 0) as at_high,
 count(*) filter (where distance_from_high is null) as no_value, round(median(distance_from_high), 4) as median from feat""", "feat"))
def ag08(spark, sf):
    return S.high_proximity(materialize(D.feature_quality(spark, sf)))


@query("ag08_distance_buckets", sql("""
select lo, hi, (select count(*) from feat where distance_from_high >= lo and (hi is null or distance_from_high < hi)) as count
from (values (0, 2), (2, 5), (5, 10), (10, 20), (20, null)) t(lo, hi)""", "feat"))
def ag08_buckets(spark, sf):
    return tidy(S.distance_buckets(D.feature_quality(spark, sf)))


STRENGTH = """
select coalesce(sector, 'UNKNOWN') as sector, count(*) as n, count(*) filter (where close > ema_medium) as above,
  count(*) filter (where ema_medium is not null and close is not null) as "of",
  round(count(*) filter (where close > ema_medium) * 100.0::double / nullif(count(*) filter (where ema_medium is not null and close is not null), 0), 1) as above_pct,
  round(median(roc), 4) as median_roc, round(median(relative_return), 4) as median_relative_return,
  round(median(distance_from_high), 4) as median_distance_from_high from frow group by 1"""


def unnamed(df):
    """A sector that the files leave empty."""
    return df.withColumn("sector", F.when(F.col("sector") == "AFRICA", "").otherwise(F.col("sector")))


@query("ag09_sector_strength", sql(STRENGTH.replace("coalesce(sector, 'UNKNOWN')", "coalesce(nullif(sector, 'AFRICA'), 'UNKNOWN')"), "frow"))
def ag09(spark, sf):
    return S.sector_strength(materialize(unnamed(rows(spark, sf))))


STATUS_PIVOT = """
select coalesce(sector, 'UNKNOWN') as sector, count(*) filter (where status = 'VALID') as valid, count(*) filter (where status = 'INSUFFICIENT_HISTORY') as insufficient_history,
  count(*) filter (where status = 'STALE') as stale, count(*) filter (where status = 'FAILED') as failed, count(*) as total from scanned group by 1"""


@query("ag10_sector_status", sql(STATUS_PIVOT.replace("coalesce(sector, 'UNKNOWN')", "coalesce(nullif(sector, 'AFRICA'), 'UNKNOWN')"), "scanned"))
def ag10(spark, sf):
    return S.sector_status(unnamed(scan(spark, sf)))


view("warned", """
select r.symbol, company_name, sector, r.status, place, code, message from scanned r left join quality q on q.symbol = r.symbol,
lateral (select case when q.break_date is not null then concat(cast(q.break_date as varchar), printf(' (close ratio %.4f)', q.break_ratio)) end as bon) x,
lateral (values
 (0, r.status, coalesce(status_reason, 'no reason recorded by the scanner'), r.status <> 'VALID'),
 (1, 'history_gaps', printf('%d missing session(s); %d available', coalesce(missing, 0), coalesce(available, 0)), history_gaps),
 (2, 'corporate_action_review', 'listed in the corporate-action review file (version v1)', corporate_action_review),
 (3, 'price_break_detected', concat('close-to-close jump consistent with an unadjusted split/bonus', coalesce(concat('; E4 break on ', nullif(bon, '')), '')), price_break_detected),
 (4, 'non_eq_series', concat('series ', series, ' is not EQ'), non_eq_series),
 (5, concat('e4_', q.status), q.reason, q.status <> 'VALID'),
 (6, 'e4_no_full_high_window', 'fewer than 252 bars: the high-window distance is unavailable', not w52_complete),
 (7, 'e4_volume_unusable', 'volume history not usable: relative volume unavailable', not volume_usable),
 (8, 'e4_break', concat('E4 detected a break on ', bon, '; indicators use later bars only'), bon <> '' and not price_break_detected)) w(place, code, message, hit)
where hit""".replace("coalesce(concat('; E4 break on ', nullif(bon, '')), '')", "case when bon <> '' then concat('; E4 break on ', bon) else '' end"),
     "scanned", "quality")


def warned(spark, sf, daily=None, features=None):
    """features: the feature rows, where the caller has them already."""
    daily = D.stored_bars(spark, sf) if daily is None else daily
    quality = FT.mark_stale(D.feature_quality(spark, sf, daily) if features is None else features, daily)
    return S.warnings(scan(spark, sf, daily), quality, "v1", P.high_window)


@query("ag11_warning_list", sql("select symbol, company_name, sector, status, code, message from warned", "warned"))
def ag11(spark, sf):
    return S.issues(warned(spark, sf)).drop("place")


@query("ag11_warning_counts", sql("select code, count(*) as n from warned group by 1", "warned"))
def ag11_counts(spark, sf):
    return S.warning_counts(warned(spark, sf))


@query("ag11_warning_totals", sql("""
select (select count(*) from scanned) as symbols_total, count(distinct symbol) as symbols_with_warnings,
  (select count(*) from scanned) - count(distinct symbol) as symbols_without_warning from warned""", "warned"))
def ag11_totals(spark, sf):
    return S.warning_totals(warned(spark, sf))


COPIES = """, copies as (select symbol, trading_date, close, volume from bars union all select symbol, trading_date, close * 1.5, volume - 1 from bars where volume > 25)
"""


@query("ag13_chart_bars", sql(COPIES + """select symbol, trading_date, round(c, 6) as close, v as volume from
(select symbol, trading_date, max(close) as c, max(volume) as v, row_number() over (partition by symbol order by trading_date desc) as z from copies group by 1, 2) where z <= 400""", "bars").replace("\n, copies", ", copies", 1))
def ag13(spark, sf):
    b = D.bars(spark, sf).select("symbol", "trading_date", "close", "volume")
    again = b.filter("volume > 25").withColumn("close", F.col("close") * 1.5).withColumn("volume", F.col("volume") - 1)
    return tidy(B.chart_bars(b.unionByName(again), 400))


view("aruns", """
select concat('acq', o_custkey) as run_id, max(o_orderdate) as started_at, 'COMPLETE' as status from orders where o_orderstatus = 'F' group by 1""")
view("aout", """
select concat('acq', o_custkey) as run_id, concat('O', o_orderkey) as symbol, case when o_totalprice < 100000 then 'INSUFFICIENT_HISTORY' when o_totalprice < 200000 then 'NO_DATA' else 'SUCCESS' end as status from orders""")
LATEST_RUN = "run_id = (select run_id from aruns order by started_at desc, run_id desc limit 1)"


def run_outcomes(spark, sf):
    o = D.table(spark, sf, "orders").withColumn("run_id", F.concat(F.lit("acq"), F.col("o_custkey").cast("string")))
    runs = o.filter("o_orderstatus = 'F'").groupBy("run_id").agg(F.max("o_orderdate").alias("started_at")) \
        .withColumn("status", F.lit("COMPLETE"))
    status = F.when(F.col("o_totalprice") < 100000, "INSUFFICIENT_HISTORY").when(F.col("o_totalprice") < 200000, "NO_DATA") \
        .otherwise("SUCCESS")
    return runs, o.select("run_id", F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("symbol"), status.alias("status"))


@query("ag14_acquisition_status", sql(f"select run_id, status, count(*) as n from aout where {LATEST_RUN} group by 1, 2", "aruns", "aout"))
def ag14(spark, sf):
    return S.acquisition_status(*run_outcomes(spark, sf))


@query("ag14_short_histories", sql(f"select * from aout where {LATEST_RUN} and status = 'INSUFFICIENT_HISTORY'", "aruns", "aout"))
def ag14_short(spark, sf):
    return S.short_histories(*run_outcomes(spark, sf))


# --- explorer ------------------------------------------------------------------------------

SCREEN = X.Screen(text="supplier", flag="history_gaps", ranges={"rsi": (30.0, 70.0), "rvol": (None, 5.0)}, sort="rsi", direction="desc")


@query("flt17_screen_filter", sql("""
select s.symbol, s.status, round(rsi, 6) as rsi from scanned s left join feat f on f.symbol = s.symbol
where (s.symbol ilike '%supplier%' or company_name ilike '%supplier%') and history_gaps and rsi >= 30 and rsi <= 70 and relative_volume <= 5""", "scanned", "feat"))
def flt17(spark, sf):
    daily = D.stored_bars(spark, sf)
    return tidy(X.screen_rows(scan(spark, sf, daily), D.feature_quality(spark, sf, daily), SCREEN).select("symbol", "status", "rsi"))


@query("flt17_unknown_sector", sql("select symbol, status from scanned where sector is null", "scanned"))
def flt17_sector(spark, sf):
    return X.screen_rows(scan(spark, sf), None, X.Screen(sector="UNKNOWN")).select("symbol", "status")


@query("flt18_guarded_screen", sql("select symbol, company_name from scanned where status = 'FAILED' order by company_name desc, symbol limit 10", "scanned"))
def flt18(spark, sf):
    for wrong in (X.Screen(sort="price"), X.Screen(direction="up"), X.Screen(status="OK"), X.Screen(flag="x"),
                  X.Screen(ranges={"rsi": (float("nan"), None)}), X.Screen(ranges={"pe": (1.0, None)})):
        try:
            wrong.check(True)
        except ValueError:
            continue
        raise AssertionError(f"{wrong} was accepted")
    chosen = X.Screen(status="FAILED", sort="company_name", direction="desc")
    return X.explore(scan(spark, sf), None, chosen, 1, 10).select("symbol", "company_name")


@query("jn06_explorer_join", sql("""
select s.symbol, s.status, round(rsi, 6) as rsi, round(roc, 6) as roc from scanned s left join feat f on f.symbol = s.symbol""", "scanned", "feat"))
def jn06(spark, sf):
    daily = D.stored_bars(spark, sf)
    return tidy(X.screen_rows(scan(spark, sf, daily), D.feature_quality(spark, sf, daily), X.Screen()).select("symbol", "status", "rsi", "roc"))


@query("tk06_explorer_sort", sql("""
select s.symbol, round(distance_from_high, 6) as distance_from_high, row_number() over (order by distance_from_high desc nulls last, s.symbol) - 1 as place
from scanned s left join feat f on f.symbol = s.symbol""", "scanned", "feat"))
def tk06(spark, sf):
    screen = X.Screen(sort="distance_from_high", direction="desc")
    daily = D.stored_bars(spark, sf)
    found = X.screen_rows(scan(spark, sf, daily), D.feature_quality(spark, sf, daily), screen).select("symbol", "distance_from_high")
    return tidy(RK.positions(found, X.screen_order(screen), "place"))


@query("vw2_explorer_page", sql("""
select s.symbol, s.status, s.sector, round(rsi, 6) as rsi, f.close, f.break_date, count(*) over () as total from scanned s left join feat f on f.symbol = s.symbol
where coalesce(s.sector, '') <> '' and rsi >= 20 and s.sector = 'ASIA' order by rsi nulls last, s.symbol limit 5 offset 5""", "scanned", "feat"))
def vw2(spark, sf):
    daily = D.stored_bars(spark, sf)
    f, results = materialize(D.feature_quality(spark, sf, daily)), materialize(scan(spark, sf, daily))
    screen = X.Screen(sector="ASIA", ranges={"rsi": (20.0, None)}, sort="rsi")
    paged = X.explore(results, f, screen, 2, 5).select("symbol", "status", "sector", "rsi", "total")
    more = S.features_of(paged, f.select("symbol", "last_date"), f, daily).select("symbol", "close", "break_date")
    return tidy(paged.join(more, "symbol", "left"))


@query("tk08_latest_snapshots", sql("""
select symbol, trading_date, status, content_hash from (select *, case when missing or found <> '' then 'INVALID' else 'VALID' end as status,
  row_number() over (partition by symbol order by trading_date desc) as z from checked) where z <= 90""", "checked"))
def tk08(spark, sf):
    return S.latest_snapshots(Q.snapshots(D.raw_candles(spark, sf)), 90).select("symbol", "trading_date", "status", "content_hash")


@query("tk08_symbol_snapshots", sql("""
select trading_date, content_hash from checked where symbol = 'S000007' order by trading_date desc limit 20""", "checked"))
def tk08_symbol(spark, sf):
    return S.symbol_snapshots(Q.snapshots(D.raw_candles(spark, sf)), "S000007", 20).select("trading_date", "content_hash")


# --- order statistics ------------------------------------------------------------------------

@query("fn06_exact_median", """
select l_returnflag, round(median(l_extendedprice), 4) as median_l_extendedprice, round(median(l_quantity), 4) as median_l_quantity from lineitem group by 1""")
def fn06(spark, sf):
    return RK.exact_medians(D.table(spark, sf, "lineitem"), ["l_returnflag"], ["l_extendedprice", "l_quantity"])


@query("tk09_stratified_sample", """
with o as (select c_mktsegment, cast(c_custkey as varchar) as id, row_number() over (order by c_mktsegment, sha256('seed-v1' || c_custkey)) - 1 as p, count(*) over () as n from customer)
select c_mktsegment, id from o where p in (select cast(floor(i * (cast(n as double) / 90)) as bigint) from range(90) t(i))""")
def tk09(spark, sf):
    c = D.table(spark, sf, "customer").select("c_mktsegment", F.col("c_custkey").cast("string").alias("id"))
    return RK.stratified_sample(c, "c_mktsegment", "id", "seed-v1", 90).select("c_mktsegment", "id")


@query("tk11_decile_bins", """
select event_id, (row_number() over (order by value, event_id) - 1) * 10 // count(*) over () as bin from events""")
def tk11(spark, sf):
    e = D.table(spark, sf, "events").select("event_id", "value")
    return RK.decile_bins(e, [F.asc("value"), F.asc("event_id")]).select("event_id", "bin")


# --- composed views ------------------------------------------------------------------------------

@query("vw1_summary", sql("""
, lr as (select * from runs where status = 'COMPLETE' and symbols_filter_json is null order by started_at desc, run_id limit 1)
select 'run' as section, run_id as item, cast(requested as double) as value from lr
union all select 'outdated', 'outdated', case when coalesce(latest_closed_session < date '2001-08-01', true) then 1.0 else 0.0 end from lr
union all select 'breadth', 'short', cast(count(*) filter (where close > ema_short) as double) from feat
union all select 'breadth', 'medium', cast(count(*) filter (where close > ema_medium) as double) from feat
union all select 'breadth', 'long', cast(count(*) filter (where close > ema_long) as double) from feat
union all select 'median', 'rsi', round(median(rsi), 4) from feat
union all select 'median', 'distance_from_high', round(median(distance_from_high), 4) from feat
union all select 'history', 'sessions', cast(count(distinct trading_date) as double) from bars
union all select 'history', 'symbols', cast(count(distinct symbol) as double) from bars
union all select 'warnings', code, cast(count(*) as double) from warned group by 2""", "runs", "warned", "feat").replace("\n, lr as", ", lr as", 1))
def vw1(spark, sf):
    item = lambda df, section, name, value: df.select(F.lit(section).alias("section"), name.alias("item"),
                                                      value.cast("double").alias("value"))
    latest = R.latest_complete(D.scan_runs(spark, sf))
    at = F.lit("2001-08-01 20:00:00").cast("timestamp")
    daily = D.stored_bars(spark, sf)
    table = materialize(summed(spark, sf, daily), "summary")
    depth = K.history_depth(daily, D.benchmark(spark, sf, daily))
    sessions, symbols = F.struct(F.lit("sessions").alias("item"), F.col("sessions").alias("n")), F.struct(F.lit("symbols").alias("item"), F.col("symbols").alias("n"))
    shown = F.col("view").isin("breadth_above", "warning") | ((F.col("view") == "median") & F.col("item").isin("rsi", "distance_from_high"))
    section = F.when(F.col("view") == "breadth_above", "breadth").when(F.col("view") == "warning", "warnings").otherwise(F.col("view"))
    run = F.struct(F.lit("run").alias("section"), F.col("run_id").alias("item"), F.col("requested").cast("double").alias("value"))
    old = F.struct(F.lit("outdated").alias("section"), F.lit("outdated").alias("item"), K.outdated(F.col("latest_closed_session"), at).cast("double").alias("value"))
    counted = table.filter(F.col("sector").isNull() & shown).select(section.alias("section"), "item", "value")
    none = spark.range(1).select(F.explode(F.array(*[F.lit(k) for k in PERIODS])).alias("item")).join(counted.filter("section = 'breadth'"), "item", "left_anti")
    return (latest.select(F.explode(F.array(run, old)).alias("x")).select("x.*").unionByName(counted)
            .unionByName(item(none, "breadth", F.col("item"), F.lit(0)))
            .unionByName(item(depth.select(F.explode(F.array(sessions, symbols)).alias("x")), "history", F.col("x.item"), F.col("x.n"))))


def summed(spark, sf, daily):
    """The summary table of the scan and the features, both computed once."""
    features = materialize(D.feature_quality(spark, sf, daily), "features")
    results = materialize(warned(spark, sf, daily, features), "warned")
    return S.summary_table(materialize(S.feature_rows(features, results, daily), "rows"), results, PERIODS)


_SCOPED = "(select f.*, coalesce(nullif(s.sector, ''), 'UNKNOWN') as sec from feat f left join scanned s using (symbol))"
_COUNTED = [("symbols", "''", "true"), ("rsi_of", "''", "rsi is not null"), ("roc_of", "''", "roc is not null"), ("roc_positive", "''", "roc > 0"),
            ("distance_of", "''", "distance_from_high is not null"), ("at_high", "''", "distance_from_high <= 0"), ("no_distance", "''", "distance_from_high is null"),
            ("rsi_bin", "cast(cast(least(floor(rsi / 10), 9) as int) * 10 as varchar)", "rsi is not null"),
            *[(v, f"'{k}'", c.format(k)) for k in PERIODS for v, c in (("breadth_of", "ema_{0} is not null and close is not null"), ("breadth_above", "close > ema_{0}"))],
            *[("distance_bucket", f"'{lo}'", f"distance_from_high >= {lo}" + ("" if hi is None else f" and distance_from_high < {hi}")) for lo, hi in S.DISTANCE_EDGES]]


@query("vw1_summary_table", sql(f"""
, f as {_SCOPED},
facts as ({' union all '.join(f"select sec, '{v}' as view, {i} as item from f where {c}" for v, i, c in _COUNTED)}
 union all select coalesce(nullif(sector, ''), 'UNKNOWN'), 'status', status from scanned union all select coalesce(nullif(sector, ''), 'UNKNOWN'), 'warning', code from warned),
m as (unpivot (select sec, median(rsi) as rsi, median(roc) as roc, median(distance_from_high) as distance_from_high, median(relative_return) as relative_return from f group by grouping sets ((), (sec)))
 on rsi, roc, distance_from_high, relative_return into name item value value)
select sec as sector, view, item, cast(count(*) as double) as value from facts group by grouping sets ((view, item), (sec, view, item))
union all select sec, 'median', item, round(value, 4) from m where value is not null""", "feat", "scanned", "warned").replace("\n, f as", ", f as", 1))
def vw1_table(spark, sf):
    return tidy(summed(spark, sf, D.stored_bars(spark, sf)))


@query("vw3_sector_overview", sql(f"""
, a as ({STATUS_PIVOT}), b as ({STRENGTH}) select a.*, n, above_pct, median_roc from a left join b using (sector)""", "frow", "scanned").replace("\n, a as", ", a as", 1))
def vw3(spark, sf):
    daily = D.stored_bars(spark, sf)
    results = materialize(scan(spark, sf, daily))
    strength = S.sector_strength(materialize(S.feature_rows(D.feature_quality(spark, sf, daily), results, daily)))
    return S.sector_status(results).join(strength.select("sector", "n", "above_pct", "median_roc"), "sector", "left")


DETAIL = f"""
, shown as (select b.*, break_date from (select *, row_number() over (partition by symbol order by trading_date desc) as z from bars) b join brk using (symbol) where z <= 400),
liv as (select symbol, list(close order by trading_date) as c from shown where break_date is null or trading_date >= break_date group by 1)
select s.symbol, s.status, s.sector, s.instrument_key, s.isin, s.series, f.last_date, round(rsi, 6) as rsi, f.close, f.break_date,
  (select count(*) from warned w where w.symbol = s.symbol) as n_warnings, round({ema_sql('c', 20)}, 6) as chart_ema_short,
  (select nullif(least(count(*), 90), 0) from raw where raw.symbol = s.symbol) as n_candles
from scanned s left join feat f on f.symbol = s.symbol left join liv on liv.symbol = s.symbol"""
NEEDS = ("scanned", "feat", "warned", "brk", "raw")


def detail(spark, sf, symbol=None):
    """The rows of the detail view; of one symbol only its bars are read after the benchmark and the run's last day."""
    every = D.stored_bars(spark, sf)
    daily = every if symbol is None else materialize(every.filter(F.col("symbol") == symbol), "bars")
    f = materialize(FT.compute_features(daily, D.benchmark(spark, sf, every), P), "features")
    breaks = B.last_breaks(daily, P.break_low_ratio, P.break_high_ratio)
    chart = I.chart_ema(daily, breaks, {"chart_ema_short": P.ema_short}, 400)
    chart = chart.groupBy("symbol").agg(F.max_by("chart_ema_short", "trading_date").alias("chart_ema_short"))
    candles = S.latest_snapshots(Q.snapshots(D.raw_candles(spark, sf, daily)), 90).groupBy("symbol").agg(
        F.count(F.lit(1)).alias("n_candles"))
    more = S.features_of(f, f.drop("break_date", "break_ratio"), f, daily).select("symbol", "last_date", "rsi", "close", "break_date")
    quality = FT.mark_stale(f, every)
    w = S.warnings(scan(spark, sf, daily, symbol), quality, "v1", P.high_window).select(
        "symbol", "status", "sector", "instrument_key", "isin", "series", F.size("warnings").alias("n_warnings"))
    return tidy(w.join(more, "symbol", "left").join(chart, "symbol", "left").join(candles, "symbol", "left"))


@query("vw4_stock_detail", sql(DETAIL, *NEEDS).replace("\n, shown as", ", shown as", 1))
def vw4(spark, sf):
    return detail(spark, sf)


@query("vw4_one_stock", sql(DETAIL + " where s.symbol = 'S000007'", *NEEDS).replace("\n, shown as", ", shown as", 1))
def vw4_one(spark, sf):
    return detail(spark, sf, "S000007")


@query("vw4_stock_candles", sql("""
select symbol, trading_date, cast(open as varchar) as open, cast(high as varchar) as high, cast(low as varchar) as low, cast(close as varchar) as close, volume, status, errors, content_hash from
 (select *, case when missing or found <> '' then 'INVALID' else 'VALID' end as status, case when missing then 'MISSING_FIELD' else found end as errors,
   row_number() over (partition by symbol order by trading_date desc) as z from checked) where z <= 90""", "checked"))
def vw4_candles(spark, sf):
    shown = S.latest_snapshots(Q.snapshots(D.raw_candles(spark, sf)), 90)
    return shown.select("symbol", "trading_date", "open", "high", "low", "close", "volume", "status", F.array_join("errors", ",").alias("errors"), "content_hash")


@query("vw4_fetch_history", sql("""
select symbol, run_id, trading_date, fetched_at, status from (select *, concat('y', year(trading_date)) as run_id, trading_date + 1 as fetched_at, case when missing or found <> '' then 'INVALID' else 'VALID' end as status,
  row_number() over (partition by symbol order by trading_date desc) as z from checked) where z <= 20""", "checked"))
def vw4_history(spark, sf):
    kept = Q.snapshots(D.raw_candles(spark, sf)).withColumn("run_id", F.concat(F.lit("y"), F.year("trading_date").cast("string"))) \
        .withColumn("fetched_at", F.date_add("trading_date", 1))
    return S.fetch_history(kept, 20).select("symbol", "run_id", "trading_date", "fetched_at", "status")


@query("vw4_stock_chart", sql(f"""
, shown as (select b.*, break_date, row_number() over (partition by symbol order by trading_date) as i from (select *, row_number() over (partition by symbol order by trading_date desc) as z from bars) b join brk using (symbol) where z <= 400),
liv as (select symbol, trading_date, row_number() over (partition by symbol order by trading_date) as j from shown where break_date is null or trading_date >= break_date),
arr as (select symbol, list(close order by trading_date) as c from shown where break_date is null or trading_date >= break_date group by 1)
select s.symbol, s.trading_date, s.close, round({ema_sql('c[1:j]', 20)}, 6) as ema_short from shown s left join liv using (symbol, trading_date) left join arr using (symbol)""", "bars", "brk").replace("\n, shown as", ", shown as", 1))
def vw4_chart(spark, sf):
    daily = D.stored_bars(spark, sf)
    breaks = B.last_breaks(daily, P.break_low_ratio, P.break_high_ratio)
    return tidy(I.chart_ema(daily, breaks, {"ema_short": P.ema_short}, 400).select("symbol", "trading_date", "close", "ema_short"))


@query("vw4_provenance", sql("""
, lr as (select * from runs where status = 'COMPLETE' and symbols_filter_json is null order by started_at desc, run_id limit 1)
select s.symbol, s.instrument_key, s.isin, s.series, run_id, latest_closed_session, q.status as quality_status, q.reason as quality_reason from scanned s cross join lr left join quality q on q.symbol = s.symbol""",
    "scanned", "runs", "quality").replace("\n, lr as", ", lr as", 1))
def vw4_provenance(spark, sf):
    daily = D.stored_bars(spark, sf)
    quality = FT.mark_stale(D.feature_quality(spark, sf, daily), daily)
    return S.provenance(scan(spark, sf, daily), R.latest_complete(D.scan_runs(spark, sf)), quality)
