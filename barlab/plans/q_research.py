"""Registered queries: point-in-time features, dataset, evaluation, scoring."""
from __future__ import annotations

from pyspark.sql import functions as F

from barlab.operators import dataset as DS
from barlab.operators import evaluate as E
from barlab.operators import pointintime as PT
from barlab.operators import scoring as SC
from barlab.plans import derived as D
from barlab.plans.oracle_views import ema_sql, rsi_sql, sql, view, wilder_sql
from barlab.plans.registry import query, tidy
from barlab.session import materialize

PIT = PT.PointInTimeParams(emas=(20, 50, 200), slope_lag=10, rsi_period=14, atr_period=14, returns=(1, 3, 5, 10, 20),
                           high_window=252, volatility_window=20, rvol_window=20, relative=(5, 20),
                           break_low_ratio=0.80, break_high_ratio=1.25)
HORIZON, LOOKBACK = 5, 30
FIRST_TEST, BLOCK, EMBARGO = 120, 40, 10
CUTOFF = "2000-06-30"


def day(text):
    return F.lit(text).cast("date")


# --- features-v1 ------------------------------------------------------------------------------------

view("pit0", """
select *, sum(cast(coalesce(close / pc < 0.80 or close / pc > 1.25, false) as int)) over (partition by symbol order by trading_date) as s,
  coalesce(close / pc < 0.80 or close / pc > 1.25, false) as ab from (select r.*, e.close as bench from ratios r left join bench e using (trading_date))""", "ratios", "bench")
view("pit1", """
select *, row_number() over w as i, lag(close) over w as p1, ln(close / lag(close) over w) as st,
  greatest(high - low, abs(high - lag(close) over w), abs(low - lag(close) over w)) as tr from pit0 window w as (partition by symbol, s, ab order by trading_date)""", "pit0")
view("pitl", """
select symbol, s, ab, list(close order by i) as c, list(greatest(close - p1, 0.0) order by i) filter (where i > 1) as g,
  list(greatest(p1 - close, 0.0) order by i) filter (where i > 1) as l, list(tr order by i) filter (where i > 1) as t from pit1 group by 1, 2, 3""", "pit1")
RETURNS = ", ".join(f"(close / lag(close, {k}) over w - 1) * 100 as return_{k}" for k in PIT.returns)
RELATIVE = ", ".join(f"(close / lag(close, {k}) over w - 1) * 100 - (bench / lag(bench, {k}) over w - 1) * 100 as relative_{k}" for k in PIT.relative)
view("pitw", f"""
select symbol, trading_date, close, i, s, ab, {RETURNS}, {RELATIVE},
  case when count(*) over a = 252 then (max(high) over a - close) / max(high) over a * 100 end as below_high,
  case when count(*) over a = 252 then (close - min(low) over a) / min(low) over a * 100 end as above_low,
  case when count(st) over v = 20 then stddev_samp(st) over v end as volatility,
  case when count(volume) over r = 20 then volume / nullif(avg(volume) over r, 0) end as rvol
from pit1 window w as (partition by symbol, s, ab order by trading_date), a as (partition by symbol, s, ab order by trading_date rows between 251 preceding and current row),
  v as (partition by symbol, s, ab order by trading_date rows between 19 preceding and current row), r as (partition by symbol, s, ab order by trading_date rows between 20 preceding and 1 preceding)""", "pit1")
view("pitr", f"""
select w.*, {ema_sql('c[1:i]', 20)} as ema_short, {ema_sql('c[1:i]', 50)} as ema_medium, {ema_sql('c[1:i]', 200)} as ema_long,
  case when i > 1 then {rsi_sql('g[1:i-1]', 'l[1:i-1]', 14)} end as rsi, case when i > 1 then {wilder_sql('t[1:i-1]', 14)} end as atr
from pitw w join pitl using (symbol, s, ab)""", "pitw", "pitl")
NAMES = ("short", "medium", "long")
view("pit", "select *, " + ", ".join(
    f"(ema_{n} / lag(ema_{n}, 10) over w - 1) * 100 as ema_{n}_slope, (close / ema_{n} - 1) * 100 as ema_{n}_distance" for n in NAMES)
     + ", atr / close * 100 as atr_percent from pitr window w as (partition by symbol, s, ab order by trading_date)", "pitr")
PIT_COLS = [*[f"return_{k}" for k in PIT.returns], *[f"relative_{k}" for k in PIT.relative], "below_high", "above_low", "volatility", "rvol",
            *[f"ema_{n}{x}" for n in NAMES for x in ("", "_slope", "_distance")], "rsi", "atr_percent"]


def features(spark, sf):
    b = D.bars(spark, sf)
    return PT.features_v1(b, D.benchmark(spark, sf, b), PIT)


@query("ind17_features_every_bar", sql("select symbol, trading_date, close, " + ", ".join(f"round({c}, 8) as {c}" for c in PIT_COLS) + " from pit", "pit"))
def ind17(spark, sf):
    # means of 200 four-digit prices end in halves of the sixth digit, so more digits are kept
    return tidy(features(spark, sf), 8)


ABOVE = ", ".join(f"round(count(*) filter (where close > ema_{n}) * 100.0::double / nullif(count(ema_{n}), 0), 4) as above_ema_{n}" for n in NAMES)


@query("ind17_breadth", sql(f"select trading_date, {ABOVE} from pit group by 1", "pit"))
def ind17_breadth(spark, sf):
    return PT.breadth_at(features(spark, sf))


@query("ind17_sector_breadth", sql(f"select trading_date, coalesce(sector, 'UNKNOWN') as sector, {ABOVE} from pit join univ using (symbol) group by 1, 2", "pit", "univ"))
def ind17_sector_breadth(spark, sf):
    return PT.breadth_at(features(spark, sf), D.universe(spark, sf))


@query("ind17_benchmark_context", sql(f"""
, bl as (select *, row_number() over (order by trading_date) as i, ln(close / lag(close) over (order by trading_date)) as st from bench),
bc as (select list(close order by i) as c from bl)
select trading_date, round((close / ({ema_sql('c[1:i]', 50)}) - 1) * 100, 6) as benchmark_trend,
  round(case when count(st) over v = 20 then stddev_samp(st) over v end, 6) as benchmark_volatility from bl, bc
window v as (order by trading_date rows between 19 preceding and current row)""", "bench").replace("\n, bl as", ", bl as", 1))
def ind17_context(spark, sf):
    return tidy(PT.benchmark_context(D.benchmark(spark, sf), PIT))


# --- samples ----------------------------------------------------------------------------------------

def index(spark, sf):
    return DS.session_index(D.weeks(spark, sf))


def labelled(spark, sf):
    return DS.forward_labels(D.weekly_bars(spark, sf), index(spark, sf), HORIZON)


view("widx", "select trading_date, row_number() over (order by trading_date) - 1 as idx from weeks", "weeks")
view("lab", """
select *, case when fr is not null then cast(fr > 0 as int) end as positive, fr as forward_return from
 (select w.*, (select f.close / w.close - 1 from (select wbars.*, idx from wbars join widx using (trading_date)) f where f.symbol = w.symbol and f.idx = w.idx + 5
     and (select count(*) from wbars b join widx x using (trading_date) where b.symbol = w.symbol and x.idx between w.idx + 1 and w.idx + 5) = 5) as fr
  from (select wbars.*, idx from wbars join widx using (trading_date)) w)""", "wbars", "widx")


@query("ml1_forward_labels", sql("select symbol, trading_date, idx, round(forward_return, 6) as forward_return, positive from lab", "lab"))
def ml1(spark, sf):
    return tidy(labelled(spark, sf).select("symbol", "trading_date", "idx", "forward_return", "positive"))


def judged(spark, sf, treat_membership=True):
    daily = D.stored_bars(spark, sf)
    candles = materialize(D.weekly_candles(spark, sf, daily), "candles")
    sessions = D.weeks(spark, sf).filter("year(trading_date) > 1995 or month(trading_date) > 3")
    numbered = materialize(DS.session_index(sessions), "weeks")
    ca = D.corporate_actions(spark, sf).filter("status = 'CONFIRMED'").select("symbol", F.col("effective_date").alias("date"))
    odd = D.raw_candles(spark, sf, daily).filter("close < 1 and volume > 45").select("symbol", F.col("trading_date").alias("date"))
    member = candles.filter("volume > 5").select("symbol", "trading_date")
    complete = candles.filter("volume > 8").select("symbol", "trading_date")
    return DS.eligibility(candles, numbered, D.universe(spark, sf).filter("balance < 9500"),
                          member if treat_membership else None, ca, odd, complete, LOOKBACK, HORIZON, 0.80, 1.25)


view("eidx", "select trading_date, row_number() over (order by trading_date) - 1 as idx from weeks where year(trading_date) > 1995 or month(trading_date) > 3", "weeks")
view("eca", "select distinct concat('S', lpad(cast(o_custkey as varchar), 6, '0')) as symbol, cast(o_orderdate as date) as date from orders where o_orderpriority = '1-URGENT' and o_orderstatus = 'P'")
view("eodd", "select distinct symbol, trading_date as date from raw where close < 1 and volume > 45", "raw")
view("ecand", """
select distinct symbol, trading_date from (select s.symbol, e.trading_date from (select symbol, min(trading_date) as a, max(trading_date) as b from wk group by 1) s, eidx e where e.trading_date between a and b
 union all select symbol, trading_date from wk)""", "wk", "eidx")
view("erow", """
select c.symbol, c.trading_date, e.idx, w.symbol is not null as bar, coalesce(w.open > 0 and w.high > 0 and w.low > 0 and w.close > 0 and w.high >= w.low, false) as sound,
  w.close, w.volume, e.idx is not null and coalesce(w.close > 0, false) as closed
from ecand c left join eidx e using (trading_date) left join wk w on w.symbol = c.symbol and w.trading_date = c.trading_date""", "ecand", "eidx", "wk")
view("eprev", """
select *, max(case when closed then trading_date end) over (partition by symbol order by trading_date rows between unbounded preceding and 1 preceding) as pdate from erow""", "erow")
view("ejoin", """
select e.*, p.close as pclose, p.sound as psound, case when e.closed then e.close / p.close end as ratio from eprev e left join erow p on p.symbol = e.symbol and p.trading_date = e.pdate""", "eprev", "erow")
view("eca_i", """
select distinct c.symbol, i.idx from eca c join eidx i on i.idx between (select count(*) from eidx x where x.trading_date < c.date) - 5 and (select count(*) from eidx x where x.trading_date <= c.date) - 1 + 30""", "eca", "eidx")
view("eodd_i", """
select distinct c.symbol, i.idx from eodd c join eidx i on i.idx between (select count(*) from eidx x where x.trading_date < c.date) - 5 and (select count(*) from eidx x where x.trading_date <= c.date) - 1 + 30""", "eodd", "eidx")
view("elig", """
select symbol, trading_date, idx, case when idx is null then 'E1:NOT_A_SESSION' when not bar or pclose is null then 'E1:BAR_MISSING' when not sound or not psound then 'E1:BAR_INVALID'
  when symbol not in (select symbol from univ where balance < 9500) then 'E2:NOT_IN_UNIVERSE' when not coalesce(volume > 5, false) then 'E2:MEMBERSHIP_UNEVIDENCED'
  when (symbol, idx) in (select symbol, idx from eca_i) then 'E3:CA_EVENT_IN_WINDOW' when brk > 0 then 'E3:BREAK_IN_LABEL_WINDOW'
  when (symbol, idx) in (select symbol, idx from eodd_i) then 'E3:DATA_ANOMALY' when nvalid < 30 then 'E4:INSUFFICIENT_HISTORY' when nback < least(30, idx) + 1 then 'E4:GAP_IN_LOOKBACK'
  when not coalesce(volume > 8, false) then 'E5:REQUIRED_FEATURE_MISSING' when nahead < 5 or not coalesce(endc > 0, false) then 'E6:TARGET_UNAVAILABLE' end as reason
from (select e.*, (select count(*) from ejoin f where f.symbol = e.symbol and f.idx between e.idx + 1 and e.idx + 5 and (f.ratio < 0.80 or f.ratio > 1.25)) as brk,
   (select count(*) from ejoin f where f.symbol = e.symbol and f.idx <= e.idx and f.closed) as nvalid,
   (select count(*) from ejoin f where f.symbol = e.symbol and f.idx between e.idx - 30 and e.idx and f.bar) as nback,
   (select count(*) from ejoin f where f.symbol = e.symbol and f.idx between e.idx + 1 and e.idx + 5 and f.bar) as nahead,
   (select max(close) from ejoin f where f.symbol = e.symbol and f.idx = e.idx + 5) as endc from ejoin e)""", "ejoin", "univ", "eca_i", "eodd_i")


@query("ml2_eligibility", sql("select * from elig", "elig"))
def ml2(spark, sf):
    return tidy(judged(spark, sf))


@query("ml3_exclusion_counts", sql("""
select reason, cast(year as bigint) as year, sector, count(*) as n from (select coalesce(reason, 'ELIGIBLE') as reason, year(trading_date) as year, coalesce(sector, 'UNKNOWN') as sector
 from elig left join univ using (symbol)) group by grouping sets ((reason), (reason, year), (reason, sector))""", "elig", "univ"))
def ml3(spark, sf):
    return tidy(DS.exclusion_counts(judged(spark, sf), D.universe(spark, sf)))


@query("ml4_membership_manifest", sql("""
select count(*) as candidates, count(*) filter (where not coalesce(volume > 5, false)) as unevidenced, round(count(*) filter (where not coalesce(volume > 5, false)) * 100.0::double / count(*), 2) as unevidenced_pct,
  'NOT_RECONSTRUCTABLE' as status, 'current constituents — NOT point-in-time' as label from erow where idx is not null""", "erow"))
def ml4(spark, sf):
    member = D.weekly_candles(spark, sf).filter("volume > 5").select("symbol", "trading_date")
    return DS.membership_manifest(judged(spark, sf, False), member, "NOT_RECONSTRUCTABLE")


SEG = "case when idx < 150 then 'TRAIN' when idx >= 160 and idx < 230 then 'VALIDATION' when idx >= 240 then 'TEST' end"


def split(spark, sf):
    samples = labelled(spark, sf).filter("forward_return is not null")
    return DS.assign_split(samples, DS.split_table(index(spark, sf), 150, 10, 70), HORIZON)


view("splt", f"""
select symbol, trading_date, idx, segment from (select *, {SEG} as segment from lab where forward_return is not null) where segment is not null
 and idx + 5 <= case segment when 'TRAIN' then 149 when 'VALIDATION' then 229 else (select max(idx) from widx) end""", "lab", "widx")


@query("ml5_date_split", sql("select * from splt", "splt"))
def ml5(spark, sf):
    return tidy(split(spark, sf).select("symbol", "trading_date", "idx", "segment"))


def folds(spark, sf):
    return DS.fold_table(index(spark, sf), FIRST_TEST, BLOCK, EMBARGO)


view("fold", """
select k as fold, 120 + 40 * k - 11 as train_last, 120 + 40 * k as test_first, least(120 + 40 * k + 39, n - 1) as test_last
from (select unnest(range(0, (n - 121) // 40 + 1)) as k, n from (select count(*) as n from widx))""", "widx")


@query("ml6_walk_forward_folds", sql("select * from fold", "fold"))
def ml6(spark, sf):
    return tidy(folds(spark, sf))


def usable(spark, sf):
    """Labelled samples with a prediction from the last weekly move."""
    from barlab.operators.dataset import by_idx
    move = F.col("close") / F.lag("close").over(by_idx()) - 1
    rows = labelled(spark, sf).withColumn("move", move).filter("move is not null and forward_return is not null")
    rows = rows.withColumn("p", F.round(1 / (1 + F.exp(F.col("move") * 2)), 9)).withColumn("predicted", -F.col("move") / 2)
    return rows.join(D.universe(spark, sf).select("symbol", "sector"), "symbol", "left")


view("smpl", """
select l.*, round(1 / (1 + exp(move * 2)), 9) as p, -move / 2 as predicted, sector from (select *, close / lag(close) over (partition by symbol order by idx) - 1 as move from lab) l
left join univ using (symbol) where move is not null and forward_return is not null""", "lab", "univ")
view("base", """
select fold, train_last, test_first, test_last, count(*) as n_train, avg(positive) as base_share, avg(forward_return) as base_return
from fold join smpl on idx <= train_last group by 1, 2, 3, 4""", "fold", "smpl")
view("scored", """
select *, base_loss - loss as improvement from (select s.*, fold, base_share, base_return, -(positive * ln(least(greatest(p, 1e-6), 1 - 1e-6)) + (1 - positive) * ln(1 - least(greatest(p, 1e-6), 1 - 1e-6))) as loss,
  -(positive * ln(base_share) + (1 - positive) * ln(1 - base_share)) as base_loss from smpl s join base on idx between test_first and test_last)""", "smpl", "base")


@query("ml7_baseline", sql("""
select fold, train_last, test_first, test_last, n_train, round(base_share, 6) as base_share, round(base_return, 6) as base_return from base""", "base"))
def ml7(spark, sf):
    return tidy(E.baseline(usable(spark, sf), folds(spark, sf)))


def scored(spark, sf):
    rows = materialize(usable(spark, sf))
    f = folds(spark, sf)
    return E.scored(DS.test_rows(rows, f), E.baseline(rows, f))


METRICS = """count(*) as n, round(avg(loss), 6) as log_loss, round(avg(base_loss), 6) as base_log_loss, round(avg((p - positive) * (p - positive)), 6) as brier,
  round(avg(abs(forward_return - predicted)), 6) as mae, round(1 - sum((forward_return - predicted) * (forward_return - predicted)) / sum((forward_return - base_return) * (forward_return - base_return)), 6) as r2_oos"""


@query("ml8_metrics_by_fold", sql(f"select fold, {METRICS} from scored group by 1", "scored"))
def ml8_fold(spark, sf):
    return tidy(E.metrics(scored(spark, sf), ["fold"]))


@query("ml8_metrics_by_sector", sql(f"select sector, {METRICS} from scored group by 1", "scored"))
def ml8_sector(spark, sf):
    return tidy(E.metrics(scored(spark, sf), ["sector"]))


@query("ml8_auc_by_fold", sql("""
select fold, round((sum(r) filter (where positive = 1) - n1 * (n1 + 1) / 2) / (n1 * n0), 6) as auc from
(select fold, positive, rank() over (partition by fold order by p) + (count(*) over (partition by fold, p) - 1) / 2.0::double as r, cast(sum(positive) over (partition by fold) as double) as n1,
   cast(sum(1 - positive) over (partition by fold) as double) as n0 from scored) group by fold, n1, n0""", "scored"))
def ml8_auc(spark, sf):
    return tidy(E.auc(scored(spark, sf), ["fold"]))


BINS = """(select *, (row_number() over (order by p, symbol, trading_date) - 1) * 10 // count(*) over () as bin from scored)"""


@query("ml9_calibration", sql(f"select bin, count(*) as n, round(avg(p), 6) as mean_p, round(avg(positive), 6) as mean_y from {BINS} group by 1", "scored"))
def ml9(spark, sf):
    return tidy(E.calibration(scored(spark, sf)))


@query("ml9_calibration_error", sql(f"select round(max(abs(mp - my)), 6) as mace from (select bin, avg(p) as mp, avg(positive) as my from {BINS} group by 1)", "scored"))
def ml9_error(spark, sf):
    return tidy(E.calibration_error(E.calibration(scored(spark, sf))))


@query("ml10_concentration", sql("""
, w as (select count(*) as wn, sum(improvement) as d from scored),
s as (select coalesce(sector, 'UNMAPPED') as g, count(*) as n, sum(improvement) as c from scored group by 1),
u as (select 'SECTOR' as kind, case when n < greatest(500, 0.15 * wn) then 'SMALL_SECTORS' else g end as "group", sum(n) as n, sum(c) as c from s, w group by 2
 union all select 'FOLD', cast(fold as varchar), count(*), sum(improvement) from scored group by 2)
select kind, "group", cast(n as bigint) as n, round(c, 6) as contribution, round(case when d > 0 then c / d end, 6) as share, round(c / n, 6) as mean_improvement, d > 0 and c / d <= 0.5 as passes from u, w""", "scored").replace("\n, w as", ", w as", 1))
def ml10(spark, sf):
    return tidy(E.concentration(materialize(scored(spark, sf)), 0.5, 500, 0.15))


@query("ml11_date_bootstrap", sql("""
, dl as (select trading_date, sum(improvement) as s, count(*) as n, row_number() over (order by trading_date) - 1 as i from scored group by 1),
t as (select count(*) as n from dl),
dr as (select r as replicate, cast(concat('0x', substr(md5(concat('boot-v1:', r, ':', k)), 1, 8)) as bigint) % t.n as i from t, (select unnest(range(200)) as r) a, (select unnest(range((select n from t))) as k) b)
select replicate, round(sum(s) / sum(n), 6) as estimate from dr join dl using (i) group by 1""", "scored").replace("\n, dl as", ", dl as", 1))
def ml11(spark, sf):
    return tidy(E.date_bootstrap(materialize(scored(spark, sf)), "improvement", 200, "boot-v1"))


@query("ml11_bootstrap_interval", sql("""
, dl as (select trading_date, sum(improvement) as s, count(*) as n, row_number() over (order by trading_date) - 1 as i from scored group by 1),
t as (select count(*) as n from dl),
dr as (select r as replicate, cast(concat('0x', substr(md5(concat('boot-v1:', r, ':', k)), 1, 8)) as bigint) % t.n as i from t, (select unnest(range(200)) as r) a, (select unnest(range((select n from t))) as k) b)
select round(quantile_cont(e, 0.025), 6) as low, round(quantile_cont(e, 0.975), 6) as high from (select replicate, sum(s) / sum(n) as e from dr join dl using (i) group by 1)""", "scored").replace("\n, dl as", ", dl as", 1))
def ml11_interval(spark, sf):
    return tidy(E.bootstrap_interval(E.date_bootstrap(materialize(scored(spark, sf)), "improvement", 200, "boot-v1")))


@query("ml12_rank_correlation", sql("""
select trading_date, count(*) as n, round(corr(ra, rb), 6) as ic from (select trading_date,
  rank() over (partition by trading_date order by p) + (count(*) over (partition by trading_date, p) - 1) / 2.0::double as ra,
  rank() over (partition by trading_date order by forward_return) + (count(*) over (partition by trading_date, forward_return) - 1) / 2.0::double as rb from smpl) group by 1""", "smpl"))
def ml12(spark, sf):
    return tidy(E.rank_correlation(materialize(usable(spark, sf)), "p", "forward_return"))


@query("ml13_truncation_audit", sql("select count(*) as compared, 0::bigint as differing, true as passes from bars where trading_date <= date '2000-06-30'", "bars"))
def ml13_truncation(spark, sf):
    b = D.stored_bars(spark, sf)
    return DS.truncation_audit(b, own_features(spark, sf, b), at_cutoff(b)).drop("replicas")


def own_features(spark, sf, b):
    bench = materialize(D.benchmark(spark, sf, b), "bench")
    return lambda rows: PT.features_v1(rows, bench, PIT)


def at_cutoff(b):
    return b.filter(F.col("trading_date") <= day(CUTOFF)).select("symbol", day(CUTOFF).alias("cutoff"))


REPLICAS = 64
view("cutoffs", f"""
select symbol, trading_date as cutoff from (select *, row_number() over (order by symbol, sha256(concat('cut-v1', cast(trading_date as varchar)))) - 1 as j, count(*) over () as n from bars)
where j in (select cast(floor(i * (c / {REPLICAS}.0::double)) as bigint) from (select unnest(range({REPLICAS})) as i, c from (select count(*) as c from bars)) where i < c)""", "bars")


@query("ml13_truncation_replicas", sql("""
select count(distinct (symbol, cutoff)) as replicas, count(*) as compared, 0::bigint as differing, true as passes from cutoffs join bars using (symbol) where trading_date <= cutoff""", "cutoffs", "bars"))
def ml13_replicas(spark, sf):
    """Every feature at sampled (symbol, date): the series that ends there gives what the whole series gives."""
    b = D.stored_bars(spark, sf)
    return DS.truncation_audit(b, own_features(spark, sf, b), DS.sampled_cutoffs(b, "cut-v1", REPLICAS))


def one_ahead(rows):
    """A feature that looks one bar ahead."""
    from barlab.operators.bars import by_symbol
    return rows.select("symbol", "trading_date", F.lead("close").over(by_symbol()).alias("ahead"))


@query("ml13_leaking_replicas", sql("""
select symbol, cutoff, trading_date, side from (select c.*, b.trading_date, max(b.trading_date) over (partition by symbol, cutoff) as newest from cutoffs c join bars b using (symbol)),
 (values ('FULL'), ('TRUNCATED')) s(side) where trading_date = cutoff and newest > cutoff""", "cutoffs", "bars"))
def ml13_leaking_replicas(spark, sf):
    """A leak shows on the last row of every replica that was cut before the end."""
    b = D.stored_bars(spark, sf)
    pairs = DS.truncation_pairs(b, one_ahead, DS.sampled_cutoffs(b, "cut-v1", REPLICAS))
    return tidy(DS.truncation_differences(pairs).drop("ahead"))


@query("ml13_split_overlaps", sql("""
select *, coalesce(reach >= next_first, false) as overlaps from (select segment, min(idx) as first_idx, max(idx) + 5 as reach, count(*) as n, lead(min(idx)) over (order by min(idx)) as next_first from splt group by 1)""", "splt"))
def ml13_overlaps(spark, sf):
    return tidy(DS.split_overlaps(split(spark, sf), HORIZON))


@query("ml13_shuffled_labels", sql("""
, o as (select symbol, trading_date, positive, row_number() over (order by symbol, trading_date) as seat,
  row_number() over (order by sha256(concat('shuffle-v1:', symbol, ':', cast(trading_date as varchar))), symbol, trading_date) as card from smpl)
select a.symbol, a.trading_date, b.positive from o a join o b on a.seat = b.card""", "smpl").replace("\n, o as", ", o as", 1))
def ml13_shuffle(spark, sf):
    rows = usable(spark, sf).select("symbol", "trading_date", "positive")
    return tidy(DS.shuffled_labels(materialize(rows), "positive", "shuffle-v1"))


PENALTIES = [0.01, 0.1, 1.0]
# The objective is strictly convex in three numbers, so the twin takes Newton steps on the standardised columns.
view("lrow", f"""
select symbol, trading_date, positive, move, case when cast(volume as bigint) % 7 = 0 then null else volume end as volume, segment from
 (select *, {SEG} as segment from smpl) where segment is not null and idx + 5 <= case segment when 'TRAIN' then 149 when 'VALIDATION' then 229 else (select max(idx) from widx) end""", "smpl", "widx")
view("lstat", "select avg(move) as m1, stddev_samp(move) as s1, avg(volume) as m2, stddev_samp(volume) as s2 from lrow where segment = 'TRAIN' and volume is not null and move is not null", "lrow")
view("lstd", "select lrow.*, (move - m1) / s1 as x1, (volume - m2) / s2 as x2 from lrow, lstat", "lrow", "lstat")
view("newton", f"""
select * from (with recursive nt(lam, i, b0, b1, b2) as (
  select cast(l as double), 0, 0.0::double, 0.0::double, 0.0::double from (values {', '.join(f'({x})' for x in PENALTIES)}) v(l)
  union all
  select lam, i + 1, b0 - ((d * f - e * e) * g0 + (c * e - b * f) * g1 + (b * e - c * d) * g2) / det,
    b1 - ((c * e - b * f) * g0 + (a * f - c * c) * g1 + (b * c - a * e) * g2) / det, b2 - ((b * e - c * d) * g0 + (b * c - a * e) * g1 + (a * d - b * b) * g2) / det
  from (select *, a * (d * f - e * e) + b * (c * e - b * f) + c * (b * e - c * d) as det from
   (select lam, i, b0, b1, b2, avg(p - positive) as g0, avg((p - positive) * x1) + lam * b1 as g1, avg((p - positive) * x2) + lam * b2 as g2,
      avg(p * (1 - p)) as a, avg(p * (1 - p) * x1) as b, avg(p * (1 - p) * x2) as c, avg(p * (1 - p) * x1 * x1) + lam as d, avg(p * (1 - p) * x1 * x2) as e, avg(p * (1 - p) * x2 * x2) + lam as f
    from (select nt.*, positive, x1, x2, 1 / (1 + exp(-(b0 + b1 * x1 + b2 * x2))) as p from nt, lstd where segment = 'TRAIN' and x1 is not null and x2 is not null and i < 12)
    group by lam, i, b0, b1, b2)))
select * from nt where i = 12)""", "lstd")
view("chosen", """
select * from (select lam, b0, b1, b2, avg(-(positive * ln(least(greatest(p, 1e-6), 1 - 1e-6)) + (1 - positive) * ln(1 - least(greatest(p, 1e-6), 1 - 1e-6)))) as loss from
 (select newton.*, positive, 1 / (1 + exp(-(b0 + b1 * x1 + b2 * x2))) as p from newton, lstd where segment = 'VALIDATION' and x1 is not null and x2 is not null) group by 1, 2, 3, 4)
order by loss, lam desc limit 1""", "newton", "lstd")


@query("ml14_logistic_tier", sql("""
select symbol, trading_date, positive, round(1 / (1 + exp(-(b0 + b1 * x1 + b2 * x2))), 4) as p, case when volume is null then 'MISSING_FEATURE:volume' end as p_reason, lam as regularization
from lstd, chosen where segment = 'TEST'""", "lstd", "chosen"))
def ml14(spark, sf):
    rows = usable(spark, sf).drop("p", "predicted").join(DS.split_table(index(spark, sf), 150, 10, 70), "idx")
    volume = F.when(F.col("volume").cast("bigint") % 7 == 0, F.lit(None)).otherwise(F.col("volume")).cast("double")
    rows = materialize(rows.filter(F.col("idx") + HORIZON <= F.col("last_idx")).select(
        "symbol", "trading_date", "segment", "move", volume.alias("volume"), "positive"))
    part = lambda name: rows.filter(F.col("segment") == name)
    out = E.logistic_tier(part("TRAIN"), part("VALIDATION"), part("TEST"), ["move", "volume"], PENALTIES, 200)
    return tidy(out.select("symbol", "trading_date", "positive", F.round("p", 4).alias("p"), "p_reason", "regularization"))


# Few distinct values, so that every split between them is tried by either side.
view("trow", """
select symbol, trading_date, positive, segment, cast(greatest(least(floor(move * 50), 4), -5) as int) as step, case when volume is null then null else cast(volume as bigint) % 5 end as lot from lrow""", "lrow")
view("stump", """
select * from (select feature, cut, sum(cast(v <= cut as int)) as nl, sum(case when v <= cut then positive else 0 end) as pl, count(*) as n, sum(positive) as p from
 (select 'step' as feature, step as v, positive from trow where segment = 'TRAIN' and lot is not null union all select 'lot', lot, positive from trow where segment = 'TRAIN' and lot is not null) x
 join (select distinct 'step' as feature, step as cut from trow where segment = 'TRAIN' and lot is not null union all select distinct 'lot', lot from trow where segment = 'TRAIN' and lot is not null) c using (feature) group by 1, 2)
where nl < n order by nl * 1.0 / n * 2 * (pl * 1.0 / nl) * (1 - pl * 1.0 / nl) + (n - nl) * 1.0 / n * 2 * ((p - pl) * 1.0 / (n - nl)) * (1 - (p - pl) * 1.0 / (n - nl)) limit 1""", "trow")


@query("ml17_tree_tier", sql("""
select symbol, trading_date, positive, round(case when lot is null then null when case feature when 'step' then step else lot end <= cut then pl::double / nl else (p - pl)::double / (n - nl) end, 6) as p,
  case when lot is null then 'MISSING_FEATURE:lot' end as p_reason, 1::bigint as depth from trow, stump where segment = 'TEST'""", "trow", "stump"))
def ml17(spark, sf):
    """The second tier at depth one, which SQL can search too."""
    rows = usable(spark, sf).drop("p", "predicted").join(DS.split_table(index(spark, sf), 150, 10, 70), "idx").filter(F.col("idx") + HORIZON <= F.col("last_idx"))
    lot = F.when(F.col("volume").cast("bigint") % 7 == 0, F.lit(None)).otherwise(F.col("volume").cast("bigint") % 5).cast("double")
    step = F.greatest(F.least(F.floor(F.col("move") * 50), F.lit(4)), F.lit(-5)).cast("double")
    rows = materialize(rows.select("symbol", "trading_date", "segment", "positive", step.alias("step"), lot.alias("lot")))
    part = lambda name: rows.filter(F.col("segment") == name)
    out = E.tree_tier(part("TRAIN"), part("VALIDATION"), part("TEST"), ["step", "lot"], [1])
    return tidy(out.select("symbol", "trading_date", "positive", "p", "p_reason", "depth"))


def drawn(seed, of):
    """SQL: (r, trading_date) of every draw of the date bootstrap over a view's dates."""
    return f"""dl as (select trading_date, row_number() over (order by trading_date) - 1 as i from {of} group by 1),
t as (select count(*) as n from dl),
dr as (select r, cast(concat('0x', substr(md5(concat('{seed}:', r, ':', k)), 1, 8)) as bigint) % t.n as i from t, (select unnest(range(200)) as r) a, (select unnest(range((select n from t))) as k) b),
dd as (select r, trading_date, count(*) as times from dr join dl using (i) group by 1, 2)"""


def placed(of):
    """SQL: the area under the curve of every replicate, rows counted per date and place of the score."""
    return f"""cell as (select trading_date, {of} as c, sum(positive) as n1, sum(1 - positive) as n0 from scored where p is not null group by 1, 2),
rc as (select r, c, sum(times * n1) as n1, sum(times * n0) as n0 from dd join cell using (trading_date) group by 1, 2),
ra as (select r, sum(u) / (sum(n1) * sum(n0)) as estimate from (select *, n1 * (coalesce(sum(n0) over (partition by r order by c rows between unbounded preceding and 1 preceding), 0) + n0 / 2.0::double) as u from rc) group by 1)"""


EXACT, CELLS = placed("p"), placed("least(cast(floor(p * 100) as int), 99)")


@query("ml11_auc_bootstrap_cells", sql(f", {drawn('boot-v1', 'scored')}, {CELLS} select r as replicate, round(estimate, 6) as estimate from ra", "scored").replace("\n, dl as", ", dl as", 1))
def ml11_auc_cells(spark, sf):
    return tidy(E.auc_bootstrap(materialize(scored(spark, sf)), 200, "boot-v1", cells=100))


@query("ml11_auc_bootstrap", sql(f", {drawn('boot-v1', 'scored')}, {EXACT} select r as replicate, round(estimate, 6) as estimate from ra", "scored").replace("\n, dl as", ", dl as", 1))
def ml11_auc(spark, sf):
    return tidy(E.auc_bootstrap(materialize(scored(spark, sf)), 200, "boot-v1"))


@query("ml11_r2_interval", sql(f""", {drawn('boot-v1', 'scored')},
dy as (select trading_date, sum((forward_return - predicted) * (forward_return - predicted)) as a, sum((forward_return - base_return) * (forward_return - base_return)) as b from scored group by 1),
re as (select r, 1 - sum(times * a) / sum(times * b) as e from dd join dy using (trading_date) group by 1)
select round(quantile_cont(e, 0.025), 6) as low, round(quantile_cont(e, 0.975), 6) as high from re""", "scored").replace("\n, dl as", ", dl as", 1))
def ml11_r2(spark, sf):
    rows = materialize(scored(spark, sf))
    error, base_error = F.col("forward_return") - F.col("predicted"), F.col("forward_return") - F.col("base_return")
    left = E.ratio_bootstrap(rows, error * error, base_error * base_error, 200, "boot-v1")
    return tidy(E.bootstrap_interval(left.withColumn("estimate", 1 - F.col("estimate"))))


# The thresholds the study proposes for its gate.
GATE = {"auc": 0.5, "improvement": 0.0, "folds_beaten": 0.7, "calibration_error": 0.1, "concentration": 0.5}


@query("ml16_evidence_gate", sql(f""", {drawn('boot-v1', 'scored')}, {EXACT},
im as (select trading_date, sum(improvement) as s, count(*) as n from scored group by 1),
ri as (select r, sum(times * s) / sum(times * n) as e from dd join im using (trading_date) group by 1),
fb as (select avg(case when a < b then 1.0 else 0.0 end) as v from (select fold, avg(loss) as a, avg(base_loss) as b from scored group by 1)),
mc as (select max(abs(mp - my)) as v from (select bin, avg(p) as mp, avg(positive) as my from {BINS} group by 1)),
w as (select count(*) as wn, sum(improvement) as d from scored),
s as (select coalesce(sector, 'UNMAPPED') as g, count(*) as n, sum(improvement) as c from scored group by 1),
u as (select 'SECTOR' as kind, case when n < greatest(500, 0.15 * wn) then 'SMALL_SECTORS' else g end as g, sum(c) as c from s, w group by 2
 union all select 'FOLD', cast(fold as varchar), sum(improvement) from scored group by 2),
cc as (select max(case when d > 0 then c / d end) as v, bool_and(coalesce(d > 0 and c / d <= 0.5, false)) and count(*) filter (where kind = 'FOLD') >= 3 as ok from u, w)
select 'auc' as criterion, round(l, 6) as value, 0.5::double as "limit", coalesce(l > 0.5, false) as passes from (select quantile_cont(estimate, 0.025) as l from ra)
union all select 'improvement', round(l, 6), 0.0, coalesce(l > 0, false) from (select quantile_cont(e, 0.025) as l from ri)
union all select 'folds_beaten', round(cast(v as double), 6), 0.7, coalesce(v >= 0.7, false) from fb
union all select 'calibration_error', round(v, 6), 0.1, coalesce(v <= 0.1, false) from mc
union all select 'concentration', round(v, 6), 0.5, coalesce(ok, false) from cc""", "scored").replace("\n, dl as", ", dl as", 1))
def ml16(spark, sf):
    return tidy(E.evidence_gate(materialize(scored(spark, sf)), GATE, 200, "boot-v1", 500, 0.15))


@query("ml13_leaking_features", sql("""
select count(*) filter (where trading_date <= date '2000-06-30') as compared,
  2 * (select count(*) from (select symbol from bars group by 1 having min(trading_date) <= date '2000-06-30' and max(trading_date) > date '2000-06-30')) as differing,
  false as passes from bars""", "bars"))
def ml13_leak(spark, sf):
    """A feature that looks one bar ahead must be found: it differs on the last bar before the cut."""
    b = D.stored_bars(spark, sf)
    return DS.truncation_audit(b, one_ahead, at_cutoff(b)).drop("replicas")


@query("ml13_shuffled_auc", sql("""
, o as (select symbol, trading_date, p, positive, row_number() over (order by symbol, trading_date) as seat,
  row_number() over (order by sha256(concat('shuffle-v1:', symbol, ':', cast(trading_date as varchar))), symbol, trading_date) as card from smpl),
x as (select a.p, b.positive from o a join o b on a.seat = b.card)
select round((sum(r) filter (where positive = 1) - n1 * (n1 + 1) / 2) / (n1 * n0), 6) as auc from
(select positive, rank() over (order by p) + (count(*) over (partition by p) - 1) / 2.0::double as r, cast(sum(positive) over () as double) as n1, cast(sum(1 - positive) over () as double) as n0 from x) group by n1, n0""", "smpl").replace("\n, o as", ", o as", 1))
def ml13_shuffled_auc(spark, sf):
    rows = materialize(usable(spark, sf).select("symbol", "trading_date", "p", "positive"))
    dealt = DS.shuffled_labels(rows, "positive", "shuffle-v1").withColumn("all", F.lit(1))
    return tidy(E.auc(dealt, ["all"]).select("auc"))


@query("ml15_data_gate", sql("""
select count(*) filter (where longest >= 30) as symbols_meeting, count(*) as symbols, count(*) filter (where longest >= 30) >= 20 as passes from
 (select symbol, max(n) as longest from (select symbol, idx - r as run, count(*) as n from (select symbol, idx, row_number() over (partition by symbol order by idx) as r from wbars join widx using (trading_date)) group by 1, 2) group by 1)""", "wbars", "widx"))
def ml15(spark, sf):
    return DS.data_gate(D.weekly_bars(spark, sf), index(spark, sf), 30, 20)


# --- band scoring: the tables below are this query's own parameters -------------------------------------

RSI_BANDS = [SC.Band(None, 40, 0), SC.Band(40, 50, 2), SC.Band(50, 55, 4), SC.Band(55, 60, 6), SC.Band(60, 70, 8), SC.Band(70, None, 10)]
ROC_BANDS = [SC.Band(None, 0, 0), SC.Band(0, 2, 2), SC.Band(2, 4, 4), SC.Band(4, 6, 6), SC.Band(6, 10, 8), SC.Band(10, None, 10)]
DIST_BANDS = [SC.Band(0, 2, 12), SC.Band(2, 5, 9), SC.Band(5, 10, 6), SC.Band(10, 20, 3), SC.Band(20, None, 0)]
view("pts", """
select symbol, case when rsi < 40 then 0 when rsi < 50 then 2 when rsi < 55 then 4 when rsi < 60 then 6 when rsi < 70 then 8 when rsi >= 70 then 10 end as rsi_points,
  case when roc < 0 then 0 when roc < 2 then 2 when roc < 4 then 4 when roc < 6 then 6 when roc < 10 then 8 when roc >= 10 then 10 end as roc_points,
  case when distance_from_high < 0 then null when distance_from_high < 2 then 12 when distance_from_high < 5 then 9 when distance_from_high < 10 then 6 when distance_from_high < 20 then 3 when distance_from_high >= 20 then 0 end as distance_points from feat""", "feat")


def pointed(spark, sf):
    return D.feature_quality(spark, sf).select(
        "symbol", SC.points(F.col("rsi"), RSI_BANDS).alias("rsi_points"), SC.points(F.col("roc"), ROC_BANDS).alias("roc_points"),
        SC.points(F.col("distance_from_high"), DIST_BANDS).alias("distance_points"))


def composed(spark, sf):
    return SC.composite(pointed(spark, sf), ["rsi_points", "roc_points", "distance_points"])


@query("sc1_band_points", sql("select * from pts", "pts"))
def sc1(spark, sf):
    return tidy(pointed(spark, sf))


@query("sc2_composite", sql("select symbol, rsi_points + roc_points + distance_points as composite from pts", "pts"))
def sc2(spark, sf):
    return tidy(composed(spark, sf).select("symbol", "composite"))


@query("sc3_shortlist", sql("""
select * from (select symbol, rsi_points + roc_points + distance_points as composite from pts) where composite >= 12 order by composite desc, symbol limit 10""", "pts"))
def sc3(spark, sf):
    return tidy(SC.shortlist(composed(spark, sf), 12, 10).select("symbol", "composite"))


@query("sc4_histogram", sql("select * from (select rsi_points + roc_points + distance_points as composite, count(*) as n from pts group by 1) where composite is not null", "pts"))
def sc4(spark, sf):
    return tidy(SC.histogram(composed(spark, sf)))


@query("sc4_cutoff_sweep", sql("""
select c::double as cutoff, (select count(*) from pts where rsi_points + roc_points + distance_points >= c) as candidates from (values (4), (8), (12), (16), (20)) t(c)""", "pts"))
def sc4_sweep(spark, sf):
    return SC.cutoff_sweep(composed(spark, sf), [4, 8, 12, 16, 20])
