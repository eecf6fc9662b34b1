"""Registered queries: index membership and survivorship."""
from __future__ import annotations

from pyspark.sql import functions as F

from barlab.operators import membership as M
from barlab.operators import survivorship as V
from barlab.operators import universe as U
from barlab.plans import derived as D
from barlab.plans.oracle_views import sql, view
from barlab.plans.registry import query, tidy

SNAP, LAST, W1 = "2022-12-31", "2022-12-26", "2021-12-27"


def day(text):
    return F.lit(text).cast("date")


# Event hours become weekly dates from 2011 on, so that a month of events spans years.
def dated(spark, sf):
    e = D.table(spark, sf, "events")
    hours = F.datediff(F.to_date("ts"), day("2024-01-01")) * 24 + F.hour("ts")
    return e.select("event_type", "value", F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("symbol"),
                    F.date_add(day("2011-01-03"), hours * 7).alias("date"),
                    F.concat(F.lit("rel"), F.floor(F.minute("ts") / 15).cast("string")).alias("part"))


def events(spark, sf):
    """Signups include, errors exclude, clicks revoke an inclusion; a quarter hour is a release.
    Some signups are stated three times over."""
    d = dated(spark, sf).filter(F.col("event_type").isin("signup", "error", "click"))
    action = F.when(F.col("event_type") == "signup", "INCLUDE").when(F.col("event_type") == "error", "EXCLUDE").otherwise("CANCEL_INCLUDE")
    return d.select("part", F.when(F.col("value") < 200, F.col("date")).alias("effective_date"), action.alias("action"), "symbol", "date",
                    F.when((F.col("event_type") == "signup") & F.col("value").between(150, 230), 3).otherwise(1).alias("times")) \
        .select(F.concat(F.col("part"), F.lit("-"), F.col("date").cast("string")).alias("file"), "effective_date", "action", "symbol", "times") \
        .withColumn("_", F.explode(F.sequence(F.lit(1), "times"))).drop("_", "times")


def snapshot(spark, sf):
    worth = lambda t: F.coalesce(F.sum(F.when(F.col("event_type") == t, F.col("value").cast("decimal(18,2)"))), F.lit(0))
    return dated(spark, sf).groupBy("symbol").agg(worth("purchase").alias("p"), worth("view").alias("v")).filter("p > v").select("symbol")


def voids(spark, sf):
    """Releases whose dearest view passes a value are void, wholly or for that user, some without a date."""
    v = dated(spark, sf).filter("event_type = 'view' and value > 150")
    return v.select(F.concat(F.col("part"), F.lit("-"), F.col("date").cast("string")).alias("file"),
                    F.when((F.col("value") < 200) | (F.col("value") >= 260), F.col("date")).alias("effective_date"),
                    F.when(F.col("value") > 300, "*").otherwise(F.col("symbol")).alias("symbol")).distinct()


def aliases(spark, sf):
    """Users whose dearest event is a view changed their symbol once."""
    top = dated(spark, sf).groupBy("symbol").agg(F.max_by("event_type", F.struct("value", "event_type")).alias("t"))
    return top.filter("t = 'view'").select(F.col("symbol").alias("old_symbol"), F.concat("symbol", F.lit("N")).alias("new_symbol"))


def coverage(spark, sf):
    return covered(spark, sf, snapshot(spark, sf))


def sessions(spark, sf):
    return dated(spark, sf).select(F.col("date").alias("trading_date")).distinct().filter(F.col("trading_date") <= day(LAST))


def study(spark, sf):
    return M.Reconstruction(events(spark, sf), voids(spark, sf), aliases(spark, sf), snapshot(spark, sf), day(SNAP))


def covered(spark, sf, found):
    """First and last bar of the snapshot's symbols, from purchases."""
    return dated(spark, sf).filter("event_type = 'purchase'").groupBy("symbol").agg(
        F.min("date").alias("first_bar"), F.max("date").alias("last_bar")).join(found, "symbol", "left_semi")


def classed(spark, sf):
    s = study(spark, sf)
    samples = V.candidate_samples(covered(spark, sf, s.snapshot), sessions(spark, sf), day(LAST))
    return V.classify_samples(samples, s.intervals(), s.anomaly_windows())


def stretches(spark, sf):
    s = study(spark, sf)
    return V.class_stretches(covered(spark, sf, s.snapshot), s.intervals(), s.anomaly_windows(), day(LAST))


view("dated", """
select event_type, value, concat('U', user_id) as symbol, date '2011-01-03' + cast(floor(epoch_us(ts - timestamp '2024-01-01') / 3600000000) * 7 as int) as date,
  concat('rel', cast(floor(minute(ts) / 15) as int)) as part from events
""".replace("epoch_us(ts - timestamp '2024-01-01')", "(epoch_us(ts) - epoch_us(timestamp '2024-01-01'))"))
view("mev", """
select concat(part, '-', cast(date as varchar)) as file, case when value < 200 then date end as effective_date,
  case event_type when 'signup' then 'INCLUDE' when 'error' then 'EXCLUDE' else 'CANCEL_INCLUDE' end as action, symbol from dated,
  lateral (select unnest(range(case when event_type = 'signup' and value between 150 and 230 then 3 else 1 end)))
where event_type in ('signup', 'error', 'click')""", "dated")
view("snap", """
select symbol from dated group by 1 having coalesce(sum(cast(value as decimal(18,2))) filter (where event_type = 'purchase'), 0)
  > coalesce(sum(cast(value as decimal(18,2))) filter (where event_type = 'view'), 0)""", "dated")
view("voided", """
select distinct concat(part, '-', cast(date as varchar)) as file, case when value < 200 or value >= 260 then date end as effective_date, case when value > 300 then '*' else symbol end as symbol
from dated where event_type = 'view' and value > 150""", "dated")
view("alias", """
select symbol as old_symbol, concat(symbol, 'N') as new_symbol from (select symbol, event_type, row_number() over (partition by symbol order by value desc, event_type desc) as z from dated)
where z = 1 and event_type = 'view'""", "dated")
view("unvoid", """
select * from mev e where not exists (select 1 from voided v where v.file = e.file and v.effective_date is not distinct from e.effective_date and v.symbol in ('*', e.symbol))""", "mev", "voided")
# A cancel list meets an announcement list; the greedy walk over both is a recursion on the number of
# cancels taken, each removing one copy.
view("lists", """
select replace(action, 'CANCEL_', '') as kind, symbol, effective_date,
  coalesce(list(file order by file) filter (where action not like 'CANCEL%'), []) as a,
  coalesce(list(file order by file) filter (where action like 'CANCEL%'), []) as c from unvoid group by 1, 2, 3""", "unvoid")
view("walk", """
select * from (with recursive w(kind, symbol, effective_date, a, c, i, canceller, hit) as (
  select kind, symbol, effective_date, a, c, 0, cast(null as varchar), cast(null as varchar) from lists
  union all
  select kind, symbol, effective_date, case when h is null then a else list_concat(a[:list_position(a, h) - 1], a[list_position(a, h) + 1:]) end, c, i + 1, c[i + 1], h
  from (select *, list_filter(a, lambda x: x <> c[i + 1])[-1] as h from w where i < len(c)))
select * from w)""", "lists")
view("stand", """
select unnest(a) as file, effective_date, kind as action, symbol from walk where i = len(c)""", "walk")
view("chg", """
select effective_date, action, coalesce(new_symbol, s.symbol) as symbol, max(file) as file from stand s left join alias on old_symbol = s.symbol
where effective_date is not null group by 1, 2, 3""", "stand", "alias")
view("stt0", """
select symbol, effective_date, max(file) filter (where action = 'INCLUDE') as inc, max(file) filter (where action = 'EXCLUDE') as exc
from chg where effective_date <= date '2022-12-31' group by 1, 2""", "chg")
view("stt", """
select *, exc is not null as before, symbol in (select symbol from snap) as in_snapshot,
  coalesce(lead(exc is not null) over (partition by symbol order by effective_date), symbol in (select symbol from snap)) as after from stt0""", "stt0", "snap")
view("anom", """
select effective_date, inc as file, symbol, 'INCLUDE_NOT_MEMBER' as "check" from stt where inc is not null and not after
union all select effective_date, exc, symbol, 'EXCLUDE_IS_MEMBER' from stt where exc is not null and after""", "stt")
view("endx", "select coalesce(min(effective_date), date '9999-12-31') as e from chg where effective_date > date '2022-12-31'", "chg")
view("seg", """
select symbol, effective_date as start, after as member, inc is not null as included, (inc is not null and not after) or (exc is not null and after) as anomalous from stt
union all select symbol, null, (list(before order by effective_date))[1], false, false from stt group by 1
union all select symbol, null, true, false, false from snap where symbol not in (select symbol from stt)""", "stt", "snap")
view("ivl", """
select symbol, case when bool_or(start is null) then null else min(start) end as member_from, max(until) as member_until,
  symbol in (select symbol from snap) as in_snapshot, symbol in (select symbol from anom) as touched_by_anomaly
from (select *, sum(case when included or not coalesce(pm, false) then 1 else 0 end) over (partition by symbol order by start nulls first) as island
  from (select seg.*, coalesce(lead(start) over w, e) as until, lag(member) over w as pm from seg, endx window w as (partition by symbol order by start nulls first)) where member)
group by symbol, island""", "seg", "endx", "snap", "anom")
view("tlf", "select distinct effective_date, inc as file from stt where inc is not null union select distinct effective_date, exc from stt where exc is not null", "stt")
view("tl", """
select effective_date, (select count(*) from tlf where tlf.effective_date = stt.effective_date) as n_files,
  cast((select count(*) from snap) + sum(sum(cast(before as int) - cast(after as int))) over (order by effective_date desc) as bigint) as size_before from stt group by 1""", "stt", "snap", "tlf")
view("drift", """
select effective_date as since, coalesce(lead(size_before) over (order by effective_date) - (select count(*) from snap), 0) as drift from tl
union all select null, (list(size_before order by effective_date))[1] - (select count(*) from snap) from tl having count(*) > 0""", "tl", "snap")
view("mcov", """
select symbol, min(date) as first_bar, max(date) as last_bar from dated where event_type = 'purchase' and symbol in (select symbol from snap) group by 1""", "dated", "snap")
view("msess", "select distinct date as trading_date from dated where date <= date '2022-12-26'", "dated")
view("wnd", """
select distinct a.symbol, a.effective_date as start, coalesce((select min(c.effective_date) from chg c where c.symbol = a.symbol and c.effective_date > a.effective_date), date '9999-12-31') as until
from anom a where a.symbol in (select symbol from snap)""", "anom", "chg", "snap")
view("smp", """
select symbol, trading_date from mcov, msess where trading_date between first_bar and least(last_bar, date '2022-12-26')""", "mcov", "msess")
view("smpc", """
select symbol, trading_date, case when exists (select 1 from wnd w where w.symbol = s.symbol and w.start <= trading_date and trading_date < w.until) then 'UNCERTAIN_CHAIN'
  when exists (select 1 from ivl i where i.symbol = s.symbol and (member_from is null or member_from <= trading_date) and trading_date < member_until) then 'MEMBER_RECONSTRUCTED'
  else 'NOT_MEMBER_RECONSTRUCTED' end as class from smp s""", "smp", "wnd", "ivl")
view("sdrift", """
select trading_date, coalesce((select arg_max(drift, coalesce(since, date '0001-01-01')) from drift where since is null or since <= trading_date), 0) as drift from msess""", "msess", "drift")


@query("jn08_void_events", sql("select * from unvoid", "unvoid"))
def jn08(spark, sf):
    return M.apply_voids(events(spark, sf), voids(spark, sf))


@query("jn09_cancellations", sql("""
select canceller as cancelling_file, hit as cancelled_file, symbol, kind, effective_date from walk where i > 0""", "walk"))
def jn09(spark, sf):
    return M.cancellations(M.match_cancellations(M.apply_voids(events(spark, sf), voids(spark, sf))))


@query("jn09_standing_events", sql("select * from stand", "stand"))
def jn09_standing(spark, sf):
    return M.standing_events(M.match_cancellations(M.apply_voids(events(spark, sf), voids(spark, sf))))


@query("jn10_symbol_alias", sql("select m.file, effective_date, action, coalesce(new_symbol, m.symbol) as symbol from mev m left join alias on old_symbol = m.symbol", "mev", "alias"))
def jn10(spark, sf):
    return M.rename(events(spark, sf), aliases(spark, sf)).select("file", "effective_date", "action", "symbol")


@query("mem01_intervals", sql("select * from ivl", "ivl"))
def mem01(spark, sf):
    return study(spark, sf).intervals()


@query("mem02_anomalies", sql("select * from anom", "anom"))
def mem02(spark, sf):
    return study(spark, sf).anomalies()


@query("mem03_timeline", sql("select * from tl", "tl"))
def mem03(spark, sf):
    return study(spark, sf).timeline()


@query("mem03_timeline_files", sql("select * from tlf", "tlf"))
def mem03_files(spark, sf):
    return study(spark, sf).timeline_files()


@query("mem04_listed_not_applied", sql("""
select file, effective_date, action, symbol from stand where effective_date is null or effective_date > date '2022-12-31'""", "stand"))
def mem04(spark, sf):
    standing = M.standing_events(M.match_cancellations(M.apply_voids(events(spark, sf), voids(spark, sf))))
    return M.undated(standing).unionByName(M.after_snapshot(standing, day(SNAP)))


@query("mem05_last_announced", sql("select effective_date, action, symbol, max(file) as file from stand group by 1, 2, 3", "stand"))
def mem05(spark, sf):
    return M.last_announced(M.standing_events(M.match_cancellations(M.apply_voids(events(spark, sf), voids(spark, sf)))))


@query("mem06_anomaly_windows", sql("select * from wnd", "wnd"))
def mem06(spark, sf):
    return study(spark, sf).anomaly_windows()


@query("mem07_sample_classes", sql("select * from smpc", "smpc"))
def mem07(spark, sf):
    return classed(spark, sf)


@query("mem08_drift_states", sql("select * from drift", "drift"))
def mem08(spark, sf):
    return study(spark, sf).drift_states()


@query("set03_member_set", sql("""
select symbol, before as before_first_event from (select symbol, before, row_number() over (partition by symbol order by effective_date) as z from stt) where z = 1""", "stt"))
def set03(spark, sf):
    s = study(spark, sf)
    opening = s.segments().filter("start is null")
    touched = s.states.select("symbol").distinct()
    return opening.join(touched, "symbol", "left_semi").select("symbol", F.col("member").alias("before_first_event"))


@query("jn11_was_member", sql("""
select symbol, trading_date, exists (select 1 from ivl i where i.symbol = s.symbol and (member_from is null or member_from <= trading_date) and trading_date < member_until) as member from smp s""", "smp", "ivl"))
def jn11(spark, sf):
    s = study(spark, sf)
    samples = V.candidate_samples(covered(spark, sf, s.snapshot), sessions(spark, sf), day(LAST))
    return V.was_member(samples, s.intervals())


@query("jn12_candidate_samples", sql("select * from smp", "smp"))
def jn12(spark, sf):
    return V.candidate_samples(coverage(spark, sf), sessions(spark, sf), day(LAST))


@query("jn13_drift_in_force", sql("select * from sdrift", "sdrift"))
def jn13(spark, sf):
    return V.drift_on(sessions(spark, sf), study(spark, sf).drift_states())


@query("jn17_departed_names", sql("""
select symbol, concat('NSE_EQ|', symbol) as instrument_key, true as resolved from (select distinct symbol from stand where action = 'EXCLUDE' and effective_date >= date '2015-01-01' and symbol not in (select symbol from snap)) where symbol in (select symbol from dated where event_type = 'purchase' and value > 100)
union all select symbol, null, false from (select distinct symbol from stand where action = 'EXCLUDE' and effective_date >= date '2015-01-01' and symbol not in (select symbol from snap)) where symbol not in (select symbol from dated where event_type = 'purchase' and value > 100)""", "stand", "snap", "dated"))
def jn17(spark, sf):
    listed = dated(spark, sf).filter("event_type = 'purchase' and value > 100").select(
        F.lit("NSE_EQ").alias("segment"), F.lit("EQ").alias("instrument_type"), F.col("symbol").alias("trading_symbol"),
        F.concat(F.lit("NSE_EQ|"), "symbol").alias("instrument_key"))
    standing = M.standing_events(M.match_cancellations(M.apply_voids(events(spark, sf), voids(spark, sf))))
    return U.departed(standing, snapshot(spark, sf), listed, day("2015-01-01"))


@query("ag16_entrants", sql("select symbol, first_bar, year(first_bar) as year from mcov where first_bar > date '2011-01-10'", "mcov"))
def ag16(spark, sf):
    return tidy(V.entrants(coverage(spark, sf), day("2011-01-10")))


@query("ag16_entrants_by_year", sql("select year(first_bar) as year, count(*) as entrants from mcov where first_bar > date '2011-01-10' group by 1", "mcov"))
def ag16_year(spark, sf):
    return tidy(V.entrants_by_year(coverage(spark, sf), day("2011-01-10")))


CLASS_SQL = ", ".join(f"count(*) filter (where class = '{c}') as {c.lower()}" for c in V.CLASSES)


@query("ag17_samples_by_year", sql(f"""
select *, round(not_member_reconstructed * 100.0::double / samples, 2) as not_member_pct, round(uncertain_chain * 100.0::double / samples, 2) as uncertain_pct from
(select year(trading_date) as year, {CLASS_SQL}, count(*) as samples from smpc group by rollup(1))""".replace("rollup(1)", "rollup(year(trading_date))"), "smpc"))
def ag17(spark, sf):
    return tidy(V.samples_by_year(stretches(spark, sf), sessions(spark, sf)))


@query("ag17_samples_by_symbol", sql(f"select symbol, {CLASS_SQL}, count(*) as samples from smpc group by 1", "smpc"))
def ag17_symbol(spark, sf):
    return V.samples_by_symbol(stretches(spark, sf), sessions(spark, sf))


@query("ag17_symbol_audit", sql(f"""
select s.*, first_bar, symbol in (select symbol from ivl where touched_by_anomaly) as touched_by_anomaly from (select symbol, {CLASS_SQL}, count(*) as samples from smpc group by 1) s left join mcov using (symbol)""", "smpc", "mcov", "ivl"))
def ag17_audit(spark, sf):
    s = study(spark, sf)
    held = covered(spark, sf, s.snapshot)
    found = s.intervals()
    return V.symbol_audit(V.class_stretches(held, found, s.anomaly_windows(), day(LAST)), sessions(spark, sf), held, found)


@query("ag17_window_shares", sql(f"""
select *, coalesce(round(not_member_reconstructed * 100.0::double / nullif(samples, 0), 2), 0.0) as not_member_pct, coalesce(round(uncertain_chain * 100.0::double / nullif(samples, 0), 2), 0.0) as uncertain_pct from
(select {CLASS_SQL}, count(*) as samples from smpc where trading_date between date '2021-12-27' and date '2022-12-26')""", "smpc"))
def ag17_window(spark, sf):
    return V.window_shares(stretches(spark, sf), sessions(spark, sf), day(W1), day(LAST))


@query("ag18_not_full_period", sql("""
select symbol from mcov m where exists (select 1 from msess s where trading_date between date '2021-12-27' and date '2022-12-26' and
 (exists (select 1 from wnd w where w.symbol = m.symbol and w.start <= trading_date and trading_date < w.until)
  or not exists (select 1 from ivl i where i.symbol = m.symbol and (member_from is null or member_from <= trading_date) and trading_date < member_until)))""", "mcov", "msess", "wnd", "ivl"))
def ag18(spark, sf):
    s = study(spark, sf)
    return V.not_full_period(covered(spark, sf, s.snapshot), s.segments(), sessions(spark, sf), day(W1), day(LAST), s.end())


@query("ag18_beyond_the_end", sql("""
select symbol from mcov m where exists (select 1 from (select distinct date as trading_date from dated) s where trading_date between date '2022-06-27' and date '2023-12-25' and
 (exists (select 1 from wnd w where w.symbol = m.symbol and w.start <= trading_date and trading_date < w.until)
  or not exists (select 1 from ivl i where i.symbol = m.symbol and (member_from is null or member_from <= trading_date) and trading_date < member_until)))""", "mcov", "dated", "wnd", "ivl"))
def ag18_beyond(spark, sf):
    s = study(spark, sf)
    return V.not_full_period(covered(spark, sf, s.snapshot), s.segments(), dated(spark, sf).select(F.col("date").alias("trading_date")).distinct(), day("2022-06-27"), day("2023-12-25"), s.end())


@query("ag19_members_outside_universe", sql("""
, pick as (select year, trading_date from (select year(trading_date) as year, trading_date, row_number() over (partition by year(trading_date) order by trading_date) - 1 as i,
    count(*) over (partition by year(trading_date)) as n from msess) where i % greatest(1, n // 12) = 0),
m as (select trading_date, count(distinct symbol) as m, count(distinct symbol) filter (where not in_snapshot) as absent from pick, ivl
  where (member_from is null or member_from <= trading_date) and trading_date < member_until group by 1)
select year, count(*) as sessions_sampled, round(coalesce(sum(m), 0)::double / count(*), 1) as mean_members, round(coalesce(sum(absent), 0)::double / count(*), 1) as mean_not_in_universe,
  coalesce(round(sum(absent) * 100.0::double / nullif(sum(m), 0), 2), 0.0) as share_pct from pick left join m using (trading_date) group by 1""", "msess", "ivl").replace("\n, pick as", ", pick as", 1))
def ag19(spark, sf):
    s = study(spark, sf)
    return tidy(V.members_outside_universe(s.intervals(), s.snapshot, sessions(spark, sf)))


@query("ag20_drift_by_year", sql("select year(trading_date) as year, round(avg(drift), 2) as mean_drift, max(abs(drift)) as max_abs_drift from sdrift group by 1", "sdrift"))
def ag20(spark, sf):
    return tidy(V.drift_by_year(sessions(spark, sf), study(spark, sf).drift_states()))


@query("ag21_early_entries", sql("select symbol, member_from, first_bar from ivl join mcov using (symbol) where member_from < first_bar", "ivl", "mcov"))
def ag21(spark, sf):
    s = study(spark, sf)
    return V.early_entries(s.intervals(), covered(spark, sf, s.snapshot))


@query("ag22_removed_coverage", sql("""
, r as (select symbol, min(date) filter (where event_type = 'purchase') as first_bar, max(date) filter (where event_type = 'purchase') as last_bar,
   max(value) > 150 as resolved, case when min(value) < 0.5 then 'HTTP 429' end as error from dated where symbol not in (select symbol from snap) group by 1)
select count(*) filter (where resolved) as sampled, count(*) filter (where not resolved) as unresolved, count(*) filter (where resolved and first_bar is not null and error is null) as served_history,
  count(error) as errors, count(*) filter (where resolved and first_bar is not null and error is null and last_bar < date '2024-06-01') as ended_before from r""", "dated", "snap").replace("\n, r as", ", r as", 1))
def ag22(spark, sf):
    buy = F.when(F.col("event_type") == "purchase", F.col("date"))
    r = dated(spark, sf).join(snapshot(spark, sf), "symbol", "left_anti").groupBy("symbol").agg(
        F.min(buy).alias("first_bar"), F.max(buy).alias("last_bar"), (F.max("value") > 150).alias("resolved"),
        F.when(F.min("value") < 0.5, "HTTP 429").alias("error"))
    return V.removed_coverage(r, day("2024-06-01"))
