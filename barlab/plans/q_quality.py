"""Registered queries: candle and series validation, scalar functions."""
from __future__ import annotations

from pyspark.sql import functions as F

from barlab.functions.numeric import money2, money_text, share_pct, share_pct_or_zero
from barlab.functions.temporal import exchange_wall_time, release_date_text
from barlab.operators import quality as Q
from barlab.plans import derived as D
from barlab.plans.oracle_views import sql
from barlab.plans.registry import query, tidy


@query("flt04_candle_validation", sql("""
select symbol, trading_date, case when missing or found <> '' then 'INVALID' else 'VALID' end as status,
  case when missing then 'MISSING_FIELD' else found end as errors from checked""", "checked"))
def flt04(spark, sf):
    return Q.validate_candles(D.raw_candles(spark, sf)).select(
        "symbol", "trading_date", "status", F.array_join("errors", ",").alias("errors"))


def _as_of():
    return F.lit("2001-11-03").cast("date")


@query("flt05_series_findings", sql("select * exclude (item) from findings", "findings"))
def flt05(spark, sf):
    return Q.series_findings(D.arrivals(spark, sf), _as_of()).drop("item")


@query("flt05_series_status", sql("""
select symbol, observations, coalesce(e, 0) as error_count, coalesce(w, 0) as warning_count, first_error,
  case when e > 0 then 'INVALID' when w > 0 then 'VALID_WITH_WARNINGS' else 'VALID' end as status
from (select symbol, count(*) as observations from arrived group by 1) left join
 (select symbol, count(*) filter (where severity = 'ERROR') as e, count(*) filter (where severity = 'WARNING') as w,
   (list(message order by position, item) filter (where severity = 'ERROR'))[1] as first_error from findings group by 1) using (symbol)""", "findings"))
def flt05_status(spark, sf):
    return Q.series_status(D.arrivals(spark, sf), _as_of())


@query("flt06_required_columns", sql("""
select symbol, arrival, high is not null and low is not null and close is not null as has_required from arrived""", "arrived"))
def flt06(spark, sf):
    return Q.has_required(D.arrivals(spark, sf)).select("symbol", "arrival", "has_required")


@query("flt07_duplicate_dates", sql("""
select symbol, max(n) > 1 as has_duplicates from (select symbol, trading_date, count(*) as n from arrived group by 1, 2) group by 1""", "arrived"))
def flt07(spark, sf):
    return Q.duplicate_dates(D.arrivals(spark, sf))


@query("flt08_ascending_dates", sql("""
select symbol, coalesce(bool_and(trading_date > p), true) as ascending from
(select *, lag(trading_date) over (partition by symbol order by arrival) as p from arrived where trading_date is not null) group by 1""", "arrived"))
def flt08(spark, sf):
    return Q.strictly_ascending(D.arrivals(spark, sf))


def _checks(spark, sf):
    return Q.price_checks(D.raw_candles(spark, sf), 535, F.lit("2001-10-25").cast("date"))


@query("flt09_non_positive_price", sql("""
select symbol, coalesce(bool_or(high <= 0 or low <= 0 or close <= 0), false) as non_positive from raw group by 1""", "raw"))
def flt09(spark, sf):
    return _checks(spark, sf).select("symbol", "non_positive")


@query("flt10_inverted_high_low", sql("""
select symbol, coalesce(bool_or(high < low), false) as inverted from raw group by 1""", "raw"))
def flt10(spark, sf):
    return _checks(spark, sf).select("symbol", "inverted")


@query("flt11_minimum_history", sql("""
select symbol, count(*) >= 535 as enough_history, cast(null as boolean) as undecided from raw group by 1""", "raw"))
def flt11(spark, sf):
    undecided = Q.price_checks(D.raw_candles(spark, sf), None, None)
    return (_checks(spark, sf).select("symbol", "enough_history")
            .join(undecided.select("symbol", F.col("enough_history").alias("undecided")), "symbol"))


@query("flt12_usable_volume", sql("""
select symbol, trading_date, volume is not null and count(volume) over a = 20 and count(case when volume > 0 then 1 end) over a >= 20 as usable
from raw window a as (partition by symbol order by trading_date rows between 20 preceding and 1 preceding)""", "raw"))
def flt12(spark, sf):
    return Q.usable_volume(D.raw_candles(spark, sf), 20, 20).select("symbol", "trading_date", "usable")


@query("flt13_stale", sql("select symbol, max(trading_date) < date '2001-10-25' as stale from raw group by 1", "raw"))
def flt13(spark, sf):
    return _checks(spark, sf).select("symbol", "stale")


@query("fn01_round_half_up", sql("""
select symbol, trading_date, cast(open as double) as open, cast(close as double) as close from stored""", "stored"))
def fn01(spark, sf):
    return D.raw_candles(spark, sf).select("symbol", "trading_date", money2(F.col("open")).cast("double").alias("open"),
                                           money2(F.col("close")).cast("double").alias("close"))


@query("fn01_hard_numbers", """
select o_orderkey, case o_orderstatus when 'F' then 0.0::double when 'O' then null else 0.01::double end as money from orders""")
def fn01_hard(spark, sf):
    """Just under a half cent, beyond what a price can hold, exactly a half cent."""
    n = F.when(F.col("o_orderstatus") == "F", F.lit(0.00499999999995)).when(F.col("o_orderstatus") == "O", F.lit(1e17)).otherwise(F.lit(0.005))
    return D.table(spark, sf, "orders").select("o_orderkey", money2(n).cast("double").alias("money"))


@query("fn02_price_text", sql("""
select symbol, trading_date, cast(open as varchar) as open, cast(close as varchar) as close from stored""", "stored"))
def fn02(spark, sf):
    return D.raw_candles(spark, sf).select("symbol", "trading_date", money_text(F.col("open")).alias("open"),
                                           money_text(F.col("close")).alias("close"))


@query("fn03_content_hash", sql("select symbol, trading_date, content_hash from checked", "checked"))
def fn03(spark, sf):
    return Q.snapshots(D.raw_candles(spark, sf)).select("symbol", "trading_date", "content_hash")


@query("fn04_rehash", sql("select symbol, trading_date, coalesce(volume % 7, 1) <> 0 as hash_matches from stored", "stored"))
def fn04(spark, sf):
    """Rows with a volume of whole sevens were altered after they were stored."""
    kept = Q.snapshots(D.raw_candles(spark, sf))
    altered = kept.withColumn("volume", F.when(F.col("volume") % 7 == 0, F.col("volume") + 1).otherwise(F.col("volume")))
    return Q.rehash(altered).select("symbol", "trading_date", "hash_matches")


@query("fn05_share", """
select event_type, count(*) as n, count(*) filter (where value > 250) as large,
  round(count(*) filter (where value > 250) * 100.0::double / count(*), 1) as pct,
  coalesce(round(count(*) filter (where value > 250) * 100.0::double / nullif(count(*) filter (where value > 250 or value < 1), 0), 2), 0.0) as pct2
from events group by 1""")
def fn05(spark, sf):
    e = D.table(spark, sf, "events").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("value") > 250).alias("large"),
        F.count_if((F.col("value") > 250) | (F.col("value") < 1)).alias("either"))
    return e.select("event_type", "n", "large", share_pct(F.col("large"), F.col("n")).alias("pct"),
                    share_pct_or_zero(F.col("large"), F.col("either")).alias("pct2"))


@query("fn07_json_columns", sql("""
select run_id, json_array_length(symbols_filter_json) as n_symbols, json_extract_string(symbols_filter_json, '$[0]') as first_symbol,
  symbols_filter_json as again from runs""", "runs"))
def fn07(spark, sf):
    parsed = D.scan_runs(spark, sf).withColumn("s", F.from_json("symbols_filter_json", "array<string>"))
    return parsed.select("run_id", F.when(F.col("s").isNotNull(), F.size("s")).cast("bigint").alias("n_symbols"),
                         F.get("s", F.lit(0)).alias("first_symbol"), F.to_json("s").alias("again"))


@query("fn08_wall_time", """
select event_id, strftime(case when event_type = 'click' then s + interval 330 minute else s end, '%Y-%m-%d %H:%M:%S') as wall
from (select *, date_trunc('second', ts) as s from events)""")
def fn08(spark, sf):
    return D.stamped_events(spark, sf).select(
        "event_id", F.date_format(exchange_wall_time(F.col("stamp")), "yyyy-MM-dd HH:mm:ss").alias("wall"))


@query("fn09_announcement_date", """
select o_orderkey, cast(o_orderdate as date) as parsed from orders""")
def fn09(spark, sf):
    day = F.col("o_orderdate")
    ordinal = F.when(F.dayofmonth(day).isin(1, 21, 31), "st").when(F.dayofmonth(day).isin(2, 22), "nd") \
        .when(F.dayofmonth(day).isin(3, 23), "rd").otherwise("th")
    text = F.when(F.col("o_orderstatus") == "F", F.concat(F.date_format(day, "MMMM d"), ordinal, F.date_format(day, ", yyyy"))) \
        .when(F.col("o_orderstatus") == "O", F.concat(F.date_format(day, "d"), ordinal, F.date_format(day, " MMM. yyyy"))) \
        .otherwise(F.date_format(day, "MMM d,yyyy"))
    return D.table(spark, sf, "orders").select("o_orderkey", release_date_text(text).alias("parsed"))


@query("fn10_day_arithmetic", """
select o_orderkey, strftime(o_orderdate, '%a') as weekday, isodow(o_orderdate) as iso_day, year(o_orderdate) as year,
  cast(o_orderdate as date) + 5 as later from orders""")
def fn10(spark, sf):
    day = F.to_date("o_orderdate")
    return tidy(D.table(spark, sf, "orders").select(
        "o_orderkey", F.date_format(day, "EEE").alias("weekday"), (F.weekday(day) + 1).alias("iso_day"),
        F.year(day).alias("year"), F.date_add(day, 5).alias("later")))
