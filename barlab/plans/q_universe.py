"""Registered queries: universe, instrument mapping, company dimension."""
from __future__ import annotations

from pyspark.sql import functions as F

from barlab.operators import bars as B
from barlab.operators import universe as U
from barlab.plans import derived as D
from barlab.plans.oracle_views import sql
from barlab.plans.registry import query


@query("flt01_normalize_symbol", """
select c_custkey, upper(c_mktsegment || case when c_acctbal < 0 then ' ' || c_custkey else '-' || c_custkey end) as symbol,
  case when c_acctbal < 0 then concat('Malformed symbol: ', lower(c_mktsegment) || ' ' || c_custkey) end as normalization_error from customer""")
def flt01(spark, sf):
    key = F.col("c_custkey").cast("string")
    raw = F.concat(F.lit("  "), F.lower("c_mktsegment"), F.when(F.col("c_acctbal") < 0, " ").otherwise("-"), key)
    return U.normalize_symbols(D.table(spark, sf, "customer").select("c_custkey", raw.alias("symbol")))


@query("flt02_placeholders", sql("""
select symbol, case when symbol like 'DUMMY%' then 'DUMMY_SYMBOL' end as excluded_reason from univ""", "univ"))
def flt02(spark, sf):
    return U.mark_placeholders(D.universe(spark, sf)).select("symbol", "excluded_reason")


@query("flt03_duplicate_symbols", """
select concat(c_mktsegment, '-', c_nationkey) as symbol, count(*) as n from customer group by 1 having count(*) > 1""")
def flt03(spark, sf):
    c = D.table(spark, sf, "customer").select(F.concat_ws("-", "c_mktsegment", F.col("c_nationkey").cast("string")).alias("symbol"))
    return U.duplicate_symbols(c)


@query("flt14_accepted_instruments", sql("""
select * from master where segment = 'NSE_EQ' and instrument_type in ('EQ', 'BE')""", "master"))
def flt14(spark, sf):
    return U.accepted(D.instrument_master(spark, sf))


CAND = """
select concat('C', c_custkey) as symbol, trim(c_name || case when c_mktsegment = 'MACHINERY' then ' Ltd' when nth = 1 then ' Again' else '' end) as company_name,
  case when c_acctbal < 0 then 'BSE' else 'NSE' end as exchange, concat('INE', c_custkey, case when c_mktsegment = 'BUILDING' then 'X' else '' end) as isin,
  c_acctbal >= 0 and not (c_acctbal >= 1000 and c_acctbal < 2000) as kept, c_custkey * 2 + nth as listed
from customer, (values (0), (1)) x(nth) where c_acctbal >= -500 and (nth = 0 or c_mktsegment = 'AUTOMOBILE' and c_acctbal >= 5000)"""


@query("flt15_sync_candidates", CAND)
def flt15(spark, sf):
    return U.sync_candidates(D.listed_instruments(spark, sf))


@query("flt16_requested_symbols", sql("""
select distinct symbol, symbol in (select symbol from univ) as known from rev""", "rev", "univ"))
def flt16(spark, sf):
    return U.unknown_requests(D.universe(spark, sf), D.reviews(spark, sf))


@query("jn01_map_constituents", sql("""
select symbol, isin, mapping_status, mapping_error, instrument_key, instrument_type from mapped""", "mapped"))
def jn01(spark, sf):
    out = U.map_constituents(U.eligible(D.universe(spark, sf)), D.instrument_master(spark, sf))
    return out.select("symbol", "isin", "mapping_status", "mapping_error", "instrument_key", "instrument_type")


@query("jn02_isin_keys", sql("select * from keys", "keys"))
def jn02(spark, sf):
    return U.isin_keys(D.instrument_master(spark, sf), F.col("listed"))


@query("jn03_unmatched_isins", sql("select distinct isin from univ where isin not in (select isin from keys)", "univ", "keys"))
def jn03(spark, sf):
    return U.unmatched_isins(D.universe(spark, sf), U.isin_keys(D.instrument_master(spark, sf), F.col("listed")))


@query("jn03_mapping_report", sql("""
select count(distinct isin) filter (where isin in (select isin from keys)) as matched, count(distinct isin) filter (where isin not in (select isin from keys)) as unmatched,
  (select count(*) from master) as total_instruments, (select count(*) from master where segment = 'NSE_EQ') as accepted from univ""", "univ", "keys", "master"))
def jn03_report(spark, sf):
    master = D.instrument_master(spark, sf)
    return U.mapping_report(D.universe(spark, sf), master, U.isin_keys(master, F.col("listed")))


DIM = """WITH e as (select concat('C', c_custkey) as symbol, c_name as company_name, case when c_mktsegment <> 'HOUSEHOLD' then concat('INE', c_custkey) end as isin,
  c_mktsegment <> 'FURNITURE' as is_active from customer where c_acctbal < 7000),
c as (""" + CAND + """), k as (select c.*, e.symbol is not null as held, e.is_active, row_number() over w as nth, case when row_number() over w = 1 then e.company_name else lag(c.company_name) over w end as pn,
  case when row_number() over w = 1 then e.isin else lag(c.isin) over w end as pi from c left join e on e.symbol = c.symbol where kept window w as (partition by c.symbol order by c.listed)),
i as (select symbol, arg_max(company_name, listed) as company_name, arg_max(isin, listed) as isin, bool_or(held) as held,
  count(*) filter (where (pn is distinct from company_name or pi is distinct from isin or nth = 1 and not is_active) and (nth > 1 or held)) as updates from k group by 1),
dim as (select symbol, company_name, isin, true as is_active, case when not held then 'INSERTED' when updates > 0 then 'UPDATED' else 'UNCHANGED' end as action, updates from i
 union all select symbol, company_name, isin, is_active, 'UNTOUCHED', 0 from e where symbol not in (select symbol from i))
"""


def dimension(spark, sf):
    incoming = U.sync_candidates(D.listed_instruments(spark, sf)).filter("kept")
    return U.upsert_companies(D.companies(spark, sf), incoming)


@query("jn18_company_upsert", DIM + "select * from dim")
def jn18(spark, sf):
    return dimension(spark, sf)


@query("ag24_sync_metrics", DIM + """
select count(*) filter (where action = 'INSERTED') as inserted, cast(sum(updates) as bigint) as updated, 0::bigint as failed,
  (select count(*) from c) as total_received, (select count(*) from c where not kept) as skipped from dim""")
def ag24(spark, sf):
    return U.sync_metrics(U.sync_candidates(D.listed_instruments(spark, sf)), dimension(spark, sf))


HELD = "(select * from bars where trading_date < date '2001-06-01' or volume > 20)"


@query("jn19_newer_backfill", sql(f"""
, held as {HELD}, newest as (select symbol, max(trading_date) as m from held group by 1)
select symbol, trading_date, close from held
union all select b.symbol, b.trading_date, b.close from bars b join newest using (symbol) where m < date '2001-10-01' and b.trading_date > m""", "bars").replace("\n, held as", ", held as", 1))
def jn19(spark, sf):
    b = D.bars(spark, sf)
    held = b.filter("trading_date < date'2001-06-01' or volume > 20")
    return B.append_newer(held, b, F.lit("2001-10-01").cast("date")).select("symbol", "trading_date", "close")


@query("set04_union_newer", sql(f"""
, held as {HELD}, newest as (select symbol, max(trading_date) as m from held group by 1)
select symbol, count(*) as bars, max(trading_date) as last_date from (select symbol, trading_date from held
union all select b.symbol, b.trading_date from bars b join newest using (symbol) where m < date '2001-11-04' and b.trading_date > m) group by 1""", "bars").replace("\n, held as", ", held as", 1))
def set04(spark, sf):
    b = D.bars(spark, sf)
    held = b.filter("trading_date < date'2001-06-01' or volume > 20")
    merged = B.append_newer(held, b, F.lit("2001-11-04").cast("date"))
    return merged.groupBy("symbol").agg(F.count(F.lit(1)).alias("bars"), F.max("trading_date").alias("last_date"))
