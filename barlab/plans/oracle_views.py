"""SQL twins of the derived tables, written on their own for the cross-check engine."""
from __future__ import annotations

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {}


def view(name: str, sql: str, *needs: str) -> None:
    VIEWS[name] = (needs, sql.strip())


def with_views(*names: str) -> str:
    """`WITH ...` text holding the named views and all they need, in order."""
    done: list[str] = []

    def visit(name: str) -> None:
        if name not in done:
            for need in VIEWS[name][0]:
                visit(need)
            done.append(name)

    for name in names:
        visit(name)
    return "WITH " + ",\n".join(f"{n} AS (\n{VIEWS[n][1]}\n)" for n in done) + "\n"


def sql(text: str, *views: str) -> str:
    return (with_views(*views) if views else "") + text.strip()


view("px", """
select l_suppkey, cast(l_shipdate as date) as d, l_orderkey, l_linenumber, l_extendedprice, l_quantity,
       100 + 10*ln(1 + l_extendedprice) as p, l_tax, l_discount from lineitem""")
view("bars", """
select concat('S', lpad(cast(l_suppkey as varchar), 6, '0')) as symbol, d as trading_date,
       round(max(case when a = 1 then p end), 4) as open, round(max(p * (1 + l_tax)), 4) as high,
       round(min(p * (1 - l_discount)), 4) as low, round(max(case when z = 1 then p end), 4) as close,
       sum(l_quantity) as volume
from (select *, row_number() over (partition by l_suppkey, d order by l_orderkey, l_linenumber, l_extendedprice, l_quantity) as a,
             row_number() over (partition by l_suppkey, d order by l_orderkey desc, l_linenumber desc, l_extendedprice desc, l_quantity desc) as z
      from px) group by l_suppkey, d""", "px")
view("bench", """
select trading_date, cast(sum(cast(close as decimal(18,4))) as double) / count(*) as close from bars group by 1""", "bars")
view("wbars", """
select symbol, week as trading_date, close, volume from (
  select symbol, cast(date_trunc('week', trading_date) as date) as week, close,
         sum(volume) over (partition by symbol, date_trunc('week', trading_date)) as volume,
         row_number() over (partition by symbol, date_trunc('week', trading_date) order by trading_date desc) as z
  from bars) where z = 1""", "bars")
view("raw", """
select symbol, trading_date, case when k % 97 = 0 then null else open end as open,
       case when k % 89 = 0 then low else high end as high, case when k % 89 = 0 then high else low end as low,
       case when k % 79 = 0 then 0.001 else close end as close,
       case when k % 83 = 0 then -1.0 when k % 71 = 0 then 0.0 else volume end as volume
from (select *, cast(substr(symbol, 2) as int) * 31 + (trading_date - date '1990-01-01') as k from bars)""", "bars")
view("univ", """
select concat(case when s_acctbal < 0 then 'DUMMY' else 'S' end, lpad(cast(s_suppkey as varchar), 6, '0')) as symbol,
       s_name as company_name, case when s_acctbal < 9000 then r_name end as sector,
       case when s_acctbal >= 0 and s_acctbal < 1500 then 'BE' else 'EQ' end as series,
       concat('INE', lpad(cast(s_suppkey as varchar), 6, '0')) as isin, s_acctbal as balance
from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey""")
view("master", """
select 'NSE_EQ' as segment, 'NSE' as exchange, 'EQ' as instrument_type,
       case when balance < 3000 or balance >= 3500 then isin end as isin, symbol as trading_symbol,
       concat('NSE_EQ|', case when balance < 7500 then isin else '' end) as instrument_key, cast(substr(isin, 4) as bigint) * 8 + 1 as listed from univ where balance < 8000
union all select 'NSE_EQ', 'NSE', 'EQ', isin, symbol, concat('NSE_EQ|Z', isin), cast(substr(isin, 4) as bigint) * 8 from univ where balance >= 6500 and balance < 7000
union all select 'NSE_EQ', 'NSE', 'BE', isin, symbol, concat('NSE_EQ|B', isin), cast(substr(isin, 4) as bigint) * 8 + 2 from univ
  where balance >= 4000 and balance < 5500 or balance >= 8000 and balance < 8500
union all select 'NSE_FO', 'NSE', 'FUT', isin, symbol, concat('NSE_FO|', isin), cast(substr(isin, 4) as bigint) * 8 + 3 from univ""", "univ")
view("runs", """
select concat('run', cast(o_orderkey as varchar)) as run_id, o_orderdate as started_at,
       case o_orderstatus when 'F' then 'COMPLETE' when 'O' then 'RUNNING' else 'ABORTED' end as status,
       case when o_orderpriority = '1-URGENT' then '["S000001","S000002"]' end as symbols_filter_json,
       case when o_orderpriority <> '5-LOW' then cast(o_orderdate as date) - 1 end as latest_closed_session,
       o_totalprice as requested from orders""")
view("acq", """
select symbol, case when balance < 2000 then 'INSUFFICIENT_HISTORY' when balance < 6000 then 'SUCCESS' else 'NO_DATA' end as status,
       case when balance < 2000 then concat(cast(cast(floor(balance) as bigint) as varchar), ' observations; 2000 required') end as reason
from univ""", "univ")

# --- indicators -------------------------------------------------------------------------
view("ratios", """
select *, lag(close) over (partition by symbol order by trading_date) as pc,
       row_number() over (partition by symbol order by trading_date) - 1 as bar_index from bars""", "bars")
view("brk", """
select symbol, count(*) as n_all, max(case when pc > 0 and (close/pc < 0.80 or close/pc > 1.25) then trading_date end) as break_date
from ratios group by symbol""", "ratios")
view("post", """
select r.*, b.break_date, b.n_all, row_number() over (partition by r.symbol order by trading_date) as rn
from ratios r join brk b using (symbol) where b.break_date is null or r.trading_date >= b.break_date""", "ratios", "brk")
view("arrs", """
select symbol, any_value(break_date) as break_date, max(case when trading_date = break_date then close/pc end) as break_ratio,
       max(case when trading_date = break_date then bar_index end) as break_index, any_value(n_all) as n_all, count(*) as n,
       max(trading_date) as last_date, list(trading_date order by trading_date) as dd, list(close order by trading_date) as c,
       list(high order by trading_date) as h, list(volume order by trading_date) as v,
       coalesce(list(greatest(close - pc, 0.0) order by trading_date) filter (where rn > 1), []) as g,
       coalesce(list(greatest(pc - close, 0.0) order by trading_date) filter (where rn > 1), []) as l,
       coalesce(list(greatest(high - low, abs(high - pc), abs(low - pc)) order by trading_date) filter (where rn > 1), []) as tr
from post group by symbol""", "post")


def ema_sql(arr: str, p: int) -> str:
    a = 2.0 / (p + 1)
    return (f"case when len({arr}) >= {p} then list_reduce({arr}[{p + 1}:], lambda e, x: {a!r}::double * x + (1 - {a!r}::double) * e,"
            f" list_sum({arr}[1:{p}]) / {p}) end")


def wilder_sql(arr: str, p: int) -> str:
    return (f"case when len({arr}) >= {p} then list_reduce({arr}[{p + 1}:], lambda e, x: (e * {p - 1} + x) / {p},"
            f" list_sum({arr}[1:{p}]) / {p}) end")


def rsi_sql(g: str, l: str, p: int) -> str:
    ag, al = wilder_sql(g, p), wilder_sql(l, p)
    return (f"case when ({ag}) is null then null when ({al}) = 0 and ({ag}) = 0 then 50.0 when ({al}) = 0 then 100.0 "
            f"else 100.0 - 100.0 / (1 + ({ag}) / ({al})) end")


view("feat0", f"""
select symbol, n, n_all, break_date, break_ratio, break_index, last_date, c, h, v, dd,
       {ema_sql('c', 20)} as ema_short, {ema_sql('c', 50)} as ema_medium, {ema_sql('c', 200)} as ema_long,
       {rsi_sql('g', 'l', 14)} as rsi, case when n > 10 then (c[n] / c[n - 10] - 1) * 100 end as roc,
       len(v[greatest(n - 19, 1):n]) = 20 and len(list_filter(v[greatest(n - 19, 1):n], lambda x: x > 0)) >= 15 as volume_usable,
       case when n >= 252 then list_max(h[n - 251:n]) end as prior_high_long,
       {wilder_sql('tr', 14)} / c[n] * 100 as atr_percent, c[n] as close,
       case when n > 60 then c[n - 60] end as s_close, case when n > 60 then dd[n - 60] end as s_date
from arrs""", "arrs")
view("feat", """
select symbol, case when n < 252 then 'INSUFFICIENT_HISTORY' else 'VALID' end as status,
       case when n < 252 and break_date is null then printf('%d bars; 252 required', n)
            when n < 252 then printf('%d post-break bars; 252 required; possible corporate-action break at bar index %d, close ratio %.4f', n, break_index, break_ratio)
            when break_date is not null then printf('possible corporate-action break at bar index %d, close ratio %.4f', break_index, break_ratio) end as reason,
       n as n_bars, n >= 252 as w52_complete, break_date, break_ratio, volume_usable, last_date, ema_short, ema_medium, ema_long,
       rsi, roc, (f.close / s_close - 1) * 100 - (e.close / s.close - 1) * 100 as relative_return,
       case when n > 20 and volume_usable then v[n] / nullif(list_sum(v[n - 20:n - 1]) / 20, 0) end as relative_volume,
       (prior_high_long - f.close) / prior_high_long * 100 as distance_from_high, prior_high_long, atr_percent, f.close
from feat0 f left join bench s on s.trading_date = f.s_date left join bench e on e.trading_date = f.last_date""", "feat0", "bench")
view("quality", """
select * replace (case when status = 'VALID' and last_date < mx then 'STALE' else status end as status,
       case when status = 'VALID' and last_date < mx then concat('last observation ', cast(last_date as varchar), ', run as-of ', cast(mx as varchar)) else reason end as reason)
from (select *, max(last_date) over () as mx from feat)""", "feat")

# --- series with planted defects ---------------------------------------------------------
view("arrived", """
select symbol, row_number() over (partition by symbol order by case when kind = 0 then -dn else dn end, copy) - 1 as arrival,
  case when kind = 1 and k % 97 = 0 then null else trading_date end as trading_date,
  case when kind = 2 and k % 97 = 0 then null else open end as open,
  case when kind = 5 and k % 89 = 0 then low else high end as high, case when kind = 5 and k % 89 = 0 then high else low end as low,
  case when kind = 3 and k % 97 = 0 then 'nan'::double when kind = 4 and k % 97 = 0 then -1.0 else close end as close,
  case when kind = 6 and k % 83 = 0 then -1.0 when kind = 7 and k % 71 = 0 then 0.0 else volume end as volume
from (select *, num % 10 as kind, num * 31 + dn as k from
   (select *, cast(substr(symbol, 2) as int) as num, trading_date - date '1990-01-01' as dn from bars)) b
join (values (0), (1)) x(copy) on copy = 0 or (kind = 8 and k % 101 = 0)""", "bars")
view("stored", """
select symbol, trading_date, m(open) as open, m(high) as high, m(low) as low, m(close) as close, cast(volume as bigint) as volume from raw""".replace(
    "m(open)", "try_cast(try_cast(cast(open as varchar) as decimal(38,20)) as decimal(18,2))").replace(
    "m(high)", "try_cast(try_cast(cast(high as varchar) as decimal(38,20)) as decimal(18,2))").replace(
    "m(low)", "try_cast(try_cast(cast(low as varchar) as decimal(38,20)) as decimal(18,2))").replace(
    "m(close)", "try_cast(try_cast(cast(close as varchar) as decimal(38,20)) as decimal(18,2))"), "raw")
view("checked", """
select *, concat_ws(',', case when high < low then 'HIGH_LESS_THAN_LOW' end,
   case when not (open between low and high) then 'OPEN_OUTSIDE_RANGE' end,
   case when not (close between low and high) then 'CLOSE_OUTSIDE_RANGE' end,
   case when open <= 0 then 'NON_POSITIVE_OPEN' end, case when high <= 0 then 'NON_POSITIVE_HIGH' end,
   case when low <= 0 then 'NON_POSITIVE_LOW' end, case when close <= 0 then 'NON_POSITIVE_CLOSE' end,
   case when volume < 0 then 'NEGATIVE_VOLUME' end) as found,
   open is null or high is null or low is null or close is null or volume is null as missing,
   sha256(concat(strftime(trading_date, '%Y-%m-%d'), '|', coalesce(cast(open as varchar), ''), '|', coalesce(cast(high as varchar), ''), '|',
     coalesce(cast(low as varchar), ''), '|', coalesce(cast(close as varchar), ''), '|', coalesce(cast(volume as varchar), ''))) as content_hash
from stored""", "stored")
view("findings", """
select symbol, arrival as position, 0 as item, 'ERROR' as severity, concat('Observation ', arrival, ': missing ', concat_ws(', ',
   case when open is null then 'open' end, case when high is null then 'high' end, case when low is null then 'low' end,
   case when close is null then 'close' end, case when volume is null then 'volume' end)) as message
 from arrived where open is null or high is null or low is null or close is null or volume is null
union all select symbol, arrival, 0, 'ERROR', concat('Observation ', arrival, ': non-finite OHLCV value') from arrived
 where isnan(close)
union all select symbol, arrival, pos, sev, concat('Observation ', arrival, ': ', msg) from
 (select * from arrived where open is not null and not isnan(close)) a,
 lateral (values (1, 'ERROR', 'non-positive price', least(open, high, low, close) <= 0),
   (2, 'ERROR', 'high below open/close/low', high < greatest(open, close, low)),
   (3, 'ERROR', 'low above open/close/high', low > least(open, close, high)),
   (4, 'ERROR', 'negative volume', volume < 0), (5, 'WARNING', 'zero volume', volume = 0)) t(pos, sev, msg, hit) where hit
union all select distinct symbol, -4, 0, 'ERROR', 'Missing or invalid trading date' from arrived where trading_date is null
union all select symbol, -3, 0, 'ERROR', 'Duplicate trading dates' from arrived group by symbol having count(trading_date) <> count(distinct trading_date)
union all select distinct symbol, -2, 0, 'ERROR', 'Trading dates are not in ascending order' from
 (select *, lag(trading_date) over (partition by symbol order by arrival) as p from arrived where trading_date is not null) where trading_date < p
union all select distinct symbol, -1, 0, 'ERROR', 'Future observation date' from arrived where trading_date > date '2001-11-03'""", "arrived")

# --- calendars, classification, mapping -----------------------------------------------------
view("span", "select cast(min(o_orderdate) as date) as first, cast(max(o_orderdate) as date) as last from orders")
view("hol", """
select date, case p when '1-URGENT' then 'Diwali Laxmi Pujan*' when '2-HIGH' then 'Union Budget' when '3-MEDIUM' then 'Republic Day'
   when '4-NOT SPECIFIED' then 'Dhanteras Trading' else 'Holi' end as description
from (select cast(o_orderdate as date) as date, o_orderpriority as p, o_totalprice,
        row_number() over (partition by o_orderdate order by o_totalprice desc, o_orderkey desc) as z from orders)
where z = 1 and o_totalprice >= 480000""")
view("res", """
select date, case when s <> 'F' then 'SESSION' else 'CLOSED' end as status, case when s <> 'F' then 'SPECIAL_LIVE' else '' end as session_type,
  concat('C/', o_orderkey) as circulars, concat('note ', o_custkey) as note
from (select cast(o_orderdate as date) as date, o_orderstatus as s, o_totalprice, o_orderkey, o_custkey,
        row_number() over (partition by o_orderdate order by o_totalprice, o_orderkey) as z from orders)
where z = 1 and o_totalprice < 10000""")
view("days", "select cast(unnest(generate_series(first, last, interval 1 day)) as date) as date from span", "span")
view("cal0", """
select d.date, coalesce(h.description, '') as descr, r.status, r.session_type as rtype, r.circulars, r.note,
  case when r.status is not null then r.status = 'SESSION'
       when isodow(d.date) <= 5 then coalesce(h.description, '') = '' or h.description similar to '.*(\\*|Special Live Trading|Union Budget|Dhanteras Trading).*'
       else coalesce(h.description similar to '.*(\\*|Special Live Trading|Union Budget|Dhanteras Trading).*', false) end as is_session
from days d left join hol h on h.date = d.date left join res r on r.date = d.date""", "days", "hol", "res")
view("cal", """
select date, strftime(date, '%a') as weekday, is_session,
  case when not is_session then '' when status is not null then rtype else 'REGULAR' end as session_type,
  case when is_session then '' when status is not null then note when descr <> '' then descr else 'weekend' end as closure_reason,
  descr as holiday_master, case when status is not null then concat('resolution:', circulars) when descr <> '' then 'nse_holiday_master' else 'weekday_rule' end as source
from cal0""", "cal0")
view("sess", "select date from cal where is_session", "cal")
view("vend", "select distinct symbol as instrument, trading_date from bars", "bars")
view("gaps", """
select distinct d + 1 as date, concat('S', lpad(cast(l_suppkey as varchar), 6, '0')) as instrument from px where l_quantity = 50""", "px")
view("diffs", """
select instrument, trading_date as date, 'vendor bar on a closed day' as finding from vend, span
 where trading_date between first and last and trading_date not in (select date from sess)
union all select instrument, date, 'session without vendor bar' from (select distinct instrument from vend), sess
 where (instrument, date) not in (select instrument, trading_date from vend)""", "vend", "sess", "span")
view("wk", """
select symbol, cast(date_trunc('week', trading_date) as date) as trading_date,
  last(open order by trading_date) as open, max(high) as high, min(low) as low, last(close order by trading_date) as close, sum(volume) as volume
from raw group by 1, 2""", "raw")
view("wkq", """
select symbol, trading_date, q(open) as open, q(high) as high, q(low) as low, q(close) as close, volume from wk""".replace(
    "q(open)", "try_cast(try_cast(cast(open as varchar) as decimal(38,20)) as decimal(18,2))").replace(
    "q(high)", "try_cast(try_cast(cast(high as varchar) as decimal(38,20)) as decimal(18,2))").replace(
    "q(low)", "try_cast(try_cast(cast(low as varchar) as decimal(38,20)) as decimal(18,2))").replace(
    "q(close)", "try_cast(try_cast(cast(close as varchar) as decimal(38,20)) as decimal(18,2))"), "wk")
view("wkv", """
select symbol, trading_date, close from wkq where open is not null and high >= low and open between low and high
  and close between low and high and open > 0 and high > 0 and low > 0 and close > 0 and volume >= 0""", "wkq")
view("weeks", "select distinct cast(date_trunc('week', d) as date) as trading_date from px", "px")
view("lastc", "select max(trading_date) as last_closed from weeks where trading_date < date '2001-11-04'", "weeks")
view("win", "select trading_date from weeks, lastc where trading_date <= last_closed order by 1 desc limit 100", "weeks", "lastc")
view("cls", """
select u.symbol, case when coalesce(available, 0) < 80 then 'INSUFFICIENT_HISTORY' when latest < last_closed then 'STALE' else 'VALID' end as status,
  case when coalesce(available, 0) < 80 then printf('only %d valid candle(s) in the trailing %d-session window (need 80)', coalesce(available, 0), n)
       when latest < last_closed then concat('latest valid candle (', cast(latest as varchar), ') is older than latest_closed_session (', cast(last_closed as varchar), ')') end as status_reason,
  coalesce(available, 0) as available, n - coalesce(available, 0) as missing, n - coalesce(available, 0) > 0 as history_gaps
from univ u left join (select symbol, count(*) filter (where trading_date in (select trading_date from win)) as available, max(trading_date) as latest from wkv group by 1) c using (symbol),
 lastc, (select count(*) as n from win)""", "univ", "wkv", "win", "lastc")
view("wkbrk", """
select symbol, bool_or(prior <> 0 and (close < 0.80 * prior or close > 1.25 * prior)) as jump from
(select symbol, close, lag(close) over (partition by symbol order by trading_date) as prior from wkv) group by 1""", "wkv")
view("rev", """
select concat('S', lpad(cast(o_custkey as varchar), 6, '0')) as symbol, cast(o_orderdate as date) as effective_date,
  case when o_orderstatus = 'F' then 'RESOLVED' else 'OPEN' end as review_state from orders""")
view("keys", """
select isin, instrument_key from (select *, row_number() over (partition by isin order by case instrument_type when 'EQ' then 1 else 2 end, listed) as z
 from master where segment = 'NSE_EQ' and instrument_type in ('EQ', 'BE') and isin <> '') where z = 1""", "master")
view("members", "select * from univ where symbol not like 'DUMMY%'", "univ")
view("scanned", """
select m.symbol, k.instrument_key, m.isin, m.series, company_name, sector,
  case when f is not null then 'FAILED' else c.status end as status, case when f is not null then f else c.status_reason end as status_reason,
  case when f is null then c.available end as available, case when f is null then c.missing end as missing,
  f is null and c.history_gaps as history_gaps,
  f is null and m.symbol in (select symbol from rev where review_state <> 'RESOLVED' and effective_date between date '2001-06-01' and date '2001-07-31') as corporate_action_review,
  f is null and coalesce(jump, false) as price_break_detected, m.series <> 'EQ' as non_eq_series
from members m left join keys k using (isin) join cls c on c.symbol = m.symbol left join wkbrk b on b.symbol = m.symbol,
 lateral (select case when k.instrument_key is null then concat('no instrument-master match for ISIN ', m.isin)
   when balance >= 6000 and balance < 6500 then 'TimeoutError: no answer' end as f)""", "members", "keys", "cls", "wkbrk", "rev")
view("mapped", """
select m.symbol, m.isin, balance, case when n > 1 then 'AMBIGUOUS' when n = 0 then 'UNMAPPED' when key like 'NSE_EQ|_%' then 'MAPPED' else 'INVALID_INSTRUMENT' end as mapping_status,
  case when n > 1 then concat(n, ' NSE_EQ instruments matched by ', case when ni > 0 then 'ISIN' else 'symbol fallback' end)
       when n = 0 then 'No NSE_EQ instrument matched by ISIN or exact symbol'
       when key not like 'NSE_EQ|_%' then 'Matched instrument has invalid/missing instrument_key' end as mapping_error,
  case when n = 1 and key like 'NSE_EQ|_%' then key end as instrument_key, case when n = 1 then typ end as instrument_type
from (select u.*, ni, case when ni > 0 then ni else ns end as n, case when ni > 0 then ki else ks end as key, case when ni > 0 then ti else ts end as typ
  from members u,
  lateral (select count(*) as ni, min(instrument_key) as ki, min(instrument_type) as ti from master i where i.segment = 'NSE_EQ' and i.isin = u.isin),
  lateral (select count(*) as ns, min(instrument_key) as ks, min(instrument_type) as ts from master i where i.segment = 'NSE_EQ' and i.trading_symbol = u.symbol)) m""", "members", "master")
view("mapall", """
select symbol, isin, mapping_status, mapping_error, cast(substr(isin, 4) as bigint) as source_order from mapped
union all select symbol, isin, 'EXCLUDED_PLACEHOLDER', 'Placeholder row excluded from scan universe', cast(substr(isin, 4) as bigint) from univ where symbol like 'DUMMY%'""", "mapped", "univ")
view("outcomes", """
select symbol, mapping_status, status, requested, case status when 'EXCLUDED' then 'Placeholder excluded' when 'MAPPING_FAILED' then mapping_error
   when 'NOT_REQUESTED' then 'Run stopped after authentication failure (HTTP 401)' when 'REQUEST_FAILED' then error when 'VALIDATION_FAILED' then concat(ne, ' validation error(s), first: ', first_error)
   when 'INSUFFICIENT_HISTORY' then printf('%d observations; 530 required', n) end as reason,
  case when status = 'SUCCESS' then 530 when requested and status <> 'REQUEST_FAILED' then n else 0 end as observation_count,
  case when status = 'SUCCESS' then 530 else 0 end as persisted_count
from (select *, status in ('REQUEST_FAILED', 'NO_DATA', 'VALIDATION_FAILED', 'INSUFFICIENT_HISTORY', 'SUCCESS') as requested from
 (select *, case when mapping_status = 'EXCLUDED_PLACEHOLDER' then 'EXCLUDED' when mapping_status <> 'MAPPED' then 'MAPPING_FAILED'
    when source_order > stop then 'NOT_REQUESTED' when error is not null then 'REQUEST_FAILED' when n = 0 then 'NO_DATA'
    when ne > 0 then 'VALIDATION_FAILED' when n < 530 then 'INSUFFICIENT_HISTORY' else 'SUCCESS' end as status
  from (select m.*, case when balance >= 6000 and balance < 6500 then 'TimeoutError: no answer' when balance >= 9950 then 'AuthenticationError: 401' end as error,
      case when balance < 6500 then coalesce(a.n, 0) else 0 end as n, e.ne, e.first_error, stop
    from mapall m join univ u using (symbol) left join (select symbol, count(*) as n from arrived group by 1) a using (symbol)
    left join (select symbol, count(*) as ne, (list(message order by position, item))[1] as first_error from findings where severity = 'ERROR' and message <> 'Future observation date' group by 1) e using (symbol),
    (select min(source_order) as stop from mapall join univ using (symbol) where mapping_status = 'MAPPED' and balance >= 9950))))""", "mapall", "univ", "findings")
