"""Registered queries: files, payloads, stored tables, streams.

File readers run over files that Spark first writes from the given tables into the shared
folder.
"""
from __future__ import annotations

from pyspark.sql import functions as F

from barlab.plans import derived as D
from barlab.plans.oracle_views import sql, view
from barlab.plans.registry import query, tidy
from barlab.session import scratch_path
from barlab.operators import universe
from barlab.sources import files, payloads, tables
from barlab.streaming import ingest
from barlab.streaming.ledger import BatchLedger


def universe_file(spark, sf):
    path = scratch_path(spark, "universe")
    u = D.universe(spark, sf)
    u.select(F.col("company_name").alias("Company Name"), F.col("sector").alias("Industry"),
             F.concat(F.lit(" "), F.lower("symbol")).alias("Symbol"), F.col("series").alias("Series"),
             F.col("isin").alias("ISIN Code")).write.option("header", True).csv(path)
    return path


@query("src1_universe", sql("""
select upper(symbol) as symbol, company_name, coalesce(sector, '') as sector, series, isin from univ""", "univ"))
def src1(spark, sf):
    return files.read_universe(spark, universe_file(spark, sf)).drop("source_order")


@query("src2_scan_universe", sql("""
select lower(symbol) as symbol, company_name, coalesce(sector, '') as sector, series, isin, series <> 'EQ' as non_eq_series from univ""", "univ"))
def src2(spark, sf):
    return files.read_scan_universe(spark, universe_file(spark, sf))


def one_json_per(rows, key, text, spark, label):
    """One text file per key value; each key holds one row."""
    path = scratch_path(spark, label)
    rows.select(F.col(key), text.alias("value")).write.partitionBy(key).option("compression", "gzip").text(path)
    return path


def master_file(spark, sf):
    m = D.instrument_master(spark, sf).withColumn("part", F.floor(F.regexp_extract("trading_symbol", r"(\d+)", 1).cast("bigint") / 1000))
    # a part holds the instruments of a thousand members
    row = F.struct("listed", *[c for c in m.columns if c not in ("part", "listed")])
    packed = m.groupBy("part").agg(F.sort_array(F.collect_list(row)).alias("rows"))
    path = one_json_per(packed, "part", F.to_json("rows"), spark, "master")
    return files.read_instrument_master(spark, f"{path}/*/*.gz")


@query("src3_instrument_master", sql("select segment, exchange, instrument_type, isin, trading_symbol, instrument_key from master", "master"))
def src3(spark, sf):
    return master_file(spark, sf).select("segment", "exchange", "instrument_type", "isin", "trading_symbol", "instrument_key")


@query("src3_first_rows_of_file", sql("select * from keys", "keys"))
def src3_keys(spark, sf):
    """One key per ISIN by the order of the file's rows."""
    return universe.isin_keys(master_file(spark, sf), F.col("source_order"))


@query("src4_reviews", sql("""
select symbol, concat('INE', o_custkey) as isin, 'SPLIT' as event_type, effective_date, 'r, "' || o_orderkey || '"' as reason, review_state
from (select o_custkey, o_orderkey, concat('S', lpad(cast(o_custkey as varchar), 6, '0')) as symbol, cast(o_orderdate as date) as effective_date,
  case when o_orderstatus = 'F' then 'RESOLVED' else 'OPEN' end as review_state from orders)"""))
def src4(spark, sf):
    path = scratch_path(spark, "reviews")
    key = F.col("o_orderkey").cast("string")
    D.table(spark, sf, "orders").select(
        D.symbol_of(F.col("o_custkey")).alias("symbol"), F.concat(F.lit("INE"), F.col("o_custkey").cast("string")).alias("isin"),
        F.lit("SPLIT").alias("event_type"), F.to_date("o_orderdate").cast("string").alias("effective_date"),
        F.concat(F.lit('r, "'), key, F.lit('"')).alias("reason"), F.lit("").alias("reviewer"),
        F.when(F.col("o_orderstatus") == "F", "RESOLVED").otherwise("OPEN").alias("review_state")) \
        .write.option("header", True).option("escape", '"').csv(path)
    return files.read_reviews(spark, path).drop("reviewer")


def holiday_files(spark, sf):
    h = D.holidays(spark, sf).withColumn("year", F.year("date"))
    entry = F.struct(F.date_format("date", "dd-MMM-yyyy").alias("tradingDate"),
                     F.concat(F.lit(" "), "description", F.lit(" ")).alias("description"))
    # a year holds at most one entry per day
    packed = h.groupBy("year").agg(F.collect_list(entry).alias("CM"))
    return one_json_per(packed, "year", F.to_json(F.struct("CM")), spark, "holidays")


@query("src5_holiday_master", sql("select date, description from hol", "hol"))
def src5(spark, sf):
    return files.read_holidays(spark, f"{holiday_files(spark, sf)}/*/*.gz")


def resolution_file(spark, sf):
    path = scratch_path(spark, "resolutions")
    D.resolutions(spark, sf).withColumn("date", F.col("date").cast("string")).write.option("header", True).csv(path)
    return path


@query("src6_resolutions", sql("select * from res", "res"))
def src6(spark, sf):
    return files.read_resolutions(spark, resolution_file(spark, sf))


@query("src6_resolution_violations", """
select cast(o_orderdate as date) as date, count(*) as n, bool_or(o_orderstatus = 'P' or o_orderpriority = '1-URGENT') as bad from orders group by 1
having count(*) > 1 or bool_or(o_orderstatus = 'P' or o_orderpriority = '1-URGENT')""")
def src6_violations(spark, sf):
    rows = D.table(spark, sf, "orders").select(
        F.to_date("o_orderdate").alias("date"), F.when(F.col("o_orderstatus") == "P", "MAYBE").otherwise("SESSION").alias("status"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "").otherwise("C/1").alias("circulars"))
    return files.resolution_violations(rows)


@query("src7_fingerprints", sql("""
select sha256(concat(coalesce(sector, 'none'), ',', count(*), ',', cast(sum(cast(balance as decimal(18,2))) as varchar), chr(10))) as version from univ group by sector""", "univ"))
def src7(spark, sf):
    path = scratch_path(spark, "sectors")
    rows = D.universe(spark, sf).groupBy(F.coalesce("sector", F.lit("none")).alias("sector")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("balance").cast("decimal(18,2)")).alias("b"))
    rows.select("sector", F.concat_ws(",", "sector", F.col("n").cast("string"), F.col("b").cast("string")).alias("value")) \
        .write.partitionBy("sector").text(path)
    return files.fingerprints(spark, f"{path}/*/*.txt").select("version")


@query("src8_newest_input", sql("select date, description from hol where year(date) = (select max(year(date)) from hol)", "hol"))
def src8(spark, sf):
    base = scratch_path(spark, "dated")
    D.holidays(spark, sf).withColumn("year", F.year("date")).write.partitionBy("year").parquet(base)
    newest = files.newest_by_name(spark, f"{base}/year=*")
    return spark.read.parquet(newest.rsplit("/", 1)[0])


# --- payloads -----------------------------------------------------------------------------------

def _num(c):
    return F.col(c).cast("decimal(18,2)").cast("string")


def candle_payloads(spark, sf):
    """Each order as a payload of five candles: a later one first, then one whose high is no
    number, one with a broken time, a bare number and a null."""
    day = F.to_date("o_orderdate")
    row = lambda d, h, rest: F.concat(F.lit('["'), d, F.lit('",'), _num("o_totalprice"), F.lit(","), h, F.lit(","), rest, F.lit("]"))
    stamp = lambda d: F.concat(d.cast("string"), F.lit("T00:00:00+05:30"))
    text = F.concat(F.lit('{"data":{"candles":['),
                    row(stamp(F.date_add(day, 1)), _num("o_totalprice"), F.concat(_num("o_totalprice"), F.lit(",1.5,100,7"))), F.lit(","),
                    row(stamp(day), F.lit('"n/a"'), F.lit("null,2.5,200")), F.lit(","),
                    row(F.lit("not a time"), F.lit("3"), F.lit("4")), F.lit(",5,null]}}"))
    return D.table(spark, sf, "orders").select(F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("symbol"), text.alias("payload"))


CANDLES = """
select concat('O', o_orderkey) as symbol, x.place, cast(o_orderdate as date) + x.place as trading_date, case when x.place < 3 then cast(cast(o_totalprice as decimal(18,2)) as double) end as open,
  case x.place when 1 then cast(cast(o_totalprice as decimal(18,2)) as double) when 2 then 3.0 end as high,
  case x.place when 1 then cast(cast(o_totalprice as decimal(18,2)) as double) when 2 then 4.0 end as low,
  case x.place when 0 then 2.5 when 1 then 1.5 end as close, case x.place when 0 then 200.0 when 1 then 100.0 end as volume,
  case x.place when 1 then 7.0 end as open_interest from orders, (values (0), (1), (2), (3), (4)) x(place)"""


@query("src9_candle_payloads", f"select symbol, place, open, high, low, close, volume, open_interest, place >= 2 as no_time from ({CANDLES})")
def src9(spark, sf):
    rows = payloads.candles(candle_payloads(spark, sf))
    return tidy(rows.withColumn("no_time", F.col("timestamp").isNull()).drop("timestamp", "raw_time"))


@query("src10_payload_bars", f"select symbol, place as arrival, case when place < 2 then trading_date end as trading_date, open, high, low, close, volume from ({CANDLES})")
def src10(spark, sf):
    return tidy(payloads.bars_of(payloads.candles(candle_payloads(spark, sf))))


@query("src11_instrument_payloads", """
select concat('NSE:C', c_custkey) as symbol, c_name as name, 'NSE' as exchange, 'EQ' as instrument_type, c_nationkey::bigint as lot_size, 0.05 as tick_size,
  case when c_mktsegment = 'MACHINERY' then concat('K|', c_custkey) else cast(c_custkey as varchar) end as instrument_token, cast(null as varchar) as isin from customer where c_acctbal >= 0 and c_mktsegment <> 'FURNITURE'""".replace("0.05 as", "cast(0.05 as double) as"))
def src11(spark, sf):
    return payloads.instruments(instrument_payloads(spark, sf), "NSE")


def instrument_payloads(spark, sf):
    key = F.col("c_custkey").cast("string")
    seg = F.col("c_mktsegment")
    pair = lambda k, v: F.concat(F.lit(f'"{k}":"'), v, F.lit('",'))
    text = F.concat(F.lit('{"data":[{'), pair("exchange", F.when(F.col("c_acctbal") < 0, "BSE").otherwise("NSE")),
                    F.when(seg == "FURNITURE", "").otherwise(pair("tradingsymbol", F.concat(F.lit("C"), key))),
                    pair("name", F.col("c_name")), pair("instrument_token", F.when(seg == "MACHINERY", "").otherwise(key)),
                    pair("instrument_key", F.concat(F.lit("K|"), key)), pair("instrument_type", F.lit("EQ")),
                    F.lit('"tick_size":0.05,"lot_size":'), F.col("c_nationkey").cast("string"),
                    F.when(seg == "BUILDING", ".0").otherwise(""), F.lit("}]}"))
    return D.table(spark, sf, "customer").select(text.alias("payload"))


@query("src11_unknown_keys", """
select key, count(*) as n from (select unnest(['tick_size', 'lot_size', case when c_mktsegment <> 'FURNITURE' then 'tradingsymbol' end]) as key from customer) where key is not null group by 1""")
def src11_keys(spark, sf):
    """Keys of the payloads that a reader of exchange, name, type and the two identifiers would not know."""
    return payloads.unknown_keys(instrument_payloads(spark, sf), "$.data", ["exchange", "name", "instrument_type", "instrument_token", "instrument_key"])


@query("src12_quotes", """
select concat('NSE:C', c_custkey) as symbol, cast(cast(c_acctbal as decimal(18,2)) as double) as last_price, 1.5::double as high, 0.0::double as low, 0.0::double as open, 0.0::double as close,
  0.0::double as bid_price, 0.0::double as ask_price, c_nationkey::bigint as volume, 0::bigint as bid_quantity, 0::bigint as ask_quantity,
  case when c_mktsegment = 'BUILDING' then timestamp '2024-01-05 10:00:00' end as timestamp from customer where c_mktsegment not in ('FURNITURE', 'MACHINERY') and not (c_mktsegment = 'HOUSEHOLD' and c_acctbal < 0)""")
def src12(spark, sf):
    key = F.col("c_custkey").cast("string")
    seg = F.col("c_mktsegment")
    high = F.when(seg == "FURNITURE", '"high"').when(seg == "MACHINERY", "null").otherwise("1.5")
    text = F.concat(F.lit('{"data":{"NSE:C'), key, F.lit('":{"ltp":'), _num("c_acctbal"), F.lit(',"high":'), high,
                    F.when(seg == "BUILDING", ',"timestamp":"2024-01-05T10:00:00Z"').when((seg == "HOUSEHOLD") & (F.col("c_acctbal") < 0), ',"timestamp":"today"').otherwise(""),
                    F.lit(',"volume":'), F.col("c_nationkey").cast("string"), F.when(seg == "BUILDING", ".0").otherwise(""), F.lit("}}}"))
    return payloads.quotes(D.table(spark, sf, "customer").select(text.alias("payload")))


@query("src13_option_chain", """
select concat('C', c_custkey) as underlying, (c_nationkey * 10 + k)::double as strike_price, date '2024-01-01' + cast(c_custkey % 300 as int) as expiry,
  concat('CE', c_custkey, '-', c_nationkey * 10 + k) as ce_key, case when k = 100 then concat('PE', c_custkey, '-', c_nationkey * 10 + k) end as pe_key
from customer, (values (100), (110)) s(k) where c_mktsegment <> 'FURNITURE'""")
def src13(spark, sf):
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("c_custkey") % 300).cast("int"))
    expiry = F.when(F.col("c_mktsegment") == "FURNITURE", F.date_format(day, "dd/MM/yyyy")).otherwise(day.cast("string"))
    near, far = [(F.col("c_nationkey") * 10 + k).cast("string") for k in (100, 110)]
    leg = lambda kind, strike: F.concat(F.lit(f'"{kind}":{{"instrument_key":"{kind}'), F.col("c_custkey").cast("string"), F.lit("-"), strike, F.lit('"}'))
    text = F.concat(F.lit('{"data":{"expiry":"'), expiry, F.lit('","strikes":{"'), near, F.lit('":{'), leg("CE", near), F.lit(","), leg("PE", near),
                    F.lit('},"'), far, F.lit('":{'), leg("CE", far), F.lit(',"PE":{}},"ATM":{"CE":{"instrument_key":"x"}}}}}'))
    return payloads.option_chain(D.table(spark, sf, "customer").select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("underlying"), text.alias("payload")))


# --- stored tables --------------------------------------------------------------------------------

@query("snk1_replace_rows", sql("""
select concat('y', year(trading_date)) as run_id, symbol, trading_date, case when volume > 50 then round(close + 1, 4) else close end as close from bars""", "bars"))
def snk1(spark, sf):
    path = scratch_path(spark, "runs")
    b = D.bars(spark, sf).select(F.concat(F.lit("y"), F.year("trading_date").cast("string")).alias("run_id"), "symbol", "trading_date", "close", "volume")
    key = ["run_id", "symbol", "trading_date"]
    tables.replace_rows(b, path, key, F.col("volume"))
    again = b.filter("volume > 50").withColumn("close", F.round(F.col("close") + 1, 4))
    for _ in range(2):
        tables.replace_rows(again, path, key, F.col("volume"))
    return spark.read.parquet(path).select(*key, "close")


@query("snk2_refused_keys", sql("""
select symbol, trading_date, 'TWICE_IN_BATCH' as why from bars where volume > 50
union all select symbol, trading_date, 'ALREADY_STORED' from bars where trading_date >= date '2001-01-01'""", "bars"))
def snk2(spark, sf):
    path = scratch_path(spark, "snapshots")
    b = D.bars(spark, sf).select("symbol", "trading_date", "volume")
    key = ["symbol", "trading_date"]
    tables.append_snapshots(b.filter("trading_date >= date'2001-01-01'"), path, key)
    batch = b.unionByName(b.filter("volume > 50"))
    return tables.refused(batch, spark.read.schema(b.schema).parquet(path), key)


@query("snk3_manifest", sql("""
select 'calendar' as label, count(*) as rows, cast(sum(cast(concat('0x', substr(sha256(concat_ws('|', closure_reason, cast(date as varchar), holiday_master, cast(is_session as varchar), session_type, source, weekday)), 1, 15)) as bigint)) as varchar) as checksum from cal""", "cal"))
def snk3(spark, sf):
    from barlab.operators.calendar import verified_calendar
    cal = verified_calendar(D.span(spark, sf), D.holidays(spark, sf), D.resolutions(spark, sf))
    return tables.export(cal, scratch_path(spark, "calendar"), "calendar")


# --- streams ---------------------------------------------------------------------------------------

@query("st1_stream_first_copies", sql("select symbol, trading_date, close from bars", "bars"))
def st1(spark, sf):
    source, out, mark = (scratch_path(spark, n) for n in ("st1-in", "st1-out", "st1-mark"))
    b = D.bars(spark, sf).select("symbol", "trading_date", "close", F.lit("vendor").alias("source"))
    for copy in (b, b.filter("trading_date > date'2000-01-01'")):  # the second delivery repeats recent bars
        copy.write.mode("append").parquet(source)
    arriving = (spark.readStream.schema(b.schema).option("maxFilesPerTrigger", 8).parquet(source)
                .withColumn("at", F.col("trading_date").cast("timestamp")))
    kept = ingest.first_copies(arriving, "at", "4000 days", ["symbol", "trading_date", "source"])
    ingest.append_available(kept.drop("at", "source"), out, mark).awaitTermination()
    return spark.read.parquet(out)


# Three deliveries: an old part of the history, a refetch that overlaps it and reaches further for even numbers, and everything.
view("deliveries", """
select 1 as part, symbol, trading_date, close from bars where trading_date <= date '1998-06-30'
union all select 2, symbol, trading_date, close + 1 from bars where trading_date between date '1997-01-01' and case when cast(right(symbol, 1) as int) % 2 = 0 then date '2000-06-30' else date '1999-12-31' end
union all select 3, symbol, trading_date, close + 2 from bars where cast(right(symbol, 1) as int) < 8""", "bars")


@query("st1_newer_only", sql("""
, one as (select symbol, trading_date, close from deliveries where part = 1),
two as (select * from one union all select symbol, trading_date, close from deliveries d where part = 2 and trading_date > coalesce((select max(trading_date) from one where one.symbol = d.symbol), date '0001-01-01'))
select * from two union all select symbol, trading_date, close from deliveries d where part = 3 and trading_date > coalesce((select max(trading_date) from two where two.symbol = d.symbol), date '0001-01-01')""", "deliveries").replace("\n, one as", ", one as", 1))
def st1_newer(spark, sf):
    source, out, mark = (scratch_path(spark, n) for n in ("st1-in", "st1-out", "st1-mark"))
    b = D.stored_bars(spark, sf).select("symbol", "trading_date", "close")
    digit, at = F.substring("symbol", -1, 1).cast("int"), F.col("trading_date")
    upto = F.when(digit % 2 == 0, "2000-06-30").otherwise("1999-12-31").cast("date")
    second = b.filter((at >= "1997-01-01") & (at <= upto)).withColumn("close", F.col("close") + 1)
    for part in (b.filter(at <= "1998-06-30"), second, b.filter(digit < 8).withColumn("close", F.col("close") + 2)):
        part.write.mode("append").parquet(source)
        arriving = spark.readStream.schema(b.schema).parquet(source)
        # one batch a delivery; what was held is found again by the next run of the stream
        ingest.append_available(ingest.newer_only(arriving, 4000), out, mark).awaitTermination()
    return spark.read.schema(b.schema).parquet(out)


@query("snk2_batch_ledger", sql("""
select 0::bigint as batch, 'STORED' as why, count(*) as n from bars where trading_date < date '2000-01-01'
union all select 1, case when trading_date between date '1999-01-01' and date '1999-12-31' then 'ALREADY_STORED' when volume > 50 then 'TWICE_IN_BATCH' else 'STORED' end, count(*) from bars where trading_date >= date '1999-01-01' group by 2
union all select 1, 'TWICE_IN_BATCH', count(*) from bars where trading_date between date '1999-01-01' and date '1999-12-31' and volume > 50
union all select 2, 'ALREADY_STORED', count(*) from bars where not (volume > 50 and trading_date >= date '2000-01-01')
union all select 2, 'STORED', count(*) from bars where volume > 50 and trading_date >= date '2000-01-01'""", "bars").replace("select 0::bigint as batch", "select batch, why, cast(sum(n) as bigint) as n from (select 0::bigint as batch") + ") group by 1, 2 having sum(n) > 0")
def snk2_ledger(spark, sf):
    """Three batches by a stream, the second with rows that come twice, and two of them delivered again."""
    source, mark, path = (scratch_path(spark, n) for n in ("ledger-in", "ledger-mark", "ledger"))
    b = D.stored_bars(spark, sf).select("symbol", "trading_date", "close", "volume")
    at, often = F.col("trading_date"), F.col("volume") > 50
    later = b.filter(at >= "1999-01-01")
    batches = [b.filter(at < "2000-01-01"), later.unionByName(later.filter(often)), b]
    ledger = BatchLedger(path, ["symbol", "trading_date"])
    for batch in batches:
        batch.write.mode("append").parquet(source)
        arriving = spark.readStream.schema(b.schema).parquet(source)
        arriving.writeStream.foreachBatch(ledger.writer()).option("checkpointLocation", mark).trigger(availableNow=True).start().awaitTermination()
    for number in (0, 1):
        ledger.store(batches[number], number)
    rows = ledger.stored(spark, b.schema).select("batch", F.lit("STORED").alias("why"))
    return rows.unionByName(ledger.refused(spark, b.schema).select("batch", "why")).groupBy("batch", "why").agg(F.count(F.lit(1)).alias("n"))


@query("st2_stream_validated", sql("""
select symbol, trading_date, case when missing or found <> '' then 'INVALID' else 'VALID' end as status,
  case when missing then 'MISSING_FIELD' else found end as errors, content_hash from checked""", "checked"))
def st2(spark, sf):
    source, out, mark = (scratch_path(spark, n) for n in ("st2-in", "st2-out", "st2-mark"))
    raw = D.raw_candles(spark, sf)
    raw.write.parquet(source)
    arriving = spark.readStream.schema(raw.schema).parquet(source)
    ingest.append_available(ingest.validated(arriving), out, mark).awaitTermination()
    return spark.read.parquet(out).select("symbol", "trading_date", "status", F.array_join("errors", ",").alias("errors"), "content_hash")
