"""Bar-shaped tables that Spark derives from the given tables.

Each function reads whole tables. The SQL twin of every table is in oracle_views.py.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from barlab.config import IndicatorParams
from barlab.operators import classify as C
from barlab.operators import features
from barlab.operators import quality as Q
from barlab.operators import universe as U
from barlab.session import materialize

# Parameters of the registered queries. The break band is narrower than a split's 0.5 / 2.0
# because the derived closes move less.
PARAMS = IndicatorParams(
    ema_short=20, ema_medium=50, ema_long=200, rsi_period=14, roc_lookback=10,
    relative_return_lookback=60, rvol_window=20, high_window=252, atr_period=14,
    minimum_history_bars=252, volume_usable_bars=15, volume_usable_window=20,
    break_low_ratio=0.80, break_high_ratio=1.25)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def symbol_of(key):
    return F.concat(F.lit("S"), F.lpad(key.cast("string"), 6, "0"))


def fills(spark: SparkSession, sf: str) -> DataFrame:
    """Line items read as priced fills of a symbol on a day."""
    return table(spark, sf, "lineitem").select(
        "l_suppkey", F.to_date("l_shipdate").alias("trading_date"), "l_orderkey", "l_linenumber",
        "l_extendedprice", "l_quantity", (100 + 10 * F.ln(1 + F.col("l_extendedprice"))).alias("p"),
        "l_tax", "l_discount")


def bars(spark: SparkSession, sf: str) -> DataFrame:
    """One bar per (symbol, day). First and last fill come from a map-side minimum and maximum,
    so a supplier holding a third of all fills is reduced before the exchange. The order of
    fills (order, line, price in cents) is one decimal: a fixed-width key keeps the whole
    aggregate hashed, where a struct would have it sorted.
    """
    line = (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("decimal(20,0)")
    place = line * F.lit(10 ** 11).cast("decimal(12,0)") + F.round(F.col("l_extendedprice") * 100).cast("decimal(11,0)")
    days = fills(spark, sf).groupBy("l_suppkey", "trading_date").agg(
        F.min_by("p", place).alias("open"), F.max(F.col("p") * (1 + F.col("l_tax"))).alias("high"),
        F.min(F.col("p") * (1 - F.col("l_discount"))).alias("low"), F.max_by("p", place).alias("close"),
        F.sum("l_quantity").alias("volume"))
    r4 = lambda c: F.round(c, 4).alias(c)
    return days.select(symbol_of(F.col("l_suppkey")).alias("symbol"), "trading_date",
                       r4("open"), r4("high"), r4("low"), r4("close"), "volume")


def benchmark(spark: SparkSession, sf: str, daily: DataFrame | None = None) -> DataFrame:
    daily = bars(spark, sf) if daily is None else daily
    return daily.groupBy("trading_date").agg(
        (F.sum(F.col("close").cast("decimal(18,4)")).cast("double") / F.count(F.lit(1))).alias("close"))


def stored_bars(spark: SparkSession, sf: str) -> DataFrame:
    """Bars written down once, for queries that read them several times."""
    return materialize(bars(spark, sf), "bars")


def weekly_bars(spark: SparkSession, sf: str) -> DataFrame:
    """Weeks serve as sessions where daily bars are too sparse for a calendar."""
    return bars(spark, sf).groupBy("symbol", F.to_date(F.date_trunc("week", "trading_date")).alias("trading_date")).agg(
        F.max_by("close", "trading_date").alias("close"), F.sum("volume").alias("volume"))


def raw_candles(spark: SparkSession, sf: str, daily: DataFrame | None = None) -> DataFrame:
    """Bars with planted defects: missing open, swapped high and low, a price that rounds to
    zero, negative and zero volume."""
    k = F.substring("symbol", 2, 9).cast("int") * 31 + F.datediff("trading_date", F.lit("1990-01-01").cast("date"))
    b = (bars(spark, sf) if daily is None else daily).withColumn("k", k)
    hit = lambda n: F.col("k") % n == 0
    return b.select(
        "symbol", "trading_date",
        F.when(hit(97), F.lit(None)).otherwise(F.col("open")).alias("open"),
        F.when(hit(89), F.col("low")).otherwise(F.col("high")).alias("high"),
        F.when(hit(89), F.col("high")).otherwise(F.col("low")).alias("low"),
        F.when(hit(79), F.lit(0.001)).otherwise(F.col("close")).alias("close"),
        F.when(hit(83), F.lit(-1.0)).when(hit(71), F.lit(0.0)).otherwise(F.col("volume")).alias("volume"))


def supplier_dim(spark: SparkSession, sf: str) -> DataFrame:
    return (table(spark, sf, "supplier")
            .join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")))


def universe(spark: SparkSession, sf: str) -> DataFrame:
    key = F.lpad(F.col("s_suppkey").cast("string"), 6, "0")
    bal = F.col("s_acctbal")
    return supplier_dim(spark, sf).select(
        F.concat(F.when(bal < 0, "DUMMY").otherwise("S"), key).alias("symbol"),
        F.col("s_name").alias("company_name"),
        F.when(bal < 9000, F.col("r_name")).alias("sector"),
        F.when((bal >= 0) & (bal < 1500), "BE").otherwise("EQ").alias("series"),
        F.concat(F.lit("INE"), key).alias("isin"), bal.alias("balance"))


def instrument_master(spark: SparkSession, sf: str, members: DataFrame | None = None) -> DataFrame:
    """Equity rows for most members, some listed twice under two keys, trade-for-trade rows for
    some, a future for each. `listed` is a row's place in the file."""
    u = (universe(spark, sf) if members is None else members).withColumn("n", F.substring("isin", 4, 9).cast("bigint") * 8)
    bal = F.col("balance")
    eq = u.filter(bal < 8000).select(
        F.lit("NSE_EQ").alias("segment"), F.lit("NSE").alias("exchange"), F.lit("EQ").alias("instrument_type"),
        F.when((bal < 3000) | (bal >= 3500), F.col("isin")).alias("isin"), F.col("symbol").alias("trading_symbol"),
        F.concat(F.lit("NSE_EQ|"), F.when(bal < 7500, F.col("isin")).otherwise("")).alias("instrument_key"), (F.col("n") + 1).alias("listed"))
    again = u.filter((bal >= 6500) & (bal < 7000)).select(
        F.lit("NSE_EQ"), F.lit("NSE"), F.lit("EQ"), "isin", "symbol", F.concat(F.lit("NSE_EQ|Z"), "isin"), "n")
    be = u.filter((bal >= 4000) & (bal < 5500) | (bal >= 8000) & (bal < 8500)).select(
        F.lit("NSE_EQ"), F.lit("NSE"), F.lit("BE"), "isin", "symbol", F.concat(F.lit("NSE_EQ|B"), "isin"), F.col("n") + 2)
    fut = u.select(F.lit("NSE_FO"), F.lit("NSE"), F.lit("FUT"), "isin", "symbol", F.concat(F.lit("NSE_FO|"), "isin"), F.col("n") + 3)
    return eq.union(again).union(be).union(fut)


def scan_runs(spark: SparkSession, sf: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", "COMPLETE").when(F.col("o_orderstatus") == "O", "RUNNING") \
        .otherwise("ABORTED")
    return table(spark, sf, "orders").select(
        F.concat(F.lit("run"), F.col("o_orderkey").cast("string")).alias("run_id"),
        F.col("o_orderdate").alias("started_at"), status.alias("status"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit('["S000001","S000002"]')).alias("symbols_filter_json"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.date_sub(F.to_date("o_orderdate"), 1))
        .alias("latest_closed_session"),
        F.col("o_totalprice").alias("requested"),
        F.format_string('{"VALID": %d, "FAILED": %d}', F.floor(F.col("o_totalprice") / 1000), F.col("o_custkey")).alias("status_counts_json"),
        F.when(F.col("o_orderstatus") != "P", F.format_string('{"history_gaps": %d}', F.col("o_custkey") % 10)).alias("flag_counts_json"),
        F.when(F.col("o_orderpriority") == "2-HIGH", F.lit('["DUMMY1", "DUMMY2"]')).alias("excluded_symbols_json"),
        F.when(F.col("o_orderstatus") == "P", F.lit('["calendar: closed"]')).alias("errors_json"),
        F.format_string('["%s"]', F.to_date("o_orderdate").cast("string")).alias("calendar_dates_json"))


def feature_quality(spark: SparkSession, sf: str, daily: DataFrame | None = None) -> DataFrame:
    """Features and quality of every symbol with bars, before the staleness pass."""
    daily = bars(spark, sf) if daily is None else daily
    return features.compute_features(daily, benchmark(spark, sf, daily), PARAMS)


def acquisition_results(spark: SparkSession, sf: str) -> DataFrame:
    """Acquisition outcome per member of the universe, from the supplier balance."""
    bal = F.col("balance")
    status = F.when(bal < 2000, "INSUFFICIENT_HISTORY").when(bal < 6000, "SUCCESS").otherwise("NO_DATA")
    return universe(spark, sf).select(
        "symbol", status.alias("status"),
        F.when(bal < 2000, F.concat(F.floor(bal).cast("string"), F.lit(" observations; 2000 required"))).alias("reason"))


def arrivals(spark: SparkSession, sf: str) -> DataFrame:
    """Bars in arrival order, with one kind of defect planted per class of symbol."""
    num = F.substring("symbol", 2, 9).cast("int")
    kind = num % 10
    k = num * 31 + F.datediff("trading_date", F.lit("1990-01-01").cast("date"))
    hit = lambda cls, n: (kind == cls) & (k % n == 0)
    b = bars(spark, sf)
    copies = b.withColumn("copy", F.explode(F.when(hit(8, 101), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    place = F.when(kind == 0, -F.datediff("trading_date", F.lit("1990-01-01").cast("date"))) \
        .otherwise(F.datediff("trading_date", F.lit("1990-01-01").cast("date")))
    order = Window.partitionBy("symbol").orderBy(place, "copy")
    return copies.withColumn("arrival", (F.row_number().over(order) - 1).cast("bigint")).select(
        "symbol", "arrival", F.when(~hit(1, 97), F.col("trading_date")).alias("trading_date"),
        F.when(~hit(2, 97), F.col("open")).alias("open"),
        F.when(hit(5, 89), F.col("low")).otherwise(F.col("high")).alias("high"),
        F.when(hit(5, 89), F.col("high")).otherwise(F.col("low")).alias("low"),
        F.when(hit(3, 97), F.lit(float("nan"))).when(hit(4, 97), F.lit(-1.0)).otherwise(F.col("close")).alias("close"),
        F.when(hit(6, 83), F.lit(-1.0)).when(hit(7, 71), F.lit(0.0)).otherwise(F.col("volume")).alias("volume"))


def stamped_events(spark: SparkSession, sf: str) -> DataFrame:
    """Event times as text, with a Z, with the exchange offset, or without an offset."""
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    return table(spark, sf, "events").select(
        "event_id", "event_type",
        F.concat(text, F.when(F.col("event_type") == "click", "Z").when(F.col("event_type") == "view", "+05:30")
                 .otherwise("")).alias("stamp"))


# --- calendars -----------------------------------------------------------------------------

def span(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").agg(F.to_date(F.min("o_orderdate")).alias("first"),
                                          F.to_date(F.max("o_orderdate")).alias("last"))


def holidays(spark: SparkSession, sf: str) -> DataFrame:
    """Days whose dearest order passes a price are holidays, described by its priority."""
    top = F.max_by("o_orderpriority", F.struct("o_totalprice", "o_orderkey"))
    p = F.col("p")
    text = (F.when(p == "1-URGENT", "Diwali Laxmi Pujan*").when(p == "2-HIGH", "Union Budget").when(p == "3-MEDIUM", "Republic Day")
            .when(p == "4-NOT SPECIFIED", "Dhanteras Trading").otherwise("Holi"))
    return (table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("date"))
            .agg(top.alias("p"), F.max("o_totalprice").alias("m")).filter("m >= 480000")
            .select("date", text.alias("description")))


def resolutions(spark: SparkSession, sf: str) -> DataFrame:
    """Days whose cheapest order is under a price are ruled on by that order."""
    row = F.min(F.struct("o_totalprice", "o_orderkey", "o_orderstatus", "o_custkey"))
    open_day = F.col("r.o_orderstatus") != "F"
    return (table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("date")).agg(row.alias("r"))
            .filter("r.o_totalprice < 10000")
            .select("date", F.when(open_day, "SESSION").otherwise("CLOSED").alias("status"),
                    F.when(open_day, "SPECIAL_LIVE").otherwise("").alias("session_type"),
                    F.concat(F.lit("C/"), F.col("r.o_orderkey")).alias("circulars"),
                    F.concat(F.lit("note "), F.col("r.o_custkey")).alias("note")))


def vendor_dates(spark: SparkSession, sf: str) -> DataFrame:
    return bars(spark, sf).select(F.col("symbol").alias("instrument"), "trading_date")


def vendor_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """A known gap on the day after each fill of fifty."""
    return fills(spark, sf).filter("l_quantity = 50").select(
        F.date_add("trading_date", 1).alias("date"), symbol_of(F.col("l_suppkey")).alias("instrument")).distinct()


def weekly_candles(spark: SparkSession, sf: str, daily: DataFrame | None = None) -> DataFrame:
    last = lambda c: F.max_by(c, "trading_date").alias(c)
    return raw_candles(spark, sf, daily).groupBy(
        "symbol", F.to_date(F.date_trunc("week", "trading_date")).alias("week")).agg(
        last("open"), F.max("high").alias("high"), F.min("low").alias("low"), last("close"),
        F.sum("volume").alias("volume")).withColumnRenamed("week", "trading_date")


def weeks(spark: SparkSession, sf: str) -> DataFrame:
    """Sessions of the weekly candles, straight from the fills."""
    return fills(spark, sf).select(F.to_date(F.date_trunc("week", "trading_date")).alias("trading_date")).distinct()


def reviews(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        symbol_of(F.col("o_custkey")).alias("symbol"), F.to_date("o_orderdate").alias("effective_date"),
        F.when(F.col("o_orderstatus") == "F", "RESOLVED").otherwise("OPEN").alias("review_state"))


def corporate_actions(spark: SparkSession, sf: str) -> DataFrame:
    """Every order of a customer as an announced action of the like-numbered symbol; the urgent ones that
    are in process are confirmed."""
    confirmed = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "P")
    return table(spark, sf, "orders").select(
        symbol_of(F.col("o_custkey")).alias("symbol"), F.to_date("o_orderdate").alias("effective_date"),
        F.when(confirmed, "CONFIRMED").otherwise("RUMOURED").alias("status"))


def fetch_failures(spark: SparkSession, sf: str, members: DataFrame | None = None) -> DataFrame:
    return (universe(spark, sf) if members is None else members).filter("balance >= 6000 and balance < 6500").select(
        "symbol", F.lit("TimeoutError: no answer").alias("error"))


def companies(spark: SparkSession, sf: str) -> DataFrame:
    seg = F.col("c_mktsegment")
    return table(spark, sf, "customer").filter("c_acctbal < 7000").select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("symbol"), F.col("c_name").alias("company_name"),
        F.when(seg != "HOUSEHOLD", F.concat(F.lit("INE"), F.col("c_custkey").cast("string"))).alias("isin"),
        (seg != "FURNITURE").alias("is_active"))


def listed_instruments(spark: SparkSession, sf: str) -> DataFrame:
    """Provider rows for the company dimension: renamed, re-numbered, other exchanges, futures;
    some companies are listed twice, the second time under another name."""
    seg, bal = F.col("c_mktsegment"), F.col("c_acctbal")
    again = (seg == "AUTOMOBILE") & (bal >= 5000)
    rows = table(spark, sf, "customer").filter("c_acctbal >= -500").withColumn("nth", F.explode(F.when(again, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    return rows.select(
        F.concat(F.when(bal > 9500, "").otherwise("NSE:"), F.lit("C"), F.col("c_custkey").cast("string")).alias("symbol"),
        F.concat(F.lit(" "), F.col("c_name"), F.when(seg == "MACHINERY", " Ltd").when(F.col("nth") == 1, " Again").otherwise("")).alias("name"),
        F.when(bal < 0, "BSE").otherwise("NSE").alias("exchange"),
        F.when((bal >= 1000) & (bal < 2000), "FUT").otherwise("EQ").alias("instrument_type"),
        F.concat(F.lit("INE"), F.col("c_custkey").cast("string"), F.when(seg == "BUILDING", "X").otherwise("")).alias("isin"),
        (F.col("c_custkey") * 2 + F.col("nth")).alias("listed"))


def run_events(spark: SparkSession, sf: str) -> DataFrame:
    """Orders read as lifecycle events; a customer is a run."""
    status = F.when(F.col("o_orderstatus") == "F", "COMPLETE").when(F.col("o_orderstatus") == "O", "RUNNING") \
        .otherwise("ABORTED")
    return table(spark, sf, "orders").select(
        F.concat(F.lit("run"), F.col("o_custkey").cast("string")).alias("run_id"), F.col("o_orderdate").alias("at"),
        F.col("o_orderkey").alias("seq"), status.alias("status"),
        F.when(F.col("o_orderstatus") == "P", "CALENDAR_INVALID").alias("abort_reason"),
        F.when(F.col("o_orderstatus") != "O", F.col("o_orderdate")).alias("finished_at"),
        F.when(F.col("o_orderpriority") != "1-URGENT", "u1").alias("universe_version"),
        F.when(F.col("o_orderpriority") != "5-LOW", "v1").alias("review_version"))


def acquisition_runs(spark: SparkSession, sf: str) -> DataFrame:
    r = F.col("o_totalprice")
    return table(spark, sf, "orders").select(
        F.concat(F.lit("acq"), F.col("o_orderkey").cast("string")).alias("run_id"), F.col("o_orderdate").alias("started_at"),
        F.when(F.col("o_orderstatus") == "F", "COMPLETE").otherwise("FAILED").alias("status"),
        F.floor(r / 1000).alias("universe_count"), F.floor(r / 1000).alias("mapped_count"),
        F.when(F.col("o_orderpriority") == "2-HIGH", F.lit(0)).otherwise(F.floor(r / 1000)).alias("requested_count"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "FAILED").otherwise("OK").alias("benchmark_status"))


def mappings(spark: SparkSession, sf: str) -> DataFrame:
    """Mapping of every constituent, placeholders included, in supplier order."""
    u = universe(spark, sf)
    mapped = U.map_constituents(U.eligible(u), instrument_master(spark, sf))
    out = U.mark_placeholders(u).filter("excluded_reason is not null").select(
        "symbol", "isin", F.lit("EXCLUDED_PLACEHOLDER").alias("mapping_status"),
        F.lit("Placeholder row excluded from scan universe").alias("mapping_error"))
    cols = ["symbol", "isin", "mapping_status", "mapping_error"]
    return mapped.select(*cols).unionByName(out).withColumn("source_order", F.substring("isin", 4, 9).cast("bigint"))


def acquisition_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    got = arrivals(spark, sf).join(universe(spark, sf).filter("balance < 6500").select("symbol"), "symbol", "left_semi")
    fetched = got.groupBy("symbol").agg(F.count(F.lit(1)).alias("observations"))
    checked = Q.series_status(got).select("symbol", F.col("status").alias("validation_status"), "error_count", "first_error")
    failures = fetch_failures(spark, sf).withColumn("is_auth", F.lit(False)).unionByName(
        universe(spark, sf).filter("balance >= 9950").select("symbol", F.lit("AuthenticationError: 401").alias("error"),
                                                            F.lit(True).alias("is_auth")))
    return C.acquisition_outcomes(mappings(spark, sf), failures, fetched, checked, None, 530)
