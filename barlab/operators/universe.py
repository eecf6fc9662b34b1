"""Universe rows, instrument mapping and the company dimension."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from barlab.functions.text import strip

# The shape of a symbol, the placeholder prefix and the equity segment's names.
SYMBOL_PATTERN = r"^[A-Z0-9&._-]{1,32}$"
PLACEHOLDER_PREFIX = "DUMMY"
EQUITY_SEGMENT = "NSE_EQ"
EQUITY_EXCHANGES = ("NSE", "NSE_EQ")
ACCEPTED_TYPES = ("EQ", "BE")  # in order of preference
SYNC_TYPES = ("EQ", "Preference", "Debenture")
SYNC_EXCHANGE = "NSE"


def normalize_symbols(universe: DataFrame) -> DataFrame:
    """Trim and upper-case; a malformed symbol keeps its row with an error text (FLT1)."""
    raw = strip(F.coalesce("symbol", F.lit("")))
    symbol = F.upper(raw)
    error = F.concat(F.lit("Malformed symbol: "), raw)
    return universe.withColumn("normalization_error", F.when(~symbol.rlike(SYMBOL_PATTERN), error)) \
        .withColumn("symbol", symbol)


def mark_placeholders(universe: DataFrame) -> DataFrame:
    """Placeholder rows are kept, with the reason they are excluded (FLT2)."""
    return universe.withColumn("excluded_reason", F.when(
        F.startswith(F.upper("symbol"), F.lit(PLACEHOLDER_PREFIX)), "DUMMY_SYMBOL"))


def eligible(universe: DataFrame) -> DataFrame:
    return mark_placeholders(universe).filter("excluded_reason is null").drop("excluded_reason")


def duplicate_symbols(universe: DataFrame) -> DataFrame:
    """Symbols listed more than once; any row here rejects the universe (FLT3)."""
    return universe.groupBy("symbol").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def with_series_flag(universe: DataFrame) -> DataFrame:
    return universe.withColumn("non_eq_series", F.col("series") != "EQ")


def requested(universe: DataFrame, symbols: list[str]) -> tuple[DataFrame, list[str]]:
    """Members asked for, and the asked symbols nobody carries; none known is an error (FLT16).

    The list is typed by a caller, so it is small by nature.
    """
    wanted = universe.sparkSession.createDataFrame([(s,) for s in sorted(set(symbols))], "symbol string")
    unknown = [r["symbol"] for r in wanted.join(universe, "symbol", "left_anti").orderBy("symbol").collect()]
    if len(unknown) == len(set(symbols)):
        raise ValueError(f"no requested symbol is in the universe: {unknown}")
    return universe.join(wanted, "symbol", "left_semi"), unknown


def unknown_requests(universe: DataFrame, wanted: DataFrame) -> DataFrame:
    """Requested symbols with whether the universe carries them (FLT16)."""
    known = universe.select("symbol").distinct().withColumn("known", F.lit(True))
    return wanted.select("symbol").distinct().join(known, "symbol", "left") \
        .withColumn("known", F.coalesce("known", F.lit(False)))


# --- instruments ----------------------------------------------------------------------------

def accepted(instruments: DataFrame) -> DataFrame:
    """Equity-segment rows of the accepted types (FLT14)."""
    return instruments.filter((F.col("segment") == EQUITY_SEGMENT) & F.col("instrument_type").isin(*ACCEPTED_TYPES))


def _clean(col: str) -> Column:
    return F.upper(strip(F.coalesce(F.col(col), F.lit(""))))


def map_constituents(members: DataFrame, instruments: DataFrame) -> DataFrame:
    """Match by ISIN, else by symbol, and judge the match by how many there are (JN1).

    Both lookups are reduced to a count and one instrument per key before they are joined,
    so an ISIN shared by many rows never multiplies members.
    """
    pool = accepted(instruments).filter(F.col("exchange").isin(*EQUITY_EXCHANGES)) \
        .withColumn("isin", _clean("isin")).withColumn("trading_symbol", _clean("trading_symbol"))
    one = F.min(F.struct(F.coalesce("instrument_key", F.lit("")).alias("key"), "instrument_type"))

    def lookup(key: str, prefix: str) -> DataFrame:
        return pool.filter(F.col(key) != "").groupBy(F.col(key).alias(f"{prefix}_id")).agg(
            F.count(F.lit(1)).alias(f"{prefix}_n"), one.alias(f"{prefix}_hit"))

    rows = normalize_symbols(members)
    by_isin, by_symbol = lookup("isin", "i"), lookup("trading_symbol", "s")
    rows = (rows.join(by_isin, F.nullif(_clean("isin"), F.lit("")) == F.col("i_id"), "left")
            .join(by_symbol, F.when(F.col("i_n").isNull(), F.col("symbol")) == F.col("s_id"), "left"))
    n = F.coalesce("i_n", "s_n", F.lit(0))
    hit = F.coalesce("i_hit", "s_hit")
    good_key = hit["key"].rlike(r"^NSE_EQ\|(?s:.+)$")
    bad_symbol = F.col("normalization_error").isNotNull()
    status = (F.when(bad_symbol, "INVALID_INSTRUMENT").when(n > 1, "AMBIGUOUS").when(n == 0, "UNMAPPED")
              .when(good_key, "MAPPED").otherwise("INVALID_INSTRUMENT"))
    basis = F.when(F.col("i_n").isNotNull(), "ISIN").otherwise("symbol fallback")
    error = (F.when(bad_symbol, F.col("normalization_error"))
             .when(n > 1, F.concat(n.cast("string"), F.lit(" NSE_EQ instruments matched by "), basis))
             .when(n == 0, "No NSE_EQ instrument matched by ISIN or exact symbol")
             .when(~good_key, "Matched instrument has invalid/missing instrument_key"))
    single = ~bad_symbol & (n == 1)
    return rows.select(*[c for c in members.columns], status.alias("mapping_status"), error.alias("mapping_error"),
                       F.when(single & good_key, hit["key"]).alias("instrument_key"),
                       F.when(single, hit["instrument_type"]).alias("instrument_type"))


def isin_keys(instruments: DataFrame, order: Column) -> DataFrame:
    """One key per ISIN: EQ beats BE, the first row wins within a type (JN2)."""
    preference = F.array_position(F.array(*[F.lit(t) for t in ACCEPTED_TYPES]), F.col("instrument_type"))
    best = F.min(F.struct(preference.alias("p"), order.alias("o"), F.col("instrument_key").alias("key")))
    return (accepted(instruments).filter(F.coalesce("isin", F.lit("")) != "")
            .groupBy("isin").agg(best.alias("b")).select("isin", F.col("b.key").alias("instrument_key")))


def unmatched_isins(universe: DataFrame, keys: DataFrame) -> DataFrame:
    """Distinct universe ISINs without an instrument (JN3)."""
    return universe.select("isin").distinct().join(keys, "isin", "left_anti")


def mapping_report(universe: DataFrame, instruments: DataFrame, keys: DataFrame) -> DataFrame:
    """Totals of one mapping: rows, accepted rows, matched and unmatched ISINs (JN3)."""
    hits = universe.select("isin").distinct().join(keys.withColumn("_hit", F.lit(1)), "isin", "left")
    totals = instruments.agg(F.count(F.lit(1)).alias("total_instruments")).scalar()
    taken = accepted(instruments).agg(F.count(F.lit(1))).scalar()
    return hits.agg(F.count("_hit").alias("matched"), F.count_if(F.col("_hit").isNull()).alias("unmatched")) \
        .withColumn("total_instruments", totals).withColumn("accepted", taken)


def departed(events: DataFrame, snapshot: DataFrame, instruments: DataFrame, since: Column) -> DataFrame:
    """Names excluded since a date and absent from the snapshot, resolved by trading symbol (JN17)."""
    eq = instruments.filter((F.col("segment") == EQUITY_SEGMENT) & (F.col("instrument_type") == "EQ"))
    keys = eq.groupBy(F.col("trading_symbol").alias("symbol")).agg(F.max("instrument_key").alias("instrument_key"))
    left = (events.filter((F.col("action") == "EXCLUDE") & (F.col("effective_date") >= since))
            .select("symbol").distinct().join(snapshot.select("symbol"), "symbol", "left_anti"))
    return left.join(keys, "symbol", "left").withColumn("resolved", F.col("instrument_key").isNotNull())


# --- company dimension ------------------------------------------------------------------------

def sync_candidates(instruments: DataFrame) -> DataFrame:
    """Instruments normalized for the company dimension, with those to skip marked (FLT15).
    `listed` is a row's place in what the provider sent."""
    keep = (F.col("exchange") == SYNC_EXCHANGE) & F.col("instrument_type").isin(*SYNC_TYPES)
    bare = F.when(F.contains("symbol", F.lit(":")), F.split_part("symbol", F.lit(":"), F.lit(2))).otherwise(F.col("symbol"))
    return instruments.select(
        bare.alias("symbol"), strip(F.coalesce("name", F.lit(""))).alias("company_name"), "exchange", "isin",
        F.coalesce(keep, F.lit(False)).alias("kept"), "listed")


def upsert_companies(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """The new dimension with what was done to each company (JN18).

    Rows of one symbol are taken in the order listed: the first inserts a company that is not
    held, every later one updates it where it differs, and the last one's values stay. `updates`
    counts the rows that changed something. Companies that are not in the list stay as they are.
    """
    values = ("company_name", "isin")
    e = existing.select("symbol", *[F.col(c).alias(f"e_{c}") for c in (*values, "is_active")], F.lit(True).alias("in_e"))
    line = Window.partitionBy("symbol").orderBy("listed")  # rows of one company
    i = incoming.select("symbol", *[F.col(c).alias(f"i_{c}") for c in values], "listed", F.row_number().over(line).alias("nth"),
                        *[F.lag(c).over(line).alias(f"p_{c}") for c in values])
    rows = i.join(e, "symbol", "left")
    first = F.col("nth") == 1
    differs = F.lit(False)
    for c in values:
        differs = differs | ~F.when(first, F.col(f"e_{c}")).otherwise(F.col(f"p_{c}")).eqNullSafe(F.col(f"i_{c}"))
    updates = F.when(first, F.col("in_e").isNotNull() & (differs | ~F.coalesce("e_is_active", F.lit(False)))).otherwise(differs)
    seen = rows.groupBy("symbol").agg(F.count_if(updates).alias("updates"), F.bool_or("in_e").alias("held"),
                                      F.max_by(F.struct(*[f"i_{c}" for c in values]), "listed").alias("last"))
    taken = seen.select("symbol", *[F.col(f"last.i_{c}").alias(c) for c in values], F.lit(True).alias("is_active"),
                        F.when(F.col("held").isNull(), "INSERTED").when(F.col("updates") > 0, "UPDATED").otherwise("UNCHANGED").alias("action"), "updates")
    rest = existing.join(incoming.select("symbol"), "symbol", "left_anti")
    return taken.unionByName(rest.select("symbol", *values, "is_active", F.lit("UNTOUCHED").alias("action"), F.lit(0).cast("bigint").alias("updates")))


def sync_metrics(candidates: DataFrame, dimension: DataFrame) -> DataFrame:
    """Received, inserted, updated, skipped and failed rows of one sync (AG24)."""
    received = candidates.agg(F.count(F.lit(1))).scalar()
    skipped = candidates.agg(F.count_if(~F.col("kept"))).scalar()
    return dimension.agg(
        F.count_if(F.col("action") == "INSERTED").alias("inserted"), F.sum("updates").alias("updated"),
        F.count_if(F.col("symbol").isNull() | (F.col("symbol") == "")).alias("failed")) \
        .withColumn("total_received", received).withColumn("skipped", skipped)
