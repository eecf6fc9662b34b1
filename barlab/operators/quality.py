"""Row and series validation of candles."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from barlab.functions.numeric import hash_of_fields, money2
from barlab.operators.bars import by_symbol

PRICES = ("open", "high", "low", "close")
FIELDS = (*PRICES, "volume")
# Arrivals of one symbol are walked in blocks of this many, so a symbol that holds a large
# share of all rows is spread over many tasks.
ARRIVAL_BLOCK = 65536


def candle_codes(q: dict[str, Column], volume: Column) -> Column:
    """Ordered error codes of one candle, on 2dp prices, as one text; empty when sound. A missing
    field hides all others (FLT4)."""
    missing = volume.isNull()
    for value in q.values():
        missing = missing | value.isNull()
    outside = lambda v: ~v.between(q["low"], q["high"])
    # joined as text first: unlike a filtered array this stays inside generated code
    found = F.concat_ws(
        ",", F.when(q["high"] < q["low"], F.lit("HIGH_LESS_THAN_LOW")),
        F.when(outside(q["open"]), F.lit("OPEN_OUTSIDE_RANGE")),
        F.when(outside(q["close"]), F.lit("CLOSE_OUTSIDE_RANGE")),
        *[F.when(q[n] <= 0, F.lit(f"NON_POSITIVE_{n.upper()}")) for n in PRICES],
        F.when(volume < 0, F.lit("NEGATIVE_VOLUME")))
    return F.when(missing, F.lit("MISSING_FIELD")).otherwise(found)


def _quantized(candles: DataFrame) -> DataFrame:
    """2dp prices as columns of their own, so that each is computed once."""
    return candles.withColumns({f"_{n}": money2(F.col(n)) for n in PRICES}).withColumn(
        "_codes", candle_codes({n: F.col(f"_{n}") for n in PRICES}, F.col("volume")))


def _judged(quantized: DataFrame) -> DataFrame:
    codes = F.col("_codes")
    return quantized.withColumn("errors", F.when(codes == "", F.array().cast("array<string>")).otherwise(F.split(codes, ","))) \
        .withColumn("status", F.when(codes == "", "VALID").otherwise("INVALID"))


def validate_candles(candles: DataFrame) -> DataFrame:
    """Adds status and errors to every candle (FLT4)."""
    return _judged(_quantized(candles)).drop(*[f"_{n}" for n in PRICES], "_codes")


def stored_hash() -> Column:
    """Hash of a stored row: the date, the 2dp price texts, the whole volume."""
    return hash_of_fields(F.col("trading_date").cast("string"), *[F.col(n) for n in PRICES], F.col("volume").cast("string"))


def snapshots(candles: DataFrame) -> DataFrame:
    """Candles as stored: 2dp price text, whole volume, status, codes, content hash (FN2, FN3)."""
    stored = _judged(_quantized(candles)).select(
        "symbol", "trading_date", *[F.col(f"_{n}").cast("string").alias(n) for n in PRICES],
        F.col("volume").cast("bigint").alias("volume"), "status", "errors")
    return stored.withColumn("content_hash", stored_hash())


def rehash(stored: DataFrame) -> DataFrame:
    """Hash of stored rows from their stored text, compared with the hash kept (FN4)."""
    return stored.withColumn("hash_matches", stored_hash() == F.col("content_hash"))


# --- whole-series validation --------------------------------------------------------------

def arrival_summary(candles: DataFrame, as_of: Column | None = None) -> DataFrame:
    """One row per symbol with all that its arrivals say about the series: observations, undated,
    dated, days (distinct dates), back and flat (a date before, or not after, the one that arrived
    before it), late (after `as_of`), error_count, warning_count, first_error of single rows.

    Arrivals are walked in blocks. What a block leaves behind is a summary that merges with others:
    counts, its first and last date, the first error, and the days it holds as bitmaps of 32,768 days.
    Blocks are then put in order by their summaries alone, so the arrivals are read and exchanged once
    and a symbol with a large share of them is spread over many tasks.
    """
    day, at = F.col("trading_date"), F.col("arrival")
    before = Window.partitionBy("symbol", "_block").orderBy("arrival").rowsBetween(Window.unboundedPreceding, -1)
    number = F.datediff(day, F.lit("1970-01-01").cast("date")).cast("long")
    found = row_findings()
    errors = F.filter("_found", lambda f: f["severity"] == "ERROR")
    rows = candles.withColumn("_block", F.floor(at / ARRIVAL_BLOCK)).withColumn("_prior", F.last("trading_date", ignorenulls=True).over(before))
    rows = rows.withColumn("_found", found).select(
        "symbol", "_block", "arrival", "trading_date", "_prior", F.coalesce(F.bitmap_bucket_number(number), F.lit(0)).alias("_bucket"),
        F.bitmap_bit_position(number).alias("_bit"), F.size(errors).alias("_errors"), (F.size("_found") - F.size(errors)).alias("_warnings"),
        F.get(errors, F.lit(0))["message"].alias("_error"))
    late = F.lit(False) if as_of is None else day > as_of
    some = lambda c: F.coalesce(F.bool_or(c), F.lit(False))
    dated, failed = F.when(day.isNotNull(), at), F.when(F.col("_error").isNotNull(), at)
    blocks = rows.groupBy("symbol", "_block", "_bucket").agg(
        F.count(F.lit(1)).alias("observations"), F.count("trading_date").alias("dated"), some(day < F.col("_prior")).alias("back"),
        some(day <= F.col("_prior")).alias("flat"), some(late).alias("late"), F.sum("_errors").alias("error_count"), F.sum("_warnings").alias("warning_count"),
        F.min_by("_error", failed).alias("first_error"), F.min(failed).alias("_error_at"),
        F.min_by("trading_date", dated).alias("_first"), F.min(dated).alias("_first_at"),
        F.max_by("trading_date", dated).alias("_last"), F.max(dated).alias("_last_at"), F.bitmap_construct_agg("_bit").alias("_days"))
    block = Window.partitionBy("symbol", "_block")
    earlier = Window.partitionBy("symbol").orderBy("_block").rangeBetween(Window.unboundedPreceding, -1)
    ends = lambda kind, w: getattr(F, kind)(F.when(F.col("_last_at").isNotNull(), F.struct(f"_{w}_at", f"_{w}")))
    joined = (blocks.withColumn("_opens", ends("min", "first").over(block)["_first"]).withColumn("_carried", ends("max", "last").over(earlier)["_last"])
              .withColumn("back", F.col("back") | F.coalesce(F.col("_opens") < F.col("_carried"), F.lit(False)))
              .withColumn("flat", F.col("flat") | F.coalesce(F.col("_opens") <= F.col("_carried"), F.lit(False))))
    sums = [F.sum(c).alias(c) for c in ("observations", "dated", "error_count", "warning_count")] + [F.bool_or(c).alias(c) for c in ("back", "flat", "late")]
    first = [F.min_by("first_error", "_error_at").alias("first_error"), F.min("_error_at").alias("_error_at")]
    spans = joined.groupBy("symbol", "_bucket").agg(*sums, *first, F.bitmap_count(F.bitmap_or_agg("_days")).alias("days"))
    return spans.groupBy("symbol").agg(*sums, first[0], F.sum("days").alias("days")).withColumn("undated", F.col("observations") - F.col("dated"))


def row_findings() -> Column:
    """Errors and warnings of one arrival, in order: an array of severity and message."""
    values = {n: F.col(n) for n in FIELDS}
    missing = F.concat_ws(", ", *[F.when(values[n].isNull(), F.lit(n)) for n in FIELDS])
    odd = F.lit(False)
    for v in values.values():
        odd = odd | F.isnan(v) | (F.abs(v) == float("inf"))
    o, h, l, c, v = (values[n] for n in FIELDS)
    label = F.concat(F.lit("Observation "), F.col("arrival").cast("string"), F.lit(": "))
    note = lambda cond, severity, text: F.when(cond, F.struct(
        F.lit(severity).alias("severity"), F.concat(label, F.lit(text)).alias("message")))
    checks = F.array_compact(F.array(
        note(F.least(o, h, l, c) <= 0, "ERROR", "non-positive price"),
        note(h < F.greatest(o, c, l), "ERROR", "high below open/close/low"),
        note(l > F.least(o, c, h), "ERROR", "low above open/close/high"),
        note(v < 0, "ERROR", "negative volume"),
        note(v == 0, "WARNING", "zero volume")))
    absent = F.array(F.struct(F.lit("ERROR").alias("severity"), F.concat(label, F.lit("missing "), missing).alias("message")))
    strange = F.array(note(F.lit(True), "ERROR", "non-finite OHLCV value"))
    return F.when(missing != "", absent).when(odd, strange).otherwise(checks)


def _series_notes() -> list[tuple[int, Column, str]]:
    """What a summary says about the series as a whole: position, whether it applies, message."""
    return [(-4, F.col("undated") > 0, "Missing or invalid trading date"), (-3, F.col("days") < F.col("dated"), "Duplicate trading dates"),
            (-2, F.col("back"), "Trading dates are not in ascending order"), (-1, F.col("late"), "Future observation date")]


def series_findings(candles: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Every error and warning of every series, one row each; series-level ones come first
    through negative positions (FLT5). One read of the arrivals for the rows, one for the series."""
    own = candles.select("symbol", F.col("arrival").alias("position"), F.posexplode(row_findings()).alias("item", "f"))
    notes = F.array_compact(F.array(*[F.when(cond, F.struct(F.lit(at).cast("bigint").alias("position"), F.lit(text).alias("message")))
                                      for at, cond, text in _series_notes()]))
    whole = arrival_summary(candles, as_of).select("symbol", F.explode(notes).alias("f")).select(
        "symbol", "f.position", F.lit(0).alias("item"), F.lit("ERROR").alias("severity"), "f.message")
    return whole.unionByName(own.select("symbol", "position", "item", "f.severity", "f.message"))


def series_status(candles: DataFrame, as_of: Column | None = None) -> DataFrame:
    """One row per series: counts, status and its first error. The full list stays in
    series_findings, so no series has to fit in one row (FLT5). Reads the arrivals once."""
    notes = _series_notes()
    more = F.lit(0)
    for _, cond, _ in notes:
        more = more + cond.cast("int")
    first = F.coalesce(*[F.when(cond, F.lit(text)) for _, cond, text in notes], F.col("first_error"))
    counted = arrival_summary(candles, as_of).select(
        "symbol", "observations", (F.col("error_count") + more).alias("error_count"), "warning_count", first.alias("first_error"))
    return counted.withColumn("status", F.when(F.col("error_count") > 0, "INVALID")
                              .when(F.col("warning_count") > 0, "VALID_WITH_WARNINGS").otherwise("VALID"))


# --- small checks with caller thresholds ----------------------------------------------------

def has_required(candles: DataFrame) -> DataFrame:
    """high, low and close present (FLT6)."""
    need = F.col("high").isNotNull() & F.col("low").isNotNull() & F.col("close").isNotNull()
    return candles.withColumn("has_required", need)


def duplicate_dates(candles: DataFrame) -> DataFrame:
    """Per symbol, whether a date occurs twice; missing dates are one date (FLT7)."""
    per_day = candles.groupBy("symbol", "trading_date").agg(F.count(F.lit(1)).alias("n"))
    return per_day.groupBy("symbol").agg((F.max("n") > 1).alias("has_duplicates"))


def strictly_ascending(candles: DataFrame) -> DataFrame:
    """Per symbol, whether dates rise strictly in arrival order, missing dates passed over (FLT8)."""
    return arrival_summary(candles).filter("dated > 0").select("symbol", (~F.col("flat")).alias("ascending"))


def price_checks(candles: DataFrame, minimum_history: int | None, expected: Column | None) -> DataFrame:
    """Per symbol: non-positive price, inverted bar, enough history, staleness; a check
    without its parameter stays undecided (FLT9, FLT10, FLT11, FLT13)."""
    undecided = F.lit(None).cast("boolean")
    flag = lambda cond: F.coalesce(F.bool_or(cond), F.lit(False))
    return candles.groupBy("symbol").agg(
        flag(F.least("high", "low", "close") <= 0).alias("non_positive"),
        flag(F.col("high") < F.col("low")).alias("inverted"),
        (undecided if minimum_history is None else F.count(F.lit(1)) >= minimum_history).alias("enough_history"),
        (undecided if expected is None else F.max("trading_date") < expected).alias("stale"))


def usable_volume(candles: DataFrame, window: int | None, positive_bars: int | None) -> DataFrame:
    """At every bar: the prior window is complete, without gaps, and traded often enough (FLT12)."""
    if window is None or positive_bars is None:
        return candles.withColumn("usable", F.lit(None).cast("boolean"))
    prior = by_symbol().rowsBetween(-window, -1)
    ok = (F.col("volume").isNotNull() & (F.count("volume").over(prior) == window)
          & (F.count(F.when(F.col("volume") > 0, 1)).over(prior) >= positive_bars))
    return candles.withColumn("usable", ok)
