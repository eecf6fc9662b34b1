"""Data status of symbols against a trading calendar, and acquisition outcomes."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from barlab.functions.numeric import money2
from barlab.operators.bars import with_jump
from barlab.operators.quality import validate_candles

STATUSES = ("VALID", "INSUFFICIENT_HISTORY", "STALE", "FAILED")
FLAGS = ("history_gaps", "corporate_action_review", "price_break_detected", "non_eq_series")


def under_review(reviews: DataFrame, first: Column, last: Column) -> DataFrame:
    """Symbols with an unresolved entry dated inside [first, last] (JN7)."""
    pending = F.coalesce(F.col("review_state"), F.lit("")) != "RESOLVED"
    return reviews.filter(pending & F.col("effective_date").between(first, last)).select("symbol").distinct()


def classify(symbols: DataFrame, valid: DataFrame, window: DataFrame, last_closed: Column, required: int) -> DataFrame:
    """Status of symbols that were fetched, from their valid dates (CLS1).

    symbols: symbol; valid: symbol, trading_date; window: the trailing sessions, at most as
    many rows as its length, hence safe to broadcast.
    """
    counts = (_marked(valid.select("symbol", "trading_date").distinct(), window)
              .groupBy("symbol").agg(F.count("_in").alias("available"), F.max("trading_date").alias("latest_valid")))
    return _judge(symbols, counts, window, last_closed, required)


def _marked(valid: DataFrame, window: DataFrame) -> DataFrame:
    marks = F.broadcast(window.select("trading_date").withColumn("_in", F.lit(1)))
    return valid.join(marks, "trading_date", "left")


def _judge(symbols: DataFrame, counts: DataFrame, window: DataFrame, last_closed: Column, required: int) -> DataFrame:
    size = window.agg(F.count(F.lit(1))).scalar()
    carried = [c for c in counts.columns if c not in ("symbol", "available", "latest_valid")]
    rows = (symbols.join(counts, "symbol", "left")
            .withColumn("available", F.coalesce("available", F.lit(0).cast("bigint")))
            .withColumn("window_size", size).withColumn("last_closed", last_closed)
            .withColumn("missing", F.col("window_size") - F.col("available")))
    short, late = F.col("available") < required, F.col("latest_valid") < F.col("last_closed")
    few = F.format_string("only %d valid candle(s) in the trailing %d-session window (need %d)",
                          "available", "window_size", F.lit(required))
    old = F.concat(F.lit("latest valid candle ("), F.col("latest_valid").cast("string"),
                   F.lit(") is older than latest_closed_session ("), F.col("last_closed").cast("string"), F.lit(")"))
    return rows.select(
        *symbols.columns, F.when(short, "INSUFFICIENT_HISTORY").when(late, "STALE").otherwise("VALID").alias("status"),
        F.when(short, few).when(late, old).alias("status_reason"), "available", "missing",
        (F.col("missing") > 0).alias("history_gaps"), *carried)


def scan(members: DataFrame, keys: DataFrame, failures: DataFrame, candles: DataFrame, reviews: DataFrame,
         window: DataFrame, last_closed: Column, fetch_first: Column, fetch_last: Column,
         required: int, low: float, high: float) -> DataFrame:
    """One row per member of the universe (CLS2).

    keys: isin, instrument_key; failures: symbol, error. A member without a key or with a
    failed fetch is FAILED before its candles are looked at.
    """
    known = members.join(keys, "isin", "left").join(failures, "symbol", "left")
    failed = (F.when(F.col("instrument_key").isNull(),
                     F.concat(F.lit("no instrument-master match for ISIN "), F.col("isin"))).otherwise(F.col("error")))
    known = known.withColumn("failed_reason", failed).withColumn("non_eq_series", F.col("series") != "EQ").drop("error")
    valid = (validate_candles(candles).filter("status = 'VALID'")
             .groupBy("symbol", "trading_date").agg(F.max(money2(F.col("close"))).alias("close_2dp")))
    # window marks and jumps come out of one pass over the valid candles of a symbol
    counts = with_jump(_marked(valid, window), low, high).groupBy("symbol").agg(
        F.count("_in").alias("available"), F.max("trading_date").alias("latest_valid"),
        F.bool_or("jump").alias("price_break_detected"))
    rows = (_judge(known, counts, window, last_closed, required)
            .join(under_review(reviews, fetch_first, fetch_last).withColumn("_review", F.lit(True)), "symbol", "left"))
    bad = F.col("failed_reason").isNotNull()
    flag = lambda c: F.when(bad, False).otherwise(F.coalesce(F.col(c), F.lit(False)))
    return rows.select(
        "symbol", "instrument_key", "isin", "series", "company_name", "sector",
        F.when(bad, "FAILED").otherwise(F.col("status")).alias("status"),
        F.when(bad, F.col("failed_reason")).otherwise(F.col("status_reason")).alias("status_reason"),
        F.when(~bad, F.col("available")).alias("available"), F.when(~bad, F.col("missing")).alias("missing"),
        flag("history_gaps").alias("history_gaps"), flag("_review").alias("corporate_action_review"),
        flag("price_break_detected").alias("price_break_detected"), "non_eq_series")


def scan_counts(rows: DataFrame) -> DataFrame:
    """Counts over the whole status and flag vocabulary, zeros included (AG2)."""
    return rows.agg(
        F.count_if(F.col("status") != "FAILED").alias("successful"), F.count_if(F.col("status") == "FAILED").alias("failed_symbols"),
        *[F.count_if(F.col("status") == s).alias(s.lower()) for s in STATUSES],
        *[F.count_if(F.col(f)).alias(f) for f in FLAGS])


def acquisition_outcomes(mappings: DataFrame, failures: DataFrame, fetched: DataFrame, validation: DataFrame,
                         benchmark_error: str | None, required: int) -> DataFrame:
    """What became of every constituent (CLS4).

    mappings: symbol, source_order, mapping_status, mapping_error; failures: symbol, error,
    is_auth; fetched: symbol, observations, first_date, last_date; validation: symbol,
    validation_status, error_count, first_error (all of them: quality.series_findings). Nothing is requested after the benchmark failed or after
    the first authentication failure in source order.
    """
    mapped = F.col("mapping_status") == "MAPPED"
    auth = failures.filter("is_auth").select("symbol")
    stop = (mappings.filter(mapped).join(auth, "symbol", "left_semi").agg(F.min("source_order")).scalar())
    rows = (mappings.join(failures.drop("is_auth"), "symbol", "left").join(fetched, "symbol", "left")
            .join(validation, "symbol", "left"))
    stopped = F.lit(True) if benchmark_error else F.coalesce(F.col("source_order") > stop, F.lit(False))
    stop_text = F.lit(benchmark_error or "Run stopped after authentication failure (HTTP 401)")
    n = F.coalesce(F.col("observations"), F.lit(0))
    status = (F.when(F.col("mapping_status") == "EXCLUDED_PLACEHOLDER", "EXCLUDED")
              .when(~mapped, "MAPPING_FAILED").when(stopped, "NOT_REQUESTED")
              .when(F.col("error").isNotNull(), "REQUEST_FAILED").when(n == 0, "NO_DATA")
              .when(F.col("validation_status") == "INVALID", "VALIDATION_FAILED")
              .when(n < required, "INSUFFICIENT_HISTORY").otherwise("SUCCESS"))
    s = F.col("status")
    reason = (F.when(s == "EXCLUDED", "Placeholder excluded").when(s == "MAPPING_FAILED", F.col("mapping_error"))
              .when(s == "NOT_REQUESTED", stop_text).when(s == "REQUEST_FAILED", F.col("error"))
              .when(s == "VALIDATION_FAILED", F.concat(F.col("error_count").cast("string"), F.lit(" validation error(s), first: "), F.col("first_error")))
              .when(s == "INSUFFICIENT_HISTORY", F.format_string("%d observations; %d required", n, F.lit(required))))
    asked = s.isin("REQUEST_FAILED", "NO_DATA", "VALIDATION_FAILED", "INSUFFICIENT_HISTORY", "SUCCESS")
    kept = F.when(s == "SUCCESS", F.lit(required)).when(asked, n).otherwise(0)
    return (rows.withColumn("status", status)
            .select("symbol", "mapping_status", "status", reason.alias("reason"), asked.alias("requested"),
                    F.when(s == "REQUEST_FAILED", 0).otherwise(kept).cast("bigint").alias("observation_count"),
                    F.when(s == "SUCCESS", F.lit(required)).otherwise(0).cast("bigint").alias("persisted_count")))


def acquisition_report(outcomes: DataFrame) -> DataFrame:
    """Counts of one acquisition run; mapped and unmapped must add up to the universe (AG1)."""
    s = F.col("status")
    counted = outcomes.agg(
        F.count_if(s != "EXCLUDED").alias("universe_count"),
        F.count_if(F.col("mapping_status") == "MAPPED").alias("mapped_count"),
        F.count_if((F.col("mapping_status") != "MAPPED") & (s != "EXCLUDED")).alias("unmapped_count"),
        F.count_if(s == "EXCLUDED").alias("excluded_count"), F.count_if("requested").alias("requested_count"),
        *[F.count_if(s == name).alias(alias) for name, alias in (
            ("SUCCESS", "successful_count"), ("NO_DATA", "no_data_count"), ("REQUEST_FAILED", "request_failed_count"),
            ("VALIDATION_FAILED", "validation_failed_count"), ("INSUFFICIENT_HISTORY", "insufficient_history_count"))],
        F.sum("persisted_count").alias("persisted_observation_count"))
    agree = F.col("mapped_count") + F.col("unmapped_count") == F.col("universe_count")
    return counted.withColumn("universe_count", F.when(agree, F.col("universe_count")).otherwise(
        F.raise_error(F.lit("mapping counts do not reconcile to the universe")).cast("bigint")))
