"""Trading calendars, reconciliation and history depth.

A calendar holds one row per day, so tables of sessions are bounded by the span in days
whatever the size of the bar tables; only such tables are gathered into arrays or broadcast.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from barlab.functions.temporal import SESSION_CLOSE_HOUR, expected_session, exchange_wall_time
from barlab.operators.bars import by_symbol, is_break, with_close_ratio
from barlab.operators.sessions import compared_words, listed, session_index, words
from barlab.session import materialize

# Words in a holiday description that mark the day as a session.
SESSION_MARKERS = ("*", "Special Live Trading", "Union Budget", "Dhanteras Trading")


def session_dates(benchmark: DataFrame) -> DataFrame:
    """Distinct session dates of a benchmark; a missing date is an error (CAL1)."""
    checked = F.when(F.col("trading_date").isNull(),
                     F.raise_error(F.lit("a benchmark bar is missing its date")).cast("date")) \
        .otherwise(F.col("trading_date"))
    return benchmark.select(checked.alias("trading_date")).distinct()


def last_closed_session(sessions: DataFrame, now: Column, close_hour: int = SESSION_CLOSE_HOUR) -> DataFrame:
    """One row: the newest session whose close has passed; none at all is an error (CAL1)."""
    today = F.to_date(now)
    closed = (F.col("trading_date") < today) | ((F.col("trading_date") == today) & (F.hour(now) >= close_hour))
    newest = F.max(F.when(closed, F.col("trading_date")))
    return sessions.agg(F.count(F.lit(1)).alias("sessions"), newest.alias("last_closed")).withColumn(
        "last_closed", F.when(F.col("last_closed").isNull(),
                              F.raise_error(F.lit("no session has closed yet")).cast("date"))
        .otherwise(F.col("last_closed")))


def verified_calendar(span: DataFrame, holidays: DataFrame, resolutions: DataFrame) -> DataFrame:
    """One row per day of the span (CAL2).

    span: one row (first, last). holidays: date, description. resolutions: date, status,
    session_type, circulars, note; they override everything else.
    """
    days = span.select(F.explode(F.sequence("first", "last")).alias("date"))
    text = F.col("description")
    marked = F.lit(False)
    for word in SESSION_MARKERS:
        marked = marked | F.contains(text, F.lit(word))
    marked = F.coalesce(marked, F.lit(False))
    listed = F.coalesce(text, F.lit("")) != ""
    by_rule = F.when(F.weekday("date") < 5, ~listed | marked).otherwise(marked)
    fixed = F.col("status").isNotNull()
    open_day = F.when(fixed, F.col("status") == "SESSION").otherwise(by_rule)
    return (days.join(holidays, "date", "left").join(resolutions, "date", "left")
            .withColumn("is_session", open_day)
            .select("date", F.date_format("date", "EEE").alias("weekday"), "is_session",
                    F.when(~F.col("is_session"), "").when(fixed, F.col("session_type")).otherwise("REGULAR")
                    .alias("session_type"),
                    F.when(F.col("is_session"), "").when(fixed, F.col("note"))
                    .otherwise(F.when(listed, text).otherwise("weekend")).alias("closure_reason"),
                    F.coalesce(text, F.lit("")).alias("holiday_master"),
                    F.when(fixed, F.concat(F.lit("resolution:"), "circulars"))
                    .when(listed, "nse_holiday_master").otherwise("weekday_rule").alias("source")))


def calendar_differences(vendor: DataFrame, sessions: DataFrame, span: DataFrame) -> DataFrame:
    """Per instrument: bars on closed days, sessions without a bar (SET2).

    vendor: instrument, trading_date. The sessions an instrument has are bits of words; those it lacks
    are the calendar's words without them, and only the bits that remain become rows.
    """
    index = materialize(session_index(sessions), "sessions")
    first, last = span.select("first").scalar(), span.select("last").scalar()
    dates = vendor.select("instrument", "trading_date").distinct()
    closed = (dates.filter(F.col("trading_date").between(first, last)).join(F.broadcast(index.select("trading_date")), "trading_date", "left_anti")
              .select("instrument", F.col("trading_date").alias("date"), F.lit("vendor bar on a closed day").alias("finding")))
    lacking = compared_words(vendor, ["instrument"], words(vendor, ["instrument"], index), index)
    absent = listed(lacking, "_lacking", index).select("instrument", F.col("trading_date").alias("date"), F.lit("session without vendor bar").alias("finding"))
    return closed.unionByName(absent)


def reconcile(vendor: DataFrame, sessions: DataFrame, span: DataFrame, resolutions: DataFrame,
              gaps: DataFrame) -> DataFrame:
    """The differences with a mark on those no resolution date and no known gap explains (JN16)."""
    found = calendar_differences(vendor, sessions, span)
    ruled = resolutions.select("date").distinct().withColumn("_ruled", F.lit(True))
    known = gaps.select("date", "instrument").distinct().withColumn("_known", F.lit(True))
    return (found.join(ruled, "date", "left").join(known, ["date", "instrument"], "left")
            .withColumn("resolved", F.col("_ruled").isNotNull() | F.col("_known").isNotNull())
            .drop("_ruled", "_known"))


def calendar_counts(calendar: DataFrame) -> DataFrame:
    """Sessions in total, by type and by year, in long form (AG23)."""
    open_days = calendar.filter("is_session")
    part = lambda scope, key: open_days.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("sessions")) \
        .select(F.lit(scope).alias("scope"), "key", "sessions")
    total = open_days.agg(F.count(F.lit(1)).alias("sessions")).select(F.lit("total").alias("scope"),
                                                                       F.lit("").alias("key"), "sessions")
    return total.unionByName(part("type", F.col("session_type"))).unionByName(
        part("year", F.year("date").cast("string")))


def instrument_coverage(vendor: DataFrame, sessions: DataFrame, span: DataFrame) -> DataFrame:
    """Per instrument: bars inside the span and sessions without a bar (AG23)."""
    index = materialize(session_index(sessions), "sessions")
    first, last = span.select("first").scalar(), span.select("last").scalar()
    total = index.agg(F.count(F.lit(1))).scalar()
    dates = vendor.select("instrument", "trading_date").distinct()
    held = words(vendor, ["instrument"], index).groupBy("instrument").agg(F.sum(F.bit_count("_held")).alias("_n"))
    inside = dates.groupBy("instrument").agg(F.count_if(F.col("trading_date").between(first, last)).alias("bars_in_span"))
    return inside.join(held, "instrument", "left").select(
        "instrument", "bars_in_span", (total - F.coalesce("_n", F.lit(0))).alias("sessions_without_bar"))


def trailing_sessions(sessions: DataFrame, last_closed: Column, n: int) -> DataFrame:
    """The last n sessions at or before the last closed one (TK5)."""
    return (sessions.select("trading_date").distinct().filter(F.col("trading_date") <= last_closed)
            .orderBy(F.desc("trading_date")).limit(n))


def missing_sessions(valid: DataFrame, window: DataFrame) -> DataFrame:
    """Per symbol: sessions of the window it lacks, and how many it has (SET1). A symbol that lacks none
    has one row without a date."""
    index = materialize(session_index(window), "sessions")
    both = compared_words(valid, ["symbol"], words(valid, ["symbol"], index), index)
    held = valid.select("symbol").distinct().join(
        both.groupBy("symbol").agg(F.sum(F.bit_count("_held")).cast("int").alias("available")), "symbol", "left")
    gone = listed(both, "_lacking", index).select("symbol", F.col("trading_date").alias("missing"))
    return held.join(gone, "symbol", "left").select("symbol", F.coalesce("available", F.lit(0)).alias("available"), "missing")


# --- freshness of runs --------------------------------------------------------------------

def with_expected_session(rows: DataFrame, stamp: str) -> DataFrame:
    return rows.withColumn("expected_session", expected_session(F.col(stamp)))


def outdated(session: Column, now: Column) -> Column:
    """Older than the session expected by now; an unknown session counts as outdated (CAL4)."""
    return F.coalesce(session < expected_session(now), F.lit(True))


def running_stale(status: Column, started_at: Column, now: Column) -> Column:
    """RUNNING for more than an hour (CAL5)."""
    late = (now - F.expr("interval 1 hour")) > started_at
    return F.coalesce((status == "RUNNING") & late, F.lit(False))


# --- depth ---------------------------------------------------------------------------------

def history_depth(bars: DataFrame, benchmark: DataFrame) -> DataFrame:
    """First and last date, sessions, symbols and benchmark sessions held (AG12).

    The two distinct counts run on their own, so no row is expanded per distinct column.
    """
    sessions = bars.select("trading_date").distinct().agg(
        F.min("trading_date").alias("first_date"), F.max("trading_date").alias("last_date"),
        F.count("trading_date").alias("sessions"))
    symbols = bars.select("symbol").distinct().agg(F.count("symbol")).scalar()
    bench = benchmark.select("trading_date").distinct().agg(F.count("trading_date")).scalar()
    return sessions.withColumn("symbols", symbols).withColumn("benchmark_sessions", bench)


def depth_probe(bars: DataFrame, low: float, high: float) -> DataFrame:
    """Per symbol: span, sessions, widest gap with its ends, weekend bars, close jumps (AG25)."""
    marked = with_close_ratio(bars).withColumn("prior_date", F.lag("trading_date").over(by_symbol()))
    gap = F.datediff("trading_date", "prior_date")
    # the earliest of equally wide gaps
    widest = F.max_by(F.struct("prior_date", "trading_date"),
                      F.when(gap.isNotNull(), F.struct(gap.alias("gap"), (-F.datediff("trading_date", F.lit("1970-01-01").cast("date"))).alias("d"))))
    return marked.groupBy("symbol").agg(
        F.min("trading_date").alias("earliest"), F.max("trading_date").alias("latest"),
        F.count(F.lit(1)).alias("sessions"), F.max(gap).alias("largest_gap_days"),
        widest.alias("w"), F.count_if(F.weekday("trading_date") >= 5).alias("weekend_bars"),
        F.count_if(is_break(F.col("close_ratio"), low, high)).alias("close_jumps")) \
        .select("symbol", "earliest", "latest", "sessions", "largest_gap_days", F.col("w.prior_date").alias("gap_from"),
                F.col("w.trading_date").alias("gap_to"), "weekend_bars", "close_jumps")


def date_fingerprint(bars: DataFrame) -> DataFrame:
    """First and last bar, bars and SHA-256 of the ordered dates, per symbol (AG15)."""
    days = F.sort_array(F.collect_set(F.date_format("trading_date", "yyyy-MM-dd")))
    return bars.groupBy("symbol").agg(
        F.min("trading_date").alias("first_bar"), F.max("trading_date").alias("last_bar"),
        F.size(days).alias("bars"), F.sha2(F.array_join(days, "\n"), 256).alias("dates_sha256"))


def calendar_manifest(counts: DataFrame, findings: DataFrame, inputs: DataFrame) -> DataFrame:
    """What a calendar's manifest says, one row per item: sessions in total, by type and year,
    discrepancies found and unresolved, the status that follows, and the hash of every input
    (SNK3). counts: calendar_counts; findings: reconcile; inputs: version."""
    row = lambda df, item, key, value: df.select(F.lit(item).alias("item"), key.alias("key"), value.cast("string").alias("value"))
    seen = findings.agg(F.count(F.lit(1)).alias("found"), F.count_if(~F.col("resolved")).alias("unresolved"))
    status = F.when(F.col("unresolved") == 0, "VALIDATED").otherwise("FAILED")
    out = counts.select(F.concat(F.lit("sessions_"), "scope").alias("item"), "key", F.col("sessions").cast("string").alias("value"))
    for part in (row(seen, "discrepancies", F.lit("found"), F.col("found")), row(seen, "discrepancies", F.lit("unresolved"), F.col("unresolved")),
                 row(seen, "status", F.lit(""), status), row(inputs, "input_sha256", F.col("version"), F.lit("1"))):
        out = out.unionByName(part)
    return out
