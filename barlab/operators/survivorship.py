"""How far a study universe departs from the index as it was."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from barlab.functions.numeric import share_pct_or_zero
from barlab.operators.asof import in_force, in_force_by_day
from barlab.operators.sessions import between, day_ranks, session_index, unfold
from barlab.session import materialize

MEMBER, NOT_MEMBER, UNCERTAIN = "MEMBER_RECONSTRUCTED", "NOT_MEMBER_RECONSTRUCTED", "UNCERTAIN_CHAIN"
CLASSES = (MEMBER, NOT_MEMBER, UNCERTAIN)


def was_member(samples: DataFrame, intervals: DataFrame) -> DataFrame:
    """Whether each (symbol, trading_date) lies inside one of the symbol's intervals (JN11).

    Intervals of a symbol do not overlap, so the last one begun decides.
    """
    spans = intervals.select("symbol", "member_from", F.col("member_until").alias("_until"))
    seen = in_force(samples, spans, ["symbol"], "trading_date", "member_from", "_until")
    return seen.withColumn("member", F.coalesce(F.col("trading_date") < F.col("_until"), F.lit(False))).drop("_until")


def candidate_samples(coverage: DataFrame, sessions: DataFrame, last: Column) -> DataFrame:
    """Every session between a symbol's first bar and its last bar or `last` (JN12).

    Two lookups of session numbers bound a symbol's range; the rows made are the rows wanted.
    """
    index = materialize(session_index(sessions), "sessions")
    spans = coverage.select("symbol", "first_bar", F.date_add(F.least("last_bar", last), 1).alias("_end"))
    return unfold(between(spans, "first_bar", "_end", day_ranks(index)), index).select("symbol", "trading_date")


def classify_samples(samples: DataFrame, intervals: DataFrame, windows: DataFrame) -> DataFrame:
    """Evidence class of every sample (MEM7)."""
    spans = windows.select("symbol", "start", F.col("until").alias("_w"))
    rows = in_force(was_member(samples, intervals), spans, ["symbol"], "trading_date", "start", "_w")
    unsure = F.coalesce(F.col("trading_date") < F.col("_w"), F.lit(False))
    return rows.withColumn("class", F.when(unsure, UNCERTAIN).when(F.col("member"), MEMBER).otherwise(NOT_MEMBER)) \
        .drop("_w", "member")


def class_stretches(coverage: DataFrame, intervals: DataFrame, windows: DataFrame, last: Column) -> DataFrame:
    """symbol, class, start, until: the stretches of days on which a symbol's samples are of one class.

    Coverage, membership and uncertainty put marks on the days where they begin and end; running sums
    of the marks tell the class between two of them. A symbol has a row for each change, not for each
    session.
    """
    never = F.lit("0001-01-01").cast("date")
    def marks(rows: DataFrame, start: Column, until: Column, name: str) -> DataFrame:
        ends = F.array(F.struct(start.alias("day"), F.lit(1).alias(name)), F.struct(until.alias("day"), F.lit(-1).alias(name)))
        return rows.filter(start < until).select("symbol", F.explode(ends).alias("m")).select("symbol", "m.*")

    lines = marks(coverage, F.col("first_bar"), F.date_add(F.least("last_bar", last), 1), "_c")
    for part in (marks(intervals, F.coalesce("member_from", never), F.col("member_until"), "_m"), marks(windows, F.col("start"), F.col("until"), "_u")):
        lines = lines.unionByName(part, allowMissingColumns=True)
    days = lines.groupBy("symbol", "day").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("_c", "_m", "_u")])
    order = Window.partitionBy("symbol").orderBy("day")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    now = days.select("symbol", F.col("day").alias("start"), F.lead("day").over(order).alias("until"), *[F.sum(c).over(upto).alias(c) for c in ("_c", "_m", "_u")])
    kind = F.when(F.col("_u") > 0, UNCERTAIN).when(F.col("_m") > 0, MEMBER).otherwise(NOT_MEMBER)
    return now.filter("_c > 0 and until is not null").select("symbol", kind.alias("class"), "start", "until")


def session_counts(stretches: DataFrame, sessions: DataFrame) -> DataFrame:
    """trading_date, class, n: how many symbols have a sample of each class on each session.

    Beginnings and ends are added up per day first, over all symbols; the running sum of what is left,
    one row per class and day, gives the count of every session.
    """
    ends = F.array(F.struct(F.col("start").alias("day"), F.lit(1).alias("d")), F.struct(F.col("until").alias("day"), F.lit(-1).alias("d")))
    change = stretches.select("class", F.explode(ends).alias("m")).groupBy("class", "m.day").agg(F.sum("m.d").alias("d"))
    asked = sessions.select(F.col("trading_date").alias("day")).distinct().withColumn("class", F.explode(F.array(*[F.lit(c) for c in CLASSES])))
    line = change.unionByName(asked.withColumn("_asked", F.lit(True)), allowMissingColumns=True)
    upto = Window.partitionBy("class").orderBy("day").rangeBetween(Window.unboundedPreceding, 0)
    return line.withColumn("n", F.coalesce(F.sum("d").over(upto), F.lit(0))).filter("_asked").select(F.col("day").alias("trading_date"), "class", "n")


def entrants(coverage: DataFrame, after: Column) -> DataFrame:
    """Symbols whose first bar is later than a window's start (AG16)."""
    return coverage.filter(F.col("first_bar") > after).select("symbol", "first_bar", F.year("first_bar").alias("year"))


def entrants_by_year(coverage: DataFrame, after: Column) -> DataFrame:
    return entrants(coverage, after).groupBy("year").agg(F.count(F.lit(1)).alias("entrants"))


def _class_sums(n: str) -> list[Column]:
    return [F.coalesce(F.sum(F.when(F.col("class") == c, F.col(n))), F.lit(0)).alias(c.lower()) for c in CLASSES] \
        + [F.coalesce(F.sum(n), F.lit(0)).alias("samples")]


def _with_shares(counts: DataFrame) -> DataFrame:
    """The shares of samples without evidence."""
    return counts.withColumn("not_member_pct", share_pct_or_zero(F.col(NOT_MEMBER.lower()), F.col("samples"))) \
        .withColumn("uncertain_pct", share_pct_or_zero(F.col(UNCERTAIN.lower()), F.col("samples")))


def samples_by_year(stretches: DataFrame, sessions: DataFrame) -> DataFrame:
    """Samples per class and year; the row without a year is the total (AG17). Years without a sample have no row."""
    per_day = session_counts(stretches, sessions).filter("n > 0").withColumn("year", F.year("trading_date"))
    return _with_shares(per_day.rollup("year").agg(*_class_sums("n")))


def samples_by_symbol(stretches: DataFrame, sessions: DataFrame) -> DataFrame:
    """Samples per class of every symbol that has any (AG17): differences of session numbers."""
    held = between(stretches, "start", "until", day_ranks(session_index(sessions))).withColumn("_n", F.col("_to") - F.col("_from"))
    return held.filter("_n > 0").groupBy("symbol").agg(*_class_sums("_n"))


def symbol_audit(stretches: DataFrame, sessions: DataFrame, coverage: DataFrame, intervals: DataFrame) -> DataFrame:
    """Samples by class of every symbol, with its first bar and whether a failed check touches
    its membership (AG17)."""
    touched = intervals.groupBy("symbol").agg(F.bool_or("touched_by_anomaly").alias("touched_by_anomaly"))
    return (samples_by_symbol(stretches, sessions).join(coverage.select("symbol", "first_bar"), "symbol", "left").join(touched, "symbol", "left")
            .withColumn("touched_by_anomaly", F.coalesce("touched_by_anomaly", F.lit(False))))


def window_shares(stretches: DataFrame, sessions: DataFrame, first: Column, last: Column) -> DataFrame:
    """Samples by class within [first, last] with the shares of those without evidence (AG17)."""
    inside = sessions.filter(F.col("trading_date").between(first, last))
    return _with_shares(session_counts(stretches, inside).agg(*_class_sums("n")))


def not_full_period(symbols: DataFrame, pieces: DataFrame, sessions: DataFrame, first: Column, last: Column, end: Column) -> DataFrame:
    """Symbols without evidence of membership on all sessions of [first, last] (AG18).

    pieces: the segments of membership; end: the first change after the snapshot, where open
    segments end. A symbol fails when some session falls into a segment where it is no member
    or the chain is uncertain, lies at or beyond the end, or when it has no segment.
    """
    line = Window.partitionBy("symbol").orderBy(F.asc_nulls_first("start"))
    asked = session_index(sessions.filter(F.col("trading_date").between(first, last)))
    doubtful = pieces.withColumn("_until", F.lead("start").over(line)).filter(~F.col("member") | F.col("anomalous"))
    # a stretch holds a session if the numbers of the first sessions from its ends differ
    open_ended = doubtful.select("symbol", F.coalesce("start", first).alias("_a"), F.coalesce("_until", F.date_add(last, 1)).alias("_b"))
    failed = between(open_ended, "_a", "_b", day_ranks(asked)).filter("_from < _to").select("symbol").distinct()
    known = pieces.select("symbol").distinct()
    # past the end there is no evidence of anything
    beyond = sessions.filter(F.col("trading_date").between(first, last)).agg(F.coalesce(F.max("trading_date") >= end, F.lit(False))).scalar()
    failed = failed.unionByName(known.filter(beyond)).distinct()
    return (symbols.select("symbol").distinct().join(failed, "symbol", "left_semi")
            .unionByName(symbols.select("symbol").distinct().join(known, "symbol", "left_anti")))


def sampled_sessions(sessions: DataFrame, per_year: int = 12) -> DataFrame:
    """Every k-th session of a year, k = max(1, sessions // 12); at most one row per day (AG19)."""
    year = Window.partitionBy("year").orderBy("trading_date")
    rows = sessions.select("trading_date").distinct().withColumn("year", F.year("trading_date"))
    rows = rows.withColumn("_i", F.row_number().over(year) - 1).withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("year")))
    return rows.filter(F.col("_i") % F.greatest(F.lit(1), F.floor(F.col("_n") / per_year)) == 0).select("year", "trading_date")


def members_outside_universe(intervals: DataFrame, snapshot: DataFrame, sessions: DataFrame) -> DataFrame:
    """Mean members and mean members missing from today's universe, per year (AG19)."""
    picked = sampled_sessions(sessions)
    held = snapshot.select("symbol").distinct().withColumn("_held", F.lit(1))
    out = F.col("_held").isNull().cast("int")
    end = lambda day, sign: F.struct(day.alias("day"), F.lit(sign).alias("m"), (out * sign).alias("absent"))
    never = F.lit("0001-01-01").cast("date")
    # intervals of a symbol do not overlap, so beginnings less ends count its members once
    ends = (intervals.join(held, "symbol", "left").select(F.explode(F.array(end(F.coalesce("member_from", never), 1), end(F.col("member_until"), -1))).alias("e"))
            .groupBy("e.day").agg(F.sum("e.m").alias("m"), F.sum("e.absent").alias("absent")))
    line = ends.unionByName(picked.select(F.col("trading_date").alias("day"), F.lit(True).alias("_asked")), allowMissingColumns=True)
    upto = Window.orderBy("day").rangeBetween(Window.unboundedPreceding, 0)  # at most two rows per calendar day
    counts = line.select("_asked", F.col("day").alias("trading_date"), F.sum("m").over(upto).alias("m"), F.sum("absent").over(upto).alias("absent")).filter("_asked")
    per_year = picked.join(counts, "trading_date", "left").groupBy("year").agg(
        F.count(F.lit(1)).alias("sessions_sampled"), F.coalesce(F.sum("m"), F.lit(0)).alias("m"),
        F.coalesce(F.sum("absent"), F.lit(0)).alias("absent"))
    return per_year.select(
        "year", "sessions_sampled", F.round(F.col("m") / F.col("sessions_sampled"), 1).alias("mean_members"),
        F.round(F.col("absent") / F.col("sessions_sampled"), 1).alias("mean_not_in_universe"),
        share_pct_or_zero(F.col("absent"), F.col("m")).alias("share_pct"))


def drift_on(sessions: DataFrame, states: DataFrame) -> DataFrame:
    """Drift in force on every session, 0 where no state has begun (JN13)."""
    return in_force_by_day(sessions.select("trading_date").distinct(), states, "trading_date", "since", "drift") \
        .withColumn("drift", F.coalesce("drift", F.lit(0)))


def drift_by_year(sessions: DataFrame, states: DataFrame) -> DataFrame:
    return drift_on(sessions, states).groupBy(F.year("trading_date").alias("year")).agg(
        F.round(F.avg("drift"), 2).alias("mean_drift"), F.max(F.abs("drift")).alias("max_abs_drift"))


def early_entries(intervals: DataFrame, coverage: DataFrame) -> DataFrame:
    """Intervals that begin before the symbol's first bar (AG21)."""
    return intervals.filter("member_from is not null").join(coverage.select("symbol", "first_bar"), "symbol") \
        .filter(F.col("member_from") < F.col("first_bar")).select("symbol", "member_from", "first_bar")


def removed_coverage(removed: DataFrame, ending_before: Column) -> DataFrame:
    """Vendor history of names that left: sampled, served, errored, ended early (AG22).
    removed: symbol, resolved, first_bar, last_bar, error."""
    served = F.col("resolved") & F.col("first_bar").isNotNull() & F.col("error").isNull()
    return removed.agg(
        F.count_if("resolved").alias("sampled"), F.count_if(~F.col("resolved")).alias("unresolved"),
        F.count_if(served).alias("served_history"), F.count_if(F.col("error").isNotNull()).alias("errors"),
        F.count_if(served & (F.col("last_bar") < ending_before)).alias("ended_before"))
