"""Samples, eligibility, splits and leakage checks of a research dataset.

A sample is (symbol, trading_date) with `idx`, the number of its session in the calendar.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window, functions as F

from barlab.operators.ranking import positions, stratified_sample
from barlab.operators.sessions import between, day_ranks, ranked, session_index, unfold  # noqa: F401  (session_index for callers)
from barlab.session import materialize


def by_idx() -> Window:
    return Window.partitionBy("symbol").orderBy("idx")


def forward_labels(bars: DataFrame, index: DataFrame, horizon: int) -> DataFrame:
    """Return over the next `horizon` sessions and its sign (ML1). With bars unique per
    session, the bar `horizon` rows on is that session exactly when none is missing between."""
    rows = bars.join(index, "trading_date")
    later_idx, later = F.lead("idx", horizon).over(by_idx()), F.lead("close", horizon).over(by_idx())
    whole = (later_idx == F.col("idx") + horizon) & (F.col("close") > 0) & (later > 0)
    return (rows.withColumn("forward_return", F.when(whole, later / F.col("close") - 1))
            .withColumn("positive", (F.col("forward_return") > 0).cast("int")))


def sweep_marks(events: DataFrame, index: DataFrame, ranks: DataFrame, before: int, after: int, name: str) -> DataFrame:
    """(symbol, trading_date, name): +1 where a span of affected sessions begins and -1 behind its end.

    A session is affected if its span from `before` sessions back to `after` ahead holds an event date,
    that is, if the running sum of the marks of its symbol up to it is positive. However many sessions
    an event touches, it gives two marks, and marks of one session are added up.
    """
    spans = ranked(events.select("symbol", "date").distinct(), "date", ranks).select(
        "symbol", F.greatest(F.col("_first") - after, F.lit(0)).alias("a"), (F.col("_last") + before + 1).alias("b")).filter("a < b")
    marks = spans.select("symbol", F.explode(F.array(F.struct(F.col("a").alias("idx"), F.lit(1).alias("m")),
                                                     F.struct(F.col("b").alias("idx"), F.lit(-1).alias("m")))).alias("e"))
    summed = marks.groupBy("symbol", F.col("e.idx").cast("int").alias("idx")).agg(F.sum("e.m").alias(name))
    # a span that ends behind the last session is not closed by anything; index: one row per session
    return summed.join(F.broadcast(index.select("trading_date", "idx")), "idx").drop("idx")


def candidates(bars: DataFrame, index: DataFrame, ranks: DataFrame) -> DataFrame:
    """Every session from a symbol's first bar to its last, and its bars on other days."""
    spans = bars.groupBy("symbol").agg(F.min("trading_date").alias("a"), F.date_add(F.max("trading_date"), 1).alias("b"))
    on = unfold(between(spans, "a", "b", ranks), index).select("symbol", "trading_date")
    return on.unionByName(bars.select("symbol", "trading_date")).distinct()


def _lanes(bars: DataFrame, index: DataFrame, evidenced: DataFrame | None, ca_events: DataFrame, anomalies: DataFrame,
           complete: DataFrame, lookback: int, horizon: int) -> DataFrame:
    """One row per (symbol, day) with everything known about it: candidate or not, its bar, evidence,
    completeness and the marks of events. All lanes meet in one aggregate."""
    sound = (F.least("open", "high", "low", "close") > 0) & (F.col("high") >= F.col("low")) & F.col("open").isNotNull() \
        & F.col("high").isNotNull() & F.col("low").isNotNull() & F.col("close").isNotNull()
    yes, key, ranks = F.lit(True), ["symbol", "trading_date"], day_ranks(index)
    lanes = [candidates(bars, index, ranks).withColumn("_candidate", yes),
             bars.select(*key, "close", F.coalesce(sound, F.lit(False)).alias("_sound"), yes.alias("_bar")),
             complete.select(*key, yes.alias("_complete")),
             sweep_marks(ca_events, index, ranks, lookback, horizon, "_ca"), sweep_marks(anomalies, index, ranks, lookback, horizon, "_odd")]
    if evidenced is not None:
        lanes.append(evidenced.select(*key, yes.alias("_evidenced")))
    rows = lanes[0]
    for lane in lanes[1:]:
        rows = rows.unionByName(lane, allowMissingColumns=True)
    flags = [F.bool_or(c).alias(c) for c in ("_candidate", "_sound", "_bar", "_complete", *(["_evidenced"] if evidenced is not None else []))]
    one = rows.groupBy(*key).agg(F.max("close").alias("close"), *flags, F.sum("_ca").alias("_ca"), F.sum("_odd").alias("_odd"))
    one = one if evidenced is not None else one.withColumn("_evidenced", yes)
    return one.join(F.broadcast(index), "trading_date", "left")  # one row per session


def eligibility(bars: DataFrame, index: DataFrame, universe: DataFrame, evidenced: DataFrame | None, ca_events: DataFrame,
                anomalies: DataFrame, complete: DataFrame, lookback: int, horizon: int, low: float, high: float) -> DataFrame:
    """One row per candidate with the first reason that excludes it, or null (ML2).

    Levels are tried in order E1 to E6. bars are unique per (symbol, trading_date). evidenced: symbol,
    trading_date with evidenced membership, or None to retain all. ca_events: symbol, date of
    unadjusted or unknown events; anomalies: the same for unresolved data anomalies. complete: symbol,
    trading_date whose required features are all present.
    """
    rows = _lanes(bars, index, evidenced, ca_events, anomalies, complete, lookback, horizon)
    # sessions only, in their order, for everything counted in sessions
    steps = Window.partitionBy("symbol", F.col("idx").isNull()).orderBy("idx")
    so_far, ahead, back = steps.rowsBetween(Window.unboundedPreceding, 0), steps.rangeBetween(1, horizon), steps.rangeBetween(-lookback, 0)
    rows = rows.withColumn("_ca", F.sum("_ca").over(so_far)).withColumn("_odd", F.sum("_odd").over(so_far)).filter("_candidate")
    rows = rows.withColumn("_closed", F.col("idx").isNotNull() & F.coalesce(F.col("close") > 0, F.lit(False)))
    earlier = Window.partitionBy("symbol").orderBy("trading_date").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_prev", F.last(F.when(F.col("_closed"), F.struct("close", "_sound")), ignorenulls=True).over(earlier))
    rows = rows.withColumn("_ratio", F.when(F.col("_closed"), F.try_divide("close", F.col("_prev.close"))))
    broke = F.when((F.col("_ratio") < low) | (F.col("_ratio") > high), 1)
    rows = (rows.withColumn("_break_ahead", F.count(broke).over(ahead))
            .withColumn("_valid_so_far", F.count(F.when(F.col("_closed"), 1)).over(so_far))
            .withColumn("_bars_back", F.count("_bar").over(back))
            .withColumn("_bars_ahead", F.count("_bar").over(ahead))
            .withColumn("_end_close", F.max("close").over(steps.rangeBetween(horizon, horizon))))
    rows = rows.join(universe.select("symbol").distinct().withColumn("_in_universe", F.lit(True)), "symbol", "left")
    no = lambda c: F.col(c).isNull()
    code = lambda cond, level, name: F.when(cond, F.lit(f"{level}:{name}"))
    reason = F.coalesce(
        code(no("idx"), "E1", "NOT_A_SESSION"), code(no("_bar") | no("_prev"), "E1", "BAR_MISSING"),
        code(~F.col("_sound") | ~F.col("_prev._sound"), "E1", "BAR_INVALID"), code(no("_in_universe"), "E2", "NOT_IN_UNIVERSE"),
        code(no("_evidenced"), "E2", "MEMBERSHIP_UNEVIDENCED"), code(F.col("_ca") > 0, "E3", "CA_EVENT_IN_WINDOW"),
        code(F.col("_break_ahead") > 0, "E3", "BREAK_IN_LABEL_WINDOW"), code(F.col("_odd") > 0, "E3", "DATA_ANOMALY"),
        code(F.col("_valid_so_far") < lookback, "E4", "INSUFFICIENT_HISTORY"),
        code(F.col("_bars_back") < F.least(F.lit(lookback), F.col("idx")) + 1, "E4", "GAP_IN_LOOKBACK"),
        code(no("_complete"), "E5", "REQUIRED_FEATURE_MISSING"),
        code((F.col("_bars_ahead") < horizon) | ~F.coalesce(F.col("_end_close") > 0, F.lit(False)), "E6", "TARGET_UNAVAILABLE"))
    return rows.select("symbol", "trading_date", "idx", reason.alias("reason"))


def exclusion_counts(judged: DataFrame, sectors: DataFrame) -> DataFrame:
    """Observations per reason: overall, by year and by sector (ML3)."""
    rows = judged.join(sectors.select("symbol", F.coalesce("sector", F.lit("UNKNOWN")).alias("sector")), "symbol", "left") \
        .withColumn("reason", F.coalesce("reason", F.lit("ELIGIBLE"))).withColumn("year", F.year("trading_date")) \
        .withColumn("sector", F.coalesce("sector", F.lit("UNKNOWN")))
    return rows.groupingSets([["reason"], ["reason", "year"], ["reason", "sector"]], "reason", "year", "sector").agg(
        F.count(F.lit(1)).alias("n"))


def membership_manifest(judged: DataFrame, evidenced: DataFrame, status: str) -> DataFrame:
    """Membership status, observations without evidence and their share; the label is carried
    where membership cannot be reconstructed (ML4)."""
    marks = evidenced.select("symbol", "trading_date").distinct().withColumn("_e", F.lit(1))
    label = F.lit("current constituents — NOT point-in-time" if status == "NOT_RECONSTRUCTABLE" else None).cast("string")
    counted = judged.filter("idx is not null").join(marks, ["symbol", "trading_date"], "left").agg(
        F.count(F.lit(1)).alias("candidates"), F.count_if(F.col("_e").isNull()).alias("unevidenced"))
    return counted.withColumn("unevidenced_pct", F.round(F.try_divide(F.col("unevidenced") * 100.0, F.col("candidates")), 2)) \
        .withColumn("status", F.lit(status)).withColumn("label", label)


def split_table(index: DataFrame, train: int, embargo: int, validation: int) -> DataFrame:
    """Sessions of TRAIN, VALIDATION and TEST with an embargo before each later one. At most
    one row per day."""
    i = F.col("idx")
    v0 = train + embargo
    t0 = v0 + validation + embargo
    part = F.when(i < train, "TRAIN").when((i >= v0) & (i < v0 + validation), "VALIDATION").when(i >= t0, "TEST")
    rows = index.select("idx", part.alias("segment")).filter("segment is not null")
    return rows.withColumn("last_idx", F.max("idx").over(Window.partitionBy("segment")))


def assign_split(samples: DataFrame, splits: DataFrame, horizon: int) -> DataFrame:
    """Samples with their segment; those whose label window leaves it are dropped (ML5)."""
    return samples.join(splits, "idx").filter(F.col("idx") + horizon <= F.col("last_idx")).drop("last_idx")


def fold_table(index: DataFrame, first_test: int, block: int, embargo: int) -> DataFrame:
    """Expanding folds: test block k and the last session it may train on (ML6)."""
    n = index.agg(F.count(F.lit(1)).alias("n"))
    starts = n.filter(F.col("n") > first_test).select("n", F.explode(F.sequence(F.lit(first_test), (F.col("n") - 1).cast("int"), F.lit(block))).alias("test_first"))
    return starts.select(
        ((F.col("test_first") - first_test) / block).cast("int").alias("fold"), (F.col("test_first") - embargo - 1).alias("train_last"),
        "test_first", F.least(F.col("test_first") + block - 1, F.col("n") - 1).cast("int").alias("test_last"))


def test_rows(samples: DataFrame, folds: DataFrame) -> DataFrame:
    """Each sample with the fold that tests it. Folds are spread to their sessions first."""
    days = folds.select("fold", "train_last", F.explode(F.sequence("test_first", "test_last")).alias("idx"))
    return samples.join(days, "idx")


def data_gate(bars: DataFrame, index: DataFrame, sessions: int, symbols: int) -> DataFrame:
    """Whether enough symbols hold enough contiguous sessions (ML15)."""
    rows = bars.join(index, "trading_date").select("symbol", "idx").distinct()
    run = F.col("idx") - F.row_number().over(by_idx())
    longest = rows.withColumn("_run", run).groupBy("symbol", "_run").agg(F.count(F.lit(1)).alias("n")) \
        .groupBy("symbol").agg(F.max("n").alias("longest"))
    return longest.agg(F.count_if(F.col("longest") >= sessions).alias("symbols_meeting"), F.count(F.lit(1)).alias("symbols")) \
        .withColumn("passes", F.col("symbols_meeting") >= symbols)


# --- leakage ------------------------------------------------------------------------------------

# Stands between symbol and cutoff in the name of a replica; no symbol holds a control sign.
SEPARATOR = "\x1f"


def truncated_replicas(bars: DataFrame, samples: DataFrame) -> DataFrame:
    """The bars of every sampled (symbol, cutoff) up to its cutoff, as a series of its own."""
    cut = samples.select("symbol", "cutoff").distinct()
    return (bars.join(cut, "symbol").filter(F.col("trading_date") <= F.col("cutoff"))
            .withColumn("symbol", F.concat("symbol", F.lit(SEPARATOR), F.col("cutoff").cast("string"))).drop("cutoff"))


def truncation_pairs(bars: DataFrame, features: Callable[[DataFrame], DataFrame], samples: DataFrame, digits: int = 9) -> DataFrame:
    """One row per sampled (symbol, cutoff) and day up to the cutoff: the features of the whole series
    (`full`) beside those of the series that ends there (`cut`), null where a side has no row (ML13).

    `features` turns bars (symbol, trading_date, ...) into one row per symbol and day. It runs once,
    over the series and their replicas together, so that both sides come from the same work.
    """
    samples = materialize(samples.select("symbol", "cutoff").distinct(), "cutoffs")
    rows = materialize(features(bars.unionByName(truncated_replicas(bars, samples))), "replicas")
    values = [F.round(f.name, digits).alias(f.name) if f.dataType.simpleString() == "double" else F.col(f.name)
              for f in rows.schema.fields if f.name not in ("symbol", "trading_date")]
    rows = rows.select(F.split_part("symbol", F.lit(SEPARATOR), F.lit(1)).alias("symbol"),
                       F.to_date(F.nullif(F.split_part("symbol", F.lit(SEPARATOR), F.lit(2)), F.lit(""))).alias("cutoff"),
                       "trading_date", F.struct(*values).alias("v"))
    full = rows.filter("cutoff is null").drop("cutoff").join(samples, "symbol").filter(F.col("trading_date") <= F.col("cutoff"))
    cut = rows.filter("cutoff is not null")
    key = ["symbol", "cutoff", "trading_date"]
    return full.withColumnRenamed("v", "full").join(cut.withColumnRenamed("v", "cut"), key, "full")


def truncation_differences(pairs: DataFrame) -> DataFrame:
    """Rows of either side that differ from the other; any row here fails the audit (ML13)."""
    odd = pairs.filter(~F.col("full").eqNullSafe(F.col("cut")))
    side = lambda c, name: odd.filter(F.col(c).isNotNull()).select("symbol", "cutoff", "trading_date", F.lit(name).alias("side"), f"{c}.*")
    return side("full", "FULL").unionByName(side("cut", "TRUNCATED"))


def truncation_audit(bars: DataFrame, features: Callable[[DataFrame], DataFrame], samples: DataFrame) -> DataFrame:
    """One row: replicas, rows compared, rows of either side that differ, and whether the audit passes (ML13)."""
    pairs = truncation_pairs(bars, features, samples)
    odd = ~F.col("full").eqNullSafe(F.col("cut"))
    sides = F.col("full").isNotNull().cast("long") + F.col("cut").isNotNull().cast("long")
    return pairs.agg(F.count_distinct("symbol", "cutoff").alias("replicas"), F.count("full").alias("compared"),
                     F.coalesce(F.sum(F.when(odd, sides)), F.lit(0)).alias("differing")).withColumn("passes", F.col("differing") == 0)


def sampled_cutoffs(bars: DataFrame, seed: str, n: int) -> DataFrame:
    """`n` bars of all, spread over the symbols, as (symbol, cutoff): see ranking.stratified_sample."""
    keyed = bars.select("symbol", "trading_date", F.col("trading_date").cast("string").alias("_key"))
    return stratified_sample(keyed, "symbol", "_key", seed, n).select("symbol", F.col("trading_date").alias("cutoff"))


def split_overlaps(split: DataFrame, horizon: int) -> DataFrame:
    """Per segment pair in date order, whether a label window reaches the next one (ML13)."""
    reach = split.groupBy("segment").agg(F.min("idx").alias("first_idx"), (F.max("idx") + horizon).alias("reach"), F.count(F.lit(1)).alias("n"))
    order = Window.orderBy("first_idx")  # one row per segment
    return reach.withColumn("next_first", F.lead("first_idx").over(order)).withColumn(
        "overlaps", F.coalesce(F.col("reach") >= F.col("next_first"), F.lit(False)))


def shuffled_labels(samples: DataFrame, label: str, seed: str) -> DataFrame:
    """Labels dealt out anew by a seeded hash; a model must then score at chance (ML13)."""
    key = [F.asc("symbol"), F.asc("trading_date")]
    dealt = F.sha2(F.concat_ws(":", F.lit(seed), "symbol", F.col("trading_date").cast("string")), 256)
    seats = positions(samples.drop(label), key, "_seat")
    cards = positions(samples.select(F.col(label), "symbol", "trading_date", dealt.alias("_h")), [F.asc("_h"), *key], "_seat").select("_seat", label)
    return seats.join(cards, "_seat").drop("_seat")
