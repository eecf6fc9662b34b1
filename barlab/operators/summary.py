"""Descriptive summaries of stored scans and features. They count; they do not rank."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from barlab.functions.numeric import share_pct
from barlab.operators.classify import STATUSES
from barlab.operators.ranking import exact_medians

# Edges of the distance-from-high buckets, the last one open.
DISTANCE_EDGES = ((0, 2), (2, 5), (5, 10), (10, 20), (20, None))
UNKNOWN_SECTOR = "UNKNOWN"


def feature_rows(features: DataFrame, results: DataFrame, bars: DataFrame) -> DataFrame:
    """Features with the scan's sector and the close on the feature's last date (JN4)."""
    closes = bars.groupBy("symbol", F.col("trading_date").alias("last_date")).agg(F.max("close").alias("close"))
    sector = results.select("symbol", "sector")
    return features.join(sector, "symbol", "left").join(closes, ["symbol", "last_date"], "left")


def features_of(symbols: DataFrame, features: DataFrame, quality: DataFrame, bars: DataFrame) -> DataFrame:
    """Features of the listed symbols with close and break details; symbols without a feature
    row are absent (JN5)."""
    wanted = features.join(symbols.select("symbol").distinct(), "symbol", "left_semi")
    closes = (bars.join(wanted.select("symbol", F.col("last_date").alias("trading_date")), ["symbol", "trading_date"], "left_semi")
              .groupBy("symbol").agg(F.max("close").alias("close")))
    return wanted.join(closes, "symbol", "left").join(
        quality.select("symbol", "break_date", "break_ratio"), "symbol", "left")


def _labelled(values: dict[str, list[Column]], names: list[str]) -> Column:
    """Explodes one aggregated row into labelled rows."""
    return F.explode(F.array(*[F.struct(F.lit(k).alias("label"), *[c.alias(n) for c, n in zip(cols, names)])
                               for k, cols in values.items()]))


def breadth(rows: DataFrame, periods: dict[str, int]) -> DataFrame:
    """Share of symbols above each EMA, with its denominator (AG5)."""
    aggs = []
    for label in periods:
        both = F.col(f"ema_{label}").isNotNull() & F.col("close").isNotNull()
        aggs += [F.count_if(both & (F.col("close") > F.col(f"ema_{label}"))).alias(f"{label}_count"),
                 F.count_if(both).alias(f"{label}_of")]
    one = rows.agg(*aggs)
    parts = {k: [F.lit(p), F.col(f"{k}_count"), F.col(f"{k}_of")] for k, p in periods.items()}
    return one.select(_labelled(parts, ["period", "count", "of"]).alias("x")).select("x.*") \
        .withColumn("pct", share_pct(F.col("count"), F.col("of")))


def rsi_histogram(rows: DataFrame) -> DataFrame:
    """Ten bins, 100 in the last one, empty bins kept (AG6)."""
    place = F.least(F.floor(F.col("rsi") / 10), F.lit(9))
    one = rows.agg(*[F.count_if(place == i).alias(f"b{i}") for i in range(10)])
    bins = F.array(*[F.struct(F.lit(i * 10).alias("lo"), F.lit(i * 10 + 10).alias("hi"), F.col(f"b{i}").alias("count"))
                     for i in range(10)])
    return one.select(F.explode(bins).alias("x")).select("x.*")


def _overall(rows: DataFrame, value: str, *aggs: Column) -> DataFrame:
    middle = exact_medians(rows.withColumn("_all", F.lit(1)), ["_all"], [value]).select(f"median_{value}")
    return rows.agg(*aggs).withColumn("median", middle.scalar())


def rsi_summary(rows: DataFrame) -> DataFrame:
    return _overall(rows, "rsi", F.count("rsi").alias("of"))


def roc_summary(rows: DataFrame) -> DataFrame:
    """Median and positive share of the rate of change (AG7)."""
    out = _overall(rows, "roc", F.count_if(F.col("roc") > 0).alias("positive"), F.count("roc").alias("of"))
    return out.withColumn("pct", share_pct(F.col("positive"), F.col("of")))


def high_proximity(rows: DataFrame) -> DataFrame:
    """At-high count, median distance, symbols without a value (AG8)."""
    d = F.col("distance_from_high")
    return _overall(rows, "distance_from_high", F.count(d).alias("of"), F.count_if(d <= 0).alias("at_high"),
                    F.count_if(d.isNull()).alias("no_value"))


def distance_buckets(rows: DataFrame) -> DataFrame:
    """Counts per distance bucket; a negative distance is in none (AG8)."""
    d = F.col("distance_from_high")
    inside = [(lo, hi, (d >= lo) if hi is None else (d >= lo) & (d < hi)) for lo, hi in DISTANCE_EDGES]
    one = rows.agg(*[F.count_if(cond).alias(f"b{lo}") for lo, _, cond in inside])
    bins = F.array(*[F.struct(F.lit(lo).alias("lo"), F.lit(hi).cast("int").alias("hi"), F.col(f"b{lo}").alias("count"))
                     for lo, hi, _ in inside])
    return one.select(F.explode(bins).alias("x")).select("x.*")


def named_sector() -> Column:
    """The sector; null and empty are unknown."""
    return F.coalesce(F.nullif("sector", F.lit("")), F.lit(UNKNOWN_SECTOR))


def sector_strength(rows: DataFrame) -> DataFrame:
    """Per sector: size, share above the medium EMA, medians; alphabetical (AG9)."""
    rows = rows.withColumn("sector", named_sector())
    both = F.col("ema_medium").isNotNull() & F.col("close").isNotNull()
    counts = rows.groupBy("sector").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(both & (F.col("close") > F.col("ema_medium"))).alias("above"),
        F.count_if(both).alias("of")).withColumn("above_pct", share_pct(F.col("above"), F.col("of")))
    middle = exact_medians(rows, ["sector"], ["roc", "relative_return", "distance_from_high"])
    return counts.join(middle, "sector", "left").orderBy("sector")


def sector_status(results: DataFrame) -> DataFrame:
    """Status counts per sector with a total (AG10)."""
    wide = (results.groupBy(named_sector().alias("sector"))
            .pivot("status", list(STATUSES)).agg(F.count(F.lit(1))))
    counts = [F.coalesce(F.col(s), F.lit(0)).alias(s.lower()) for s in STATUSES]
    return wide.select("sector", *counts).withColumn("total", sum((F.col(s.lower()) for s in STATUSES), F.lit(0)))


def warnings(results: DataFrame, quality: DataFrame, review_version: str | None, high_window: int) -> DataFrame:
    """Every scan result with its ordered list of warnings, from both scans (AG11)."""
    q = quality.select("symbol", *[F.col(c).alias(f"q_{c}") for c in (
        "status", "reason", "w52_complete", "volume_usable", "break_date", "break_ratio")], F.lit(True).alias("q_seen"))
    rows = results.join(q, "symbol", "left")
    seen = F.col("q_seen").isNotNull()
    broke = F.col("q_break_date").isNotNull()
    ratio = F.when(F.col("q_break_ratio").isNotNull(), F.format_string(" (close ratio %.4f)", "q_break_ratio")).otherwise("")
    on = F.concat(F.col("q_break_date").cast("string"), ratio)

    def warn(cond: Column, code: Column, message: Column) -> Column:
        return F.when(cond, F.struct(code.alias("code"), message.alias("message")))

    lit = F.lit
    found = F.array_compact(F.array(
        warn(F.col("status") != "VALID", F.col("status"), F.coalesce(F.nullif("status_reason", lit("")), lit("no reason recorded by the scanner"))),
        warn(F.col("history_gaps"), lit("history_gaps"), F.format_string("%d missing session(s); %d available", "missing", "available")),
        warn(F.col("corporate_action_review"), lit("corporate_action_review"),
             lit(f"listed in the corporate-action review file (version {review_version or 'unknown'})")),
        warn(F.col("price_break_detected"), lit("price_break_detected"),
             F.concat(lit("close-to-close jump consistent with an unadjusted split/bonus"),
                      F.when(broke, F.concat(lit("; E4 break on "), on)).otherwise(""))),
        warn(F.col("non_eq_series"), lit("non_eq_series"),
             F.concat(lit("series "), F.coalesce(F.nullif("series", lit("")), lit("unknown")), lit(" is not EQ"))),
        warn(seen & (F.col("q_status") != "VALID"), F.concat(lit("e4_"), F.col("q_status")),
             F.coalesce(F.nullif("q_reason", lit("")), lit("no reason recorded by the E4 scan"))),
        warn(seen & ~F.coalesce("q_w52_complete", lit(False)), lit("e4_no_full_high_window"),
             lit(f"fewer than {high_window} bars: the high-window distance is unavailable")),
        warn(seen & ~F.coalesce("q_volume_usable", lit(False)), lit("e4_volume_unusable"),
             lit("volume history not usable: relative volume unavailable")),
        warn(seen & broke & ~F.col("price_break_detected"), lit("e4_break"),
             F.concat(lit("E4 detected a break on "), on, lit("; indicators use later bars only")))))
    return rows.withColumn("warnings", found).drop(*[c for c in rows.columns if c.startswith("q_")])


def issues(warned: DataFrame) -> DataFrame:
    """Only symbols with a warning, one row per warning in order (AG11)."""
    return warned.select("symbol", "company_name", "sector", "status", F.posexplode("warnings").alias("place", "w")) \
        .select("symbol", "company_name", "sector", "status", "place", "w.code", "w.message")


def warning_counts(warned: DataFrame) -> DataFrame:
    return warned.select(F.explode("warnings").alias("w")).groupBy("w.code").agg(F.count(F.lit(1)).alias("n"))


def warning_totals(warned: DataFrame) -> DataFrame:
    n = F.size("warnings")
    return warned.agg(F.count(F.lit(1)).alias("symbols_total"), F.count_if(n > 0).alias("symbols_with_warnings"),
                      F.count_if(n == 0).alias("symbols_without_warning"))


# --- one table for all views ------------------------------------------------------------------

MEDIANS = ("rsi", "roc", "distance_from_high", "relative_return")


def _feature_facts(periods: dict[str, int]) -> Column:
    """What a feature row counts for: an array of (view, item)."""
    fact = lambda cond, view, item="": F.when(cond, F.struct(F.lit(view).alias("view"), F.lit(item).alias("item")))
    d = F.col("distance_from_high")
    found = [fact(F.lit(True), "symbols"), fact(F.col("rsi").isNotNull(), "rsi_of"), fact(F.col("roc").isNotNull(), "roc_of"),
             fact(F.col("roc") > 0, "roc_positive"), fact(d.isNotNull(), "distance_of"), fact(d <= 0, "at_high"), fact(d.isNull(), "no_distance"),
             F.when(F.col("rsi").isNotNull(), F.struct(F.lit("rsi_bin").alias("view"), (F.least(F.floor(F.col("rsi") / 10), F.lit(9)) * 10).cast("string").alias("item")))]
    for label in periods:
        both = F.col(f"ema_{label}").isNotNull() & F.col("close").isNotNull()
        found += [fact(both, "breadth_of", label), fact(both & (F.col("close") > F.col(f"ema_{label}")), "breadth_above", label)]
    found += [fact((d >= lo) if hi is None else (d >= lo) & (d < hi), "distance_bucket", str(lo)) for lo, hi in DISTANCE_EDGES]
    return F.array_compact(F.array(*found))


def summary_table(rows: DataFrame, warned: DataFrame, periods: dict[str, int]) -> DataFrame:
    """sector, view, item, value: every count the summaries show, over all symbols (sector null) and per
    sector, and the exact medians.

    rows: feature rows with sector and close (JN4); warned: scan results with their warnings (AG11). Each
    row names the counts it belongs to, and one aggregate with two grouping sets adds them up, so
    however many views there are the rows are read once. Zero counts have no row.
    """
    one = lambda df, facts: df.select(named_sector().alias("sector"), F.explode(facts).alias("f")).select("sector", "f.view", "f.item")
    tell = lambda view, item: F.struct(F.lit(view).alias("view"), item.alias("item"))
    results = F.concat(F.array(tell("status", F.col("status"))), F.transform("warnings", lambda w: tell("warning", w["code"])))
    facts = one(rows, _feature_facts(periods)).unionByName(one(warned, results))
    counts = facts.groupingSets([["view", "item"], ["sector", "view", "item"]], "sector", "view", "item").agg(F.count(F.lit(1)).cast("double").alias("value"))
    scopes = rows.withColumn("scope", F.explode(F.array(F.lit(None).cast("string"), named_sector()))).withColumn("scope", F.coalesce(F.concat(F.lit("="), "scope"), F.lit("")))
    middle = exact_medians(scopes, ["scope"], list(MEDIANS))
    medians = middle.select(F.nullif(F.expr("substring(scope, 2)"), F.lit("")).alias("sector"), F.explode(F.array(*[
        F.struct(F.lit("median").alias("view"), F.lit(m).alias("item"), F.col(f"median_{m}").alias("value")) for m in MEDIANS])).alias("m"))
    return counts.unionByName(medians.select("sector", "m.view", "m.item", "m.value").filter("value is not null"))


def overall(table: DataFrame, view: str) -> DataFrame:
    """item, value of a view over all symbols."""
    return table.filter(F.col("sector").isNull() & (F.col("view") == view)).select("item", "value")


def acquisition_status(runs: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Status counts of the latest COMPLETE acquisition (AG14). outcomes: run_id, symbol, status."""
    latest = runs.filter("status = 'COMPLETE'").agg(F.max_by("run_id", F.struct("started_at", "run_id"))).scalar()
    return outcomes.filter(F.col("run_id") == latest).groupBy("run_id", "status").agg(F.count(F.lit(1)).alias("n"))


def short_histories(runs: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Symbols of the latest COMPLETE acquisition with too short a history (AG14)."""
    latest = runs.filter("status = 'COMPLETE'").agg(F.max_by("run_id", F.struct("started_at", "run_id"))).scalar()
    return outcomes.filter((F.col("run_id") == latest) & (F.col("status") == "INSUFFICIENT_HISTORY"))


def latest_snapshots(snapshots: DataFrame, n: int, order: str = "trading_date") -> DataFrame:
    """The newest n snapshots of every symbol, in bulk (TK8).

    Spark cuts a row_number filter down to n rows per symbol and task before the exchange, so
    a symbol with very many snapshots sends at most n from each task.
    """
    newest = Window.partitionBy("symbol").orderBy(F.desc(order))
    return snapshots.withColumn("_r", F.row_number().over(newest)).filter(F.col("_r") <= n).drop("_r")


def symbol_snapshots(snapshots: DataFrame, symbol: str, n: int, order: str = "trading_date") -> DataFrame:
    """The newest n snapshots of one symbol (TK8)."""
    return snapshots.filter(F.col("symbol") == symbol).orderBy(F.desc(order)).limit(n)


def fetch_history(snapshots: DataFrame, limit: int) -> DataFrame:
    """The latest `limit` fetches of every symbol across all runs, newest first (VW4). snapshots:
    symbol, run_id, trading_date, fetched_at, status, ..."""
    newest = Window.partitionBy("symbol").orderBy(F.desc("fetched_at"), F.desc("run_id"), F.desc("trading_date"))
    return snapshots.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") <= limit).drop("_rank")


def provenance(results: DataFrame, run: DataFrame, quality: DataFrame) -> DataFrame:
    """Where a symbol's result comes from: its instrument, the run (one row) and the state of its
    features (VW4)."""
    of_run = run.agg(F.first(F.struct("run_id", "latest_closed_session"))).scalar()
    rows = results.select("symbol", "instrument_key", "isin", "series").withColumn("_run", of_run)
    judged = quality.select("symbol", F.col("status").alias("quality_status"), F.col("reason").alias("quality_reason"))
    return rows.join(judged, "symbol", "left").select(
        "symbol", "instrument_key", "isin", "series", "_run.run_id", "_run.latest_closed_session", "quality_status", "quality_reason")
