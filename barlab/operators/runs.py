"""Run tables: state, selection, labels."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

FINISHED = ("COMPLETE", "ABORTED")


def run_state(events: DataFrame) -> DataFrame:
    """Current state per run: its last event (RUN1). events: run_id, at, seq, status, ..."""
    rest = [c for c in events.columns if c not in ("run_id", "seq")]
    packed = events.groupBy("run_id").agg(F.max_by(F.struct(*rest), F.struct("at", "seq")).alias("e"))
    return packed.select("run_id", *[F.col(f"e.{c}").alias(c) for c in rest])


def interrupt_leftovers(state: DataFrame, now: Column) -> DataFrame:
    """Runs still RUNNING when a new one starts become ABORTED / INTERRUPTED (RUN1)."""
    left = F.col("status") == "RUNNING"
    return state.select(
        "run_id", F.when(left, "ABORTED").otherwise(F.col("status")).alias("status"),
        F.when(left, "INTERRUPTED").otherwise(F.col("abort_reason")).alias("abort_reason"),
        F.when(left, now).otherwise(F.col("finished_at")).alias("finished_at"))


def run_violations(events: DataFrame) -> DataFrame:
    """Runs whose events break the lifecycle: not started exactly once, finished twice or
    before the start, or COMPLETE without both input versions (RUN1)."""
    starts, ends = F.col("status") == "RUNNING", F.col("status").isin(*FINISHED)
    bare = (F.col("status") == "COMPLETE") & (F.col("universe_version").isNull() | F.col("review_version").isNull())
    point = F.struct("at", "seq")
    counted = events.groupBy("run_id").agg(
        F.count_if(starts).alias("starts"), F.count_if(ends).alias("ends"), F.count_if(bare).alias("bare"),
        F.min(F.when(starts, point)).alias("first_start"), F.min(F.when(ends, point)).alias("first_end"))
    found = F.array_compact(F.array(
        F.when(F.col("starts") != 1, F.lit("NOT_STARTED_ONCE")), F.when(F.col("ends") > 1, F.lit("FINISHED_TWICE")),
        F.when(F.col("first_end") < F.col("first_start"), F.lit("FINISHED_BEFORE_START")),
        F.when(F.col("bare") > 0, F.lit("COMPLETE_WITHOUT_VERSIONS"))))
    return counted.select("run_id", F.explode(found).alias("violation"))


def latest_complete(runs: DataFrame, full_only: bool = True) -> DataFrame:
    """Latest COMPLETE run; partial runs (with a symbol filter) never count (TK1, TK2)."""
    kept = runs.filter(F.col("status") == "COMPLETE")
    if full_only:
        kept = kept.filter(F.col("symbols_filter_json").isNull())
    return kept.orderBy(F.desc("started_at"), F.asc("run_id")).limit(1)


def usable_acquisition(runs: DataFrame, minimum_universe: int, run_id: str | None = None) -> DataFrame:
    """Latest COMPLETE acquisition covering the universe with a benchmark; an explicit run
    only has to be COMPLETE with a benchmark (TK3)."""
    ok = runs.filter((F.col("status") == "COMPLETE") & (F.col("benchmark_status") == "OK"))
    if run_id is not None:
        return ok.filter(F.col("run_id") == run_id)
    full = (F.col("universe_count") >= minimum_universe) & (F.col("requested_count") == F.col("mapped_count"))
    return ok.filter(full).orderBy(F.desc("started_at"), F.asc("run_id")).limit(1)


# Columns of a run kept as JSON text, and what they hold.
JSON_COLUMNS = {"status_counts": "map<string,bigint>", "flag_counts": "map<string,bigint>", "excluded_symbols": "array<string>",
                "errors": "array<string>", "calendar_dates": "array<string>", "symbols_filter": "array<string>"}


def summarize(runs: DataFrame) -> DataFrame:
    """JSON columns parsed (null stays null), and the label FULL or SMOKE (RUN3)."""
    held = [name for name in JSON_COLUMNS if f"{name}_json" in runs.columns]
    parsed = runs.withColumns({name: F.from_json(f"{name}_json", JSON_COLUMNS[name]) for name in held}).drop(*[f"{name}_json" for name in held])
    n = F.size("symbols_filter")
    return parsed.withColumn("scan_label", F.when(n > 0, F.format_string("SMOKE (%d symbols)", n)).otherwise("FULL"))


def feature_context(scans: DataFrame, runs: DataFrame) -> DataFrame:
    """Whether a feature scan's as-of date is its run's closed session (RUN2)."""
    session = runs.select("run_id", F.col("latest_closed_session").alias("run_session"))
    return scans.join(session, "run_id", "left").withColumn(
        "as_of_matches_run", F.coalesce(F.col("run_session") == F.col("asof_date"), F.lit(False)))


def page(rows: DataFrame, order: list[Column], number: int, size: int) -> DataFrame:
    """One page of ordered rows with the total in every row (TK7)."""
    if number < 1 or size < 1:
        raise ValueError("page number and size must be positive")
    total = rows.agg(F.count(F.lit(1))).scalar()
    return rows.orderBy(*order).offset((number - 1) * size).limit(size).withColumn("total", total)
