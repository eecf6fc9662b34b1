"""Point-in-time index membership from a snapshot and dated change announcements.

An event is (file, effective_date, action, symbol). Going back in time a symbol is a member
just before one of its event dates exactly if that date excludes it, and just after the date
it is what it was before its next event, or what the snapshot says. Each symbol is therefore
settled on its own; nothing walks one set through all dates.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from barlab.operators.ranking import group_positions
from barlab.session import materialize

FOREVER = "9999-12-31"


def apply_voids(events: DataFrame, voids: DataFrame) -> DataFrame:
    """Drop announcements declared void; symbol '*' voids the whole file and date (JN8). A void
    without a date meets announcements without one."""
    v = voids.select(F.col("file").alias("_file"), F.col("effective_date").alias("_date"), F.col("symbol").alias("_symbol")).distinct()
    here = (F.col("file") == F.col("_file")) & F.col("effective_date").eqNullSafe(F.col("_date"))
    return (events.join(v.filter("_symbol = '*'"), here, "left_anti")
            .join(v.filter("_symbol <> '*'"), here & (F.col("symbol") == F.col("_symbol")), "left_anti"))


CHANGE = ["kind", "symbol", "_day"]  # an undated change has the empty day


def _crossing(announced: DataFrame, cancels: DataFrame) -> DataFrame:
    """Per change the one file, if any, whose cancels come to be matched with its own announcements.

    Cancels go up through the files while the announcement next in line goes down, so the two can meet
    in a single file. `_k` is the first cancel that meets its own file, `_m` the cancels of that file
    from there on, `_r` the announcements of the file still standing then.
    """
    runs = lambda df, start, n: df.groupBy(*CHANGE, "file").agg(F.min("_at").alias(start), F.count(F.lit(1)).alias(n))
    both = runs(cancels, "_c", "_cn").join(runs(announced, "_a", "_an"), [*CHANGE, "file"])
    first = F.greatest("_c", "_a")
    ends = F.least(F.col("_c") + F.col("_cn"), F.col("_a") + F.col("_an"))
    return both.filter(first < ends).select(*CHANGE, first.alias("_k"), (F.col("_c") + F.col("_cn") - first).alias("_m"),
                                            (F.col("_a") + F.col("_an") - first).alias("_r"))


def match_cancellations(events: DataFrame) -> DataFrame:
    """Every cancel with the file it hit, and every announcement that stands (JN9).

    Rows: kind, symbol, effective_date, file, cancels, other (of a cancel the cancelled file,
    null when it matched nothing). Cancels are taken in file order; each removes the last-listed
    matching announcement of another file. Both sides are numbered by a distributed sort, cancels from
    the first file and announcements from the last, and the n-th meets the n-th. Only in the file
    where they cross (see _crossing) its cancels reach past its own announcements, which later
    cancels then take. So a change announced and cancelled in very many files is never gathered.
    Every copy of a statement counts.
    """
    rows = events.select(F.regexp_replace("action", "^CANCEL_", "").alias("kind"), "symbol", "file",
                         F.coalesce(F.col("effective_date").cast("string"), F.lit("")).alias("_day"),
                         F.startswith("action", F.lit("CANCEL_")).alias("cancels"))
    facts = rows.groupBy(*CHANGE).agg(F.bool_or("cancels").alias("_any"))
    rows = materialize(rows.join(facts, CHANGE), "statements")
    lined = rows.filter("_any").drop("_any")
    announced = materialize(group_positions(lined.filter("not cancels"), CHANGE, [F.desc("file")], "_at").drop("group_size"), "announced")
    cancels = materialize(group_positions(lined.filter("cancels"), CHANGE, [F.asc("file")], "_at").drop("group_size"), "cancels")
    k = F.col("_at")
    reached = (F.when((k >= F.col("_k")) & (k < F.col("_k") + F.col("_m")), k + F.col("_r"))
               .when((k >= F.col("_k") + F.col("_m")) & (k < F.col("_k") + F.col("_m") + F.col("_r")), k - F.col("_m")).otherwise(k))
    aimed = cancels.join(_crossing(announced, cancels), CHANGE, "left").withColumn("_at", reached).drop("_k", "_m", "_r")
    met = [*CHANGE, "_at"]
    nothing = F.lit(None).cast("string").alias("other")
    stands = announced.join(aimed.select(*met), met, "left_anti").withColumn("other", nothing)
    hits = aimed.join(announced.select(*met, F.col("file").alias("other")), met, "left")
    columns = [*CHANGE, "file", "cancels", "other"]
    out = rows.filter("not _any").withColumn("other", nothing).select(*columns)
    for part in (stands, hits):
        out = out.unionByName(part.select(*columns))
    return out.withColumn("effective_date", F.to_date(F.nullif("_day", F.lit("")))).drop("_day")


def cancellations(matched: DataFrame) -> DataFrame:
    """Every cancel with the file it cancelled; null when it matched nothing."""
    return matched.filter("cancels").select(F.col("file").alias("cancelling_file"), F.col("other").alias("cancelled_file"),
                                            "symbol", "kind", "effective_date")


def standing_events(matched: DataFrame) -> DataFrame:
    return matched.filter("not cancels").select("file", "effective_date", F.col("kind").alias("action"), "symbol")


def rename(events: DataFrame, aliases: DataFrame) -> DataFrame:
    """Old symbols carried to the symbol of the snapshot (JN10)."""
    names = aliases.select(F.col("old_symbol").alias("symbol"), "new_symbol")
    return events.join(names, "symbol", "left").withColumn("symbol", F.coalesce("new_symbol", "symbol")).drop("new_symbol")


def last_announced(events: DataFrame) -> DataFrame:
    """The same change announced twice keeps its last file (MEM5)."""
    return events.groupBy("effective_date", "action", "symbol").agg(F.max("file").alias("file"))


def undated(events: DataFrame) -> DataFrame:
    return events.filter("effective_date is null")


def after_snapshot(events: DataFrame, snap_date: Column) -> DataFrame:
    """Changes announced for later than the snapshot: listed, not applied (MEM4)."""
    return events.filter(F.col("effective_date") > snap_date)


def settled(events: DataFrame, voids: DataFrame, aliases: DataFrame) -> DataFrame:
    """Dated changes that stand, under their present symbols, one file each."""
    standing = standing_events(match_cancellations(apply_voids(events, voids)))
    return last_announced(rename(standing, aliases).filter("effective_date is not null"))


def state_changes(changes: DataFrame, snapshot: DataFrame, snap_date: Column) -> DataFrame:
    """Per (symbol, date) up to the snapshot: the files, and membership before and after (MEM1)."""
    pick = lambda a: F.max(F.when(F.col("action") == a, F.col("file")))
    daily = (changes.filter(F.col("effective_date") <= snap_date).groupBy("symbol", "effective_date")
             .agg(pick("INCLUDE").alias("inc"), pick("EXCLUDE").alias("exc"))
             .withColumn("before", F.col("exc").isNotNull()))
    held = snapshot.select("symbol").distinct().withColumn("_snap", F.lit(True))
    timeline = Window.partitionBy("symbol").orderBy("effective_date")
    return (daily.join(held, "symbol", "left")
            .withColumn("in_snapshot", F.coalesce("_snap", F.lit(False)))
            .withColumn("after", F.coalesce(F.lead("before").over(timeline), "in_snapshot")).drop("_snap"))


def anomalies(states: DataFrame) -> DataFrame:
    """An inclusion of a non-member, an exclusion of a member (MEM2)."""
    found = F.array_compact(F.array(
        F.when(F.col("inc").isNotNull() & ~F.col("after"),
               F.struct(F.col("inc").alias("file"), F.lit("INCLUDE_NOT_MEMBER").alias("check"))),
        F.when(F.col("exc").isNotNull() & F.col("after"),
               F.struct(F.col("exc").alias("file"), F.lit("EXCLUDE_IS_MEMBER").alias("check")))))
    return states.select("effective_date", "symbol", F.explode(found).alias("f")) \
        .select("effective_date", "f.file", "symbol", "f.check")


def open_end(changes: DataFrame, snap_date: Column) -> DataFrame:
    """One row: the earliest change after the snapshot, where open intervals end."""
    later = F.min(F.when(F.col("effective_date") > snap_date, F.col("effective_date")))
    return changes.agg(F.coalesce(later, F.lit(FOREVER).cast("date")).alias("end"))


def segments(states: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Stretches between a symbol's events: start (null = from the beginning), member or not,
    whether the event at the start failed a check and whether it was an inclusion."""
    first = Window.partitionBy("symbol").orderBy("effective_date")
    bad = (F.col("inc").isNotNull() & ~F.col("after")) | (F.col("exc").isNotNull() & F.col("after"))
    from_events = states.select("symbol", F.col("effective_date").alias("start"), F.col("after").alias("member"),
                                bad.alias("anomalous"), F.col("inc").isNotNull().alias("included"))
    quiet = F.lit(False)
    opening = states.withColumn("_n", F.row_number().over(first)).filter("_n = 1").select(
        "symbol", F.lit(None).cast("date").alias("start"), F.col("before").alias("member"), quiet.alias("anomalous"),
        quiet.alias("included"))
    still = snapshot.select("symbol").distinct().join(states.select("symbol").distinct(), "symbol", "left_anti").select(
        "symbol", F.lit(None).cast("date").alias("start"), F.lit(True).alias("member"), quiet.alias("anomalous"),
        quiet.alias("included"))
    return from_events.unionByName(opening).unionByName(still)


def intervals(states: DataFrame, snapshot: DataFrame, end: Column) -> DataFrame:
    """Reconstructed membership [member_from, member_until) per symbol; never merged across a
    date that includes the symbol (MEM1)."""
    line = Window.partitionBy("symbol").orderBy(F.asc_nulls_first("start"))
    pieces = (segments(states, snapshot)
              .withColumn("until", F.coalesce(F.lead("start").over(line), end))
              .withColumn("_new", F.col("included") | ~F.coalesce(F.lag("member").over(line), F.lit(False)))
              .withColumn("_touched", F.bool_or("anomalous").over(Window.partitionBy("symbol")))
              .filter("member")
              .withColumn("_island", F.sum(F.col("_new").cast("int")).over(line)))
    held = snapshot.select("symbol").distinct().withColumn("in_snapshot", F.lit(True))
    merged = pieces.groupBy("symbol", "_island").agg(
        F.when(F.bool_or(F.col("start").isNull()), F.lit(None)).otherwise(F.min("start")).alias("member_from"),
        F.max("until").alias("member_until"), F.bool_or("_touched").alias("touched_by_anomaly"))
    return merged.join(held, "symbol", "left").select(
        "symbol", "member_from", "member_until", F.coalesce("in_snapshot", F.lit(False)).alias("in_snapshot"), "touched_by_anomaly")


def timeline(states: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Size of the set just before every event date, with the number of files of that date (MEM3).

    The running sum goes over distinct event dates, at most one row per calendar day.
    """
    size = snapshot.agg(F.count_distinct("symbol")).scalar()
    daily = states.groupBy("effective_date").agg(F.sum(F.col("before").cast("int") - F.col("after").cast("int")).alias("delta"))
    named = timeline_files(states).groupBy("effective_date").agg(F.count(F.lit(1)).alias("n_files"))
    back = Window.orderBy(F.desc("effective_date")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return daily.join(named, "effective_date").select("effective_date", "n_files", F.sum("delta").over(back).alias("_d")) \
        .withColumn("size_before", size + F.col("_d")).drop("_d")


def timeline_files(states: DataFrame) -> DataFrame:
    """The files behind every event date, one row each (MEM3)."""
    both = F.array_compact(F.array("inc", "exc"))
    return states.select("effective_date", F.explode(both).alias("file")).distinct()


def anomaly_windows(changes: DataFrame, found: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Per failed check of a snapshot symbol: from its date to the symbol's next event (MEM6)."""
    line = Window.partitionBy("symbol").orderBy("effective_date")
    dates = (changes.select("symbol", "effective_date").distinct()
             .withColumn("until", F.coalesce(F.lead("effective_date").over(line), F.lit(FOREVER).cast("date"))))
    return (found.select("symbol", "effective_date").distinct()
            .join(snapshot.select("symbol").distinct(), "symbol", "left_semi")
            .join(dates, ["symbol", "effective_date"])
            .select("symbol", F.col("effective_date").alias("start"), "until"))


def drift_states(line: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Set size minus snapshot size, with the date each value comes into force; null is the
    beginning (MEM8). One row per event date."""
    size = snapshot.agg(F.count_distinct("symbol")).scalar()
    order = Window.orderBy("effective_date")
    sized = line.withColumn("_drift", F.col("size_before") - size)
    later = sized.select(F.col("effective_date").alias("since"), F.coalesce(F.lead("_drift").over(order), F.lit(0)).alias("drift"))
    oldest = sized.agg(F.min_by("_drift", "effective_date").alias("drift")).filter("drift is not null") \
        .select(F.lit(None).cast("date").alias("since"), "drift")
    return later.unionByName(oldest)


class Reconstruction:
    """One study's membership. The settled changes and the states feed every audit step, so
    they are kept in the shared folder once instead of being planned anew for each."""

    def __init__(self, events: DataFrame, voids: DataFrame, aliases: DataFrame, snapshot: DataFrame, snap_date: Column):
        self.snap_date = snap_date
        self.snapshot = materialize(snapshot.select("symbol").distinct())
        self.changes = materialize(settled(events, voids, aliases))
        self.states = materialize(state_changes(self.changes, self.snapshot, snap_date))

    def anomalies(self) -> DataFrame:
        return anomalies(self.states)

    def segments(self) -> DataFrame:
        return segments(self.states, self.snapshot)

    def end(self) -> Column:
        return open_end(self.changes, self.snap_date).scalar()

    def intervals(self) -> DataFrame:
        return intervals(self.states, self.snapshot, self.end())

    def timeline(self) -> DataFrame:
        return timeline(self.states, self.snapshot)

    def timeline_files(self) -> DataFrame:
        return timeline_files(self.states)

    def anomaly_windows(self) -> DataFrame:
        return anomaly_windows(self.changes, self.anomalies(), self.snapshot)

    def drift_states(self) -> DataFrame:
        return drift_states(self.timeline(), self.snapshot)
