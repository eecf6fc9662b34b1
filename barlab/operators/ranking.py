"""Exact order statistics without an ordering window over a whole table or group."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from barlab.session import materialize, small

# Sketch resolution for medians, and the share of rows kept on either side of the middle.
# The margin is ten times the sketch's own rank error.
SKETCH_ACCURACY = 10_000
MARGIN = 10 / SKETCH_ACCURACY
BROADCAST_GROUPS = 100_000  # one row a group and metric when broadcast; more are joined by shuffle


def positions(df: DataFrame, keys: list[Column], name: str = "position") -> DataFrame:
    """Exact 0-based position of every row in the total order of `keys`.

    A range sort spreads even one hot group over all tasks. The sorted rows are kept in the
    shared folder, so that counting them per task and numbering them agree even when an
    executor is lost; one row per task then carries the offsets.
    """
    placed = materialize(df.orderBy(*keys).withColumn("_id", F.monotonically_increasing_id()))
    task = F.shiftright("_id", 33)
    inside = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    placed = placed.withColumn("_task", task)
    sizes = placed.groupBy("_task").agg(F.count(F.lit(1)).alias("_n"))
    # one row per sorted task
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_task", F.coalesce(F.sum("_n").over(before), F.lit(0).cast("bigint")).alias("_before"))
    return (placed.join(F.broadcast(offsets), "_task")
            .withColumn(name, F.col("_before") + inside).drop("_task", "_id", "_before"))


def group_positions(df: DataFrame, groups: list[str], keys: list[Column], name: str = "position") -> DataFrame:
    """0-based position inside each group."""
    placed = positions(df, [*[F.col(g).asc() for g in groups], *keys], "_all")
    starts = placed.groupBy(*groups).agg(F.min("_all").alias("_start"), F.count(F.lit(1)).alias("group_size"))
    return placed.join(starts, groups).withColumn(name, F.col("_all") - F.col("_start")).drop("_all", "_start")


def average_ranks(df: DataFrame, groups: list[str], value: str, name: str) -> DataFrame:
    """Rank of `value` inside each group, ties sharing their mean rank (1-based)."""
    counts = df.groupBy(*groups, value).agg(F.count(F.lit(1)).alias("_c"))
    # distinct values are numbered by the rows before them: a prefix sum over sorted tasks
    placed = materialize(counts.orderBy(*[F.col(g).asc() for g in groups], F.col(value).asc())
                         .withColumn("_id", F.monotonically_increasing_id()))
    placed = placed.withColumn("_task", F.shiftright("_id", 33))
    sizes = placed.groupBy(*groups, "_task").agg(F.sum("_c").alias("_n"))
    before = Window.partitionBy(*groups).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*groups, "_task", F.coalesce(F.sum("_n").over(before), F.lit(0).cast("bigint")).alias("_before"))
    inside = Window.partitionBy(*groups, "_task").orderBy(value)
    ranked = (placed.withColumn("_through", F.sum("_c").over(inside)).join(offsets, [*groups, "_task"])
              .select(*groups, value, (F.col("_before") + F.col("_through") - (F.col("_c") - 1) / 2).alias(name)))
    return df.join(ranked, [*groups, value])


def stratified_sample(df: DataFrame, group: str, key: str, seed: str, n: int) -> DataFrame:
    """Order by (group, SHA-256 of seed and key) and take position int(i * rows / n) (TK9)."""
    if n <= 0:
        raise ValueError("sample size must be positive")
    total = df.agg(F.count(F.lit(1))).scalar()
    placed = positions(df, [F.col(group).asc(), F.sha2(F.concat(F.lit(seed), F.col(key)), 256).asc()])
    picks = df.sparkSession.range(n).select(F.col("id"), total.alias("_total"))
    picks = picks.filter(F.col("id") < F.col("_total")).select(
        F.floor(F.col("id") * (F.col("_total").cast("double") / n)).alias("position"))
    return placed.join(F.broadcast(picks), "position")  # n rows


def decile_bins(df: DataFrame, keys: list[Column], bins: int = 10) -> DataFrame:
    """Deterministic bin floor(j * bins / N) of each row's position j (TK11)."""
    total = df.agg(F.count(F.lit(1))).scalar()
    return positions(df, keys, "_j").withColumn("bin", F.floor(F.col("_j") * bins / total)).drop("_j")


def exact_medians(df: DataFrame, groups: list[str], values: list[str], digits: int = 4) -> DataFrame:
    """Exact median of each value column per group, nulls left out (FN6).

    A mergeable sketch brackets the middle; only values inside the bracket are counted one
    by one, everything under it is one count. The middle value is then read off the counts,
    so no group is gathered however large it is.
    """
    pairs = F.array(*[F.struct(F.lit(v).alias("metric"), F.col(v).cast("double").alias("v")) for v in values])
    long = df.select(*groups, F.explode(pairs).alias("m")).select(*groups, "m.metric", "m.v").filter("v is not null")
    keys = [*groups, "metric"]
    sketch = long.groupBy(*keys).agg(
        F.percentile_approx("v", [0.5 - MARGIN, 0.5 + MARGIN], SKETCH_ACCURACY).alias("_b"), F.count("v").alias("_n"))
    sketch = materialize(sketch, "sketch")
    tally = (long.join(small(sketch, BROADCAST_GROUPS), keys).filter(F.col("v") <= F.col("_b")[1])
             .groupBy(*keys, "_n", F.when(F.col("v") >= F.col("_b")[0], F.col("v")).alias("at"))
             .agg(F.count(F.lit(1)).alias("c")))
    # a prefix sum over range-sorted tasks, as in average_ranks: no task orders a whole group
    placed = materialize(tally.orderBy(*[F.col(k).asc() for k in keys], F.asc_nulls_first("at")).withColumn("_id", F.monotonically_increasing_id()))
    placed = placed.withColumn("_task", F.shiftright("_id", 33))
    sizes = placed.groupBy(*keys, "_task").agg(F.sum("c").alias("_s"))
    earlier = Window.partitionBy(*keys).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*keys, "_task", F.coalesce(F.sum("_s").over(earlier), F.lit(0).cast("bigint")).alias("_before"))
    inside = Window.partitionBy(*keys, "_task").orderBy(F.asc_nulls_first("at"))
    tally = placed.withColumn("_in", F.sum("c").over(inside)).join(offsets, [*keys, "_task"]).withColumn("_to", F.col("_before") + F.col("_in"))
    tally = tally.withColumn("_from", F.col("_to") - F.col("c"))

    def covering(rank: Column) -> Column:
        return F.max(F.when((F.col("_from") < rank) & (rank <= F.col("_to")), F.col("at")))

    low, high = covering(F.floor((F.col("_n") + 1) / 2)), covering(F.floor(F.col("_n") / 2) + 1)
    found = tally.groupBy(*keys).agg(low.alias("lo"), high.alias("hi")).select(
        *keys, F.when(F.col("lo").isNull() | F.col("hi").isNull(),
                      F.raise_error(F.lit("median outside its bracket")).cast("double"))
        .otherwise(F.round((F.col("lo") + F.col("hi")) / 2, digits)).alias("median"))
    return found.groupBy(*groups).agg(*[F.max(F.when(F.col("metric") == v, F.col("median"))).alias(f"median_{v}")
                                        for v in values])
