"""Closes either side of a split or bonus ex-date (JN14)."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def compare_across_events(bars: DataFrame, events: DataFrame) -> DataFrame:
    """Per event (symbol, ex_date, price_divisor): last close before, first close on or after,
    their ratio and its distance to 1 (adjusted) and to 1 / divisor (raw).

    Events are laid on the symbol's own timeline and look one way in each of two passes, so
    an event never meets all bars of its symbol. A divisor of 1 or less and a close that is
    not positive are errors.
    """
    error = lambda text, kind: F.raise_error(F.lit(text)).cast(kind)
    close = F.when(F.col("close") <= 0, error("non-positive close in series", "double")).otherwise(F.col("close"))
    divisor = F.when(F.col("price_divisor") <= 1, error("price_divisor must be above 1", "double")) \
        .otherwise(F.col("price_divisor").cast("double"))
    held = bars.select("symbol", F.col("trading_date").alias("at"),
                       F.struct(F.col("trading_date").alias("date"), close.alias("close")).alias("bar"))
    asked = events.select("symbol", F.col("ex_date").alias("at"), divisor.alias("price_divisor"))
    line = held.unionByName(asked, allowMissingColumns=True)
    is_bar = F.col("bar").isNotNull()
    so_far = lambda *order: Window.partitionBy("symbol").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # on a shared day the event comes first going forward and last going back
    forward, backward = so_far(F.asc("at"), is_bar.asc()), so_far(F.desc("at"), is_bar.desc())
    rows = (line.withColumn("b", F.last("bar", ignorenulls=True).over(forward))
            .withColumn("a", F.last("bar", ignorenulls=True).over(backward)).filter(~is_bar))
    ratio = F.col("a.close") / F.col("b.close")
    expected = 1 / F.col("price_divisor")
    return rows.select(
        "symbol", F.col("at").alias("ex_date"), "price_divisor", F.col("b.date").alias("date_before"),
        F.col("b.close").alias("close_before"), F.col("a.date").alias("date_on_or_after"),
        F.col("a.close").alias("close_on_or_after"), ratio.alias("observed_ratio"), expected.alias("unadjusted_expected_ratio"),
        F.abs(ratio - 1).alias("distance_to_adjusted"), F.abs(ratio - expected).alias("distance_to_unadjusted"),
        ratio.isNotNull().alias("conclusive"))
