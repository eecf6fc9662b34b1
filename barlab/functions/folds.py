"""Recursive indicators as folds over one symbol's ordered values.

The arrays come from a group by symbol after the bars were reduced to one per
(symbol, date), so an array never holds more entries than there are calendar days.
"""
from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from barlab.config import positive


def head_mean(values: Column, period: int) -> Column:
    return F.aggregate(F.slice(values, 1, period), F.lit(0.0), lambda acc, x: acc + x) / F.lit(float(period))


def rest(values: Column, period: int) -> Column:
    return F.slice(values, F.lit(period + 1), F.greatest(F.size(values) - F.lit(period), F.lit(0)))


def ema_last(closes: Column, period: int) -> Column:
    """Last EMA value, seeded by the mean of the first `period` values; null when shorter."""
    positive("period", period)
    alpha = 2.0 / (period + 1)
    fold = F.aggregate(rest(closes, period), head_mean(closes, period),
                       lambda e, c: F.lit(alpha) * c + F.lit(1 - alpha) * e)
    return F.when(F.size(closes) >= period, fold)


def ema_series(closes: Column, period: int) -> Column:
    """EMA at every position, null before the seed. Appending copies the array, so this is
    meant for chart lengths; the last value alone comes from ema_last."""
    positive("period", period)
    alpha = 2.0 / (period + 1)
    lead = F.array_repeat(F.lit(None).cast("double"), period - 1)
    seeded = F.concat(lead, F.array(head_mean(closes, period)))
    fold = F.aggregate(rest(closes, period), seeded,
                       lambda s, c: F.array_append(s, F.lit(alpha) * c + F.lit(1 - alpha) * F.element_at(s, -1)))
    return F.when(F.size(closes) >= period, fold)


def wilder_last(values: Column, period: int) -> Column:
    """Wilder smoothing, seeded by the mean of the first `period` values."""
    positive("period", period)
    fold = F.aggregate(rest(values, period), head_mean(values, period),
                       lambda e, x: (e * F.lit(period - 1.0) + x) / F.lit(float(period)))
    return F.when(F.size(values) >= period, fold)


def rsi_of(avg_gain: Column, avg_loss: Column) -> Column:
    return (F.when(avg_gain.isNull() | avg_loss.isNull(), F.lit(None))
            .when((avg_gain == 0) & (avg_loss == 0), F.lit(50.0))
            .when(avg_loss == 0, F.lit(100.0))
            .otherwise(F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + F.try_divide(avg_gain, avg_loss))))


def rsi_last(changes: Column, period: int) -> Column:
    """Wilder RSI from the ordered close-to-close changes."""
    gains = F.transform(changes, lambda d: F.greatest(d, F.lit(0.0)))
    losses = F.transform(changes, lambda d: F.greatest(-d, F.lit(0.0)))
    return rsi_of(wilder_last(gains, period), wilder_last(losses, period))


@dataclass(frozen=True)
class Recursion:
    """e = keep * (e before) + share * value, begun by the mean of the first `period` values.

    `skip` rows at the head of a series have no value (the first bar has no change). What is left of
    an old value after n rows is keep ** n; below `negligible` it is not carried on.
    """
    value: Column
    period: int
    share: float
    skip: int = 0
    negligible: float = 1e-30

    @property
    def keep(self) -> float:
        return 1.0 - self.share


def affine_scan(rows: DataFrame, recursions: dict[str, Recursion], series: list[str], order: str) -> DataFrame:
    """Adds the value of every recursion at every row; null before its start.

    A step is the affine map e -> keep * e + x, and maps compose, so the recursion is a prefix scan: in
    pass k each row adds what the row 2 ** k before it has gathered, times keep ** (2 ** k). The start
    is the map that forgets (a constant), which ends the reach of the rows behind it. All recursions
    share each pass, and all passes one exchange and one sort by `series` and `order`; no series is
    gathered into an array or a Python worker.
    """
    line = Window.partitionBy(*series).orderBy(order)
    out = rows.withColumn("_at", F.row_number().over(line))
    first = {}
    for name, r in recursions.items():
        positive("period", r.period)
        start = r.skip + r.period
        head = F.avg(r.value).over(line.rowsBetween(-(r.period - 1), 0))
        first[name] = F.when(F.col("_at") == start, head).when(F.col("_at") > start, r.value * r.share)
    out = out.withColumns(first)
    reach = {name: 1 if r.keep <= 0 else math.ceil(math.log2(max(1.0, math.log(r.negligible) / math.log(r.keep)))) for name, r in recursions.items()}
    for k in range(max(reach.values(), default=0)):
        live = {name: r for name, r in recursions.items() if k < reach[name] and r.keep > 0}
        out = out.withColumns({name: F.col(name) + F.coalesce(F.lag(name, 2 ** k).over(line) * (r.keep ** (2 ** k)), F.lit(0.0)) for name, r in live.items()})
    return out.drop("_at")
