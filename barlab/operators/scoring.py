"""Band scoring with the caller's tables. There are no default bands, cutoffs or limits."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Band:
    """Half-open [low, high); None leaves a side open."""
    low: float | None
    high: float | None
    points: int


def points(value: Column, bands: list[Band]) -> Column:
    """Points of a value; null in, null out, and null outside every band (SC1)."""
    if not bands:
        raise ValueError("a band table must be supplied")
    out = None
    for band in bands:
        hit = value.isNotNull()
        if band.low is not None:
            hit = hit & (value >= band.low)
        if band.high is not None:
            hit = hit & (value < band.high)
        out = F.when(hit, band.points) if out is None else out.when(hit, band.points)
    return out


def composite(rows: DataFrame, components: list[str]) -> DataFrame:
    """Exact sum; null as soon as one component is null (SC2)."""
    total = F.col(components[0])
    for name in components[1:]:
        total = total + F.col(name)
    return rows.withColumn("composite", total)


def shortlist(rows: DataFrame, cutoff: float, k: int) -> DataFrame:
    """The k best of those at or above the cutoff, ties by symbol (SC3)."""
    return rows.filter(F.col("composite") >= cutoff).orderBy(F.desc("composite"), F.asc("symbol")).limit(k)


def histogram(rows: DataFrame) -> DataFrame:
    return rows.filter("composite is not null").groupBy("composite").agg(F.count(F.lit(1)).alias("n"))


def cutoff_sweep(rows: DataFrame, cutoffs: list[float]) -> DataFrame:
    """Candidates at every cutoff, in one pass (SC4)."""
    one = rows.agg(*[F.count_if(F.col("composite") >= c).alias(f"c{i}") for i, c in enumerate(cutoffs)])
    pairs = F.array(*[F.struct(F.lit(float(c)).alias("cutoff"), F.col(f"c{i}").alias("candidates")) for i, c in enumerate(cutoffs)])
    return one.select(F.explode(pairs).alias("x")).select("x.*")
