"""Stored tables: per-run replacement, append-only snapshots, exports with a manifest."""
from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from barlab.operators.bars import latest_copy
from barlab.session import materialize, small

BROADCAST_RUNS = 100_000  # names of runs; more are joined by shuffle


class AlreadyStored(ValueError):
    """A row whose key is held already, or twice in one batch."""


def held_table(spark: SparkSession, schema: StructType | str, path: str) -> DataFrame | None:
    """A stored table, or None where nothing has been stored yet."""
    try:
        found = spark.read.schema(schema).parquet(path)
        found.schema  # a remote session looks for the path only now
        return found
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def replace_rows(rows: DataFrame, path: str, key: list[str], order: Column) -> None:
    """Insert-or-replace on the key, rewriting only the run partitions that are touched (SNK1).

    `key` starts with run_id. Writing the same rows again leaves the same table.
    """
    spark = rows.sparkSession
    merged = latest_copy(rows, key, order).withColumn("_new", F.lit(1))
    held = held_table(spark, rows.schema, path)
    if held is not None:
        runs = materialize(rows.select("run_id").distinct(), "runs")
        touched = held.join(small(runs, BROADCAST_RUNS), "run_id", "left_semi")
        both = merged.unionByName(touched.withColumn("_new", F.lit(0)))
        # the table is read and rewritten, so the merged rows are put down first
        merged = materialize(latest_copy(both, key, F.col("_new")))
    # balanced by size: a run of any size is written by as many tasks as it needs
    (merged.drop("_new").hint("rebalance", "run_id")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path))


def refused(incoming: DataFrame, held: DataFrame | None, key: list[str]) -> DataFrame:
    """Keys that an append-only table refuses: twice in the batch, or stored before (SNK2)."""
    twice = incoming.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*key, F.lit("TWICE_IN_BATCH").alias("why"))
    if held is None:
        return twice
    stored = incoming.select(*key).distinct().join(held.select(*key), key, "left_semi").withColumn("why", F.lit("ALREADY_STORED"))
    return twice.unionByName(stored)


def append_snapshots(incoming: DataFrame, path: str, key: list[str]) -> None:
    """Append a batch, or nothing at all when any key is refused (SNK2)."""
    spark = incoming.sparkSession
    batch = materialize(incoming)
    held = held_table(spark, batch.schema, path)
    if not refused(batch, held, key).isEmpty():
        raise AlreadyStored(f"{path}: some keys {key} are stored already or repeated")
    batch.write.mode("append").parquet(path)


def row_digest(rows: DataFrame) -> Column:
    parts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in sorted(rows.columns)]
    return F.sha2(F.concat_ws("|", *parts), 256)


def manifest(rows: DataFrame, label: str) -> DataFrame:
    """One row: count and a checksum of the content that does not depend on row order (SNK3).

    Each row's digest is cut to 60 bits and summed, so the checksum is a partial aggregate.
    """
    bits = F.conv(F.substring(row_digest(rows), 1, 15), 16, 10).cast("decimal(38,0)")
    return rows.select(bits.alias("b")).agg(
        F.lit(label).alias("label"), F.count(F.lit(1)).alias("rows"), F.sum("b").cast("string").alias("checksum"))


def export(rows: DataFrame, path: str, label: str, kind: str = "parquet") -> DataFrame:
    """Write a table and, beside it, its manifest computed from what was written (SNK3)."""
    spark = rows.sparkSession
    writer = rows.write.mode("overwrite")
    (writer.option("header", True).csv(f"{path}/data") if kind == "csv" else writer.parquet(f"{path}/data"))
    back = spark.read.schema(rows.schema)
    back = back.option("header", True).csv(f"{path}/data") if kind == "csv" else back.parquet(f"{path}/data")
    manifest(back, label).write.mode("overwrite").json(f"{path}/manifest")
    return spark.read.schema("label string, rows bigint, checksum string").json(f"{path}/manifest")
