"""Append-only storage of numbered batches, with what was refused as a second output."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DataType, LongType, StringType, StructField, StructType

from barlab.session import materialize
from barlab.sources.tables import held_table, refused


def _with(schema: StructType, **more: DataType) -> StructType:
    return StructType([*schema.fields, *[StructField(name, kind) for name, kind in more.items()]])


class BatchLedger:
    """Snapshots under a unique key, stored batch by batch (SNK2, ST2).

    A key that is stored already, or comes twice in a batch, is refused with the reason; the other
    rows of the batch are stored. Rows and refused keys of a batch go to partitions of its number,
    its line in the ledger follows last. A batch whose line is there is not stored again; one that was
    interrupted before is stored over, judged against the other batches only. Either way a replay
    changes nothing, and only batches with a line are read.
    """

    def __init__(self, path: str, key: list[str]):
        self.key = key
        self.rows_path, self.refused_path, self.lines_path = (f"{path}/{name}" for name in ("rows", "refused", "ledger"))

    def lines(self, spark: SparkSession) -> DataFrame:
        """batch, stored, refused: one row per batch that was taken."""
        schema = "batch bigint, stored bigint, refused bigint"
        found = held_table(spark, schema, self.lines_path)
        return spark.createDataFrame([], schema) if found is None else found

    def store(self, batch: DataFrame, number: int) -> bool:
        """Store a batch under its number; False if it was stored before."""
        spark = batch.sparkSession
        if not self.lines(spark).filter(F.col("batch") == number).isEmpty():
            return False
        rows = materialize(batch, "batch")
        held = self.stored(spark, rows.schema)
        turned_down = materialize(refused(rows, held, self.key), "refused")
        taken = rows.join(turned_down.select(*self.key).distinct(), self.key, "left_anti").select(*rows.columns)
        self._put(taken, self.rows_path, number)
        self._put(turned_down, self.refused_path, number)
        kept = held_table(spark, _with(taken.schema, batch=LongType()), self.rows_path)
        counts = spark.range(1).select(
            F.lit(number).cast("bigint").alias("batch"),
            (F.lit(0).cast("bigint") if kept is None else kept.filter(F.col("batch") == number).agg(F.count(F.lit(1))).scalar()).alias("stored"),
            turned_down.agg(F.count(F.lit(1))).scalar().alias("refused"))
        counts.write.mode("append").parquet(self.lines_path)
        return True

    @staticmethod
    def _put(rows: DataFrame, path: str, number: int) -> None:
        rows.withColumn("batch", F.lit(number).cast("bigint")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)

    def _read(self, spark: SparkSession, schema, path: str) -> DataFrame | None:
        found = held_table(spark, schema, path)
        return None if found is None else found.join(F.broadcast(self.lines(spark).select("batch").distinct()), "batch", "left_semi")  # one line a batch

    def stored(self, spark: SparkSession, schema) -> DataFrame | None:
        """The rows of all batches taken, with their batch; None before the first."""
        return self._read(spark, _with(schema, batch=LongType()), self.rows_path)

    def refused(self, spark: SparkSession, schema) -> DataFrame | None:
        """Refused keys with the reason and their batch."""
        wanted = _with(StructType([schema[c] for c in self.key]), why=StringType(), batch=LongType())
        return self._read(spark, wanted, self.refused_path)

    def writer(self) -> Callable[[DataFrame, int], None]:
        """For foreachBatch."""
        return lambda batch, number: self.store(batch, number) and None
