"""Reference files: universe, reviews, instrument master, holidays, resolutions."""
from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from barlab import schemas
from barlab.functions.text import strip


class SourceError(ValueError):
    """An input file that must not be read as if it were valid."""


def _csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A CSV with a header holding at least the schema's columns. A header alone is valid.

    Of several files every header is checked against the first; another order of columns is an
    error instead of a shifted table. Fields may hold line breaks, so a file is one task: these
    are reference lists of at most some thousand rows.
    """
    rows = spark.read.option("header", True).option("escape", '"').option("multiLine", True).option("enforceSchema", False).csv(path)
    missing = [n for n in schema.names if n not in [c.lstrip("﻿") for c in rows.columns]]
    if missing:
        raise SourceError(f"{path} lacks required column(s): {missing}")
    rows = rows.toDF(*[c.lstrip("﻿") for c in rows.columns])
    return rows.select(*[strip(F.coalesce(F.col(f"`{n}`"), F.lit(""))).alias(n) for n in schema.names])


def read_universe(spark: SparkSession, path: str) -> DataFrame:
    """Constituents, upper-cased, with a number that keeps the order of the file (SRC1)."""
    rows = _csv(spark, path, schemas.UNIVERSE_CSV)
    return rows.select(F.upper("Symbol").alias("symbol"), F.col("Company Name").alias("company_name"),
                       F.col("Industry").alias("sector"), F.upper("Series").alias("series"),
                       F.upper("ISIN Code").alias("isin"), F.monotonically_increasing_id().alias("source_order"))


def read_scan_universe(spark: SparkSession, path: str) -> DataFrame:
    """Constituents as written, with the mark of a series other than EQ (SRC2)."""
    rows = _csv(spark, path, schemas.UNIVERSE_CSV)
    return rows.select(F.col("Symbol").alias("symbol"), F.col("Company Name").alias("company_name"),
                       F.col("Industry").alias("sector"), F.col("Series").alias("series"),
                       F.col("ISIN Code").alias("isin"), (F.col("Series") != "EQ").alias("non_eq_series"))


def read_instrument_master(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array per file, gzip or plain; another root or broken JSON is an error. source_order
    keeps the order of a file's rows (SRC3)."""
    opening = spark.read.text(path, wholetext=True).select(F.substring(F.ltrim("value"), 1, 1).alias("c"))
    if not opening.filter("c <> '['").isEmpty():
        raise SourceError(f"{path}: the instrument master must be a JSON array")
    rows = (spark.read.schema(schemas.INSTRUMENT).option("multiLine", True).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt").json(path))
    broken = F.when(F.col("_corrupt").isNotNull(), F.raise_error(F.lit("broken instrument master")).cast("string"))
    return rows.withColumn("segment", F.coalesce(broken, "segment")).drop("_corrupt").withColumn("source_order", F.monotonically_increasing_id())


def read_reviews(spark: SparkSession, path: str) -> DataFrame:
    """The corporate-action review list; a missing file or column is an error (SRC4)."""
    return _csv(spark, path, schemas.REVIEW_CSV).withColumn("effective_date", F.expr("try_cast(effective_date as date)"))


def read_holidays(spark: SparkSession, path: str, wanted: Iterable[int] = ()) -> DataFrame:
    """Exchange holidays, one JSON per year; a year without entries is an error, and so is one
    of the wanted years of which no file holds a date. Of several entries for a date the last
    one wins (SRC5)."""
    years = (spark.read.schema(schemas.HOLIDAY_MASTER).option("multiLine", True)
             .option("columnNameOfCorruptRecord", "_corrupt").json(path)
             .withColumn("file", F.col("_metadata.file_path")))
    empty = F.col("_corrupt").isNotNull() | F.col("CM").isNull() | (F.size("CM") == 0)
    checked = years.withColumn("CM", F.when(empty, F.raise_error(F.concat(F.lit("no holiday entries in "), F.col("file")))
                                            .cast(schemas.HOLIDAY_MASTER["CM"].dataType)).otherwise(F.col("CM")))
    rows = checked.select("file", F.posexplode("CM").alias("place", "e"))
    found = (rows.select(F.to_date("e.tradingDate", "dd-MMM-yyyy").alias("date"), strip(F.col("e.description")).alias("description"), "file", "place")
             .groupBy("date").agg(F.max_by("description", F.struct("file", "place")).alias("description")))
    if wanted := set(wanted):  # one row per year
        missing = wanted - {r["y"] for r in found.select(F.year("date").alias("y")).distinct().collect()}
        if missing:
            raise SourceError(f"{path} has no holidays of {sorted(missing)}")
    return found


def resolution_violations(resolutions: DataFrame) -> DataFrame:
    """Dates ruled on twice, unknown statuses, rulings without a citation (SRC6)."""
    bad = ~F.col("status").isin("SESSION", "CLOSED") | (F.col("circulars") == "")
    return resolutions.groupBy("date").agg(F.count(F.lit(1)).alias("n"), F.bool_or(bad).alias("bad")) \
        .filter((F.col("n") > 1) | F.col("bad")).select("date", "n", "bad")


def read_resolutions(spark: SparkSession, path: str) -> DataFrame:
    rows = _csv(spark, path, schemas.RESOLUTION_CSV).withColumn("date", F.to_date("date"))
    if not resolution_violations(rows).isEmpty():
        raise SourceError(f"{path} holds duplicate or uncited resolutions")
    return rows


def fingerprints(spark: SparkSession, path: str) -> DataFrame:
    """SHA-256 of every input file, its version id (SRC7)."""
    return spark.read.format("binaryFile").load(path).select(
        F.element_at(F.split("path", "/"), -1).alias("file"), F.col("path"), F.sha2("content", 256).alias("version"))


def newest_by_name(spark: SparkSession, path: str) -> str:
    """The newest of dated input files, by name (SRC8). Only names are read."""
    row = spark.read.format("binaryFile").load(path).select("path").agg(F.max("path").alias("p")).first()
    if row is None or row["p"] is None:
        raise SourceError(f"no file matches {path}")
    return row["p"]
