"""Session settings and the one place that decides where shared files go."""
from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F


# A union of co-partitioned inputs may lose its partitioning while a plan is adapted at run
# time, after its consumer was planned without an exchange; unions are kept plain instead.
PLAIN_UNIONS = ("spark.sql.unionOutputPartitioning", "false")


# What one task takes on, so that its memory does not grow with the tables: bytes of files it reads and of an
# exchange. Exchanges are cut into many small parts, which the adaptive planner puts together up to that size.
FILE_SPLIT, EXCHANGE_SPLIT, EXCHANGE_PARTS = 16 << 20, 8 << 20, 2000


def prepare(spark: SparkSession) -> SparkSession:
    """Settings that the jobs rely on, for a session made elsewhere."""
    spark.conf.set(*PLAIN_UNIONS)
    return spark


def bound_tasks(spark: SparkSession) -> SparkSession:
    """The same amount of work for a task whatever the size of the tables; finer settings of the session stay."""
    for key, most in (("spark.sql.files.maxPartitionBytes", FILE_SPLIT), ("spark.sql.adaptive.advisoryPartitionSizeInBytes", EXCHANGE_SPLIT)):
        if _bytes(spark.conf.get(key)) > most:
            spark.conf.set(key, str(most))
    parts = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    if int(spark.conf.get(parts, None) or spark.conf.get("spark.sql.shuffle.partitions")) < EXCHANGE_PARTS:
        spark.conf.set(parts, str(EXCHANGE_PARTS))
    return spark


def _bytes(size: str) -> int:
    """Bytes of a size as settings name it: 16m, 64MB, 134217728b."""
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)b?", size.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def build_session(app: str = "barlab", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in spark.checkpoint.dir.

    Only a local master may fall back to a temporary folder: there the driver and its tasks
    share one machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    made = tempfile.mkdtemp(prefix="barlab-")
    spark.sparkContext.setCheckpointDir(made)
    return made


# Paths handed out, by application; the session owns them until it clears them or ends.
_OWNED: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder for one written table or one stream."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    app = spark.sparkContext.applicationId
    if app not in _OWNED:
        _OWNED[app] = []
        atexit.register(clear_scratch, spark)
    _OWNED[app].append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Delete the intermediate tables of this session, when a study or the session ends; says how
    many paths there were. Results that are still to be read must be written or collected before."""
    try:
        paths = _OWNED.pop(spark.sparkContext.applicationId, [])
        for path in paths:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
        return len(paths)
    except Exception:  # the engine is gone already
        return 0


def materialize(df: DataFrame, label: str = "kept") -> DataFrame:
    """Write the rows once into the shared folder and go on from there.

    Cuts the lineage: a lost executor neither changes the rows nor repeats the work. A table,
    unlike a checkpointed plan, is read back column by column.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(written: DataFrame, most: int) -> DataFrame:
    """A written table, to be broadcast if it holds `most` rows at most: rows of the other side, of which one key may
    hold most, then stay where they are."""
    return F.broadcast(written) if written.limit(most + 1).count() <= most else written
