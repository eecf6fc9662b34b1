from pathlib import Path

from pyspark.sql import functions as F

from barlab import session


def test_shared_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert session.shared_dir(spark) == named.rstrip("/")
    kept = session.materialize(spark.range(10).withColumn("x", F.col("id") * 2))
    assert kept.inputFiles()[0].replace("file:", "").lstrip("/").startswith(named.lstrip("/"))
    assert kept.agg(F.sum("x")).first()[0] == 90


def test_scratch_tables_are_deleted_with_their_session(spark, monkeypatch):
    monkeypatch.setattr(session, "_OWNED", {})
    path = session.materialize(spark.range(3)).inputFiles()[0].replace("file://", "")
    assert Path(path).exists() and session.clear_scratch(spark) == 1 and not Path(path).exists()
