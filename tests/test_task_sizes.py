"""Work of one task: it stays the same when tables grow and sessions name few partitions."""
import pytest
from pyspark.sql import functions as F

from barlab import session

PARTS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
SIZES = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")


def fresh(spark):
    """Settings of another session do not leak into this one's."""
    return spark.newSession()


def test_sizes_are_read_as_settings_write_them():
    assert [session._bytes(s) for s in ("512", "16m", "64MB", "128b", " 1k ", "2g")] == [512, 16 << 20, 64 << 20, 128, 1024, 2 << 30]


def test_exchanges_follow_the_rows_not_the_named_partitions(spark):
    one = session.bound_tasks(fresh(spark))
    one.conf.set("spark.sql.shuffle.partitions", "2")
    one.conf.set(SIZES[1], "64k")
    rows = one.range(0, 200_000, 1, 4).groupBy(F.sha2(F.col("id").cast("string"), 256).alias("k")).agg(F.count("*").alias("n"))
    path = session.scratch_path(one, "sized")
    rows.write.parquet(path)
    assert len(one.read.parquet(path).inputFiles()) > 2
    assert one.read.parquet(path).agg(F.sum("n")).first()[0] == 200_000


def test_finer_settings_stay_and_coarser_ones_do_not(spark):
    one = fresh(spark)
    for key in SIZES:
        one.conf.set(key, "1m")
    one.conf.set(PARTS, "5000")
    session.bound_tasks(one)
    assert [one.conf.get(k) for k in (*SIZES, PARTS)] == ["1m", "1m", "5000"]
    for key in SIZES:
        one.conf.set(key, "1g")
    one.conf.unset(PARTS)
    session.bound_tasks(one)
    assert [one.conf.get(k) for k in (*SIZES, PARTS)] == [str(session.FILE_SPLIT), str(session.EXCHANGE_SPLIT), str(session.EXCHANGE_PARTS)]


def test_registered_queries_run_with_bounded_tasks(spark, monkeypatch):
    from barlab.plans import registry
    monkeypatch.setattr(registry, "QUERIES", {})
    monkeypatch.setattr(registry, "ORACLES", {})
    registry.query("q")(lambda s, sf: s.range(1))
    one = fresh(spark)
    registry.QUERIES["q"](one, "")
    assert one.conf.get(PARTS) == str(session.EXCHANGE_PARTS)


def plans_of(monkeypatch, module):
    """What the module writes down, as plans."""
    seen = []
    kept = module.materialize
    monkeypatch.setattr(module, "materialize", lambda df, *label: (seen.append(df._jdf.queryExecution().toString()), kept(df, *label))[1])
    return seen


@pytest.mark.parametrize("most", [100_000, 0])
def test_medians_do_not_deal_out_all_values_by_a_few_groups(spark, monkeypatch, most):
    from barlab.operators import ranking
    one = fresh(spark)
    one.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    monkeypatch.setattr(ranking, "BROADCAST_GROUPS", most)
    seen = plans_of(monkeypatch, ranking)
    rows = one.range(0, 2001).select(F.when(F.col("id") < 1000, "a").otherwise("b").alias("g"), F.col("id").cast("double").alias("x"))
    got = {r["g"]: r["median_x"] for r in ranking.exact_medians(rows, ["g"], ["x"]).collect()}
    assert got == {"a": 499.5, "b": 1500.0}
    assert any("BroadcastHashJoin" in plan for plan in seen) == bool(most)


@pytest.mark.parametrize("most", [100_000, 0])
def test_stored_rows_are_not_dealt_out_by_their_run(spark, monkeypatch, most):
    from barlab.sources import tables
    one = fresh(spark)
    one.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    monkeypatch.setattr(tables, "BROADCAST_RUNS", most)
    path = session.scratch_path(one, "stored")
    rows = one.createDataFrame([("r1", 1, 1.0), ("r1", 2, 1.0), ("r2", 1, 1.0), (None, 1, 1.0)], "run_id string, k int, v double")
    tables.replace_rows(rows, path, ["run_id", "k"], F.col("v"))
    seen = plans_of(monkeypatch, tables)
    tables.replace_rows(one.createDataFrame([("r1", 2, 5.0), ("r3", 1, 5.0)], rows.schema), path, ["run_id", "k"], F.col("v"))
    got = sorted((str(r["run_id"]), r["k"], r["v"]) for r in one.read.parquet(path).collect())
    assert got == [("None", 1, 1.0), ("r1", 1, 1.0), ("r1", 2, 5.0), ("r2", 1, 1.0), ("r3", 1, 5.0)]
    assert any("BroadcastHashJoin" in plan for plan in seen) == bool(most)


def test_announcements_are_spread_before_they_are_parsed(spark, tmp_path):
    from barlab.plans import q_releases
    one = session.bound_tasks(fresh(spark))
    orders = one.range(0, 4000, 1, 1).select(
        F.col("id").alias("o_orderkey"), F.col("id").alias("o_custkey"), F.lit("F").alias("o_orderstatus"), F.lit("5-LOW").alias("o_orderpriority"),
        F.to_timestamp(F.lit("1995-01-02 00:00:00")).alias("o_orderdate"))
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    plan = q_releases.documents(one, str(tmp_path))
    assert "RebalancePartitions" in plan._jdf.queryExecution().toString() and plan.select("file").distinct().count() == 4000
