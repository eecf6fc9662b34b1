import hashlib
import random
import statistics

import pytest
from pyspark.sql import functions as F

from barlab.operators import evaluate as E
from barlab.operators import ranking as R


def test_positions_of_a_skewed_key(spark):
    rng = random.Random(1)
    rows = [("hot" if rng.random() < 0.5 else f"k{rng.randrange(30)}", rng.randrange(50), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, v int, id int").repartition(7)
    got = {r["id"]: r["position"] for r in R.positions(df, [F.asc("v"), F.asc("id")]).collect()}
    for place, row in enumerate(sorted(rows, key=lambda r: (r[1], r[2]))):
        assert got[row[2]] == place
    inside = {r["id"]: (r["position"], r["group_size"]) for r in R.group_positions(df, ["g"], [F.asc("v"), F.asc("id")]).collect()}
    hot = sorted((r for r in rows if r[0] == "hot"), key=lambda r: (r[1], r[2]))
    assert [inside[r[2]] for r in hot] == [(i, len(hot)) for i in range(len(hot))]


def test_average_ranks(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(2), rng.randrange(40)) for _ in range(800)]
    df = spark.createDataFrame(rows, "g int, v int")
    got = {(r["g"], r["v"]): r["rank"] for r in R.average_ranks(df, ["g"], "v", "rank").distinct().collect()}
    for g in (0, 1):
        ordered = sorted(v for k, v in rows if k == g)
        for v in set(ordered):
            places = [i + 1 for i, x in enumerate(ordered) if x == v]
            assert got[(g, v)] == pytest.approx(sum(places) / len(places))


@pytest.mark.parametrize("values", [
    [1.0], [1.0, 2.0], [3.0, 1.0, 2.0], [5.0] * 9, [None, 4.0], [float(i % 7) for i in range(1000)],
    [0.0] * 700 + [float(i) for i in range(300)], [float(i * i) for i in range(25001)]])
def test_exact_median(spark, values):
    rows = [("a", v) for v in values] + [("b", 1.0), ("c", None)]
    got = {r["g"]: r["median_v"] for r in R.exact_medians(spark.createDataFrame(rows, "g string, v double"), ["g"], ["v"]).collect()}
    assert got["a"] == round(statistics.median([v for v in values if v is not None]), 4)
    assert got["b"] == 1.0 and "c" not in got


def test_stratified_sample_and_bins(spark):
    rows = [(f"g{i % 3}", f"id{i}") for i in range(50)]
    got = R.stratified_sample(spark.createDataFrame(rows, "g string, id string"), "g", "id", "s", 7).collect()
    ordered = sorted(rows, key=lambda r: (r[0], hashlib.sha256(("s" + r[1]).encode()).hexdigest()))
    assert {r["id"] for r in got} == {ordered[int(i * (50 / 7))][1] for i in range(7)}
    assert R.stratified_sample(spark.createDataFrame(rows[:4], "g string, id string"), "g", "id", "s", 7).count() == 4
    bins = R.decile_bins(spark.range(23).select("id"), [F.asc("id")]).collect()
    assert {r["id"]: r["bin"] for r in bins} == {j: j * 10 // 23 for j in range(23)}


def test_auc_and_losses(spark):
    rng = random.Random(4)
    rows = [(0, round(rng.random(), 2), int(rng.random() < 0.4)) for _ in range(300)]
    got = E.auc(spark.createDataFrame(rows, "fold int, p double, positive int"), ["fold"]).first()["auc"]
    pos, neg = [r[1] for r in rows if r[2]], [r[1] for r in rows if not r[2]]
    assert got == pytest.approx(sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg)))
    worst = spark.createDataFrame([(1.0, 0)], "p double, y int").select(E.log_loss(F.col("p"), F.col("y"))).first()[0]
    assert worst == pytest.approx(13.815510, abs=1e-5)
    flat = spark.createDataFrame([("X", 1, 0.0)], "sector string, fold int, improvement double")
    assert {(r["share"], r["passes"]) for r in E.concentration(flat, 0.5, 1, 0.0).collect()} == {(None, False)}
