import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from barlab.functions.numeric import money2
from barlab.operators import asof, bars, evaluate as E, ranking
from barlab.session import materialize

DAYS = [date(2024, 1, 1) + timedelta(days=i) for i in range(30)]


def scored(spark, n=900, good=True):
    rng = random.Random(4)
    rows = []
    for i in range(n):
        y = rng.random() < 0.5
        p = min(0.99, max(0.01, 0.5 + (0.25 if y else -0.25) * good + rng.uniform(-0.2, 0.2)))
        rows.append((f"S{i % 30}", DAYS[i % 30], i % 5, ["A", "B", "C", "D", None][i % 5], p, int(y), rng.gauss(0, 1), 0.0, 0.5, 0.0))
    df = spark.createDataFrame(rows, "symbol string, trading_date date, fold int, sector string, p double, positive int, forward_return double, predicted double, base_share double, base_return double")
    return E.scored(df.drop("base_share", "base_return"), df.select("fold", "base_share", "base_return").distinct())


def test_auc_over_drawn_dates_counts_rows_as_often_as_their_dates(spark):
    rows = scored(spark, 300)
    draws = {}
    for r in E.date_draws(rows, 3, "s").collect():
        draws.setdefault(r["replicate"], {})[r["trading_date"]] = r["times"]
    assert all(sum(d.values()) == 30 for d in draws.values())
    got = {r["replicate"]: r["estimate"] for r in E.auc_bootstrap(rows, 3, "s", cells=100).collect()}
    data = [(r["trading_date"], int(min(99, r["p"] * 100)), r["positive"]) for r in rows.collect()]
    for k, times in draws.items():
        many = [(c, y) for d, c, y in data for _ in range(times.get(d, 0))]
        ones, zeros = [c for c, y in many if y], [c for c, y in many if not y]
        wins = sum((a > b) + 0.5 * (a == b) for a in ones for b in zeros)
        assert got[k] == pytest.approx(wins / len(ones) / len(zeros))


def test_scores_of_one_cell_keep_their_order(spark, monkeypatch):
    monkeypatch.setattr(E, "SCORE_BLOCK", 7)
    rows = scored(spark, 300).withColumn("p", F.round(0.505 + F.col("p") * 0.004, 5))
    rows = materialize(rows, "rows")
    draws = {}
    for r in E.date_draws(rows, 3, "s").collect():
        draws.setdefault(r["replicate"], {})[r["trading_date"]] = r["times"]
    data = [(r["trading_date"], r["p"], r["positive"]) for r in rows.collect()]
    for r in E.auc_bootstrap(rows, 3, "s", None).collect():
        many = [(p, y) for d, p, y in data for _ in range(draws[r["replicate"]].get(d, 0))]
        ones, zeros = [p for p, y in many if y], [p for p, y in many if not y]
        assert r["estimate"] == pytest.approx(sum((a > b) + 0.5 * (a == b) for a in ones for b in zeros) / len(ones) / len(zeros))
    limits = {"auc": 0.5, "improvement": 0.0, "folds_beaten": 0.7, "calibration_error": 0.5, "concentration": 0.6}
    assert E.evidence_gate(rows, limits, 60, "g", 10, 0.01).filter("criterion = 'auc'").first()["passes"]


def test_replicates_are_not_multiplied_with_the_scores(spark, monkeypatch):
    """No step of the plan holds a row per replicate and score, and places that go on in the next piece are one."""
    monkeypatch.setattr(E, "SCORE_BLOCK", 5)
    rows = materialize(scored(spark, 200).withColumn("p", F.round("p", 1)), "rows")
    out = E.auc_bootstrap(rows, 4, "s")
    assert "place" not in out._jdf.queryExecution().optimizedPlan().toString().partition("MapInArrow")[0]
    often = {(r["replicate"], r["trading_date"]): r["times"] for r in E.date_draws(rows, 4, "s").collect()}
    data = [(r["trading_date"], r["p"], r["positive"]) for r in rows.collect()]
    for r in out.collect():
        cells = [(p, y, often.get((r["replicate"], d), 0)) for d, p, y in data]
        wins = sum(n * m * ((p > q) + 0.5 * (p == q)) for p, y, n in cells if y for q, z, m in cells if not z)
        assert r["estimate"] == pytest.approx(wins / sum(n for _, y, n in cells if y) / sum(n for _, y, n in cells if not y))


def test_gate_passes_skill_and_stops_its_opposite(spark):
    limits = {"auc": 0.5, "improvement": 0.0, "folds_beaten": 0.7, "calibration_error": 0.5, "concentration": 0.6}
    gate = lambda good: {r["criterion"]: r["passes"] for r in E.evidence_gate(scored(spark, good=good), limits, 60, "g", 10, 0.01).collect()}
    assert all(gate(True).values())
    wrong = gate(-1)
    assert not wrong["auc"] and not wrong["improvement"]


def test_rows_with_a_missing_feature_keep_their_place(spark):
    rng = random.Random(1)
    rows = [(float(x), rng.gauss(0, 1), int(x + rng.gauss(0, 1) > 0)) for x in (rng.gauss(0, 1) for _ in range(400))]
    df = spark.createDataFrame(rows, "a double, b double, positive int")
    test = df.limit(3).unionByName(spark.createDataFrame([(None, 1.0, 1), (1.0, None, 0), (None, None, 1)], df.schema))
    out = E.logistic_tier(df, df, test, ["a", "b"], [0.01, 10.0], 100).collect()
    assert len(out) == 6 and sorted(r["p_reason"] for r in out if r["p"] is None) == ["MISSING_FEATURE:a", "MISSING_FEATURE:a,b", "MISSING_FEATURE:b"]
    assert {r["regularization"] for r in out} == {0.01}
    with pytest.raises(E.NotConverged):
        E.logistic_tier(df, df, test, ["a", "b"], [0.01], 1)


def test_a_timeline_without_keys_is_refused(spark):
    with pytest.raises(ValueError):
        asof.in_force(spark.range(1), spark.range(1), [], "id", "id", "id")


def test_two_bars_of_one_day_raise(spark):
    rows = spark.createDataFrame([("A", DAYS[0]), ("A", DAYS[1]), ("B", DAYS[0])], "symbol string, trading_date date")
    assert bars.once_a_day(rows).count() == 3 and len(bars.once_a_day(rows).collect()) == 3
    with pytest.raises(Exception, match="two bars on one day of A"):
        bars.once_a_day(rows.unionByName(rows.limit(1))).collect()


def test_money_is_rounded_once_and_never_aborts(spark):
    numbers = [0.00499999999995, 0.005, 1.005, 2.675, 1e17, 1e300, -0.005, 123456.785, None]
    got = [r["m"] for r in spark.createDataFrame([(i, x) for i, x in enumerate(numbers)], "i int, x double").orderBy("i").select(money2(F.col("x")).cast("string").alias("m")).collect()]
    assert got == ["0.00", "0.01", "1.01", "2.68", None, None, "-0.01", "123456.79", None]


def test_exact_median_of_one_large_group(spark):
    rows = spark.range(200_001).select(F.lit("g").alias("g"), ((F.col("id") * 7919) % 200_003).cast("double").alias("v"))
    values = sorted(float(i * 7919 % 200_003) for i in range(200_001))
    assert ranking.exact_medians(rows, ["g"], ["v"]).first()["median_v"] == values[100_000]


def test_a_tree_takes_the_depth_that_validation_asks_for(spark):
    rng = random.Random(6)
    def rows(n):
        out = []
        for i in range(n):
            a, b = rng.randrange(6), rng.randrange(6)
            y = int(((a > 2) != (b > 2)) != (rng.random() < 0.1))  # one split says nothing
            out.append((f"S{i}", float(a), float(b) if i % 50 else None, y))
        return spark.createDataFrame(out, "symbol string, a double, b double, positive int")
    train, check, test = rows(1500), rows(500), rows(400)
    got = E.tree_tier(train, check, test, ["a", "b"], [1, 3]).collect()
    assert len(got) == 400 and {r["depth"] for r in got} == {3}
    known = [r for r in got if r["p"] is not None]
    assert len(known) == 392 and all(r["p_reason"] == "MISSING_FEATURE:b" for r in got if r["p"] is None)
    assert sum((r["p"] > 0.5) == bool(r["positive"]) for r in known) / len(known) > 0.8
    forest = E.tree_tier(train, check, test, ["a", "b"], [4], trees=8, seed=3).filter("p is not null").collect()
    assert sum((r["p"] > 0.5) == bool(r["positive"]) for r in forest) / len(forest) > 0.75


def test_a_tier_waits_for_the_gate_before_it(spark):
    limits = {"auc": 0.5, "improvement": 0.0, "folds_beaten": 0.7, "calibration_error": 0.5, "concentration": 0.6}
    E.require_gate(E.evidence_gate(scored(spark), limits, 60, "g", 10, 0.01))
    wrong = materialize(E.evidence_gate(scored(spark, good=-1), limits, 60, "g", 10, 0.01), "gate")
    for gate in (wrong, wrong.limit(0)):
        with pytest.raises(E.TierNotAllowed):
            E.require_gate(gate)
