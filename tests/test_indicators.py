import random

import pytest
from pyspark.sql import functions as F

from barlab.config import IndicatorParams
from barlab.operators import bars as B
from barlab.operators import features as FT
from barlab.operators import indicators as I
from barlab.operators import pointintime as PT
from helpers import BAR_SCHEMA, bar_rows, rows_by, weekdays

P = IndicatorParams(20, 50, 200, 14, 10, 60, 20, 252, 14, 252, 15, 20, 0.5, 2.0)


def table(spark, *series):
    return spark.createDataFrame([r for s in series for r in s], BAR_SCHEMA)


def flat_benchmark(spark, n=400):
    return spark.createDataFrame([(d, 100.0 + i) for i, d in enumerate(weekdays(n))], "trading_date date, close double")


def loop_ema(closes, p):
    e = sum(closes[:p]) / p
    for c in closes[p:]:
        e = 2 / (p + 1) * c + (1 - 2 / (p + 1)) * e
    return e


def loop_wilder(values, p):
    e = sum(values[:p]) / p
    for v in values[p:]:
        e = (e * (p - 1) + v) / p
    return e


def test_folds_equal_plain_loops(spark):
    rng = random.Random(3)
    closes = [100.0]
    for _ in range(120):
        closes.append(round(closes[-1] * rng.uniform(0.97, 1.03), 4))
    bars = table(spark, bar_rows("A", closes), bar_rows("SHORT", closes[:10]))
    ema = rows_by(I.ema_latest(bars, 20))
    assert ema["A"]["ema"] == pytest.approx(loop_ema(closes, 20), abs=1e-9)
    assert ema["SHORT"]["ema"] is None
    steps = [b - a for a, b in zip(closes, closes[1:])]
    gain, loss = loop_wilder([max(s, 0) for s in steps], 14), loop_wilder([max(-s, 0) for s in steps], 14)
    rsi = rows_by(I.rsi_latest(bars, 14))
    assert rsi["A"]["rsi"] == pytest.approx(100 - 100 / (1 + gain / loss), abs=1e-9)
    assert rsi["SHORT"]["rsi"] is None
    tr = [max(2.0, abs(b + 1 - a), abs(b - 1 - a)) for a, b in zip(closes, closes[1:])]
    atr = rows_by(I.atr_latest(bars, 14))
    assert atr["A"]["atr"] == pytest.approx(loop_wilder(tr, 14), abs=1e-9)


def test_rsi_without_losses_or_moves(spark):
    bars = table(spark, bar_rows("UP", range(10, 40)), bar_rows("FLAT", [5.0] * 30))
    rsi = rows_by(I.rsi_latest(bars, 14))
    assert rsi["UP"]["rsi"] == 100.0 and rsi["FLAT"]["rsi"] == 50.0


def test_window_indicators(spark):
    bars = table(spark, bar_rows("A", [100.0] * 10 + [110.0]))
    last = bars.select("trading_date", I.roc(F.col("close"), 10).alias("roc")).orderBy(F.desc("trading_date")).first()
    assert last["roc"] == pytest.approx(10.0)
    highs = spark.createDataFrame([("A", d, h) for d, h in zip(weekdays(4), [1.0, 2.0, 3.0, 100.0])], "symbol string, trading_date date, high double")
    got = I.with_rolling_extreme(I.with_rolling_extreme(highs, "high", 3, "i"), "high", 3, "x", exclude_current=True)
    got = got.orderBy(F.desc("trading_date")).first()
    assert (got["x"], got["i"]) == (3.0, 100.0)
    d = spark.createDataFrame([(90.0, 100.0), (1.0, 0.0), (1.0, None)], "c double, h double")
    assert [r[0] for r in d.select(I.distance_from_high(F.col("c"), F.col("h"))).collect()] == [10.0, None, None]
    v = spark.createDataFrame([("A", d, x) for d, x in zip(weekdays(3), [10.0, 10.0, 20.0])] +
                              [("N", d, x) for d, x in zip(weekdays(3), [10.0, None, 20.0])] +
                              [("Z", d, 0.0) for d in weekdays(3)], "symbol string, trading_date date, volume double")
    got = v.select("symbol", "trading_date", I.relative_volume(F.col("volume"), 2).alias("r")).filter(F.col("trading_date") == weekdays(3)[-1])
    assert {r["symbol"]: r["r"] for r in got.collect()} == {"A": 2.0, "N": None, "Z": None}


def test_rolling_extremes_equal_sliding_ones(spark):
    rng = random.Random(8)
    values = [rng.choice([None, rng.random()]) if i % 9 == 0 else rng.random() for i in range(57)]
    rows = spark.createDataFrame([("A", d, v) for d, v in zip(weekdays(57), values)], "symbol string, trading_date date, v double")
    for n in (1, 2, 5, 20, 57, 58):
        got = I.with_rolling_extreme(I.with_rolling_extreme(rows, "v", n, "hi"), "v", n, "lo", lowest=True).orderBy("trading_date").collect()
        for i, r in enumerate(got):
            held = [v for v in values[i - n + 1:i + 1] if v is not None] if i >= n - 1 else []
            assert (r["hi"], r["lo"]) == ((max(held), min(held)) if held else (None, None))


def test_relative_return(spark):
    r = spark.createDataFrame([(100.0, 110.0, 100.0, 105.0), (0.0, 1.0, 1.0, 1.0)], "a double, b double, c double, d double")
    got = [x[0] for x in r.select(I.relative_return(*[F.col(c) for c in "abcd"])).collect()]
    assert got[0] == pytest.approx(5.0) and got[1] is None


def test_break_thresholds_are_strict(spark):
    bars = table(spark, bar_rows("E", [100, 50, 100]), bar_rows("B", [100, 49, 100, 210, 211]))
    got = rows_by(B.last_breaks(bars, 0.5, 2.0))
    assert got["E"]["break_date"] is None
    assert got["B"]["break_date"] == weekdays(5)[3] and got["B"]["break_ratio"] == pytest.approx(2.1) and got["B"]["n_bars"] == 2


def test_feature_rows(spark):
    bars = table(spark, bar_rows("SPLIT", [100.0] * 100 + [30.0] * 152), bar_rows("OLD", [100.0] * 10 + [30.0] * 260),
                 bar_rows("NOVOL", [100.0] * 260, [0.0] * 260), bar_rows("BAD", [100.0] * 5 + [0.0]))
    got = rows_by(FT.compute_features(bars, flat_benchmark(spark), P))
    split, old, novol, bad = got["SPLIT"], got["OLD"], got["NOVOL"], got["BAD"]
    assert (split["status"], split["n_bars"]) == ("INSUFFICIENT_HISTORY", 152)
    assert split["ema_long"] is None and split["ema_short"] is not None
    assert split["reason"] == ("152 post-break bars; 252 required; possible corporate-action break at bar index 100, "
                               "close ratio 0.3000")
    assert old["status"] == "VALID" and "break" in old["reason"] and old["break_ratio"] == pytest.approx(0.3)
    assert novol["relative_volume"] is None and novol["volume_usable"] is False
    assert bad["status"] == "FAILED" and bad["rsi"] is None and bad["n_bars"] == 6
    assert bad["reason"] == "2 non-positive or missing price value(s)"


def test_stale_and_missing_symbols(spark):
    bars = table(spark, bar_rows("NEW", [10.0] * 300), bar_rows("LATE", [10.0] * 260))
    universe = spark.createDataFrame([("NEW",), ("LATE",), ("NONE",), ("FEW",)], "symbol string")
    acquired = spark.createDataFrame([("FEW", "INSUFFICIENT_HISTORY", "9 observations; 252 required")], "symbol string, status string, reason string")
    scan = FT.feature_scan(universe, bars, flat_benchmark(spark), acquired, P)
    got = rows_by(scan)
    assert got["LATE"]["status"] == "STALE" and got["LATE"]["reason"].startswith("last observation ")
    assert got["NONE"]["status"] == "FAILED" and got["NONE"]["reason"] == "acquisition MISSING"
    assert got["FEW"]["status"] == "INSUFFICIENT_HISTORY"
    assert FT.coverage(universe, scan).first()["complete"]


def test_features_every_bar_do_not_look_ahead(spark):
    rng = random.Random(5)
    closes = [50.0]
    for i in range(80):
        closes.append(round(closes[-1] * (2.5 if i == 40 else rng.uniform(0.95, 1.05)), 4))
    rows = bar_rows("A", closes)
    p = PT.PointInTimeParams((3, 5, 8), 2, 4, 4, (1, 3), 6, 5, 4, (2,), 0.5, 2.0)
    bench = flat_benchmark(spark, 100)
    full = {r["trading_date"]: r for r in PT.features_v1(table(spark, rows), bench, p).collect()}
    cut = PT.features_v1(table(spark, rows[:60]), bench, p).collect()
    assert len(cut) == 60
    for r in cut:
        other = full[r["trading_date"]]
        for name in r.asDict():
            assert r[name] == other[name] or r[name] == pytest.approx(other[name], abs=1e-12)
    at_break = full[rows[41][1]]
    assert at_break["return_1"] is None and at_break["ema_short"] is None
    third = full[rows[44][1]]
    assert third["ema_short"] == pytest.approx(sum(closes[42:45]) / 3)
    assert full[rows[60][1]]["ema_medium"] == pytest.approx(loop_ema(closes[42:61], 5))


def test_one_hot_symbol_keeps_one_bar_per_day(spark):
    rows = [("HOT", weekdays(3)[i % 3], 1.0, 2.0, 0.5, float(i), 10.0) for i in range(3000)] + bar_rows("COLD", [5.0])
    got = B.one_per_day(spark.createDataFrame(rows, BAR_SCHEMA))
    assert got.count() == 4 and got.filter("symbol = 'HOT'").agg(F.max("close")).first()[0] == 2999.0


def test_prefix_scan_equals_the_loop(spark):
    """Seeds, periods of one, a skipped head, series of every length, and one longer than all old values reach."""
    from barlab.functions.folds import Recursion, affine_scan
    rng = random.Random(12)
    data = {f"s{n}": [rng.uniform(0, 100) for _ in range(n)] for n in (1, 2, 4, 5, 6, 17, 300, 1500)}
    rows = [(s, i, v) for s, values in data.items() for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "s string, i int, v double")
    asked = {"one": Recursion(F.col("v"), 1, 1.0), "short": Recursion(F.col("v"), 5, 2 / 6), "wilder": Recursion(F.col("v"), 14, 1 / 14, skip=1, negligible=1e-300),
             "slow": Recursion(F.col("v"), 200, 2 / 201)}
    got = {}
    for r in affine_scan(df, asked, ["s"], "i").collect():
        got.setdefault(r["s"], {})[r["i"]] = r
    for s, values in data.items():
        for name, r in asked.items():
            e = None
            for i, v in enumerate(values):
                start = r.skip + r.period - 1
                e = None if i < start else sum(values[r.skip:start + 1]) / r.period if i == start else r.keep * e + r.share * v
                found = got[s][i][name]
                assert (found is None) == (e is None) and (e is None or found == pytest.approx(e, rel=1e-9)), (s, name, i)
