import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from barlab.operators import calendar as K
from barlab.operators import dataset as DS
from barlab.operators import sessions as SS

DAYS = [d for i in range(220) if (d := date(2021, 1, 1) + timedelta(days=i)).weekday() < 5 and i % 11]


@pytest.fixture(scope="module")
def index(spark):
    return SS.session_index(spark.createDataFrame([(d,) for d in DAYS + DAYS[:5]], "trading_date date"))


def test_ranks_of_days_in_and_out_of_the_calendar(spark, index):
    ask = [DAYS[0] - timedelta(days=400), DAYS[0], date(2021, 1, 23), DAYS[-1], DAYS[-1] + timedelta(days=9), None]
    got = {r["d"]: (r["_first"], r["_last"]) for r in SS.ranked(spark.createDataFrame([(d,) for d in ask], "d date"), "d", SS.day_ranks(index)).collect()}
    assert got == {d: (sum(x < d for x in DAYS), sum(x <= d for x in DAYS) - 1) for d in ask if d}


def test_words_hold_and_lack(spark, index):
    rng = random.Random(2)
    held = {"none": [], "all": DAYS, "some": rng.sample(DAYS, 70), "edge": [DAYS[0], DAYS[63], DAYS[64], DAYS[-1], date(2021, 1, 2)]}
    rows = spark.createDataFrame([(k, d) for k, ds in held.items() for d in list(ds) * 2], "symbol string, trading_date date")
    names = spark.createDataFrame([(k,) for k in held], "symbol string")
    both = SS.compared_words(names, ["symbol"], SS.words(rows, ["symbol"], index), index)
    for bits, want in (("_held", lambda k: set(held[k]) & set(DAYS)), ("_lacking", lambda k: set(DAYS) - set(held[k]))):
        got = {k: [] for k in held}
        for r in SS.listed(both, bits, index).collect():
            got[r["symbol"]].append(r["trading_date"])
        assert {k: sorted(v) for k, v in got.items()} == {k: sorted(want(k)) for k in held}


def test_no_session_at_all(spark):
    none = SS.session_index(spark.createDataFrame([], "trading_date date"))
    rows = spark.createDataFrame([("A", DAYS[0]), ("B", None)], "symbol string, trading_date date")
    assert SS.ranked(rows, "trading_date", SS.day_ranks(none)).count() == 0
    assert [(r["symbol"], r["available"], r["missing"]) for r in K.missing_sessions(rows, none.select("trading_date")).orderBy("symbol").collect()] == [("A", 0, None), ("B", 0, None)]


def test_running_marks_tell_the_affected_sessions(spark, index):
    rng = random.Random(5)
    events = [(f"S{rng.randrange(4)}", DAYS[0] + timedelta(days=rng.randrange(-60, 280))) for _ in range(25)] + [("S0", DAYS[3])] * 3
    df = spark.createDataFrame(events, "symbol string, date date")
    for before, after in ((0, 0), (5, 2), (30, 7)):
        marks = {}
        for r in DS.sweep_marks(df, index, SS.day_ranks(index), before, after, "m").collect():
            marks.setdefault(r["symbol"], {})[r["trading_date"]] = r["m"]
        for s in {s for s, _ in events}:
            hit = set()
            for _, d in [e for e in events if e[0] == s]:
                first, last = sum(x < d for x in DAYS), sum(x <= d for x in DAYS) - 1
                hit |= set(range(first - after, last + before + 1))
            level, got = 0, set()
            for i, d in enumerate(DAYS):
                level += marks.get(s, {}).get(d, 0)
                got |= {i} if level > 0 else set()
            assert got == hit & set(range(len(DAYS)))


def test_a_leak_is_found_at_every_sampled_cutoff(spark):
    bars = spark.createDataFrame([(s, d, float(i + 1)) for s in "AB" for i, d in enumerate(DAYS[:40])], "symbol string, trading_date date, close double")
    samples = spark.createDataFrame([("A", DAYS[10]), ("A", DAYS[20]), ("A", DAYS[20]), ("B", DAYS[39]), ("B", DAYS[5])], "symbol string, cutoff date")
    order = "over (partition by symbol order by trading_date)"
    past = lambda rows: rows.selectExpr("symbol", "trading_date", f"close / lag(close) {order} as r")
    future = lambda rows: rows.selectExpr("symbol", "trading_date", f"lead(close) {order} as r")
    short = lambda rows: past(rows).filter("r is not null")
    assert DS.truncation_audit(bars, past, samples).first().asDict() == {"replicas": 4, "compared": 11 + 21 + 40 + 6, "differing": 0, "passes": True}
    assert DS.truncation_audit(bars, short, samples).first()["passes"]
    found = DS.truncation_differences(DS.truncation_pairs(bars, future, samples)).collect()
    assert {(r["symbol"], r["cutoff"], r["trading_date"]) for r in found} == {(s, d, d) for s, d in (("A", DAYS[10]), ("A", DAYS[20]), ("B", DAYS[5]))}
    # rows that only one side has are differences too
    fewer = lambda rows: rows.filter(~F.col("symbol").contains(DS.SEPARATOR)).select("symbol", "trading_date", "close")
    assert DS.truncation_audit(bars, fewer, samples).first()["differing"] == 11 + 21 + 40 + 6
