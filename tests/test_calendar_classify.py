from datetime import date

import pytest
from pyspark.sql import functions as F

from barlab.operators import adjustment as A
from barlab.operators import calendar as K
from barlab.operators import classify as C
from barlab.operators import explorer as X
from barlab.operators import runs as R
from barlab.operators import summary as S
from barlab.operators import universe as U
from helpers import rows_by, weekdays

DAYS = weekdays(5, date(2026, 9, 21))


def dates(spark, values):
    return spark.createDataFrame([(d,) for d in values], "trading_date date")


def at(text):
    return F.lit(text).cast("timestamp")


def test_last_closed_session(spark):
    sessions = K.session_dates(dates(spark, DAYS))
    last = lambda now: K.last_closed_session(sessions, at(now)).first()["last_closed"]
    assert last("2026-09-25 17:59:59") == DAYS[3] and last("2026-09-25 18:00:00") == DAYS[4]
    with pytest.raises(Exception, match="no session has closed"):
        last("2020-01-01 00:00:00")
    with pytest.raises(Exception, match="missing its date"):
        K.session_dates(dates(spark, [None])).collect()


def test_verified_calendar(spark):
    span = spark.createDataFrame([(date(2026, 10, 1), date(2026, 10, 6))], "first date, last date")
    hol = spark.createDataFrame([(date(2026, 10, 2), "Gandhi Jayanti"), (date(2026, 10, 3), "Special Live Trading"),
                                 (date(2026, 10, 5), "Dhanteras Trading")], "date date, description string")
    res = spark.createDataFrame([(date(2026, 10, 5), "CLOSED", "", "C/1", "closed again"), (date(2026, 10, 4), "SESSION", "MUHURAT", "C/2", "")],
                                "date date, status string, session_type string, circulars string, note string")
    got = {r["date"].day: r for r in K.verified_calendar(span, hol, res).collect()}
    assert [got[d]["is_session"] for d in range(1, 7)] == [True, False, True, True, False, True]
    assert got[2]["closure_reason"] == "Gandhi Jayanti" and got[5]["closure_reason"] == "closed again"
    assert got[4]["session_type"] == "MUHURAT" and got[5]["source"] == "resolution:C/1" and got[1]["source"] == "weekday_rule"


def test_reconciliation(spark):
    vendor = spark.createDataFrame([("x", DAYS[0]), ("x", DAYS[2]), ("x", date(2026, 9, 26))], "instrument string, trading_date date")
    span = spark.createDataFrame([(DAYS[0], date(2026, 9, 30))], "first date, last date")
    res = spark.createDataFrame([(DAYS[1],)], "date date")
    gaps = spark.createDataFrame([(DAYS[3], "x"), (DAYS[4], "y")], "date date, instrument string")
    got = {(r["date"], r["finding"]): r["resolved"] for r in K.reconcile(vendor, dates(spark, DAYS), span, res, gaps).collect()}
    assert got == {(date(2026, 9, 26), "vendor bar on a closed day"): False, (DAYS[1], "session without vendor bar"): True,
                   (DAYS[3], "session without vendor bar"): True, (DAYS[4], "session without vendor bar"): False}


def test_classification(spark):
    symbols = spark.createDataFrame([("FULL",), ("GAP",), ("OLD",), ("NONE",)], "symbol string")
    valid = spark.createDataFrame([("FULL", d) for d in DAYS] + [("GAP", d) for d in (DAYS[0], DAYS[1], DAYS[4])] + [("OLD", d) for d in DAYS[:3]],
                                  "symbol string, trading_date date")
    window = K.trailing_sessions(dates(spark, DAYS), F.lit(DAYS[4]), 5)
    got = rows_by(C.classify(symbols, valid, window, F.lit(DAYS[4]), 3))
    assert [got[s]["status"] for s in ("FULL", "GAP", "OLD", "NONE")] == ["VALID", "VALID", "STALE", "INSUFFICIENT_HISTORY"]
    assert got["GAP"]["history_gaps"] and not got["FULL"]["history_gaps"]
    assert got["NONE"]["status_reason"] == "only 0 valid candle(s) in the trailing 5-session window (need 3)"


def test_acquisition_outcomes(spark):
    m = spark.createDataFrame([("A", 1, "MAPPED", None), ("B", 2, "UNMAPPED", "none"), ("C", 3, "MAPPED", None), ("D", 4, "MAPPED", None),
                               ("E", 5, "EXCLUDED_PLACEHOLDER", None), ("F", 0, "MAPPED", None)], "symbol string, source_order int, mapping_status string, mapping_error string")
    failures = spark.createDataFrame([("C", "AuthenticationError: 401", True)], "symbol string, error string, is_auth boolean")
    fetched = spark.createDataFrame([("A", 5), ("F", 2)], "symbol string, observations bigint")
    checked = spark.createDataFrame([("A", "VALID", 0, None), ("F", "VALID", 0, None)], "symbol string, validation_status string, error_count bigint, first_error string")
    got = rows_by(C.acquisition_outcomes(m, failures, fetched, checked, None, 3))
    assert {s: r["status"] for s, r in got.items()} == {"A": "SUCCESS", "B": "MAPPING_FAILED", "C": "REQUEST_FAILED", "D": "NOT_REQUESTED",
                                                         "E": "EXCLUDED", "F": "INSUFFICIENT_HISTORY"}
    wrong = checked.selectExpr("symbol", "'INVALID' as validation_status", "2L as error_count", "'bad' as first_error")
    failed = rows_by(C.acquisition_outcomes(m, failures, fetched, wrong, None, 3))
    assert failed["A"]["status"] == "VALIDATION_FAILED" and failed["A"]["reason"] == "2 validation error(s), first: bad"
    stopped = C.acquisition_outcomes(m, failures, fetched, checked, "benchmark failed", 3)
    assert stopped.filter("status = 'NOT_REQUESTED'").count() == 4
    report = C.acquisition_report(C.acquisition_outcomes(m, failures, fetched, checked, None, 3)).first()
    assert (report["universe_count"], report["mapped_count"], report["persisted_observation_count"]) == (5, 4, 3)


def test_mapping_statuses(spark):
    members = spark.createDataFrame([("A", "I1"), ("B", "I2"), ("C", "I3"), ("bad symbol", "I4"), ("E", "")], "symbol string, isin string")
    row = lambda isin, sym, typ, key: ("NSE_EQ", "NSE", typ, isin, sym, key)
    master = spark.createDataFrame([row("I1", "A", "EQ", "NSE_EQ|I1"), row("I2", "B", "EQ", "NSE_EQ|I2"), row("I2", "B", "BE", "NSE_EQ|B2"),
                                    row("I4", "X", "EQ", "NSE_EQ|I4"), row("I9", "E", "EQ", "NSE_EQ|")],
                                   "segment string, exchange string, instrument_type string, isin string, trading_symbol string, instrument_key string")
    got = rows_by(U.map_constituents(members, master))
    assert got["A"]["mapping_status"] == "MAPPED" and got["B"]["mapping_status"] == "AMBIGUOUS" and got["C"]["mapping_status"] == "UNMAPPED"
    assert got["BAD SYMBOL"]["mapping_status"] == "INVALID_INSTRUMENT" and got["E"]["mapping_status"] == "INVALID_INSTRUMENT"
    keys = {r["isin"]: r["instrument_key"] for r in U.isin_keys(master, F.col("instrument_key")).collect()}
    assert keys["I2"] == "NSE_EQ|I2"


def test_requested_symbols(spark):
    u = spark.createDataFrame([("A",), ("B",)], "symbol string")
    kept, unknown = U.requested(u, ["A", "Z"])
    assert [r["symbol"] for r in kept.collect()] == ["A"] and unknown == ["Z"]
    with pytest.raises(ValueError):
        U.requested(u, ["Z"])


def test_ex_date_comparison(spark):
    bars = spark.createDataFrame([("A", date(2026, 9, 25), 100.0), ("A", date(2026, 9, 28), 50.0)], "symbol string, trading_date date, close double")
    events = spark.createDataFrame([("A", date(2026, 9, 27), 2.0), ("A", date(2026, 9, 28), 2.0), ("A", date(2026, 9, 20), 2.0), ("Q", date(2026, 9, 20), 2.0)],
                                   "symbol string, ex_date date, price_divisor double")
    got = {(r["symbol"], r["ex_date"].day): r for r in A.compare_across_events(bars, events).collect()}
    assert got[("A", 27)]["observed_ratio"] == 0.5 and got[("A", 27)]["date_on_or_after"] == date(2026, 9, 28)
    assert got[("A", 28)]["conclusive"] and got[("A", 28)]["distance_to_unadjusted"] == 0.0
    assert not got[("A", 20)]["conclusive"] and got[("A", 20)]["close_on_or_after"] == 100.0 and not got[("Q", 20)]["conclusive"]
    with pytest.raises(Exception, match="above 1"):
        A.compare_across_events(bars, events.withColumn("price_divisor", F.lit(1.0))).collect()
    with pytest.raises(Exception, match="non-positive"):
        A.compare_across_events(bars.withColumn("close", F.lit(0.0)), events).collect()


def test_breadth_and_buckets(spark):
    rows = spark.createDataFrame([("A", 110.0, 100.0, 100.0, 90.0, 100.0, 0.0), ("B", 95.0, 100.0, 100.0, None, 35.0, 6.0), ("C", 120.0, 100.0, 130.0, 110.0, 99.9, -1.0)],
                                 "symbol string, close double, ema_short double, ema_medium double, ema_long double, rsi double, distance_from_high double")
    got = {r["label"]: (r["count"], r["of"]) for r in S.breadth(rows, {"short": 20, "medium": 50, "long": 200}).collect()}
    assert got == {"short": (2, 3), "medium": (1, 3), "long": (2, 2)}
    hist = {r["lo"]: r["count"] for r in S.rsi_histogram(rows).collect()}
    assert hist[90] == 2 and hist[30] == 1 and sum(hist.values()) == 3
    buckets = {r["lo"]: r["count"] for r in S.distance_buckets(rows).collect()}
    assert buckets == {0: 1, 2: 0, 5: 1, 10: 0, 20: 0}
    assert S.high_proximity(rows).first()["at_high"] == 2


def test_screen_nulls_and_guards(spark):
    results = spark.createDataFrame([("A", "Alpha", "IT", "VALID"), ("B", "Beta", None, "FAILED"), ("C", "Gamma", "IT", "VALID")],
                                    "symbol string, company_name string, sector string, status string")
    empty = {n: F.lit(None).cast("double") for n in X.FEATURE_SORTS}
    features = spark.createDataFrame([("A", 40.0), ("C", None)], "symbol string, rsi double").withColumns({k: v for k, v in empty.items() if k != "rsi"})
    names = lambda s, f=features: [r["symbol"] for r in X.explore(results, f, s, 1, 10).collect()]
    assert names(X.Screen(sort="rsi")) == ["A", "B", "C"] and names(X.Screen(sort="rsi", direction="desc")) == ["A", "B", "C"]
    assert names(X.Screen(ranges={"rsi": (0.0, None)})) == ["A"] and names(X.Screen(text="ALPH")) == ["A"]
    assert names(X.Screen(sector="UNKNOWN")) == ["B"]
    with pytest.raises(ValueError, match="features"):
        names(X.Screen(sort="rsi"), None)


def test_runs(spark):
    ev = spark.createDataFrame([("r1", at_, i, s, None, None, u, v) for at_, i, s, u, v in
                                [("2026-01-01", 1, "RUNNING", None, None), ("2026-01-02", 2, "COMPLETE", "u", "v")]] +
                               [("r2", "2026-01-01", 1, "RUNNING", None, None, None, None), ("r3", "2026-01-01", 1, "COMPLETE", None, None, None, None)],
                               "run_id string, at string, seq int, status string, abort_reason string, finished_at string, universe_version string, review_version string")
    state = rows_by(R.interrupt_leftovers(R.run_state(ev), F.lit("now")), "run_id")
    assert state["r1"]["status"] == "COMPLETE" and (state["r2"]["status"], state["r2"]["abort_reason"]) == ("ABORTED", "INTERRUPTED")
    bad = {(r["run_id"], r["violation"]) for r in R.run_violations(ev).collect()}
    assert bad == {("r3", "NOT_STARTED_ONCE"), ("r3", "COMPLETE_WITHOUT_VERSIONS")}
