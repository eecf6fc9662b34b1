from datetime import date

import pytest
from pyspark.sql import functions as F

from barlab.functions.numeric import money_text
from barlab.functions.temporal import exchange_wall_time, expected_session, release_date_text
from barlab.operators import quality as Q
from helpers import rows_by, weekdays

CANDLE = "symbol string, trading_date date, open double, high double, low double, close double, volume double"
SERIES = "symbol string, arrival bigint, trading_date date, open double, high double, low double, close double, volume double"


def codes(spark, o, h, l, c, v):
    row = Q.validate_candles(spark.createDataFrame([("A", date(2020, 1, 1), o, h, l, c, v)], CANDLE)).first()
    return row["status"], row["errors"]


def test_money_rounds_half_up_from_text(spark):
    values = [100.125, 100.124, 2.675, 0.001, 1e-7, None]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v double").select(money_text(F.col("v"))).collect()]
    assert got == ["100.13", "100.12", "2.68", "0.00", "0.00", None]


@pytest.mark.parametrize("candle, errors", [
    ((10.0, 12.0, 9.0, 11.0, 100.0), []),
    ((None, 12.0, 9.0, 0.0, -1.0), ["MISSING_FIELD"]),
    ((10.0, 8.0, 9.0, 11.0, 1.0), ["HIGH_LESS_THAN_LOW", "OPEN_OUTSIDE_RANGE", "CLOSE_OUTSIDE_RANGE"]),
    ((0.001, 12.0, 0.001, 11.0, 1.0), ["NON_POSITIVE_OPEN", "NON_POSITIVE_LOW"]),
    ((10.0, 12.0, 9.0, 11.0, -5.0), ["NEGATIVE_VOLUME"]),
    ((12.004, 12.0, 9.0, 11.0, 5.0), [])])
def test_candle_codes(spark, candle, errors):
    assert codes(spark, *candle) == ("INVALID" if errors else "VALID", errors)


def test_hash_is_of_the_stored_form(spark):
    import hashlib
    stored = Q.rehash(Q.snapshots(spark.createDataFrame([("A", date(2020, 1, 2), 1.005, None, 1.0, 1.5, 7.0)], CANDLE))).first()
    assert stored["content_hash"] == hashlib.sha256(b"2020-01-02|1.01||1.00|1.50|7").hexdigest() and stored["hash_matches"]


def series(symbol, dates, **defects):
    out = []
    for i, d in enumerate(dates):
        row = dict(open=10.0, high=12.0, low=9.0, close=11.0, volume=100.0)
        row.update(defects.get(f"at{i}", {}))
        out.append((symbol, i, d, *row.values()))
    return out


def test_series_status_and_findings(spark, monkeypatch):
    monkeypatch.setattr(Q, "ARRIVAL_BLOCK", 2)  # several blocks per series
    d = weekdays(6)
    rows = (series("OK", d) + series("WARN", d, at3={"volume": 0.0}) + series("BACK", [d[0], d[1], d[3], d[2], d[4]])
            + series("TWICE", [d[0], d[0], d[1]]) + series("GAP", d, at1={"open": None, "close": None})
            + series("NAN", d, at0={"close": float("nan")}) + series("LATE", d[:3] + [date(2030, 1, 1)])
            + series("NODATE", [d[0], None, d[1]]) + series("LOW", d, at2={"low": 11.5}))
    table = spark.createDataFrame(rows, SERIES)
    got = rows_by(Q.series_status(table, F.lit("2021-01-01").cast("date")))
    first = {s: r["first_error"] for s, r in got.items()}
    assert got["OK"]["status"] == "VALID" and got["WARN"]["status"] == "VALID_WITH_WARNINGS" and got["WARN"]["warning_count"] == 1
    assert first["BACK"] == "Trading dates are not in ascending order" and got["BACK"]["error_count"] == 1
    assert first["TWICE"] == "Duplicate trading dates"
    assert first["GAP"] == "Observation 1: missing open, close"
    assert first["NAN"] == "Observation 0: non-finite OHLCV value"
    assert first["LATE"] == "Future observation date" and first["NODATE"] == "Missing or invalid trading date"
    assert first["LOW"] == "Observation 2: low above open/close/high"
    up = rows_by(Q.strictly_ascending(table))
    assert {s for s, r in up.items() if not r["ascending"]} == {"BACK", "TWICE"}
    assert {s for s, r in rows_by(Q.duplicate_dates(table)).items() if r["has_duplicates"]} == {"TWICE"}


def test_expected_session_and_wall_time(spark):
    cases = [("2026-10-02 18:00:00", date(2026, 10, 2)), ("2026-10-02 17:59:00", date(2026, 10, 1)),
             ("2026-10-03 20:00:00", date(2026, 10, 2)), ("2026-10-04 20:00:00", date(2026, 10, 2)),
             ("2026-10-05 09:00:00", date(2026, 10, 2))]
    df = spark.createDataFrame([(t,) for t, _ in cases], "t string").select(expected_session(F.to_timestamp("t")))
    assert [r[0] for r in df.collect()] == [d for _, d in cases]
    texts = ["2026-01-01T00:00:00Z", "2026-01-01T00:00:00+05:30", "2026-01-01T00:00:00", "", None]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(F.date_format(exchange_wall_time(F.col("t")), "HH:mm"))
    assert [r[0] for r in got.collect()] == ["05:30", "00:00", "00:00", None, None]


def test_release_dates(spark):
    texts = ["March 3rd, 2014", "3 March 2014", "Mar. 3, 2014", "3rd Mar 2014", "no date"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(release_date_text(F.col("t")))
    assert [r[0] for r in got.collect()] == [date(2014, 3, 3)] * 4 + [None]
