import gzip
import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from barlab.operators import releases as T
from barlab.operators import universe
from barlab.operators.bars import append_newer
from barlab.sources import files, payloads, tables
from barlab.streaming import ingest
from barlab.streaming.ledger import BatchLedger


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_universe_files(spark, tmp_path):
    good = write(tmp_path / "u.csv", "﻿Company Name,Industry,Symbol,Series,ISIN Code\n Alpha , IT ,abc ,be, in1\n")
    row = files.read_universe(spark, good).first()
    assert (row["symbol"], row["company_name"], row["series"], row["isin"]) == ("ABC", "Alpha", "BE", "IN1")
    assert files.read_scan_universe(spark, good).first()["non_eq_series"]
    bad = write(tmp_path / "bad.csv", "Company Name,Symbol\nA,B\n")
    with pytest.raises(files.SourceError):
        files.read_universe(spark, bad)


def test_review_list(spark, tmp_path):
    head = "symbol,isin,event_type,effective_date,reason,reviewer,review_state\n"
    assert files.read_reviews(spark, write(tmp_path / "r.csv", head)).isEmpty()
    with pytest.raises(Exception):
        files.read_reviews(spark, str(tmp_path / "absent.csv"))


def test_master_and_holidays(spark, tmp_path):
    path = tmp_path / "m.json.gz"
    path.write_bytes(gzip.compress(json.dumps([{"segment": "NSE_EQ", "isin": "I"}, {"segment": "X"}]).encode()))
    assert files.read_instrument_master(spark, str(path)).count() == 2
    other = tmp_path / "o.json.gz"
    other.write_bytes(gzip.compress(b'{"segment": "NSE_EQ"}'))
    with pytest.raises(files.SourceError):
        files.read_instrument_master(spark, str(other))
    year = tmp_path / "trading_2026.json"
    entries = [{"tradingDate": "02-Oct-2026", "description": "x"}, {"tradingDate": "02-Oct-2026", "description": " y "}]
    year.write_text(json.dumps({"CM": entries}))
    assert files.read_holidays(spark, str(year)).first().asDict() == {"date": date(2026, 10, 2), "description": "y"}
    year.write_text(json.dumps({"FO": []}))
    with pytest.raises(Exception, match="no holiday entries"):
        files.read_holidays(spark, str(year)).collect()


def test_resolutions_and_newest(spark, tmp_path):
    head = "date,status,session_type,circulars,note\n"
    assert files.read_resolutions(spark, write(tmp_path / "a.csv", head + "2026-01-01,CLOSED,,C/1,n\n")).count() == 1
    for wrong in ("2026-01-01,MAYBE,,C/1,n\n", "2026-01-01,CLOSED,,,n\n", "2026-01-01,CLOSED,,C,n\n2026-01-01,CLOSED,,C,n\n"):
        with pytest.raises(files.SourceError):
            files.read_resolutions(spark, write(tmp_path / "b.csv", head + wrong))
    for d in ("2026-01-02", "2026-02-01"):
        write(tmp_path / f"nifty_{d}.csv", d)
    assert files.newest_by_name(spark, str(tmp_path / "nifty_*.csv")).endswith("nifty_2026-02-01.csv")


def test_candle_payload(spark):
    text = json.dumps({"data": {"candles": [["2026-01-02T00:00:00+05:30", 1, "2.5", None, "x", 5, 0], [], ["bad", 1], ["2026-01-01T00:00:00Z", 1, 2, 3, 4]]}})
    got = payloads.bars_of(payloads.candles(spark.createDataFrame([("A", text)], "symbol string, payload string"))).orderBy("arrival").collect()
    assert [r["trading_date"] for r in got] == [date(2026, 1, 1), date(2026, 1, 2), None, None]
    assert (got[1]["open"], got[1]["high"], got[1]["low"], got[1]["close"], got[1]["volume"]) == (1.0, 2.5, None, None, 5.0)


def test_backfill(spark):
    cols = "symbol string, trading_date date, close double"
    held = spark.createDataFrame([("A", date(2026, 1, 1), 1.0), ("B", date(2026, 1, 3), 1.0)], cols)
    again = spark.createDataFrame([("A", date(2026, 1, 1), 9.0), ("A", date(2026, 1, 2), 2.0), ("B", date(2026, 1, 4), 9.0)], cols)
    got = {(r["symbol"], r["trading_date"].day): r["close"] for r in append_newer(held, again, F.lit(date(2026, 1, 3))).collect()}
    assert got == {("A", 1): 1.0, ("A", 2): 2.0, ("B", 3): 1.0}
    assert append_newer(held, again.limit(0), F.lit(date(2026, 1, 3))).count() == 2


def test_append_only(spark, tmp_path):
    path, cols = str(tmp_path / "snap"), "run_id string, symbol string, v int"
    batch = spark.createDataFrame([("r", "A", 1)], cols)
    tables.append_snapshots(batch, path, ["run_id", "symbol"])
    with pytest.raises(tables.AlreadyStored):
        tables.append_snapshots(batch, path, ["run_id", "symbol"])
    with pytest.raises(tables.AlreadyStored):
        two = spark.createDataFrame([("r", "B", 1), ("r", "B", 2)], cols)
        tables.append_snapshots(two, path, ["run_id", "symbol"])
    assert spark.read.parquet(path).count() == 1


def test_replace_rows_is_idempotent(spark, tmp_path):
    path, cols = str(tmp_path / "runs"), "run_id string, symbol string, v int"
    tables.replace_rows(spark.createDataFrame([("r1", "A", 1), ("r1", "B", 1), ("r2", "A", 1)], cols), path, ["run_id", "symbol"], F.col("v"))
    for _ in range(2):
        tables.replace_rows(spark.createDataFrame([("r1", "A", 5), ("r1", "A", 7)], cols), path, ["run_id", "symbol"], F.col("v"))
    got = {(r["run_id"], r["symbol"]): r["v"] for r in spark.read.parquet(path).collect()}
    assert got == {("r1", "A"): 7, ("r1", "B"): 1, ("r2", "A"): 1}


def test_manifest_ignores_row_order(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"x{i}") for i in range(50)], "i int, t string")
    a = tables.manifest(rows, "m").first()
    assert a == tables.manifest(rows.orderBy(F.desc("i")).repartition(5), "m").first()
    assert a["checksum"] != tables.manifest(rows.filter("i <> 3"), "m").first()["checksum"]
    assert tables.export(rows, str(tmp_path / "out"), "m", "csv").first()["rows"] == 50


def test_stream_keeps_one_copy(spark, tmp_path):
    source, schema = str(tmp_path / "in"), "symbol string, at timestamp, close double"
    rows = spark.createDataFrame([("A", "2026-01-01", 1.0), ("B", "2026-01-01", 2.0)], "symbol string, at string, close double").withColumn("at", F.to_timestamp("at"))
    for _ in range(3):
        rows.write.mode("append").parquet(source)
    arriving = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    kept = ingest.first_copies(arriving, "at", "10 days", ["symbol", "at"])
    ingest.append_available(kept, str(tmp_path / "out"), str(tmp_path / "mark")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_release_text(spark):
    text = "\n".join([
        "Changes", "This cites changes effective from March 1, 2013 and", "they shall become effective", "from Friday, March 28, 2014.",
        "1) Nifty Bank", "1 Alpha Ltd ALPHA", "2) NIFTY 500 Index", "1 Ignored Before Action X", "The following are being excluded:",
        "1 Good Goods Ltd GOOD", "2 Broken Name Limited", "3 Numbers 12345", "Companies being included", " 10 M&M Motors M&M-DVR ", "3. Nifty Next 50", "1 Delta DELTA"])
    docs = spark.createDataFrame([("ind_prs05032014_1.pdf", text), ("other.pdf", "nothing here\n")], "file string, text string")
    got = [tuple(r) for r in T.section_rows(docs).orderBy("line_no").select("action", "symbol", "name").collect()]
    assert got == [("EXCLUDE", "GOOD", "Good Goods Ltd"), ("EXCLUDE", None, "2 Broken Name Limited"), ("EXCLUDE", None, "3 Numbers 12345"),
                   ("INCLUDE", "M&M-DVR", "M&M Motors")]
    dated = {r["file"]: r for r in T.release_dates(docs).collect()}
    assert dated["ind_prs05032014_1.pdf"]["effective_date"] == date(2014, 3, 28)
    assert dated["ind_prs05032014_1.pdf"]["release_date"] == date(2014, 3, 5) and dated["other.pdf"]["effective_date"] is None
    report = T.parse_report(docs).first().asDict()
    assert report == {"files_with_section": 1, "no_rows": 0, "unreadable_rows": 2, "no_effective_date": 0, "rows": 2}


def test_a_candle_that_is_no_array_keeps_the_others(spark):
    text = '{"data":{"candles":[7,["2024-01-03T00:00:00+05:30",1,2,0.5,1.5,10,0],null,"x",["2024-01-02T00:00:00+05:30",1,"n/a"]]}}'
    got = payloads.candles(spark.createDataFrame([("A", text)], "symbol string, payload string")).orderBy("place").collect()
    assert [(r["raw_time"] or "")[:10] for r in got] == ["2024-01-02", "2024-01-03", "", "", ""]
    assert got[1]["close"] == 1.5 and got[0]["high"] is None and all(r["open"] is None for r in got[2:])


def test_json_numbers_count_as_whole_numbers(spark):
    one = lambda text: spark.createDataFrame([(text,)], "payload string")
    row = payloads.instruments(one('{"data":[{"exchange":"NSE","tradingsymbol":"A","lot_size":75.0},{"exchange":"NSE","tradingsymbol":"B","lot_size":"many"}]}')).orderBy("symbol").collect()
    assert [r["lot_size"] for r in row] == [75, 0]
    quotes = payloads.quotes(one('{"data":{"A":{"ltp":1,"volume":100.0},"B":{"ltp":1,"timestamp":"2024-01-02T00:00:00Z"},"C":{"ltp":1,"timestamp":"soon"},"D":{"volume":"x"}}}'))
    got = {r["symbol"]: r for r in quotes.collect()}
    assert set(got) == {"A", "B"} and got["A"]["volume"] == 100 and got["A"]["timestamp"] is None and got["B"]["timestamp"] is not None


def test_csv_files_must_agree_on_their_columns(spark, tmp_path):
    head = ["Company Name", "Industry", "Symbol", "Series", "ISIN Code"]
    for i, order in enumerate((head, head[::-1])):
        (tmp_path / f"{i}.csv").write_text(",".join(order) + "\n" + ",".join("abcde") + "\n")
    with pytest.raises(Exception):
        files.read_universe(spark, str(tmp_path)).collect()


def test_a_missing_holiday_year_is_an_error(spark, tmp_path):
    (tmp_path / "2020.json").write_text('{"CM":[{"tradingDate":"01-May-2020","description":" Day\\u00a0"}]}')
    assert [r["description"] for r in files.read_holidays(spark, str(tmp_path), [2020]).collect()] == ["Day"]
    with pytest.raises(files.SourceError):
        files.read_holidays(spark, str(tmp_path), [2020, 2021])


def test_order_of_the_instrument_file_is_kept(spark, tmp_path):
    rows = [{"segment": "NSE_EQ", "instrument_type": "EQ", "isin": "I", "instrument_key": k} for k in ("Z", "A", "M")]
    (tmp_path / "m.json").write_text(json.dumps(rows))
    read = files.read_instrument_master(spark, str(tmp_path))
    assert [r["instrument_key"] for r in read.orderBy("source_order").collect()] == ["Z", "A", "M"]
    assert universe.isin_keys(read, F.col("source_order")).first()["instrument_key"] == "Z"


def test_text_is_parsed_without_an_exchange(spark, tmp_path):
    text = "1) Nifty Bank\n2)\xa0Nifty\xa0500\xa0\nbeing\xa0excluded:\n1\xa0Good Goods\xa0GOOD\xa0\n2 Beta Ltd BETA\n3) Other"
    docs = spark.createDataFrame([(f"f{i}", text) for i in range(8)], "file string, text string").repartition(4)
    docs.write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    found = T.announced_changes(docs)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("FileScan") == 1
    assert {(r["action"], r["symbol"], r["name"]) for r in found.collect()} == {("EXCLUDE", "GOOD", "Good Goods"), ("EXCLUDE", "BETA", "Beta Ltd")}


def test_a_ledger_takes_a_batch_once(spark, tmp_path, monkeypatch):
    rows = lambda *r: spark.createDataFrame(list(r), "symbol string, day int, v int")
    ledger = BatchLedger(str(tmp_path / "t"), ["symbol", "day"])
    assert ledger.stored(spark, rows(("A", 1, 1)).schema) is None and ledger.lines(spark).count() == 0
    first, second = rows(("A", 1, 1), ("B", 1, 1)), rows(("A", 1, 9), ("A", 2, 2), ("C", 1, 3), ("C", 1, 4), ("B", 1, 5), ("B", 1, 6))
    held = lambda: sorted(tuple(r) for r in ledger.stored(spark, first.schema).select("symbol", "day", "v", "batch").collect())
    down = lambda: sorted(tuple(r) for r in ledger.refused(spark, first.schema).select("symbol", "day", "why", "batch").collect())
    assert ledger.store(first, 0) and not ledger.store(first, 0) and not ledger.store(second, 0)
    assert held() == [("A", 1, 1, 0), ("B", 1, 1, 0)]
    # interrupted after its rows were written, before its line
    with monkeypatch.context() as m:
        m.setattr(ledger, "lines_path", str(tmp_path / "elsewhere"))
        ledger.store(first, 0)
        ledger.store(second, 1)
    assert held() == [("A", 1, 1, 0), ("B", 1, 1, 0)] and down() == []
    for _ in range(2):
        ledger.store(second, 1)
    assert held() == [("A", 1, 1, 0), ("A", 2, 2, 1), ("B", 1, 1, 0)]
    assert down() == [("A", 1, "ALREADY_STORED", 1), ("B", 1, "ALREADY_STORED", 1), ("B", 1, "TWICE_IN_BATCH", 1), ("C", 1, "TWICE_IN_BATCH", 1)]
    assert sorted(tuple(r) for r in ledger.lines(spark).collect()) == [(0, 2, 0), (1, 1, 4)]


def test_only_newer_bars_pass_from_batch_to_batch(spark, tmp_path):
    source, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    schema = "symbol string, trading_date date, close double"
    d = lambda n: date(2024, 1, n)
    batches = [[("A", d(5), 1.0), ("A", d(3), 2.0), ("B", d(9), 3.0), ("A", None, 0.0)],
               [("A", d(5), 4.0), ("A", d(4), 5.0), ("A", d(7), 6.0), ("A", d(6), 7.0), ("A", d(6), 8.0), ("C", d(1), 9.0)],
               [("A", d(6), 10.0), ("B", d(10), 11.0), ("C", d(1), 12.0)]]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        arriving = spark.readStream.schema(schema).parquet(source)
        ingest.append_available(ingest.newer_only(arriving, 4000), out, mark).awaitTermination()
    got = sorted(tuple(r) for r in spark.read.schema(schema).parquet(out).collect())
    assert got == [("A", d(3), 2.0), ("A", d(5), 1.0), ("A", d(6), 7.0), ("A", d(7), 6.0), ("B", d(9), 3.0), ("B", d(10), 11.0), ("C", d(1), 9.0)]


def test_payloads_keep_what_no_reader_asks_for(spark):
    df = spark.createDataFrame([('{"data":[{"a":1,"new":{"x":[1,2]}},{"a":2},5,null,{"new":3}],"more":true}',), ("no json",), (None,), ('{"data":{"a":1,"single":null}}',)], "payload string")
    assert {r["key"]: r["n"] for r in payloads.unknown_keys(df, "$.data", ["a"]).collect()} == {"new": 2, "single": 1}
    assert {r["key"] for r in payloads.unknown_keys(df, "$", ["data"]).collect()} == {"more"}
    none = spark.createDataFrame([("A", "no json"), ("A", None), ("A", '{"data":{"candles":5}}'), ("A", '{"data":[]}')], "symbol string, payload string")
    assert payloads.candles(none).count() == 0 and payloads.instruments(none).count() == 0 and payloads.quotes(none).count() == 0
    assert payloads.option_chain(none.withColumnRenamed("symbol", "underlying")).count() == 0
    odd = spark.createDataFrame([("A", '{"data":{"candles":[["2024-01-02T00:00:00+05:30",1e1,"2.5",null,[7],{"v":1},true],"text"]}}')], "symbol string, payload string")
    got = payloads.candles(odd).orderBy("place").collect()
    assert [(r["open"], r["high"], r["low"], r["close"], r["volume"]) for r in got] == [(10.0, 2.5, None, None, None), (None,) * 5]
