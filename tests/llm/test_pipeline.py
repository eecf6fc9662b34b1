import corpus_pipeline
import pytest
from conftest import awkward_rows

import __spark_entry__ as entry
import crosscheck
from barlab.llm import decontam, langid, neardup, pieces, pii, transducer

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "benchmark_decontamination", "pii", "sentencepiece"]


def test_whole_run(spark, tables):
    """What run() gives, beside the stages taken by hand over plain rows."""
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    known = {r.doc_id for r in langid.predict(docs).where("lang_pred <> 'und' and score >= 0.5").collect()}
    rows = [r for r in docs.collect() if r.doc_id in known]
    shingles = {r.doc_id: neardup._shingles(r.text) for r in rows}
    up = {r.doc_id: r.doc_id for r in rows}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for a in up:
        for b in up:
            if a < b and (both := sum((shingles[a] & shingles[b]).values())) and both >= 0.8 * (shingles[a].total() + shingles[b].total() - both):
                x, y = sorted((top(a), top(b)))
                up[y] = x
    rows = [r for r in rows if top(r.doc_id) == r.doc_id]
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, tables).collect()}
    hit = {r.doc_id for r in decontam.report(spark.createDataFrame(rows, docs.schema), spark.read.parquet(f"{tables}/benchmark.parquet")).where("contaminated").collect()}
    assert set(got) <= {r.doc_id for r in rows} and {r.doc_id for r in rows} - set(got) <= hit
    machine = transducer.Transducer(pieces.load(spark))
    for r in rows:
        if r.doc_id not in hit:
            text = pii.redacted(r.text, pii.base_spans(r.text))
            if not pii.candidates(text):
                assert got[r.doc_id].ids == machine.encode(text).tolist()
            assert "@" not in text or "@" in r.text


def test_each_stage_keeps_the_columns(spark, tables, awkward, empty):
    for df in (awkward, empty):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            left = stage(spark, df, tables)
            assert left.columns == df.columns, name
            assert left.count() <= max(len(awkward_rows()), 1) * (df is awkward)


@pytest.mark.parametrize("name", ["op4_fingerprint", "op7_benchmark_decontamination"])
def test_query_equals_its_sql(spark, tables, name):
    con = crosscheck.connect(tables)
    text, ok = crosscheck.compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], tables)
    assert ok, text


def test_all_are_registered():
    names = set(entry.queries())
    assert {"pipeline", *(n for n in names if n.startswith("op"))} <= names
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2].isdigit()) == list(range(1, 14))
