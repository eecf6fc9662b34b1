import gzip
import hashlib
from pathlib import Path

import pytest

from barlab.llm import warc

PAGES = "page_id bigint, url string, html string, digest string, `key` string, file string"


def page(i, url, html):
    return (i, url, html, "d", "k", "f")


LONG = "<html>" + "copy é " * 40 + "</html>"


def awkward():
    return [page(3, "http://a.example.com/x", LONG), page(2, "https://A.example.com:443/x", LONG), page(2, "https://A.example.com:443/x", LONG),
            page(None, None, LONG), page(None, "http://b.example.com", "n" * 200), page(None, "http://b.example.com", "n" * 200),
            page(4, "http://a.example.com/x", "short"), page(5, None, "short"), page(6, "", None), page(7, "no url at all", ""),
            page(8, "http://user@c.example.org/p?q=1#top", "x" * 100), page(9, "http://c.example.org/p?q=1", "x" * 100), page(10, "http://c.example.org", "x" * 99),
            page(11, "http://c.example.org/", "x" * 99), page(12, "http://ü.example/ä b\r\nWARC-Type: response", "y" * 3_000_000), page(-1, "http://ü.example/", "y" * 3_000_000)]


def brute(rows):
    first = {}
    for r in rows:
        html = r[2] or ""
        if r[0] is not None and len(html.encode()) >= 100:
            first[html] = min(first.get(html, r[0]), r[0])
    out = []
    for r in rows:
        data, to = (r[2] or "").encode(), first.get(r[2] or "")
        again = to is not None and to != r[0]
        out.append((r[0], len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", to if again else None))
    return sorted(out, key=str)


def archive(spark, rows, root, **kw):
    captures = warc.write_archives(spark.createDataFrame(rows, PAGES), root)
    return captures, warc.write_index(captures, root, **kw)


@pytest.mark.parametrize("most", [warc.BROADCAST_FIRSTS, 0])
def test_awkward_rows(spark, monkeypatch, most):
    monkeypatch.setattr(warc, "BROADCAST_FIRSTS", most)
    got = warc.report(spark.createDataFrame(awkward(), PAGES))
    assert sorted(map(tuple, got.collect()), key=str) == brute(awkward())


def test_empty_table(spark):
    assert warc.report(spark.createDataFrame([], PAGES)).collect() == []


def test_archives_are_records_of_the_format(spark, tmp_path):
    captures, _ = archive(spark, awkward(), str(tmp_path))
    for r in captures.collect():
        data = Path(tmp_path, r.file).read_bytes()[r.offset:r.offset + r.length]
        text = gzip.decompress(data)
        head, _, body = text.partition(b"\r\n\r\n")
        fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
        assert text.startswith(b"WARC/1.1\r\n") and fields[b"WARC-Type"].decode() == r.record_type
        assert body.endswith(b"\r\n\r\n") and len(body) == int(fields[b"Content-Length"]) + 4
    whole = [gzip.decompress(f.read_bytes()) for f in tmp_path.glob("*.warc.gz")]  # members follow each other
    assert sum(w.count(b"WARC-Type: response\r\n") + w.count(b"WARC-Type: revisit\r\n") for w in whole) == len(awkward())


def test_keys(spark):
    urls = ["http://www.Example.com/A?b=1#c", "https://u:p@example.com", "http://example.com:8080/x", "", None, "example.com/y", "http://h/a b", "HTTPS://H:443", "https://h:80/"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i int, url string").select("i", warc.capture_key("url").alias("k"))
    assert [r.k for r in df.orderBy("i").collect()] == ["com,example,www)/A?b=1", "com,example)/", "com,example:8080)/x", "", "", "com,example)/y", "h)/a%20b", "h)/", "h:80)/"]


def test_one_url_over_many_files_and_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 7)
    rows = [page(i, "http://hot.example.com/" if i % 3 else f"http://{i % 50}.example.com/{i}", f"<p>{i}</p>") for i in range(600)]
    captures, index = archive(spark, rows, str(tmp_path), lines=40)
    assert index.count() > 10 and index.agg({"lines": "sum"}).first()[0] == 600
    wanted = spark.createDataFrame([("com,example,hot)/",), ("com,example,hot)/",), ("com,example,0)/0",), ("com,example,unknown)/",), (None,)], "key string")
    got = sorted(r.page_id for r in warc.lookup(index, str(tmp_path), wanted).collect())
    assert got == sorted([0, *[i for i in range(600) if i % 3]])
    every = warc.lookup(index, str(tmp_path), captures.select("key"))
    assert sorted(every.select("page_id", "file", "offset").collect()) == sorted(captures.select("page_id", "file", "offset").collect())


def test_index_file_against_a_list(tmp_path):
    rows = sorted((k, str(i)) for i, k in enumerate(["a", "b", "b", "b", "b", "c", "e", "e", "é", "漢"] * 3))
    data = warc.index_file(rows, lines=2)
    (tmp_path / "x").write_bytes(data)
    fs, folder = warc.opened(str(tmp_path))
    held = warc.IndexFile(fs, f"{folder}/x", len(data))
    for key in ("", "a", "b", "c", "d", "e", "z", "é", "漢", "龍"):
        assert [v for part in held.find(key) for v in part] == [v for k, v in rows if k == key]


def test_fetch_follows_revisits(spark, tmp_path):
    _, index = archive(spark, awkward(), str(tmp_path))
    urls = spark.createDataFrame([("http://a.example.com/x",), ("http://c.example.org/p?q=1",), ("http://ü.example/ä b\r\nWARC-Type: response",)], "url string")
    got = sorted((r.page_id, bytes(r.payload).decode()) for r in warc.fetch(index, str(tmp_path), urls).collect())
    assert got == sorted([(3, LONG), (2, LONG), (2, LONG), (4, "short"), (8, "x" * 100), (9, "x" * 100), (12, "y" * 3_000_000)])


def test_damage_is_found(spark, tmp_path):
    captures, _ = archive(spark, [page(1, "http://a/", "z" * 500)], str(tmp_path))
    r = captures.first()
    text = gzip.decompress((tmp_path / r.file).read_bytes()[r.offset:r.offset + r.length])
    with pytest.raises(ValueError, match="does not match"):
        warc.parsed(text.replace(b"zzz", b"zyz", 1))
    with pytest.raises(ValueError, match="no WARC record"):
        warc.parsed(text[1:])
