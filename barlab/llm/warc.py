"""WARC archives of pages, and their two-level capture index.

Tasks write compressed archives into the shared folder. Captures are sorted by reversed host into
index files; an index file is a row of compressed blocks with a sparse directory of their first keys
behind them. A lookup finds the index files from their bounds, the block from the directory and the
line in the block, each by binary search, and then reads just the record's range of the archive.
"""
from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from barlab.llm.common import need, parts
from barlab.session import materialize, scratch_path

LEAST_SHARED = 100  # bytes: shorter payloads are never written as revisits
DATE = "2000-01-01T00:00:00Z"  # the tables have no time of capture
LEVEL = 6  # of gzip
ARCHIVE_BYTES = 64_000_000  # an archive file is closed after so many
BLOCK_LINES = 500
INDEX_LINES = 50_000  # lines of an index file, while there are fewer files than this:
INDEX_FILES = 5_000  # bounds of so many files, some 200 bytes each, are all that a lookup task holds
CHUNK = 8_000_000  # compressed bytes that a task reads back
READ_AHEAD = 1_000_000
# A row costs about 150 bytes when broadcast; beyond so many the rows are joined by shuffle.
BROADCAST_FIRSTS = 200_000
# A header ends at its line: these signs are percent-encoded in URLs, of records and of keys alike.
CODES = {" ": "%20", "\t": "%09", "\n": "%0A", "\r": "%0D"}

CAPTURE = "key string, page_id bigint, url string, record_type string, digest string, file string, offset bigint, length bigint"
INDEX = "file string, first_key string, last_key string, lines bigint, size bigint"
RECORD = ("page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, "
          "refers_url string, payload binary")


def arrow_schema(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(schema))


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path in the shared folder, which may be local to the cluster or a store."""
    return pafs.FileSystem.from_uri(path)


def capture_key(url: Column) -> Column:
    """Host labels in reverse, `)`, then path and query; scheme, its own port, user and fragment do not count.
    Null: empty."""
    url = F.coalesce(url, F.lit(""))
    for sign, code in CODES.items():
        url = F.replace(url, F.lit(sign), F.lit(code))
    for scheme, port in (("http", 80), ("https", 443)):
        url = F.regexp_replace(url, rf"^(?i)({scheme}://[^/?#]*):{port}(?=[/?#]|$)", "$1")
    rest = F.regexp_replace(F.regexp_replace(url, r"(?s)#.*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?@]*@)?", "")
    host = F.lower(F.regexp_extract(rest, r"^[^/?]*", 0))
    tail = F.regexp_extract(rest, r"(?s)^[^/?]*(.*)$", 1)
    port = F.regexp_extract(host, r":\d+$", 0)
    labels = F.array_join(F.reverse(F.split(F.regexp_replace(host, r":\d+$", ""), r"\.")), ",")
    return F.when(url == "", "").otherwise(F.concat(labels, port, F.lit(")"), F.when(tail == "", "/").otherwise(tail)))


# ---- one record ----------------------------------------------------------------------------

def record_id(page_id: int | None, url: str | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url}')}>"


def header_value(text: str) -> str:
    return text.translate(str.maketrans(CODES))


def block(first: str, fields: list[tuple[str, object]]) -> bytes:
    lines = [first, *[f"{name}: {value}" for name, value in fields if value is not None]]
    return "".join(line + "\r\n" for line in [*lines, ""]).encode()


def gzipped(data: bytes, level: int) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def record(page_id, url, payload: bytes, digest: str, refers_to=None, refers_url=None, revisit=False) -> bytes:
    """One page as a response, or as a revisit: the same headers without the payload."""
    http = block("HTTP/1.1 200 OK", [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", len(payload))])
    body = http if revisit else http + payload
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page_id, url)), ("WARC-Date", DATE),
            ("WARC-Target-URI", None if url is None else header_value(url)), ("WARC-Payload-Digest", f"sha256:{digest}"), ("Page-ID", page_id)]
    if revisit:
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                 ("WARC-Refers-To", record_id(refers_to, refers_url)), ("Refers-To-Page-ID", refers_to),
                 ("WARC-Refers-To-Target-URI", None if refers_url is None else header_value(refers_url)), ("WARC-Refers-To-Date", DATE)]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(body))]
    return block("WARC/1.1", head) + body + b"\r\n\r\n"


def headers(data: bytes, at: int) -> tuple[dict[str, str], int]:
    end = data.index(b"\r\n\r\n", at)
    lines = data[at:end].decode().split("\r\n")[1:]
    return dict(line.split(": ", 1) for line in lines), end + 4


def parsed(data: bytes) -> dict:
    """A record as it lies in an archive, decompressed. Raises ValueError if it is damaged."""
    if not data.startswith(b"WARC/1."):
        raise ValueError("no WARC record at this place")
    head, at = headers(data, 0)
    body = data[at:at + int(head["Content-Length"])]
    http, start = headers(body, 0)
    payload = body[start:]
    digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
    kind = head["WARC-Type"]
    if kind == "response" and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != int(http["Content-Length"])):
        raise ValueError(f"payload of {head['WARC-Record-ID']} does not match its digest")
    number = {k: int(head[k]) if k in head else None for k in ("Page-ID", "Refers-To-Page-ID")}
    return {"page_id": number["Page-ID"], "url": head.get("WARC-Target-URI"), "payload_bytes": int(http["Content-Length"]), "payload_digest": digest,
            "record_type": kind, "refers_to": number["Refers-To-Page-ID"], "refers_url": head.get("WARC-Refers-To-Target-URI"),
            "payload": payload if kind == "response" else None}


# ---- archives ------------------------------------------------------------------------------

def with_firsts(pages: DataFrame, least: int) -> DataFrame:
    """page_id, url, html, key, digest, and of shared payloads the page whose record is the response.

    Only payloads that occur twice are looked up, so a page met once needs no partner, and the html is
    shuffled only if there are more shared payloads than may be broadcast.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    told = need(pages, "page_id", "url", "html").select(
        "page_id", "url", html.alias("html"), capture_key(F.col("url")).alias("key"), F.sha2(html, 256).alias("digest"))
    firsts = (told.where(F.octet_length("html") >= least).groupBy("digest")
              .agg(F.count(F.lit(1)).alias("_n"), F.min("page_id").alias("first_id"), F.min(F.struct(F.col("page_id").isNull(), "page_id", "url")).alias("_f"))
              .where("_n > 1").select("digest", "first_id", F.col("_f.url").alias("first_url")))
    firsts = materialize(firsts, "warc-firsts")
    firsts = F.broadcast(firsts) if firsts.count() <= BROADCAST_FIRSTS else firsts
    return told.join(firsts, "digest", "left").select("page_id", "url", "html", "key", "digest", "first_id", "first_url", F.expr(
        "first_id is not null and not (page_id <=> first_id)").alias("revisit"))


def write_archives(pages: DataFrame, root: str, least: int = LEAST_SHARED, level: int = LEVEL) -> DataFrame:
    """Write every page into archives under `root`; returns the captures, one row a record (CAPTURE).

    A task writes files of names of its own and its captures are written with them, so what a lost
    task leaves is never referred to.
    """
    schema = arrow_schema(CAPTURE)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = opened(root)
        fs.create_dir(folder, recursive=True)
        out = path = None
        try:
            for batch in batches:
                for piece in parts([batch], 2):
                    lines = []
                    for r in piece.to_pylist():
                        if out is None or out.tell() > ARCHIVE_BYTES:
                            if out is not None:
                                out.close()
                            path = f"{uuid.uuid4().hex}.warc.gz"
                            out = fs.open_output_stream(f"{folder}/{path}", compression=None)
                            info = block("", [("software", "barlab"), ("format", "WARC File Format 1.1")])[2:]
                            out.write(gzipped(block("WARC/1.1", [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", DATE),
                                                                 ("Content-Type", "application/warc-fields"), ("Content-Length", len(info))]) + info + b"\r\n\r\n", level))
                        at, payload = out.tell(), r["html"].encode()
                        data = gzipped(record(r["page_id"], r["url"], payload, r["digest"], r["first_id"], r["first_url"], r["revisit"]), level)
                        out.write(data)
                        lines.append({"key": r["key"], "page_id": r["page_id"], "url": r["url"], "record_type": "revisit" if r["revisit"] else "response",
                                      "digest": r["digest"], "file": path, "offset": at, "length": len(data)})
                    if lines:
                        yield pa.RecordBatch.from_pylist(lines, schema=schema)
        finally:
            if out is not None:
                out.close()

    return materialize(with_firsts(pages, least).mapInArrow(write, CAPTURE), "warc-captures")


# ---- index ---------------------------------------------------------------------------------

def line_of(r: dict) -> str:
    """What a capture's line holds beside its key."""
    return json.dumps([r["page_id"], r["url"], r["record_type"], r["digest"], r["file"], r["offset"], r["length"]], ensure_ascii=False, separators=(",", ":"))


def index_file(rows: list[tuple[str, str]], lines: int = BLOCK_LINES) -> bytes:
    """Sorted (key, capture) as compressed blocks, their directory and where it starts."""
    data, directory = bytearray(), []
    for at in range(0, len(rows), lines):
        packed = zlib.compress(json.dumps(rows[at:at + lines], ensure_ascii=False).encode())
        directory.append((rows[at][0], len(data), len(packed)))
        data += packed
    start = len(data)
    data += zlib.compress(json.dumps(directory, ensure_ascii=False).encode())
    return bytes(data) + start.to_bytes(8, "big")


def write_index(captures: DataFrame, root: str, lines: int = INDEX_LINES, files: int = INDEX_FILES) -> DataFrame:
    """Sort the captures into index files under `root`; returns their bounds (INDEX), at most `files` rows.

    Captures of one URL, however many, are told apart by page and place and may fill several files.
    """
    schema = arrow_schema(INDEX)
    spark = captures.sparkSession
    n = min(files, max(spark.sparkContext.defaultParallelism, -(-captures.count() // lines)))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(r["key"], line_of(r)) for batch in batches for r in batch.to_pylist()]
        if rows:
            fs, folder = opened(root)
            fs.create_dir(folder, recursive=True)
            path, data = f"{uuid.uuid4().hex}.idx", index_file(rows)
            with fs.open_output_stream(f"{folder}/{path}", compression=None) as out:
                out.write(data)
            yield pa.RecordBatch.from_pylist([{"file": path, "first_key": rows[0][0], "last_key": rows[-1][0], "lines": len(rows), "size": len(data)}], schema=schema)

    order = ["key", "page_id", "file", "offset"]
    return materialize(captures.repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(write, INDEX), "warc-index")


class IndexFile:
    """One index file: its directory is read once, blocks as they are needed."""

    def __init__(self, fs: pafs.FileSystem, path: str, size: int):
        self.file = fs.open_input_file(path)
        start = int.from_bytes(self.file.read_at(8, size - 8), "big")
        self.directory = json.loads(zlib.decompress(self.file.read_at(size - 8 - start, start)))
        self.firsts = [d[0].encode() for d in self.directory]
        self.at, self.rows, self.keys = None, [], []

    def load(self, number: int) -> None:
        if number != self.at:
            _, offset, length = self.directory[number]
            self.rows = json.loads(zlib.decompress(self.file.read_at(length, offset)))
            self.keys = [r[0].encode() for r in self.rows]
            self.at = number

    def find(self, key: str) -> Iterator[list[str]]:
        """Captures of a key, block by block: from the last block that starts before it."""
        wanted = key.encode()
        for number in range(max(bisect_left(self.firsts, wanted) - 1, 0), bisect_right(self.firsts, wanted)):
            self.load(number)
            found = self.rows[bisect_left(self.keys, wanted):bisect_right(self.keys, wanted)]
            if found:
                yield [capture for _, capture in found]


def lookup(index: DataFrame, root: str, keys: DataFrame) -> DataFrame:
    """Captures (CAPTURE) of the wanted keys (column `key`; repeated and unknown keys are fine).

    Bounds of the index files are sorted as the files are; a key whose captures fill several files is
    looked up in each of them, by as many tasks.
    """
    bounds = [(r["first_key"].encode(), r["last_key"].encode(), r["file"], r["size"]) for r in
              index.orderBy("first_key", "last_key").collect()]  # INDEX_FILES rows at most
    firsts, lasts = [b[0] for b in bounds], [b[1] for b in bounds]
    schema = arrow_schema(CAPTURE)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(k, i) for k in batch.column(0).to_pylist() for i in range(bisect_left(lasts, k.encode()), bisect_right(firsts, k.encode()))]
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], pa.string()), pa.array([i for _, i in found], pa.int32())], ["key", "at"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = opened(root)
        at = held = None
        for batch in batches:
            out = []
            for key, number in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if number != at:
                    at, held = number, IndexFile(fs, f"{folder}/{bounds[number][2]}", bounds[number][3])
                for lines in held.find(key):
                    out += [dict(zip(schema.names, [key, *json.loads(line)])) for line in lines]
                    if len(out) > 5_000:
                        yield pa.RecordBatch.from_pylist(out, schema=schema)
                        out = []
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    wanted = keys.select(F.coalesce("key", F.lit("")).alias("key")).distinct()
    placed = wanted.mapInArrow(place, "key string, at int")
    if not bounds:
        return placed.sparkSession.createDataFrame([], CAPTURE)
    return placed.repartition(len(bounds), "at").sortWithinPartitions("at", "key").mapInArrow(search, CAPTURE)


def read_records(captures: DataFrame, root: str, payloads: bool = True) -> DataFrame:
    """Read the captures' ranges of the archives and parse them (RECORD; without payloads it is null).

    Ranges are put in the order of the files, so neighbours come with one read. A row is small but its
    record is not, so as many tasks read as there are chunks to read. A damaged record fails.
    """
    schema = arrow_schema(RECORD)
    captures = materialize(captures.select("file", "offset", "length"), "warc-ranges")
    tasks = max(captures.sparkSession.sparkContext.defaultParallelism, -(-(captures.agg(F.sum("length")).first()[0] or 0) // CHUNK))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = opened(root)
        name, file, start, held = None, None, 0, b""
        for batch in batches:
            out, size = [], 0
            for path, offset, length in zip(*[batch.column(c).to_pylist() for c in ("file", "offset", "length")]):
                if path != name:
                    if file is not None:
                        file.close()
                    name, file, start, held = path, fs.open_input_file(f"{folder}/{path}"), 0, b""
                if not start <= offset <= offset + length <= start + len(held):
                    start, held = offset, file.read_at(max(length, READ_AHEAD), offset)
                found = parsed(zlib.decompress(held[offset - start:offset - start + length], 31))
                size += found["payload_bytes"]
                out.append(found if payloads else found | {"payload": None})
                if payloads and size > 4_000_000:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
        if file is not None:
            file.close()

    return (captures.repartition(tasks, "file", F.expr(f"offset div {CHUNK // 4}L"))
            .sortWithinPartitions("file", "offset").mapInArrow(read, RECORD))


def fetch(index: DataFrame, root: str, urls: DataFrame) -> DataFrame:
    """page_id, url, payload of every capture of the wanted URLs; revisits are followed to their response.

    Every response that revisits refer to is looked up and read once.
    """
    found = materialize(read_records(lookup(index, root, urls.select(capture_key(F.col("url")).alias("key"))), root), "warc-found")
    again = found.where("record_type = 'revisit'")
    targets = read_records(lookup(index, root, again.select(capture_key(F.col("refers_url")).alias("key"))), root)
    targets = targets.where("record_type = 'response'").groupBy(F.col("page_id").alias("refers_to"), "payload_digest").agg(F.first("payload").alias("payload"))
    followed = again.drop("payload").join(targets, ["refers_to", "payload_digest"])
    return found.where("record_type = 'response'").select("page_id", "url", "payload").unionByName(followed.select("page_id", "url", "payload"))


def report(pages: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every page, as read back from
    archives by way of the index.

    Null html is an empty payload; payloads under LEAST_SHARED bytes are always responses. Of equal
    payloads the smallest page_id is the response (repeated rows of that page all are, and all rows if
    every id is null), the others, null ids among them, revisit it. Pages without a URL are captures of
    the empty key. An empty table has no archive and no row.
    """
    spark: SparkSession = pages.sparkSession
    root = scratch_path(spark, "warc")
    captures = write_archives(pages, root)
    index = write_index(captures, root)
    wanted = need(pages, "url").select(capture_key(F.col("url")).alias("key"))
    return read_records(lookup(index, root, wanted), root, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first_id FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to FROM f"""
