"""Small helpers that the operators share."""
from __future__ import annotations

import ctypes
import gc
import math
from bisect import bisect_left
from collections.abc import Callable, Iterator
from itertools import count

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Fixed value: everything in ASCII that is neither a digit nor a lower-case letter.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def need(df: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, so that whatever else a table holds cannot clash."""
    return df.select(*[F.col(f"`{c}`") for c in columns])


def free_name(df: DataFrame, wish: str) -> str:
    """A column name that the table does not use yet."""
    taken = {c.lower() for c in df.columns}
    return next(n for n in (f"{wish}{i or ''}" for i in count()) if n.lower() not in taken)


def words(text: Column) -> Column:
    """Words of a text: A-Z lowered, cut at every other ASCII sign; null has none."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())
    return F.filter(F.split(lowered, NOT_WORD), lambda w: w != "")


def map_rows(df: DataFrame, make: Callable[[], Callable[[list[dict]], list[dict]]], schema: str) -> DataFrame:
    """Run a function over Arrow batches given as lists of rows.

    `make` builds what a task needs once; its result turns one batch of rows into new rows.
    """
    df_text = df.columns.index("text") if "text" in df.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in parts(batches, df_text) if df_text is not None else batches:
            out = step(batch.to_pylist())
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))
    return df.mapInArrow(lean(run), schema)


def runs(sizes: list[int], most: int):
    """(start, end) of runs of texts, given by their sizes, of about `most`; a larger one is a run of its own."""
    at = 0
    while at < len(sizes):
        end, size = at, 0
        while end < len(sizes) and (end == at or size + sizes[end] <= most):
            size += sizes[end]
            end += 1
        yield at, end
        at = end


def parts(batches: Iterator[pa.RecordBatch], text: int = 1, most: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """The batches cut into pieces of about `most` bytes of the text column, so that what Python holds at once
    does not depend on how many rows a batch has."""
    for batch in batches:
        sizes = [n or 0 for n in pc.binary_length(batch.column(text)).to_pylist()]
        for at, end in runs(sizes, most):
            yield batch.slice(at, end - at)


def split_by_bytes(total_bytes: int, each: int, least: int = 1) -> int:
    """Into how many parts some bytes go, if a part is to hold about `each`."""
    return max(least, math.ceil(total_bytes / each))



def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function over batches that gives its spare memory back when a task is done: the worker process
    stays, and what it held would be missing in the stages that follow."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):  # not this C library
                pass

    return task


def hash_below(column: str, share: float) -> Column:
    """Whether the hash of a column lies in a share of all hashes, in steps of 2 ** -64."""
    if share >= 1:
        return F.lit(True)
    return F.xxhash64(column) < F.lit(int(share * 2.0 ** 64) - 2 ** 63)


def clear_of(spans: list[tuple[int, int]], taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans that overlap none of those taken, in their order."""
    ends: list[int] = []
    starts: list[int] = []
    for s, e in sorted(taken):
        if ends and s <= ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)
    out = []
    for s, e in spans:
        i = bisect_left(starts, e) - 1  # the last one that begins before this ends
        if i < 0 or ends[i] <= s:
            out.append((s, e))
    return out


PIECE = 16_384  # code points


def sampled_pieces(rows: DataFrame, chars: int) -> DataFrame:
    """(g, piece): of each group g distinct pieces of its texts, about `chars` characters and at least one piece.

    rows: g, text. Texts are cut into pieces, so one long text is not taken or left as a whole, and equal
    pieces count once, so copies do not fill the sample. A piece's level is the number of zeros its hash
    begins with, which halves what is left with every step: per group the level is taken down until
    about twice the wanted characters are there, and of these the smallest hashes up to `chars` stay.
    """
    cut = F.expr(f"transform(sequence(0, (char_length(text) - 1) div {PIECE}), i -> substring(text, i * {PIECE} + 1, {PIECE}))")
    pieces = rows.select("g", F.explode(cut).alias("piece")).where("piece <> ''").withColumn("h", F.xxhash64("piece"))
    pieces = pieces.withColumn("level", 64 - F.length(F.bin("h")))
    found = pieces.groupBy("g", "level").agg(F.approx_count_distinct("h").alias("n"), F.avg(F.length("piece")).alias("size")).collect()  # 64 rows a group
    least: dict[str, int] = {}
    room: dict[str, float] = {}
    for r in sorted(found, key=lambda r: -r["level"]):
        if room.setdefault(r["g"], 2.0 * chars) > 0:
            room[r["g"]] -= r["n"] * r["size"]
            least[r["g"]] = r["level"]
    if not least:
        return pieces.select("g", "piece").limit(0)
    wanted = F.element_at(F.create_map(*[F.lit(x) for pair in least.items() for x in pair]), F.col("g"))
    some = pieces.where(F.col("level") >= wanted).dropDuplicates(["g", "piece"])
    before = F.sum(F.length("piece")).over(Window.partitionBy("g").orderBy("h", "piece").rowsBetween(Window.unboundedPreceding, -1))  # a few times `chars`
    return some.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < chars).select("g", "piece")
