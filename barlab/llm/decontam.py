"""Benchmark decontamination by a broadcast set of normalised word windows.

Main path: DataFrame functions only.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from barlab.llm.common import NOT_WORD, free_name, need, words

WINDOW = 10
# A window row costs about 200 bytes when broadcast (hash, text, item names).
BROADCAST_WINDOWS = 200_000
# Rows are told apart by id and text; a null id is a value of its own.


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(hash, size, window, items): every distinct word window of the items.

    An item of fewer words than a window, but not none, is one window. Items without words or with
    null text give none; a null item_id marks its words but cannot be named. Repeated items count
    once.
    """
    items = need(benchmark, "item_id", "text").select("item_id", words(F.col("text")).alias("w")).where("size(w) > 0")
    each = items.select("item_id", "w", F.least(F.lit(window), F.size("w")).alias("size")).select(
        "item_id", "w", "size", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("size") + 1)).alias("at"))
    each = each.select("item_id", "size", F.slice("w", F.col("at"), F.col("size")).alias("part"))
    each = each.select("item_id", "size", F.xxhash64("part").alias("hash"), F.array_join("part", " ").alias("window"))
    return each.groupBy("hash", "size", "window").agg(F.collect_set(F.col("item_id").cast("string")).alias("items"))


def find_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Each document with its words and the verified windows that occur in it.

    Returns doc_id, text, __w (words) and __hits (array of pos, size, window, items; pos from 0).
    Null and empty texts have no words and no hits; rows with equal doc_id stay apart by their
    text; a null doc_id is a value like any other. An empty benchmark hits nothing.

    The windows are broadcast if they are at most BROADCAST_WINDOWS rows; a larger set is joined by
    hash, and adaptive execution splits a window that very many documents hold.
    """
    found = item_windows(benchmark, window).withColumnRenamed("size", "len")
    sizes = {r["len"]: r["n"] for r in found.groupBy("len").agg(F.count("*").alias("n")).collect()}  # `window` rows at most
    small = sum(sizes.values()) <= BROADCAST_WINDOWS
    base = need(docs, "doc_id", "text").withColumn("__th", F.xxhash64("text"))
    cut = base.select("doc_id", "__th", words(F.col("text")).alias("__w"))
    hits = None
    for size in sorted(sizes):
        grams = cut.where(F.size("__w") >= size).select("doc_id", "__th", F.posexplode(F.transform(
            F.sequence(F.lit(1), F.size("__w") - size + 1), lambda i: F.xxhash64(F.slice("__w", i, size)))).alias("pos", "hash"))
        side = found.where(F.col("len") == size)
        one = grams.join(F.broadcast(side) if small else side, "hash")
        hits = one if hits is None else hits.unionByName(one)
    if hits is None:
        none = "array<struct<pos:int,len:int,window:string,items:array<string>>>"
        return base.select("doc_id", "text", words(F.col("text")).alias("__w"), F.array().cast(none).alias("__hits"))
    hits = hits.groupBy(F.col("doc_id").alias("__id"), F.col("__th").alias("__ih")).agg(
        F.collect_set(F.struct("pos", "len", "window", "items")).alias("__hits"))
    joined = base.join(hits, F.expr("doc_id <=> __id and __th = __ih"), "left").select("doc_id", "text", words(F.col("text")).alias("__w"), "__hits")
    real = F.filter(F.coalesce("__hits", F.array()),
                    lambda h: F.array_join(F.slice("__w", h["pos"] + 1, h["len"]), " ") == h["window"])
    return joined.withColumn("__hits", real)


def covered(hits: Column) -> Column:
    """Distinct word positions that the hits cover, from 0."""
    return F.array_distinct(F.flatten(F.transform(hits, lambda h: F.sequence(h["pos"], h["pos"] + h["len"] - 1))))


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: n_words, n_hit, n_items, items_sha256, contaminated (see find_hits)."""
    items = F.array_sort(F.array_distinct(F.flatten(F.transform("__hits", lambda h: h["items"]))))
    got = find_hits(docs, benchmark, window).select(
        "doc_id", F.size("__w").cast("bigint").alias("n_words"), F.size(covered(F.col("__hits"))).cast("bigint").alias("n_hit"),
        items.alias("__items"))
    return got.select("doc_id", "n_words", "n_hit", F.size("__items").cast("bigint").alias("n_items"),
                      F.sha2(F.array_join("__items", ","), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))


def remove_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without their hit words; a document of which no word is left goes.

    All columns stay; only `text` changes, and only where something was hit (n_chars, if there, is
    left as the source's figure). A hit word goes with the separator after it.
    """
    found = find_hits(docs, benchmark, window)
    th, id_, ih, new, was = (free_name(docs, n) for n in ("__th", "__id", "__ih", "__new", "__hit"))
    hit = found.where(F.size("__hits") > 0).select(
        "doc_id", F.xxhash64("text").alias("__th"), F.col("text").alias("__text"), covered(F.col("__hits")).alias("__gone")).distinct()
    lead = F.regexp_extract("__text", f"^{NOT_WORD_CASED}", 0)
    parts = F.regexp_extract_all("__text", F.lit(f"{WORD_CASED}(?:{NOT_WORD_CASED})?"), F.lit(0))
    kept = F.filter(parts, lambda p, i: ~F.array_contains("__gone", i))
    hit = hit.select(F.col("doc_id").alias(id_), F.col("__th").alias(ih), F.when(F.size(kept) > 0, F.concat(lead, F.array_join(kept, ""))).alias(new),
                     F.lit(True).alias(was))
    base = docs.select(*[F.col(f"`{c}`") for c in docs.columns], F.xxhash64("text").alias(th))
    both = base.join(hit, F.col("doc_id").eqNullSafe(F.col(id_)) & (F.col(th) == F.col(ih)), "left").where(F.col(was).isNull() | F.col(new).isNotNull())
    text = F.when(F.col(was), F.col(new)).otherwise(F.col("text"))
    return both.select(*[text.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns])


# The same classes before lowering: capitals belong to words.
NOT_WORD_CASED = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORD_CASED = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

ORACLE = r"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM documents),
b AS (SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM benchmark),
bw AS (SELECT DISTINCT item_id, size, array_to_string(list_slice(ws, i, i + size - 1), ' ') AS win FROM
  (SELECT item_id, ws, least(10, len(ws)) AS size, unnest(generate_series(1, len(ws) - least(10, len(ws)) + 1)) AS i FROM b WHERE len(ws) > 0)),
dw AS (SELECT doc_id, i, size, array_to_string(list_slice(ws, i, i + size - 1), ' ') AS win FROM
  (SELECT doc_id, ws, size, unnest(generate_series(1, len(ws) - size + 1)) AS i FROM w, (SELECT DISTINCT size FROM bw) WHERE len(ws) >= size)),
hits AS (SELECT dw.doc_id, dw.i, dw.size, bw.item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.size = bw.size),
cov AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + size - 1)) AS p FROM hits) GROUP BY 1),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM
  (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY 1)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN cov USING (doc_id) LEFT JOIN its USING (doc_id)"""
