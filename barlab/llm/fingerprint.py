"""Homomorphic multiset fingerprints of documents. Main path: DataFrame functions only.

A paragraph (a piece between line breaks) is hashed to a wide vector; the vectors of a text are summed
lane by lane modulo powers of two. Order does not matter, and a paragraph can be put in or taken out
by adding or subtracting its vector. Lanes:

    1       number of sentences, modulo 2^32
    8       SHA-256 of the paragraph in 32-bit parts, each modulo 2^32: equality
    40      for each sentence of the paragraph 120 hash bits, summed in three 20-bit fields a lane, the
            lane modulo 2^60: likeness. Read as signs +1 and -1, products of these sums estimate how much
            two multisets share.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from barlab.llm.common import need

ROWS_PER_BUCKET = 8192
MOST_BUCKETS = 20_000  # one row a bucket is broadcast: half a megabyte at most
PACK = 20  # bits of a field
FIELDS = (1 << 40) + (1 << 20) + 1
LOW60, LOW32, LOW20 = (1 << 60) - 1, (1 << 32) - 1, (1 << 20) - 1


def _number(hexed: Column, start: int, size: int) -> Column:
    return F.conv(F.substring(hexed, start, size), 16, 10).cast("bigint")


def _total(values: Column, pick, mask: int) -> Column:
    """Sum modulo a power of two, never beyond a long."""
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda acc, v: (acc + pick(v)).bitwiseAND(F.lit(mask)))


def with_vector(df: DataFrame, text: Column, name: str) -> DataFrame:
    """Adds the fingerprint of a text as an array of 49 longs; null counts as empty."""
    full = F.coalesce(text, F.lit(""))
    out = df.withColumns({f"{name}_s": F.transform(F.filter(F.split(full, r"[.!?\n][ \n]*"), lambda s: s != ""), lambda s: F.sha2(s, 256)),
                          f"{name}_p": F.transform(F.split(full, "\n"), lambda p: F.sha2(p, 256))})
    out = out.withColumns({f"{name}_a": F.transform(f"{name}_s", lambda h: _number(h, 1, 15)),
                           f"{name}_b": F.transform(f"{name}_s", lambda h: _number(h, 16, 15))})
    lanes = [F.size(f"{name}_s").cast("bigint")]
    lanes += [_total(F.col(f"{name}_p"), lambda h, i=i: _number(h, 1 + 8 * i, 8), LOW32) for i in range(8)]
    lanes += [_total(F.col(f"{name}_{side}"), lambda v, i=i: F.shiftright(v, i).bitwiseAND(F.lit(FIELDS)), LOW60)
              for side in "ab" for i in range(PACK)]
    return out.withColumn(name, F.array(*lanes)).drop(*[f"{name}_{x}" for x in "spab"])


def as_text(vector: Column) -> Column:
    return F.array_join(F.transform(vector, lambda v: F.lpad(F.lower(F.hex(v)), 15, "0")), "")


def signs(vector: Column) -> Column:
    """The 120 sums of +1 and -1."""
    ones = F.flatten(F.transform(F.slice(vector, 10, 40), lambda v: F.array(*[F.shiftright(v, k * PACK).bitwiseAND(F.lit(LOW20)) for k in range(3)])))
    return F.transform(ones, lambda x: 2 * x - F.element_at(vector, 1))


def with_likeness(df: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """2 a.b / (a.a + b.b) over the sign sums, kept within 0 and 1; equal vectors give 1."""
    out = df.withColumns({f"{name}_x": signs(F.col(a)), f"{name}_y": signs(F.col(b))})
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0).cast("bigint"), lambda s, v: s + v)
    x, y = F.col(f"{name}_x"), F.col(f"{name}_y")
    both = dot(x, x) + dot(y, y)
    value = F.when(F.col(a) == F.col(b), F.lit(1.0)).when(both == 0, F.lit(0.0)).otherwise(
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2 * dot(x, y) / both)))
    return out.withColumn(name, F.round(value, 6)).drop(f"{name}_x", f"{name}_y")


def _range_of(value: Column, cuts: list[int]) -> Column:
    """How many of the sorted cuts lie at or below a value, by binary search; 0 for null."""
    if not cuts:
        return F.lit(0).cast("bigint")
    bounds = F.array(*[F.lit(c).cast("bigint") for c in cuts]) if len(cuts) < 100 else F.from_json(F.lit(str(cuts)), "array<bigint>")
    steps = F.sequence(F.lit(1), F.lit(len(cuts).bit_length()))

    def halve(at: Column, _: Column) -> Column:
        middle = F.shiftright(at["low"] + at["high"], 1)
        below = (at["low"] < at["high"]) & (F.get(bounds, middle) <= value)
        return F.struct(F.when(below, middle + 1).otherwise(at["low"]).alias("low"),
                        F.when(below | (at["low"] >= at["high"]), at["high"]).otherwise(middle).alias("high"))

    found = F.aggregate(steps, F.struct(F.lit(0).alias("low"), F.lit(len(cuts)).alias("high")), halve)["low"]
    return F.when(value.isNull(), F.lit(0)).otherwise(found).cast("bigint")


def with_next(rows: DataFrame, carry: list[str], prepare=lambda df: df) -> DataFrame:
    """Adds next_<c> of the following row in descending doc_id; after the last comes the first.

    Ids are cut into ranges at their quantiles, so that a range holds about equally many however the ids
    are spread, and each range is sorted on its own. The first row of a range is copied behind
    the range above, so that every range knows its follower; `prepare` adds columns to all rows after
    that. Equal ids share a range and are ordered by text, null ids come last.
    """
    n = rows.count()
    buckets = max(1, min(MOST_BUCKETS, n // ROWS_PER_BUCKET))
    share = [i / buckets for i in range(1, buckets)]
    cuts = rows.agg(F.percentile_approx("doc_id", share, max(10_000, 10 * buckets))).first()[0] if share else None
    bucket = _range_of(F.col("doc_id"), sorted(set(cuts or [])))
    placed = rows.withColumn("__bucket", bucket).withColumn("__copy", F.lit(0))
    ids = rows.select("doc_id").withColumn("__bucket", bucket)
    # one row a range; the range below the first is the last
    heads = ids.groupBy("__bucket").agg(F.max("doc_id").alias("__head"))
    up = F.lead("__bucket").over(Window.orderBy("__bucket"))
    lowest = F.min("__bucket").over(Window.partitionBy())
    heads = heads.select("__head", F.coalesce(up, lowest).alias("__to"), F.when(up.isNull(), 2).otherwise(1).alias("__kind"))
    copies = rows.join(F.broadcast(heads), F.col("doc_id").eqNullSafe(F.col("__head"))).select(
        *rows.columns, F.col("__to").alias("__bucket"), F.col("__kind").alias("__copy"))
    order = Window.partitionBy("__bucket").orderBy(F.col("__copy") == 2, F.col("doc_id").desc_nulls_last(), F.col("text"))
    lined = prepare(placed.unionByName(copies)).withColumns({f"next_{c}": F.lead(c).over(order) for c in carry})
    return lined.where("__copy = 0").drop("__bucket", "__copy")


def report(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likenesses.

    Null text counts as empty: n_chars 0, the fingerprint of one empty paragraph. Repeated rows give
    repeated results. A single document is its own next one. An empty table gives no rows.
    """
    rows = need(docs, "doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    got = with_next(rows, ["text", "__v"], lambda df: with_vector(df, F.col("text"), "__v"))
    got = got.withColumn("n_chars", F.length("text").cast("bigint")).withColumn("__half", F.floor(F.col("n_chars") / 2).cast("int"))
    got = got.withColumn("__edited", F.expr("concat(left(text, int(n_chars) - __half), left(next_text, __half))"))
    got = with_vector(got, F.col("__edited"), "__w")
    got = with_likeness(with_likeness(got, "__v", "__w", "near_edited"), "__v", "next___v", "near_next")
    return got.select("doc_id", "n_chars", F.sha2("__edited", 256).alias("edited_sha256"), as_text(F.col("__v")).alias("fingerprint"),
                      as_text(F.col("__w")).alias("edited_fingerprint"), "near_edited", "near_next")


def _oracle() -> str:
    vector = r"""list_concat([CAST(len(S) AS BIGINT)],
      list_transform(range(0, 8), lambda i: CAST(coalesce(list_sum(list_transform(P, lambda h: CAST('0x' || substr(h, CAST(1 + 8 * i AS BIGINT), 8) AS BIGINT))), 0) % 4294967296 AS BIGINT)),
      list_transform(range(0, 20), lambda i: CAST(coalesce(list_sum(list_transform(S, lambda h: (CAST('0x' || substr(h, 1, 15) AS BIGINT) >> i) & 1099512676353)), 0) % 1152921504606846976 AS BIGINT)),
      list_transform(range(0, 20), lambda i: CAST(coalesce(list_sum(list_transform(S, lambda h: (CAST('0x' || substr(h, 16, 15) AS BIGINT) >> i) & 1099512676353)), 0) % 1152921504606846976 AS BIGINT)))"""
    cut = r"""list_transform(list_filter(regexp_split_to_array(T, '[.!?\n][ \n]*'), lambda s: s <> ''), lambda s: sha256(s)) AS S,
      list_transform(string_split(T, chr(10)), lambda p: sha256(p)) AS P"""
    of = lambda col, frm: f"SELECT * EXCLUDE (S, P), {vector} AS V{col} FROM (SELECT *, {cut.replace('T,', col + ',')} FROM {frm})"
    sign = lambda v: f"list_transform(flatten(list_transform({v}[10:49], lambda x: [x & 1048575, (x >> 20) & 1048575, (x >> 40) & 1048575])), lambda x: 2 * x - {v}[1])"
    near = lambda a, b, x, y: (f"round(CASE WHEN {a} = {b} THEN 1.0 WHEN list_dot_product({x}, {x}) + list_dot_product({y}, {y}) = 0 THEN 0.0 ELSE "  # noqa: E731
                               f"greatest(0.0, least(1.0, 2 * list_dot_product({x}, {y}) / (list_dot_product({x}, {x}) + list_dot_product({y}, {y})))) END, 6)")
    text = lambda v: f"array_to_string(list_transform({v}, lambda x: lpad(lower(to_hex(x)), 15, '0')), '')"
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    v AS ({of('t', 'd')}),
    n AS (SELECT *, coalesce(lead(t) OVER w, first_value(t) OVER w) AS nt, coalesce(lead(Vt) OVER w, first_value(Vt) OVER w) AS vn, length(t) AS n_chars FROM v WINDOW w AS (ORDER BY doc_id DESC)),
    e AS (SELECT *, concat(left(t, n_chars - n_chars // 2), left(nt, n_chars // 2)) AS e FROM n),
    f AS ({of('e', 'e')}),
    g AS (SELECT *, CAST({sign('Vt')} AS DOUBLE[]) AS x, CAST({sign('Ve')} AS DOUBLE[]) AS y, CAST({sign('vn')} AS DOUBLE[]) AS z FROM f)
    SELECT doc_id, CAST(n_chars AS BIGINT) AS n_chars, sha256(e) AS edited_sha256, {text('Vt')} AS fingerprint, {text('Ve')} AS edited_fingerprint,
    {near('Vt', 'Ve', 'x', 'y')} AS near_edited, {near('Vt', 'vn', 'x', 'z')} AS near_next FROM g"""


ORACLE = _oracle()
