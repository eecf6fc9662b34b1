"""Divergence of sources by their terms, ranked over cells of equal counts.

What a term is worth in a group depends only on how often it occurs in the group and in its language,
so terms are counted into cells of equal counts first. The measure is taken once a cell, cells of
equal value are merged, the best values are found by how many terms lie in them, and only their terms
are looked up and put in order.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from barlab.llm.common import UPPER, need
from barlab.session import materialize

# Fixed value: ASCII without letters.
NOT_TERM = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
LEAST_DOCUMENTS = 10
TOP = 10
# Broadcast up to so many rows of about 100 bytes: groups, and chosen cells.
BROADCAST_ROWS = 100_000


def sized(df: DataFrame, label: str) -> DataFrame:
    """A small table, written and counted; broadcast only if it is small indeed."""
    kept = materialize(df, label)
    return F.broadcast(kept) if kept.count() <= BROADCAST_ROWS else kept


def share(count: str, total: str, terms: str) -> Column:
    """Smoothed share of a term in billionths, exact: the product outgrows 64 bits, the quotient does not."""
    return F.expr(f"1 + (cast(1000000000 AS decimal(10,0)) * cast({count} + 2 AS decimal(20,0))) div ({total} + 2 * {terms})")


def measure(p: str, q: str) -> str:
    """The measure of two shares; both lie under 1.1 x 10^9, so the square fits 64 bits."""
    return f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})"


def count_terms(docs: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """(lang, source, term, c, total, lead) of the terms that a language keeps.

    c counts occurrences in the group, total in the language; lead marks one row of each (lang, term).
    Every document gives each of its terms once more, marked, to count documents by.
    """
    lowered = F.translate(F.col("text"), UPPER, UPPER.lower())
    split = docs.select("lang", "source", F.split(lowered, NOT_TERM).alias("all"))
    lists = split.select("lang", "source", F.explode(F.array(
        F.struct(F.lit(0).alias("d"), F.col("all").alias("terms")),
        F.struct(F.lit(1).alias("d"), F.array_distinct("all").alias("terms")))).alias("l"))
    each = lists.select("lang", "source", "l.d", F.explode("l.terms").alias("term")).where("term <> ''")
    counts = each.groupBy("lang", "source", "term").agg(F.sum(1 - F.col("d")).alias("c"), F.sum("d").alias("docs"))
    term = Window.partitionBy("lang", "term")  # at most one row a source
    return (counts.select("*", F.sum("docs").over(term).alias("_docs"), F.sum("c").over(term).alias("total"),
                          F.min("source").over(term).alias("_first"))
            .where(F.col("_docs") >= least).select("lang", "source", "term", "c", "total", (F.col("source") == F.col("_first")).alias("lead")))


def best_terms(kept: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    """Ranks to `top` of the terms that a group holds beyond their share in the language."""
    cells = kept.groupBy("lang", "source", "c", "total").agg(F.count(F.lit(1)).alias("terms"))
    cells = cells.join(groups, ["lang", "source"]).select(
        "lang", "source", "c", "total", "terms", share("c", "n", "v").alias("p"), share("total", "lang_n", "v").alias("q"))
    cells = materialize(cells.where("p > q").select("lang", "source", "c", "total", "terms", F.expr(measure("p", "q")).alias("value")), "term-cells")
    # every value has a term at least, so the best `top` values hold the best `top` terms
    down = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    values = (cells.groupBy("lang", "source", "value").agg(F.sum("terms").alias("terms"))
              .withColumn("_r", F.row_number().over(down)).where(F.col("_r") <= top)
              .withColumn("before", F.coalesce(F.sum("terms").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .where(F.col("before") < top).drop("_r", "terms"))
    chosen = sized(cells.join(values, ["lang", "source", "value"]).drop("terms"), "term-values")
    inside = Window.partitionBy("lang", "source", "value").orderBy("term")
    return (kept.join(chosen, ["lang", "source", "c", "total"])
            .withColumn("_r", F.row_number().over(inside)).where(F.col("_r") <= top)
            .withColumn("rank", (F.col("before") + F.col("_r")).cast("int")).where(F.col("rank") <= top)
            .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank"))


def compared(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """Every other source of a language with the measure summed over all kept terms.

    A term that neither holds is worth the same in a pair, one that a single side holds depends on its
    count there alone: both are taken from cells. Only terms that two sources share are met one by
    one, as what they add to that.
    """
    zero = share("0L", "n", "v")
    sides = groups.select("lang", "source", "n", "v", F.when(F.col("v") > 0, zero).alias("z"))
    other = sides.select("lang", F.col("source").alias("item"), F.col("z").alias("oz"))
    base = sides.join(other, "lang").where("source <> item").select(
        "lang", "source", "item", F.expr(f"coalesce(v * ({measure('z', 'oz')}), 0L)").alias("value"))

    alone = kept.groupBy("lang", "source", "c").agg(F.count(F.lit(1)).alias("terms"))
    alone = alone.join(sides, ["lang", "source"]).select("lang", "source", "terms", "z", share("c", "n", "v").alias("p"))
    alone = alone.join(other, "lang").where("source <> item").select(
        "lang", "source", "item", F.expr(f"terms * ({measure('p', 'oz')} - {measure('z', 'oz')})").alias("value"))
    alone = alone.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))

    shares = kept.join(sides, ["lang", "source"]).select("lang", "term", "source", "z", share("c", "n", "v").alias("p"))
    terms = shares.groupBy("lang", "term").agg(F.array_sort(F.collect_list(F.struct("source", "p", "z"))).alias("by")).where("size(by) > 1")
    pairs = terms.select("lang", F.posexplode("by").alias("at", "a"), "by").select(
        "lang", "a", F.explode(F.expr("slice(by, at + 2, size(by))")).alias("b"))
    both = pairs.select("lang", F.col("a.source").alias("source"), F.col("b.source").alias("item"), F.expr(
        f"{measure('a.p', 'b.p')} - {measure('a.p', 'b.z')} - {measure('a.z', 'b.p')} + {measure('a.z', 'b.z')}").alias("value"))
    both = both.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))

    halves = alone.unionByName(both)
    turned = halves.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")
    summed = base.unionByName(halves).unionByName(turned).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    place = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.col("item"))  # one row a source
    return summed.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(place).alias("rank"))


def audit(docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank: see best_terms (part `term`) and compared (part `pair`).

    Null text, lang and source read as ''; repeated rows count as documents of their own. A language
    keeps the terms of `least` documents or more; if it keeps none, its pairs are worth 0 and it has no
    terms. A single source of a language has no pair; an empty table gives nothing. Equal values are
    ordered by the item's bytes. The number of sources of a language sets the size of the result
    (every pair is in it) and of what is held for a term; documents and terms are unbounded.
    """
    base = need(docs, "text", "lang", "source").select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    kept = materialize(count_terms(base, least), "kept-terms")
    own = kept.groupBy("lang", "source").agg(F.sum("c").alias("n"), F.sum(F.col("lead").cast("bigint")).alias("_lead"))
    langs = own.groupBy("lang").agg(F.sum("n").alias("lang_n"), F.sum("_lead").alias("v"))
    groups = base.select("lang", "source").distinct().join(own.drop("_lead"), ["lang", "source"], "left").join(langs, "lang", "left")
    groups = sized(groups.select("lang", "source", *[F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c) for c in ("n", "lang_n", "v")]), "term-groups")
    return compared(kept, groups).unionByName(best_terms(kept, groups, top))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
t AS (SELECT k, lang, source, unnest(ts) AS term FROM d),
keep AS (SELECT lang, term, count(*) AS total FROM t GROUP BY 1, 2 HAVING count(DISTINCT k) >= 10),
g AS (SELECT DISTINCT lang, source FROM d),
full_counts AS (SELECT g.lang, g.source, keep.term, total, coalesce(c, 0) AS c FROM g JOIN keep USING (lang)
  LEFT JOIN (SELECT lang, source, term, count(*) AS c FROM t GROUP BY 1, 2, 3) USING (lang, source, term)),
n AS (SELECT lang, source, sum(c) AS n, count(*) AS v FROM full_counts GROUP BY 1, 2),
ln AS (SELECT lang, sum(total) AS n FROM keep GROUP BY 1),
p AS (SELECT lang, source, term, c, CAST(1 + (1000000000::HUGEINT * (c + 2)) // (n.n + 2 * n.v) AS BIGINT) AS p,
  CAST(1 + (1000000000::HUGEINT * (total + 2)) // (ln.n + 2 * n.v) AS BIGINT) AS q
  FROM full_counts JOIN n USING (lang, source) JOIN ln USING (lang)),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE c > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(row_number() OVER w AS INTEGER) AS rank FROM every
WINDOW w AS (PARTITION BY lang, source, part ORDER BY value DESC, item) QUALIFY part = 'pair' OR rank <= 10"""
