"""Index changes out of the text of announcements.

A document is one row (file, text) and stays one while it is parsed: headings, actions and rows are
found inside the array of its lines, so nothing is exchanged between documents. White space and
digits are those of Unicode text.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from barlab.functions.temporal import release_date_text
from barlab.functions.text import strip, unicode_pattern as U

# Line shapes of the announcements, and what ends a line.
LINE_ENDS = r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x85\u2028\u2029]"
INDEX_NUMBER = "500"  # in every heading and table row of the index
INDEX_HEADING = r"(?i)^\s*(?:\d{1,2}|[A-Za-z])[\.\)]\s*(?:S&P\s+)?(?:CNX\s+|NIFTY\s*)500(?:\s+Index)?\s*:?\s*$"
ANY_HEADING = r"^\s*(?:\d{1,2}|[A-Za-z])[\.\)]\s+\S"
EFFECTIVE_PHRASE = r"(?i)(?:effective\s+from|w\.?e\.?f\.?|with\s+effect\s+from)[:\s]+(?:\w+day,?\s+)?([A-Z][a-z]+\.?\s+\d{1,2}(?:st|nd|rd|th)?\s*,?\s*\d{4}|\d{1,2}(?:st|nd|rd|th)?\s+[A-Z][a-z]+\.?,?\s+\d{4})"
COMPANY_ROW = r"^(\d{1,3})\s+(.+?)\s+([A-Z0-9][A-Z0-9&\-]*)\s*$"
NUMBERED_ROW = r"^\d{1,3}\s+\S"
NAME_ENDING = r"\b(Ltd|Limited|Co|Corp|Company|Inc|India)\.?$"
REMARK_ROW = r"(?i)^(?:(.+?)\s+)?([A-Z0-9][A-Z0-9&\-]*)\s+(Inclusion|Exclusion)(\s+revoked)?\*{0,2}\s*$"
INDEX_ROW = r"(?i)^(?:\d{1,2}\s+)?(?:S&P\s+)?(?:CNX\s+|NIFTY\s*)500(?:\s+Index)?\s*$"
NEXT_INDEX = r"^\d{1,2}\s+\S"
ACTION_WORDS = (r"(?i)\b(?:being|are|is)\s+(excluded|included)\b|\b(excluded|included)\s*:?\s*$"
                r"|following.*?(excluded|included)")
RELEASE_FILE = r"ind_prs(\d{8})"
OPENING_LINES = 40

SECTION, TABLE = "SECTION", "TABLE"


def kept_lines(documents: DataFrame) -> DataFrame:
    """Non-empty lines of every document, as an array per document."""
    return documents.select("file", F.filter(F.split("text", LINE_ENDS), lambda l: strip(l) != "").alias("lines"))


def _marks(value: Callable[[Column], Column]) -> Column:
    """Places of the lines for which a value is given."""
    return F.filter(F.transform("lines", lambda l, i: F.struct(i.alias("at"), value(l).alias("value"))), lambda m: m["value"].isNotNull())


def _turns(marks: str) -> Column:
    """Of marks that open (true) and close (false) those that change something."""
    return F.filter(marks, lambda m, k: m["value"] != F.coalesce(F.get(marks, k - 1)["value"], F.lit(False)))


def _pieces(marks: str) -> Column:
    """What each mark is followed by, up to the next mark: value, place of its first line, lines."""
    def piece(m: Column, k: Column) -> Column:
        until = F.coalesce(F.get(marks, k + 1)["at"], F.size("lines"))
        return F.struct(m["value"].alias("value"), (m["at"] + 1).alias("first"), F.slice("lines", m["at"] + 2, until - m["at"] - 1).alias("lines"))
    return F.transform(marks, piece)


def _heading(line: Column) -> Column:
    named = line.contains(INDEX_NUMBER) & line.rlike(U(INDEX_HEADING))
    return F.when(named, F.lit(True)).when(line.rlike(U(ANY_HEADING)), F.lit(False))


def _table_row(line: Column) -> Column:
    s = strip(line)
    named = s.contains(INDEX_NUMBER) & s.rlike(U(INDEX_ROW))
    return F.when(named, F.lit(True)).when(s.rlike(U(NEXT_INDEX)) & ~s.rlike(U(REMARK_ROW)), F.lit(False))


GROUP_END = "\x1f"


def _groups(line: Column, pattern: str, n: int) -> Column:
    """The n groups of a pattern that spans the line, found by one match; null where it does not match."""
    cut = F.split(F.regexp_replace(line, U(pattern), GROUP_END.join(f"${i + 1}" for i in range(n))), GROUP_END)
    return F.when(F.size(cut) == n, cut)


def _parts(rows: DataFrame) -> DataFrame:
    """One row for each section of the index and each stretch of a remarks table: kind, number, first,
    lines; a document without any gives one row of nulls. rows: file, lines, ..."""
    titled = F.exists("lines", lambda l: l.rlike("Remarks") & l.contains("Symbol"))
    rows = rows.withColumns({"_h": _marks(_heading), "_t": F.when(titled, _marks(_table_row)).otherwise(F.array())})
    rows = rows.withColumns({"_h": _turns("_h"), "_t": _turns("_t")})
    rows = rows.withColumns({"_h": F.filter(_pieces("_h"), lambda p: p["value"]), "_t": F.filter(_pieces("_t"), lambda p: p["value"])})
    tagged = lambda column, kind: F.transform(column, lambda p, k: F.struct(
        F.lit(kind).alias("kind"), (k + 1).alias("section"), p["first"].alias("first"), p["lines"].alias("lines")))
    rest = [c for c in rows.columns if c not in ("lines", "_h", "_t")]
    return rows.select(*rest, F.explode_outer(F.concat(tagged("_h", SECTION), tagged("_t", TABLE))).alias("p")).select(*rest, "p.*")


def _said(line: Column) -> Column:
    """The action a line names, unless it is a company's row."""
    s = strip(line)
    word = F.coalesce(*[F.nullif(F.regexp_extract(s, U(ACTION_WORDS), i), F.lit("")) for i in (1, 2, 3)])
    # both words of the pattern hold these letters; few lines do
    return F.when(F.lower(line).contains("cluded") & ~s.rlike(U(COMPANY_ROW)), F.lower(word))


def _rows(parts: DataFrame) -> DataFrame:
    """The lines of all parts under the action named last, with what each says; `listed` marks rows of
    the index (readable or not). A part without lines keeps one row.

    A line is matched against the row of its part's kind only, once, and its groups are kept.
    """
    whole = F.array(F.struct(F.lit(-1).alias("at"), F.lit("").alias("value")))
    rest = [c for c in parts.columns if c not in ("first", "lines")]
    rows = parts.withColumn("_m", F.when(F.col("kind") == SECTION, _marks(_said)).otherwise(whole)).withColumn("_p", _pieces("_m"))
    rows = rows.select(*rest, "first", F.explode_outer("_p").alias("p"))
    rows = rows.select(*rest, (F.col("first") + F.col("p.first")).alias("_from"), F.col("p.value").alias("said"), F.posexplode_outer("p.lines").alias("k", "line"))
    in_table = F.col("kind") == TABLE
    rows = rows.withColumn("_s", strip(F.col("line"))).withColumn("_g", F.when(in_table, _groups(F.col("_s"), REMARK_ROW, 4)).otherwise(_groups(F.col("_s"), COMPANY_ROW, 3)))
    group = lambda i: F.get("_g", F.lit(i))
    rows = rows.withColumn("_ok", F.col("_g").isNotNull() & (in_table | ~group(2).rlike(U(r"^\d+$")) & ~group(2).rlike(U(NAME_ENDING))))
    change = F.when(F.upper(group(2)) == "INCLUSION", "INCLUDE").otherwise("EXCLUDE")
    listed = F.when(in_table, F.col("_ok")).otherwise(F.col("_ok") | F.col("_s").rlike(U(NUMBERED_ROW)))
    return rows.select(
        *rest, (F.col("_from") + F.col("k")).alias("line_no"), F.coalesce(listed, F.lit(False)).alias("listed"),
        F.when(in_table, F.when(group(3) != "", F.concat(F.lit("CANCEL_"), change)).otherwise(change))
        .otherwise(F.when(F.col("said") == "included", "INCLUDE").otherwise("EXCLUDE")).alias("action"),
        F.when(F.col("_ok"), F.when(in_table, group(1)).otherwise(group(2))).alias("symbol"),
        F.when(F.col("_ok"), strip(F.when(in_table, group(0)).otherwise(group(1)))).otherwise(F.col("_s")).alias("name"))


def _of_index(documents: DataFrame) -> DataFrame:
    """Documents that can hold a section or a table of the index."""
    return documents.filter(F.contains("text", F.lit(INDEX_NUMBER)))


def index_sections(documents: DataFrame) -> DataFrame:
    """Lines inside the sections of the index: its heading opens one, the next heading of
    another index closes it (TXT1)."""
    parts = _parts(kept_lines(_of_index(documents))).filter(F.col("kind") == SECTION)
    return parts.select("file", "section", "first", F.posexplode("lines").alias("k", "line")).select(
        "file", "section", (F.col("first") + F.col("k")).alias("line_no"), "line")


def section_rows(documents: DataFrame) -> DataFrame:
    """Companies listed under the action last named in their section; a numbered row without a
    readable symbol is reported, not repaired (TXT2)."""
    parts = _parts(kept_lines(_of_index(documents))).filter(F.col("kind") == SECTION)
    return _rows(parts).filter("listed").select("file", "section", "line_no", "action", "symbol", "name")


def remark_rows(documents: DataFrame) -> DataFrame:
    """Rows of the index in a remarks table; a revoked change becomes a cancellation (TXT3)."""
    parts = _parts(kept_lines(_of_index(documents))).filter(F.col("kind") == TABLE)
    return _rows(parts).filter("listed").select("file", "line_no", "action", "symbol", "name")


def _dated(rows: DataFrame) -> DataFrame:
    """Adds release and effective date (TXT4). rows: file, lines, ..."""
    opening = F.array_join(F.slice("lines", 1, OPENING_LINES), " ")
    whole = F.array_join("lines", " ")
    last = F.try_element_at(F.regexp_extract_all(opening, F.lit(U(EFFECTIVE_PHRASE)), F.lit(1)), F.lit(-1))
    phrase = F.coalesce(last, F.nullif(F.regexp_extract(whole, U(EFFECTIVE_PHRASE), 1), F.lit("")))
    named = F.nullif(F.regexp_extract("file", RELEASE_FILE, 1), F.lit(""))
    return rows.withColumns({"release_date": F.to_date(F.try_to_timestamp(named, F.lit("ddMMyyyy"))), "effective_date": release_date_text(phrase)})


def release_dates(documents: DataFrame) -> DataFrame:
    """Per document: release date from the file name and effective date from the text (TXT4).

    The last phrase of the opening lines counts, else the first of the whole text.
    """
    return _dated(kept_lines(documents)).select("file", "release_date", "effective_date")


def announced_changes(documents: DataFrame) -> DataFrame:
    """Every readable change with its dates (TXT1 to TXT4 together), in one pass."""
    rows = _rows(_parts(_dated(kept_lines(_of_index(documents)))))
    return rows.filter("listed and symbol is not null").select("file", "action", "symbol", "name", "release_date", "effective_date")


def parse_report(documents: DataFrame) -> DataFrame:
    """Files with a section, without rows, unreadable rows, files without a date (TXT5).

    The counts of a file are summed up before anything is exchanged.
    """
    headed = F.exists("lines", lambda l: l.rlike(U(INDEX_HEADING)))
    rows = _rows(_parts(_dated(kept_lines(_of_index(documents)).withColumn("has_section", headed))))
    per_file = rows.groupBy("file", "has_section", "effective_date").agg(
        F.count_if(F.col("listed") & F.col("symbol").isNotNull()).alias("rows"), F.count_if(F.col("listed") & F.col("symbol").isNull()).alias("unreadable_rows"),
        F.count_if(F.col("listed") & (F.col("kind") == TABLE)).alias("remarks")).filter(F.col("has_section") | (F.col("remarks") > 0))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    return per_file.agg(
        F.count(F.lit(1)).alias("files_with_section"), F.count_if(F.col("rows") == 0).alias("no_rows"), total("unreadable_rows"),
        F.count_if(F.col("effective_date").isNull()).alias("no_effective_date"), total("rows"))
