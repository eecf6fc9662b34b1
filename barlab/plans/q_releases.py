"""Registered queries: index changes out of announcement texts."""
from __future__ import annotations

from pyspark.sql import functions as F

from barlab.operators import releases as T
from barlab.plans import derived as D
from barlab.plans.oracle_views import sql, view
from barlab.plans.registry import query, tidy


HARD_SPACE = "\xa0"
SPACED = ("2) Nifty 500", "Nifty 500\nOmega", "3) Nifty", "1 Customer", "Ltd OM", "being excluded")


def hardened(text: str) -> str:
    """SQL that replaces the spaces of those places in a text's SQL."""
    for plain in SPACED:
        text = f"replace({text}, {quoted(plain)}, {quoted(plain.replace(' ', HARD_SPACE))})"
    return text


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def documents(spark, sf):
    """One announcement per order, its wording chosen by the order's status and priority. Every
    third has no-break spaces in headings, tables and rows, as text out of PDF files does."""
    day, key = F.col("o_orderdate"), F.col("o_orderkey").cast("string")
    cust = F.col("o_custkey").cast("string")
    later = F.date_add(F.to_date(day), 7)
    st, pr = F.col("o_orderstatus"), F.col("o_orderpriority")
    dated = (F.when(pr == "1-URGENT", "No date is given here.")
             .when(st == "F", F.concat(F.lit("These changes replace those effective from January 5, 1990 and shall become effective from "),
                                       F.date_format(later, "MMMM d, yyyy"), F.lit(".")))
             .when(st == "O", F.concat(F.lit("The changes apply w.e.f. "), F.date_format(later, "d MMMM yyyy")))
             .otherwise(F.concat(F.lit("with effect from Monday, "), F.date_format(later, "MMMM d, yyyy"))))
    head = F.concat(F.lit("Press Release\n\nChanges in indices\n"), dated, F.lit("\n"))
    table = F.concat(F.lit("Index Name Security Name Symbol Remarks\n1 Nifty 500\nOmega Ltd OM"), cust,
                     F.lit(" Inclusion revoked\nSigma SG"), key, F.lit(" Exclusion\n2 Nifty 100\nZeta ZETA Inclusion\n"))
    empty = F.lit("1) Nifty Bank\n1 Alpha Ltd ALPHA\n2) Nifty 500\nNo changes.\n3) Nifty Midcap\n1 Delta Ltd DELTA\n")
    second = F.when(pr == "2-HIGH", "2 Bad Row Limited").otherwise(F.concat(F.lit("2 Beta Corp B"), cust))
    full = F.concat(F.lit("1) Nifty Bank\nThe following companies are being excluded:\n1 Alpha Ltd ALPHA\n2) Nifty 500\n"
                          "The following companies are being excluded:\n1 Customer Goods C"), cust, F.lit("\n  "), second,
                    F.lit("\nThe following companies are being included:\n1 Gamma Industries G"), key,
                    F.lit("\n3) Nifty Midcap\n1 Delta Ltd DELTA\n"))
    body = F.when(pr == "5-LOW", table).when(pr == "4-NOT SPECIFIED", empty).otherwise(full)
    hard = F.lit(HARD_SPACE)
    for plain in SPACED:
        body = F.when(F.col("o_orderkey") % 3 == 0, F.replace(body, F.lit(plain), F.replace(F.lit(plain), F.lit(" "), hard))).otherwise(body)
    # parsing a text costs far more than reading its order, so the orders of a few large row groups are spread first
    return D.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority").hint("rebalance").select(
        F.concat(F.lit("ind_prs"), F.date_format(day, "ddMMyyyy"), F.lit("_"), key, F.lit(".pdf")).alias("file"),
        F.concat(head, body).alias("text"))


PLAIN = """case o_orderpriority when '5-LOW' then concat('Index Name Security Name Symbol Remarks|1 Nifty 500|Omega Ltd OM', o_custkey, ' Inclusion revoked|Sigma SG', o_orderkey, ' Exclusion|2 Nifty 100|Zeta ZETA Inclusion|')
    when '4-NOT SPECIFIED' then '1) Nifty Bank|1 Alpha Ltd ALPHA|2) Nifty 500|No changes.|3) Nifty Midcap|1 Delta Ltd DELTA|'
    else concat('1) Nifty Bank|The following companies are being excluded:|1 Alpha Ltd ALPHA|2) Nifty 500|The following companies are being excluded:|1 Customer Goods C', o_custkey, '|  ',
      case when o_orderpriority = '2-HIGH' then '2 Bad Row Limited' else concat('2 Beta Corp B', o_custkey) end,
      '|The following companies are being included:|1 Gamma Industries G', o_orderkey, '|3) Nifty Midcap|1 Delta Ltd DELTA|') end"""
view("docs", f"""
select concat('ind_prs', strftime(o_orderdate, '%d%m%Y'), '_', o_orderkey, '.pdf') as file, concat('Press Release', chr(10), chr(10), 'Changes in indices', chr(10),
  case when o_orderpriority = '1-URGENT' then 'No date is given here.'
       when o_orderstatus = 'F' then concat('These changes replace those effective from January 5, 1990 and shall become effective from ', strftime(o_orderdate + interval 7 day, '%B %-d, %Y'), '.')
       when o_orderstatus = 'O' then concat('The changes apply w.e.f. ', strftime(o_orderdate + interval 7 day, '%-d %B %Y'))
       else concat('with effect from Monday, ', strftime(o_orderdate + interval 7 day, '%B %-d, %Y')) end, chr(10),
  case when o_orderkey % 3 = 0 then {hardened('body')} else body end) as text from (select *, replace({PLAIN}, '|', chr(10)) as body from orders)""")
# The twin's engine knows white space of ASCII only, so it matches a copy of the line with plain spaces.
view("dlines", f"""
select file, line, p, trim(p) as s, row_number() over (partition by file order by i) - 1 as line_no from
 (select file, line, replace(line, '{HARD_SPACE}', ' ') as p, i from (select file, unnest(string_split(text, chr(10))) as line, unnest(range(len(string_split(text, chr(10))))) as i from docs))
where trim(p) <> ''""", "docs")
INDEX, ANY, ROW, WORDS, NUMBERED, ENDING, REMARK, TABLE_ROW, NEXT = map(quoted, (
    T.INDEX_HEADING, T.ANY_HEADING, T.COMPANY_ROW, T.ACTION_WORDS, T.NUMBERED_ROW, T.NAME_ENDING, T.REMARK_ROW, T.INDEX_ROW, T.NEXT_INDEX))
view("dsec", f"""
select file, line_no, line, s, sum(case when opens and not was then 1 else 0 end) over (partition by file order by line_no) as section, inside and not (opens and not was) as kept from
 (select *, coalesce(last_value(mark ignore nulls) over (partition by file order by line_no), false) as inside,
   coalesce(last_value(mark ignore nulls) over (partition by file order by line_no rows between unbounded preceding and 1 preceding), false) as was
  from (select *, regexp_matches(p, {INDEX}) as opens, case when regexp_matches(p, {INDEX}) then true when regexp_matches(p, {ANY}) then false end as mark from dlines))""", "dlines")
view("drows", f"""
select file, section, line_no, case when said = 'included' then 'INCLUDE' else 'EXCLUDE' end as action, case when ok then sym end as symbol, case when ok then trim(regexp_extract(s, {ROW}, 2)) else s end as name from
 (select *, last_value(says ignore nulls) over (partition by file, section order by line_no) as said, sym <> '' and not regexp_full_match(sym, '\\d+') and not regexp_matches(sym, {ENDING}) as ok from
  (select *, regexp_extract(s, {ROW}, 3) as sym, case when not regexp_matches(s, {ROW}) then lower(coalesce(nullif(regexp_extract(s, {WORDS}, 1), ''), nullif(regexp_extract(s, {WORDS}, 2), ''), nullif(regexp_extract(s, {WORDS}, 3), ''))) end as says
   from dsec where kept))
where says is null and said is not null and (ok or regexp_matches(s, {NUMBERED}))""", "dsec")
view("dremark", f"""
select file, line_no, concat(case when regexp_extract(s, {REMARK}, 4) <> '' then 'CANCEL_' else '' end, case upper(regexp_extract(s, {REMARK}, 3)) when 'INCLUSION' then 'INCLUDE' else 'EXCLUDE' end) as action,
  regexp_extract(s, {REMARK}, 2) as symbol, trim(regexp_extract(s, {REMARK}, 1)) as name
from (select *, bool_or(contains(line, 'Remarks') and contains(line, 'Symbol')) over (partition by file) as tbl, last_value(mark ignore nulls) over (partition by file order by line_no) as inside
  from (select *, regexp_matches(s, {TABLE_ROW}) as starts, case when regexp_matches(s, {TABLE_ROW}) then true when regexp_matches(s, {NEXT}) and not regexp_matches(s, {REMARK}) then false end as mark from dlines))
where tbl and inside and not starts and regexp_matches(s, {REMARK})""", "dlines")
view("ddates", """
select concat('ind_prs', strftime(o_orderdate, '%d%m%Y'), '_', o_orderkey, '.pdf') as file, cast(o_orderdate as date) as release_date,
  case when o_orderpriority <> '1-URGENT' then cast(o_orderdate as date) + 7 end as effective_date from orders""")


@query("txt1_index_sections", sql("select file, section, line_no, line from dsec where kept", "dsec"))
def txt1(spark, sf):
    return tidy(T.index_sections(documents(spark, sf)))


@query("txt2_section_rows", sql("select * from drows", "drows"))
def txt2(spark, sf):
    return tidy(T.section_rows(documents(spark, sf)))


@query("txt3_remark_rows", sql("select * from dremark", "dremark"))
def txt3(spark, sf):
    return tidy(T.remark_rows(documents(spark, sf)))


@query("txt4_release_dates", sql("select * from ddates", "ddates"))
def txt4(spark, sf):
    return T.release_dates(documents(spark, sf))


@query("txt5_parse_report", sql("""
, c as (select file from dlines where s = '2) Nifty 500' union select file from dremark),
n as (select file, count(*) as n from (select file from drows where symbol is not null union all select file from dremark) group by 1)
select count(*) as files_with_section, count(*) filter (where n is null) as no_rows, (select count(*) from drows where symbol is null) as unreadable_rows,
  count(*) filter (where effective_date is null) as no_effective_date, cast(sum(n) as bigint) as rows from c left join n using (file) join ddates using (file)""", "drows", "dremark", "ddates").replace("\n, c as", ", c as", 1))
def txt5(spark, sf):
    return T.parse_report(documents(spark, sf))


@query("txt_announced_changes", sql("""
select r.file, action, symbol, name, release_date, effective_date from (select file, action, symbol, name from drows where symbol is not null union all select file, action, symbol, name from dremark) r join ddates using (file)""", "drows", "dremark", "ddates"))
def txt_changes(spark, sf):
    return T.announced_changes(documents(spark, sf))
