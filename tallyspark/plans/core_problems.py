"""Queries of the general data problems (2, 4, 6, 7) and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyspark.functions.text import canonical_uuid, instant_key, money
from tallyspark.operators.diff import Field, field_differences, pair_copies, repeated_keys
from tallyspark.operators.feed import current_rows, fold_changes
from tallyspark.operators.panes import compose_windows, late_events, pane_partials, with_panes
from tallyspark.operators.split import explode_packed
from tallyspark.sources.tables import table

CENT = "abs(coalesce(l, 0) - coalesce(r, 0)) > 0.01BD"
FILING_FIELDS = [
    Field("income", "income", "income", CENT),
    Field("filing_date", "filing_date", "filing_date"),
    Field("filing_type", "filing_type", "filing_type"),
    Field("year", "year", "year"),
    Field("quarter", "quarter", "quarter"),
    Field("client_id", "client_id", "client_id"),
    Field("registrant_id", "registrant_id", "registrant_id"),
]


def _sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Both copies with keys, amounts, types and dates in one notation."""
    cols = ["year", "quarter", "client_id", "registrant_id"]
    kind = F.upper(F.trim("filing_type")).alias("filing_type")
    day = instant_key(F.col("filing_date")).alias("filing_date")
    stored = table(spark, d, "filings").select(canonical_uuid(F.col("sopr_filing_id")).alias("key"), "id", "is_current", F.col("income").cast("decimal(20,4)").alias("income"), kind, day, *cols)
    live = table(spark, d, "filings_mirror").select(canonical_uuid(F.col("filing_uuid")).alias("key"), "audit_id", "fetched_at", money(F.col("income")).alias("income"), kind, day, *cols)
    return stored, live


def _paired(stored: DataFrame, live: DataFrame) -> DataFrame:
    return pair_copies(stored, live, ("key", "key"), FILING_FIELDS, ("named_struct('a', is_current, 'b', id)", "named_struct('a', false, 'b', unix_micros(timestamp(fetched_at)))"))


def p2_differences(spark: SparkSession, d: str) -> DataFrame:
    """Filings missing on either side, each differing field with both values, and keys that a side holds more than once."""
    paired = _paired(*_sides(spark, d))
    out = field_differences(paired, FILING_FIELDS, "missing_in_filings", "missing_in_mirror").unionByName(repeated_keys(paired))
    return out.select(F.col("key").alias("sopr_filing_id"), "field_name", "left_value", "right_value")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    stored, live = _sides(spark, d)
    paired = _paired(stored, live)
    rows = field_differences(paired, FILING_FIELDS, "missing_in_filings", "missing_in_mirror")
    filings = rows.select(F.lit("filings").alias("table_name"), F.col("key").alias("row_key"), "field_name")
    # of each run, the distinct filings among its mirror rows whose income differs
    runs = live.where("key is not null and audit_id is not null").groupBy("key", "audit_id").agg(F.max(F.coalesce("income", F.lit(0))).alias("hi"), F.min(F.coalesce("income", F.lit(0))).alias("lo"))
    both = paired.where("l is not null and r is not null").select("key", F.coalesce("l.income", F.lit(0)).alias("income"))
    off = runs.join(both, "key").where("abs(hi - income) > 0.01BD or abs(lo - income) > 0.01BD").groupBy("audit_id").agg(F.count(F.lit(1)).alias("n"))
    log = table(spark, d, "audit_log", "id", "income_mismatch")
    wrong = log.join(off, log.id == off.audit_id, "left").where("id is not null and not (income_mismatch <=> coalesce(n, 0))")
    return filings.unionByName(wrong.select(F.lit("audit_log").alias("table_name"), F.col("id").cast("string").alias("row_key"), F.lit("income_mismatch").alias("field_name"))).distinct()


def agency_names(spark: SparkSession, d: str) -> list[str]:
    """The names of agency_ref that hold a delimiter or quote. The table is a fixed list; a longer one costs more patterns, but no row."""
    return [r[0] for r in table(spark, d, "agency_ref", "agency_name").where(r"agency_name rlike '(?i)[,;|/\\n\\t\"]|\'|\\sand\\s|\\d\\)'").distinct().collect()]


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    out = explode_packed(table(spark, d, "activities", "id", "agencies"), "id", "agencies", agency_names(spark, d))
    return out.where("id is not null").select(F.col("id").alias("activity_id"), "pos", "part_text")


def _paned(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    periods = table(spark, d, "report_periods", "year", "quarter", "due_day", "closes_on")
    return with_panes(table(spark, d, "filings", "id", "sopr_filing_id", "year", "quarter", "income", "filing_date"), periods), periods


def p6_revisions(spark: SparkSession, d: str) -> DataFrame:
    """Count and income per period as first known on due_day and after each later arrival up to closes_on."""
    paned, periods = _paned(spark, d)
    return compose_windows(pane_partials(paned), periods)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    paned, periods = _paned(spark, d)
    panes = pane_partials(paned)
    return late_events(paned, panes, compose_windows(panes, periods)).withColumnRenamed("key", "sopr_filing_id")


def _state(spark: SparkSession, d: str) -> DataFrame:
    payload = ["filing_type", "filing_date", "is_current", "year", "quarter", "client_id", "registrant_id", "income"]
    key = canonical_uuid(F.col("sopr_filing_id")).alias("key")
    feed = table(spark, d, "filing_feed").select(key, "lsn", "op", *payload)
    base = table(spark, d, "filings").select(key, *payload)
    return fold_changes(feed, "key", "lsn", "op", payload, base)


def p7_current(spark: SparkSession, d: str) -> DataFrame:
    """The current rows of filings after all changes; lsn is null for rows the feed does not touch."""
    return current_rows(_state(spark, d)).select(F.col("key").alias("sopr_filing_id"), "filing_type", "filing_date", "is_current", F.col("sequence").alias("lsn"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return p7_current(spark, d).where("lsn is not null").select("sopr_filing_id", "lsn")


QUERIES = {f.__name__: f for f in (p2_found, p2_differences, p4_found, p6_found, p6_revisions, p7_found, p7_current)}

_UUID = "regexp_replace(regexp_replace(lower({}), '[^0-9a-f]', '', 'g'), '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', '\\1-\\2-\\3-\\4-\\5')"
_MONEY = "coalesce(try_cast(regexp_replace(upper({}), '[\\s$,]|USD', '', 'g') as decimal(20,4)), 0)"
_WHEN = "case when regexp_full_match(trim({0}), '\\d{{4}}-\\d{{2}}-\\d{{2}}') then 'D' || trim({0}) else 'T' || epoch_us(cast(trim({0}) as timestamptz)) end"
_BOTH = f"""
with s as (select {_UUID.format('sopr_filing_id')} as k, max(coalesce(income, 0)::decimal(20,4)) as income, max(upper(trim(filing_type))) as filing_type, max({_WHEN.format('filing_date')}) as filing_date,
    max(year) as year, max(quarter) as quarter, max(client_id) as client_id, max(registrant_id) as registrant_id from filings group by 1),
m as (select {_UUID.format('filing_uuid')} as k, max({_MONEY.format('income')}) as income, max(upper(trim(filing_type))) as filing_type, max({_WHEN.format('filing_date')}) as filing_date,
    max(year) as year, max(quarter) as quarter, max(client_id) as client_id, max(registrant_id) as registrant_id from filings_mirror group by 1),
d as (select coalesce(s.k, m.k) as k, unnest([
    case when m.k is null then 'missing_in_mirror' when s.k is null then 'missing_in_filings' when abs(s.income - m.income) > 0.01 then 'income' end,
    {', '.join(f"case when m.k is not null and s.k is not null and s.{c} is distinct from m.{c} then '{c}' end" for c in ('filing_date', 'filing_type', 'year', 'quarter', 'client_id', 'registrant_id'))}
    ]) as field_name from s full join m on s.k = m.k)
"""
_FOLD = "(select lower(trim(sopr_filing_id)) as k, max_by(lower(op) in ('d', 'del', 'delete'), lsn) as gone, max(lsn) as lsn, max_by(struct_pack(a := filing_type, b := filing_date, c := is_current), lsn) as v from filing_feed group by 1)"

ORACLE = {
    "p2_found": _BOTH + f""", n as (select audit_id, count(distinct k) as n from (select audit_id, {_UUID.format('filing_uuid')} as k, {_MONEY.format('income')} as income from filings_mirror) x
    join s using (k) where abs(x.income - s.income) > 0.01 group by 1)
    select 'filings' as table_name, k as row_key, field_name from d where field_name is not null
    union select 'audit_log', cast(id as varchar), 'income_mismatch' from audit_log left join n on id = audit_id where income_mismatch is distinct from coalesce(n, 0)""",
    "p2_differences": _BOTH.replace("as income, max(upper", "as income, count(*) as n, max(upper").replace("\nd as (", "\nx as (") + f""", ls as (select {_UUID.format('sopr_filing_id')} as k, max(income::decimal(20,4)) as v from filings group by 1),
    rs as (select {_UUID.format('filing_uuid')} as k, max(try_cast(regexp_replace(upper(income), '[\\s$,]|USD', '', 'g') as decimal(20,4))) as v from filings_mirror group by 1),
    b as (select coalesce(s.k, m.k) as k, s.k is null as no_s, m.k is null as no_m, coalesce(s.n, 0) as sn, coalesce(m.n, 0) as mn, ls.v as lv, rs.v as rv, abs(s.income - m.income) > 0.01 as off, {', '.join(f's.{c} as s_{c}, m.{c} as m_{c}' for c in ('filing_date', 'filing_type', 'year', 'quarter', 'client_id', 'registrant_id'))}
        from s full join m on s.k = m.k left join ls on ls.k = s.k left join rs on rs.k = m.k),
    o as (select k, 'missing_in_mirror' as field_name, null as l, null as r from b where no_m union all select k, 'missing_in_filings', null, null from b where no_s union all select k, 'repeated', cast(sn as varchar), cast(mn as varchar) from b where sn > 1 or mn > 1
        union all select k, 'income', cast(lv as varchar), cast(rv as varchar) from b where off {' '.join(f"union all select k, '{c}', cast(s_{c} as varchar), cast(m_{c} as varchar) from b where not no_s and not no_m and s_{c} is distinct from m_{c}" for c in ('filing_date', 'filing_type', 'year', 'quarter', 'client_id', 'registrant_id'))})
    select k as sopr_filing_id, field_name, l as left_value, r as right_value from o""",
    "p6_found": "select distinct sopr_filing_id from filings join report_periods using (year, quarter) where cast(substr(trim(filing_date), 1, 10) as date) > closes_on",
    "p6_revisions": """with f as (select sopr_filing_id, min(struct_pack(day := cast(substr(trim(filing_date), 1, 10) as date), id := id, year := year, quarter := quarter, income := coalesce(income, 0)::decimal(20,2))) as x
        from filings join report_periods using (year, quarter) where cast(substr(trim(filing_date), 1, 10) as date) <= closes_on group by 1),
    p as (select x.year, x.quarter, greatest(x.day, due_day) as known_on, count(*) as n, sum(x.income) as income from f join report_periods r on r.year = x.year and r.quarter = x.quarter group by 1, 2, 3),
    z as (select year, quarter, known_on, sum(n) as n, sum(income) as income from (select * from p union all select year, quarter, due_day, 0, 0 from report_periods) group by 1, 2, 3)
    select year, quarter, known_on, cast(row_number() over w - 1 as int) as revision, cast(sum(n) over w as bigint) as n_filings, cast(sum(income) over w as double) as income, closes_on
    from z join report_periods using (year, quarter) window w as (partition by year, quarter order by known_on)""",
    "p7_found": f"select k as sopr_filing_id, lsn from {_FOLD} where not gone",
    "p7_current": f"""with b as (select sopr_filing_id as k, max(struct_pack(a := filing_type, b := filing_date, c := is_current, d := year, e := quarter, f := client_id, g := registrant_id, h := income)) as v from filings group by 1)
    select coalesce(f.k, b.k) as sopr_filing_id, case when f.k is null then b.v.a else f.v.a end as filing_type, case when f.k is null then b.v.b else f.v.b end as filing_date,
    case when f.k is null then b.v.c else f.v.c end as is_current, f.lsn from {_FOLD} f full join b on f.k = b.k where f.k is null or not gone""",
}
