"""Queries on versions, loads, parsing and predicates, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyspark import schemas
from tallyspark.functions import periods
from tallyspark.functions.text import canonical_uuid, money
from tallyspark.operators import versioning as v
from tallyspark.sources import api
from tallyspark.sources.tables import table

DAY = "2023-08-15"


def dedupe_activities(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "activities")
    keys = ["filing_id", F.col("description"), F.col("issue_code"), "houses_lobbied", "agencies"]
    return v.first_of_repeats(a, keys).select("id", "filing_id")


def current_filings(spark: SparkSession, d: str) -> DataFrame:
    return v.mark_current(table(spark, d, "filings", "id", *v.GROUP, "filing_date")).select("id", "is_current")


def stale_flags(spark: SparkSession, d: str) -> DataFrame:
    """Filings whose stored flag is not what a recompute gives."""
    f = v.mark_current(table(spark, d, "filings", "id", *v.GROUP, "filing_date", F.col("is_current").alias("stored")))
    return f.where("not (stored <=> is_current)").select("id", "stored", "is_current")


def as_of_filings(spark: SparkSession, d: str) -> DataFrame:
    return v.as_of(table(spark, d, "filings", "id", *v.GROUP, "filing_date"), DAY).select("id", "year", "quarter")


def as_of_by_absence(spark: SparkSession, d: str) -> DataFrame:
    return v.as_of_by_absence(table(spark, d, "filings", "id", *v.GROUP, "filing_date"), DAY).select("id", "year", "quarter")


def superseded_counts(spark: SparkSession, d: str) -> DataFrame:
    f = v.mark_current(table(spark, d, "filings", "id", *v.GROUP, "filing_date"))
    return f.groupBy("year", "quarter").agg(F.count_if(~F.col("is_current")).alias("n_superseded"), F.count(F.lit(1)).alias("n_filings"))


def work_queue(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "activities", F.col("id").alias("activity_id"), "description", "issue_code").where(F.length("description") > 20)
    return v.pending(a, table(spark, d, "activity_extractions_rules", "activity_id"), "activity_id").select("activity_id", "issue_code")


def merge_new_filings(spark: SparkSession, d: str) -> DataFrame:
    """Mirror rows whose filing is not stored: what an idempotent load would append."""
    live = table(spark, d, "filings_mirror", canonical_uuid(F.col("filing_uuid")).alias("k"), "year", "quarter").where("k is not null")
    return v.only_new(live, table(spark, d, "filings", canonical_uuid(F.col("sopr_filing_id")).alias("k")), ["k"])


def upsert_extractions(spark: SparkSession, d: str) -> DataFrame:
    """The stored extractions with new ones of all activities in place of or beside them."""
    e = table(spark, d, "activity_extractions_rules", "activity_id", "l0_issue_code", "extractor_version")
    new = table(spark, d, "activities", F.col("id").alias("activity_id"), F.upper(F.trim("issue_code")).alias("l0_issue_code")).withColumn("extractor_version", F.lit("next"))
    return v.upsert(e, new, ["activity_id"])


def stratified_sample(spark: SparkSession, d: str) -> DataFrame:
    return v.stratified(table(spark, d, "filings", "id", "year", "quarter"), ["year", "quarter"], 100).select("id", "year", "quarter", "rank")


def parse_filings(spark: SparkSession, d: str) -> DataFrame:
    """The live copies as the API gives them (nested, period by name), parsed; the kind of report told from its type."""
    m = table(spark, d, "filings_mirror")
    period = F.element_at(F.array(*map(F.lit, ("1st Quarter (Jan 1 - Mar 31)", "second_quarter", "Q3", "4TH QUARTER"))), F.col("quarter"))
    party = lambda c: F.struct(F.col(c).cast("string").alias("id"), F.concat(F.lit("  party "), F.col(c).cast("string")).alias("name"))
    raw = m.select("filing_uuid", F.col("year").alias("filing_year"), period.alias("filing_period"), F.upper(F.trim("filing_type")).alias("filing_type"), "income", "filing_date", party("registrant_id").alias("registrant"), party("client_id").alias("client"))
    out = api.parse_filings(schemas.migrate(raw, schemas.FILING))
    kind = F.col("filing_type")
    return out.select(
        F.col("sopr_filing_id").alias("k"), "year", "quarter", F.col("income").alias("amount"), kind.alias("kind"), F.substring(F.ltrim("filing_date"), 1, 10).alias("day"), "registrant_sopr", "client_name", F.size("activities").alias("n_activities"),
        F.when(kind.rlike("^[1-4](A|AY)$"), "amendment").when(kind.rlike("^[1-4](T|TY|@|@Y)$"), "termination").when(kind.rlike("^Q[1-4]Y?$"), "original").otherwise("other").alias("family"),
        kind.endswith("Y").alias("no_activity"),
    )


def parse_periods(spark: SparkSession, d: str) -> DataFrame:
    """Quarters read back from the names of periods."""
    p = table(spark, d, "report_periods", "year", "quarter")
    names = F.element_at(F.array(*map(F.lit, ("1st Quarter (Jan 1 - Mar 31)", "second_quarter", "Q3", "4TH QUARTER"))), F.col("quarter"))
    q = periods.q_index()
    return p.select("year", "quarter", periods.parse_period(names).alias("parsed"), periods.label(q).alias("label"), periods.quarter_end(q).alias("last_day"), periods.label(q - 4).alias("year_before"), periods.congress(F.col("year")).alias("congress"), periods.ordinal(periods.congress(F.col("year"))).alias("nth"))


def houses_split(spark: SparkSession, d: str) -> DataFrame:
    """Chambers and agencies told apart by the parser, from each activity as a nested filing of its own: a name is a chamber if it is exactly one."""
    a = table(spark, d, "activities", "id", "houses_lobbied", "agencies")
    names = F.transform(F.split(F.concat_ws(",", "houses_lobbied", "agencies"), ","), lambda x: F.struct(x.alias("name")))
    one = F.struct(F.lit("text").alias("description"), F.lit(None).cast("string").alias("specific_issues"), F.lit("TAX").alias("general_issue_code"), names.alias("government_entities"))
    party = F.struct(F.lit("1").alias("id"), F.lit("name").alias("name"))
    raw = a.select(F.concat(F.lit("00000000-0000-0000-0000-"), F.lpad(F.col("id").cast("string"), 12, "0")).alias("filing_uuid"), F.lit(2024).alias("filing_year"), F.lit("Q1").alias("filing_period"), party.alias("registrant"), party.alias("client"), F.array(one).alias("lobbying_activities"))
    x = api.parse_filings(schemas.migrate(raw, schemas.FILING)).select(F.substring("sopr_filing_id", 25, 12).cast("long").alias("id"), F.explode("activities").alias("a")).select("id", "a.*")
    parts = lambda c: F.transform(F.split(c, ","), lambda p: F.upper(F.trim(p)))
    return x.select("id", F.array_join(F.sort_array(F.array_distinct(parts("houses_lobbied"))), ",").alias("chambers"), F.size(F.filter(parts("agencies"), lambda p: p != "")).alias("n_other"))


def activity_predicates(spark: SparkSession, d: str) -> DataFrame:
    """Counts under the usual predicates: lengths, code lists, empty texts, positive income, a range of periods and of days."""
    a = table(spark, d, "activities", "filing_id", "description", "issue_code")
    f = table(spark, d, "filings", F.col("id").alias("filing_id"), "income", "filing_date", periods.q_index().alias("q"))
    day = F.ltrim("filing_date")
    return a.join(f, "filing_id").agg(
        F.count_if(F.length("description") > 20).alias("n_over_20"), F.count_if(F.length("description") > 50).alias("n_over_50"), F.count_if(F.upper(F.trim("issue_code")).isin("TAX", "HCR", "DEF")).alias("n_codes"),
        F.count_if(F.coalesce(F.trim("description"), F.lit("")) == "").alias("n_empty"), F.count_if(F.col("income") > 0).alias("n_paid"), F.count_if(F.col("q").between(2022 * 4 + 1, 2023 * 4 + 4)).alias("n_periods"),
        F.count_if(day.between("2022-01-01", "2022-06-30")).alias("n_days"),
    )


def snippets(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "activities", "id", "description").where("description is not null")
    return a.select("id", F.substring(F.replace("description", F.lit("\n"), F.lit(" ")), 1, 60).alias("snippet"))


def unmapped_modes(spark: SparkSession, d: str) -> DataFrame:
    """Activities by how far they are tagged: not processed, processed without a topic, processed."""
    a = table(spark, d, "activities", F.col("id").alias("activity_id"), "issue_code")
    e = table(spark, d, "activity_extractions_rules", "activity_id", F.coalesce(F.size(F.filter("topics", lambda x: ~x.startswith("general_"))), F.lit(0)).alias("n"))
    mode = F.when(F.col("n").isNull(), "unprocessed").when(F.col("n") <= 0, "processed_unmapped").otherwise("mapped")
    return a.join(e, "activity_id", "left").groupBy(mode.alias("mode")).agg(F.count(F.lit(1)).alias("n"))


QUERIES = {
    f.__name__: f for f in (dedupe_activities, current_filings, stale_flags, as_of_filings, as_of_by_absence, superseded_counts, work_queue, merge_new_filings, upsert_extractions, stratified_sample, parse_filings, parse_periods, houses_split, activity_predicates, snippets, unmapped_modes)
}

_RANK = "row_number() over (partition by registrant_id, client_id, year, quarter order by filing_date desc nulls last, id desc)"
_KEY = "regexp_replace(lower({}), '[^0-9a-f]', '', 'g')"
_HYPHENS = "regexp_replace({}, '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', '\\1-\\2-\\3-\\4-\\5')"

ORACLE = {
    "dedupe_activities": "select id, filing_id from activities where id in (select min(id) from activities group by filing_id, coalesce(description, ''), coalesce(issue_code, ''), houses_lobbied, agencies)",
    "current_filings": f"select id, {_RANK} = 1 as is_current from filings",
    "stale_flags": f"select id, stored, is_current from (select id, is_current as stored, {_RANK} = 1 as is_current from filings) where stored is distinct from is_current",
    "as_of_filings": f"select id, year, quarter from (select *, {_RANK} as rn from filings where substr(ltrim(filing_date), 1, 10) <= '{DAY}') where rn = 1",
    "as_of_by_absence": f"""with s as (select * from filings where substr(ltrim(filing_date), 1, 10) <= '{DAY}') select id, year, quarter from s a where not exists (select 1 from s b where b.registrant_id = a.registrant_id
        and b.client_id = a.client_id and b.year = a.year and b.quarter = a.quarter and (b.filing_date > a.filing_date or b.filing_date = a.filing_date and b.id > a.id))""",
    "superseded_counts": f"select year, quarter, count(*) filter (rn > 1) as n_superseded, count(*) as n_filings from (select year, quarter, {_RANK} as rn from filings) group by 1, 2",
    "work_queue": "select id as activity_id, issue_code from activities a left join activity_extractions_rules e on e.activity_id = a.id where e.activity_id is null and length(description) > 20",
    "merge_new_filings": f"""select k, year, quarter from (select distinct on (k) {_HYPHENS.format(_KEY.format('filing_uuid'))} as k, year, quarter from filings_mirror) where k not in (select sopr_filing_id from filings)""",
    "upsert_extractions": "select id as activity_id, upper(trim(issue_code)) as l0_issue_code, 'next' as extractor_version from activities union all select activity_id, l0_issue_code, extractor_version from activity_extractions_rules where activity_id not in (select id from activities)",
    "stratified_sample": "select id, year, quarter, cast(rank as int) as rank from (select id, year, quarter, row_number() over (partition by year, quarter order by md5(cast(id as varchar) || '1'), id) as rank from filings) order by rank, year, quarter limit 100",
    "parse_filings": f"""select {_HYPHENS.format(_KEY.format('filing_uuid'))} as k, year, quarter, cast(coalesce(try_cast(regexp_replace(upper(income), '[\\s$,]|USD', '', 'g') as decimal(20,4)), 0) as double) as amount, upper(trim(filing_type)) as kind,
        substr(ltrim(filing_date), 1, 10) as day, cast(registrant_id as varchar) as registrant_sopr, 'party ' || client_id as client_name, 0 as n_activities, case when regexp_full_match(upper(trim(filing_type)), '[1-4](A|AY)') then 'amendment' when regexp_full_match(upper(trim(filing_type)), '[1-4](T|TY|@|@Y)') then 'termination'
        when regexp_full_match(upper(trim(filing_type)), 'Q[1-4]Y?') then 'original' else 'other' end as family, ends_with(upper(trim(filing_type)), 'Y') as no_activity from filings_mirror
        where filing_uuid is not null and year is not null and quarter is not null and registrant_id is not null and client_id is not null and coalesce(upper(trim(filing_type)), '') not in ('RR', 'RA')""",
    "parse_periods": """select year, quarter, quarter as parsed, year || ' Q' || quarter as label, period_end as last_day, (year - 1) || ' Q' || quarter as year_before, cast((year - 1789) // 2 + 1 as int) as congress,
        ((year - 1789) // 2 + 1) || 'th' as nth from report_periods""",
    "houses_split": """with n as (select id, upper(trim(unnest(string_split(concat_ws(',', houses_lobbied, agencies), ',')))) as x from activities)
        select a.id, coalesce(string_agg(distinct x, ',' order by x) filter (x in ('SENATE', 'HOUSE OF REPRESENTATIVES')), '') as chambers,
        cast(count(*) filter (x <> '' and x not in ('SENATE', 'HOUSE OF REPRESENTATIVES')) as int) as n_other from activities a left join n on n.id = a.id group by 1""",
    "activity_predicates": """select count(*) filter (length(description) > 20) as n_over_20, count(*) filter (length(description) > 50) as n_over_50, count(*) filter (upper(trim(issue_code)) in ('TAX', 'HCR', 'DEF')) as n_codes,
        count(*) filter (coalesce(trim(description), '') = '') as n_empty, count(*) filter (income > 0) as n_paid, count(*) filter (year * 4 + quarter between 8089 and 8096) as n_periods,
        count(*) filter (ltrim(filing_date) between '2022-01-01' and '2022-06-30') as n_days from activities a join filings f on f.id = a.filing_id""",
    "snippets": "select id, substr(replace(description, chr(10), ' '), 1, 60) as snippet from activities where description is not null",
    "unmapped_modes": """select case when e.activity_id is null then 'unprocessed' when len(list_filter(coalesce(topics, []), lambda x: not starts_with(x, 'general_'))) = 0 then 'processed_unmapped' else 'mapped' end as mode, count(*) as n
        from activities a left join activity_extractions_rules e on e.activity_id = a.id group by 1""",
}
