"""Queries that aggregate and rank, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tallyspark.functions import periods
from tallyspark.operators import facts as fx, measures as m
from tallyspark.plans.keys_sql import CLIENT_KEYS
from tallyspark.sources.tables import table


def _codes(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    a = table(spark, d, "activities", F.col("id").alias("activity_id"), "filing_id", F.upper(F.trim("issue_code")).alias("label"))
    f = table(spark, d, "filings", F.col("id").alias("filing_id"), "registrant_id", "client_id", "year", "quarter", "income")
    return a.select("activity_id", "label").where("label <> ''"), a.select("activity_id", "filing_id"), f


def period_totals(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "filings", "year", "quarter", "income", "client_id", "is_current").where("is_current")
    return f.groupBy("year", "quarter").agg(F.count(F.lit(1)).alias("filings"), F.sum("income").alias("income"), F.countDistinct("client_id").alias("clients"))


def allocated_income(spark: SparkSession, d: str) -> DataFrame:
    labels, acts, filings = _codes(spark, d)
    return m.allocated_income(labels, acts, filings.select("filing_id", "year", "quarter", "income")).withColumn("income", F.round("income", 4))


def registrant_totals(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "filings", "registrant_id", "year", "quarter", "income").where("income > 0")
    r = table(spark, d, "registrants", F.col("id").alias("registrant_id"), "name")
    return f.groupBy("registrant_id", "year", "quarter").agg(F.sum("income").alias("income"), F.count(F.lit(1)).alias("n")).join(r, "registrant_id")


def client_totals(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "filings", "client_id", "year", "quarter", "income").where("income > 0")
    c = table(spark, d, "clients", F.col("id").alias("client_id"), "name")
    return f.groupBy("client_id", "year", "quarter").agg(F.sum("income").alias("income"), F.count(F.lit(1)).alias("n")).join(c, "client_id")


def distinct_parties(spark: SparkSession, d: str) -> DataFrame:
    labels, acts, filings = _codes(spark, d)
    x = labels.join(acts, "activity_id").join(filings, "filing_id")
    return x.groupBy("label").agg(F.countDistinct("client_id").alias("clients"), F.countDistinct("registrant_id").alias("registrants"), F.count_if(F.col("income") > 0).alias("paid"), F.avg("income").alias("mean_income"), F.min("year").alias("first_year"), F.max("year").alias("last_year"))


def frequent_codes(spark: SparkSession, d: str) -> DataFrame:
    """Labels frequent enough to learn from."""
    return _codes(spark, d)[0].groupBy("label").agg(F.count(F.lit(1)).alias("n")).where("n >= 20")


def tag_counts(spark: SparkSession, d: str) -> DataFrame:
    return m.count_mentions(fx.mentions(fx.star(spark, d)))


def tag_counts_by_quarter(spark: SparkSession, d: str) -> DataFrame:
    return m.count_mentions(fx.mentions(fx.star(spark, d), ("topics",)), "q")


def top_clients_per_tag(spark: SparkSession, d: str) -> DataFrame:
    per = m.tag_clients(fx.mentions(fx.star(spark, d), ("topics", "entities")))
    return m.top_per_group(per, ["kind", "tag"], [F.desc("income"), F.asc("client_key")], 10)


def example_filings_per_tag(spark: SparkSession, d: str) -> DataFrame:
    """The eight latest filings of each topic."""
    x = fx.mentions(fx.star(spark, d), ("topics",)).select("tag", "filing_id", "filing_date", "income").distinct()
    return m.top_per_group(x, ["tag"], [F.desc_nulls_last("filing_date"), F.desc("income"), F.desc("filing_id")], 8).select("tag", "rank", "filing_id")


def issue_shares(spark: SparkSession, d: str) -> DataFrame:
    """Of each label and year, the part of its activities that a registrant holds."""
    labels, acts, filings = _codes(spark, d)
    n = labels.join(acts, "activity_id").join(filings, "filing_id").groupBy("label", "year", "registrant_id").agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("label", "year")))


def usual_name(spark: SparkSession, d: str) -> DataFrame:
    """The most frequent spelling of each normalized name, over the filings."""
    c = table(spark, d, "clients", F.col("id").alias("client_id"), F.trim("normalized_name").alias("party"), "name")
    f = table(spark, d, "filings", "client_id")
    return m.most_frequent(f.join(c, "client_id").where("party is not null"), "party", "name")


def quarter_distribution(spark: SparkSession, d: str) -> DataFrame:
    """Of the quarterly counts of each label: least, median, 90th percentile (nearest rank) and most, and the sums of the last and the previous four quarters."""
    labels, acts, filings = _codes(spark, d)
    n = labels.join(acts, "activity_id").join(filings.withColumn("q", periods.q_index()), "filing_id").groupBy("label", "q").agg(F.count(F.lit(1)).alias("n"))
    ends = n.agg(F.min("q").alias("a"), F.max("q").alias("b")).first()
    dense = n.select("label").distinct().withColumn("q", F.explode(F.sequence(F.lit(ends.a or 0), F.lit(ends.b or 0)))).join(n, ["label", "q"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    s = dense.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("q", "n"))).alias("s"))  # one entry per quarter
    values = F.sort_array(F.col("s.n"))
    total = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x)
    series = F.col("s.n")
    return s.select("label", F.array_min(series).alias("least"), m.nearest_rank(values, 0.5).alias("median"), m.nearest_rank(values, 0.9).alias("p90"), F.array_max(series).alias("most"), total(F.slice(series, -4, 4)).alias("last_four"), total(F.slice(series, -8, 4)).alias("four_before"))


def month_seasonality(spark: SparkSession, d: str) -> DataFrame:
    """Average filings of each calendar month, and whether it is one in which reports are due."""
    f = table(spark, d, "filings", F.substring(F.ltrim("filing_date"), 1, 7).alias("month")).where("month is not null")
    per = f.groupBy("month").agg(F.count(F.lit(1)).alias("n")).groupBy(F.substring("month", 6, 2).cast("int").alias("month_no")).agg(F.avg("n").alias("mean"))
    return per.withColumn("due", F.col("month_no").isin(1, 4, 7, 10))


def yearly_growth(spark: SparkSession, d: str) -> DataFrame:
    y = table(spark, d, "filings", "year", "income").groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.sum("income").alias("income"))
    w = Window.orderBy("year")  # one row per year
    first = F.first("n").over(w.rowsBetween(Window.unboundedPreceding, 0))
    years = F.col("year") - F.first("year").over(w.rowsBetween(Window.unboundedPreceding, 0))
    return y.select("year", "n", "income", F.lag("n").over(w).alias("n_before"), F.round(m.growth_pct(F.col("n"), F.lag("n").over(w)), 6).alias("change_pct"), F.when(years > 0, F.round((F.pow(F.col("n") / first, 1 / years) - 1) * 100, 6)).alias("cagr_pct"))


def tagging_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Of each issue code: activities, how many are tagged, how many with a specific topic, and in percent."""
    a = table(spark, d, "activities", F.col("id").alias("activity_id"), F.upper(F.trim("issue_code")).alias("code"))
    e = table(spark, d, "activity_extractions_rules", "activity_id", F.exists("topics", lambda x: ~x.startswith("general_")).alias("specific"))
    x = a.join(e.withColumn("tagged", F.lit(True)), "activity_id", "left").groupBy("code")
    x = x.agg(F.count(F.lit(1)).alias("n"), F.count_if("tagged").alias("n_tagged"), F.count_if("specific").alias("n_specific"))
    return x.withColumn("pct_tagged", F.round(F.col("n_tagged") * 100 / F.col("n"), 3)).withColumn("pct_specific", F.round(F.coalesce(F.try_divide(F.col("n_specific") * 100, "n_tagged"), F.lit(0.0)), 3))


def terms_per_code(spark: SparkSession, d: str) -> DataFrame:
    """In how many descriptions of a code each word occurs, and in how many at all."""
    a = table(spark, d, "activities", "id", "description", F.upper(F.trim("issue_code")).alias("code")).where("description is not null and code <> ''")
    words = a.select("code", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("description"), F.lit("[a-z][a-z0-9-]{2,}"), F.lit(0)))).alias("term"))
    per = words.groupBy("code", "term").agg(F.count(F.lit(1)).alias("in_code"))
    return per.withColumn("in_all", F.sum("in_code").over(Window.partitionBy("term"))).where("in_code >= 3")


def top_terms_capped(spark: SparkSession, d: str) -> DataFrame:
    """Descriptions of each code up to the 50th by id: the work list of a capped pass."""
    a = table(spark, d, "activities", "id", F.upper(F.trim("issue_code")).alias("code"), "description").where("code <> '' and length(description) > 20")
    return m.top_per_group(a, ["code"], [F.asc("id")], 50).select("code", "rank", "id")


def recent_filings(spark: SparkSession, d: str) -> DataFrame:
    """The 300 latest filings with their topics: the specific ones, and the general ones only where there is no specific one."""
    f = table(spark, d, "filings", F.col("id").alias("filing_id"), "client_id", "filing_date", "income", "is_current").where("is_current and filing_date is not null").join(fx.keyed_clients(spark, d).select("client_id", F.col("client_name").alias("name")), "client_id")
    f = f.orderBy(F.desc("filing_date"), F.desc("filing_id")).limit(300)
    a = table(spark, d, "activities", F.col("id").alias("activity_id"), "filing_id")
    e = table(spark, d, "activity_extractions_rules", "activity_id", F.explode("topics").alias("topic"))
    x = f.join(a.join(e, "activity_id"), "filing_id", "left").groupBy("filing_id", "filing_date", "income", "name").agg(F.sort_array(F.collect_set("topic")).alias("t"))
    special = F.filter("t", lambda c: ~c.startswith("general_"))
    return x.select("filing_id", "filing_date", "income", "name", F.array_join(F.when(F.size(special) > 0, special).otherwise(F.col("t")), ",").alias("topics"))


def busiest_quarters(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "filings", "year", "quarter").groupBy("year", "quarter").agg(F.count(F.lit(1)).alias("n"))
    return n.orderBy(F.desc("n"), "year", "quarter").limit(3)


def last_quarters(spark: SparkSession, d: str) -> DataFrame:
    """The last eight quarters, oldest first."""
    n = table(spark, d, "filings", "year", "quarter", "income").groupBy("year", "quarter").agg(F.count(F.lit(1)).alias("n"), F.sum("income").alias("income"))
    return n.orderBy(F.desc("year"), F.desc("quarter")).limit(8).orderBy("year", "quarter")


def quarter_over_year(spark: SparkSession, d: str) -> DataFrame:
    """Each quarter beside the same quarter of the year before: filings, income, change; seasonal slices are filters of it."""
    n = table(spark, d, "filings", "year", "quarter", "income").groupBy("year", "quarter").agg(F.count(F.lit(1)).alias("n"), F.sum("income").alias("income"))
    w = Window.partitionBy("quarter").orderBy("year")
    return n.withColumn("n_before", F.lag("n").over(w)).withColumn("change_pct", F.round(m.growth_pct(F.col("n"), F.col("n_before")), 6))


def tag_sets(spark: SparkSession, d: str) -> DataFrame:
    """Topics of two years as sets: in either, in both, only in one."""
    x = fx.mentions(fx.star(spark, d), ("topics",)).select("tag", "year")
    a, b = x.where("year = 2023").select("tag").distinct(), x.where("year = 2024").select("tag").distinct()
    named = lambda df, n: df.select(F.lit(n).alias("set_name"), "tag")
    return named(a.union(b).distinct(), "either").unionByName(named(a.intersect(b), "both")).unionByName(named(a.subtract(b), "only_2023")).unionByName(named(b.subtract(a), "only_2024"))


def mirror_drift(spark: SparkSession, d: str) -> DataFrame:
    """Audit runs: filings checked, missing here, and of differing income."""
    from tallyspark.functions.text import canonical_uuid, money

    live = table(spark, d, "filings_mirror", "audit_id", canonical_uuid(F.col("filing_uuid")).alias("k"), F.coalesce(money(F.col("income")), F.lit(0)).alias("live")).distinct()
    here = table(spark, d, "filings", canonical_uuid(F.col("sopr_filing_id")).alias("k"), F.coalesce("income", F.lit(0.0)).cast("decimal(20,4)").alias("stored")).dropDuplicates(["k"])
    x = live.join(here, "k", "left")
    return x.groupBy("audit_id").agg(F.count(F.lit(1)).alias("checked"), F.count_if(F.col("stored").isNull()).alias("missing"), F.count_if(F.abs(F.col("live") - F.col("stored")) > F.lit("0.01").cast("decimal(20,4)")).alias("income_off"))


def coverage_shortfall(spark: SparkSession, d: str) -> DataFrame:
    """Periods with fewer filings here than the mirror knows, beyond a tolerance of 5."""
    from tallyspark.functions.text import canonical_uuid

    want = table(spark, d, "filings_mirror", "year", "quarter", canonical_uuid(F.col("filing_uuid")).alias("k")).distinct().groupBy("year", "quarter").agg(F.count(F.lit(1)).alias("expected"))
    have = table(spark, d, "filings", "year", "quarter", "sopr_filing_id").distinct().groupBy("year", "quarter").agg(F.count(F.lit(1)).alias("actual"))
    x = want.join(have, ["year", "quarter"], "full").select("year", "quarter", F.coalesce("expected", F.lit(0)).alias("expected"), F.coalesce("actual", F.lit(0)).alias("actual"))
    return x.withColumn("short", F.col("expected") - F.col("actual") > 5)


QUERIES = {
    f.__name__: f for f in (period_totals, allocated_income, registrant_totals, client_totals, distinct_parties, frequent_codes, tag_counts, tag_counts_by_quarter, top_clients_per_tag, example_filings_per_tag, issue_shares, usual_name, quarter_distribution, month_seasonality, yearly_growth, tagging_coverage, terms_per_code, top_terms_capped, recent_filings, busiest_quarters, last_quarters, quarter_over_year, tag_sets, mirror_drift, coverage_shortfall)
}

STAR = CLIENT_KEYS + """, s as (select e.activity_id, a.filing_id, f.registrant_id, f.client_id, k.client_key, f.year, f.quarter, f.year * 4 + f.quarter as q, coalesce(f.income, 0) as income, f.filing_date, a.issue_code, topics, entities, legislation, c.name as client_name
    from activity_extractions_rules e join activities a on a.id = e.activity_id join filings f on f.id = a.filing_id join clients c on c.id = f.client_id join ck k on k.client_id = f.client_id and not k.excluded join registrants r on r.id = f.registrant_id where f.is_current)"""
TIDY = "trim(regexp_replace(regexp_replace(x, '[\\s\\x{00A0}]+', ' ', 'g'), '^ | $', '', 'g'))"
_CHAMBERS = "('HOUSE OF REPRESENTATIVES', 'U.S. HOUSE OF REPRESENTATIVES', 'SENATE', 'U.S. SENATE', 'CONGRESS', 'U.S. CONGRESS')"
MENTIONS = STAR + f""", t as (select s.* exclude (topics, entities, legislation), 'topics' as kind, {TIDY} as tag from s, unnest(topics) u(x) where {TIDY} <> '' and not starts_with({TIDY}, 'general_')),
    n as (select s.* exclude (topics, entities, legislation), 'entities' as kind, {TIDY} as tag from s, unnest(entities) u(x) where {TIDY} <> '' and upper({TIDY}) not in {_CHAMBERS}),
    l as (select distinct s.* exclude (topics, entities, legislation), 'legislation' as kind, {TIDY} as tag from s, unnest(legislation) u(x) where {TIDY} <> ''),
    x as (select * from t union all select * from n union all select * from l)"""
_LABELS = "l as (select id as activity_id, filing_id, upper(trim(issue_code)) as label from activities where trim(issue_code) <> '')"
_KEY = "regexp_replace(lower(filing_uuid), '[^0-9a-f]', '', 'g')"

ORACLE = {
    "period_totals": "select year, quarter, count(*) as filings, sum(income) as income, count(distinct client_id) as clients from filings where is_current group by 1, 2",
    "allocated_income": f"""with {_LABELS}, n as (select filing_id, count(*) as n from activities group by 1)
        select label, year, quarter, round(sum(income / n), 4) as income, count(*) as n from l join filings f on f.id = l.filing_id join n using (filing_id) where income > 0 group by 1, 2, 3""",
    "registrant_totals": "select registrant_id, year, quarter, sum(income) as income, count(*) as n, any_value(r.name) as name from filings f join registrants r on r.id = registrant_id where income > 0 group by 1, 2, 3",
    "client_totals": "select client_id, year, quarter, sum(income) as income, count(*) as n, any_value(c.name) as name from filings f join clients c on c.id = client_id where income > 0 group by 1, 2, 3",
    "distinct_parties": f"with {_LABELS} select label, count(distinct client_id) as clients, count(distinct registrant_id) as registrants, count(*) filter (income > 0) as paid, avg(income) as mean_income, min(year) as first_year, max(year) as last_year from l join filings f on f.id = l.filing_id group by 1",
    "frequent_codes": f"with {_LABELS} select label, count(*) as n from l group by 1 having count(*) >= 20",
    "tag_counts": f"""with {MENTIONS}, f as (select kind, tag, filing_id, any_value(income) as income from x group by 1, 2, 3)
        select kind, tag, count(*) as mentions, count(distinct filing_id) as filings, count(distinct client_key) as clients, (select sum(income) from f where f.kind = x.kind and f.tag = x.tag) as income from x group by kind, tag""",
    "tag_counts_by_quarter": f"""with {MENTIONS}, g as (select kind, tag, q, filing_id, client_key, any_value(income) as income, count(*) as n from x where kind = 'topics' group by 1, 2, 3, 4, 5)
        select kind, tag, q, cast(sum(n) as bigint) as mentions, count(*) as filings, count(distinct client_key) as clients, sum(income) as income from g group by 1, 2, 3""",
    "top_clients_per_tag": f"""with {MENTIONS}, g as (select distinct kind, tag, filing_id, client_key, income, client_name from x where kind <> 'legislation'), h as (select kind, tag, client_key, sum(income) as income, max(client_name) as client_name from g group by 1, 2, 3)
        select * from (select *, cast(row_number() over (partition by kind, tag order by income desc, client_key) as int) as rank from h) where rank <= 10""",
    "example_filings_per_tag": f"""with {MENTIONS}, g as (select distinct tag, filing_id, filing_date, income from x where kind = 'topics')
        select tag, rank, filing_id from (select *, cast(row_number() over (partition by tag order by filing_date desc nulls last, income desc, filing_id desc) as int) as rank from g) where rank <= 8""",
    "issue_shares": f"with {_LABELS}, n as (select label, year, registrant_id, count(*) as n from l join filings f on f.id = l.filing_id group by 1, 2, 3) select *, n / sum(n) over (partition by label, year) as share from n",
    "usual_name": """with n as (select trim(normalized_name) as party, name, count(*) as n from filings f join clients c on c.id = f.client_id where normalized_name is not null and name is not null group by 1, 2)
        select party, name, n from (select *, row_number() over (partition by party order by n desc, length(name), name) as rn from n) where rn = 1""",
    "quarter_distribution": f"""with {_LABELS}, n as (select label, year * 4 + quarter as q, count(*) as n from l join filings f on f.id = l.filing_id group by 1, 2),
        p as (select distinct label, u.q from n, (select unnest(range((select min(q) from n), (select max(q) + 1 from n))) as q) u), e as (select p.label, p.q, coalesce(n.n, 0) as n from p left join n using (label, q)),
        s as (select label, list(n order by n) as v, list(n order by q) as t from e group by 1)
        select label, v[1] as least, v[cast(round_even((len(v) - 1) * 0.5, 0) as int) + 1] as median, v[cast(round_even((len(v) - 1) * 0.9, 0) as int) + 1] as p90, v[-1] as most,
        cast(list_sum(t[-4:]) as bigint) as last_four, cast(list_sum(t[-8:-5]) as bigint) as four_before from s""",
    "month_seasonality": "with n as (select substr(ltrim(filing_date), 1, 7) as month, count(*) as n from filings where filing_date is not null group by 1) select cast(substr(month, 6, 2) as int) as month_no, avg(n) as mean, month_no in (1, 4, 7, 10) as due from n group by 1",
    "yearly_growth": """with y as (select year, count(*) as n, sum(income) as income from filings group by 1) select year, n, income, lag(n) over (order by year) as n_before, round((n - lag(n) over (order by year)) * 100.0::double / lag(n) over (order by year), 6) as change_pct,
        case when year > first(year) over (order by year) then round((pow(n::double / first(n) over (order by year), 1.0::double / (year - first(year) over (order by year))) - 1) * 100, 6) end as cagr_pct from y""",
    "tagging_coverage": """with x as (select upper(trim(issue_code)) as code, e.activity_id is not null as tagged, coalesce(len(list_filter(topics, lambda x: not starts_with(x, 'general_'))) > 0, false) as specific from activities a left join activity_extractions_rules e on e.activity_id = a.id)
        select code, count(*) as n, count(*) filter (tagged) as n_tagged, count(*) filter (specific) as n_specific, round(count(*) filter (tagged) * 100::double / count(*), 3) as pct_tagged,
        round(coalesce(count(*) filter (specific) * 100::double / nullif(count(*) filter (tagged), 0), 0), 3) as pct_specific from x group by 1""",
    "terms_per_code": """with w as (select upper(trim(issue_code)) as code, unnest(list_distinct(regexp_extract_all(lower(description), '[a-z][a-z0-9-]{2,}'))) as term from activities where description is not null and trim(issue_code) <> ''),
        n as (select code, term, count(*) as in_code from w group by 1, 2) select * from (select *, cast(sum(in_code) over (partition by term) as bigint) as in_all from n) where in_code >= 3""",
    "top_terms_capped": "select code, rank, id from (select id, upper(trim(issue_code)) as code, cast(row_number() over (partition by upper(trim(issue_code)) order by id) as int) as rank from activities where trim(issue_code) <> '' and length(description) > 20) where rank <= 50",
    "recent_filings": f"""with {CLIENT_KEYS}, f as (select f.*, c.name from filings f join ck on ck.client_id = f.client_id and not excluded join clients c on c.id = f.client_id where is_current and filing_date is not null order by filing_date desc, f.id desc limit 300),
        t as (select f.id, list_sort(list_distinct(list(topic))) as t from f join activities a on a.filing_id = f.id join (select activity_id, unnest(topics) as topic from activity_extractions_rules) e on e.activity_id = a.id where topic is not null group by 1),
        s as (select *, list_filter(t, lambda x: not starts_with(x, 'general_')) as s from t) select f.id as filing_id, filing_date, income, name, coalesce(array_to_string(case when len(s) > 0 then s else t end, ','), '') as topics from f left join s using (id)""",
    "busiest_quarters": "select year, quarter, count(*) as n from filings group by 1, 2 order by n desc, year, quarter limit 3",
    "last_quarters": "select * from (select year, quarter, count(*) as n, sum(income) as income from filings group by 1, 2 order by year desc, quarter desc limit 8) order by year, quarter",
    "quarter_over_year": "with n as (select year, quarter, count(*) as n, sum(income) as income from filings group by 1, 2), b as (select *, lag(n) over (partition by quarter order by year) as n_before from n) select *, round((n - n_before) * 100::double / n_before, 6) as change_pct from b",
    "tag_sets": f"""with {MENTIONS}, a as (select distinct tag from x where kind = 'topics' and year = 2023), b as (select distinct tag from x where kind = 'topics' and year = 2024)
        select 'either' as set_name, tag from (select tag from a union select tag from b) union all select 'both', tag from (select tag from a intersect select tag from b)
        union all select 'only_2023', tag from (select tag from a except select tag from b) union all select 'only_2024', tag from (select tag from b except select tag from a)""",
    "mirror_drift": f"""with m as (select distinct audit_id, {_KEY} as k, coalesce(try_cast(regexp_replace(upper(income), '[\\s$,]|USD', '', 'g') as decimal(20,4)), 0) as live from filings_mirror),
        f as (select replace(sopr_filing_id, '-', '') as k, max(coalesce(income, 0)::decimal(20,4)) as stored from filings group by 1)
        select audit_id, count(*) as checked, count(*) filter (stored is null) as missing, count(*) filter (abs(live - stored) > 0.01) as income_off from m left join f using (k) group by 1""",
    "coverage_shortfall": f"""with w as (select year, quarter, count(distinct {_KEY}) as expected from filings_mirror group by 1, 2), h as (select year, quarter, count(distinct sopr_filing_id) as actual from filings group by 1, 2)
        select year, quarter, coalesce(expected, 0) as expected, coalesce(actual, 0) as actual, coalesce(expected, 0) - coalesce(actual, 0) > 5 as short from w full join h using (year, quarter)""",
}
