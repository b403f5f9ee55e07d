"""Queries behind reports: statistics of the tags, cards, contexts, point lookups, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tallyspark.functions import canon, periods
from tallyspark.functions.text import canonical_uuid, money
from tallyspark.operators import facts as fx, measures as m, tagging as tg, trends as tr, versioning as v
from tallyspark.plans import q_trends as qt
from tallyspark.plans.q_measures import MENTIONS, STAR
from tallyspark.sources.tables import table

GROUPS = (("farms", ("crop", "dairy", "hog", "grain")), ("money", ("bank", "loan", "tax", "credit")), ("power", ("grid", "turbine", "reactor")), ("travel", ("airport", "rail", "bus", "ferry")), ("care", ("hospital", "nurs", "drug")))
AGENCY_NAMES = {"BRKE": "Bureau of Reefs, Kelp and Estuaries", "OMMK": "Office of Mines, Mills and Kilns", "US Senate": "Senate", "U.S. Senate": "Senate", "the Senate": "Senate"}


def extraction_stats(spark: SparkSession, d: str) -> DataFrame:
    """Of the extractions: rows, tagged, with laws, with entities; and the ten most frequent coarse topics."""
    e = table(spark, d, "activity_extractions_rules", "coarse_topic", "topics", "entities", "legislation")
    some = lambda c: F.count_if(F.coalesce(F.size(c), F.lit(0)) > 0)
    total = e.agg(F.count(F.lit(1)).alias("rows"), some("topics").alias("tagged"), some("entities").alias("with_entities"), some("legislation").alias("with_laws"))
    one = total.select(F.explode(F.array(*[F.struct(F.lit("total").alias("part"), F.lit(c).alias("name"), F.col(c).alias("n")) for c in total.columns])).alias("x")).select("x.*")
    top = e.where("coarse_topic is not null").groupBy(F.col("coarse_topic").alias("name")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "name").limit(10)
    return one.unionByName(top.select(F.lit("coarse_topic").alias("part"), "name", "n"))


def mover_cards(spark: SparkSession, d: str) -> DataFrame:
    """The ten strongest topic movers, each with its top three clients by income and its latest filing."""
    top = qt.tag_changes(spark, d, kinds=("topics",), least=2).where("rank <= 10").select("tag", "count", F.round("delta_pp", 6).alias("delta_pp"))
    x = fx.mentions(fx.star(spark, d), ("topics",)).join(F.broadcast(top.select("tag")), "tag", "left_semi")  # ten rows
    clients = m.top_per_group(m.tag_clients(x), ["kind", "tag"], [F.desc("income"), F.asc("client_key")], 3).groupBy("tag").agg(F.expr("array_join(transform(array_sort(collect_list(struct(rank, client_key))), x -> x.client_key), ',')").alias("clients"))
    latest = x.groupBy("tag").agg(F.max(F.struct("q", "filing_id")).alias("l")).select("tag", F.col("l.filing_id").alias("latest_filing"))
    return top.join(clients, "tag", "left").join(latest, "tag", "left")


def narrative_context(spark: SparkSession, d: str) -> DataFrame:
    """What a text on the greatest client would cite: its last eight quarters of income and its five most frequent codes."""
    f = table(spark, d, "filings", F.col("id").alias("filing_id"), "client_id", "year", "quarter", "income").where("client_id = 1")
    a = table(spark, d, "activities", "filing_id", F.upper(F.trim("issue_code")).alias("code")).where("code <> ''")
    q = f.groupBy(periods.q_index().alias("q")).agg(F.sum("income").alias("value")).orderBy(F.desc("q")).limit(8)
    c = a.join(f, "filing_id").groupBy("code").agg(F.count(F.lit(1)).cast("double").alias("value")).orderBy(F.desc("value"), "code").limit(5)
    return q.select(F.lit("quarter").alias("part"), F.col("q").cast("string").alias("name"), "value").unionByName(c.select(F.lit("code").alias("part"), F.col("code").alias("name"), "value"))


def named_offices(spark: SparkSession, d: str) -> DataFrame:
    """Entities through a table of names, each once per activity, counted."""
    e = table(spark, d, "activity_extractions_rules", "activity_id", "entities")
    return e.select(F.explode(canon.apply_names(F.col("entities"), AGENCY_NAMES)).alias("entity")).groupBy("entity").agg(F.count(F.lit(1)).alias("n")).where("n >= 5")


def group_tags(spark: SparkSession, d: str) -> DataFrame:
    x = tg.group_tags(table(spark, d, "activities", "id", "description"), GROUPS, most=3)
    return x.where(F.size("groups") > 0).select("id", F.array_join("groups", ",").alias("groups"))


def filled_clients(spark: SparkSession, d: str) -> DataFrame:
    """Clients with the industry that others of the same normalized name state, where their own is null."""
    c = table(spark, d, "clients", "id", F.trim("normalized_name").alias("party"), "industry")
    return v.fill_from(c.where("party is not null"), c.where("party is not null and industry is not null"), "party", ["industry"])


def sampled_audit(spark: SparkSession, d: str) -> DataFrame:
    """A hundred filings drawn by a hash, beside their live copies: missing there, or of another income or type."""
    f = table(spark, d, "filings", canonical_uuid(F.col("sopr_filing_id")).alias("k"), F.coalesce("income", F.lit(0.0)).cast("decimal(20,4)").alias("income"), "filing_type").dropDuplicates(["k"])
    drawn = f.orderBy(F.md5("k")).limit(100)
    live = table(spark, d, "filings_mirror", canonical_uuid(F.col("filing_uuid")).alias("k"), F.coalesce(money(F.col("income")), F.lit(0)).alias("live"), F.upper(F.trim("filing_type")).alias("live_type"), "fetched_at")
    last = live.groupBy("k").agg(F.max(F.struct("fetched_at", "live", "live_type")).alias("l"))
    x = drawn.join(last, "k", "left")
    return x.select("k", F.col("l").isNull().alias("missing"), F.coalesce(F.abs(F.col("l.live") - F.col("income")) > F.lit("0.01").cast("decimal(20,4)"), F.lit(False)).alias("income_off"), F.coalesce(F.col("l.live_type") != F.col("filing_type"), F.lit(False)).alias("type_off"))


def topic_drilldown(spark: SparkSession, d: str) -> DataFrame:
    """Everything on one topic, quarter by quarter: mentions, filings, clients, income, share of all mentions."""
    x = fx.mentions(fx.star(spark, d), ("topics",))
    total = x.groupBy("q").agg(F.count(F.lit(1)).alias("all"))
    return m.count_mentions(x.where("tag = 'drug_rebates'"), "q").join(total, "q").select("q", "mentions", "filings", "clients", "income", F.round(F.col("mentions") * 100 / F.col("all"), 6).alias("share"))


def normalized_series(spark: SparkSession, d: str) -> DataFrame:
    """Quarterly mentions of each coarse topic as a share of the quarter, and its place in the quarter."""
    e = table(spark, d, "activity_extractions_rules", "activity_id", "coarse_topic")
    x = e.join(fx.star(spark, d).select("activity_id", "q"), "activity_id").groupBy("q", "coarse_topic").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("q")
    return x.select("q", "coarse_topic", "n", F.round(F.col("n") * 100 / F.sum("n").over(w), 6).alias("share"), F.row_number().over(w.orderBy(F.desc("n"), "coarse_topic")).alias("place"))


def coded_labels(spark: SparkSession, d: str) -> DataFrame:
    """Labels within the taxonomy, with the mean length of their descriptions; others are left out."""
    a = table(spark, d, "activities", F.upper(F.trim("issue_code")).alias("label"), "description")
    return a.where(F.col("label").isin(*canon.CODE_LABELS)).groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(F.length("description")), 6).alias("mean_length"), F.count_if(F.length("description") < 20).alias("n_short"))


def record_history(spark: SparkSession, d: str) -> DataFrame:
    """Each registrant's quarters with the highest earlier value and the part of its values below."""
    from tallyspark.operators.signals import history

    return qt._rounded(history(qt._series(spark, d, "registrant_id"), "registrant_id"))


def quarters_to_anchor(spark: SparkSession, d: str) -> DataFrame:
    """Each quarter with its last day and whether it is complete at the data's anchor."""
    f = table(spark, d, "filings", "year", "quarter", "filing_date")
    last = tr.last_complete(tr.anchor_day(f))
    q = periods.q_index()
    return f.select("year", "quarter").distinct().select("year", "quarter", periods.quarter_end(q).alias("ends_on"), (q <= F.lit(last)).alias("complete"))


QUERIES = {
    f.__name__: f for f in (extraction_stats, mover_cards, narrative_context, named_offices, group_tags, filled_clients, sampled_audit, topic_drilldown, normalized_series, coded_labels, record_history, quarters_to_anchor)
}

_KEY = "regexp_replace(regexp_replace(lower(filing_uuid), '[^0-9a-f]', '', 'g'), '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\\1-\\2-\\3-\\4-\\5')"
_MOVER = qt.change_sql("topics", least=2)
_NAMES = ", ".join(f"('{a}', '{b}')" for a, b in AGENCY_NAMES.items())
_GROUP_ROWS = ", ".join(f"('{n}', '{p}')" for n, ps in GROUPS for p in ps)

ORACLE = {
    "extraction_stats": """with t as (select count(*) as rows, count(*) filter (len(topics) > 0) as tagged, count(*) filter (len(entities) > 0) as with_entities, count(*) filter (len(legislation) > 0) as with_laws from activity_extractions_rules),
        c as (select coarse_topic as name, count(*) as n from activity_extractions_rules where coarse_topic is not null group by 1 order by n desc, name limit 10)
        select 'total' as part, unnest(['rows', 'tagged', 'with_entities', 'with_laws']) as name, unnest([rows, tagged, with_entities, with_laws]) as n from t union all select 'coarse_topic', name, n from c""",
    "mover_cards": f"""with {MENTIONS}, top as (select tag, count, delta_pp, row_number() over () as o from ({_MOVER}) limit 10), y as (select * from x where kind = 'topics' and tag in (select tag from top)),
        g as (select distinct tag, filing_id, client_key, income from y), h as (select tag, client_key, sum(income) as income from g group by 1, 2), r as (select *, row_number() over (partition by tag order by income desc, client_key) as rank from h),
        lt as (select tag, max(struct_pack(q := q, f := filing_id)) as z from y group by 1), cl as (select tag, string_agg(client_key, ',' order by rank) as clients from r where rank <= 3 group by 1)
        select top.tag, top.count, top.delta_pp, clients, lt.z.f as latest_filing from top left join cl on cl.tag = top.tag left join lt on lt.tag = top.tag""",
    "narrative_context": """select * from (select 'quarter' as part, cast(year * 4 + quarter as varchar) as name, sum(income) as value from filings where client_id = 1 group by year * 4 + quarter order by year * 4 + quarter desc limit 8)
        union all select * from (select 'code', upper(trim(issue_code)) as code, cast(count(*) as double) as value from activities a join filings f on f.id = a.filing_id where client_id = 1 and trim(issue_code) <> '' group by 2 order by value desc, code limit 5)""",
    "named_offices": f"""with e as (select activity_id, unnest(entities) as x from activity_extractions_rules), n as (select distinct activity_id, coalesce(t.b, e.x) as entity from e left join (values {_NAMES}) t(a, b) on t.a = e.x) select entity, count(*) as n from n group by 1 having count(*) >= 5""",
    "group_tags": f"""with h as (select distinct a.id, t.n from activities a join (values {_GROUP_ROWS}) t(n, p) on contains(lower(a.description), t.p)), r as (select *, row_number() over (partition by id order by n) as rn from h) select id, string_agg(n, ',' order by n) as groups from r where rn <= 3 group by 1""",
    "filled_clients": """with i as (select trim(normalized_name) as party, max(industry) as industry from clients where normalized_name is not null and industry is not null group by 1)
        select c.id, trim(c.normalized_name) as party, coalesce(c.industry, i.industry) as industry from clients c left join i on i.party = trim(c.normalized_name) where c.normalized_name is not null""",
    "sampled_audit": f"""with f as (select sopr_filing_id as k, any_value(coalesce(income, 0)::decimal(20,4)) as income, any_value(filing_type) as filing_type from filings group by 1 order by md5(sopr_filing_id) limit 100),
        l as (select {_KEY} as k, max(struct_pack(a := fetched_at, live := coalesce(try_cast(regexp_replace(upper(income), '[\\s$,]|USD', '', 'g') as decimal(20,4)), 0), t := upper(trim(filing_type)))) as l from filings_mirror group by 1)
        select f.k, l.k is null as missing, coalesce(abs(l.l.live - income) > 0.01, false) as income_off, coalesce(l.l.t <> filing_type, false) as type_off from f left join l using (k)""",
    "topic_drilldown": f"""with {MENTIONS}, tot as (select q, count(*) as n from x where kind = 'topics' group by 1), g as (select q, filing_id, client_key, any_value(income) as income, count(*) as n from x where kind = 'topics' and tag = 'drug_rebates' group by 1, 2, 3)
        select g.q, cast(sum(g.n) as bigint) as mentions, count(*) as filings, count(distinct client_key) as clients, sum(income) as income, round(sum(g.n) * 100::double / any_value(tot.n), 6) as share from g join tot on tot.q = g.q group by 1""",
    "normalized_series": f"""with {STAR}, n as (select s.q, e.coarse_topic, count(*) as n from activity_extractions_rules e join s using (activity_id) group by 1, 2)
        select q, coarse_topic, n, round(n * 100::double / sum(n) over (partition by q), 6) as share, cast(row_number() over (partition by q order by n desc, coarse_topic nulls first) as int) as place from n""",
    "coded_labels": f"select upper(trim(issue_code)) as label, count(*) as n, round(avg(length(description)), 6) as mean_length, count(*) filter (length(description) < 20) as n_short from activities where upper(trim(issue_code)) in ({', '.join(repr(c) for c in canon.CODE_LABELS)}) group by 1",
    "record_history": """with s as (select registrant_id, year * 4 + quarter as q, sum(income) as value from filings where income > 0 and registrant_id is not null group by 1, 2)
        select *, max(value) over (partition by registrant_id order by q rows between unbounded preceding and 1 preceding) as most_before, count(*) over (partition by registrant_id) as periods, sum(value) over (partition by registrant_id) as total,
        round((rank() over (partition by registrant_id order by value) - 1) / count(*) over (partition by registrant_id), 6) as below, q = max(q) over (partition by registrant_id) as last from s""",
    "quarters_to_anchor": """with a as (select max(cast(substr(ltrim(filing_date), 1, 10) as date)) + 1 as anchor from filings) select distinct f.year, f.quarter, last_day(make_date(f.year, f.quarter * 3, 1)) as ends_on, anchor > last_day(make_date(f.year, f.quarter * 3, 1)) + 40 as complete from filings f, a""",
}
