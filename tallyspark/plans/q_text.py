"""Queries that tag texts, mine dictionaries, name things canonically and search, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyspark.functions import canon
from tallyspark.functions.text import squeeze
from tallyspark.operators import audit as au, facts as fx, measures as m, search as se, tagging as tg, versioning as v
from tallyspark.plans import q_trends as qt
from tallyspark.plans.keys_sql import CLIENT_KEYS
from tallyspark.plans.q_measures import MENTIONS
from tallyspark.plans.rules import DICTIONARY, RULES
from tallyspark.sources.tables import table

LABELS = {t["id"]: t["label"] for t in RULES["topics"]}


def _acts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "activities", "id", "description", F.upper(F.trim("issue_code")).alias("issue_code"), "agencies", "houses_lobbied")


def rule_topics(spark: SparkSession, d: str) -> DataFrame:
    x = tg.topics(_acts(spark, d), tg.load_rules(RULES))
    return x.select("id", F.posexplode("topics").alias("pos", "topic"), "topic_scores", "topic_evidence").select("id", (F.col("pos") + 1).alias("pos"), "topic", F.round(F.try_element_at("topic_scores", "topic"), 6).alias("score"), F.try_element_at("topic_evidence", "topic")["assignment_tier"].alias("tier"))


def rule_extractions(spark: SparkSession, d: str) -> DataFrame:
    """Extraction rows of the activities that have none yet, as the batch job would store them."""
    x = tg.extract(_acts(spark, d), table(spark, d, "activity_extractions_rules", "activity_id"), tg.load_rules(RULES), "rules-1")
    return x.select("activity_id", "l0_issue_code", "coarse_topic", F.to_json("topics").alias("topics"), F.to_json("topic_scores").alias("topic_scores"), F.to_json("topic_evidence").alias("topic_evidence"), F.to_json("entities").alias("entities"), F.to_json("legislation").alias("legislation"), "extractor_version")


def coarse_topics(spark: SparkSession, d: str) -> DataFrame:
    a = _acts(spark, d)
    general = canon.fallback_topic(F.col("issue_code"))
    return a.groupBy("issue_code", canon.coarse_topic(F.col("issue_code")).alias("coarse"), general.alias("general"), F.when(general.isNotNull(), canon.display_topic(general)).alias("shown")).agg(F.count(F.lit(1)).alias("n"))


def law_references(spark: SparkSession, d: str) -> DataFrame:
    x = _acts(spark, d).select("id", F.posexplode(tg.laws(F.col("description"))).alias("p", "reference"))
    return x.select("id", (F.col("p") + 1).alias("pos"), "reference")


def named_entities(spark: SparkSession, d: str) -> DataFrame:
    x = _acts(spark, d).select("id", F.posexplode(tg.entities(F.col("description"), F.col("agencies"), F.col("houses_lobbied"))).alias("p", "label"))
    return x.select("id", (F.col("p") + 1).alias("pos"), "label")


def dictionary_matches(spark: SparkSession, d: str) -> DataFrame:
    return tg.dictionary_matches(_acts(spark, d), "id", "description", DICTIONARY)


def dictionary_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Of each label of the dictionary: activities, phrases that hit, percent of all activities."""
    total = _acts(spark, d).agg(F.count(F.lit(1)).alias("all"))
    n = dictionary_matches(spark, d).groupBy("label").agg(F.countDistinct("id").alias("n"), F.countDistinct("phrase").alias("phrases"))
    return n.crossJoin(F.broadcast(total)).select("label", "n", "phrases", F.round(F.col("n") * 100 / F.col("all"), 6).alias("pct"))


def uncovered(spark: SparkSession, d: str) -> DataFrame:
    """Newest activities that no phrase covers."""
    a = _acts(spark, d).where("length(description) > 20")
    return a.join(dictionary_matches(spark, d).select("id").distinct(), "id", "left_anti").orderBy(F.desc("id")).limit(200).select("id", "description")


def mining_terms(spark: SparkSession, d: str) -> DataFrame:
    x = _acts(spark, d).select(F.explode(tg.mining_terms(F.col("description"))).alias("term"))
    return x.groupBy("term").agg(F.count(F.lit(1)).alias("n")).where("n >= 5")


def _candidates(spark: SparkSession, d: str) -> DataFrame:
    return tg.mine_candidates(_acts(spark, d).select("id", F.col("issue_code").alias("code"), F.col("description").alias("text")), least_df=5, least_lift=2.0, top=20)


def candidate_terms(spark: SparkSession, d: str) -> DataFrame:
    return _candidates(spark, d).select("code", "rank", "term", "ngram", "doc_freq", "issue_doc_count", "corpus_doc_count", F.round("lift", 6).alias("lift"), F.round("score", 6).alias("score"))


def gap_report(spark: SparkSession, d: str) -> DataFrame:
    a = _acts(spark, d).where("issue_code <> ''")
    done = table(spark, d, "activity_extractions_rules", F.col("activity_id").alias("id"), "topics")
    specific = F.exists("topics", lambda x: ~x.startswith("general_"))
    cover = a.join(done, "id", "left").groupBy(F.col("issue_code").alias("code")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(F.when(specific, 100.0).otherwise(0.0)), 3).alias("pct"))
    open_ = a.join(done.where(specific), "id", "left_anti").select(F.col("issue_code").alias("code"), "id", F.substring(F.replace("description", F.lit("\n"), F.lit(" ")), 1, 220).alias("snippet"))
    x = tg.gap_report(cover, _candidates(spark, d), open_)
    return x.select("code", "n", "pct", F.array_join("terms", ";").alias("terms"), F.array_join("snippets", " || ").alias("snippets"))


def unmapped_sample(spark: SparkSession, d: str) -> DataFrame:
    """Fifty untagged descriptions, drawn by a hash."""
    a = _acts(spark, d).where("length(description) > 20")
    x = v.pending(a, table(spark, d, "activity_extractions_rules", F.col("activity_id").alias("id")), "id")
    return x.orderBy(F.md5(F.concat(F.col("id").cast("string"), F.lit("7"))), "id").limit(50).select("id", "issue_code", F.substring(F.replace("description", F.lit("\n"), F.lit(" ")), 1, 220).alias("snippet"))


def variant_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Entities typed more than once that nearly match."""
    e = table(spark, d, "activity_extractions_rules", F.explode("entities").alias("entity"))
    return tg.near_variants(e, "entity")


def _client_income(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "filings", "client_id", "income", "is_current").where("is_current").groupBy("client_id").agg(F.sum("income").alias("income"))
    return table(spark, d, "clients", F.col("id").alias("client_id"), "name").join(f, "client_id", "left").select("name", F.coalesce("income", F.lit(0.0)).alias("income"))


def rename_evidence(spark: SparkSession, d: str) -> DataFrame:
    """Former names given in names, with what their own keys still hold."""
    return au.rename_candidates(_client_income(spark, d), 0.0)


def quarter_outliers(spark: SparkSession, d: str) -> DataFrame:
    """The greatest quarter of each client that reaches half a million."""
    f = table(spark, d, "filings", "client_id", "year", "quarter", F.coalesce("income", F.lit(0.0)).alias("income"), "is_current").where("is_current")
    return au.quarter_outliers(f.join(canon.client_keys(table(spark, d, "clients", "id", "name")), "client_id"), 5e5)


def prefix_pairs(spark: SparkSession, d: str) -> DataFrame:
    return tg.prefix_pairs(table(spark, d, "clients", F.upper(squeeze(F.col("name"))).alias("key")))


def client_keys(spark: SparkSession, d: str) -> DataFrame:
    """Clients with the key of their canonical name; keys are worked out for distinct names and joined back."""
    c = table(spark, d, "clients", "id", "name")
    return c.join(canon.canonical_names(c), "name", "left").select("id", "key")


def identity_review(spark: SparkSession, d: str) -> DataFrame:
    """Spellings, filings and greatest single income of each client key with several spellings."""
    c = client_keys(spark, d).join(table(spark, d, "clients", "id", "name"), "id")
    f = table(spark, d, "filings", F.col("client_id").alias("id"), "income")
    x = f.join(c, "id").groupBy("key").agg(F.countDistinct("name").alias("spellings"), F.count(F.lit(1)).alias("filings"), F.max("income").alias("greatest"))
    return x.where("spellings > 1")


def usual_display_names(spark: SparkSession, d: str) -> DataFrame:
    """The most frequent spelling of each client key, as display form."""
    c = client_keys(spark, d).join(table(spark, d, "clients", "id", "name"), "id")
    best = m.most_frequent(c.where("key <> ''"), "key", "name")
    show = F.pandas_udf(lambda s: s.map(lambda n: canon.display_name([n])), "string")
    return best.select("key", show("name").alias("shown"), "n")


def canonical_laws(spark: SparkSession, d: str) -> DataFrame:
    """Mentions per law after folding names, numbers and public laws of the filings' years."""
    x = fx.star(spark, d).select("activity_id", "year", F.explode("legislation").alias("tag"))
    law = canon.with_legislation(x, "tag", "year")
    return law.where("law <> ''").select("activity_id", "law").distinct().groupBy("law").agg(F.count(F.lit(1)).alias("n"), F.max(canon.bill_url(F.col("law"))).alias("url"))


def alias_review(spark: SparkSession, d: str) -> DataFrame:
    """Law tags that no table names, of ten mentions or more, and the most frequent that name nothing."""
    return au.alias_gaps(fx.star(spark, d).select("year", F.explode("legislation").alias("tag")), least=10)


def normalized_tags(spark: SparkSession, d: str) -> DataFrame:
    """Free-entered tags under the plain normalizers: space, phrase form, label form, display form."""
    e = table(spark, d, "activity_extractions_rules", F.explode("topics").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("n"))
    return e.select("t", "n", squeeze(F.col("t")).alias("tag"), canon.phrase(F.col("t")).alias("phrase"), canon.phrase_label(F.col("t")).alias("label"))


def client_search(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "clients", F.col("id").alias("client_id"), "name")
    n = table(spark, d, "filings", "client_id").groupBy("client_id").agg(F.count(F.lit(1)).alias("n"))
    return se.search(c.join(n, "client_id", "left").withColumn("n", F.coalesce("n", F.lit(0))), "city of").select("client_id", "name", "n", "score")


def _movers(spark: SparkSession, d: str) -> DataFrame:
    return se.merged_movers(qt.tag_changes(spark, d, least=2).withColumnRenamed("kind", "category"), most=200)


def merged_movers(spark: SparkSession, d: str) -> DataFrame:
    return qt._rounded(_movers(spark, d))


def digest(spark: SparkSession, d: str) -> DataFrame:
    return qt._rounded(se.digest(_movers(spark, d)))


def hero_picks(spark: SparkSession, d: str) -> DataFrame:
    return qt._rounded(se.hero_picks(_movers(spark, d), least=3))


def org_ramps(spark: SparkSession, d: str) -> DataFrame:
    """Risers and new entrants in one list by what they added, with strength and direction."""
    x = qt.client_movers(spark, d).where("kind in ('riser', 'new_entrant')")
    return x.select("client_key", "kind", "delta", se.intensity(F.try_divide("now", "before")).alias("intensity"), se.direction(F.round(m.growth_pct(F.col("now"), F.col("before")), 6)).alias("direction")).orderBy(F.desc("delta"), "client_key").limit(30)


def client_drilldown(spark: SparkSession, d: str) -> DataFrame:
    """The topics of one client (that of id 1, in all its spellings) with its filings and mentions, and its rank among the clients of each topic by mentions."""
    x = fx.mentions(fx.star(spark, d, excluded=True), ("topics",))
    per = x.groupBy("tag", "client_key").agg(F.count(F.lit(1)).alias("mentions"), F.count_distinct("filing_id").alias("filings"), F.min("q").alias("first_q"), F.max("q").alias("last_q"))
    own = fx.keyed_clients(spark, d, excluded=True).where("client_id = 1").select("client_key")
    mine = per.join(F.broadcast(own), "client_key").drop("client_key")  # one row
    # clients of the topic with more mentions, counted instead of ranked, so that a topic of many clients meets in no task
    more = per.select("tag", F.col("mentions").alias("other")).join(mine.select("tag", "mentions"), "tag").groupBy("tag").agg(F.count_if(F.col("other") > F.col("mentions")).alias("more"))
    return mine.join(more, "tag").select("tag", "filings", "mentions", "first_q", "last_q", (F.col("more") + 1).alias("rank"))


QUERIES = {
    f.__name__: f for f in (rule_topics, rule_extractions, coarse_topics, law_references, named_entities, dictionary_matches, dictionary_coverage, uncovered, mining_terms, candidate_terms, gap_report, unmapped_sample, variant_pairs, rename_evidence, quarter_outliers, prefix_pairs, client_keys, identity_review, usual_display_names, canonical_laws, alias_review, normalized_tags, client_search, merged_movers, digest, hero_picks, org_ramps, client_drilldown)
}


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(_q(x) if isinstance(x, str) else str(x).lower() if isinstance(x, bool) else str(x) for x in r) + ")" for r in rows)


_LOW = "trim(regexp_replace(regexp_replace(lower(coalesce({}, '')), '[\\s\\x{{00A0}}]+', ' ', 'g'), '^ +| +$', '', 'g'))"
_HIT = "case when contains({p}, ' ') or length({p}) > 4 then contains({t}, {p}) else contains(' ' || regexp_replace({t}, '[^a-z0-9]+', ' ', 'g') || ' ', ' ' || regexp_replace({p}, '[^a-z0-9]+', ' ', 'g') || ' ') end"
_RULES = tg.load_rules(RULES)
_PHRASES = [(t["id"], kind, i, p) for t in _RULES for kind in ("keywords", "programs", "acts", "exclude") for i, p in enumerate(t[kind])]
_CODES = [(t["id"], c) for t in _RULES for c in t["issue_codes"]]
_GENERAL = "'general_' || regexp_replace(regexp_replace(lower(coalesce(cl.label, code)), '[^a-z0-9]+', '_', 'g'), '^_|_$', '', 'g')"
_CODE_LABELS = f"cl as (select * from (values {_values(list(canon.CODE_LABELS.items()))}) t(c, label))"
_TOPICS = f"""a as (select id, upper(trim(issue_code)) as code, {_LOW.format('description')} as low from activities), ph as (select * from (values {_values(_PHRASES)}) t(rule, kind, ord, p)), rc as (select * from (values {_values(_CODES)}) t(rule, c)), {_CODE_LABELS},
    h as (select a.id, a.code, rule, kind, ord, p from a join ph on {_HIT.format(p='ph.p', t='a.low')}), k as (select *, row_number() over (partition by id, rule, kind order by ord) as rn from h),
    l as (select * from k where rn <= case kind when 'keywords' then 8 when 'programs' then 5 when 'acts' then 4 else 1 end),
    g as (select id, code, l.rule, count(*) filter (kind = 'exclude') as ex, count(*) filter (kind = 'keywords') as kw, count(*) filter (kind = 'programs') as pr, count(*) filter (kind = 'acts') as ac,
        count(*) filter (kind = 'keywords' and regexp_matches(p, '[-/&()\\d]|\\s')) as ph, count(*) filter (kind = 'keywords' and not regexp_matches(p, '[-/&()\\d]|\\s') and p in ({', '.join(map(_q, tg.SIGNAL_WORDS))})) as si,
        count(*) filter (kind = 'keywords' and not regexp_matches(p, '[-/&()\\d]|\\s') and p not in ({', '.join(map(_q, tg.SIGNAL_WORDS))})) as su, exists(select 1 from rc where rc.rule = l.rule and rc.c = code) as cm from l group by 1, 2, 3),
    s as (select *, ac * 2.8::double + pr * 2.2 + ph * 1.6 + si * 1.1 + su * 0.45 + case when cm then 0.6 else 0 end as strict, ac * 2.4::double + pr * 1.9 + ph * 1.3 + si * 0.9 + su * 0.3 + case when cm then 0.4 else 0 end as relaxed, pr + ac > 0 as hi,
        rule in ({', '.join(_q(t['id']) for t in _RULES if t['allow_single_support_relaxed'])}) as single from g where ex = 0 and kw + pr + ac > 0),
    t as (select *, case when not (cm or hi or ph >= 2) then null when hi and round(strict, 6) >= 2.2 and (cm or pr > 0 or ph > 0) or cm and ph + si > 0 and round(strict, 6) >= 2.0 or ph >= 2 and round(strict, 6) >= 2.6 or cm and su >= 2 and round(strict, 6) >= 2.2 then 'strict'
        when hi and round(relaxed, 6) >= 2.0 and (cm or pr > 0 or ph > 0) then 'relaxed' when cm and kw > 0 then case when si + ph > 0 or su >= 2 or single and su = 1 then 'relaxed' end when ph >= 2 and round(relaxed, 6) >= 2.2 then 'relaxed' end as tier from s),
    r as (select id, rule as topic, tier, round(case when tier = 'strict' then strict else relaxed end, 3) as score from t where tier is not null),
    o as (select *, cast(row_number() over (partition by id order by score desc, topic) as int) as pos from r)"""
_DICT = f"m as (select a.id, t.label, t.p as phrase from activities a join (values {_values([(p, n) for p, n in DICTIONARY])}) t(p, label) on {_HIT.format(p='t.p', t='lower(coalesce(description, chr(32)))')})"
_TERMS = f"""w as (select id, upper(trim(issue_code)) as code, list_filter(regexp_extract_all(lower(coalesce(description, '')), '[a-z][a-z0-9\\-]{{2,}}'), lambda x: x not in ({', '.join(map(_q, tg.STOP_WORDS))}) and length(x) <= 32) as w from activities),
    b as (select id, code, list_concat(w, list_filter(list_transform(range(1, greatest(len(w), 1)), lambda i: w[i] || ' ' || w[i + 1]), lambda x: x not in ({', '.join(map(_q, tg.GENERIC_PAIRS))}))) as t from w)"""
_LAWS = " union all ".join(f"select id, {i} as k, unnest(regexp_extract_all(description, {_q(p)})) as x, generate_subscripts(regexp_extract_all(description, {_q(p)}), 1) as p from activities where description is not null" for i, p in enumerate(tg.LAW_PATTERNS))
_MOVERS = " union all ".join(f"select '{k}' as category, tag, count, delta_pp, score from ({qt.change_sql(k, least=2)})" for k in ("topics", "entities", "legislation"))
_MERGED = f"select category, tag, count, delta_pp, score from (select *, row_number() over (partition by lower(tag) order by count desc, category) as rn from ({_MOVERS})) where rn = 1 order by abs(score) desc, tag limit 200"

ORACLE = {
    "rule_topics": f"""with {_TOPICS} select id, pos, topic, score, tier from o where pos <= 8 union all select a.id, 1, {_GENERAL}, 0.2, 'fallback' from a left join cl on cl.c = a.code where code <> '' and a.id not in (select id from r)""",
    "coarse_topics": f"""with {_CODE_LABELS}, g as (select * from (values {_values([(c, g) for g, cs in canon.COARSE_CODES.items() for c in cs])}) t(c, coarse)), a as (select upper(trim(issue_code)) as issue_code, upper(trim(issue_code)) as code from activities),
        x as (select issue_code, case when coalesce(code, '') = '' then 'unknown' else coalesce(g.coarse, 'other') end as coarse, case when code <> '' then {_GENERAL} end as general from a left join g on g.c = code left join cl on cl.c = code)
        select issue_code, coarse, general, 'General: ' || array_to_string(list_transform(string_split(substr(general, 9), '_'), lambda w: upper(w[1]) || w[2:]), ' ') as shown, count(*) as n from x group by 1, 2, 3""",
    "law_references": f"""with x as ({_LAWS}), t as (select id, k, p, trim(regexp_replace(x, '[\\s\\x{{00A0}}]+', ' ', 'g')) as v from x), d as (select * from (select *, row_number() over (partition by id, lower(v) order by k, p) as rn from t where length(v) >= 4) where rn = 1),
        o as (select id, cast(row_number() over (partition by id order by k, p) as int) as pos, v as reference from d) select * from o where pos <= 12""",
    "named_entities": f"""with e as (select * from (values {_values([(i, p, n) for i, (p, n) in enumerate(tg.ENTITY_PATTERNS)])}) t(k, p, label)), a as (select id, lower(concat_ws(' ', description, agencies, houses_lobbied)) as low from activities),
        h as (select id, label, min(k) as k from a join e on {_HIT.format(p='e.p', t='a.low')} group by 1, 2), o as (select id, cast(row_number() over (partition by id order by k) as int) as pos, label from h) select * from o where pos <= 8""",
    "dictionary_matches": f"with {_DICT} select * from m",
    "dictionary_coverage": f"with {_DICT} select label, count(distinct id) as n, count(distinct phrase) as phrases, round(count(distinct id) * 100::double / (select count(*) from activities), 6) as pct from m group by 1",
    "uncovered": f"with {_DICT} select id, description from activities where length(description) > 20 and id not in (select id from m) order by id desc limit 200",
    "mining_terms": f"with {_TERMS} select term, count(*) as n from b, unnest(t) u(term) group by 1 having count(*) >= 5",
    "candidate_terms": f"""with {_TERMS}, d as (select id, code, list_distinct(t) as t from b where code <> '' and len(t) > 0), sz as (select code, count(*) as issue_doc_count from d group by 1), tot as (select count(*) as n from d),
        p as (select code, term, count(*) as doc_freq from d, unnest(t) u(term) group by 1, 2), q as (select *, sum(doc_freq) over (partition by term) as all_freq from p),
        l as (select q.*, issue_doc_count, n as corpus_doc_count, ((doc_freq + 1::double) / (issue_doc_count + 2)) / ((all_freq - doc_freq + 1::double) / (greatest(n - issue_doc_count, 1) + 2)) as lift from q join sz using (code), tot where doc_freq >= 5 and not starts_with(term, 'section ')),
        s as (select *, ln(1 + least(lift, 250)) * ln(1 + doc_freq) as score from l where lift >= 2), r as (select *, cast(row_number() over (partition by code order by round(score, 6) desc, doc_freq desc, term) as int) as rank from s)
        select code, rank, term, cast(case when contains(term, ' ') then 2 else 1 end as int) as ngram, doc_freq, issue_doc_count, corpus_doc_count, round(lift, 6) as lift, round(score, 6) as score from r where rank <= 20""",
    "unmapped_sample": "select id, upper(trim(issue_code)) as issue_code, substr(replace(description, chr(10), ' '), 1, 220) as snippet from activities where length(description) > 20 and id not in (select activity_id from activity_extractions_rules) order by md5(cast(id as varchar) || '7'), id limit 50",
    "prefix_pairs": """with k as (select distinct upper(trim(regexp_replace(regexp_replace(name, '[\\s\\x{00A0}]+', ' ', 'g'), '^ +| +$', '', 'g'))) as key from clients where name is not null) select a.key as shorter, b.key as longer from k a join k b on starts_with(b.key, a.key || ' ')
        where a.key <> '' and len(string_split(b.key, ' ')) <= len(string_split(a.key, ' ')) + 3""",
    "normalized_tags": """with t as (select unnest(topics) as t from activity_extractions_rules), n as (select t, count(*) as n from t where t is not null group by 1), s as (select t, n, trim(regexp_replace(t, '\\s+', ' ', 'g')) as tag from n)
        select t, n, tag, trim(lower(tag), '"''` ') as phrase, substr(coalesce(nullif(trim(regexp_replace(lower(t), '[^a-z0-9]+', '_', 'g'), '_'), ''), 'other'), 1, 48) as label from s""",
    "client_search": """with n as (select client_id, count(*) as n from filings group by 1), s as (select c.id as client_id, name, coalesce(n, 0) as n, cast(case when lower(trim(name)) = 'city of' then 100 when starts_with(lower(trim(name)), 'city of') then 80 when contains(lower(name), ' city of') then 60
        when contains(lower(name), 'city of') then 30 end as int) as score from clients c left join n on n.client_id = c.id) select client_id, name, n, score from s where score is not null order by score desc, n desc, name limit 30""",
    "quarter_outliers": f"""with {CLIENT_KEYS}, p as (select client_key, excluded, year, quarter, sum(coalesce(income, 0)) as income from filings f join ck on ck.client_id = f.client_id where is_current group by 1, 2, 3, 4 having sum(income) >= 5e5)
        select client_key, excluded, year, quarter, income from (select *, row_number() over (partition by client_key order by income desc, year desc, quarter desc) as rn from p) where rn = 1""",
    "identity_review": f"""with {CLIENT_KEYS}, k as (select c.id, name, case when name is null then null when starts_with(client_key, '#') then '' else client_key end as key from clients c join ck on ck.client_id = c.id)
        select key, count(distinct name) as spellings, count(*) as filings, max(income) as greatest from filings f join k on k.id = f.client_id group by 1 having count(distinct name) > 1""",
    "merged_movers": _MERGED,
    "digest": f"select * from (select *, cast(row_number() over (partition by category order by score desc, tag) as int) as rank from ({_MERGED}) where delta_pp > 0) where rank <= case category when 'entities' then 3 else 4 end",
    "client_drilldown": f"""with {MENTIONS.replace(' and not k.excluded', '')}, p as (select tag, client_key, count(*) as mentions, count(distinct filing_id) as filings, min(q) as first_q, max(q) as last_q from x where kind = 'topics' group by 1, 2),
        r as (select *, rank() over (partition by tag order by mentions desc) as rank from p) select tag, filings, mentions, first_q, last_q, rank from r where client_key = (select client_key from ck where client_id = 1)""",
    "org_ramps": f"""select client_key, kind, delta, case when before = 0 then 'new' when now / before >= 5 then 'surge' when now / before >= 2 then 'strong' when now / before >= 1.25 then 'up' else 'steady' end as intensity,
        case when before = 0 then 'none' when round((now - before) * 100 / before, 6) > 5 then 'up' when round((now - before) * 100 / before, 6) > 2 then 'slightly_up' when round((now - before) * 100 / before, 6) < -5 then 'down' when round((now - before) * 100 / before, 6) < -2 then 'slightly_down' else 'flat' end as direction
        from ({qt.MOVERS}) where kind in ('riser', 'new_entrant') order by delta desc, client_key limit 30""",
    "hero_picks": f"""with mm as ({_MERGED}), r as (select *, delta_pp > 0 and count >= 3 as good from mm), f as (select *, good and row_number() over (partition by category order by good desc, abs(score) desc, tag) = 1 as first from r)
        select category, tag, count, delta_pp, score from f order by first desc, abs(score) desc, tag limit 3""",
    "client_keys": f"with {CLIENT_KEYS} select client_id as id, case when name is not null then if(starts_with(client_key, '#'), '', client_key) end as key from clients join ck on ck.client_id = clients.id",
}
