"""Queries of signals and trends, with their SQL. The frames are those that the data's last posting gives."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyspark.functions import periods
from tallyspark.functions.canon import with_legislation
from tallyspark.operators import audit as au, facts as fx, measures as m, signals as sg, trends as tr
from tallyspark.plans.keys_sql import CLIENT_KEYS
from tallyspark.plans.q_measures import MENTIONS
from tallyspark.sources.tables import table

KINDS = ("topics", "entities", "legislation")


def frame(spark: SparkSession, d: str, name: str = "quarter") -> tr.Frame:
    """The frame of that name at the data's own anchor, one aggregate over the posting days."""
    return next(f for f in tr.data_frames(table(spark, d, "filings", "year", "quarter", "filing_date")) if f.name == name)


def _filings(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "filings", "id", "registrant_id", "client_id", "year", "quarter", "income", "filing_date")


def _series(spark: SparkSession, d: str, party: str) -> DataFrame:
    f = table(spark, d, "filings", party, "year", "quarter", "income").where(f"income > 0 and {party} is not null")
    return f.groupBy(party, periods.q_index().alias("q")).agg(F.sum("income").alias("value"))


def _spend(spark: SparkSession, d: str) -> DataFrame:
    """Spend by issue code, client and quarter: a filing's income shared evenly by its activities."""
    a = table(spark, d, "activities", F.col("id").alias("activity_id"), "filing_id", F.upper(F.trim("issue_code")).alias("code"))
    f = table(spark, d, "filings", F.col("id").alias("filing_id"), "client_id", "year", "quarter", "income").where("income > 0 and client_id is not null")
    per = a.groupBy("filing_id").agg(F.count(F.lit(1)).alias("n"))
    x = a.where("code <> ''").join(f, "filing_id").join(per, "filing_id")
    return x.groupBy("code", "client_id", periods.q_index().alias("q")).agg(F.sum(F.col("income") / F.col("n")).alias("value"))


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else c for c, t in df.dtypes])


def signal_records(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(sg.records(_series(spark, d, "client_id"), "client_id", least_total=3e5))


def signal_spikes(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(sg.spikes(_series(spark, d, "client_id"), "client_id", least_base=2e4, least_growth=0.5, latest_only=False))


def signal_concentration(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(sg.concentration(_spend(spark, d), "code", "client_id", least_total=1e5, least_share=0.2))


def signal_entrants(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(sg.new_entrants(_spend(spark, d), "code", "client_id"))


def signal_coordinated(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(sg.coordinated(_spend(spark, d), "code", "client_id"))


def signals_all(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(sg.detect({p: _series(spark, d, p) for p in ("client_id", "registrant_id")}, _spend(spark, d), "code", "client_id"))


def trend_frames(spark: SparkSession, d: str) -> DataFrame:
    """The frames at the data's own anchor, with the number of filings of each leg and whether they are few."""
    f, out = _filings(spark, d), None
    for fr in tr.data_frames(f):
        for n, leg in (("current", fr.current), ("baseline", fr.baseline)):
            few = (F.col("filings") < tr.THIN) if fr.name == "qtd" else F.lit(False)
            fixed = [F.lit(v).alias(k) for k, v in (("frame", fr.name), ("leg", n), ("year", leg.year), ("quarter", leg.quarter))]
            row = tr.leg_filings(f, leg).agg(F.count(F.lit(1)).alias("filings")).select(*fixed, F.lit(leg.through).cast("string").alias("through"), "filings", few.alias("thin"))
            out = row if out is None else out.unionByName(row)
    return out


def tag_changes(spark: SparkSession, d: str, name: str = "quarter", kinds: tuple[str, ...] = KINDS, least: int = 1) -> DataFrame:
    """Changes of the tags of some kinds: the filings of both legs first, one star, the kinds exploded once."""
    star = fx.star(spark, d, filings=tr.both_legs(_filings(spark, d), frame(spark, d, name)))
    counts = fx.mentions(star, kinds).groupBy("kind", "tag").agg(F.count_if("now").alias("count"), F.count_if(~F.col("now")).alias("baseline_count"))
    totals = star.agg(F.count_if("now").alias("now"), F.count_if(~F.col("now")).alias("before"))
    return tr.changes(counts, totals, least)


def _of_kind(spark: SparkSession, d: str, kind: str, name: str = "quarter", least: int = 1) -> DataFrame:
    return _rounded(tag_changes(spark, d, name, (kind,), least).drop("kind", "rank"))


def trend_topics(spark: SparkSession, d: str) -> DataFrame:
    return _of_kind(spark, d, "topics")


def trend_topics_to_date(spark: SparkSession, d: str) -> DataFrame:
    return _of_kind(spark, d, "topics", "qtd")


def trend_entities(spark: SparkSession, d: str) -> DataFrame:
    return _of_kind(spark, d, "entities")


def trend_legislation(spark: SparkSession, d: str) -> DataFrame:
    return _of_kind(spark, d, "legislation", least=2)


def trend_alerts(spark: SparkSession, d: str) -> DataFrame:
    return tr.alerts(tag_changes(spark, d, kinds=("topics",)), "tag", least=3).select("tag", "count", "baseline_count", F.round("delta_pp", 6).alias("delta_pp"), "confidence", "direction")


def _keyed_filings(spark: SparkSession, d: str) -> DataFrame:
    """Filings with the key of their client, without those of excluded clients."""
    return _filings(spark, d).join(fx.keyed_clients(spark, d).select("client_id", "client_key"), "client_id")


def client_movers(spark: SparkSession, d: str) -> DataFrame:
    return tr.movers(tr.client_legs(_keyed_filings(spark, d), frame(spark, d)), floor=2e4, new_floor=5e4)


def frame_totals(spark: SparkSession, d: str) -> DataFrame:
    """Income, filings and clients of both legs, and the change."""
    x = tr.both_legs(_keyed_filings(spark, d), frame(spark, d))
    leg = lambda n, own: [F.sum(F.when(own, F.col("income"))).alias(f"income_{n}"), F.count_if(own).alias(f"filings_{n}"), F.countDistinct(F.when(own, F.col("client_key"))).alias(f"clients_{n}")]
    x = x.agg(*leg("now", F.col("now")), *leg("before", ~F.col("now")))
    return x.withColumn("income_change_pct", F.round(m.growth_pct(F.col("income_now"), F.col("income_before")), 1))


def tag_series(spark: SparkSession, d: str) -> DataFrame:
    """Dense series up to the last complete quarter of the ten most frequent tags of each kind, and of those that moved in the frame of the quarter."""
    last = frame(spark, d).current.q
    n = fx.mentions(fx.star(spark, d)).groupBy("kind", "tag", "q").agg(F.count(F.lit(1)).alias("n"))
    top = m.top_per_group(n.groupBy("kind", "tag").agg(F.sum("n").alias("all")), ["kind"], [F.desc("all"), F.asc("tag")], 10).select("kind", "tag")
    moved = tag_changes(spark, d, least=2).where("rank <= 5").select("kind", "tag")
    kept = n.join(top.unionByName(moved).distinct(), ["kind", "tag"], "left_semi").withColumn("key", F.struct("kind", "tag"))
    return tr.dense_series(kept.select("key", "q", "n"), "key", 20, last).select("key.kind", "key.tag", F.array_join(F.transform("series", lambda x: x.cast("string")), ",").alias("series"))


def deflated_totals(spark: SparkSession, d: str) -> DataFrame:
    """Quarterly income in constant dollars, by an index of 250 in January 2019 that grows by one a month."""
    months = spark.range(0, 84).select(F.add_months(F.lit("2019-01-01").cast("date"), F.col("id").cast("int")).alias("month"), (250 + F.col("id")).cast("double").alias("value"))
    f = table(spark, d, "filings", "year", "quarter", "income").groupBy("year", "quarter").agg(F.sum("income").alias("income"))
    return f.join(tr.deflators(months), ["year", "quarter"]).select("year", "quarter", "income", F.round(F.col("income") * F.col("factor"), 4).alias("constant_income"))


def partial_quarters(spark: SparkSession, d: str) -> DataFrame:
    return tr.complete_flags(table(spark, d, "filings", periods.q_index().alias("q")).groupBy("q").agg(F.count(F.lit(1)).alias("n")))


def _health(spark: SparkSession, d: str) -> DataFrame:
    filings = table(spark, d, "filings", F.col("id").alias("filing_id"), "year", "filing_date", "is_current").where("is_current").drop("is_current")
    acts = table(spark, d, "activities", F.col("id").alias("activity_id"), "filing_id").join(filings, "filing_id")
    rules = table(spark, d, "activity_extractions_rules", "activity_id", "legislation")
    coverage = acts.join(rules.select("activity_id", F.lit(True).alias("extracted")), "activity_id", "left").select("filing_date", F.coalesce("extracted", F.lit(False)).alias("extracted"))
    counts = tag_changes(spark, d, kinds=("topics",)).select("count", "baseline_count")
    tags = counts.select(F.lit(True).alias("now"), F.col("count").alias("n")).unionByName(counts.select(F.lit(False).alias("now"), F.col("baseline_count").alias("n")))
    laws = with_legislation(acts.join(rules, "activity_id").select("filing_date", "year", F.explode("legislation").alias("tag")), "tag", "year")
    return au.health(filings, coverage, tags, laws, table(spark, d, "audit_log"), tr.anchor_day(filings))


def data_checks(spark: SparkSession, d: str) -> DataFrame:
    """What is unusual in the data at its last posting, as flags."""
    return _rounded(au.flags(_health(spark, d)))


def data_status(spark: SparkSession, d: str) -> DataFrame:
    return au.status(au.flags(_health(spark, d)))


def data_gaps(spark: SparkSession, d: str) -> DataFrame:
    """Gaps of the data as rows (check, value, severity)."""
    f, e = table(spark, d, "filings"), table(spark, d, "activity_extractions_rules")
    a = f.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("filing_date").isNull()).alias("no_date"), F.count_if(F.col("registrant_id").isNull()).alias("no_registrant"), F.count_if(F.coalesce("income", F.lit(0.0)) == 0).alias("no_income"),
        (F.count(F.lit(1)) - F.countDistinct("sopr_filing_id")).alias("repeated"), F.count_if(F.col("income") >= 1e6).alias("outliers"),
    )
    t = e.agg(F.count_if(F.size("topics") <= 0).alias("untagged"), F.count_if(F.col("legislation").isNull()).alias("no_legislation"))
    row = a.crossJoin(t)
    checks = {"no_date": 0.02, "no_registrant": 0.02, "no_income": 0.5, "repeated": 0.005, "outliers": 0.01, "untagged": 0.2, "no_legislation": 0.2}
    level = lambda c, most: F.when(F.col(c) == 0, "ok").when(F.col(c) > most * F.col("n"), "high").otherwise("low")
    every = F.array(*[F.struct(F.lit(c).alias("check"), F.col(c).alias("value"), level(c, most).alias("severity")) for c, most in checks.items()])
    return row.select(F.explode(every).alias("c")).select("c.*")


QUERIES = {
    f.__name__: f for f in (signal_records, signal_spikes, signal_concentration, signal_entrants, signal_coordinated, signals_all, trend_frames, trend_topics, trend_topics_to_date, trend_entities, trend_legislation, trend_alerts, client_movers, frame_totals, tag_series, deflated_totals, partial_quarters, data_checks, data_status, data_gaps)
}

_SERIES = "s as (select client_id, year * 4 + quarter as q, sum(income) as value from filings where income > 0 and client_id is not null group by 1, 2)"
_HISTORY = _SERIES + """, h as (select *, max(value) over (partition by client_id order by q rows between unbounded preceding and 1 preceding) as most_before, count(*) over (partition by client_id) as periods, sum(value) over (partition by client_id) as total,
    (rank() over (partition by client_id order by value) - 1) / count(*) over (partition by client_id) as below, q = max(q) over (partition by client_id) as last from s)"""
_SPEND = """n as (select filing_id, count(*) as n from activities group by 1), p as (select upper(trim(issue_code)) as code, client_id, year * 4 + quarter as q, sum(income / n) as value from activities a join filings f on f.id = a.filing_id
    join n on n.filing_id = a.filing_id where income > 0 and client_id is not null and trim(issue_code) <> '' group by 1, 2, 3)"""
_ENTRANTS = _SPEND + ", e as (select * from (select *, min(q) over (partition by code, client_id) as first from p) where q = (select max(q) from p) and first = q)"
_NULLS = "cast(null as double)"


def _own_history(party: str) -> str:
    """The history of a party's quarters, as h_ and its name, and its series as s_ and its name."""
    return _HISTORY.replace("client_id", party).replace("s as (", f"s_{party} as (").replace("h as (", f"h_{party} as (").replace("from s)", f"from s_{party})")


def _own_signals(party: str) -> str:
    return f"""select 'record' as signal_type, cast({party} as varchar) as entity, value as current_value, most_before as prior_value, (value - most_before) / nullif(most_before, 0) as growth_rate, below as historical_pct, value / 1e6 as magnitude, q from h_{party} where last and total >= 1e6 and value > most_before and periods >= 5
        union all select 'spike', cast(h.{party} as varchar), h.value, b.value, (h.value - b.value) / b.value, below, (h.value - b.value) / 1e6, h.q from h_{party} h join s_{party} b on b.{party} = h.{party} and b.q = h.q - 4 where last and periods >= 5 and b.value >= 5e5 and (h.value - b.value) / b.value >= 1"""


_RANK = "row_number() over (partition by registrant_id, client_id, year, quarter order by filing_date desc nulls last, id desc)"


#: fr: the anchor, the last complete quarter (q) and the one to date (qt), none after the last with filings.
FRAMES = f"""an as (select max(try_cast(substr(ltrim(filing_date), 1, 10) as date)) + 1 as anchor, max(year * 4 + quarter) as mq from filings),
    cq as (select anchor, mq, max(q) as q from (select unnest(range(7000, 9000)) as q) t, an where anchor > last_day(make_date(cast((q - 1) // 4 as int), cast(((q - 1) % 4 + 1) * 3 as int), 1)) + {tr.GRACE} group by 1, 2),
    fr as (select anchor, least(q, mq) as q, least(q + 1, mq) as qt from cq)"""


def _leg(name: str = "quarter", current: bool = True, table: str = "filings") -> str:
    q = f"fr.{'q' if name == 'quarter' else 'qt'} - {0 if current else 4}"
    cut = f" and substr(ltrim(filing_date), 1, 10) <= cast(anchor - {1 if current else 366} as varchar)" if name == "qtd" else ""
    return f"select * from (select f.*, {_RANK} as rn from {table} f, fr where year * 4 + quarter = {q}{cut}) where rn = 1"


def change_sql(kind: str, name: str = "quarter", least: int = 1) -> str:
    base = MENTIONS.replace(" where f.is_current)", ")")
    return f"""with {base}, {FRAMES}, c as ({_leg(name)}), b as ({_leg(name, False)}), cn as (select count(*) as n from s where filing_id in (select id from c)), bn as (select count(*) as n from s where filing_id in (select id from b)),
        ct as (select tag, count(*) as count from x where kind = '{kind}' and filing_id in (select id from c) group by 1), bt as (select tag, count(*) as count from x where kind = '{kind}' and filing_id in (select id from b) group by 1),
        j as (select tag, ct.count, coalesce(bt.count, 0) as baseline_count, ct.count * 100::double / (select n from cn) as share, coalesce(coalesce(bt.count, 0) * 100::double / nullif((select n from bn), 0), 0) as baseline_share from ct left join bt using (tag) where ct.count >= {least}),
        k as (select *, share - baseline_share as delta_pp, count / nullif(baseline_count, 0) as ratio, share - baseline_share + least(count / 2000, 1.0) * 0.1 as score from j)
        select tag, count, baseline_count, round(share, 6) as share, round(baseline_share, 6) as baseline_share, round(delta_pp, 6) as delta_pp, round(ratio, 6) as ratio, round(score, 6) as score,
        case when count >= 50 and baseline_count >= 50 and abs(delta_pp) >= 0.35 then 'high' when count >= 25 and abs(delta_pp) >= 0.15 then 'medium' else 'low' end as confidence from k order by abs(k.score) desc, count desc, tag limit 500"""


_KEYED = f"{CLIENT_KEYS}, {FRAMES}, kf as (select f.*, client_key from filings f join ck on ck.client_id = f.client_id and not excluded)"
_LEGS = f"""{_KEYED}, n as (select client_key, sum(coalesce(income, 0)) as now from ({_leg(table='kf')}) group by 1), b as (select client_key, sum(coalesce(income, 0)) as before from ({_leg(current=False, table='kf')}) group by 1),
    e as (select client_key, sum(coalesce(income, 0)) as early from (select kf.*, {_RANK} as rn from kf, fr where year * 4 + quarter between fr.q - 8 and fr.q - 5) where rn = 1 group by 1),
    l as (select client_key, coalesce(now, 0) as now, coalesce(before, 0) as before, coalesce(early, 0) as early, coalesce(now, 0) - coalesce(before, 0) as delta from n full join b using (client_key) left join e using (client_key) where coalesce(now, 0) <> 0 or coalesce(before, 0) <> 0)"""
MOVERS = f"""with {_LEGS}, k as (select *, case when before = 0 and early = 0 and now >= 5e4 then 'new_entrant' when not (before = 0 and early = 0) and delta >= 2e4 then 'riser' when delta <= -2e4 then 'faller' else 'major' end as kind from l),
        r as (select *, cast(row_number() over (partition by kind order by case when kind = 'major' then now else abs(delta) end desc, client_key) as int) as rank from k) select * from r where rank <= case kind when 'riser' then 25 when 'faller' then 15 when 'new_entrant' then 10 else 150 end"""
_SERIES_OF = " union all ".join(f"(select '{k}' as kind, tag from ({change_sql(k, least=2)}) limit 5)" for k in ("topics", "entities", "legislation"))
ORACLE = {
    "signal_records": f"with {_HISTORY} select 'record' as signal_type, cast(client_id as varchar) as entity, round(value, 6) as current_value, round(most_before, 6) as prior_value, round((value - most_before) / most_before, 6) as growth_rate, round(below, 6) as historical_pct, round(value / 1e6, 6) as magnitude, q from h where last and total >= 3e5 and value > most_before and periods >= 5",
    "signal_spikes": f"with {_HISTORY} select 'spike' as signal_type, cast(h.client_id as varchar) as entity, round(h.value, 6) as current_value, round(b.value, 6) as prior_value, round((h.value - b.value) / b.value, 6) as growth_rate, round(below, 6) as historical_pct, round((h.value - b.value) / 1e6, 6) as magnitude, h.q from h join s b on b.client_id = h.client_id and b.q = h.q - 4 where periods >= 5 and b.value >= 2e4 and (h.value - b.value) / b.value >= 0.5",
    "signal_concentration": f"""with {_SPEND}, s as (select *, sum(value) over (partition by code, q) as total, value / sum(value) over (partition by code, q) as share from p), t as (select *, row_number() over (partition by code order by share desc, client_id desc) as rn from s where q = (select max(q) from s x where x.code = s.code))
        select 'concentration' as signal_type, t.code || ': ' || t.client_id as entity, round(t.share, 6) as current_value, round(coalesce(b.share, 0), 6) as prior_value, round(t.share - coalesce(b.share, 0), 6) as growth_rate, {_NULLS} as historical_pct, round(t.total / 1e6, 6) as magnitude, t.q
        from t left join s b on b.code = t.code and b.client_id = t.client_id and b.q = t.q - 4 where rn = 1 and t.total >= 1e5 and t.share >= 0.2 and coalesce(b.share, 0) <= 0.1""",
    "signals_all": f"""with {', '.join(_own_history(p) for p in ('client_id', 'registrant_id'))}, {_ENTRANTS}, sh as (select *, sum(value) over (partition by code, q) as total, value / sum(value) over (partition by code, q) as share from p),
        t as (select *, row_number() over (partition by code order by share desc, client_id desc) as rn from sh where q = (select max(q) from sh x where x.code = sh.code)),
        a as ({' union all '.join(_own_signals(p) for p in ('client_id', 'registrant_id'))}
        union all select 'concentration', t.code || ': ' || t.client_id, t.share, coalesce(b.share, 0), t.share - coalesce(b.share, 0), null, t.total / 1e6, t.q from t left join sh b on b.code = t.code and b.client_id = t.client_id and b.q = t.q - 4 where rn = 1 and t.total >= 5e5 and t.share >= 0.3 and coalesce(b.share, 0) <= 0.1
        union all select 'new_entrant', code || ': ' || client_id, value, 0, null, null, value / 1e6, q from e union all select 'coordinated', code, count(*), 0, null, null, sum(value) / 1e6, q from e group by code, q having count(*) >= 3)
        select signal_type, entity, {', '.join(f'round({c}, 6)::double as {c}' for c in ('current_value', 'prior_value', 'growth_rate', 'historical_pct', 'magnitude'))}, q, cast((q - 1) // 4 as int) as year, cast((q - 1) % 4 + 1 as int) as quarter from a""",
    "signal_entrants": f"with {_ENTRANTS} select 'new_entrant' as signal_type, code || ': ' || client_id as entity, round(value, 6) as current_value, 0.0::double as prior_value, {_NULLS} as growth_rate, {_NULLS} as historical_pct, round(value / 1e6, 6) as magnitude, q from e",
    "signal_coordinated": f"with {_ENTRANTS} select code, q, count(*) as n, round(sum(value), 6) as value from e group by 1, 2 having count(*) >= 3",
    "trend_topics": change_sql("topics"),
    "trend_topics_to_date": change_sql("topics", "qtd"),
    "trend_entities": change_sql("entities"),
    "trend_legislation": change_sql("legislation", least=2),
    "trend_alerts": f"select tag, count, baseline_count, delta_pp, confidence, case when delta_pp >= 0 then 'up' else 'down' end as direction from ({change_sql('topics')}) where abs(delta_pp) >= 0.25 and count >= 3 order by case confidence when 'high' then 0 when 'medium' then 1 else 2 end, abs(delta_pp) desc, count desc, tag limit 20",
    "client_movers": MOVERS,
    "frame_totals": f"""with {_KEYED}, n as ({_leg(table='kf')}), b as ({_leg(current=False, table='kf')}), x as (select (select sum(income) from n) as income_now, (select count(*) from n) as filings_now, (select count(distinct client_key) from n) as clients_now,
        (select sum(income) from b) as income_before, (select count(*) from b) as filings_before, (select count(distinct client_key) from b) as clients_before) select *, round((income_now - income_before) * 100 / income_before, 1) as income_change_pct from x""",
    "tag_series": f"""with {MENTIONS}, {FRAMES}, cnt as (select kind, tag, q, count(*) as n from x group by 1, 2, 3), top as (select kind, tag from (select kind, tag, row_number() over (partition by kind order by sum(n) desc, tag) as rn from cnt group by 1, 2) where rn <= 10),
        g as (select * from top union select * from ({_SERIES_OF})), k as (select g.* from g semi join cnt using (kind, tag)), spine as (select unnest(range(fr.q - 19, fr.q + 1)) as q from fr)
        select kind, tag, string_agg(cast(coalesce(cnt.n, 0) as varchar), ',' order by q) as series from (select * from k, spine) h left join cnt using (kind, tag, q) group by 1, 2""",
    "trend_frames": f"""with {FRAMES}, l as (select 'quarter' as frame, 'current' as leg, q, null as through from fr union all select 'quarter', 'baseline', q - 4, null from fr union all select 'qtd', 'current', qt, cast(anchor - 1 as varchar) from fr union all select 'qtd', 'baseline', qt - 4, cast(anchor - 366 as varchar) from fr),
        k as (select l.*, f.id, {_RANK.replace('partition by', 'partition by frame, leg,')} as rn from l left join filings f on f.year * 4 + f.quarter = l.q and (through is null or substr(ltrim(filing_date), 1, 10) <= through))
        select frame, leg, cast((q - 1) // 4 as int) as year, cast((q - 1) % 4 + 1 as int) as quarter, through, count(id) as filings, frame = 'qtd' and count(id) < {tr.THIN} as thin from k where rn = 1 or id is null group by frame, leg, q, through""",
    "deflated_totals": """with c as (select date '2019-01-01' + to_months(cast(i as int)) as month, (250 + i)::double as value from range(84) r(i)), b as (select avg(value) as base from c where year(month) = (select max(year(month)) from c where month(month) = 12)),
        k as (select year(month) as year, quarter(month) as quarter, avg(value) as mean from c group by 1, 2) select f.year, f.quarter, sum(income) as income, round(sum(income) * (any_value(base) / any_value(mean)), 4) as constant_income from filings f join k on k.year = f.year and k.quarter = f.quarter, b group by 1, 2""",
    "partial_quarters": """with n as (select year * 4 + quarter as q, count(*) as n from filings group by 1), m as (select median(n) as m from n) select q, n, max(cast(n >= m / 2 as int)) over (order by q desc) = 0 as partial from n, m""",
    "data_gaps": """with a as (select count(*) as n, count(*) filter (filing_date is null) as no_date, count(*) filter (registrant_id is null) as no_registrant, count(*) filter (coalesce(income, 0) = 0) as no_income, count(*) - count(distinct sopr_filing_id) as repeated, count(*) filter (income >= 1e6) as outliers,
        (select count(*) from activity_extractions_rules where len(topics) = 0 or topics is null) as untagged, (select count(*) from activity_extractions_rules where legislation is null) as no_legislation from filings),
        c as (select n, unnest(['no_date', 'no_registrant', 'no_income', 'repeated', 'outliers', 'untagged', 'no_legislation']) as "check", unnest([no_date, no_registrant, no_income, repeated, outliers, untagged, no_legislation]) as value, unnest([0.02, 0.02, 0.5, 0.005, 0.01, 0.2, 0.2]) as most from a)
        select "check", value, case when value = 0 then 'ok' when value > most * n then 'high' else 'low' end as severity from c""",
}
