"""Audits: stored rows beside live ones, identities, aliases, and the health of the data as flags."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyspark.functions import canon
from tallyspark.operators.measures import growth_pct

#: Months in which quarterly reports are due.
DUE_MONTHS = (1, 4, 7, 10)


def drift(stored: DataFrame, live: DataFrame, cent: float = 0.01) -> DataFrame:
    """Stored rows (key, income, n_activities) beside what was fetched for them (key, income, n_activities, status).

    status of a fetch: 'ok', 'missing' (the source has no such row) or 'error' (nothing is known, so nothing was checked). Rows
    (key, checked, missing, error, income_off, activities_off); a stored row that was not fetched is left out. Null amounts are 0.
    """
    zero = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    s = stored.groupBy("key").agg(F.max(zero("income")).alias("s_income"), F.max("n_activities").alias("s_n"))
    x = s.join(live.select("key", zero("income").alias("income"), "n_activities", F.coalesce("status", F.lit("ok")).alias("status")), "key")
    ok = F.col("status") == "ok"
    return x.select(
        "key", ok.alias("checked"), (F.col("status") == "missing").alias("missing"), (F.col("status") == "error").alias("error"),
        (ok & (F.abs(F.col("income") - F.col("s_income")) > cent)).alias("income_off"), (ok & F.coalesce(F.col("n_activities") != F.col("s_n"), F.lit(False))).alias("activities_off"),
    )


def drift_summary(rows: DataFrame) -> DataFrame:
    """One row for the audit log: sampled (checked or missing), missing, income_mismatch, activity_mismatch, errors."""
    return rows.agg(
        F.count_if(F.col("checked") | F.col("missing")).cast("int").alias("sampled"), F.count_if("missing").cast("int").alias("missing"), F.count_if("income_off").cast("int").alias("income_mismatch"),
        F.count_if("activities_off").cast("int").alias("activity_mismatch"), F.count_if("error").cast("int").alias("errors"),
    )


def rename_candidates(names: DataFrame, least_income: float = 1e6) -> DataFrame:
    """Rows (former_key, present_key, former_income, name): names that give a former one whose own key still holds income.

    names: name, income (of all its filings). A former name whose key is the present one, by the table of renames, is none. Of
    several names that say the same the smallest is shown.
    """
    mark = r"(?i)(?:\(\s*(?:formerly(?:\s+(?:known|reported)\s+as)?|fka|f/k/a)\s*[:,]?\s*([^)]+)\)|\b(?:fka|f/k/a|formerly(?:\s+(?:known|reported)\s+as)?)\s+(.+)$)"
    n = names.where("name is not null")
    said = n.where(F.col("name").rlike(mark)).select("name", F.coalesce(F.nullif(F.regexp_extract("name", mark, 1), F.lit("")), F.regexp_extract("name", mark, 2)).alias("former"))
    keys = canon.canonical_names(n.select("name").unionByName(said.select(F.col("former").alias("name"))))
    key = lambda c, out: keys.select(F.col("name").alias(c), F.col("key").alias(out))
    income = n.join(keys, "name").where("key <> ''").groupBy("key").agg(F.sum("income").alias("former_income")).withColumnRenamed("key", "former_key")
    x = said.join(key("name", "present_key"), "name").join(key("former", "former_key"), "former").where("former_key <> '' and former_key <> present_key")
    return x.join(income.where(F.col("former_income") >= least_income), "former_key").groupBy("former_key", "present_key", "former_income").agg(F.min("name").alias("name"))


def quarter_outliers(filings: DataFrame, least: float = 2.5e7) -> DataFrame:
    """Of each client key (client_key, excluded, year, quarter, income) its greatest quarter, if it reaches least; of ties the latest."""
    per = filings.groupBy("client_key", "excluded", "year", "quarter").agg(F.sum("income").alias("income")).where(F.col("income") >= least)
    best = per.groupBy("client_key", "excluded").agg(F.max(F.struct("income", "year", "quarter")).alias("x"))
    return best.select("client_key", "excluded", "x.year", "x.quarter", "x.income")


def alias_gaps(tags: DataFrame, least: int = 1500, dropped: int = 12) -> DataFrame:
    """Rows (kind, tag, n) of law tags (tag, year): numbers and titled acts that no table names, of least mentions, and the most frequent that name nothing."""
    law = canon.with_legislation(tags, "tag", "year")
    kind = F.when(F.col("law") == "", "dropped").when(F.col("law").rlike(r"^(H\.R\.|S\.|P\.L\.) \d"), "number").when(F.col("law").rlike(r"(?i) act\b") & ~F.col("law").isin(*canon.ACT_PHRASES), "titled")
    shown = F.when(kind == "dropped", F.trim("tag")).otherwise(F.col("law"))
    n = law.select(kind.alias("kind"), shown.alias("tag")).where("kind is not null and tag <> ''").groupBy("kind", "tag").agg(F.count(F.lit(1)).alias("n"))
    rank = F.row_number().over(Window.partitionBy("kind").orderBy(F.desc("n"), "tag"))
    return n.withColumn("rank", rank).where(F.when(F.col("kind") == "dropped", F.col("rank") <= dropped).otherwise(F.col("n") >= least)).select("kind", "tag", "n")


def health(filings: DataFrame, coverage: DataFrame, tags: DataFrame, laws: DataFrame, audits: DataFrame, anchor: date) -> DataFrame:
    """One row of measures of the data at a day: arrivals of 90 days against the 90 before and a year before, the cycle of due
    months over four years, coverage, noise among law tags, concentration of topics, the last audit.

    filings: filing_date of current ones. coverage: filing_date, extracted (of the activities). tags: now, n (mentions of
    topics in the two legs of a frame, one row per topic and leg). laws: filing_date, law ('' where it names none). audits:
    id, sampled, missing, income_mismatch, activity_mismatch, errors.
    """
    day = lambda: F.substring(F.ltrim("filing_date"), 1, 10)
    within = lambda a, b: day().between(str(anchor - timedelta(days=a)), str(anchor - timedelta(days=b)))
    pct = lambda a, b: F.try_divide(a * F.lit(100.0), b)
    arrived = filings.agg(F.count_if(within(90, 0)).alias("filings_90d"), F.count_if(within(180, 90)).alias("filings_before"), F.count_if(within(455, 365)).alias("filings_year_ago"))
    month = filings.where(day() >= str(date(anchor.year - 4, anchor.month, min(anchor.day, 28)))).groupBy(F.substring(F.ltrim("filing_date"), 1, 7).alias("month")).agg(F.count(F.lit(1)).alias("n"))
    due = F.substring("month", 6, 2).cast("int").isin(*DUE_MONTHS)
    cycle = month.agg(F.avg(F.when(due, F.col("n"))).alias("due_mean"), F.avg(F.when(~due, F.col("n"))).alias("other_mean"), pct(F.sum(F.when(due, F.col("n"))), F.sum("n")).alias("due_share_pct"))
    covered = coverage.agg(pct(F.count_if(F.col("extracted") & within(90, 0)), F.count_if(within(90, 0))).alias("coverage_90d_pct"), pct(F.count_if("extracted"), F.count(F.lit(1))).alias("coverage_pct"))
    top = tags.agg(
        F.sum(F.when(F.col("now"), F.col("n"))).alias("mentions_now"), F.sum(F.when(~F.col("now"), F.col("n"))).alias("mentions_before"), pct(F.max(F.when(F.col("now"), F.col("n"))), F.sum(F.when(F.col("now"), F.col("n")))).alias("top_topic_pct"),
    )
    noise = laws.where(within(90, 0)).agg(pct(F.count_if(F.col("law") == ""), F.count(F.lit(1))).alias("laws_dropped_pct"))
    last = audits.agg(F.max(F.struct("id", "sampled", "missing", "income_mismatch", "activity_mismatch", "errors")).alias("audit"))
    row = arrived
    for part in (cycle, covered, top, noise, last):  # one row each
        row = row.crossJoin(part)
    return row.select(
        "*", growth_pct(F.col("mentions_now"), F.col("mentions_before")).alias("mentions_change_pct"), growth_pct(F.col("filings_90d"), F.col("filings_before")).alias("filings_change_pct"),
        growth_pct(F.col("filings_90d"), F.col("filings_year_ago")).alias("filings_year_change_pct"), F.try_divide("due_mean", "other_mean").alias("due_ratio"),
    )


def flags(measures: DataFrame) -> DataFrame:
    """Rows (flag, severity, value) of what is unusual in the measures of health, in the order of the rules."""
    c = F.col
    audit = lambda name: F.coalesce(F.col(f"audit.{name}"), F.lit(0))
    off = audit("missing") + audit("income_mismatch") + audit("activity_mismatch")
    steps = lambda x, *levels: F.coalesce(*[F.when(x >= at, severity) for severity, at in levels], F.lit(None).cast("string"))
    rules: list[tuple[str, Column, Column]] = [
        ("stored rows drift from live ones", F.when(off > 0, "high"), off),
        ("audit inconclusive", F.when(audit("errors") > F.greatest(audit("sampled"), F.lit(1)) * 0.1, "medium"), audit("errors")),
        ("shift of mentions", steps(F.abs(c("mentions_change_pct")), ("high", 50), ("medium", 30)), c("mentions_change_pct")),
        ("shift of filings", steps(F.abs(c("filings_year_change_pct")), ("medium", 35), ("low", 20)), c("filings_year_change_pct")),
        ("seasonal pattern", steps(c("due_ratio"), ("high", 3), ("medium", 1.8)), c("due_ratio")),
        ("due months hold most", steps(c("due_share_pct"), ("medium", 60)), c("due_share_pct")),
        ("coverage dips", F.when(c("coverage_90d_pct") + 3 < c("coverage_pct"), "medium"), c("coverage_90d_pct")),
        ("noise among law tags", steps(c("laws_dropped_pct"), ("high", 10), ("medium", 5)), c("laws_dropped_pct")),
        ("one topic leads", steps(c("top_topic_pct"), ("low", 15)), c("top_topic_pct")),
    ]
    every = F.array(*[F.struct(F.lit(n).alias("flag"), s.alias("severity"), v.cast("double").alias("value")) for n, s, v in rules])
    return measures.select(F.explode(F.filter(every, lambda x: x["severity"].isNotNull())).alias("x")).select("x.*")


def status(flagged: DataFrame) -> DataFrame:
    """One row: status (needs_attention, review or ok) and how many flags of each severity."""
    n = flagged.agg(*[F.count_if(F.col("severity") == s).alias(s) for s in ("high", "medium", "low")])
    return n.select(F.when(F.col("high") > 0, "needs_attention").when(F.col("medium") > 0, "review").otherwise("ok").alias("status"), "high", "medium", "low")
