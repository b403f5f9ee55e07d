"""Signals: records, spikes, concentration, new entrants and coordinated surges in series of spending per period."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tallyspark.functions.periods import quarter_of, year_of

COLUMNS = ("signal_type", "entity", "current_value", "prior_value", "growth_rate", "historical_pct", "magnitude", "q")


def _signal(df: DataFrame, kind: str, entity: str, **columns: str) -> DataFrame:
    null = F.lit(None).cast("double")
    pick = [F.expr(columns[c]).cast("double").alias(c) if c in columns else null.alias(c) for c in COLUMNS[2:-1]]
    return df.select(F.lit(kind).alias("signal_type"), F.col(entity).cast("string").alias("entity"), *pick, "q")


def history(series: DataFrame, entity: str) -> DataFrame:
    """series (entity, q, value) with, per row: most before (highest earlier value), periods, total, below (part of the entity's values under this one), last (whether it is the entity's latest)."""
    by = Window.partitionBy(entity)
    before = by.orderBy("q").rowsBetween(Window.unboundedPreceding, -1)
    lower = F.rank().over(by.orderBy("value")) - 1
    return series.select(
        entity, "q", "value", F.max("value").over(before).alias("most_before"), F.count(F.lit(1)).over(by).alias("periods"), F.sum("value").over(by).alias("total"),
        (lower / F.count(F.lit(1)).over(by)).alias("below"), (F.col("q") == F.max("q").over(by)).alias("last"),
    )


def records(series: DataFrame, entity: str, least_total: float = 1e6, least_periods: int = 5) -> DataFrame:
    """The latest value of an entity above all earlier ones."""
    h = history(series, entity).where(f"last and total >= {least_total} and value > most_before and periods >= {least_periods}")
    return _signal(h, "record", entity, current_value="value", prior_value="most_before", growth_rate="try_divide(value - most_before, most_before)", historical_pct="below", magnitude="value / 1e6")


def spikes(series: DataFrame, entity: str, least_base: float = 5e5, least_growth: float = 1.0, least_periods: int = 5, latest_only: bool = True) -> DataFrame:
    """Growth against the same quarter of the year before; a self join, since quarters may be missing."""
    h = history(series, entity).where(f"periods >= {least_periods}" + " and last" * latest_only)
    base = series.select(entity, (F.col("q") + 4).alias("q"), F.col("value").alias("base"))
    x = h.join(base, [entity, "q"]).where(f"base >= {least_base} and (value - base) / base >= {least_growth}")
    return _signal(x, "spike", entity, current_value="value", prior_value="base", growth_rate="(value - base) / base", historical_pct="below", magnitude="(value - base) / 1e6")


def concentration(spend: DataFrame, group: str, party: str, least_total: float = 5e5, least_share: float = 0.3, most_before: float = 0.1) -> DataFrame:
    """A party that holds much of a group's latest period and held little of it a year before. spend: group, party, q, value."""
    w = Window.partitionBy(group, "q")
    shares = spend.groupBy(group, party, "q").agg(F.sum("value").alias("value")).withColumn("total", F.sum("value").over(w)).withColumn("share", F.try_divide("value", "total"))
    top = shares.withColumn("latest", F.max("q").over(Window.partitionBy(group))).where("q = latest")
    top = top.groupBy(group, "q").agg(F.max("total").alias("total"), F.max_by(F.struct(party, "share", "value"), F.struct("share", party)).alias("t")).select(group, "q", "total", "t.*")
    base = shares.select(group, party, (F.col("q") + 4).alias("q"), F.col("share").alias("base"))
    x = top.join(base, [group, party, "q"], "left").where(f"total >= {least_total} and share >= {least_share} and coalesce(base, 0) <= {most_before}")
    x = x.withColumn("entity_name", F.concat(F.col(group).cast("string"), F.lit(": "), F.col(party).cast("string")))
    return _signal(x, "concentration", "entity_name", current_value="share", prior_value="coalesce(base, 0)", growth_rate="share - coalesce(base, 0)", magnitude="total / 1e6")


def entrants(spend: DataFrame, group: str, party: str) -> DataFrame:
    """Parties in the latest period of all that were never before in their group: group, party, q, value."""
    per = spend.groupBy(group, party, "q").agg(F.sum("value").alias("value"))
    latest = per.agg(F.max("q").alias("latest"))
    first = F.min("q").over(Window.partitionBy(group, party))
    return per.withColumn("first", first).crossJoin(F.broadcast(latest)).where("q = latest and first = latest").select(group, party, "q", "value")


def new_entrants(spend: DataFrame, group: str, party: str) -> DataFrame:
    x = entrants(spend, group, party).withColumn("entity_name", F.concat(F.col(group).cast("string"), F.lit(": "), F.col(party).cast("string")))
    return _signal(x, "new_entrant", "entity_name", current_value="value", prior_value="0", magnitude="value / 1e6")


def coordinated(spend: DataFrame, group: str, party: str, least: int = 3) -> DataFrame:
    """Groups that several new parties entered in the latest period: group, q, n, value."""
    return entrants(spend, group, party).groupBy(group, "q").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("value")).where(F.col("n") >= least)


def coordinated_signals(spend: DataFrame, group: str, party: str, least: int = 3) -> DataFrame:
    return _signal(coordinated(spend, group, party, least), "coordinated", group, current_value="n", prior_value="0", magnitude="value / 1e6")


def detect(series: dict[str, DataFrame], spend: DataFrame, group: str, party: str) -> DataFrame:
    """All signals, the greatest first, with year and quarter. series: entity column -> (entity, q, value)."""
    parts: Sequence[DataFrame] = [f(s, e) for e, s in series.items() for f in (records, spikes)] + [f(spend, group, party) for f in (concentration, new_entrants, coordinated_signals)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("year", year_of(F.col("q"))).withColumn("quarter", quarter_of(F.col("q"))).orderBy(F.desc("magnitude"), "signal_type", "entity")
