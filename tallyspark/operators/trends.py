"""Two-frame trends: complete quarters and quarters to date against a year before, as plans on mentions and filings."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyspark.functions.periods import q_index, quarter_end
from tallyspark.operators.versioning import latest

#: Days after the end of a quarter until it counts as complete.
GRACE = 40
#: Filings below which a quarter to date is thin.
THIN = 2000


@dataclass(frozen=True)
class Leg:
    """A quarter, whole or through a day."""

    q: int
    through: str | None = None

    @property
    def year(self) -> int:
        return (self.q - 1) // 4

    @property
    def quarter(self) -> int:
        return (self.q - 1) % 4 + 1


@dataclass(frozen=True)
class Frame:
    name: str
    current: Leg
    baseline: Leg


def anchor_day(filings: DataFrame) -> date:
    """The day after the last posting; not the clock's, so that results depend on the data alone. Without any posting a day before all."""
    last = filings.agg(F.max(F.substring(F.ltrim("filing_date"), 1, 10).try_cast("date"))).first()[0]
    return last + timedelta(days=1) if last else date(1900, 1, 1)


def last_complete(anchor: date, grace: int = GRACE) -> int:
    """The index of the last quarter whose end lies more than grace days before the anchor."""
    q = anchor.year * 4 + (anchor.month - 1) // 3 + 1
    while anchor <= _end(q) + timedelta(days=grace):
        q -= 1
    return q


def _end(q: int) -> date:
    year, month = (q - 1) // 4, ((q - 1) % 4 + 1) * 3
    return date(year + month // 12, month % 12 + 1, 1) - timedelta(days=1)


def frames(anchor: date, last_reported: int | None = None) -> list[Frame]:
    """quarter: the last complete one against a year before. qtd: the next one, through the last posting, against the same day a year before.

    last_reported: the last quarter with filings; where a single late posting has moved the anchor beyond it, the frames end with it.
    """
    q, through = last_complete(anchor), anchor - timedelta(days=1)
    q, to_date = (q, q + 1) if last_reported is None else (min(q, last_reported), min(q + 1, last_reported))
    return [Frame("quarter", Leg(q), Leg(q - 4)), Frame("qtd", Leg(to_date, str(through)), Leg(to_date - 4, str(through - timedelta(days=365))))]


def data_frames(filings: DataFrame) -> list[Frame]:
    """The frames that filings (year, quarter, filing_date) give."""
    return frames(anchor_day(filings), filings.agg(F.max(q_index())).first()[0])


def leg_filings(filings: DataFrame, leg: Leg) -> DataFrame:
    """The filings of a leg: current ones, or with a day those current as of that day."""
    return latest(filings.where(in_leg(leg)))


def in_leg(leg: Leg) -> Column:
    own = (F.col("year") == leg.year) & (F.col("quarter") == leg.quarter)
    return own & (F.substring(F.ltrim("filing_date"), 1, 10) <= leg.through) if leg.through else own


def both_legs(filings: DataFrame, frame: Frame) -> DataFrame:
    """The filings of both legs of a frame in one pass, with now: whether of the current one. The quarters reach the scan."""
    rows = latest(filings.where(in_leg(frame.current) | in_leg(frame.baseline)))
    return rows.withColumn("now", (F.col("year") == frame.current.year) & (F.col("quarter") == frame.current.quarter))


def changes(counts: DataFrame, totals: DataFrame, least: int = 1, most: int = 500, by: str = "kind", key: str = "tag") -> DataFrame:
    """Tags of the current leg beside the baseline (0 where absent; tags only in the baseline are not reported), the first of each kind by rank.

    counts: kind, tag, count, baseline_count. totals: one row (now, before), the activities of each leg. Shares are in percent
    of them; score is their difference and a little for the size: + min(count / 2000, 1) * 0.1.
    """
    x = counts.where(F.col("count") >= least).crossJoin(F.broadcast(totals))
    share = lambda c, t: F.coalesce(F.try_divide(F.col(c) * 100.0, F.col(t)), F.lit(0.0))
    x = x.withColumn("share", share("count", "now")).withColumn("baseline_share", share("baseline_count", "before")).withColumn("delta_pp", F.col("share") - F.col("baseline_share")).drop("now", "before")
    x = x.withColumn("ratio", F.try_divide("count", "baseline_count")).withColumn("score", F.col("delta_pp") + F.least(F.col("count") / 2000, F.lit(1.0)) * 0.1)
    x = x.withColumn("confidence", confidence(F.col("count"), F.col("baseline_count"), F.col("delta_pp")))
    w = Window.partitionBy(by).orderBy(F.desc(F.abs("score")), F.desc("count"), key)
    return x.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= most)


def confidence(count: Column, baseline: Column, delta: Column) -> Column:
    return F.when((count >= 50) & (baseline >= 50) & (F.abs(delta) >= 0.35), "high").when((count >= 25) & (F.abs(delta) >= 0.15), "medium").otherwise("low")


def alerts(changed: DataFrame, key: str, least_pp: float = 0.25, least: int = 25, most: int = 20) -> DataFrame:
    rank = F.when(F.col("confidence") == "high", 0).when(F.col("confidence") == "medium", 1).otherwise(2)
    x = changed.where((F.abs("delta_pp") >= least_pp) & (F.col("count") >= least))
    way = F.when(F.col("delta_pp") >= 0, "up").otherwise("down")
    headline = F.format_string("%s %s %.2f points", F.col(key), way, F.abs("delta_pp"))
    return x.withColumn("direction", way).withColumn("headline", headline).orderBy(rank, F.desc(F.abs("delta_pp")), F.desc("count"), key).limit(most)


def client_legs(filings: DataFrame, frame: Frame, key: str = "client_key") -> DataFrame:
    """Of each client its income in both legs, in the four quarters before the baseline, and the difference; clients in neither leg are left out.

    One pass over the filings of the legs and one over the quarters before.
    """
    paid = F.coalesce("income", F.lit(0.0))
    both = both_legs(filings, frame).groupBy(key).agg(F.sum(F.when(F.col("now"), paid).otherwise(0.0)).alias("now"), F.sum(F.when(~F.col("now"), paid).otherwise(0.0)).alias("before")).where("now <> 0 or before <> 0")
    q = q_index()
    early = latest(filings.where(q.between(frame.baseline.q - 4, frame.baseline.q - 1))).groupBy(key).agg(F.sum(paid).alias("early"))
    return both.join(early, key, "left").select(key, "now", "before", F.coalesce("early", F.lit(0.0)).alias("early"), (F.col("now") - F.col("before")).alias("delta"))


def movers(legs: DataFrame, floor: float = 1e5, new_floor: float = 2.5e5, key: str = "client_key") -> DataFrame:
    """Risers (25), fallers (15) and new entrants (10; nothing in the baseline nor in the four quarters before it), and the 150 greatest others."""
    new = (F.col("before") == 0) & (F.col("early") == 0)
    kind = F.when(new & (F.col("now") >= new_floor), "new_entrant").when(~new & (F.col("delta") >= floor), "riser").when(F.col("delta") <= -floor, "faller").otherwise("major")
    x = legs.withColumn("kind", kind)
    size = F.when(F.col("kind") == "major", F.col("now")).otherwise(F.abs("delta"))
    x = x.withColumn("rank", F.row_number().over(Window.partitionBy("kind").orderBy(size.desc(), key)))
    return x.where("rank <= case kind when 'riser' then 25 when 'faller' then 15 when 'new_entrant' then 10 else 150 end")


def dense_series(counts: DataFrame, key: str, quarters: int = 20, last: int | None = None) -> DataFrame:
    """key, series: counts of the last quarters in order, 0 where there are none. counts: key, q, n."""
    last = last if last is not None else counts.agg(F.max("q")).first()[0]
    if last is None:
        return counts.select(key).limit(0).withColumn("series", F.array().cast("array<bigint>"))
    dense = counts.select(key).distinct().withColumn("q", F.explode(F.sequence(F.lit(last - quarters + 1), F.lit(last)))).join(counts, [key, "q"], "left")
    return dense.groupBy(key).agg(F.expr("transform(array_sort(collect_list(struct(q, coalesce(n, 0) as n))), x -> x.n)").alias("series"))


def deflators(cpi: DataFrame) -> DataFrame:
    """Rows (year, quarter, factor) of a monthly index (month date, value): mean of the last year with a December over the quarter's mean; quarters without a month take the latest print."""
    base_year = cpi.where(F.month("month") == 12).agg(F.max(F.year("month")).alias("y"))
    base = cpi.join(F.broadcast(base_year), F.year("month") == F.col("y")).agg(F.avg("value").alias("base"))
    per = cpi.groupBy(F.year("month").alias("year"), F.quarter("month").alias("quarter")).agg(F.avg("value").alias("mean"))
    return per.crossJoin(F.broadcast(base)).select("year", "quarter", F.try_divide("base", "mean").alias("factor"))


def complete_flags(counts: DataFrame) -> DataFrame:
    """Quarters (q, n) with partial: from the last backwards, those below half the median, up to the first that is not."""
    median = counts.agg(F.expr("percentile(n, 0.5)").alias("median"))
    x = counts.crossJoin(F.broadcast(median)).withColumn("ok", (F.col("n") >= F.col("median") / 2).cast("int"))
    after = Window.orderBy(F.desc("q")).rowsBetween(Window.unboundedPreceding, 0)  # one row per quarter
    return x.select("q", "n", (F.max("ok").over(after) == 0).alias("partial"))


def end_of(q: Column) -> Column:
    return quarter_end(q)
