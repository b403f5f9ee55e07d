"""Mixing sources to target weights (problem 9).

The total is filled with each source's target share, as far as its size times its allowed repeats goes; what such a source
cannot give goes to the others in proportion to their targets. Each source has a weight schedule over the training run;
its integral, inverted at a document's place in the source's cumulative tokens, is the time of the schedules at which the
document is due; the demand of all sources up to that time, as a part of all tokens, is its training position, and the
documents are range-sorted by it. Cumulative sums go over hash buckets of bounded size, and over blocks of these, so a source
that holds most of the corpus is never in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyspark.session import cut_lineage

#: Rows of a hash bucket, on average.
BUCKET_ROWS = 20_000
#: Buckets whose sums are added up in one task.
BLOCK_BUCKETS = 1000
#: Sources up to which the plan is broadcast (a table of targets has one row for each).
MOST_BROADCAST = 10_000


def source_key(c: Column) -> Column:
    """One label for labels differing only in case, spaces, hyphens or underscores; blank is null."""
    k = F.regexp_replace(F.regexp_replace(F.lower(c), r"(?U)[\s_\-]+", "_"), "^_|_$", "")
    return F.when(k != "", k)


def allocate(sizes: dict[str, int], targets: dict[str, tuple[float, int]], total: float) -> dict[str, float]:
    """Tokens of each source: its share of total, at most size * repeats; the shortfall goes to the others by their shares."""
    got = {s: 0.0 for s in targets}
    free = {s for s, (share, repeats) in targets.items() if share > 0 and repeats > 0 and sizes.get(s, 0) > 0}
    left = float(total)
    while free and left > 0:
        weight = sum(targets[s][0] for s in free)
        over = {s for s in free if sizes[s] * targets[s][1] <= left * targets[s][0] / weight}
        if not over:
            for s in free:
                got[s] = left * targets[s][0] / weight
            break
        for s in sorted(over):
            got[s] = float(sizes[s] * targets[s][1])
        left -= sum(got[s] for s in over)
        free -= over
    return got


def inverse_schedule(u: Column, slope: Column) -> Column:
    """The time t in [0, 1] at which a source of linear weight 1 + slope * (1 - 2t) has used the part u of its tokens.

    The integral of the weight is (1 + slope) t - slope t^2; slope in [-1, 1]: 1 starts at twice its mean weight and fades
    out, -1 the reverse, 0 is even.
    """
    a = 1 + slope
    root = F.sqrt(F.greatest(a * a - 4 * slope * u, F.lit(0.0)))
    return F.when(F.abs(slope) < 1e-9, u).otherwise((a - root) / (2 * slope))


def consumed(t: Column, slope: float) -> Column:
    """The part of all tokens used up to time t, from the mean slope of the sources by their tokens: at it the shares of the sources add up to one."""
    return (1 + slope) * t - slope * t * t


def mix(sized: DataFrame, targets: DataFrame, slopes: dict[str, float] | None = None, buckets: int = 0) -> tuple[DataFrame, DataFrame]:
    """(schedule, shares) for sized rows (id, source, n_tokens) and targets (source, target_share, max_repeats).

    schedule: position (part of all tokens used before and half of it), doc_id, source, pass, n_tokens, sorted by position; each use of a document is a row. shares: one row
    per source of either table with what was asked, available and reached. Documents without tokens are never drawn; those
    of a null source, or of one without target, have target 0. A null max_repeats counts as 1. slopes: of a source's weight
    schedule (see inverse_schedule), 0 where not given. Repeated rows are documents of their own.
    """
    docs = cut_lineage(sized.select("id", source_key(F.col("source")).alias("source"), F.coalesce("n_tokens", F.lit(0)).cast("long").alias("n_tokens")))
    goals = targets.select(source_key(F.col("source")).alias("source"), F.coalesce("target_share", F.lit(0.0)).alias("share"), F.coalesce("max_repeats", F.lit(1)).alias("repeats")).where("source is not null")
    goals = goals.groupBy("source").agg(F.sum("share").alias("share"), F.max("repeats").alias("repeats"))
    wanted = {r.source: (r.share, r.repeats) for r in goals.collect()}  # the table of targets: one row per source
    per = docs.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("n"))
    totals = per.join(goals.select("source"), "source", "left_semi").collect()
    everything = per.agg(F.sum("tokens").alias("t"), F.sum("n").alias("n")).first()
    total, n = everything.t or 0, everything.n or 0
    sizes = {r.source: r.tokens for r in totals}
    plan = allocate(sizes, wanted, total)
    spark = sized.sparkSession
    slope = lambda x: min(1.0, max(-1.0, float((slopes or {}).get(x, 0.0))))
    mean_slope = sum(plan[x] * slope(x) for x in plan) / max(1.0, sum(plan.values()))
    rows = [(s, wanted[s][0], wanted[s][1], sizes.get(s, 0), plan[s], slope(s)) for s in sorted(wanted)]
    plans = spark.createDataFrame(rows, "source string, share double, repeats int, tokens long, planned double, slope double")
    buckets = buckets or max(1, -(-n // BUCKET_ROWS))

    some = plans.where("planned > 0")
    drawn = docs.where("n_tokens > 0").join(F.broadcast(some) if len(rows) <= MOST_BROADCAST else some, "source")
    passes = F.ceil(F.col("planned") / F.col("tokens")).cast("int")
    uses = drawn.select("*", F.explode(F.sequence(F.lit(0), F.greatest(passes - 1, F.lit(0)))).alias("pass"))
    uses = uses.withColumn("h", F.xxhash64("id", "pass")).withColumn("bucket", F.pmod(F.shiftrightunsigned("h", 1), F.lit(buckets)).cast("int"))
    group = ["source", "pass", "bucket"]
    cells = uses.groupBy(*group).agg(F.sum("n_tokens").alias("sum")).withColumn("block", F.floor((F.col("pass").cast("long") * buckets + F.col("bucket")) / BLOCK_BUCKETS))
    earlier = lambda *by: Window.partitionBy("source", *by[:-2]).orderBy(*by[-2:]).rowsBetween(Window.unboundedPreceding, -1)
    blocks = cells.groupBy("source", "block").agg(F.sum("sum").alias("sum")).select("source", "block", F.coalesce(F.sum("sum").over(earlier("block", "sum")), F.lit(0)).alias("ahead"))
    starts = cells.withColumn("own", F.coalesce(F.sum("sum").over(earlier("block", "pass", "bucket")), F.lit(0))).join(blocks, ["source", "block"]).select(*group, (F.col("ahead") + F.col("own")).alias("start"))
    within = Window.partitionBy(*group).orderBy("h", "id").rowsBetween(Window.unboundedPreceding, 0)
    placed = uses.join(starts, group).withColumn("end", F.col("start") + F.sum("n_tokens").over(within))
    middle = F.col("end") - F.col("n_tokens") / 2
    kept = placed.where(middle <= F.col("planned")).select(consumed(inverse_schedule(F.least(middle / F.col("planned"), F.lit(1.0)), F.col("slope")), mean_slope).alias("position"), F.col("id").alias("doc_id"), "source", "pass", "n_tokens")
    schedule = kept.orderBy("position", "source", "pass", "doc_id")

    reached = kept.groupBy("source").agg(F.sum("n_tokens").alias("reached_tokens"), F.count(F.lit(1)).alias("n_uses"))
    grand = reached.agg(F.sum("reached_tokens").alias("all_tokens"))
    asked = plans.drop("slope", "tokens")
    shares = per.select("source", F.col("tokens").alias("available_tokens"), F.col("n").alias("n_documents")).join(asked, "source", "full").join(reached, "source", "left").crossJoin(grand)
    zero = lambda c, kind="long": F.coalesce(F.col(c), F.lit(0)).cast(kind)
    shares = shares.select(
        "source", zero("n_documents").alias("n_documents"), zero("available_tokens").alias("available_tokens"), zero("share", "double").alias("target_share"), zero("repeats", "int").alias("max_repeats"),
        zero("planned", "double").alias("planned_tokens"), zero("reached_tokens").alias("reached_tokens"), zero("n_uses").alias("n_uses"),
        F.coalesce(F.try_divide("reached_tokens", "all_tokens"), F.lit(0.0)).alias("reached_share"),
        ((zero("share", "double") > 0) & (zero("planned", "double") >= zero("available_tokens") * zero("repeats"))).alias("used_up"),
    )
    return schedule, shares
