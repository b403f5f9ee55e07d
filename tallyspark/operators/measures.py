"""Aggregates over facts and mentions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def allocated_income(labels: DataFrame, activities: DataFrame, filings: DataFrame) -> DataFrame:
    """Income by label and period: a filing's income is shared evenly by its activities, and an activity of several labels gives its share to each.

    labels: activity_id, label. activities: activity_id, filing_id. filings: filing_id, year, quarter, income (> 0 count).
    """
    per = activities.groupBy("filing_id").agg(F.count(F.lit(1)).alias("n_activities"))
    share = activities.join(filings.where("income > 0"), "filing_id").join(per, "filing_id").withColumn("share", F.try_divide("income", "n_activities"))
    return labels.join(share, "activity_id").groupBy("label", "year", "quarter").agg(F.sum("share").alias("income"), F.count(F.lit(1)).alias("n"))


def count_mentions(mentions: DataFrame, *more: str) -> DataFrame:
    """Of each tag: mentions (each activity's counts), filings and clients (distinct keys), income (each filing once).

    Distinct filings first, so that income is summed once per filing and the distinct counts are plain ones.
    """
    by = ["kind", "tag", *more]
    filings = mentions.groupBy(*by, "filing_id").agg(F.count(F.lit(1)).alias("n"), F.first("income").alias("income"), F.first("client_key").alias("client_key"))
    clients = filings.groupBy(*by, "client_key").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("filings"), F.sum("income").alias("income"))
    return clients.groupBy(*by).agg(F.sum("n").alias("mentions"), F.sum("filings").alias("filings"), F.count("client_key").alias("clients"), F.sum("income").alias("income"))


def tag_clients(mentions: DataFrame) -> DataFrame:
    """Income of each (kind, tag, client), each filing once; a client in several spellings is one, with the greatest of its names."""
    filings = mentions.groupBy("kind", "tag", "filing_id").agg(F.first("income").alias("income"), F.first("client_key").alias("client_key"), F.first("client_name").alias("client_name"))
    return filings.groupBy("kind", "tag", "client_key").agg(F.sum("income").alias("income"), F.max("client_name").alias("client_name"))


def top_per_group(df: DataFrame, by: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first k rows of each group; Spark prunes each task to k rows per group before the shuffle."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(rank) <= k)


def with_share(df: DataFrame, total: int | DataFrame, count_col: str, name: str = "share") -> DataFrame:
    """count_col as a percentage of a total: a number, or a table of one row and column."""
    if isinstance(total, DataFrame):
        t = total.columns[0]
        return df.crossJoin(F.broadcast(total)).withColumn(name, F.coalesce(F.try_divide(F.col(count_col) * 100, F.col(t)), F.lit(0.0))).drop(t)
    return df.withColumn(name, F.col(count_col) * 100 / F.lit(total) if total else F.lit(0.0))


def nearest_rank(sorted_values: Column, q: float) -> Column:
    """The value at rank (n - 1) * q, rounded half to even, of a sorted array; null for an empty one."""
    return F.get(sorted_values, F.rint((F.size(sorted_values) - 1) * F.lit(q)).cast("int"))


def most_frequent(df: DataFrame, by: str, value: str) -> DataFrame:
    """Of each group the most frequent value; ties go to the shorter, then the smaller one."""
    n = df.where(F.col(value).isNotNull()).groupBy(by, value).agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy(by).agg(F.min(F.struct((-F.col("n")).alias("n"), F.length(value).alias("l"), F.col(value).alias("v"))).alias("x")).select(by, F.col("x.v").alias(value), (-F.col("x.n")).alias("n"))


def growth_pct(now: Column, before: Column) -> Column:
    """Change in percent, null without a base."""
    return F.when(before != 0, (now - before) * 100 / before)
