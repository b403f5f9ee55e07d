"""Ranked search and the small result sets of a dashboard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def match_score(name: Column, query: str) -> Column:
    """100 for the same name, 80 for a prefix of it, 60 for a prefix of a later word, 30 for anywhere in it, else null."""
    n, q = F.lower(F.trim(name)), query.lower().strip()
    return F.when(n == q, 100).when(n.startswith(q), 80).when(n.contains(" " + q), 60).when(n.contains(q), 30)


def search(items: DataFrame, query: str, name: str = "name", weight: str = "n", most: int = 30) -> DataFrame:
    """Items (name, weight, ...) that match, best first; ties by weight, then name. A blank query finds nothing."""
    x = items.withColumn("score", match_score(F.col(name), query)) if query.strip() else items.limit(0).withColumn("score", F.lit(None).cast("int"))
    return x.where("score is not null").orderBy(F.desc("score"), F.desc(weight), name).limit(most)


def merged_movers(movers: DataFrame, name: str = "tag", most: int = 30) -> DataFrame:
    """Movers (category, name, count, delta_pp, score) in one list: of equal names that of the higher count, ordered by the size of the score."""
    w = Window.partitionBy(F.lower(name)).orderBy(F.desc("count"), "category")
    one = movers.select("category", name, "count", "delta_pp", "score").withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
    return one.orderBy(F.desc(F.abs("score")), name).limit(most)


def hero_picks(movers: DataFrame, name: str = "tag", n: int = 3, least: int = 100) -> DataFrame:
    """The first rising item of enough mentions of each category, up to n; filled up with the next best."""
    good = (F.col("delta_pp") > 0) & (F.col("count") >= least)
    w = Window.partitionBy("category").orderBy(F.desc(good), F.desc(F.abs("score")), name)
    x = movers.withColumn("first", (F.row_number().over(w) == 1) & good)
    return x.orderBy(F.desc("first"), F.desc(F.abs("score")), name).limit(n).drop("first")


def digest(movers: DataFrame, name: str = "tag", quotas: dict[str, int] | None = None) -> DataFrame:
    """The greatest risers of each category up to its quota."""
    quotas = quotas or {"topics": 4, "legislation": 4, "entities": 3}
    w = Window.partitionBy("category").orderBy(F.desc("score"), name)
    quota = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in quotas.items() for x in kv]), F.col("category")), F.lit(0))
    return movers.where("delta_pp > 0").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= quota)


def intensity(ratio: Column) -> Column:
    return F.when(ratio.isNull(), "new").when(ratio >= 5, "surge").when(ratio >= 2, "strong").when(ratio >= 1.25, "up").otherwise("steady")


def direction(pct: Column, narrow: float = 2.0, wide: float = 5.0) -> Column:
    return F.when(pct.isNull(), "none").when(pct > wide, "up").when(pct > narrow, "slightly_up").when(pct < -wide, "down").when(pct < -narrow, "slightly_down").otherwise("flat")


def longest_prefix(keys: DataFrame, known: DataFrame, key: str = "key") -> DataFrame:
    """Each key with the longest known key that it begins with (by whole words): stale links brought home."""
    k = keys.select(key).distinct().withColumn("w", F.split(key, " "))
    steps = k.select(key, F.explode(F.transform(F.sequence(F.lit(1), F.size("w")), lambda i: F.array_join(F.slice("w", F.lit(1), i), " "))).alias("known_key"))
    hit = steps.join(known.select(F.col(key).alias("known_key")).distinct(), "known_key")
    return hit.groupBy(key).agg(F.max_by("known_key", F.length("known_key")).alias("known_key"))
