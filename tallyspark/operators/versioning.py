"""Which version of a record counts: repeated rows, supersession now and as of a past day, idempotent loads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

GROUP = ("registrant_id", "client_id", "year", "quarter")


def first_of_repeats(df: DataFrame, keys: Sequence[Column | str], id_col: str = "id") -> DataFrame:
    """One row, that of the smallest id, of rows equal in keys; nulls are equal. min combines before the shuffle."""
    named = [F.coalesce(k, F.lit("")).alias(f"_k{i}") if isinstance(k, Column) else F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    keep = df.select(*named, F.col(id_col)).groupBy(*[f"_k{i}" for i in range(len(keys))]).agg(F.min(id_col).alias(id_col)).select(id_col)
    return df.join(keep, id_col, "left_semi")


def _last(order: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in order])


def latest(df: DataFrame, keys: Sequence[str] = GROUP, order: Sequence[str] = ("filing_date", "id")) -> DataFrame:
    """The last row of each group by order; null keys form a group, null dates come before all others.

    A maximum of structs, combined before the shuffle, so a group of any size costs one row per map task; of rows equal in
    order the largest in the other columns stays.
    """
    rest = [c for c in df.columns if c not in order and c not in keys]
    ahead = [c for c in order if c not in keys]
    best = df.groupBy(*keys).agg(F.max(F.struct(*ahead, *rest)).alias("_x"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_x.{c}").alias(c) for c in df.columns])


def mark_current(df: DataFrame, keys: Sequence[str] = GROUP, order: Sequence[str] = ("filing_date", "id"), name: str = "is_current", id_col: str = "id") -> DataFrame:
    """df with name set true on the last row of each group, else false; ids are unique.

    The last rows are found by a combined maximum and brought back by id, so no group meets in one task.
    """
    last = df.groupBy(*keys).agg(F.max(_last(order)).alias("_x")).select(F.col(f"_x.{id_col}").alias(id_col), F.lit(True).alias("_last"))
    return df.drop(name).join(last, id_col, "left").select(*[c for c in df.columns if c != name], F.coalesce("_last", F.lit(False)).alias(name))


def as_of(df: DataFrame, day: str, keys: Sequence[str] = GROUP, order: Sequence[str] = ("filing_date", "id"), date_col: str = "filing_date") -> DataFrame:
    """What was current on a day: the last of the rows posted up to it (days as written), ranked anew, since a later amendment was not known then."""
    return latest(df.where(F.substring(F.ltrim(date_col), 1, 10) <= day), keys, order)


def as_of_by_absence(df: DataFrame, day: str, keys: Sequence[str] = GROUP, date_col: str = "filing_date") -> DataFrame:
    """The same as an anti join: no row of the group up to that day is later. A null key equals none, so such rows all stay."""
    seen = df.where(F.substring(F.ltrim(date_col), 1, 10) <= day)
    a, b = seen.alias("a"), seen.alias("b")
    later = (F.col(f"b.{date_col}") > F.col(f"a.{date_col}")) | ((F.col(f"b.{date_col}") == F.col(f"a.{date_col}")) & (F.col("b.id") > F.col("a.id")))
    on = later
    for k in keys:
        on = (F.col(f"a.{k}") == F.col(f"b.{k}")) & on
    return a.join(b, on, "left_anti")


def only_new(rows: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not stored yet, each key once: what an insert-if-absent load appends."""
    return rows.dropDuplicates(list(keys)).join(stored.select(*keys), list(keys), "left_anti")


def upsert(stored: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """stored with rows put in place of those of equal key; columns that one side lacks are null."""
    return stored.join(rows.select(*keys).distinct(), list(keys), "left_anti").unionByName(rows, allowMissingColumns=True)


def pending(work: DataFrame, done: DataFrame, key: str, done_key: str | None = None) -> DataFrame:
    """Rows of work without a row in done."""
    return work.join(done.select(F.col(done_key or key).alias(key)).where(F.col(key).isNotNull()).distinct(), key, "left_anti")


def stratified(df: DataFrame, strata: Sequence[str], n: int, id_col: str = "id", seed: str = "1") -> DataFrame:
    """n rows drawn evenly over the strata, in rounds, in an order given by a hash of id and seed: the same rows in every run."""
    h = F.md5(F.concat(F.col(id_col).cast("string"), F.lit(seed)))
    w = Window.partitionBy(*strata).orderBy(h, id_col)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n).orderBy("rank", *strata).limit(n)  # no stratum gives more than n


def fill_from(df: DataFrame, found: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """df with the null values of some columns filled from a table of lookups (one row per key; of repeated ones the largest values)."""
    once = found.groupBy(key).agg(*[F.max(c).alias(f"_{c}") for c in columns])
    have = set(df.columns)
    return df.join(once, key, "left").select(*[c for c in df.columns if c not in columns], *[(F.coalesce(F.col(c), F.col(f"_{c}")) if c in have else F.col(f"_{c}")).alias(c) for c in columns])
