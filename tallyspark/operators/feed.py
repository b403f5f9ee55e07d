"""Applying a change feed (problem 7) as a commutative fold.

Per key the maximum of struct(sequence, operation, payload) is the state, base rows included with no sequence. The
maximum does not depend on the order or number of deliveries, and combines before the shuffle, so hot keys cost one row
per map task. Deletes stay as tombstones: a late change with a lower sequence cannot bring a row back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

UPSERTS = ("i", "u", "c", "r", "insert", "ins", "update", "upd", "create", "upsert", "read")
DELETES = ("d", "delete", "del", "remove", "tombstone")


def operation(op: Column) -> Column:
    """1 for a delete, 0 for an insert or update in any spelling, null for what is neither."""
    o = F.lower(F.trim(op))
    return F.when(o.isin(*DELETES), 1).when(o.isin(*UPSERTS), 0)


def fold_changes(feed: DataFrame, key: str, sequence: str, op: str, payload: Sequence[str], base: DataFrame | None = None) -> DataFrame:
    """The state after all changes: key, sequence (null: base row without change), deleted, and the payload of the last change.

    key and sequence are SQL over feed's columns (key also over base's); payload names columns of both. An update of an
    unknown key creates it. At equal sequence a delete wins, then the larger payload. Changes with a null key or sequence
    or an unknown operation have no place in the order and are left out. Feed fold_changes its own result again (as
    state_as_feed) together with later changes: tombstones keep late ones from reviving a row.
    """
    item = lambda seq, deleted: F.struct(seq.alias("seq"), deleted.alias("deleted"), F.struct(*[F.col(c) for c in payload]).alias("row"))
    rows = feed.select(F.expr(key).alias("key"), item(F.expr(sequence).cast("long"), operation(F.col(op))).alias("x")).where("key is not null and x.seq is not null and x.deleted is not null")
    if base is not None:
        rows = rows.unionByName(base.select(F.expr(key).alias("key"), item(F.lit(None).cast("long"), F.lit(0)).alias("x")).where("key is not null"))
    last = rows.groupBy("key").agg(F.max("x").alias("x"))
    return last.select("key", F.col("x.seq").alias("sequence"), (F.col("x.deleted") == 1).alias("deleted"), "x.row.*")


def current_rows(state: DataFrame) -> DataFrame:
    """The rows that exist in a state, without tombstones."""
    return state.where(~F.col("deleted")).drop("deleted")
