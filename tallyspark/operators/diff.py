"""Differences between two copies of a table, field by field (problem 2).

Sides are tagged and united, grouped once by key, one struct per side is kept, and the struct fields are compared by
generated higher-order SQL. The struct of a side is the maximum by `order`, which combines before the shuffle, so a key
repeated any number of times costs one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F


@dataclass(frozen=True)
class Field:
    """A field to compare: its value on either side as SQL, and when `l` and `r` differ (default: null-safe inequality)."""

    name: str
    left: str
    right: str
    differs: str = "not (l <=> r)"


def pair_copies(left: DataFrame, right: DataFrame, key: tuple[str, str], fields: Sequence[Field], order: tuple[str, str] = ("0", "0")) -> DataFrame:
    """One row per key: key, n_left, n_right (rows on each side), l and r (structs of the compared values, null if absent).

    key and order are SQL over the side's columns; of repeated keys the row with the largest order, then the largest
    values, stands for its side. Rows with a null key cannot be matched: they are left out here. Empty tables and extra
    columns are fine; only the named expressions are read.
    """

    def tagged(df: DataFrame, side: int) -> DataFrame:
        value = F.struct(*[F.expr(f.right if side else f.left).alias(f.name) for f in fields])
        return df.select(F.expr(key[side]).alias("key"), F.lit(side).alias("side"), F.struct(F.expr(order[side]).alias("o"), value.alias("v")).alias("x"))

    both = tagged(left, 0).unionByName(tagged(right, 1)).where("key is not null")
    return both.groupBy("key").agg(
        F.sum(1 - F.col("side")).alias("n_left"),
        F.sum("side").alias("n_right"),
        F.expr("max(x) filter (where side = 0)").alias("lx"),
        F.expr("max(x) filter (where side = 1)").alias("rx"),
    ).select("key", "n_left", "n_right", F.col("lx.v").alias("l"), F.col("rx.v").alias("r"))


def field_differences(paired: DataFrame, fields: Sequence[Field], missing_left: str, missing_right: str) -> DataFrame:
    """Rows (key, field_name, left_value, right_value) of what differs, from pair_copies: a key without a left side gives
    field_name missing_left, one without a right side missing_right, else one row per differing field."""
    checks = ", ".join(
        f"named_struct('field_name', '{f.name}', 'left_value', string(l.{f.name}), 'right_value', string(r.{f.name}), 'differs', "
        f"{_on(f.differs, f.name)})" for f in fields
    )
    gone = "array(named_struct('field_name', '{}', 'left_value', string(null), 'right_value', string(null), 'differs', true))"
    found = F.expr(f"case when l is null then {gone.format(missing_left)} when r is null then {gone.format(missing_right)} else filter(array({checks}), x -> x.differs) end")
    return paired.select("key", F.explode(found).alias("d")).select("key", "d.field_name", "d.left_value", "d.right_value")


def repeated_keys(paired: DataFrame) -> DataFrame:
    """Rows (key, field_name 'repeated', left_value, right_value) of keys that stand on a side more than once, with how often on either."""
    n = lambda c: F.col(c).cast("string")
    return paired.where("n_left > 1 or n_right > 1").select("key", F.lit("repeated").alias("field_name"), n("n_left").alias("left_value"), n("n_right").alias("right_value"))


def _on(differs: str, name: str) -> str:
    """The comparison of one field: l and r are the field's two values."""
    return f"transform(array(named_struct('l', l.{name}, 'r', r.{name})), p -> {_prefixed(differs)})[0]"


def _prefixed(differs: str) -> str:
    import re

    return re.sub(r"\b([lr])\b", r"p.\1", differs)
