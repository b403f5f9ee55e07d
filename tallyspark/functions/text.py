"""Column expressions on strings that several operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def squeeze(c: Column) -> Column:
    """White space of any kind collapsed to single spaces, ends trimmed."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def strip_space(c: Column) -> Column:
    """White space of any kind trimmed at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def canonical_uuid(c: Column) -> Column:
    """A UUID in any notation (case, braces, missing hyphens, spaces) as lower case with hyphens; other strings lower and trimmed; blank is null."""
    hexes = F.regexp_replace(F.lower(c), "[^0-9a-f]", "")
    plain = F.lower(strip_space(c))
    parts = [F.substring(hexes, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    looks = plain.rlike(r"^[{(]?(urn:uuid:)?[0-9a-f]{8}-?[0-9a-f]{4}-?[0-9a-f]{4}-?[0-9a-f]{4}-?[0-9a-f]{12}[)}]?$")
    return F.when(looks, F.concat_ws("-", *parts)).when(plain != "", plain)


def money(c: Column) -> Column:
    """An amount as typed ($ , USD, spaces, parentheses for negative) as decimal(20,4); unreadable or blank is null."""
    s = F.regexp_replace(F.upper(c), r"(?U)[\s$,]|USD", "")
    s = F.regexp_replace(s, r"^\((.*)\)$", "-$1")
    return s.try_cast("decimal(20,4)")


def instant_key(c: Column) -> Column:
    """A time as typed, as a key that is equal for equal instants ('T' and microseconds) or, without a time of day, for equal dates ('D' and the date).

    A string that is neither is kept, trimmed, after 'S'; null and blank give null.
    """
    s = strip_space(c)
    is_date = s.rlike(r"^\d{4}-\d{2}-\d{2}$")
    instant = F.try_to_timestamp(F.regexp_replace(s, "^(\\d{4}-\\d{2}-\\d{2}) +", "$1T"))
    return (
        F.when(s == "", None)
        .when(is_date, F.concat(F.lit("D"), s))
        .when(instant.isNotNull(), F.concat(F.lit("T"), F.unix_micros(instant).cast("string")))
        .when(s.isNotNull(), F.concat(F.lit("S"), s))
    )


def written_day(c: Column) -> Column:
    """The calendar day as written at the start of a time string, whatever its offset; null where there is none."""
    return F.regexp_extract(c, r"^(?U)\s*(\d{4}-\d{2}-\d{2})", 1).try_cast("date")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value worked out once however often use mentions it."""
    return F.get(F.transform(F.array(value), lambda v: use(v)), F.lit(0))
