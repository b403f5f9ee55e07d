"""Report periods as column expressions: a quarter's index is year * 4 + quarter."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def q_index(year: Column | str = "year", quarter: Column | str = "quarter") -> Column:
    y, q = (F.col(c) if isinstance(c, str) else c for c in (year, quarter))
    return y * 4 + q


def year_of(q: Column) -> Column:
    return F.floor((q - 1) / 4).cast("int")


def quarter_of(q: Column) -> Column:
    return (F.pmod(q - 1, F.lit(4)) + 1).cast("int")


def quarter_end(q: Column) -> Column:
    """The last day of a quarter."""
    return F.last_day(F.make_date(year_of(q), quarter_of(q) * 3, F.lit(1)))


def label(q: Column) -> Column:
    return F.concat(year_of(q).cast("string"), F.lit(" Q"), quarter_of(q).cast("string"))


def parse_period(c: Column) -> Column:
    """1 to 4 from a period as typed ('1st Quarter (Jan 1 - Mar 31)', 'second_quarter', 'Q3'); null for others."""
    s = F.lower(F.trim(c))
    out = None
    for n, words in enumerate((("1st", "first"), ("2nd", "second"), ("3rd", "third"), ("4th", "fourth")), 1):
        hit = s.contains(words[0]) | s.contains(words[1]) | (s == f"q{n}")
        out = F.when(hit, n) if out is None else out.when(hit, n)
    return out


def congress(year: Column) -> Column:
    """The Congress that sits in a year: the first convened in 1789, each lasts two years."""
    return (F.floor((year - 1789) / 2) + 1).cast("int")


def ordinal(n: Column) -> Column:
    tail = F.when(F.pmod(n, F.lit(100)).between(10, 20), "th").when(n % 10 == 1, "st").when(n % 10 == 2, "nd").when(n % 10 == 3, "rd").otherwise("th")
    return F.concat(n.cast("string"), tail)
