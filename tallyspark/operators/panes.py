"""Late and out-of-order events (problem 6): aggregates per period by stream slicing.

The windows of a period all begin with it and end at its due day or at a later arrival, up to the day it closes. Their
boundaries cut the arrivals into panes that do not overlap: one up to the due day, one for each later day. A pane holds
one partial aggregate; a late event changes one pane, and the windows that cover it are composed again from the panes.
A period has no more panes than days between due_day and closes_on, and one for what came after it closed, whatever its
number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyspark.functions.text import written_day

PANE = ["year", "quarter", "pane_day"]


def with_panes(filings: DataFrame, periods: DataFrame) -> DataFrame:
    """Rows (year, quarter, key, id, income, posted_day, pane_day, late) of the filings of known periods.

    posted_day is the calendar day as written in filing_date; a null or unreadable one is in no pane and not late.
    pane_day is due_day for what came up to it, else the day of arrival up to closes_on; what came later is late and lies in
    the pane of the day after, which no window covers. filings: id, sopr_filing_id, year, quarter, income, filing_date.
    periods: year, quarter, due_day, closes_on.
    """
    f = filings.select("year", "quarter", F.col("sopr_filing_id").alias("key"), "id", "income", written_day(F.col("filing_date")).alias("posted_day"))
    p = periods.select("year", "quarter", "due_day", "closes_on").dropDuplicates(["year", "quarter"])
    day = F.col("posted_day")
    pane = F.when(day <= F.col("due_day"), F.col("due_day")).when(day <= F.col("closes_on"), day).when(day > F.col("closes_on"), F.date_add("closes_on", 1))
    return f.join(p, ["year", "quarter"]).select(*f.columns, pane.alias("pane_day"), F.coalesce(day > F.col("closes_on"), F.lit(False)).alias("late"))


def row_key(key: Column, row_id: Column) -> Column:
    """The key of a filing; rows with a null key count one by one."""
    return F.coalesce(key, F.concat(F.lit("#"), row_id.cast("string")))


def arrival() -> Column:
    """What the first arrival of a key is the least of."""
    return F.struct("posted_day", "id", "year", "quarter", "pane_day", F.col("income").cast("decimal(20,2)").alias("income"))


def pane_partials(paned: DataFrame) -> DataFrame:
    """One partial aggregate per pane: n, income (decimal). A filing stored more than once counts on its first arrival; rows with a null key count one by one.

    What came too late is in the panes after the last windows, by the same rule among itself.
    """
    rows = paned.where("pane_day is not null").select(row_key(F.col("key"), F.col("id")).alias("key"), "late", arrival().alias("x"))
    first = rows.groupBy("key", "late").agg(F.min("x").alias("x")).select("x.*")
    return first.groupBy(*PANE).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("income").cast("decimal(24,2)"), F.lit(0).cast("decimal(24,2)")).alias("income"))


def late_events(paned: DataFrame, panes: DataFrame, windows: DataFrame) -> DataFrame:
    """The distinct keys of events whose pane no window covers: the last window of a period ends on the day it closes.

    panes: from pane_partials, no more than one a day for each period. windows: from compose_windows.
    """
    ends = windows.groupBy("year", "quarter").agg(F.max("closes_on").alias("end"))
    beyond = panes.join(ends, ["year", "quarter"]).where("pane_day > end").select(*PANE)
    return paned.where("key is not null").join(beyond, PANE, "left_semi").select("key").distinct()


def merge_partials(*partials: DataFrame) -> DataFrame:
    """Partials of the same panes added up: the state after further arrivals."""
    every = partials[0]
    for p in partials[1:]:
        every = every.unionByName(p)
    return every.groupBy(*PANE).agg(F.sum("n").alias("n"), F.sum("income").cast("decimal(24,2)").alias("income"))


def compose_windows(partials: DataFrame, periods: DataFrame) -> DataFrame:
    """The windows from the panes: year, quarter, known_on, revision (0: as first known on due_day), n_filings, income, closes_on.

    A period without any arrival by its due day starts with 0 filings.
    """
    zero = periods.select("year", "quarter", F.col("due_day").alias("pane_day"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("decimal(24,2)").alias("income"))
    p = periods.select("year", "quarter", "closes_on").dropDuplicates(["year", "quarter"])
    w = Window.partitionBy("year", "quarter").orderBy("pane_day")
    panes = merge_partials(partials, zero).join(p, ["year", "quarter"]).where("pane_day <= closes_on")
    return panes.select(
        "year", "quarter", F.col("pane_day").alias("known_on"), (F.row_number().over(w) - 1).alias("revision"),
        F.sum("n").over(w).alias("n_filings"), F.sum("income").over(w).cast("double").alias("income"), "closes_on",
    )
