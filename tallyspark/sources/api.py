"""Filings from a paged API, and their parsing into tables."""

from __future__ import annotations

import importlib
import json
import time
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tallyspark import schemas
from tallyspark.functions.periods import parse_period
from tallyspark.functions.text import canonical_uuid, money, squeeze

# Kinds of reports.
ORIGINAL = tuple(f"Q{q}" for q in range(1, 5))
OTHER = tuple(f"{q}{s}" for q in range(1, 5) for s in ("A", "AY", "T", "TY", "@", "@Y"))
REGISTRATIONS = ("RR", "RA")
CHAMBERS = ("SENATE", "HOUSE OF REPRESENTATIVES")


class TooManyRequests(Exception):
    """A client raises it when the service asks to wait."""


class FilingsSource(DataSource):
    """spark.read.format("filings_api").option("client", "module:function").option("years", "2023,2024").option("types", "Q1,Q2").load()

    client(year, filing_type, page, posted_after) returns {"results": [filing, ...], "next": anything true if there is a
    further page}; it runs on the executors, one partition per (year, type). A page is asked again, with doubling pauses,
    up to five times while the client raises TooManyRequests. Rows are (year, filing_type, filing: JSON string).
    """

    @classmethod
    def name(cls) -> str:
        return "filings_api"

    def schema(self) -> str:
        return "year int, filing_type string, filing string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))


class _Part(InputPartition):
    def __init__(self, year: int, kind: str):
        super().__init__((year, kind))
        self.year, self.kind = year, kind


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = options

    def partitions(self) -> list[InputPartition]:
        return [_Part(int(y), t) for y in self.options["years"].split(",") for t in self.options.get("types", ",".join(ORIGINAL)).split(",")]

    def read(self, part: _Part) -> Iterator[tuple]:
        module, _, name = self.options["client"].partition(":")
        client = getattr(importlib.import_module(module), name)
        page, pause = 1, float(self.options.get("pause", "5"))
        while True:
            for attempt in range(5):
                try:
                    got = client(part.year, part.kind, page, self.options.get("posted_after"))
                    break
                except TooManyRequests:
                    if attempt == 4:
                        raise
                    time.sleep(pause * 2**attempt)
            for f in got.get("results") or []:
                yield part.year, part.kind, json.dumps(f)
            if not got.get("results") or not got.get("next"):
                return
            page += 1


def parse_filings(raw: DataFrame) -> DataFrame:
    """API filings (columns of schemas.FILING) flat, with their activities as an array.

    Amount: income, else expenses, else 0 (0 counts as not given). Registrations, and rows without uuid, period, registrant
    or client, are left out.
    """
    amount = F.coalesce(F.nullif(money(F.col("income")), F.lit(0)), F.nullif(money(F.col("expenses")), F.lit(0)), F.lit(0)).cast("double")
    text = lambda a: F.coalesce(F.nullif(F.trim(a["description"]), F.lit("")), F.trim(a["specific_issues"]))
    names = lambda a: F.transform(F.coalesce(a["government_entities"], F.array().cast("array<struct<name:string>>")), lambda e: F.trim(e["name"]))
    chamber = lambda n: F.upper(n).isin(*CHAMBERS)
    acts = F.transform(F.coalesce("lobbying_activities", F.array().cast(schemas.FILING["lobbying_activities"].dataType)), lambda a: F.struct(
        text(a).alias("description"), a["general_issue_code"].alias("issue_code"), F.array_join(F.filter(names(a), chamber), ",").alias("houses_lobbied"), F.array_join(F.filter(names(a), lambda n: ~chamber(n)), ",").alias("agencies"),
    ))
    kept = F.filter(acts, lambda a: F.coalesce(a["description"], F.lit("")) != "")
    x = raw.select(
        canonical_uuid(F.col("filing_uuid")).alias("sopr_filing_id"), F.col("filing_year").alias("year"), parse_period(F.col("filing_period")).alias("quarter"), amount.alias("income"), F.coalesce("filing_date", "dt_posted").alias("filing_date"),
        "filing_type", F.col("registrant.id").alias("registrant_sopr"), squeeze(F.col("registrant.name")).alias("registrant_name"), F.col("client.id").alias("client_sopr"), squeeze(F.col("client.name")).alias("client_name"), kept.alias("activities"),
    )
    given = [F.col(c).isNotNull() & (F.col(c).cast("string") != "") for c in ("sopr_filing_id", "year", "quarter", "registrant_sopr", "registrant_name", "client_sopr", "client_name")]
    out = x.where(~F.coalesce("filing_type", F.lit("")).isin(*REGISTRATIONS))
    for g in given:
        out = out.where(g)
    return out


def with_ids(new: DataFrame, stored: DataFrame, order: list[str], id_col: str = "id") -> DataFrame:
    """new rows with ids that go on after the largest stored one, in the given order (numbers of partitions, then of rows)."""
    top = stored.agg(F.coalesce(F.max(id_col), F.lit(0)).cast("long").alias("_top"))
    spread = new.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_p", F.spark_partition_id()).withColumn("_m", F.monotonically_increasing_id())
    sizes = spread.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"), F.min("_m").alias("_first"))
    starts = sizes.withColumn("_start", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))  # one row per partition
    x = spread.join(F.broadcast(starts.drop("_n")), "_p").crossJoin(F.broadcast(top))
    return x.withColumn(id_col, F.col("_top") + F.col("_start") + F.col("_m") - F.col("_first") + 1).drop("_p", "_m", "_first", "_start", "_top")


def read_index(spark, path: str) -> DataFrame:
    """A monthly price index from CSV (date, value): '.' and blank are missing; rows (month, value)."""
    raw = spark.read.option("header", True).schema("date string, value string").csv(path)
    return raw.select(F.trunc(F.col("date").try_cast("date"), "month").alias("month"), F.nullif(F.trim("value"), F.lit(".")).try_cast("double").alias("value")).where("month is not null and value is not null")
