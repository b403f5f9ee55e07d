"""The star of facts and its mentions: one row per tag named by an activity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyspark.functions.canon import client_keys
from tallyspark.functions.periods import q_index
from tallyspark.functions.text import squeeze
from tallyspark.sources.tables import table

#: The chambers, which are no agencies, in upper case.
CHAMBERS = ("HOUSE OF REPRESENTATIVES", "U.S. HOUSE OF REPRESENTATIVES", "SENATE", "U.S. SENATE", "CONGRESS", "U.S. CONGRESS")


def star(spark: SparkSession, d: str, current_only: bool = True, filings: DataFrame | None = None, excluded: bool = False) -> DataFrame:
    """Tagged activities with their filing, client and registrant; inner joins, the small sides planned by their size.

    filings: those that count (id, registrant_id, client_id, year, quarter, income, filing_date, and any others), if not all
    or all current ones. client_key is the client in whatever spelling; excluded ones are left out unless asked for.
    """
    if filings is None:
        filings = table(spark, d, "filings", "id", "registrant_id", "client_id", "year", "quarter", "income", "filing_date", "is_current")
        filings = filings.where("is_current") if current_only else filings
    filings = filings.withColumnRenamed("id", "filing_id").withColumn("income", F.coalesce("income", F.lit(0.0)))
    rules = table(spark, d, "activity_extractions_rules", "activity_id", "topics", "entities", "legislation")
    acts = table(spark, d, "activities", F.col("id").alias("activity_id"), "filing_id", "issue_code")
    clients = keyed_clients(spark, d, excluded)
    registrants = table(spark, d, "registrants", F.col("id").alias("registrant_id"), F.col("name").alias("registrant_name"))
    return rules.join(acts, "activity_id").join(filings, "filing_id").join(clients, "client_id").join(registrants, "registrant_id").withColumn("q", q_index())


def keyed_clients(spark: SparkSession, d: str, excluded: bool = False) -> DataFrame:
    """Rows (client_id, client_name, client_key) of the clients."""
    c = table(spark, d, "clients", "id", "name")
    keys = client_keys(c)
    keys = keys if excluded else keys.where("not excluded")
    return c.select(F.col("id").alias("client_id"), F.col("name").alias("client_name")).join(keys.select("client_id", "client_key"), "client_id")


def tags_of(kind: str) -> Column:
    """The tags of a kind of an activity: topics without general ones, entities without the chambers (repeats count), legislation each once."""
    tidy = F.filter(F.transform(F.coalesce(F.col(kind), F.array().cast("array<string>")), squeeze), lambda x: x != "")
    if kind == "topics":
        return F.filter(tidy, lambda x: ~x.startswith("general_"))
    if kind == "entities":
        return F.filter(tidy, lambda x: ~F.upper(x).isin(*CHAMBERS))
    return F.array_distinct(tidy)


def mentions(facts: DataFrame, kinds: tuple[str, ...] = ("topics", "entities", "legislation")) -> DataFrame:
    """facts exploded to one row per mention: kind, tag. One pass: the kinds are one array of structs."""
    def named(kind: str) -> Column:
        return F.transform(tags_of(kind), lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("tag")))

    every = F.concat(*map(named, kinds))
    return facts.withColumn("m", F.explode(every)).select("*", "m.kind", "m.tag").drop("m", *kinds)
