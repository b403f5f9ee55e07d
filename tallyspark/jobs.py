"""What the commands run: loads from the API into a store, audits, checks and exports. Every part is a plan; a job only puts them in order."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyspark import schemas
from tallyspark.functions import canon
from tallyspark.functions.text import canonical_uuid, money
from tallyspark.operators import audit, versioning
from tallyspark.session import cut_lineage
from tallyspark.sources import api
from tallyspark.sources.sinks import Store, write_report
from tallyspark.streaming.ingest import load_batch, sweep_start

#: A period with this part of the expected filings counts as complete.
COMPLETE = 0.95


def fetch(spark: SparkSession, client: str, years: Iterable[int], types: Iterable[str] = api.ORIGINAL, posted_after: str | None = None) -> DataFrame:
    """Filings of the API (columns of schemas.FILING) for years and types, one partition for each of both."""
    spark.dataSource.register(api.FilingsSource)
    options = {"client": client, "years": ",".join(map(str, years)), "types": ",".join(types)} | ({"posted_after": posted_after} if posted_after else {})
    raw = spark.read.format("filings_api").options(**options).load()
    return raw.select(F.from_json("filing", schemas.FILING).alias("f")).select("f.*")


def load(store: Store, raw: DataFrame) -> int:
    """Parse filings and add those that are not stored yet, with their parties and activities; the number of new filings."""
    parsed = cut_lineage(api.parse_filings(raw).dropDuplicates(["sopr_filing_id"]).join(store.read("filings").select("sopr_filing_id"), "sopr_filing_id", "left_anti"))
    for name, side in (("registrants", "registrant"), ("clients", "client")):
        party = parsed.select(F.col(f"{side}_sopr").alias("sopr_id"), F.col(f"{side}_name").alias("name")).groupBy("sopr_id").agg(F.min("name").alias("name"))
        new = party.join(store.read(name).select("sopr_id"), "sopr_id", "left_anti").withColumn("normalized_name", canon.normalized_name(F.col("name")))
        store.append(name, schemas.migrate(api.with_ids(new, store.read(name), ["sopr_id"]), schemas.TABLES[name]))
    known = lambda name, side: store.read(name).where("sopr_id is not null").groupBy(F.col("sopr_id").alias(f"{side}_sopr")).agg(F.min("id").alias(f"{side}_id"))
    rows = parsed.join(known("registrants", "registrant"), "registrant_sopr").join(known("clients", "client"), "client_sopr")
    rows = cut_lineage(api.with_ids(rows, store.read("filings"), ["sopr_filing_id"]))
    load_batch(store, schemas.migrate(rows.withColumn("is_current", F.lit(False)), schemas.FILINGS))
    acts = rows.select(F.col("id").alias("filing_id"), F.posexplode("activities").alias("place", "a")).select("filing_id", "place", "a.*")
    acts = api.with_ids(acts, store.read("activities"), ["filing_id", "place"])
    store.append("activities", schemas.migrate(acts, schemas.ACTIVITIES))
    return rows.count()


def sweep(store: Store, client: str, years: Iterable[int], types: Iterable[str] = api.ORIGINAL, posted_after: str | None = None) -> dict[str, int | str]:
    """Load period by period: the new filings of each year and type, or its error; one that fails does not stop the others."""
    out: dict[str, int | str] = {}
    for year in years:
        for kind in types:
            try:
                out[f"{year} {kind}"] = load(store, fetch(store.spark, client, [year], [kind], posted_after))
            except Exception as e:  # a failed period is reported and tried again by the next sweep
                out[f"{year} {kind}"] = f"failed: {str(e).splitlines()[0][:200]}"
    return out


def latest(store: Store, client: str, today: date) -> dict[str, int | str]:
    """What was posted since the last load, with some overlap, for this year and the last, amendments and terminations included.

    A year's types are fetched at once; only if that fails type by type, so that the others are loaded.
    """
    last = store.read("filings").agg(F.max(F.substring(F.ltrim("filing_date"), 1, 10).try_cast("date"))).first()[0]
    since, types, out = str(sweep_start(last, today)), api.ORIGINAL + api.OTHER, {}
    for year in (today.year - 1, today.year):
        try:
            out[str(year)] = load(store, fetch(store.spark, client, [year], types, since))
        except Exception:  # which of them failed is found out and reported
            out |= sweep(store, client, [year], types, since)
    return out


def recompute_current(store: Store) -> None:
    store.replace("filings", versioning.mark_current(store.read("filings")))


def missing_periods(store: Store, expected: DataFrame, complete: float = COMPLETE) -> DataFrame:
    """Rows (year, quarter, expected, actual) of periods with less than that part of the filings expected (year, quarter, expected)."""
    have = store.read("filings").groupBy("year", "quarter").agg(F.count_distinct("sopr_filing_id").alias("actual"))
    x = expected.join(have, ["year", "quarter"], "left").withColumn("actual", F.coalesce("actual", F.lit(0)))
    return x.where(F.col("actual") < F.col("expected") * complete).select("year", "quarter", "expected", "actual")


def fill_missing(store: Store, client: str, expected: DataFrame, tries: int = 2) -> list[tuple[int, int]]:
    """Load the periods that are not complete, some times over; those that still are not."""
    left = [(r.year, r.quarter) for r in missing_periods(store, expected).collect()]
    for _ in range(tries):
        for year, quarter in left:
            sweep(store, client, [year], [f"Q{quarter}"])
        left = [(r.year, r.quarter) for r in missing_periods(store, expected).collect()]
        if not left:
            break
    return left


def audit_sample(store: Store, client: str, n: int = 100, seed: str = "1") -> DataFrame:
    """n stored filings drawn by a hash beside what the API has for them; one row is added to audit_log and returned.

    A filing that its period's pages do not hold is missing.
    """
    f = store.read("filings").select("id", F.col("sopr_filing_id").alias("key"), "year", "filing_type", "income")
    drawn = cut_lineage(f.orderBy(F.md5(F.concat("key", F.lit(seed))), "id").limit(n))
    stored = drawn.join(store.read("activities").groupBy(F.col("filing_id").alias("id")).agg(F.count(F.lit(1)).alias("n_activities")), "id", "left").withColumn("n_activities", F.coalesce("n_activities", F.lit(0)))
    asked = drawn.select("year", "filing_type").distinct().collect()
    got = fetch(store.spark, client, sorted({r.year for r in asked}), sorted({r.filing_type for r in asked if r.filing_type}))
    live = got.select(canonical_uuid(F.col("filing_uuid")).alias("key"), money(F.col("income")).alias("income"), F.size(F.coalesce("lobbying_activities", F.array().cast(schemas.FILING["lobbying_activities"].dataType))).alias("n_activities"))
    live = drawn.select("key").join(live.dropDuplicates(["key"]).withColumn("status", F.lit("ok")), "key", "left").withColumn("status", F.coalesce("status", F.lit("missing")))
    row = audit.drift_summary(audit.drift(stored, live)).withColumn("ts", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss"))
    row = cut_lineage(schemas.migrate(api.with_ids(row, store.read("audit_log"), ["ts"]), schemas.AUDIT_LOG))
    store.append("audit_log", row)
    return row


def identity_report(spark: SparkSession, filings: DataFrame, clients: DataFrame, path: str, least: float = 1e6, outlier: float = 2.5e7, most: int = 40) -> None:
    """Rename candidates, prefix pairs among the greater clients, and single-quarter outliers, as a Markdown report."""
    from tallyspark.operators.tagging import prefix_pairs

    current = filings.where("is_current").join(clients.select(F.col("id").alias("client_id"), "name"), "client_id")
    income = current.groupBy("name").agg(F.sum(F.coalesce("income", F.lit(0.0))).alias("income"))
    keyed = current.join(canon.client_keys(clients), "client_id")
    large = keyed.groupBy("client_key").agg(F.sum("income").alias("income")).where(F.col("income") >= least)
    side = lambda c: large.select(F.col("client_key").alias(c), F.col("income").alias(f"{c}_income"))
    pairs = prefix_pairs(large.select(F.col("client_key").alias("key"))).join(side("shorter"), "shorter").join(side("longer"), "longer").orderBy(F.desc(F.col("shorter_income") + F.col("longer_income")), "shorter", "longer")
    write_report(path, "Client identities", {
        "Former names that still hold income": audit.rename_candidates(income, least).orderBy(F.desc("former_income"), "former_key"), "Keys that begin with another": pairs, "Greatest quarters": audit.quarter_outliers(keyed, outlier).orderBy(F.desc("income")),
    }, most)


def refresh(steps: list[tuple[str, Callable[[], object]]], only: Iterable[str] = (), skip: Iterable[str] = (), needs: Iterable[str] = ()) -> dict[str, str]:
    """Run named steps in order; the first that fails ends the run. needs: environment variables that must be set before anything runs."""
    if absent := [n for n in needs if not os.environ.get(n)]:
        raise RuntimeError(f"not set: {', '.join(absent)}")
    wanted, out = set(only) or {n for n, _ in steps}, {}
    for name, step in steps:
        if name not in wanted or name in set(skip):
            out[name] = "skipped"
            continue
        try:
            step()
            out[name] = "done"
        except Exception as e:
            out[name] = f"failed: {str(e).splitlines()[0][:200]}"
            break
    return out
