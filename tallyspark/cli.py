"""python -m tallyspark.cli COMMAND ...: thin commands over the operators and jobs.

  query NAME DIR [--out PATH]       a registered query over a folder of tables, shown or written as Parquet
  queries                           names of the registered queries
  ingest STORE CLIENT YEARS [--types T,..]   load years (2023,2024 or 2020-2024) from the API client module:function
  backfill STORE CLIENT YEARS       the same for amendments and terminations
  latest STORE CLIENT               what was posted since the last load
  recompute STORE                   is_current worked out anew
  fill STORE CLIENT EXPECTED        periods with less than 95 % of the expected filings (CSV year,quarter,expected), loaded
  coverage STORE EXPECTED           those periods, shown
  audit STORE CLIENT [--n N]        stored filings beside live ones
  snapshot STORE TO                 a copy of the current tables
  extract DIR RULES OUT             extraction rows of activities that have none
  mine DIR OUT                      candidate terms
  gaps DIR                          terms and texts of the issue codes that the tags cover least
  dictionary DIR OUT [--rounds N]   phrases grown from mined terms until the texts are covered
  identities DIR OUT                report on names that may be one client
  export DIR OUT                    stats, trends, alerts, movers and checks as JSON documents
  refresh DIR OUT [--only S,..] [--skip S,..]   mine, identities, export, in this order
"""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import SparkSession, functions as F

from tallyspark import jobs
from tallyspark.operators import tagging
from tallyspark.plans import q_measures, q_text, q_trends, registry
from tallyspark.session import build_session
from tallyspark.sources import api
from tallyspark.sources.sinks import Store, write_document
from tallyspark.sources.tables import table


def export(spark: SparkSession, d: str, out: str) -> None:
    """The documents of a dashboard."""
    documents = {
        "stats": {"last_quarters": q_measures.last_quarters, "frame_totals": q_trends.frame_totals, "busiest": q_measures.busiest_quarters},
        "trends": {"topics": q_trends.trend_topics, "entities": q_trends.trend_entities, "legislation": q_trends.trend_legislation},
        "alerts": {"alerts": q_trends.trend_alerts}, "recent": {"filings": q_measures.recent_filings}, "timeseries": {"tags": q_trends.tag_series}, "clients": {"movers": q_trends.client_movers}, "checks": {"status": q_trends.data_status, "flags": q_trends.data_checks, "gaps": q_trends.data_gaps},
    }
    for name, parts in documents.items():
        write_document(f"{out}/{name}.json", {k: f(spark, d) for k, f in parts.items()})


def years_of(text: str) -> list[int]:
    """2020-2022,2025 as years."""
    ends = [list(map(int, part.split("-"))) for part in text.split(",")]
    return [y for e in ends for y in range(e[0], e[-1] + 1)]


def mine(spark: SparkSession, d: str, out: str) -> None:
    docs = table(spark, d, "activities", "id", F.upper(F.trim("issue_code")).alias("code"), F.col("description").alias("text"))
    tagging.mine_candidates(docs).write.mode("overwrite").parquet(out)


def dictionary(spark: SparkSession, d: str, out: str, rounds: int) -> list[float]:
    """Mined terms as proposals, each for the code it is typical of."""
    docs = table(spark, d, "activities", "id", F.col("description").alias("text"), F.upper(F.trim("issue_code")).alias("code")).where("text is not null")
    terms = [(r.term, r.code) for r in tagging.mine_candidates(docs).where("rank <= 5").select("term", "code").collect()]  # five for each code
    phrases, history = tagging.dictionary_loop(docs.select("id", "text"), terms[:50], lambda _: terms, rounds=rounds)
    write_document(out, {"phrases": [list(p) for p in phrases], "coverage": history})
    return history


def identities(spark: SparkSession, d: str, out: str) -> None:
    jobs.identity_report(spark, table(spark, d, "filings"), table(spark, d, "clients"), out)


COMMANDS = {
    "query": "name dir", "queries": "", "ingest": "store client years", "backfill": "store client years", "latest": "store client", "recompute": "store", "fill": "store client expected", "coverage": "store expected", "audit": "store client",
    "snapshot": "store to", "extract": "dir rules out", "mine": "dir out", "gaps": "dir", "dictionary": "dir out", "identities": "dir out", "export": "dir out", "refresh": "dir out",
}


def main(args: list[str] | None = None) -> object:
    p = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = p.add_subparsers(dest="command", required=True)
    for name, words in COMMANDS.items():
        s = sub.add_parser(name)
        for w in words.split():
            s.add_argument(w)
        for option, default in {"query": {"--out": None}, "ingest": {"--types": ",".join(api.ORIGINAL)}, "audit": {"--n": 100}, "dictionary": {"--rounds": 5}, "refresh": {"--only": "", "--skip": ""}}.get(name, {}).items():
            s.add_argument(option, default=default, type=type(default) if default is not None else str)
    a = p.parse_args(args)
    if a.command == "queries":
        print("\n".join(registry.queries()))
        return None
    spark = build_session()
    store = Store(spark, a.store) if "store" in a else None
    expected = lambda: spark.read.option("header", True).schema("year int, quarter int, expected long").csv(a.expected)
    listed = lambda text: [x for x in text.split(",") if x]

    def query() -> None:
        df = registry.queries()[a.name](spark, a.dir)
        df.write.mode("overwrite").parquet(a.out) if a.out else df.show(50, False)

    def extract() -> None:
        acts = table(spark, a.dir, "activities")
        tagging.extract(acts, table(spark, a.dir, "activity_extractions_rules", "activity_id"), tagging.load_rules(a.rules), "rules-1").write.mode("overwrite").parquet(a.out)

    run = {
        "query": query, "extract": extract, "gaps": lambda: q_text.gap_report(spark, a.dir).show(50, False), "ingest": lambda: jobs.sweep(store, a.client, years_of(a.years), listed(a.types)), "backfill": lambda: jobs.sweep(store, a.client, years_of(a.years), api.OTHER),
        "latest": lambda: jobs.latest(store, a.client, date.today()), "recompute": lambda: jobs.recompute_current(store), "fill": lambda: jobs.fill_missing(store, a.client, expected()), "coverage": lambda: jobs.missing_periods(store, expected()).show(200),
        "audit": lambda: jobs.audit_sample(store, a.client, a.n).show(), "snapshot": lambda: store.snapshot(a.to), "mine": lambda: mine(spark, a.dir, a.out), "dictionary": lambda: dictionary(spark, a.dir, a.out, a.rounds),
        "identities": lambda: identities(spark, a.dir, a.out), "export": lambda: export(spark, a.dir, a.out),
        "refresh": lambda: jobs.refresh([("mine", lambda: mine(spark, a.dir, f"{a.out}/terms")), ("identities", lambda: identities(spark, a.dir, f"{a.out}/identities.md")), ("export", lambda: export(spark, a.dir, a.out))], listed(a.only), listed(a.skip)),
    }
    out = run[a.command]()
    if out is not None:
        print(out)
    return out


if __name__ == "__main__":
    main()
