"""Incremental loading with Structured Streaming: overlapping sweeps are free, amendments of any age supersede."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyspark.operators.versioning import GROUP, mark_current, only_new
from tallyspark.session import cut_lineage
from tallyspark.sources.sinks import Store


def sweep_start(last_posted: date | None, today: date, overlap: int = 7, slack: int = 3, most: int = 120) -> date:
    """Where the next sweep begins: some days back, further to the last stored posting less some slack, but not beyond a limit."""
    start = today - timedelta(days=overlap)
    if last_posted:
        start = min(start, last_posted - timedelta(days=slack))
    return max(start, today - timedelta(days=most))


def load_batch(store: Store, rows: DataFrame) -> DataFrame:
    """Filings (schemas.FILINGS) that are not stored yet, added, with is_current worked out anew for the groups they touch; returns the touched periods.

    Late rows are never dropped: an amendment that comes years later supersedes what it amends. Only the partitions of the
    touched periods are read and written, besides the stored keys.
    """
    new = cut_lineage(only_new(rows, store.read("filings"), ["sopr_filing_id"]))
    touched = new.select(*GROUP).distinct()
    values = store.partition_values("filings", new)
    if not values:
        return touched.select("year", "quarter").distinct()
    old = store.of_partitions("filings", values)
    on = F.lit(True)
    for c in GROUP:
        on = on & F.col(f"a.{c}").eqNullSafe(F.col(f"t.{c}"))
    kept = old.alias("a").join(touched.alias("t"), on, "left_anti")
    again = mark_current(old.alias("a").join(touched.alias("t"), on, "left_semi").unionByName(new.select(*old.columns)))
    store.replace_partitions("filings", kept.unionByName(again.select(*old.columns)), values)
    return touched.select("year", "quarter").distinct()


def stream_filings(stream: DataFrame, store: Store, checkpoint: str) -> StreamingQuery:
    """Keep the store's filings current from a stream of filings; processes what is available, then ends. Rows delivered again change nothing."""

    def batch(rows: DataFrame, _: int) -> None:
        rows = rows.persist()
        load_batch(store, rows)
        rows.unpersist()

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
