"""The panes of operators.panes kept by a Structured Streaming query."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyspark.operators.panes import compose_windows, merge_partials, row_key, with_panes
from tallyspark.sources import files

_ARRIVAL = "posted_day date, id long, year int, quarter int, pane_day date, income decimal(20,2)"
_STATE = f"open struct<{', '.join(x.strip().replace(' ', ':', 1) for x in _ARRIVAL.replace('(20,2)', '(20;2)').split(','))}>".replace(";", ",")
_CHANGE = "key string, year int, quarter int, pane_day date, posted_day date, n int, income decimal(20,2), late boolean"


def _rank(x: tuple) -> tuple:
    """Order of arrivals as that of Spark's structs: by column, null first."""
    return tuple((v is not None, v if v is not None else 0) for v in x)


def _tuples(f: pd.DataFrame) -> Iterator[tuple]:
    for row in f.astype(object).where(f.notna(), None).itertuples(index=False):
        yield row.late, row.key, (row.posted_day, None if row.id is None else int(row.id), int(row.year), int(row.quarter), row.pane_day, row.income)


def _signed(_: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    """Of one key: if an earlier arrival than the one that counts has come, its pane gets one more and the other's one less. Late rows are passed on."""
    best = tuple(state.get[0]) if state.exists else None
    before, out = best, []
    for f in frames:
        for late, key, x in _tuples(f):
            if late:
                out.append((key, x[2], x[3], x[4], x[0], 0, Decimal("0.00"), True))
            elif best is None or _rank(x) < _rank(best):
                best = x
    if best is not None and (before is None or _rank(best) < _rank(before)):
        for x, n in ((before, -1), (best, 1)):
            if x is not None:
                out.append((None, x[2], x[3], x[4], x[0], n, n * (x[5] if x[5] is not None else Decimal("0.00")), False))
        state.update((best,))
    yield pd.DataFrame(out, columns=["key", "year", "quarter", "pane_day", "posted_day", "n", "income", "late"])


def _finished(df: DataFrame, folder: str) -> list[int]:
    spark = df.sparkSession
    return sorted(int(n[2:]) for n in files.names(spark, folder) if n[:2] == "v=" and n[2:].isdigit() and files.exists(spark, f"{folder}/{n}/_SUCCESS"))


def revise_periods(stream: DataFrame, periods: DataFrame, folder: str, **options: str) -> StreamingQuery:
    """Keep per-period aggregates of a stream of filings; returns the started query (processes what is available, then ends).

    The same as pane_partials over all rows delivered, in whatever order and however often. folder (shared by all executors)
    gets panes/v=N, the partials after batch N; revisions/v=N, the windows from the first pane that batch N changed on, in
    place of those known before; late/v=N, what came after its period had closed. The state has one arrival per key. Batches
    are written by number, so one that is run again after a failure replaces itself.
    """

    def batch(changes: DataFrame, n: int) -> None:
        changes = changes.persist()
        spark = changes.sparkSession
        change = changes.where("not late").groupBy("year", "quarter", "pane_day").agg(F.sum("n").alias("n"), F.sum("income").cast("decimal(24,2)").alias("income"))
        before = [v for v in _finished(changes, f"{folder}/panes") if v < n]
        state = merge_partials(change, spark.read.parquet(f"{folder}/panes/v={before[-1]}")) if before else change
        state.where("n > 0").write.mode("overwrite").parquet(f"{folder}/panes/v={n}")
        state = spark.read.parquet(f"{folder}/panes/v={n}")
        first = change.groupBy("year", "quarter").agg(F.min("pane_day").alias("changed_from"))
        windows = compose_windows(state.join(first, ["year", "quarter"], "left_semi"), periods.join(first, ["year", "quarter"], "left_semi"))
        again = windows.join(first, ["year", "quarter"]).where("known_on >= changed_from").drop("changed_from")
        again.write.mode("overwrite").parquet(f"{folder}/revisions/v={n}")
        changes.where("late").select("key", "year", "quarter", "posted_day").write.mode("overwrite").parquet(f"{folder}/late/v={n}")
        changes.unpersist()

    paned = with_panes(stream, periods).where("pane_day is not null")
    rows = paned.select(row_key(F.col("key"), F.col("id")).alias("by"), "key", "late", "posted_day", "id", "year", "quarter", "pane_day", F.col("income").cast("decimal(20,2)").alias("income"))
    changes = rows.groupBy("by").applyInPandasWithState(_signed, _CHANGE, _STATE, "update", "NoTimeout")
    w = changes.writeStream.foreachBatch(batch).outputMode("update").option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True)
    for k, v in options.items():
        w = w.option(k, v)
    return w.start()
