import random
from datetime import date

import pytest

from tallyspark.operators.panes import compose_windows, late_events, pane_partials, with_panes
from tallyspark.streaming.late import revise_periods

PERIODS = [(2020, 1, date(2020, 4, 20), date(2020, 6, 30), "clash"), (2020, 2, date(2020, 7, 20), date(2020, 9, 30), None)]
FILINGS = [
    (1, "a", 2020, 1, 10.0, "2020-04-10T09:00:00-04:00"), (2, "b", 2020, 1, None, " 2020-04-20T23:59:00-04:00"), (3, "c", 2020, 1, 5.5, "2020-05-01"), (4, "d", 2020, 1, 7.0, "2020-07-01T00:10:00Z"),
    (5, "c", 2020, 1, 5.5, "2020-05-02T00:00:00Z"), (6, "e", 2020, 1, 1.0, None), (7, None, 2020, 1, 2.0, "2020-05-01 10:00:00Z"), (8, "f", 1999, 1, 2.0, "2020-05-01"), (9, "g", None, None, 2.0, "2020-05-01"), (10, "h", 2020, 1, 1.0, "soon"),
]
WANT = [(2020, 1, "2020-04-20", 0, 2, 10.0), (2020, 1, "2020-05-01", 1, 4, 17.5), (2020, 2, "2020-07-20", 0, 0, 0.0)]


def frames(spark, filings=FILINGS):
    return spark.createDataFrame(filings, "id long, sopr_filing_id string, year int, quarter int, income double, filing_date string"), spark.createDataFrame(PERIODS, "year int, quarter int, due_day date, closes_on date, income string")


def rows(df):
    return sorted((r.year, r.quarter, str(r.known_on), r.revision, r.n_filings, r.income) for r in df.collect())


def test_revisions_and_late(spark):
    f, p = frames(spark)
    paned = with_panes(f, p)
    assert rows(compose_windows(pane_partials(paned), p)) == WANT
    late = lambda paned, p: sorted(r.key for r in late_events(paned, pane_partials(paned), compose_windows(pane_partials(paned), p)).collect())
    assert late(paned, p) == ["d"]
    # a filing that came in time and again too late is listed and counts; a period without any filing in time has late ones
    again, p = frames(spark, [*FILINGS, (20, "c", 2020, 1, 1.0, "2020-08-01"), (21, "q", 2020, 2, 1.0, "2021-08-01"), (21, "q", 2020, 2, 1.0, "2021-08-01")])
    assert late(with_panes(again, p), p) == ["c", "d", "q"] and rows(compose_windows(pane_partials(with_panes(again, p)), p)) == WANT
    f, p = frames(spark, [])
    assert rows(compose_windows(pane_partials(with_panes(f, p)), p)) == [(2020, 1, "2020-04-20", 0, 0, 0.0), (2020, 2, "2020-07-20", 0, 0, 0.0)]
    assert late(with_panes(f, p.limit(0)), p.limit(0)) == []


def folders(path):
    return sorted(path.iterdir(), key=lambda x: int(x.name[2:]))


@pytest.mark.parametrize("seed", [1, 2])
def test_stream_gives_the_same_as_the_batch(spark, tmp_path, seed):
    """Over deliveries in any order, with null keys and repeats; the folder is written as a URI."""
    r = random.Random(seed)
    days = ["2020-04-10", "2020-04-20T01:00:00Z", "2020-05-01", "2020-05-02", "2020-06-30", "2020-07-01", "2020-08-30", None]
    data = [(i, r.choice(["a", "b", "c", "d", "e", None, f"k{i}"]), 2020, r.choice([1, 1, 2]), r.choice([1.0, 2.5, None]), r.choice(days)) for i in range(40)]
    sent = data + r.sample(data, 10)
    r.shuffle(sent)
    folder = "file://" + str(tmp_path / "state")
    for n in range(0, len(sent), 17):
        f, p = frames(spark, sent[n : n + 17])
        f.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        revise_periods(spark.readStream.schema(f.schema).parquet(str(tmp_path / "in")), p, folder).awaitTermination()
    f, p = frames(spark, data)
    paned = with_panes(f, p)
    panes = spark.read.parquet(str(folders(tmp_path / "state/panes")[-1]))
    assert rows(compose_windows(panes, p)) == rows(compose_windows(pane_partials(paned), p))
    # what was re-emitted, each later one in place of the earlier from its first pane on, is the same
    known = {}
    for v in folders(tmp_path / "state/revisions"):
        new = rows(spark.read.parquet(str(v)))
        for period in {x[:2] for x in new}:
            since = min(x[2] for x in new if x[:2] == period)
            known = {k: x for k, x in known.items() if k[:2] != period or k[2] < since}
        known |= {x[:3]: x for x in new}
    assert [x for x in rows(compose_windows(pane_partials(paned), p)) if x[4]] == sorted(x for x in known.values() if x[4])
    late = {x.key for v in folders(tmp_path / "state/late") for x in spark.read.parquet(str(v)).collect()} - {None}
    assert late == {x.key for x in late_events(paned, pane_partials(paned), compose_windows(pane_partials(paned), p)).collect()}
