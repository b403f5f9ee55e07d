from datetime import date

from tallyspark.functions import periods
from tallyspark.operators import measures as m, search as se, signals as sg, trends as tr
from pyspark.sql import functions as F


def test_income_counts_once_per_filing(spark):
    rows = [("topics", "a", 1, 10.0, "k"), ("topics", "a", 1, 10.0, "k"), ("topics", "a", 2, 5.0, "k"), ("topics", "b", 2, 5.0, None)]
    out = {r.tag: (r.mentions, r.filings, r.clients, r.income) for r in m.count_mentions(spark.createDataFrame(rows, "kind string, tag string, filing_id long, income double, client_key string")).collect()}
    assert out == {"a": (3, 2, 1, 15.0), "b": (1, 1, 0, 5.0)}


def test_nearest_rank_mode_and_share(spark):
    x = spark.createDataFrame([([1, 2, 3, 4],), ([7],), ([],)], "v array<int>").select(m.nearest_rank(F.col("v"), 0.5).alias("r")).collect()
    assert [r.r for r in x] == [3, 7, None]  # (4 - 1) * 0.5 = 1.5 goes to the even rank 2
    names = spark.createDataFrame([("k", "long name"), ("k", "b"), ("k", "a"), ("k", None)], "k string, v string")
    assert m.most_frequent(names, "k", "v").first().v == "a"
    assert m.with_share(names.groupBy("k").count(), 0, "count").first().share == 0.0


def test_allocated_income_of_an_activity_with_two_labels(spark):
    labels = spark.createDataFrame([(1, "x"), (1, "y"), (2, "x")], "activity_id long, label string")
    acts = spark.createDataFrame([(1, 9), (2, 9)], "activity_id long, filing_id long")
    out = {r.label: r.income for r in m.allocated_income(labels, acts, spark.createDataFrame([(9, 2020, 1, 100.0)], "filing_id long, year int, quarter int, income double")).collect()}
    assert out == {"x": 100.0, "y": 50.0}


def test_signals(spark):
    s = spark.createDataFrame([("a", q, float(v) * 1e6) for q, v in enumerate((1, 2, 1, 1, 1, 5), 8080)] + [("b", 8080, 1.0)], "e string, q int, value double")
    r = sg.records(s, "e").first()
    assert (r.entity, r.current_value, r.prior_value, round(r.historical_pct, 4)) == ("a", 5e6, 2e6, round(5 / 6, 4))
    assert sg.spikes(s, "e").first().growth_rate == 1.5  # against the quarter a year before
    spend = spark.createDataFrame([("g", p, 8085, 1.0) for p in "xyz"] + [("g", "o", 8080, 1.0), ("g", "o", 8085, 1.0)], "g string, p string, q int, value double")
    assert sorted(r.p for r in sg.entrants(spend, "g", "p").collect()) == ["x", "y", "z"] and sg.coordinated(spend, "g", "p").first().n == 3
    assert sg.records(s.limit(0), "e").count() == 0


def test_frames():
    assert tr.last_complete(date(2026, 8, 9)) == 2026 * 4 + 1 and tr.last_complete(date(2026, 8, 10)) == 2026 * 4 + 2
    quarter, to_date = tr.frames(date(2026, 8, 23))
    assert (quarter.current.year, quarter.current.quarter, quarter.baseline.year) == (2026, 2, 2025)
    assert (to_date.current.quarter, to_date.current.through, to_date.baseline.through) == (3, "2026-08-22", "2025-08-22")


def test_frames_end_with_the_reports():
    quarter, to_date = tr.frames(date(2027, 6, 15), 2025 * 4 + 4)  # one posting came much later than all
    assert (quarter.current.q, to_date.current.q, to_date.baseline.q) == (2025 * 4 + 4, 2025 * 4 + 4, 2024 * 4 + 4)
    assert tr.frames(date(2026, 8, 23), 2026 * 4 + 3) == tr.frames(date(2026, 8, 23))


def test_changes_keep_the_asymmetry(spark):
    counts = spark.createDataFrame([("t", "a", 60, 50), ("t", "new", 30, 0), ("t", "gone", 0, 40), ("u", "a", 5, 5)], "kind string, tag string, count long, baseline_count long")
    totals = spark.createDataFrame([(1000, 1000)], "now long, before long")
    x = {(r.kind, r.tag): r for r in tr.changes(counts, totals).collect()}
    assert set(x) == {("t", "a"), ("t", "new"), ("u", "a")} and [x[k].rank for k in sorted(x)] == [2, 1, 1]
    new, a = x["t", "new"], x["t", "a"]
    assert new.ratio is None and new.delta_pp == 3.0 and a.confidence == "high" and new.confidence == "medium"
    assert tr.changes(counts.limit(0), totals).count() == 0
    assert tr.changes(counts, spark.createDataFrame([(0, 0)], "now long, before long")).first().share == 0.0


def test_legs_and_movers_of_clients(spark):
    rows = [(1, 7, "k", 2024, 4, 10.0, "2025-01-10"), (2, 7, "k", 2024, 4, 30.0, "2025-02-10"), (3, 8, "k", 2023, 4, 5.0, "2024-01-10"), (4, 9, "new", 2024, 4, 50.0, "2025-01-10"), (5, 9, "old", 2023, 1, 50.0, "2023-04-10")]
    f = spark.createDataFrame([(i, 1, c, k, y, q, x, d) for i, c, k, y, q, x, d in rows], "id long, registrant_id long, client_id long, client_key string, year int, quarter int, income double, filing_date string")
    frame = tr.Frame("quarter", tr.Leg(2024 * 4 + 4), tr.Leg(2023 * 4 + 4))
    legs = {r.client_key: (r.now, r.before, r.early) for r in tr.client_legs(f, frame).collect()}
    assert legs == {"k": (30.0, 5.0, 0.0), "new": (50.0, 0.0, 0.0)}  # an amendment replaces, two rows of one client are one
    assert {r.client_key: r.kind for r in tr.movers(tr.client_legs(f, frame), floor=20.0, new_floor=40.0).collect()} == {"k": "riser", "new": "new_entrant"}


def test_periods(spark):
    x = spark.range(1).select(periods.parse_period(F.lit("Second Quarter")), periods.quarter_end(F.lit(2023 * 4 + 4)), periods.congress(F.lit(2020)), periods.ordinal(F.lit(112)), periods.parse_period(F.lit("mid-year"))).first()
    assert x[0] == 2 and x[1] == date(2023, 12, 31) and x[2] == 116 and x[3] == "112th" and x[4] is None


def test_search_and_prefixes(spark):
    items = spark.createDataFrame([("City", 1), ("City of X", 5), ("Old City", 9), ("Electricity", 2), (None, 3)], "name string, n long")
    assert [(r.name, r.score) for r in se.search(items, "city").collect()] == [("City", 100), ("City of X", 80), ("Old City", 60), ("Electricity", 30)]
    assert se.search(items, " ").count() == 0
    keys, known = spark.createDataFrame([("a b c",), ("z",)], "key string"), spark.createDataFrame([("a",), ("a b",)], "key string")
    assert [(r.key, r.known_key) for r in se.longest_prefix(keys, known).collect()] == [("a b c", "a b")]
