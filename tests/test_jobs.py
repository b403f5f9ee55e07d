from datetime import date

import fake_live
import pytest
from pyspark.sql import functions as F

from tallyspark import cli, jobs
from tallyspark.operators import audit
from tallyspark.sources.sinks import Store


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


def test_load_sweep_and_audit(spark, store):
    swept = jobs.sweep(store, "fake_live:fetch", [2023, 2024], ["Q1", "Q2"])
    assert str(swept.pop("2024 Q2")).startswith("failed") and swept == {"2023 Q1": 3, "2023 Q2": 2, "2024 Q1": 3}
    assert jobs.sweep(store, "fake_live:fetch", [2023], ["Q1"]) == {"2023 Q1": 0}  # loaded again: nothing new
    f = store.read("filings")
    assert (f.count(), f.select("id").distinct().count(), f.where("is_current").count()) == (8, 8, 6)
    assert [(r.sopr_id, r.name, r.normalized_name) for r in store.read("clients").orderBy("sopr_id").collect()] == [("10", "Client 0, Inc.", "CLIENT 0"), ("11", "Client 1, Inc.", "CLIENT 1")]
    a = store.read("activities")
    assert (a.count(), a.select("id").distinct().count()) == (16, 16) and a.join(f, a.filing_id == f.id, "left_anti").count() == 0
    row = jobs.audit_sample(store, "fake_live:drifted", n=50).first()
    assert (row.sampled, row.missing, row.income_mismatch, row.activity_mismatch, row.errors) == (8, 1, 1, 1, 0)
    assert store.read("audit_log").count() == 1
    assert jobs.latest(store, "fake_live:drifted", date(2024, 8, 1)) == {"2023": 0, "2024": 0}


def test_missing_periods_are_filled(spark, store):
    expected = spark.createDataFrame([(2023, 1, 3), (2023, 2, 2), (2019, 1, 5)], "year int, quarter int, expected long")
    assert jobs.missing_periods(store, expected).count() == 3
    assert jobs.fill_missing(store, "fake_live:fetch", expected, tries=1) == [(2019, 1)]
    assert [(r.year, r.expected, r.actual) for r in jobs.missing_periods(store, expected).collect()] == [(2019, 5, 0)]


def test_commands_on_a_store(spark, tmp_path, capsys):
    store, csv = str(tmp_path / "store"), tmp_path / "expected.csv"
    csv.write_text("year,quarter,expected\n2023,1,3\n2023,2,9\n")
    cli.main(["ingest", store, "fake_live:fetch", "2023-2023", "--types", "Q1"])
    assert "2023 Q1" in capsys.readouterr().out
    cli.main(["coverage", store, str(csv)])
    assert "|2023|      2|       9|     0|" in capsys.readouterr().out
    cli.main(["recompute", store])
    cli.main(["snapshot", store, str(tmp_path / "copy")])
    assert Store(spark, str(tmp_path / "copy")).read("filings").count() == 3
    assert cli.years_of("2019-2021,2024") == [2019, 2020, 2021, 2024]


def test_refresh_order_and_failures(monkeypatch):
    done = []
    steps = [("a", lambda: done.append("a")), ("b", lambda: 1 / 0), ("c", lambda: done.append("c"))]
    assert jobs.refresh(steps) == {"a": "done", "b": "failed: division by zero"} and done == ["a"]
    assert jobs.refresh(steps, only=["c"]) == {"a": "skipped", "b": "skipped", "c": "done"}
    assert jobs.refresh(steps, skip=["b"]) == {"a": "done", "b": "skipped", "c": "done"}
    with pytest.raises(RuntimeError, match="NOT_SET_HERE"):
        jobs.refresh(steps, needs=["NOT_SET_HERE"])


def test_drift(spark):
    f = spark.createDataFrame
    stored = f([("a", 10.0, 2), ("b", None, 1), ("c", 5.0, 1), ("d", 1.0, 3), ("e", 1.0, 1)], "key string, income double, n_activities long")
    live = f([("a", 10.005, 2, "ok"), ("b", 3.0, 1, "ok"), ("c", None, None, "missing"), ("d", 1.0, 4, None), ("e", None, None, "error"), ("zz", 1.0, 1, "ok")], "key string, income double, n_activities long, status string")
    assert tuple(audit.drift_summary(audit.drift(stored, live)).first()) == (4, 1, 1, 1, 1)
    assert tuple(audit.drift_summary(audit.drift(stored.limit(0), live)).first()) == (0, 0, 0, 0, 0)


def test_rename_candidates_and_outliers(spark):
    f = spark.createDataFrame
    names = f([("Zelmar Optics (formerly Quill Lens Inc)", 5.0), ("Quill Lens", 70.0), ("Quill Lens, Inc.", 30.0), ("Mopi Works FKA Tarn Works", 1.0), ("Tarn Works", 3.0), ("Meta Platforms (fka Facebook)", 9.0), ("Facebook", 900.0), (None, 1.0)], "name string, income double")
    assert [tuple(r) for r in audit.rename_candidates(names, 50.0).collect()] == [("QUILL LENS", "ZELMAR OPTICS", 100.0, "Zelmar Optics (formerly Quill Lens Inc)")]
    rows = f([("A", False, 2020, 1, 30.0), ("A", False, 2020, 1, 30.0), ("A", False, 2021, 2, 55.0), ("B", True, 2020, 1, 70.0), ("C", False, 2020, 1, 1.0)], "client_key string, excluded boolean, year int, quarter int, income double")
    assert sorted(tuple(r) for r in audit.quarter_outliers(rows, 50.0).collect()) == [("A", False, 2020, 1, 60.0), ("B", True, 2020, 1, 70.0)]


def test_flags_and_status(spark):
    row = spark.range(1).select(
        F.struct(F.lit(0).alias("missing"), F.lit(1).alias("income_mismatch"), F.lit(0).alias("activity_mismatch"), F.lit(10).alias("errors"), F.lit(50).alias("sampled")).alias("audit"), F.lit(-55.0).alias("mentions_change_pct"),
        F.lit(21.0).alias("filings_year_change_pct"), F.lit(2.0).alias("due_ratio"), F.lit(61.0).alias("due_share_pct"), F.lit(80.0).alias("coverage_90d_pct"), F.lit(84.0).alias("coverage_pct"), F.lit(None).cast("double").alias("laws_dropped_pct"), F.lit(14.9).alias("top_topic_pct"),
    )
    got = audit.flags(row)
    assert [r.severity for r in got.collect()] == ["high", "medium", "high", "low", "medium", "medium", "medium"]
    assert tuple(audit.status(got).first()) == ("needs_attention", 2, 4, 1) and audit.status(got.limit(0)).first().status == "ok"
