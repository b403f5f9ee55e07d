import json
from datetime import date

import fake_api
import pytest
from tallyspark import schemas
from tallyspark.sources import api, sinks
from tallyspark.streaming.ingest import load_batch, stream_filings, sweep_start
from pyspark.sql import functions as F


def test_api_source_and_parse(spark):
    spark.dataSource.register(api.FilingsSource)
    raw = spark.read.format("filings_api").option("client", "fake_api:fetch").option("years", "2024").option("types", "Q1,Q2").option("pause", "0").load()
    x = raw.select(F.from_json("filing", schemas.FILING).alias("f")).select("f.*")
    assert x.count() == 9
    r = api.parse_filings(x).first()
    assert (r.year, r.quarter, r.income, r.client_name) == (2024, 1, 1000.5, "C Co")
    assert [(a.description, a.houses_lobbied, a.agencies) for a in r.activities] == [("taxes", "SENATE", "White House Office")]


def test_parse_leaves_out_and_falls_through(spark):
    rows = [fake_api.filing(1, income="0", expenses="$20"), fake_api.filing(2, filing_uuid=None), fake_api.filing(3, filing_type="RR"), fake_api.filing(4, client={"id": "", "name": "x"}), fake_api.filing(5, filing_period="mid-year"), fake_api.filing(6, lobbying_activities=None)]
    x = spark.createDataFrame([(json.dumps(r),) for r in rows], "j string").select(F.from_json("j", schemas.FILING).alias("f")).select("f.*")
    out = api.parse_filings(x).orderBy("sopr_filing_id").collect()
    assert [r.income for r in out] == [20.0, 1000.5] and out[1].activities == []


def test_ids_go_on(spark):
    new = spark.range(100).select(F.col("id").alias("k"))
    out = api.with_ids(new, spark.createDataFrame([(41,)], "id long"), ["k"]).orderBy("k").collect()
    assert [r.id for r in out] == list(range(42, 142))


def test_index_csv(spark, tmp_path):
    (tmp_path / "cpi.csv").write_text("date,value\n2020-01-01,250.5\n2020-02-01,.\n2020-03-01,\nbad,1\n")
    assert [(r.month, r.value) for r in api.read_index(spark, str(tmp_path / "cpi.csv")).collect()] == [(date(2020, 1, 1), 250.5)]


FILING = "id long, sopr_filing_id string, registrant_id long, client_id long, year int, quarter int, income double, expenses double, filing_date string, filing_type string, is_current boolean"


def filings(spark, *rows):
    return spark.createDataFrame([(i, k, 1, 1, 2020, 1, 1.0, None, day, "Q1", None) for i, k, day in rows], FILING)


def test_store_and_incremental_load(spark, tmp_path):
    s = sinks.Store(spark, str(tmp_path / "store"))
    assert s.read("filings").count() == 0
    load_batch(s, filings(spark, (1, "a", "2020-04-01")))
    load_batch(s, filings(spark, (1, "a", "2020-04-01"), (2, "b", "2023-01-01")))  # overlap, and an amendment years later
    assert {r.id: r.is_current for r in s.read("filings").collect()} == {1: False, 2: True}
    s.upsert("filings", filings(spark, (2, "b", "2024-01-01")), ["sopr_filing_id"])
    assert {r.id: r.filing_date for r in s.read("filings").collect()} == {1: "2020-04-01", 2: "2024-01-01"}
    s.insert_new("filings", filings(spark, (9, "b", "x"), (3, "c", "x")), ["sopr_filing_id"])
    assert sorted(r.id for r in s.read("filings").collect()) == [1, 2, 3]
    s.snapshot(str(tmp_path / "slim"))
    assert sinks.Store(spark, str(tmp_path / "slim")).read("filings").count() == 3


def test_store_as_uri_appends_and_partitions(spark, tmp_path):
    s = sinks.Store(spark, "file://" + str(tmp_path / "store"))
    one = lambda i, year: spark.createDataFrame([(i, f"k{i}", 1, 1, year, 1, 1.0, None, "2020-01-01", "Q1", None)], FILING)
    for i in range(3):
        s.append("filings", one(i, 2020 + i))
    assert sorted(r.id for r in s.read("filings").collect()) == [0, 1, 2]
    before = {p.name for p in (tmp_path / "store/filings/rows").iterdir()}
    load_batch(s, one(7, 2021))
    new = [p for p in (tmp_path / "store/filings/rows").iterdir() if p.name not in before]
    assert [p.name for x in new for p in x.iterdir() if p.is_dir()] == ["year=2021"]  # nothing else is written again
    assert {r.id: r.is_current for r in s.read("filings").collect()} == {0: None, 1: False, 2: None, 7: True}
    s.append("filings", one(9, None))
    s.upsert("filings", one(9, 2022), ["sopr_filing_id"])
    assert [(r.id, r.year) for r in s.read("filings").where("id = 9").collect()] == [(9, 2022)]
    other = spark.createDataFrame([(1, "x")], "k int, v string")
    s.append("other", other)
    s.append("other", other)
    s.upsert("other", spark.createDataFrame([(1, "y")], "k int, v string"), ["k"])
    assert [tuple(r) for r in s.read("other").collect()] == [(1, "y")]
    with pytest.raises(Exception, match="exist"):  # of two writers one fails
        s._commit("other", 0, [])


def test_store_joins_many_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "MOST_PARTS", 2)
    s = sinks.Store(spark, str(tmp_path / "store"))
    for i in range(4):
        s.append("other", spark.createDataFrame([(i,)], "k int"))
    assert sorted(r.k for r in s.read("other").collect()) == [0, 1, 2, 3] and len(s._latest("other")[1]) == 2


def test_stream_of_filings(spark, tmp_path):
    s = sinks.Store(spark, str(tmp_path / "store"))
    for rows in (((1, "a", "2020-04-01"),), ((1, "a", "2020-04-01"), (2, "b", "2021-01-01")), ((3, "c", "2020-05-01"),)):
        filings(spark, *rows).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream_filings(spark.readStream.schema(filings(spark).schema).parquet(str(tmp_path / "in")), s, str(tmp_path / "check")).awaitTermination()
    assert {r.id: r.is_current for r in s.read("filings").collect()} == {1: False, 2: True, 3: False}


def test_sweep_start():
    today = date(2026, 8, 22)
    assert sweep_start(date(2026, 8, 21), today) == date(2026, 8, 15) and sweep_start(date(2026, 6, 1), today) == date(2026, 5, 29) and sweep_start(date(2020, 1, 1), today) == date(2026, 4, 24) and sweep_start(None, today) == date(2026, 8, 15)


def test_documents_and_reports(spark, tmp_path):
    df = spark.createDataFrame([(1, "a|b")], "n long, t string")
    sinks.write_document(str(tmp_path / "d/stats.json"), {"rows": df, "fixed": 1})
    sinks.write_report(str(tmp_path / "r.md"), "Title", {"Part": df})
    assert sinks.read_documents(str(tmp_path / "d"), ["stats", "none"]) == {"stats": {"rows": [{"n": 1, "t": "a|b"}], "fixed": 1}, "none": None}
    assert "a\\|b" in (tmp_path / "r.md").read_text()


def test_migrate(spark):
    x = schemas.migrate(spark.createDataFrame([("1", "n", 5)], "id string, name string, extra int"), schemas.CLIENTS)
    assert x.columns == schemas.CLIENTS.fieldNames() and x.first().id == 1 and x.first().state is None
