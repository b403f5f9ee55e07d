import glob
import os

import duckdb
import pytest

import __spark_entry__ as e
import compare
from tallyspark.plans import registry

QUICK = ["p2_found", "p6_found", "p6_revisions", "p7_found", "p7_current", "current_filings", "as_of_filings", "tag_counts", "quarter_distribution", "signal_records", "trend_topics", "client_movers", "rule_topics", "law_references", "candidate_terms"]


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    c.sql("set timezone='UTC'")
    for p in glob.glob(f"{sf}/*.parquet"):
        c.sql(f"create view {os.path.basename(p)[:-8]} as select * from read_parquet('{p}')")
    return c


def test_sql_is_of_registered_queries():
    assert set(registry.oracle_sql()) <= set(registry.queries()) and set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_sql(spark, sf, con, name):
    df = registry.queries()[name](spark, sf)
    cols = sorted(df.columns)
    got = sorted((tuple(compare.norm(v) for v in r) for r in df.select(*cols).collect()), key=compare.key)
    rel = con.sql(registry.oracle_sql()[name])
    order = [rel.columns.index(c) for c in cols]
    assert got == sorted((tuple(compare.norm(r[i]) for i in order) for r in rel.fetchall()), key=compare.key)


def test_entry(spark):
    assert e.entry(spark).columns == ["table_name", "row_key", "field_name"]


def test_commands(spark, sf, tmp_path, capsys):
    from tallyspark import cli

    cli.main(["queries"])
    assert "current_filings" in capsys.readouterr().out
    cli.main(["query", "period_totals", sf, "--out", str(tmp_path / "q")])
    assert spark.read.parquet(str(tmp_path / "q")).count() == spark.read.parquet(f"{sf}/filings.parquet").where("is_current").select("year", "quarter").distinct().count()
    cli.main(["refresh", sf, str(tmp_path / "docs"), "--only", "export"])
    assert sorted(p.stem for p in (tmp_path / "docs").iterdir()) == ["alerts", "checks", "clients", "recent", "stats", "timeseries", "trends"]
