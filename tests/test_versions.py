from tallyspark.operators import versioning as v

SCHEMA = "id long, registrant_id long, client_id long, year int, quarter int, filing_date string"
ROWS = [
    (1, 1, 1, 2020, 1, "2020-04-10T00:00:00-04:00"), (2, 1, 1, 2020, 1, "2020-08-01T00:00:00-04:00"), (3, 1, 2, 2020, 1, "2020-04-10"), (4, 1, 2, 2020, 1, "2020-04-10"), (5, None, 2, 2020, 1, "2020-04-11"),
    (6, None, 2, 2020, 1, "2020-04-12"), (7, 2, 2, 2020, 1, None), (8, 2, 2, 2020, 1, "2020-04-01"),
]


def ids(df):
    return sorted(r.id for r in df.collect())


def test_current_and_as_of(spark):
    f = spark.createDataFrame(ROWS, SCHEMA)
    assert ids(v.mark_current(f).where("is_current")) == [2, 4, 6, 8]
    assert ids(v.as_of(f, "9999-12-31")) == [2, 4, 6, 8]  # the filing without date cannot be last
    assert ids(v.as_of(f, "2020-05-01")) == [1, 4, 6, 8]  # the amendment of August was not known
    assert ids(v.as_of_by_absence(f, "2020-05-01")) == [1, 4, 5, 6, 8]  # null keys equal none in an anti join
    assert ids(v.as_of(f.limit(0), "2020-05-01")) == []
    assert f.groupBy(*v.GROUP).count().count() == v.latest(f).count()


def test_repeats_new_upsert_pending(spark):
    f = spark.createDataFrame([(3, "x", None), (1, "x", None), (2, "x", "y")], "id long, a string, b string")
    assert ids(v.first_of_repeats(f, ["a", f.b])) == [1, 2]
    stored = spark.createDataFrame([(1, "x")], "id long, a string")
    assert ids(v.only_new(f, stored, ["id"])) == [2, 3]
    out = {r.id: (r.a, r.b) for r in v.upsert(stored, f.where("id < 3"), ["id"]).collect()}
    assert out == {1: ("x", None), 2: ("x", "y")}
    assert ids(v.pending(f, spark.createDataFrame([(1,), (None,)], "activity_id long"), "id", "activity_id")) == [2, 3]
    assert v.stratified(f, ["a"], 2).count() == 2
