from tallyspark.functions.text import canonical_uuid, instant_key, money, written_day
from tallyspark.operators.diff import Field, field_differences, pair_copies, repeated_keys
from pyspark.sql import functions as F

FIELDS = [Field("amount", "amount", "amount", "abs(coalesce(l, 0) - coalesce(r, 0)) > 0.01BD"), Field("kind", "kind", "kind")]
SCHEMA = "id string, amount decimal(20,4), kind string, key string"


def differences(spark, left, right):
    a, b = spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA)
    out = field_differences(pair_copies(a, b, ("id", "id"), FIELDS), FIELDS, "no_left", "no_right")
    return sorted((r.key, r.field_name, r.left_value, r.right_value) for r in out.collect())


def test_missing_differing_and_equal(spark):
    from decimal import Decimal as D

    left = [("a", D("1.00"), "x", "clash"), ("b", None, None, None), ("c", D("5"), "x", None), (None, D("9"), "x", None)]
    right = [("a", D("1.01"), "x", None), ("b", D("0"), "y", "clash"), ("d", D("1"), "x", None)]
    assert differences(spark, left, right) == [("b", "kind", None, "y"), ("c", "no_right", None, None), ("d", "no_left", None, None)]
    assert differences(spark, [("a", D("1.00"), "x", None)], [("a", D("1.0101"), "x", None)]) == [("a", "amount", "1.0000", "1.0101")]


def test_repeated_rows_and_empty_tables(spark):
    from decimal import Decimal as D

    row = ("a", D("1"), "x", None)
    assert differences(spark, [row] * 5, [row] * 3) == []
    assert differences(spark, [], []) == []
    assert differences(spark, [row], []) == [("a", "no_right", None, None)]
    n = pair_copies(spark.createDataFrame([row] * 5, SCHEMA), spark.createDataFrame([row], SCHEMA), ("id", "id"), FIELDS).first()
    assert (n.n_left, n.n_right) == (5, 1)
    paired = pair_copies(spark.createDataFrame([row] * 5 + [("b", None, None, None)], SCHEMA), spark.createDataFrame([row], SCHEMA), ("id", "id"), FIELDS)
    assert [tuple(r) for r in repeated_keys(paired).collect()] == [("a", "repeated", "5", "1")]


def test_notations(spark):
    rows = [("{50B22D07-6E1A-420D-AE91-18BE987F3576}", "$1,234.50", "2019-04-20T01:00:00Z"), (" 50b22d076e1a420dae9118be987f3576", " 1234.50 USD", "2019-04-19 21:00:00-04:00"), ("", "(7)", "2019-04-19"), (None, None, None), ("n/a", "abc", "soon")]
    out = spark.createDataFrame(rows, "u string, m string, t string").select(canonical_uuid(F.col("u")), money(F.col("m")).cast("double"), instant_key(F.col("t")), written_day(F.col("t")).cast("string")).collect()
    assert out[0][0] == out[1][0] == "50b22d07-6e1a-420d-ae91-18be987f3576" and out[2][0] is None and out[4][0] == "n/a"
    assert [r[1] for r in out] == [1234.5, 1234.5, -7.0, None, None]
    assert out[0][2] == out[1][2] and out[2][2] == "D2019-04-19" and out[3][2] is None and out[4][2] == "Ssoon"
    assert [r[3] for r in out] == ["2019-04-20", "2019-04-19", "2019-04-19", None, None]
