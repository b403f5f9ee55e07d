import random

from tallyspark.operators.feed import current_rows, fold_changes

FEED, BASE = "k string, lsn long, op string, v string, deleted string", "k string, v string, sequence long"


def fold(spark, feed, base=None):
    b = spark.createDataFrame(base, BASE) if base is not None else None
    return fold_changes(spark.createDataFrame(feed, FEED), "k", "lsn", "op", ["v"], b)


def test_order_and_repeats_do_not_matter(spark):
    r = random.Random(1)
    feed = [(r.choice("abc"), i, r.choice(["I", "upd", "DELETE", "c", "U"]), str(i), "clash") for i in range(60)]
    last = {}
    for k, i, op, v, _ in feed:
        last[k] = None if op == "DELETE" else (i, v)
    want = sorted((k, *x) for k, x in last.items() if x)
    for _ in range(3):
        mixed = feed + r.sample(feed, 20)
        r.shuffle(mixed)
        assert sorted((x.key, x.sequence, x.v) for x in current_rows(fold(spark, mixed)).collect()) == want


def test_base_tombstones_nulls_and_unknown(spark):
    base = [("a", "old", 9), ("b", "old", 9), (None, "x", 9)]
    feed = [("a", 5, "D", None, None), ("c", 1, "update", "new", None), (None, 2, "I", "x", None), ("d", None, "I", "x", None), ("e", 3, "truncate", "x", None)]
    state = fold(spark, feed, base)
    assert sorted((x.key, x.sequence, x.v) for x in current_rows(state).collect()) == [("b", None, "old"), ("c", 1, "new")]
    # the tombstone of a stands against a late change of lower sequence
    assert state.where("key = 'a' and deleted and sequence = 5").count() == 1
    later = fold(spark, feed + [("a", 4, "I", "late", None)], base)
    assert current_rows(later).where("key = 'a'").count() == 0
    assert current_rows(fold(spark, feed + [("a", 6, "I", "again", None)], base)).where("key = 'a' and v = 'again'").count() == 1
    assert fold(spark, []).count() == 0 and fold(spark, [], []).count() == 0
    assert current_rows(fold(spark, [("a", 1, "I", "x", None), ("a", 1, "D", None, None)])).count() == 0  # at equal sequence the delete wins
