from tallyspark.llm import mixing as m


def test_allocate():
    got = m.allocate({"a": 100, "b": 10, "c": 50}, {"a": (0.5, 1), "b": (0.3, 2), "c": (0.2, 5), "none": (0.0, 1)}, 160)
    assert got["b"] == 20.0 and abs(got["a"] - 100) < 1e-9 and abs(got["c"] - 40) < 1e-9 and got["none"] == 0
    assert m.allocate({}, {"a": (1.0, 1)}, 0) == {"a": 0.0}
    assert m.allocate({"a": 10}, {"a": (1.0, 2), "b": (1.0, 2)}, 100) == {"a": 20.0, "b": 0.0}


DOCS = "id long, source string, n_tokens long, pass int, position double"
GOALS = "source string, target_share double, max_repeats int"


def mix(spark, docs, goals, **more):
    a, b = m.mix(spark.createDataFrame([(*d, 1, 0.5) for d in docs], DOCS), spark.createDataFrame(goals, GOALS), **more)
    return a.collect(), {r.source: r for r in b.collect()}


def test_shares_repeats_and_order(spark):
    docs = [(i, ["Filing Narrative", "filing_narrative ", "FILING-NARRATIVE"][i % 3], 100 + i % 7) for i in range(600)] + [(1000 + i, "memo", 50) for i in range(40)] + [(2000, None, 10), (2001, "web form", 500), (2002, "memo", 0), (2003, "memo", None), (2004, " ", 3)]
    goals = [("filing_narrative", 0.6, 1), ("Memo", 0.3, 3), ("absent", 0.1, 2)]
    schedule, shares = mix(spark, docs, goals, slopes={"filing_narrative": 0.5}, buckets=5)
    total = sum(d[2] or 0 for d in docs)
    # memo gives all it may, the narratives all they have, the absent source nothing
    assert shares["memo"].reached_tokens == 40 * 50 * 3 and shares["memo"].used_up and shares["absent"].reached_tokens == 0
    assert shares["filing_narrative"].reached_tokens <= total and shares["web_form"].target_share == 0 and shares[None].available_tokens == 13
    uses = {}
    for r in schedule:
        uses[r.doc_id] = uses.get(r.doc_id, 0) + 1
    assert all(n <= (3 if 1000 <= i < 2000 else 1) for i, n in uses.items()) and not {2000, 2001, 2002, 2003, 2004} & set(uses)
    positions = [r.position for r in schedule]
    assert positions == sorted(positions) and all(0 <= p <= 1 for p in positions)
    assert abs(sum(r.reached_share for r in shares.values()) - 1) < 1e-9
    # a position is the part of all tokens used so far
    done, every = 0, sum(r.n_tokens for r in schedule)
    for r in schedule:
        assert abs(r.position - (done + r.n_tokens / 2) / every) < 0.02
        done += r.n_tokens
    assert [tuple(r) for r in schedule] == [tuple(r) for r in mix(spark, docs, goals, slopes={"filing_narrative": 0.5}, buckets=5)[0]]


def test_schedules_shift_shares_along_the_run(spark):
    docs = [(i, "a", 10) for i in range(4000)] + [(5000 + i, "b", 10) for i in range(4000)]
    schedule, _ = mix(spark, docs, [("a", 0.5, 1), ("b", 0.5, 1)], slopes={"a": 0.5, "b": -0.5}, buckets=9)
    part = lambda lo, hi: [r.source for r in schedule if lo <= r.position < hi].count("a") / max(1, sum(lo <= r.position < hi for r in schedule))
    # at position x the share of a is (1 + 0.5 (1 - 2x)) / 2, as the slopes of the two cancel out
    assert [abs(part(x, x + 0.1) - (1 + 0.5 * (1 - 2 * (x + 0.05))) / 2) < 0.03 for x in (0.0, 0.3, 0.6, 0.9)] == [True] * 4


def test_blocks_of_buckets(spark, monkeypatch):
    docs = [(i, "a", 1 + i % 5) for i in range(500)]
    want = [tuple(r) for r in mix(spark, docs, [("a", 1.0, 1)], buckets=23)[0]]
    monkeypatch.setattr(m, "BLOCK_BUCKETS", 3)
    assert [tuple(r) for r in mix(spark, docs, [("a", 1.0, 1)], buckets=23)[0]] == want and len(want) == 500


def test_target_is_met_closely(spark):
    docs = [(i, "a", 10) for i in range(3000)] + [(5000 + i, "b", 10) for i in range(3000)]
    _, shares = mix(spark, docs, [("a", 0.5, 1), ("b", 0.5, 1)])
    assert shares["a"].reached_share == 0.5
    _, shares = mix(spark, docs, [("a", 0.25, 1), ("b", 0.75, 2)], buckets=7)
    assert abs(shares["a"].reached_share - 0.25) < 0.001 and abs(shares["a"].reached_tokens + shares["b"].reached_tokens - 60000) <= 20


def test_empty(spark):
    assert mix(spark, [], [("a", 1.0, 1)])[0] == [] and mix(spark, [(1, "a", 5)], [])[0] == []
    schedule, shares = mix(spark, [(1, "a", 5), (1, "a", 5)], [("a", 1.0, None)])
    assert len(schedule) == 2 and shares["a"].reached_share == 1.0
