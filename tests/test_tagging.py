from difflib import SequenceMatcher

from tallyspark.operators import tagging as tg
from pyspark.sql import functions as F
import pytest

RULES = tg.load_rules({"topics": [
    {"id": "t1", "issue_codes": ["AAA"], "keywords": ["solar farm", "wind park", "privacy", "grid", "tax"], "programs": ["big program"], "acts": ["sun act"], "exclude": ["never this"]},
    {"id": "t2", "issue_codes": ["BBB"], "keywords": ["hogs"], "allow_single_support_relaxed": True},
]})
CASES = [
    ("Solar  Farm and wind park", "ZZZ", ["t1"], "strict", 3.2), ("solar farm", "ZZZ", ["general_zzz"], "fallback", 0.2), ("solar farm", "AAA", ["t1"], "strict", 2.2), ("privacy", "AAA", ["t1"], "relaxed", 1.3),
    ("grid", "AAA", ["general_aaa"], "fallback", 0.2), ("grid taxes", "AAA", ["general_aaa"], "fallback", 0.2), ("hogs", "BBB", ["t2"], "relaxed", 0.7), ("the sun act", "ZZZ", ["general_zzz"], "fallback", 0.2),
    ("sun act, big program", "ZZZ", ["t1"], "strict", 5.0), ("solar farm, wind park never this", "AAA", ["general_aaa"], "fallback", 0.2), (None, "TAX", ["general_taxation"], "fallback", 0.2), ("", None, [], None, None),
]


def test_topics(spark):
    df = spark.createDataFrame([(i, t, c, "clash") for i, (t, c, *_) in enumerate(CASES)], "id int, description string, issue_code string, tier string")
    for r in tg.topics(df, RULES).orderBy("id").collect():
        _, _, ids, tier, score = CASES[r.id]
        assert r.topics == ids, CASES[r.id]
        if ids:
            assert abs(r.topic_scores[ids[0]] - score) < 1e-9 and r.topic_evidence[ids[0]].assignment_tier == tier, CASES[r.id]
    assert tg.topics(df.limit(0), RULES).count() == 0
    with pytest.raises(ValueError):
        tg.load_rules({"topics": []})


def test_laws_and_entities(spark):
    x = spark.createDataFrame([("HR 5, h.r. 5; S. 12 and Clean Water Act of 2020, section 7 and HR 5",), (None,)], "t string").select(tg.laws(F.col("t")).alias("l")).collect()
    assert x[0].l == ["HR 5", "h.r. 5", "S. 12", "section 7", "Clean Water Act of 2020"] and x[1].l == []
    y = spark.createDataFrame([("The EPA and sec filings; secretary", "U.S. SENATE", None)], "a string, b string, c string").select(tg.entities(F.col("a"), F.col("b"), F.col("c")).alias("e")).first()
    assert y.e == ["Senate", "EPA", "SEC"]


def test_mining_and_loop(spark):
    rows = [(i, "A", "apple pears pie") for i in range(6)] + [(i + 10, "B", "stone wall") for i in range(6)]
    out = tg.mine_candidates(spark.createDataFrame(rows, "id long, code string, text string"), least_df=3, least_lift=2).where("code = 'A'").orderBy("rank").collect()
    assert {r.term for r in out} == {"apple", "pears", "pie", "apple pears", "pears pie"} and out[0].doc_freq == 6
    docs = spark.createDataFrame([(i, t) for i, (_, _, t) in enumerate(rows)], "id long, text string")
    phrases, history = tg.dictionary_loop(docs, [("apple pears", "fruit")], lambda d: [("stone wall", "walls"), ("x", "short"), ("nothing here", "none")])
    assert ("stone wall", "walls") in phrases and history == [0.5, 1.0]
    wall = lambda d: [("stone wall", "walls")]
    assert tg.dictionary_loop(docs, [("apple pears", "fruit")], wall, banned=["stone wall"]) == ([("apple pears", "fruit")], [0.5])
    assert tg.dictionary_loop(docs, [("apple pears", "fruit")], wall, budget=1.0, cost=2.0) == ([("apple pears", "fruit")], [0.5])


def test_pairs(spark):
    e = spark.createDataFrame([(x,) for x in ["Board of Mills"] * 2 + ["Board of Milk"] * 2 + ["Quite other"] * 2 + [None]], "v string")
    assert [(r.a, r.b) for r in tg.near_variants(e, "v").collect()] == [("Board of Milk", "Board of Mills")]
    k = spark.createDataFrame([("ACME",), ("ACME FOODS",), ("ACMED",)], "key string")
    assert [tuple(r) for r in tg.prefix_pairs(k).collect()] == [("ACME", "ACME FOODS")]
    n = spark.createDataFrame([("New Co (Formerly Old Co",), ("Plain",), (None,)], "name string")
    assert [(r.present, r.former) for r in tg.rename_evidence(n).collect()] == [("New Co", "Old Co")]


def test_near_variants_are_those_of_brute_force(spark, sf, monkeypatch):
    monkeypatch.setattr(tg, "VARIANT_BLOCK", 40)
    e = spark.read.parquet(f"{sf}/activity_extractions_rules.parquet").select(F.explode("entities").alias("v"))
    given = ["BOARD OF MILLS", "Board of Milk", "board of mills", "B.D.F.Y.", "B.I.F.Y.", "Xenate", "Senate", "", "É", "Straße", "STRASSE"]
    e = e.unionByName(spark.createDataFrame([(x,) for x in given * 2], "v string"))
    words = sorted(r.v for r in e.where("v is not null").groupBy("v").count().where("count >= 2").collect())
    brute = {(a, b, r) for i, a in enumerate(words) for b in words[i + 1 :] if 0.8 < (r := SequenceMatcher(None, a.lower(), b.lower()).ratio()) < 1}
    got = [tuple(r) for r in tg.near_variants(e, "v").collect()]
    assert len(got) == len(set(got)) and set(got) == brute
    pairs = {p[:2] for p in got}
    assert {("BOARD OF MILLS", "Board of Milk"), ("B.D.F.Y.", "B.I.F.Y."), ("Senate", "Xenate")} <= pairs and ("BOARD OF MILLS", "board of mills") not in pairs
