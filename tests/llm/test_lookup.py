import random

import pytest

from tallyspark.llm import lookup as k

BILLS = [
    (1, "Solar Farm Access Act", "H.R. 10", 116, None), (2, "Wind Park Equity Act of 2020", "S. 5", 116, None), (3, "Wind Park Equity Act of 2023", "H.R. 7", 118, "P.L. 118-4"), (4, "Harbor Light Relief Act", "H.R. 10", 118, None),
    (5, "Hill Lake Reform Act", "S. 9", 117, "P.L. 117-2"), (6, "Horse Land Review Act", "S. 11", 118, None), (7, None, None, None, None),
]
AGENCIES = [(1, "Bureau of Reefs, Kelp and Estuaries", "BRKE"), (2, "Board of Weights", "BW"), (3, "House of Representatives", "HR"), (4, "Senate", "SEN"), (5, 'Office of "Dry Canal" Works', "ODCW"), (6, None, None)]
LAWS = [
    ("H.R. 10", 2019, 1), ("hr10", 2023, 4), ("H.R. 10", 2021, 0), ("H.R. 10 (118th Congress)", 2019, 4), ("House Bill 10, 116th Cong.", 2024, 1), ("S 5 of the 116th Congress", 2023, 2), ("solar farm access act.", 2024, 1), ("Solar Fram Access Act", 2024, 1),
    ("the Wind Park Equity Act", 2020, 2), ("the Wind Park Equity Act", 2024, 3), ("Wind Park Equity Act", 2021, 0), ("Wind Park Equity Act of 2023", 2019, 3), ("Wind Park Equity (116th)", 2024, 2), ("Pub. L. 118–4", 2019, 3), ("P.L. 118-99", 2019, 0),
    ("HLRA", 2017, 0), ("HLRA Act", 2021, 5), ("HLRA", 2023, 4), ("Solar Farm Access Act (H.R. 10)", 2024, 1), ("H.R. 10 - Harbor Light Relief Act", 2019, 4), ("Implementation of the Hill Lake Reform Act - oversight", 2024, 5), ("Hill  Lake, Reform Act, all provisions", 2024, 5),
    ("Solar Farm Reform Act", 2019, 0), ("the bill", 2019, 0), ("", 2019, 0), (None, 2019, 0), ("S. 9", None, 0), ("Section 12", 2019, 0), ("“Hill Lake Reform Act”", None, 5),
]
NAMES = {
    "BUREAU OF REEFS, KELP AND ESTUARIES": 1, "bureau of reefs, kelp & estuaries": 1, "Reefs, Kelp and Estuaries, Bureau of": 1, "Bur. of Reefs, Kelp and Estuaries": 1, "B.R.K.E.": 1, "the  Bureau of Reefs, Kelp and Estuaries (BRKE)": 1, "Bureau of Refes, Kelp and Estuaries": 1,
    "Board of Weights - field office": 2, "Bd. of Weights (secretary)": 2, "Board of Weihgts": 2, "US House": 3, "House of Reps.": 3, "House Of Representative": 3, "Senat": 4, "U.S. Senate": 4, 'Office of "Dry Canal" Works, regional staff': 5,
    "Board of Marble": 0, "staff": 0, "TBD": 0, "": 0, "n/a": 0, None: 0,
}


def slow_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_distance_and_tree():
    r = random.Random(1)
    words = ["".join(r.choice("abcd ") for _ in range(r.randrange(0, 12))) for _ in range(120)]
    for a in words[:40]:
        for b in words[:40]:
            assert k.edit_distance(a, b) == slow_distance(a, b)
    tree = k.BKTree(words)
    for q in words[:30] + ["abc", "zzz"]:
        for most in (0, 1, 2, 4):
            assert tree.within(q, most) == sorted((slow_distance(q, w), w) for w in set(words) if slow_distance(q, w) <= most)
    assert k.BKTree([]).within("a", 3) == [] and k.FlatTree(k.BKTree([])).within_many(["a", ""], [3, 3]) == [[], []]
    asked = words[:60] + ["abc", "zzz", "", "x" * 64, "abcd " * 20]
    most = [r.randrange(0, 5) for _ in asked]
    assert k.FlatTree(tree).within_many(asked, most) == [tree.within(q, m) for q, m in zip(asked, most)]


def test_shards_give_what_one_tree_gives(spark):
    r = random.Random(2)
    ref = ["".join(r.choice("abcdef") for _ in range(12)) for _ in range(200)]
    asked = [w[:5] + r.choice("abcdef") + w[6:] for w in ref] + ["nothing like it", None, ref[0]]
    e, l = spark.createDataFrame([(x, 1) for x in asked], "key string, distance int"), spark.createDataFrame([(x,) for x in ref] + [(None,)], "key string")
    one, many = ({tuple(x) for x in k.closest(e, l, shards=n).collect()} for n in (1, 4))
    assert one == many and len(one) == len(set(asked) - {None}) and ("nothing like it", None, None) in one
    assert k.closest(e, l, most_broadcast=50).count() == len(one) and k.closest(e.limit(0), l).count() == 0 and k.closest(e, l.limit(0)).where("ref_key is not null").count() == 0


@pytest.fixture(scope="module", params=[50_000, 2], ids=["broadcast", "shards"])
def resolved(spark, request):
    rules = [(i, [x], None, 5) for i, (x, _, _) in enumerate(LAWS)] + [(1000, None, list(NAMES), 5), (1001, [], [], 5), (None, ["H.R. 10"], None, 5)]
    years = [(i, y) for i, (_, y, _) in enumerate(LAWS)]
    frame = spark.createDataFrame
    out = k.resolve_entries(frame(rules, "activity_id long, legislation array<string>, entities array<string>, ref_id int"), frame(years, "activity_id long, year int"), frame(BILLS, "ref_id long, title string, bill_no string, congress int, public_law string"), frame(AGENCIES, "ref_id long, agency_name string, acronym string"))
    return [tuple(r) for r in out.collect()]


def test_laws(resolved):
    got = {a: ref for a, f, p, ref in resolved if f == "legislation"}
    assert [(x, got[i]) for i, (x, _, want) in enumerate(LAWS) if got[i] != want] == []


def test_agencies(resolved):
    got = {p: ref for a, f, p, ref in resolved if a == 1000}
    assert [(n, got[i + 1]) for i, n in enumerate(NAMES) if got[i + 1] != NAMES[n]] == []
    assert len(resolved) == len(LAWS) + len(NAMES)
