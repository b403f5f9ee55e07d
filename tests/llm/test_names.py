import random

import pytest

from tallyspark.llm import names as n

SAME = [
    ("Moretegobe Railway Inc.", "MORETEGOBE RWY"), ("Moretegobe Railway Inc.", "Moretgeobe Railway"), ("Marlow Bridge Advs. (on behalf of Petro Dakemi Chem)", "Petro Dakemi Chemical Ltd."), ("Home Builders Alliance of Zaza Tropolo", "Zaza Tropolo Home Builders Ass'n"),
    ("TLTC - Tolitri Lavi Tech Corp", "Tolitri Lavi Technologies"), ("Dozedoloro Shipping (DS)", "Dozedoloro Shipping, and its subsidiaries"), ("Pöválárétö Logistics", "POVALARETO LOGISTICS LLC"), ("Ravetomago Development", "Raveto Mago Dev. Ltd"),
    ("Betty Radolifeze", "RADOLIFEZE, ELIZABETH H"), ("C. K. Vazelenefi", "Charles K. Vazelenefi, Esq."), ("Keki, Pipili & Arlow Strategies", "Pipili, Arlow & Keki"), ("Foods, Zika Keveze", "Zika Keveze Foods Co."), ("University of Bobitrareme", "U. of Bobitrareme"),
]
APART = [
    ("Tolitri Lavi Tech Corp", "Tolitri Lavi Railway Corp."), ("Mifebefepa Rural Bankers Association", "Mifebefepa Rural Bankers Association, Northern Chapter"), ("Keli Rotresi Harbor Pilots (Southern Chapter)", "Keli Rotresi Harbor Pilots (Northern Chapter)"),
    ("Henry A. Napigegoro", "William C. Napigegoro"), ("City of Razo Virama", "County of Razo Virama"), ("Salogakelo Utilities", "Moretegobe Utilities"),
]
SCHEMA = "id long, name string, normalized_name string, comp string"


def linked(spark, rows):
    df = spark.createDataFrame([(i, a, b, "clash") for i, a, b in rows], SCHEMA)
    return {tuple(r)[1:] for r in n.linked_pairs(n.linked_rows({"client": df})).collect()}


def test_pairs(spark):
    rows, want = [], set()
    for i, (a, b) in enumerate(SAME + APART):
        rows += [(10 * i, a, None), (10 * i + 1, b, None)]
        if i < len(SAME):
            want.add((10 * i, 10 * i + 1))
    got = linked(spark, rows)
    names = {i: a for i, a, _ in rows}
    # some names of the list belong to one organisation by themselves
    also = {(a, b) for a in names for b in names if a < b and a // 10 != b // 10 and {names[a], names[b]} <= {"TLTC - Tolitri Lavi Tech Corp", "Tolitri Lavi Technologies", "Tolitri Lavi Tech Corp"}}
    also |= {(a, b) for a in names for b in names if a < b and a // 10 != b // 10 and {names[a], names[b]} <= {"Moretegobe Railway Inc.", "MORETEGOBE RWY", "Moretgeobe Railway"}}
    assert got - also == want and also <= got | also


def test_former_names_chain_and_second_column(spark):
    rows = [(1, "Old Kadisi Divo Energy", None), (2, "Fefi Vapira Steel (formerly Old Kadisi Divo Energy Ltd.)", None), (3, "FEFI VAPIRA STEEL", None), (4, "Other Momimekova", "FEFI VAPIRA STEEL"), (5, None, None), (6, "  ", ""), (7, None, " Fefi Vapira Steel")]
    group = [1, 2, 3, 4, 7]
    assert linked(spark, rows) == {(a, b) for a in group for b in group if a < b}


def test_equal_spellings_repeated_rows_and_empty(spark):
    assert linked(spark, [(1, "Kofeza Moza", None), (2, "Kofeza Moza", None), (2, "Kofeza Moza", None)]) == {(1, 2)}
    assert linked(spark, []) == set()
    assert linked(spark, [(1, "x" * 5000, None), (2, "x" * 5000, None)]) == {(1, 2)}


def test_candidates_lose_no_pair_within_one_error():
    r = random.Random(5)
    for _ in range(400):
        rare = ["".join(r.choice("bcdfgkl") + r.choice("aeiou") for _ in range(r.randrange(2, 6))) for _ in range(r.randrange(1, 3))]
        w = r.randrange(len(rare))
        i = r.randrange(len(rare[w]) - 1)
        x = rare[w]
        typo = r.choice([x[:i] + x[i + 1 :], x[:i] + "z" + x[i:], x[:i] + "z" + x[i + 1 :], x[:i] + x[i + 1] + x[i] + x[i + 2 :]])
        other = rare[:w] + [typo] + rare[w + 1 :]
        order = sorted(n.grams(rare) | n.grams(other), key=lambda g: hash((g, 1)))  # any global order of the grams
        prefix = [set([g for g in order if g in n.grams(x)][: n.PREFIX]) for x in (rare, other)]
        assert prefix[0] & prefix[1], (rare, other)


def test_similarity_weighs_rare_words_more():
    weight = {"rareword": 9.0, "common": 1.0}
    assert n.similarity(["rareword", "common"], ["rareword", "comxxx"], weight) > n.similarity(["rareword", "common"], ["rarxxxxx", "common"], weight)
    assert n.similarity([], []) == 1.0 and n.similarity(["a"], []) == 0.0 and n.similarity(["raveto", "mago"], ["ravetomago"]) == 1.0


def test_rare_words_decide_in_the_links(spark):
    """The same error in a short word: beside a word that is as rare it is one in two, beside one that many names have it weighs more."""
    rows = [(i, f"Tolvan {w}", None) for i, w in enumerate(["Kobedo", "Rafisu", "Mupeti", "Gadova", "Lisoke", "Vunaro", "Pezimi"])]
    rows += [(20, "Tolvan Bak", None), (21, "Tolvan Bek", None), (30, "Zelmor Dak", None), (31, "Zelmor Dek", None)]
    rows += [(100 + i, f"{a}{b}{c}", None) for i, (a, b, c) in enumerate((x, y, z) for x in ("Qua", "Bli", "Tro", "Ske") for y in ("nuv", "pof", "jix", "gam", "wed") for z in ("arol", "umis", "oket", "ibad"))]
    got = linked(spark, rows)
    assert (30, 31) in got and (20, 21) not in got


def test_parties_stay_apart(spark):
    df = spark.createDataFrame([(1, "Kofeza Moza", None, ""), (2, "Kofeza Moza Inc.", None, "")], SCHEMA)
    got = {tuple(r) for r in n.linked_pairs(n.linked_rows({"client": df, "registrant": df.where("id = 1")})).collect()}
    assert got == {("client", 1, 2)}


@pytest.mark.parametrize("length", [1, 7, 40])
def test_components_of_chains(spark, length):
    edges = [(f"k{i:03d}", f"k{i + 1:03d}") for i in range(length)]
    out = {r.node: r.comp for r in n.components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert len(out) == length + 1 and set(out.values()) == {"k000"}
