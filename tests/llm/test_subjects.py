import random
import re
from collections import Counter

import pytest

from tallyspark.llm import subjects as s

TERMS = {
    "energy": ["peaker plants", "turbine blades", "kilowatts", "reactor licensing", "hydrogen hubs", "solar farms"],
    "health": ["telehealth visits", "organ transplants", "nurses", "drug rebates", "cancer screening", "midwives"],
    "trade": ["rules of origin", "garment quotas", "tariffs", "antidumping orders", "duty drawback", "importers"],
    "farms": ["dairy price floors", "hogs", "crop insurance", "grain storage", "pasture leases", "barley"],
}
FOREIGN = {"energy": ["redes electricas", "parques solares", "presas"], "health": ["salud rural", "vacunas", "tarifas hospitalarias"], "trade": ["aranceles", "aduanas", "cuotas importadas"], "farms": ["cosechas", "ganaderos", "riego agricola"]}
AREAS = [(k, [k[:3].upper(), k[:2].upper() + "X"]) for k in TERMS]
LEADS = ["issues related to", "the cost of", "oversight of", "funds for", "new limits on"]
IDIOMS = ["the chair kept a battery of questions in reserve", "there is a healthy margin of votes in the room", "nobody wants to fuel the rumor mill of the town"]
NEUTRAL = ["minutes were taken by the clerk and sent to the members", "the next meeting is in the old room on monday", "attachments of the memo were scanned by the staff"]


def make(seed=1, n=900):
    r = random.Random(seed)
    name = lambda: "".join(r.choice("bdfgk") + r.choice("aeiou") for _ in range(4)).title()
    phrase = lambda k: (r.choice(LEADS) + " " if r.random() < 0.4 else "") + r.choice(TERMS[k])
    acts, docs, truth = [], [], {}
    for i in range(n):
        ks = r.sample(sorted(TERMS), 2 if r.random() < 0.2 else 1)
        code = ks[0] if r.random() < 0.8 else r.choice(sorted(TERMS))
        acts.append((i, "; ".join(f"{phrase(k)}; {phrase(k)}".capitalize() for k in ks), code[:3] if r.random() < 0.5 else code[:3].upper() + " "))
        truth["activity", i] = set(ks)
    for i in range(n // 2):
        ks, foreign = r.sample(sorted(TERMS), r.choice([1, 1, 2])), r.random() < 0.3
        lines = []
        for k in ks:
            for _ in range(r.randrange(2, 5)):
                lines.append(f"La oficina recibio cartas de {name()} sobre {r.choice(FOREIGN[k])}." if foreign else f"{name()} asked the committee to revisit {r.choice(TERMS[k])} before the deadline of the members.")
        if not foreign:
            lines += [r.choice(IDIOMS).capitalize() + "." for _ in range(2)] + [r.choice(NEUTRAL).capitalize() + "."]
            if r.random() < 0.3:
                other = r.choice(sorted(set(TERMS) - set(ks)))
                lines.append(f"In passing, {name()} of the committee named {r.choice(TERMS[other])}.")
                if len(ks) == 1 and lines:
                    pass
        r.shuffle(lines)
        docs.append((i, " ".join(lines)))
        truth["document", i] = set(ks)
    labels = [(i, k) for i in range(n // 2) if r.random() < 0.3 for k in (truth["document", i] if r.random() < 0.95 else [r.choice(sorted(TERMS))])]
    return acts, docs, labels, truth


def run(spark, acts, docs, labels):
    f = spark.createDataFrame
    out = s.subjects(f(acts, "id long, description string, issue_code string"), f(docs, "doc_id long, text string"), f(AREAS, "subject string, issue_codes array<string>"), f(labels, "doc_id long, subject string"))
    rows = [tuple(x) for x in out.collect()]
    assert len(rows) == len(set(rows))
    got = {}
    for kind, i, k in rows:
        got.setdefault((kind, i), set()).add(k)
    return got


@pytest.fixture(scope="module")
def result(spark):
    acts, docs, labels, truth = make()
    extra = [(5001, None, "ENE"), (5002, "  ", " h e a "), (5003, "No specific bills this period", "TRX"), (5004, "No specific bills", None), (5005, "", "zzz"), (5006, "Peaker plnats; hogs", "TRA"), (None, "hogs", "FAR"), (5001, None, "ENE"), (5007, "word " * 20000 + "; hogs", None)]
    more = [(9001, None), (9002, ""), (9003, " \n "), (9004, "One line on hogs."), (9005, " ".join(x.capitalize() + "." for x in IDIOMS)), (None, "hogs"), (9006, "Two on hogs. And hogs again. One on nurses."), (9007, "neutral words of the members. " * 20000 + "hogs.")]
    return run(spark, acts + extra, docs + more, labels + [(None, "farms"), (3, None)]), truth


def test_accuracy(result):
    got, truth = result
    for kind, least in (("activity", 0.99), ("document", 0.93)):
        cases = {k: v for k, v in truth.items() if k[0] == kind}
        right = sum(got.get(k, set()) == v for k, v in cases.items())
        assert right / len(cases) >= least, (kind, right / len(cases))


def test_given_cases(result):
    got, _ = result
    activity = lambda i: got.get(("activity", i), set())
    assert [activity(5000 + i) for i in range(1, 8)] == [{"energy"}, {"health"}, {"trade"}, set(), set(), {"energy", "farms"}, {"farms"}]
    document = lambda i: got.get(("document", i), set())
    assert [document(9000 + i) for i in range(1, 8)] == [set(), set(), set(), {"farms"}, set(), {"farms"}, {"farms"}]


def test_empty_tables(spark):
    assert run(spark, [], [], []) == {}
    assert run(spark, [(1, None, "ENE")], [], []) == {("activity", 1): {"energy"}}


def test_pairs_with_short_words(spark):
    assert {"assurance vie", "vie reste", "sur assurance"} <= set(s.own_phrases(s.sentences("Une note sur assurance vie reste.")))


def test_rounds_of_propagation(spark):
    """1 and 2 are known from ratings, 3 only over the texts that share 1 and 2; a rated text that has them keeps its own rating."""
    f = spark.createDataFrame
    edges = f([(i, [1, 2] if i < 4 else [1, 2, 3] if i < 12 else [4]) for i in range(20)], "doc_id long, ps array<int>")
    ratings = f([(i, "b") for i in range(4)] + [(11, "c")], "doc_id long, subject string")
    nodes = f([(1, 12), (2, 12), (3, 8), (4, 8)], "p int, df long")
    at = lambda r: {x.p: x.subject for x in s.propagate(edges, ratings, nodes, 5, 12, 0.1, r).collect()}
    assert at(1) == {1: "b", 2: "b"}
    assert at(3) == {1: "b", 2: "b", 3: "b"}


def test_seeds_speak_once(spark):
    f = spark.createDataFrame
    seeds = f([(0, "a", 5), (0, "b", 1), (1, "a", 2), (1, "b", 2)], "p int, subject string, n long")
    edges = f([(i, [0, 1, 7]) for i in range(9)], "doc_id long, ps array<int>")
    got = {x.p: x.subject for x in s.seeded(seeds, edges, f([(1, "b"), (2, "b"), (99, "a")], "doc_id long, subject string")).collect()}
    assert got == {0: "a", 1: "b"}


def test_ratings_are_clamped(spark):
    """A rating survives with one sentence in its favour or where no phrase is known; not against the text."""
    f = spark.createDataFrame
    labels = f([(0, "a"), (1, "b"), (2, "c")], "p int, subject string")
    spans = [(1, [(0, 0, 0, 4), (0, 1, 9, 13), (1, 2, 20, 24)]), (2, []), (3, [(0, 0, 0, 4)]), (4, [(0, 0, 0, 4), (0, 1, 9, 13), (1, 2, 20, 24)])]
    ratings = f([(1, "b"), (2, "c"), (3, "c")], "doc_id long, subject string")
    known = f(spans, f"doc_id long, spans {s.SPANS}")
    got = {r.doc_id: sorted(r.subjects) for r in s.document_subjects(known, known.limit(0), labels, ratings).collect()}
    assert got == {1: ["a", "b"], 2: ["c"], 3: ["a"], 4: ["a"]}
    # a phrase within a longer labelled one does not count
    nested = f([(5, [(0, 0, 0, 9), (0, 1, 20, 29), (1, 0, 0, 20), (1, 1, 20, 40)])], f"doc_id long, spans {s.SPANS}")
    assert [r.subjects for r in s.document_subjects(known.limit(0), nested, labels, ratings.limit(0)).collect()] == [["b"]]


def test_errors_are_mended_in_every_document():
    phrases = ["crop insurance", "organ transplants", "wetland permits"]
    finder = s.Finder(phrases, {"permit", "cop"})
    count = lambda t: dict(Counter(phrases[p] for p, _ in {x[:2] for x in s.document_edges(t, finder)[0]}))
    assert count("Nobody could explain why crop insuracne cost so much.") == {"crop insurance": 1}
    assert count("On organ transplants. Organ transplants again. The wetland permts. Also wetlnad permits.") == {"organ transplants": 2, "wetland permits": 2}
    assert count("The crop insurance. And crop insurrance.") == {"crop insurance": 2}
    assert count("A cop insurance. A wetland permit. Nothing.") == {}


def test_longest_phrases():
    phrases = ["a b", "a b c", "b c", "c d"]
    find = lambda t: sorted(phrases[h[2]] for h in s.Finder(phrases).longest(t))
    assert find(" a b c d ") == ["a b c", "c d"] and find(" a b b c ") == ["a b", "b c"]


def test_small_subjects_in_a_skewed_corpus(spark):
    """A subject keeps its phrases when another one grows: its own size sets what is enough."""
    r = random.Random(5)
    acts = [(i, f"{r.choice(TERMS['energy'])}; {r.choice(TERMS['energy'])}", "ENE") for i in range(20_000)]
    acts += [(100_000 + i, f"{r.choice(TERMS[k])}; {r.choice(TERMS[k])}", k[:3].upper()) for i, k in enumerate(["health", "trade", "farms"] * 30)]
    docs = [(i, f"{t.capitalize()} came up. The members spoke of {t} again.") for i, t in enumerate(t for k in ("health", "trade", "farms") for t in TERMS[k])]
    got = run(spark, acts, docs, [])
    want = {i: k for i, k in enumerate(k for k in ("health", "trade", "farms") for _ in TERMS[k])}
    assert sum(got.get(("document", i)) == {k} for i, k in want.items()) >= 0.9 * len(want)


def test_words_of_long_descriptions_count(spark):
    long = "the registrant keeps watch over everything that the committees of both houses and their members discuss in these months"
    rows = spark.createDataFrame([(i, long if i % 2 else "hogs in 2024; hogs", ["farms"] if i % 2 else None) for i in range(20)] + [(99, None, None)], "id long, description string, seeds array<string>")
    got = {(r.what, r.text, r.subject): r.n for r in s.seed_counts(rows).collect()}
    assert got["word", "registrant", None] == got["word", "hogs", None] == got["word", "2024", None] == 10
    assert got["phrase", "hogs", None] == 10 and got["size", "", "farms"] == got["size", "", None] == 10
    assert got["phrase", "their members discuss in these months", "farms"] == 10 and not any("2024" in t for w, t, _ in got if w == "phrase")


def test_descriptions_are_searched_once(spark):
    """Labels of named phrases, or seeds where none is named, come from one pass over the activities."""
    f = spark.createDataFrame
    acts = f([(1, "hogs; barley", "FAR"), (2, "No specific bills", "TRX"), (3, None, "ENE"), (4, "No specific bills", None)], "id long, description string, issue_code string")
    out = s.subjects(acts, f([], "doc_id long, text string"), f(AREAS, "subject string, issue_codes array<string>"), f([], "doc_id long, subject string"))
    assert out._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    named = f([(1, ["a"], [0, 2]), (2, ["a", "b"], []), (3, None, [1, 5]), (4, None, [])], "id long, seeds array<string>, ps array<int>")
    got = s.activity_subjects(named, f([(0, "x"), (1, "y"), (2, "z")], "p int, subject string"))
    assert sorted(map(tuple, got.collect())) == [(1, "x"), (1, "z"), (2, "a"), (2, "b"), (3, "y")]


def test_words_and_cuts():
    """Words and cuts are those that one search from left to right finds."""
    cuts = {
        s.SENTENCE: r"[.?!…][\"”’)\]»]*\s+|[\r\n]+",
        s.PIECE: r"[;,/\r\n]|\sand\s",
        s.DELIMITER: r"[;,/\r\n()\"“”]|\.(?=\s|$)|\s[-–—]\s|\sand\s",
        (): r"(?!)",
    }
    odd = ["\n", "\r", "\x00", "\x1c", "\x85", " ", "\xa0", " ", ". ", ".", "…", "?”", "’", "»", ")", " and ", "\nand ", ", and\n", " and and ", ";", "/", " - ", " – ", "—", "_", "²", "٣", "á", "i̇", "​", '"', "A.B. ", "\x0b"]
    r = random.Random(7)
    for _ in range(3000):
        low = "".join(r.choice(odd) if r.random() < 0.5 else r.choice(["hogs", "and", "été", "x1"]) for _ in range(r.randrange(12))).lower()
        for cut, pattern in cuts.items():
            want = [w if w.isalnum() else "\x00" for w in re.findall(r"[^\W_]+|" + pattern, low)]
            assert s.plain_words(low, cut) == f" {' '.join(want)} ", (low, pattern)
    assert s.blanked("a" + "é".join(map(chr, range(0x2190, 0x21D0)))) == "a" + "é".join([" "] * 64)


def test_errors_of_words():
    mended = s.Finder(["crop insurance", "wetland permits"], {"insurances"}).mended
    for _ in range(2):
        assert mended.errors(["crop", "insurances", "insuracne", "permts", "permit", "other", "\x00"]) == {"insuracne": "insurance", "permts": "permits"}
