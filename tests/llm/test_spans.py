import random

from hypothesis import HealthCheck, given, settings, strategies as st

from tallyspark.llm import spans as s

SCHEMA = "doc_id long, text string, pos int, left string"


def brute(docs):
    """Pairs that share a run, and the covered characters of each document."""
    grams = {}
    for i, text in docs:
        for k in range(len(text or "") - s.RUN + 1):
            grams.setdefault(text[k : k + s.RUN], set()).add(i)
    pairs, covered = set(), {}
    for ids in grams.values():
        pairs |= {(a, b) for a in ids for b in ids if a < b}
    for i, text in docs:
        mark = bytearray(len(text or ""))
        for k in range(len(mark) - s.RUN + 1):
            if len(grams[text[k : k + s.RUN]]) > 1:
                mark[k : k + s.RUN] = b"\1" * s.RUN
        covered[i] = sum(mark)
    return pairs, covered


def random_text(r, n, letters="abcdefgh é数"):
    return "".join(r.choice(letters) for _ in range(n))


def found(spark, docs):
    df = spark.createDataFrame([(i, t, 1, "clash") for i, t in docs], SCHEMA)
    pairs = [tuple(x) for x in s.sharing_pairs(df).collect()]
    assert len(pairs) == len(set(pairs))
    shares = {x.doc_id: x.shared_chars for x in s.shared_share(df).collect()}
    return set(pairs), shares


def test_against_brute_force(spark):
    r = random.Random(7)
    passage, edge = random_text(r, 450), random_text(r, 200)
    docs = [(i, random_text(r, r.randrange(0, 900))) for i in range(30)]
    docs += [(100 + i, random_text(r, 50 + 13 * i) + passage[i * 20 :] + random_text(r, 33)) for i in range(8)]  # overlapping pieces
    docs += [(200, "x" + edge + "y"), (201, "z" + edge + "w"), (202, "p" + edge[:199] + "q"), (203, edge)]  # exactly 200, and 199
    docs += [(300, passage + "---" + passage), (301, "ab" * 400), (302, "ba" * 300), (303, "a" * 1000), (304, "a" * 199 + "b")]  # repeats within a text
    pairs, covered = brute(docs)
    got, shares = found(spark, docs)
    assert got == pairs and shares == covered


def test_copies_nulls_and_short(spark):
    r = random.Random(3)
    text, other = random_text(r, 400), random_text(r, 400)
    docs = [(i, text) for i in range(5, 45)] + [(50, text[:300] + other), (51, other), (60, None), (61, ""), (62, "short"), (63, None)]
    got, shares = found(spark, docs)
    copies = {(i, j) for i in range(5, 45) for j in range(i + 1, 45)}
    assert got == copies | {(i, 50) for i in range(5, 45)} | {(50, 51)}
    links = {tuple(x) for x in s.text_links(spark.createDataFrame([(i, t, 1, "clash") for i, t in docs], SCHEMA)).collect()}
    assert links == {(5, 50), (50, 51)}
    assert shares[5] == 400 and shares[50] == 700 and shares[60] == shares[61] == shares[62] == 0
    assert found(spark, docs[:1]) == (set(), {5: 0})
    empty = spark.createDataFrame([], SCHEMA)
    assert s.sharing_pairs(empty).count() == 0 and s.shared_share(empty).count() == 0


def test_a_passage_in_all_documents(spark):
    """A common footer, and one that is a little too short, in more texts than are compared in pairs."""
    r = random.Random(13)
    footer, short = random_text(r, 230), random_text(r, 190)
    docs = [(i, random_text(r, 80 + i % 40) + (footer if i % 3 else short) + random_text(r, 60 + i % 7)) for i in range(2 * s.MANY)]
    docs += [(1000 + i, footer[10:] + random_text(r, 90 + i)) for i in range(5)]
    pairs, covered = brute(docs)
    got, shares = found(spark, docs)
    assert got == pairs and shares == covered


def test_large_groups_meet_in_blocks(spark):
    rows = [(k, i) for k, n in ((1, 37), (2, 1), (3, 2)) for i in range(n)]
    got = sorted(tuple(x) for x in s.pairs_within(spark.createDataFrame(rows, "k int, id long"), together=5).collect())
    assert got == sorted([(i, j) for i in range(37) for j in range(i + 1, 37)] + [(0, 1)])


def test_sketch_in_blocks_finds_the_same(spark):
    r = random.Random(21)
    texts = [random_text(r, 600) for _ in range(12)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts + [t[100:] for t in texts[:4]] + [None, ""])], "doc_id long, text string").repartition(3)
    cells = 1 << 18
    few, many = ({(x.id, x.h, x.g, x.left, x.right, tuple(x.pos)) for x in s.repeated_anchors(docs, cells=cells, most_cells=m).collect()} for m in (1 << 26, 1 << 10))
    assert few and few == many


def test_same_id_twice(spark):
    r = random.Random(5)
    text = random_text(r, 300)
    assert found(spark, [(1, text), (1, text), (2, random_text(r, 300))])[0] == set()


@settings(max_examples=60, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.integers(0, 10**6), st.integers(200, 420), st.sampled_from(["ab", "abc ", "abcdefghij"]))
def test_every_run_holds_a_common_anchor(seed, length, letters):
    r = random.Random(seed)
    run = random_text(r, length, letters)
    texts = [random_text(r, r.randrange(0, 300), letters) + run + random_text(r, r.randrange(0, 300), letters) for _ in range(2)]
    who, pos, h = s.anchors(texts)
    inside = [{x for w, p, x in zip(who, pos, h) if w == n and texts[n].find(run) <= p <= texts[n].find(run) + length - s.K} for n in range(2)]
    assert inside[0] & inside[1]


def test_sketch_never_underestimates(spark):
    r = random.Random(9)
    texts = [random_text(r, 600) for _ in range(20)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts + texts[:5])], "doc_id long, text string").repartition(5)
    cells = 1 << 16
    rows = s._bits(s.sketch(docs, cells), cells)
    _, _, h = s.anchors(texts[:5])
    for row, at in zip(rows, s._cells(h, cells)):
        assert ((row[at >> 3] >> (7 - (at & 7)).astype("uint8")) & 1).all()
    assert s.repeated_anchors(docs).select("h").distinct().count() >= len(set(h.tolist()))
