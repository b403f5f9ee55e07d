"""Subject areas of records by label propagation (problem 1).

The graph: records (activities, documents) on one side, verified phrases on the other, an edge for each phrase a record
holds, with the sentence it stands in. Two records are neighbours if they share a phrase; passing through phrases, a group
of records that share one costs one edge each, never all pairs. The texts are searched for the phrases only to find the
edges; every label comes from rounds of joins over them:

1. Seeds are the activities' issue codes and the raters' labels of documents. They are clamped: no round changes them. A
   phrase that the codes have verified listens to seeds alone, so what it hears is the same in each round and is joined once.
2. Texts in which no such phrase stands (other languages) have phrases of their own. A round carries the labels of the texts
   to the phrases, which take the subject that most of their labelled texts have, and the labels of the phrases back to the
   texts, which may take several; rated texts keep their ratings.
3. The last joins carry the phrases' labels to all records: a description has each subject named, a document those of two
   sentences or its only one, and a rated document keeps its ratings as well, if a phrase of it agrees or none is known.

Only lists of verified phrases are broadcast. A phrase needs a share of the records of its subject, which bounds their
number whatever the input and however the subjects are distributed.
"""

from __future__ import annotations

import re
from bisect import bisect
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyspark.session import cut_lineage

#: Share of the activities of its subject (and number) that must hold a phrase; a subject has at most (phrases per activity) / SUPPORT of them.
SUPPORT, LEAST = 1e-3, 3
#: A word is common, so no typing error, in this share of all descriptions.
COMMON = 3e-4
#: Share of a phrase's labelled records that must agree on its subject.
PURITY = 0.5
#: A lead ("the cost of", "issues related to") is no part of a phrase: in this share of the activities, and no subject has more than NEUTRAL of it.
LEAD_SUPPORT, NEUTRAL = 2e-3, 0.35
MOST_WORDS = 6
#: What a document says to a phrase that seeds have verified, beside one seed.
DAMPING = 0.1
#: Of texts without a known phrase: share of the texts of one language label that must hold a phrase of their own; purity; rounds of propagation.
OWN_LEAST, OWN_PURITY, ROUNDS = 4e-3, 0.6, 3
#: A phrase of one subject is in no more of these texts than so many times the largest subject's share of the ratings; a turn of speech is.
#: One known from a single rated text is believed up to the smaller figure.
OWN_MOST, OWN_SINGLE = 1.5, 0.6
#: The labelled texts that hold it are at least so many times what their share of the texts lets expect: labelled texts seldom hold what names no subject.
DENSE = 0.4
#: A document takes a subject in a round from so many of its phrases at least, and from so many for each of its strongest subject.
TAKES, TAKES_SHARE = 2, 0.4
#: Below this share of sentences with a known phrase a text is searched for the phrases of texts without any.
SPARSE = 0.25
#: A text of whose words at least this share is common in the activities is in their language, whose phrases the codes have verified: it has none of its own
#: (one wrong rating would else reach, over turns of speech, every text of that language without a subject).
SAME_LANGUAGE = 0.15
#: Where a text whose line ends are \n is cut, one pattern after the other. Each begins with a character or a set of them, which a search skips to.
SENTENCE = (re.compile(r"[.?!…][\"”’)\]»]*\s+"), re.compile(r"\n\n*"))
PIECE = (re.compile(r"[^\S\n]and\s"), re.compile(r"[;,/\n]"))
DELIMITER = (re.compile(r"[^\S\n](?:[-–—]|and)\s"), re.compile(r"\.(?=\s|$)"), re.compile(r"[;,/\n()\"“”]"))
DIGIT = re.compile(r"\d")
#: The bytes of UTF-8 with a blank for each that is no letter, digit or zero character of ASCII; the bytes of ASCII.
BLANKS, ASCII = bytes(i if i > 127 or i == 0 or chr(i).isalnum() else 32 for i in range(256)), bytes(range(128))
SPANS = "array<struct<p:int,s:int,b:int,e:int>>"


def code_key(c: Column) -> Column:
    return F.upper(F.regexp_replace(c, r"(?U)\s+", ""))


def coded(activities: DataFrame, areas: DataFrame) -> DataFrame:
    """Activities (id, description, seeds): seeds are the subjects that list the issue code (case and spaces ignored)."""
    codes = areas.select("subject", F.explode("issue_codes").alias("c")).select(code_key(F.col("c")).alias("code"), "subject").groupBy("code").agg(F.sort_array(F.collect_set("subject")).alias("seeds"))
    return activities.select("id", "description", code_key(F.col("issue_code")).alias("code")).join(codes, "code", "left").select("id", "description", "seeds")


def seed_counts(records: DataFrame) -> DataFrame:
    """Rows (what, text, subject, n) of the descriptions of coded activities, counted in each task before the shuffle.

    what: 'phrase', the pieces between delimiters with the subjects of their seeds (null without one); 'word', in how many
    descriptions; 'size', the descriptions of each subject.
    """

    def flush(phrases: dict[str | None, Counter], words: Counter, sizes: Counter) -> pa.RecordBatch:
        text = [*(x for c in phrases.values() for x in c), *words, *[""] * len(sizes)]
        subject = [*(k for k, c in phrases.items() for _ in c), *[None] * len(words), *sizes]
        what = ["phrase"] * (len(text) - len(words) - len(sizes)) + ["word"] * len(words) + ["size"] * len(sizes)
        n = [*(n for c in phrases.values() for n in c.values()), *words.values(), *sizes.values()]
        return pa.RecordBatch.from_arrays([pa.array(what), pa.array(text), pa.array(subject, pa.string()), pa.array(n, pa.int64())], names=["what", "text", "subject", "n"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases, words, sizes = defaultdict(Counter), Counter(), Counter()
        for b in batches:
            for part in _pieces(b):
                new = defaultdict(list)
                seen = []
                for text, seeds in zip(part.column(0).to_pylist(), _lists(part.column(1))):
                    low, seeds = text.lower(), seeds or (None,)
                    pieces = {x.strip() for x in plain_words(low, DELIMITER).split("\x00")}
                    digits = DIGIT.search(low)
                    pieces = [x for x in pieces if x and len(x) <= 80 and not (digits and DIGIT.search(x))]
                    for k in seeds:
                        new[k] += pieces
                    seen += set(blanked(low.replace("\x00", "_")).split())
                    sizes.update(seeds)
                words.update(seen)
                for k, x in new.items():
                    phrases[k].update(x)
                if len(words) + sum(map(len, phrases.values())) > 300_000:
                    yield flush(phrases, words, sizes)
                    for x in (phrases, words, sizes):
                        x.clear()
        if sizes:
            yield flush(phrases, words, sizes)

    counted = records.where("description is not null").select("description", "seeds").mapInArrow(run, "what string, text string, subject string, n long")
    return counted.groupBy("what", "text", "subject").agg(F.sum("n").alias("n"))


def _top(df: DataFrame, key: str) -> DataFrame:
    """Of each key: n of its labelled records, the subject most of them have, and how many."""
    per = df.where("subject is not null").groupBy(key, "subject").agg(F.sum("n").alias("n"))
    return per.groupBy(key).agg(F.sum("n").alias("n"), F.max(F.struct("n", "subject")).alias("m"), F.count(F.lit(1)).alias("k")).select(key, "n", F.col("m.subject").alias("subject"), F.col("m.n").alias("top"), "k")


def learn_phrases(counts: DataFrame, sizes: dict[str, int]) -> tuple[list[str], list[str]]:
    """The verified phrases and the leads, from the phrases of seed_counts and the number of coded activities of each subject."""
    n = sum(sizes.values())
    blanks = F.length("phrase") - F.length(F.replace("phrase", F.lit(" "), F.lit("")))
    cuts = counts.where(blanks > 0).select("phrase", "subject", "n", F.explode(F.sequence(F.lit(1), F.least(blanks, F.lit(4)))).alias("k"))
    cuts = cuts.select("subject", "n", "phrase", F.expr("substring_index(phrase, ' ', k)").alias("lead"))
    leads = [r[0] for r in _top(cuts, "lead").where((F.col("n") >= max(LEAST, LEAD_SUPPORT * n)) & (F.col("top") <= NEUTRAL * F.col("n"))).select("lead").collect()]
    every = without_leads(counts, leads).where(F.size(F.split("phrase", " ")) <= MOST_WORDS)
    least = F.coalesce(*[F.when(F.col("subject") == s, float(max(LEAST, SUPPORT * k))) for s, k in sizes.items()], F.lit(float(LEAST)))
    good = _top(every, "phrase").where((F.col("n") >= least) & (F.col("top") >= PURITY * F.col("n")))
    good = good.where(~F.col("phrase").isin(leads) & ~F.col("phrase").rlike(r"\bact$") & (F.length("phrase") > 3))
    return _minimal({r.phrase: (r.subject, r.n) for r in good.select("phrase", "subject", "n").collect()}), leads


def without_leads(counts: DataFrame, leads: list[str]) -> DataFrame:
    """counts, and once more without the lead for phrases that begin with one."""
    if not leads:
        return counts
    ks = F.sequence(F.lit(1), F.lit(max(x.count(" ") for x in leads) + 1))
    cut = counts.where(F.col("phrase").contains(" ")).select("phrase", "subject", "n", F.explode(ks).alias("k")).withColumn("lead", F.expr("substring_index(phrase, ' ', k)"))
    bare = cut.where(F.col("lead").isin(leads) & (F.length("lead") < F.length("phrase"))).select(F.expr("substring(phrase, length(lead) + 2)").alias("phrase"), "subject", "n")
    return counts.unionByName(bare)


def _minimal(found: dict[str, tuple[str, int]]) -> list[str]:
    """Phrases, from phrase: (subject, records). Without those that only extend another one of the same subject, and those
    that extend one of another subject in less than a quarter of its records, which is chance."""
    kept: dict[str, tuple[str, int]] = {}
    for p in sorted(found, key=lambda p: (p.count(" "), p)):
        w = p.split()
        inner = [kept[x] for i in range(len(w)) for j in range(i + 1, len(w) + 1) if j - i < len(w) and (x := " ".join(w[i:j])) in kept]
        if all(s != found[p][0] and 4 * found[p][1] >= n for s, n in inner):
            kept[p] = found[p]
    return sorted(kept)


class _Mended:
    """Words with a typing error, mended; common words and words of phrases are none."""

    def __init__(self, phrases: Iterable[str], common: Iterable[str]):
        self.words = {w for p in phrases for w in p.split()} | {"\x00"}
        self.common = set(common)
        self.right = self.words | self.common
        self.known, self.wrong = set(self.right), {}
        self.by_deletion: dict[str, set[str]] = {}
        for w in self.words:
            if len(w) >= 5:
                for x in (w, *(w[:i] + w[i + 1 :] for i in range(len(w)))):
                    self.by_deletion.setdefault(x, set()).add(w)

    def errors(self, words: Iterable[str]) -> dict[str, str]:
        """The words that have an error, mended. Words found to have none are remembered as known."""
        return {w: m for w in set(words).difference(self.known) if (m := self.wrong.get(w) or self._mend(w)) != w}

    def _mend(self, w: str) -> str:
        m = w
        if len(w) >= 5:
            less = [w[:i] + w[i + 1 :] for i in range(len(w))]
            less.append(w)
            if not self.by_deletion.keys().isdisjoint(less):
                m = min((c for x in less for c in self.by_deletion.get(x, ()) if _one_error(w, c)), default=w)
        if len(self.known) + len(self.wrong) > 300_000:
            self.known, self.wrong = set(self.right), {}
        if m == w:
            self.known.add(w)
        else:
            self.wrong[w] = m
        return m


class Finder:
    """Finds phrases in texts, as whole words; the number of a phrase is its place in the list, counted from first."""

    def __init__(self, phrases: Sequence[str], common: Iterable[str] = (), first: int = 0):
        self.tree = ahocorasick.Automaton()
        for i, p in enumerate(phrases, first):
            self.tree.add_word(f" {p} ", (len(p) + 1, i, " " in p))
        self.tree.make_automaton()
        self.any = bool(phrases)
        self.mended = _Mended(phrases, common)

    def every(self, plain: str) -> list[tuple[int, int, int, bool]]:
        """(begin, end, phrase, of several words) in a string of words between single blanks, with a blank at both ends."""
        return [(e - n, e, i, several) for e, (n, i, several) in self.tree.iter(plain)] if self.any else []

    def longest(self, plain: str) -> list[tuple[int, int, int, bool]]:
        """Those of every that are not within a longer one."""
        found = self.every(plain)
        if len(found) < 2:
            return found
        found.sort(key=lambda h: (-h[1], h[0]))
        kept, low = [], len(plain)
        for h in found:
            if h[0] < low:
                kept.append(h)
                low = h[0]
        return kept


@lru_cache(maxsize=4)
def _finder(phrases: tuple[str, ...], common: tuple[str, ...], first: int) -> Finder:
    """One per worker, not one per task."""
    return Finder(phrases, common, first)


def _one_error(a: str, b: str) -> bool:
    """Whether one letter more, less or other, or a swap of neighbours, makes a of b; a plural of b is no error."""
    if a + "s" == b or b + "s" == a:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    x, y = a[i:], b[i:]
    return x[1:] == y[1:] or x[1:] == y or x == y[1:] or (x[:2] == y[:2][::-1] and x[2:] == y[2:])


def blanked(low: str) -> str:
    """A text with a blank for each character that is no letter, digit or zero character."""
    raw = low.encode("utf-8", "surrogatepass")
    out = raw.translate(BLANKS).decode("utf-8", "surrogatepass")
    if not low.isascii():
        odd = [c for c in set(raw.translate(None, ASCII).decode("utf-8", "surrogatepass")) if not c.isalnum()]
        if len(odd) > 20:
            return out.translate(dict.fromkeys(map(ord, odd), " "))
        for c in odd:
            out = out.replace(c, " ")
    return out


def plain_words(low: str, cuts: Iterable[re.Pattern] = ()) -> str:
    """The words of a lower-case text between single blanks, with a blank at both ends and a zero character where it is cut."""
    low = low.replace("\x00", "_").replace("\r", "\n")
    for cut in cuts:
        low = " \x00 ".join(cut.split(low))
    return between_blanks(blanked(low).split())


def between_blanks(words: Sequence[str]) -> str:
    return f" {' '.join(words)} "


def sentences(text: str) -> str:
    return plain_words(text.lower(), SENTENCE)


def description_phrases(text: str | None, finder: Finder) -> set[int]:
    """Every phrase that a description names; in pieces that name none, typing errors are mended (common words are none)."""
    if not text:
        return set()
    low = text.lower()
    plain = plain_words(low, PIECE)
    hits = finder.longest(plain)
    found = {h[2] for h in hits}
    if errors := finder.mended.errors(plain.split()):
        ends, pieces = [m.start() for m in re.finditer("\x00", plain)], plain.split("\x00")
        for k in {bisect(ends, i) for i in places(plain, errors)} - {bisect(ends, h[0]) for h in hits}:
            found |= {h[2] for h in finder.longest(mend(pieces[k], errors))}
    return found or {h[2] for h in finder.longest(plain_words(low))}


def places(plain: str, words: Iterable[str]) -> Iterator[int]:
    """Where the words stand in a string of words between single blanks."""
    for w in words:
        i = plain.find(x := f" {w} ")
        while i >= 0:
            yield i
            i = plain.find(x, i + 1)


def mend(words: str, errors: dict[str, str]) -> str:
    return between_blanks([errors.get(w, w) for w in words.split()])


def document_edges(text: str | None, finder: Finder, nested: bool = False) -> tuple[list[tuple[int, int, int, int]], int, str]:
    """([(phrase, sentence, begin, end)], number of sentences, words) of a document; nested: also phrases within longer ones.

    In sentences that hold no phrase (nested: in all), typing errors are mended (common words are none), for phrases of several words.
    """
    if not text or not text.strip():
        return [], 0, ""
    plain = sentences(text)
    find = finder.every if nested else finder.longest
    hits, errors = find(plain), finder.mended.errors(plain.split())
    if not hits and not errors:
        return [], plain.count("\x00") + 1, plain
    ends = [m.start() for m in re.finditer("\x00", plain)]
    edges = [(p, bisect(ends, b), b, e) for b, e, p, _ in hits]
    if errors:
        done = set() if nested else {x[1] for x in edges}
        starts, old = [0, *(e + 1 for e in ends)], plain.split("\x00")
        for k in sorted({bisect(ends, i) for i in places(plain, errors)} - done):
            edges += [(p, k, starts[k] + b, starts[k] + e) for b, e, p, several in find(mend(old[k], errors)) if several]
    return edges, len(ends) + 1, plain


def _spans(rows: list[list[tuple[int, int, int, int]]]) -> pa.Array:
    flat = np.fromiter(chain.from_iterable(chain.from_iterable(rows)), np.int32).reshape(-1, 4)
    ends = np.cumsum([0, *map(len, rows)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(4)], ["p", "s", "b", "e"]))


def activity_edges(activities: DataFrame, areas: DataFrame, phrases: list[str], common: list[str]) -> DataFrame:
    """Rows (id, seeds, ps): the phrases that the description names."""
    known = activities.sparkSession.sparkContext.broadcast((tuple(phrases), tuple(common)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = _finder(*known.value, 0)
        for b in batches:
            ps = [sorted(description_phrases(t, finder)) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(ps, pa.list_(pa.int32()))], names=["id", "seeds", "ps"])

    return coded(activities, areas).mapInArrow(run, "id long, seeds array<string>, ps array<int>")


def own_phrases(plain: str) -> list[str]:
    """Words, every pair of words, and words joined by a short one, of a text, each once, within sentences."""
    out = set()
    for s in plain.split("\x00"):
        w = [x if x.isalpha() else "" for x in s.split()]
        out.update(x for x in w if x)
        out.update(f"{x} {y}" for x, y in zip(w, w[1:]) if x and y)
        out.update(f"{x} {y} {z}" for x, y, z in zip(w, w[1:], w[2:]) if x and 0 < len(y) < 5 and z)
    return sorted(out)


def _pieces(b: pa.RecordBatch, rows: int = 2000) -> Iterator[pa.RecordBatch]:
    for i in range(0, b.num_rows, rows):
        yield b.slice(i, rows)


def _lists(lists: pa.ListArray) -> list[list[str]]:
    """The lists, a null one empty; each distinct string is made once."""
    flat = lists.flatten().dictionary_encode()
    every, ends = flat.dictionary.to_pylist(), np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)).tolist()
    each = [every[i] for i in flat.indices.to_numpy().tolist()]
    return [each[i:j] for i, j in zip([0, *ends], ends)]


def _other_language(plain: str, common: set[str]) -> bool:
    words = plain.split()
    return bool(common) and sum(w in common for w in words) < SAME_LANGUAGE * len(words)


def document_graph(documents: DataFrame, phrases: list[str], common: list[str]) -> DataFrame:
    """Rows (doc_id, lang, spans, own, text): own has the phrases of texts without a known one, text the texts in few of
    whose sentences one is known, which are searched again; else both are null."""
    known = documents.sparkSession.sparkContext.broadcast((tuple(phrases), tuple(common)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = _finder(*known.value, 0)
        for b in batches:
            for part in _pieces(b):
                spans, own, again = [], [], []
                for t in part.column(1).to_pylist():
                    edges, k, plain = document_edges(t, finder)
                    spans.append(edges)
                    again.append(t if k and len({x[:2] for x in edges}) < SPARSE * k else None)
                    own.append(own_phrases(plain) if k and not edges and _other_language(plain, finder.mended.common) else None)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), _spans(spans), pa.array(own, pa.list_(pa.string())), pa.array(again, pa.string())], names=["doc_id", "lang", "spans", "own", "text"])

    lang = F.lower(F.trim("lang")) if "lang" in documents.columns else F.lit(None).cast("string")
    return documents.select("doc_id", "text", lang.alias("lang")).mapInArrow(run, f"doc_id long, lang string, spans {SPANS}, own array<string>, text string")


def own_edges(texts: DataFrame, phrases: list[str], common: list[str], first: int) -> DataFrame:
    """Rows (doc_id, spans) of these phrases, numbered from first, in texts (doc_id, text)."""
    known = texts.sparkSession.sparkContext.broadcast((tuple(phrases), tuple(common)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = _finder(*known.value, first)
        for b in batches:
            for part in _pieces(b):
                yield pa.RecordBatch.from_arrays([part.column(0), _spans([document_edges(t, finder, True)[0] for t in part.column(1).to_pylist()])], names=["doc_id", "spans"])

    return texts.select("doc_id", "text").mapInArrow(run, f"doc_id long, spans {SPANS}")


def own_candidates(graph: DataFrame, common: list[str], largest: float) -> list[tuple[str, int]]:
    """(phrase, number of texts) of texts without a known phrase: in enough texts of some language label, and in no more of all than one subject accounts for.

    largest: the largest share of a subject. Words in more texts are function words; phrases of nothing else, and of words
    common in the activities, name no subject. The share makes this a list of bounded length.
    """
    texts = graph.where("own is not null")
    size = {r[0]: r[1] for r in texts.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    per = texts.select("lang", F.explode("own").alias("phrase")).groupBy("lang", "phrase").agg(F.count(F.lit(1)).alias("n"))
    least = F.coalesce(*[F.when(F.col("lang").eqNullSafe(F.lit(k)), float(max(LEAST, OWN_LEAST * n))) for k, n in size.items()], F.lit(float(LEAST)))
    df = per.groupBy("phrase").agg(F.sum("n").alias("df"), F.max(F.col("n") >= least).alias("enough"))
    found = df.where("enough").select("phrase", "df").collect()
    most = max(2 * LEAST, OWN_MOST * largest * sum(size.values()))
    function = {p for p, n in found if n > most and " " not in p} | set(common)
    return sorted((p, n) for p, n in found if n <= most and len(p) > 3 and not function.issuperset(p.split()))


def seeded(seeds: DataFrame, edges: DataFrame, ratings: DataFrame) -> DataFrame:
    """Rows (p, subject): what the clamped seeds say to the phrases that codes have verified, the same in every round.

    seeds: p, subject, n (coded activities). edges: doc_id, ps array<int>. ratings: doc_id, subject.
    """
    said = edges.join(ratings, "doc_id").select(F.explode("ps").alias("p"), "subject").groupBy("p", "subject").agg((DAMPING * F.count(F.lit(1))).alias("w"))
    said = said.join(F.broadcast(seeds.select("p").distinct()), "p", "left_semi")
    every = seeds.select("p", "subject", F.col("n").cast("double").alias("w")).unionByName(said).groupBy("p", "subject").agg(F.sum("w").alias("w"))
    return every.groupBy("p").agg(F.max(F.struct("w", "subject")).alias("m")).select("p", "m.subject")


def propagate(edges: DataFrame, ratings: DataFrame, nodes: DataFrame, n_rated: int, n_texts: int, largest: float, rounds: int = ROUNDS) -> DataFrame:
    """Rows (p, subject): the subject of each phrase that gets one in some rounds over the texts that share them.

    edges: doc_id, ps array<int>. ratings: doc_id, subject, which stay as they are. nodes: p, df. n_rated of the n_texts texts
    have ratings.
    """
    rated = cut_lineage(ratings.join(edges.select("doc_id"), "doc_id", "left_semi").groupBy("doc_id").agg(F.collect_set("subject").alias("subjects")))
    nodes = F.broadcast(nodes)
    current, found, labelled = rated, None, n_rated
    for r in range(rounds):
        share = labelled / max(1, n_texts)
        # a null subject counts the labelled texts
        said = edges.join(current, "doc_id").select(F.explode("ps").alias("p"), F.array_append("subjects", F.lit(None).cast("string")).alias("x")).select("p", F.explode("x").alias("subject"))
        per = said.groupBy("p", "subject").agg(F.count(F.lit(1)).alias("w"))
        best = per.groupBy("p").agg(F.max(F.when(F.col("subject").isNotNull(), F.struct("w", "subject"))).alias("m"), F.max(F.when(F.col("subject").isNull(), F.col("w"))).alias("held")).join(nodes, "p")
        # one rated text may err: it is believed only at first and where no second is to be expected
        least = F.when((F.col("df") * share < 1.5) & (F.col("df") <= OWN_SINGLE * largest * n_texts), 1).otherwise(2) if r == 0 else F.lit(2)
        found = cut_lineage(best.where((F.col("m.w") >= OWN_PURITY * F.col("held")) & (F.col("m.w") >= least) & (F.col("held") >= DENSE * share * F.col("df"))).select("p", F.col("m.subject").alias("subject")))
        if r + 1 < rounds:
            score = edges.select("doc_id", F.explode("ps").alias("p")).join(F.broadcast(found), "p").groupBy("doc_id").agg(F.collect_list("subject").alias("x"))
            counted = F.transform(F.array_distinct("x"), lambda k: F.struct(k.alias("subject"), F.size(F.filter("x", lambda x: x == k)).alias("n")))
            score = score.select("doc_id", counted.alias("x")).withColumn("most", F.array_max(F.transform("x", lambda x: x["n"])))
            taken = F.transform(F.filter("x", lambda x: (x["n"] >= TAKES) & (x["n"] >= TAKES_SHARE * F.col("most"))), lambda x: x["subject"])
            spread = score.select("doc_id", taken.alias("subjects")).where(F.size("subjects") > 0)
            current = cut_lineage(spread.join(rated.select("doc_id"), "doc_id", "left_anti").unionByName(rated))
            labelled = current.count()
    return found


def document_subjects(known: DataFrame, nested: DataFrame, labels: DataFrame, ratings: DataFrame) -> DataFrame:
    """Rows (doc_id, subjects): the only subject of a document, or of several those of two sentences or more, and its ratings.

    known, nested: doc_id, spans. In nested a phrase does not count within a longer labelled one. A rating is kept if a phrase
    of its subject stands in the document or no phrase is known there; else the text contradicts it.
    """
    hits = lambda df: df.select("doc_id", F.explode("spans").alias("x")).select("doc_id", "x.*").join(F.broadcast(labels), "p")
    before = Window.partitionBy("doc_id").orderBy(F.desc("e"), "b").rowsBetween(Window.unboundedPreceding, -1)
    outer = hits(nested.repartition("doc_id")).withColumn("low", F.min("b").over(before)).where("low is null or b < low")
    rows = hits(known).unionByName(outer, allowMissingColumns=True).select("doc_id", F.struct("subject", "s").alias("x")).unionByName(ratings.select("doc_id", F.struct("subject", F.lit(-1).alias("s")).alias("x")))
    per = rows.groupBy("doc_id").agg(F.collect_set("x").alias("x"))
    per = per.select("doc_id", F.filter("x", lambda x: x["s"] >= 0).alias("x"), F.transform(F.filter("x", lambda x: x["s"] < 0), lambda x: x["subject"]).alias("rated"))
    per = per.withColumn("named", F.array_distinct(F.transform("x", lambda x: x["subject"])))
    dealt = F.filter("named", lambda k: (F.size("named") == 1) | (F.size(F.filter("x", lambda x: x["subject"] == k)) > 1))
    clamped = F.when(F.size("named") == 0, F.col("rated")).otherwise(F.array_intersect("rated", "named"))
    return per.select("doc_id", F.array_union(dealt, clamped).alias("subjects"))


def activity_subjects(named: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (id, subject) of activity_edges: the labels of the phrases named, or the seeds if none is. named is read once."""
    phrase = F.transform("ps", lambda p: F.struct(p.alias("p"), F.lit(None).cast("string").alias("seed")))
    seed = F.transform("seeds", lambda k: F.struct(F.lit(None).cast("int").alias("p"), k.alias("seed")))
    each = named.select("id", F.explode(F.when(F.size("ps") > 0, phrase).otherwise(seed)).alias("x")).select("id", "x.p", "x.seed")
    return each.join(F.broadcast(labels), "p", "left").select("id", F.coalesce("subject", "seed").alias("subject")).where("subject is not null")


def subjects(activities: DataFrame, documents: DataFrame, areas: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (rec_kind, rec_id, subject), distinct: every record with each subject it deals with.

    activities: id, description, issue_code. documents: doc_id, text, and lang if there is one. areas: subject, issue_codes.
    labels: doc_id, subject. Null and blank texts name nothing (an activity then has the subject of its issue code). Records
    with a null id are left out. Copies of a record get the same subjects; rows of one doc_id are read as one document.
    """
    spark = activities.sparkSession
    activities = activities.where("id is not null")
    documents = documents.where("doc_id is not null")
    records = coded(activities, areas)
    seen = cut_lineage(seed_counts(records))
    sizes = {r[0]: r[1] for r in seen.where("what = 'size'").select("subject", "n").collect()}
    n = sum(sizes.values())
    sizes.pop(None, None)
    counts = seen.where("what = 'phrase'").select(F.col("text").alias("phrase"), "subject", "n")
    phrases, leads = learn_phrases(counts, sizes)
    common = [r[0] for r in seen.where((F.col("what") == "word") & (F.col("n") >= max(2 * LEAST, COMMON * n))).select("text").collect()]
    graph = cut_lineage(document_graph(documents, phrases, common))
    rated = labels.where("doc_id is not null and subject is not null").select("doc_id", "subject").distinct()
    rated = cut_lineage(rated.join(graph.select("doc_id"), "doc_id", "left_semi"))
    shares = [r[0] for r in rated.groupBy("subject").agg(F.count(F.lit(1)).alias("n")).select("n").collect()]
    largest = max(shares, default=1) / max(1, sum(shares)) if shares else 1.0
    own = own_candidates(graph, common, largest)
    nested = cut_lineage(own_edges(graph.where("text is not null"), [p for p, _ in own], common, len(phrases)))
    numbers = spark.createDataFrame(list(enumerate(phrases)), "p int, phrase string")
    seeds = without_leads(counts, leads).join(F.broadcast(numbers), "phrase").where("subject is not null").groupBy("p", "subject").agg(F.sum("n").alias("n"))
    ids = F.array_distinct(F.transform("spans", lambda x: x["p"]))
    fixed = seeded(cut_lineage(seeds), graph.where("size(spans) > 0").select("doc_id", ids.alias("ps")), rated)
    nodes = spark.createDataFrame([(i, k) for i, (_, k) in enumerate(own, len(phrases))], "p int, df long")
    unknown = graph.where("own is not null").select("doc_id")  # other texts hear their phrases, but teach them nothing
    n_texts, n_rated = unknown.count(), rated.join(unknown, "doc_id", "left_semi").select("doc_id").distinct().count()
    edges = nested.where("size(spans) > 0").join(unknown, "doc_id", "left_semi").select("doc_id", ids.alias("ps"))
    found = fixed.unionByName(propagate(cut_lineage(edges), rated, nodes, n_rated, n_texts, largest)) if own else fixed
    found = cut_lineage(found)
    docs = document_subjects(graph.select("doc_id", "spans", F.col("text").isNotNull().alias("again")).where("not again").drop("again"), nested.unionByName(graph.where("text is not null").select("doc_id", "spans")), found, rated)
    acts = activity_subjects(activity_edges(activities, areas, phrases, common), found)
    docs = docs.select(F.lit("document").alias("rec_kind"), F.col("doc_id").alias("rec_id"), F.explode("subjects").alias("subject"))
    return acts.select(F.lit("activity").alias("rec_kind"), F.col("id").alias("rec_id"), "subject").unionByName(docs).distinct()
