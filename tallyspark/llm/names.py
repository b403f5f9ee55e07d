"""Variant spellings of names typed by people (problem 5).

A name is read as what it stands for: the client behind an intermediary, a former name beside the present one, without
legal form, acronym of itself and words like 'and affiliates'. Its frequent words (trades, kinds of organisation, given
names; short forms and nicknames written out) must agree, which keeps sister companies and chapters apart. Its rare words
may differ by typing errors: a prefix-filtered join on their q-grams (rarest first) finds candidates, and a soft token
similarity, in which rare tokens weigh more, decides. Linked spellings are joined to components by iterated joins.

Spellings are numbered by a 64-bit hash, so that the joins are on long numbers.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import permutations

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyspark.llm.spans import pairs_within
from tallyspark.session import cut_lineage, spread

Q = 4
#: Typing errors between two spellings that the prefix filter is sure to pass: one destroys at most Q + 1 grams (a letter Q
#: and that of all letters, a swap Q + 1), so of the rarest ERRORS * (Q + 1) + 1 two such spellings share one. Spellings further apart are linked through those between them.
ERRORS = 1
PREFIX = ERRORS * (Q + 1) + 1
#: Errors that the verification accepts in a name: names that differ in two are as often two names.
MOST_EDITS = 1
LEAST_SIMILARITY = 0.8
#: A word is frequent if at least this share of the distinct spellings holds it (and 10 at least): so there are at most 1 / share * words per name.
FREQUENT_SHARE = 0.002
#: Words and grams of a smaller share of the spellings all count as equally rare; it bounds the lists of the others to 1 / share * words (grams) per name.
COUNTED_SHARE = 2e-4

# Fixed values.
SMALL_WORDS = set("a an and at by for in of on the to y de".split())
LEGAL_FORMS = set("inc incorporated corp corporation co company llc llp lp lc ltd limited liability plc pllc pc pa gmbh sa nv bv".split())
FIRM_WORDS = set("group partners advisors strategies consulting associates esq esquire jr sr ii iii iv mr mrs ms dr".split())
SHORT_FORMS = {
    "adv": "advisors", "advs": "advisors", "adviser": "advisors", "advisers": "advisors", "advisor": "advisors", "admin": "administration",
    "assn": "association", "assoc": "association", "asso": "association", "auth": "authority", "bros": "brothers", "chem": "chemical", "chems": "chemical", "comm": "communications", "comms": "communications",
    "consltg": "consulting", "consult": "consulting", "conslt": "consulting", "dev": "development", "devel": "development", "dist": "district", "eng": "engineering", "engg": "engineering", "engr": "engineering",
    "engrg": "engineering", "env": "environmental", "environ": "environmental", "envtl": "environmental", "fin": "financial", "finl": "financial", "govt": "government", "grp": "group", "hldg": "holdings", "hldgs": "holdings",
    "hosp": "hospital", "ins": "insurance", "inst": "institute", "intl": "international", "lab": "laboratories", "labs": "laboratories", "med": "medical", "mfg": "manufacturing", "mfr": "manufacturing", "mgmt": "management",
    "mgt": "management", "natl": "national", "pharm": "pharmaceuticals", "pharma": "pharmaceuticals", "ptnrs": "partners", "rr": "railway", "rwy": "railway", "ry": "railway", "semi": "semiconductor", "st": "state",
    "strat": "strategies", "strategy": "strategies", "strats": "strategies", "svc": "services", "svcs": "services", "sys": "systems", "tech": "technologies", "techs": "technologies", "u": "university", "univ": "university",
    "util": "utilities", "utils": "utilities", "cty": "county", "cnty": "county", "dept": "department", "ctr": "center", "semicon": "semiconductor", "logis": "logistics",
}
#: Words for a body of members, which people use for one another ('Tile Makers Alliance of X', 'Assoc. of Tile Makers - X').
SHORT_FORMS |= dict.fromkeys("all alli allnce alliance".split(), "association")
GENERIC = set(SHORT_FORMS.values())
NICKNAMES = {
    "abigail": "abby gail", "alexander": "alex sandy", "andrew": "andy drew", "anthony": "tony", "barbara": "barb babs", "benjamin": "ben benny", "catherine": "cathy", "charles": "charlie chuck chas", "christopher": "chris kit",
    "cynthia": "cindy", "daniel": "dan danny", "david": "dave davy", "deborah": "deb debbie debby debra", "donald": "don donny", "dorothy": "dot dottie", "edward": "ed eddie ned ted", "elizabeth": "liz beth betty eliza lizzie betsy",
    "frances": "fran franny frankie", "francis": "frank", "gregory": "greg", "henry": "harry hank", "james": "jim jimmy jamie", "jennifer": "jen jenny", "john": "jack johnny", "jonathan": "jon", "joseph": "joe joey",
    "joshua": "josh", "katherine": "kate kathy katie kay kitty kathryn", "kenneth": "ken kenny", "lawrence": "larry laurence", "leonard": "len lenny", "margaret": "maggie meg peggy marge", "martha": "marty", "matthew": "matt",
    "michael": "mike mick mickey", "nancy": "nan", "nathaniel": "nate nat", "nicholas": "nick nicky", "pamela": "pam", "patricia": "pat patty trish tricia", "patrick": "paddy", "peter": "pete", "philip": "phil", "raymond": "ray",
    "rebecca": "becky becca", "richard": "rich rick dick ricky", "robert": "bob rob bobby robbie", "ronald": "ron ronnie", "samuel": "sam sammy", "sandra": "sandy", "stephen": "steve steven", "susan": "sue susie suzy", "theodore": "theo teddy",
    "thomas": "tom tommy", "timothy": "tim timmy", "victoria": "vicky vicki tori", "vincent": "vince vinny", "virginia": "ginny", "walter": "walt", "william": "bill will billy willy liam",
}
FORMAL = {n: full for full, ns in NICKNAMES.items() for n in ns.split()}
GIVEN = set(NICKNAMES)

ALONE = re.compile(r"[(\"]\s*([^\W_]+)\s*[)\"]|^\s*([^\W_]+)\s+-\s|\s-\s+([^\W_]+)\s*$")
BEHALF = re.compile(r"^.*?\b(?:on\s+behalf\s+of|o\.?b\.?o\.?)\s+(.+?)\)?\s*$", re.I | re.S)
FORMER = re.compile(r"[\s,(\[]*\b(?:f/?k/?a|f\.k\.a\.|formerly(?:\s+known\s+as)?|previously(?:\s+known\s+as)?|n/?k/?a|now\s+known\s+as|d/?b/?a|a/?k/?a|also\s+known\s+as)\b\.?:?\s*", re.I)
AFFILIATES = re.compile(r"[\s,]*\b(?:and|&)\s+(?:its\s+|their\s+|all\s+)*(?:subsidiar\w+|affiliat\w+)(?:\s+(?:and|&)\s+(?:subsidiar\w+|affiliat\w+))?\s*$", re.I)


def fold(s: str) -> str:
    s = unicodedata.normalize("NFKD", s)
    return re.sub(r"\s+", " ", "".join(c for c in s if not unicodedata.combining(c))).strip()


def readings(name: str | None) -> list[str]:
    """What a typed name stands for: one string, or more if it gives former names; none if null or blank."""
    s = fold(name or "")
    if m := BEHALF.match(s):
        s = m[1]
    out = []
    for part in FORMER.split(s):
        part = part.strip(" ,;[]")
        if part.count(")") > part.count("("):
            part = part.rstrip(") ")
        part = AFFILIATES.sub("", part.lstrip("( ")).strip(" ,;")
        if part:
            out.append(part)
    return out


def words_of(reading: str) -> list[str]:
    """Lower-case words of a reading, without the acronym of itself, small words and legal forms; short forms and nicknames written out."""
    s = reading.lower().replace("’", "'")
    s = re.sub(r"(?<=\b[a-z])\.(?=[a-z]\b)", "", s)  # l.l.c. -> llc
    s = re.sub(r"ass'n|assoc'n", "assn", s).replace("'", "")
    s = re.sub(r"^co\.?\s+of\b", "county of", s)
    raw = re.findall(r"[^\W_]+|[\"()]|\s-\s", s)
    plain = [w for w in raw if w[0].isalnum()]
    lone = {w for m in ALONE.findall(s) for w in m if len(w) > 1} if '"' in s or "(" in s or " - " in s else ()
    keep = [w for i, w in enumerate(plain) if not (w in lone and _initials(w, plain[:i] + plain[i + 1 :]))]
    out = [FORMAL.get(w, w) for w in (SHORT_FORMS.get(w, w) for w in keep) if w not in SMALL_WORDS and w not in LEGAL_FORMS]
    return out or keep


def _initials(w: str, rest: list[str]) -> bool:
    at = 0
    for r in rest:
        if at < len(w) and r[0] == w[at]:
            at += 1
    return at == len(w) and len(w) >= sum(r not in SMALL_WORDS and r not in LEGAL_FORMS for r in rest) - 1


def near(a: str, b: str) -> int:
    """Edits between two words, a swap of neighbours counted as one (optimal string alignment)."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > MOST_EDITS or _bag_distance(a, b) > 2 * MOST_EDITS:
        return MOST_EDITS + 1
    before, last = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            d = min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            row.append(d)
        before, last = last, row
    return last[-1]


def _bag_distance(a: str, b: str) -> int:
    """Letters of one word that the other has not, both ways; an edit changes two at most."""
    out = len(a) + len(b)
    for c in set(a):
        out -= 2 * min(a.count(c), b.count(c))
    return out


def _deletions(w: str) -> Iterator[str]:
    yield w
    for i in range(len(w)):
        yield w[:i] + w[i + 1 :]


class Reader:
    """Splits words into the frequent ones (typing errors in them mended) and the rare ones."""

    def __init__(self, frequent: Iterable[str]):
        self.frequent = set(frequent) | GENERIC | GIVEN
        self.by_deletion: dict[str, set[str]] = {}
        for w in self.frequent:
            if len(w) >= 5:
                for d in _deletions(w):
                    self.by_deletion.setdefault(d, set()).add(w)

    def mend(self, w: str) -> str:
        if w in GENERIC or len(w) < 4:
            return w
        if w + "s" in self.frequent:
            return w + "s"
        if len(w) > 4 and len(longer := [g for g in GENERIC if g.startswith(w)]) == 1:
            return longer[0]
        if w in self.frequent:
            return w
        if w[-1] == "y" and w[:-1] + "ies" in self.frequent:
            return w[:-1] + "ies"
        if w[-1] == "s" and w[:-1] in self.frequent:
            return w[:-1]
        close = {c for d in _deletions(w) for c in self.by_deletion.get(d, ()) if near(w, c) <= 1}
        return min(close) if close else w

    def read_all(self, reading: str) -> list[tuple[str, list[str]]]:
        """What read gives; for a person whose middle initial is given also the reading with the initials alone, which others may have typed."""
        signature, rare = self.read(reading)
        words = [self.mend(w) for w in words_of(reading)]
        letters, given = [w for w in words if len(w) == 1], [w for w in words if w in GIVEN]
        if len(rare) == 1 and len(rare[0]) > 1:
            if len(given) == 1 and len(letters) == 1 and signature == given[0]:
                return [(signature, rare), (f"initials {given[0][0]}{letters[0]}", rare)]
            if len(letters) == 2 and not signature:
                return [(f"initials {''.join(letters)}", rare)]
        return [(signature, rare)]

    def read(self, reading: str) -> tuple[str, list[str]]:
        """(signature: the frequent words in order of the alphabet, rare words as they stand)."""
        mended = [self.mend(w) for w in words_of(reading)]
        person = any(w in GIVEN for w in mended)
        if any(w in FIRM_WORDS for w in mended) and len(mended) > 1:
            mended = [w for w in mended if w not in FIRM_WORDS] or mended
        rare = [w for w in mended if w not in self.frequent]
        if person or len(rare) > 1:
            rare = [w for w in rare if len(w) > 1] or rare  # middle initials
        return " ".join(sorted({w for w in mended if w in self.frequent})), rare


def grams(rare: list[str]) -> set[str]:
    """Q-grams of the words with marked ends, and all letters in order of the alphabet, which neither a swap nor another order or division of the words changes."""
    return {w[i : i + Q] for w in (f"^^{r}$$" for r in rare) for i in range(len(w) - Q + 1)} | {"=" + "".join(sorted("".join(rare)))}


def similarity(a: list[str], b: list[str], weight: dict[str, float] | None = None, usual: float = 10.0) -> float:
    """Soft weighted token similarity, 0 to 1: each word is matched with its nearest on the other side, rare words weigh more.

    weight: of words; all others have the usual one. Words joined or divided differently count as one word. More than
    MOST_EDITS errors in all make it too small.
    """
    if not a or not b:
        return float(a == b)
    x, y = "".join(a), "".join(b)
    if len(a) != len(b):
        if abs(len(x) - len(y)) > 1 or max(len(a), len(b)) > 4:
            return 1.0 if x == y else 0.0
        joined = min(near("".join(p), "".join(q)) for p in permutations(a) for q in permutations(b))
        return 1 - joined / max(len(x), len(y)) if joined <= 1 else 0.0
    left, total, got, edits = list(b), 0.0, 0.0, 0
    for w in sorted(a, key=lambda w: (w not in b, -len(w), w)):
        best = min(left, key=lambda v: (near(w, v), v))
        left.remove(best)
        n = (weight or {}).get(w, usual)
        total += n
        d = near(w, best)
        edits += d
        got += n * (1 - d / max(len(w), len(best)) if d <= MOST_EDITS else 0)
    if edits > MOST_EDITS:
        return 1.0 if x == y else min(got / total, LEAST_SIMILARITY / 2)
    return got / total


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Rows (node, comp) of the nodes of edges (a, b): comp is the smallest node reachable. Each round is two joins, written to the shared folder.

    A round also jumps to the label of the label, so the rounds grow with the logarithm of the longest chain.
    """
    both = cut_lineage(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    # the first round needs no join
    linked = cut_lineage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("comp")))
    for _ in range(most_rounds):
        heard = both.join(linked, both.b == linked.node).groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("heard"))
        stepped = linked.join(heard, "node").select("node", F.least("comp", "heard").alias("comp"), F.col("comp").alias("old"))
        jump = linked.select(F.col("node").alias("comp"), F.col("comp").alias("further"))
        after = cut_lineage(stepped.join(jump, "comp", "left").select("node", F.least("comp", F.coalesce("further", "comp")).alias("comp"), "old"))
        linked = after.select("node", "comp")
        if after.where("comp < old").isEmpty():
            return linked
    raise RuntimeError("components did not settle")


def spellings(rows: DataFrame, id_col: str, name_cols: list[str], party: str) -> DataFrame:
    """Rows (party, id, reading) of what the names of a row stand for, distinct within a row."""
    kind = rows.schema[id_col].dataType.simpleString()

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names = zip(*(c.to_pylist() for c in b.columns[1:]))
            found = [sorted({r for n in row if isinstance(n, str) for r in readings(n)}) for row in names]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(pa.string()))], names=["id", "found"])

    read_rows = rows.where(F.col(id_col).isNotNull()).select(id_col, *name_cols).mapInArrow(read, f"id {kind}, found array<string>")
    return read_rows.select(F.lit(party).alias("party"), "id", F.explode("found").alias("reading"))


def counted_words(readings_df: DataFrame) -> dict[str, tuple[int, dict[str, int]]]:
    """Of each party, the number of distinct readings, and the words in a share of COUNTED_SHARE of them (and 3 at least) with in how many: lists of bounded length whatever the input."""

    def split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = [[w for w in set(words_of(r)) if len(w) > 1] for r in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(words, pa.list_(pa.string()))], names=["party", "words"])

    distinct = cut_lineage(spread(readings_df.select("party", "reading").distinct()))
    sizes = {r[0]: r[1] for r in distinct.groupBy("party").agg(F.count(F.lit(1)).alias("n")).collect()}
    per = distinct.mapInArrow(split, "party string, words array<string>").select("party", F.explode("words").alias("word")).groupBy("party", "word").agg(F.count(F.lit(1)).alias("n"))
    out = {p: (n, {}) for p, n in sizes.items()}
    for r in per.where(F.col("n") >= _least(sizes)).collect():
        out[r.party][1][r.word] = r.n
    return out


def _least(sizes: dict[str, int]):
    return F.coalesce(*[F.when(F.col("party") == p, float(max(3, COUNTED_SHARE * n))) for p, n in sizes.items()], F.lit(3.0))


def frequent_words(n: int, counts: dict[str, int], share: float = FREQUENT_SHARE) -> list[str]:
    return sorted(w for w, k in counts.items() if k >= max(10, share * n))


def word_weights(n: int, counts: dict[str, int]) -> tuple[dict[str, float], float]:
    """(weights of the counted words, weight of all rarer ones): the logarithm of how many spellings there are to one with the word."""
    return {w: max(0.1, math.log(n / k)) for w, k in counts.items()}, max(1.0, math.log(min(n, 1 / COUNTED_SHARE) if n > 1 else 2))


@lru_cache(maxsize=8)
def _reader(frequent: tuple[str, ...]) -> Reader:
    """One per worker, not one per task."""
    return Reader(frequent)


def linked_rows(tables: dict[str, DataFrame], id_col: str = "id", name_cols: tuple[str, ...] = ("name", "normalized_name")) -> DataFrame:
    """Rows (party, id, comp): comp is the same for all rows of a table whose names stand for one party. Rows without any name are left out.

    tables: by the name of the party, all worked on in one plan. Rows of different tables are never linked.
    """
    sc = next(iter(tables.values())).sparkSession.sparkContext
    every = [spellings(df, id_col, list(name_cols), party) for party, df in tables.items()]
    read = every[0]
    for df in every[1:]:
        read = read.unionByName(df)
    read = cut_lineage(read)
    counted = counted_words(read)
    frequent = {p: tuple(frequent_words(n, c)) for p, (n, c) in counted.items()}
    known = sc.broadcast((frequent, {p: word_weights(n, c) for p, (n, c) in counted.items()}))

    def key(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = {n: [] for n in ("party", "id", "key", "grams")}
            for party, i, r in zip(*(c.to_pylist() for c in b.columns)):
                for signature, rare in _reader(known.value[0][party]).read_all(r):
                    for n, v in zip(out, (party, i, f"{signature}|{' '.join(sorted(rare))}", sorted(grams(rare)) if rare else [])):
                        out[n].append(v)
            types = (pa.string(), b.schema.field(1).type, pa.string(), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types)], names=list(out))

    kind = read.schema["id"].dataType.simpleString()
    keyed = spread(read).mapInArrow(key, f"party string, id {kind}, key string, grams array<string>").withColumn("k", F.xxhash64("party", "key"))
    keyed = cut_lineage(keyed.select("party", "id", "key", "grams", "k"))
    keys = cut_lineage(keyed.groupBy("k").agg(F.first("party").alias("party"), F.first("key").alias("key"), F.first("grams").alias("grams")))
    sizes = {p: n for p, (n, _) in counted.items()}
    often = keys.select("party", F.explode("grams").alias("gram")).groupBy("party", "gram").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= _least(sizes)).collect()
    common = sc.broadcast({(r.party, r.gram): r.n for r in often})

    def prefix(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            df = common.value
            first = [sorted(gs, key=lambda g: (df.get((party, g), 0), g))[:PREFIX] for party, gs in zip(b.column(1).to_pylist(), b.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(first, pa.list_(pa.string()))], names=["k", "party", "key", "grams"])

    cut = keys.where("size(grams) > 0").mapInArrow(prefix, "k long, party string, key string, grams array<string>")
    # only spellings with the same frequent words meet, and large groups of them in blocks
    cut = cut.select("*", F.explode("grams").alias("gram")).select(F.xxhash64("party", F.substring_index("key", "|", 1), "gram").alias("k"), F.struct("k", "party", "key").alias("id"))
    candidates = pairs_within(cut).distinct()

    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = []
            for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                (sa, ra), (sb, rb) = x["key"].rsplit("|", 1), y["key"].rsplit("|", 1)
                ok.append(x["party"] == y["party"] and sa == sb and similarity(ra.split(), rb.split(), *known.value[1][x["party"]]) >= LEAST_SIMILARITY)
            yield pa.RecordBatch.from_arrays([c.field("k") for c in b.columns], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    similar = candidates.mapInArrow(verify, "a long, b long")
    # the spellings of one row stand for one party
    row_keys = keyed.select("party", "id", "k")
    first = row_keys.groupBy("party", "id").agg(F.min("k").alias("node"), F.collect_set("k").alias("ks"))
    first = cut_lineage(first)
    same_row = first.where("size(ks) > 1").select(F.col("node").alias("a"), F.explode("ks").alias("b")).where("a <> b").distinct()
    comps = components(similar.unionByName(same_row))
    return first.join(comps, "node", "left").select("party", "id", F.coalesce("comp", "node").alias("comp"))


def linked_pairs(comps: DataFrame) -> DataFrame:
    """Distinct pairs (party, id_a, id_b), smaller id first, of the rows of one party; large parties meet in blocks."""
    rows = comps.select(F.struct("party", "comp").alias("k"), F.struct("id", "party").alias("id")).distinct()
    return pairs_within(rows).select("a.party", F.col("a.id").alias("id_a"), F.col("b.id").alias("id_b"))
