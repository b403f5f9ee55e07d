"""Mapping free-entered values to a canonical list (problem 3) by BK-trees under the Levenshtein distance.

A tree returns every entry within the threshold; the triangle inequality prunes the rest. A list of checked size is
broadcast; a longer one is cut into shards, each searched by its own tree, and the winners of the shards are merged.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tallyspark.session import spread

#: Reference entries up to which the list is broadcast to all workers.
MOST_BROADCAST = 50_000
#: Keys that one task searches in one shard of a longer list.
KEYS_PER_BLOCK = 200_000


def edit_distance(a: str, b: str) -> int:
    """Levenshtein distance, a metric, by bit vectors: one step per character of b."""
    if not a or not b:
        return len(a) or len(b)
    return _distance_to(_masks(a), len(a), b)


def _masks(a: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


def _distance_to(masks: dict[str, int], n: int, b: str) -> int:
    full, high = (1 << n) - 1, 1 << (n - 1)
    up, down, d = full, 0, n
    for c in b:
        eq = masks.get(c, 0)
        x = eq | down
        y = ((eq & up) + up) ^ up | eq
        rise, fall = down | ~(y | up) & full, up & y
        d += bool(rise & high) - bool(fall & high)
        rise, fall = (rise << 1 | 1) & full, (fall << 1) & full
        up, down = fall | ~(x | rise) & full, rise & x
    return d


class BKTree:
    """Entries (string keys) by their distance to the entry above them."""

    def __init__(self, keys: Iterable[str]):
        self.keys: list[str] = []
        self.below: list[dict[int, int]] = []
        for k in sorted(set(keys)):
            self._add(k)

    def _add(self, key: str) -> None:
        at, masks = 0, _masks(key)
        if self.keys:
            while True:
                d = _distance_to(masks, len(key), self.keys[at]) if key and self.keys[at] else len(key) or len(self.keys[at])
                if d not in self.below[at]:
                    break
                at = self.below[at][d]
            self.below[at][d] = len(self.keys)
        self.keys.append(key)
        self.below.append({})

    def within(self, key: str, most: int) -> list[tuple[int, str]]:
        """(distance, entry) of every entry at most that far, nearest first."""
        if not self.keys:
            return []
        masks, n, found, todo = _masks(key), len(key), [], [0]
        while todo:
            at = todo.pop()
            other = self.keys[at]
            d = _distance_to(masks, n, other) if n and other else n or len(other)
            if d <= most:
                found.append((d, other))
            todo.extend(child for edge, child in self.below[at].items() if d - most <= edge <= d + most)
        return sorted(found)


class FlatTree:
    """A BK-tree as arrays, searched for many keys at once: level by level, all (key, node) pairs of a level in one bit-vector pass."""

    WORD = 64

    def __init__(self, tree: BKTree):
        self.tree = tree
        self.sizes = np.array([len(k) for k in tree.keys], dtype=np.int64)
        letters = sorted({c for k in tree.keys for c in k})
        self.index = {c: i for i, c in enumerate(letters)}
        self.chars = np.zeros((len(tree.keys), max(1, self.sizes.max(initial=0))), dtype=np.int64)
        for i, k in enumerate(tree.keys):
            self.chars[i, : len(k)] = [self.index[c] for c in k]
        below = [sorted(b.items()) for b in tree.below]
        self.count = np.array([len(b) for b in below], dtype=np.int64)
        self.start = np.cumsum(self.count) - self.count
        self.edges = np.array([e for b in below for e, _ in b], dtype=np.int64)
        self.children = np.array([c for b in below for _, c in b], dtype=np.int64)

    def within_many(self, keys: list[str], most: list[int]) -> list[list[tuple[int, str]]]:
        """For each key what BKTree.within gives."""
        out: list[list[tuple[int, str]]] = [[] for _ in keys]
        short = [i for i, k in enumerate(keys) if 0 < len(k) <= self.WORD]
        for i in set(range(len(keys))) - set(short):
            out[i] = self.tree.within(keys[i], most[i])
        if not short or not self.tree.keys:
            return out
        masks = np.zeros((len(short), len(self.index) or 1), dtype=np.uint64)
        for row, i in enumerate(short):
            for bit, c in enumerate(keys[i]):
                if (at := self.index.get(c)) is not None:
                    masks[row, at] |= np.uint64(1 << bit)
        n = np.array([len(keys[i]) for i in short], dtype=np.int64)
        limit = np.array([most[i] for i in short], dtype=np.int64)
        q, node = np.arange(len(short)), np.zeros(len(short), dtype=np.int64)
        while len(q):
            d = self._distances(masks, n, q, node)
            for k in np.flatnonzero(d <= limit[q]):
                out[short[q[k]]].append((int(d[k]), self.tree.keys[node[k]]))
            times = self.count[node]
            first = np.repeat(np.cumsum(times) - times, times)
            at = np.repeat(self.start[node], times) + np.arange(times.sum()) - first
            q, d = np.repeat(q, times), np.repeat(d, times)
            near = np.abs(self.edges[at] - d) <= limit[q]
            q, node = q[near], self.children[at[near]]
        return [sorted(x) for x in out]

    def _distances(self, masks: np.ndarray, n: np.ndarray, q: np.ndarray, node: np.ndarray) -> np.ndarray:
        order = np.argsort(-self.sizes[node], kind="stable")
        qs, nodes = q[order], node[order]
        sizes = self.sizes[nodes]
        high = np.uint64(1) << (n[qs] - 1).astype(np.uint64)
        up, down, d, one = np.full(len(qs), ~np.uint64(0)), np.zeros(len(qs), dtype=np.uint64), n[qs].copy(), np.uint64(1)
        for t in range(int(sizes.max(initial=0))):
            k = int(np.searchsorted(-sizes, -t, side="left"))  # pairs whose node is longer than t come first
            eq, u, w = masks[qs[:k], self.chars[nodes[:k], t]], up[:k], down[:k]
            x = eq | w
            y = ((eq & u) + u) ^ u | eq
            rise, fall = w | ~(y | u), u & y
            d[:k] += ((rise & high[:k]) != 0).astype(np.int64) - ((fall & high[:k]) != 0)
            rise, fall = rise << one | one, fall << one
            up[:k], down[:k] = fall | ~(x | rise), rise & x
        out = np.empty(len(q), dtype=np.int64)
        out[order] = d
        return out


def nearest(tree: FlatTree, keys: Iterable[str]) -> dict[str, tuple[int, str] | None]:
    """Of each key the nearest entry within its tolerance (of ties the smaller), or None."""
    todo = sorted(set(keys))
    return {k: (hits[0] if hits else None) for k, hits in zip(todo, tree.within_many(todo, [tolerance(k) for k in todo]))}


def tolerance(key: str) -> int:
    """Edits allowed for a key: none below 5 characters, 1 below 12, else 2 (a swap of two letters is two edits)."""
    return 0 if len(key) < 5 else 1 if len(key) < 12 else 2


def closest(entries: DataFrame, reference: DataFrame, key_col: str = "key", shards: int = 0, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """Rows (key, ref_key, distance): for each distinct key of entries the nearest key of reference within its tolerance.

    Ties go to the smaller key. Keys without any are reported with nulls; null keys are left out. shards: 0 to choose by
    size (one broadcast tree up to most_broadcast entries).
    """
    keys = entries.select(F.col(key_col).alias("key")).where("key is not null").distinct()
    ref = reference.select(F.col(key_col).alias("ref_key")).where("ref_key is not null").distinct()
    if not shards:
        n = ref.limit(most_broadcast + 1).count()
        shards = 1 if n <= most_broadcast else -(-ref.count() // most_broadcast)
    schema = "key string, ref_key string, distance int"

    def search(tree: BKTree, wanted: Iterable[str]) -> pd.DataFrame:
        best = [(k, *(hit[::-1] if hit else (None, None))) for k, hit in nearest(FlatTree(tree), wanted).items()]
        return pd.DataFrame(best, columns=["key", "ref_key", "distance"]).astype({"distance": "Int32"})

    if shards == 1:
        known = entries.sparkSession.sparkContext.broadcast([r[0] for r in ref.collect()])

        keys = spread(keys)

        def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            tree = BKTree(known.value)
            for f in frames:
                yield search(tree, f.key)

        return keys.mapInPandas(run, schema)

    def shard(_: tuple, wanted: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        return search(BKTree(own.ref_key), wanted.key)

    # each shard of the list meets the keys in blocks, so no task holds all of either side
    blocks = blocks_of(keys)
    every = keys.select("key", F.pmod(F.xxhash64("key"), F.lit(blocks).cast("long")).alias("block"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    parts = ref.select("ref_key", F.pmod(F.xxhash64("ref_key"), F.lit(shards)).cast("int").alias("shard"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"))
    found = every.groupBy("shard", "block").cogroup(parts.groupBy("shard", "block")).applyInPandas(shard, schema)
    best = found.groupBy("key").agg(F.min(F.when(F.col("ref_key").isNotNull(), F.struct("distance", "ref_key"))).alias("x"))
    return best.select("key", "x.ref_key", "x.distance")


# --- entries that name bills and agencies -------------------------------------------------------------------------

BILL = re.compile(r"(?<![a-z0-9])(h\.?\s*r\.?|h\.?\s*b\.?|house\s+bill|s\.?|s\.?\s*b\.?|senate\s+bill)\s*(?:no\.?\s*)?(\d{1,5})(?![\d-])")
LAW = re.compile(r"(?<![a-z0-9])(?:p\.?\s*l\.?|pub(?:lic)?\.?\s*l(?:aw)?\.?)\s*(?:no\.?\s*)?(\d{2,3})\s*-\s*(\d+)")
CONGRESS = re.compile(r"\(?(?:of\s+the\s+)?(\d{2,3})(?:st|nd|rd|th)\b\.?(?:\s+cong(?:ress|r)?\b\.?)?\)?")
YEAR = re.compile(r"\b(?:of\s+)?((?:19|20)\d\d)\b")
LEAD = re.compile(r"^(?:(?:implementation|enactment|provisions|passage)\s+of|(?:issues|matters)?\s*(?:related|relating)\s+to|re:?|the|regarding|support(?:ing)?(?:\s+for)?|oppos\w+)\s+")
TAIL = re.compile(r"(?:\s+-\s+\w+(?:\s+\w+)?|,\s*all\s+provisions|,\s*as\s+amended|\s+generally)$")
#: Short forms of words in names of agencies.
AGENCY_WORDS = {
    "admin": "administration", "agcy": "agency", "auth": "authority", "bd": "board", "brd": "board", "bur": "bureau", "cmsn": "commission", "cncl": "council", "comm": "commission",
    "commn": "commission", "dept": "department", "natl": "national", "ofc": "office", "off": "office", "svc": "service", "svcs": "services",
}
#: Other names of the two chambers.
CHAMBERS = {"house": "house of representatives", "house of reps": "house of representatives", "house of rep": "house of representatives", "reps": "house of representatives", "senate chamber": "senate"}


def congress_of(year: int) -> int:
    return (year - 1789) // 2 + 1


def plain(s: str) -> str:
    s = unicodedata.normalize("NFKD", s).lower()
    s = "".join(c for c in s if not unicodedata.combining(c))
    s = re.sub("[‐-―−]", "-", s)
    s = re.sub("[‘’‛`]", "'", s)
    s = re.sub("[“”«»]", '"', s)
    return re.sub(r"\s+", " ", s).strip()


def title_key(title: str) -> str:
    """A title without year, 'Act', punctuation and lead words."""
    s = YEAR.sub(" ", plain(title))
    s = re.sub(r"\(\s*\)", " ", s).strip(" \"'()[].,;:-")
    for _ in range(3):
        s = LEAD.sub("", s).strip(" \"'()[].,;:-")
        s = TAIL.sub("", s).strip(" \"'()[].,;:-") or s
    s = re.sub(r"[^\w]+", " ", s).strip()
    return re.sub(r"\s+act$", "", s)


def agency_key(name: str) -> str:
    s = plain(name).replace("&", " and ")
    s = re.sub(r"\s+-\s+[^-]*$|\s*\([^()]*\)\s*$|,\s*(?:regional|field|local|general)\s.*$", "", s)
    s = re.sub(r"\bu\.?\s*s\.?(?=\s)|\bunited states\b", " ", s).replace("'", "").strip()
    s = re.sub(r"^(.*),\s*(\S+\s+(?:of|on|for))$", r"\2 \1", s.strip())
    s = re.sub(r"[^\w]+", " ", s).strip()
    s = re.sub(r"^the\s+", "", s)
    s = " ".join(AGENCY_WORDS.get(w, w) for w in s.split())
    return CHAMBERS.get(s, s)


Row = tuple[int, int | None, str | None, int | None, str]  # ref_id, congress, number, year, title key
Ranked = tuple[int, int, str, list[Row]]  # level of the evidence, distance, key, rows
BY_LAW, BY_TITLE, NEAR_TITLE, BY_SHORT, BY_NUMBER = range(5)


class Bills:
    """Some of the listed bills: found by public law, title (exact, within the tolerance, or its short form), or number."""

    def __init__(self, rows: Iterable[tuple]):
        self.by_title, self.by_number, self.by_law, self.by_short = (defaultdict(list) for _ in range(4))
        for ref_id, title, number, congress, law in rows:
            year = YEAR.search(title or "")
            key = title_key(title) if title else ""
            row = (ref_id, congress, bill_number(number), int(year[1]) if year else None, key)
            if title:
                self.by_title[key].append(row)
                self.by_short["".join(w[0] for w in key.split()) + "a"].append(row)
            if row[2]:
                self.by_number[row[2]].append(row)
            if m := LAW.search(plain(law or "")):
                self.by_law[int(m[1]), int(m[2])].append(row)
        self.tree, self.near = FlatTree(BKTree(self.by_title)), {}

    def look_up(self, entries: Iterable[str | None]) -> None:
        """Search the titles of entries that are no listed title, all at once."""
        keys = {named_parts(plain(e or ""))[2] for e in entries}
        self.near |= nearest(self.tree, [k for k in keys if k and k not in self.by_title and k not in self.near])

    def find(self, entry: str | None) -> Ranked | None:
        """The rows that the best evidence in an entry points to. Of several parts of the list, the least of the results holds."""
        s = plain(entry or "")
        if not s:
            return None
        if m := LAW.search(s):
            rows = self.by_law.get((int(m[1]), int(m[2])))
            return (BY_LAW, 0, "", rows) if rows else None
        key = named_parts(s)[2]
        if rows := self.by_title.get(key):
            return (BY_TITLE, 0, key, rows)
        if key and (hit := self.near[key] if key in self.near else nearest(self.tree, [key])[key]):
            return (NEAR_TITLE, *hit, self.by_title[hit[1]])
        if re.fullmatch(r"[a-z]{3,6}", key) and (rows := self.by_short.get(key)):
            return (BY_SHORT, 0, "", rows)
        number = bill_number(s)
        if number and (rows := self.by_number.get(number)):
            return (BY_NUMBER, 0, "", rows)
        return None


def named_parts(s: str) -> tuple[int | None, int | None, str]:
    """(named Congress, year, title key) of a tidy entry."""
    rest = BILL.sub(" ", s)
    at = CONGRESS.search(rest)
    rest = CONGRESS.sub(" ", rest)
    year = YEAR.search(rest)
    return int(at[1]) if at else None, int(year[1]) if year else None, title_key(rest)


def bill_number(s: str | None) -> str | None:
    m = BILL.search(plain(s or ""))
    return m and ("h" if m[1][0] == "h" else "s") + m[2]


def meant(entry: str | None, level: int, rows: list[Row]) -> list[tuple[int, int | None, bool]]:
    """(ref_id, congress, whether only for filings of that Congress) of what an entry may mean among the rows its best evidence points to."""
    s = plain(entry or "")
    if level == BY_LAW:
        return [(r[0], r[1], False) for r in rows]
    bill = bill_number(s)
    at, year, _ = named_parts(s)
    of = at or (congress_of(year) if year else None)
    if level == BY_NUMBER:
        return [(r[0], r[1], of is None) for r in rows if of in (None, r[1])]
    if level == BY_SHORT and len({r[4] for r in rows}) > 1 and of is None and not bill:  # one short form of several titles: that of the filing's Congress
        return [(r[0], r[1], True) for r in rows]
    if year and any(r[3] for r in rows):
        rows = [r for r in rows if r[3] == year]
    elif of is not None:
        rows = [r for r in rows if r[1] == of]
    if bill and len(rows) > 1:
        rows = [r for r in rows if r[2] == bill] or rows
    return [(r[0], r[1], len(rows) > 1 and of is None) for r in rows]


class Agencies:
    """Some of the listed agencies: found by acronym, name (exact or within the tolerance), or an acronym behind the name."""

    def __init__(self, rows: Iterable[tuple]):
        self.by_name, self.by_acronym = {}, {}
        for ref_id, name, acronym in sorted(rows, key=lambda r: -r[0]):
            if name:
                self.by_name[agency_key(name)] = ref_id
            if acronym:
                self.by_acronym[acronym.lower()] = ref_id
        self.tree, self.near = FlatTree(BKTree(self.by_name)), {}

    def look_up(self, entries: Iterable[str | None]) -> None:
        """Search the names in entries that are no listed name, all at once."""
        self.near |= nearest(self.tree, [k for k in {agency_key(plain(e or "")) for e in entries} if k and k not in self.by_name and k not in self.near])

    def find(self, entry: str | None) -> Ranked | None:
        s = plain(entry or "")
        found = lambda level, d, key, ref: (level, d, key, [(ref, None, None, None, "")])
        letters = re.sub(r"[.\s]", "", s)
        if re.fullmatch(r"[a-z]{2,8}", letters) and letters in self.by_acronym and (" " not in s or "." in s):
            return found(0, 0, "", self.by_acronym[letters])
        key = agency_key(s)
        if not key:
            return None
        if key in self.by_name:
            return found(1, 0, "", self.by_name[key])
        if hit := self.near[key] if key in self.near else nearest(self.tree, [key])[key]:
            return found(2, *hit, self.by_name[hit[1]])
        m = re.search(r"\(([a-z.]{2,10})\)\s*$", s)
        ref = self.by_acronym.get(m[1].replace(".", "")) if m else None
        return None if ref is None else found(3, 0, "", ref)


_ROWS = "array<struct<ref_id:long,congress:int,number:string,year:int,title:string>>"
_RANKED = f"field_name string, entry string, rank struct<level:int,distance:int,key:string>, rows {_ROWS}"
_FOUND = "field_name string, entry string, fixed long, by_congress array<struct<congress:int,ref_id:long>>"
LISTS = {"legislation": (Bills, ["ref_id", "title", "bill_no", "congress", "public_law"]), "entities": (Agencies, ["ref_id", "agency_name", "acronym"])}


def _ranked(lists: dict[str, Bills | Agencies], f: pd.DataFrame) -> Iterator[tuple[str, str, Ranked]]:
    for field, part in lists.items():
        part.look_up(f.entry[f.field_name == field])
    for field, entry in zip(f.field_name, f.entry):
        if field in lists and (hit := lists[field].find(entry)):
            yield field, entry, hit


def _settled(field: str, entry: str, level: int, rows: list[Row]) -> tuple:
    """(field_name, entry, fixed, by_congress): the smallest row meant, or the row for each Congress where the filing's decides."""
    hits = meant(entry, level, rows) if field == "legislation" else [(r[0], 0, False) for r in rows]
    if not any(h[2] for h in hits):
        return field, entry, min((h[0] for h in hits), default=0), None
    by = {c: r for r, c, _ in sorted(hits, key=lambda h: -h[0])}
    return field, entry, 0, [{"congress": c, "ref_id": r} for c, r in sorted(by.items(), key=lambda x: (x[0] is not None, x[0]))]


def blocks_of(keys: DataFrame) -> int:
    return max(1, -(-keys.count() // KEYS_PER_BLOCK))


def _found_by_broadcast(distinct: DataFrame, lists: dict[str, list[tuple]]) -> DataFrame:
    known = distinct.sparkSession.sparkContext.broadcast(lists)

    def look(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = {field: LISTS[field][0](rows) for field, rows in known.value.items()}
        for f in frames:
            yield pd.DataFrame([_settled(field, entry, hit[0], hit[3]) for field, entry, hit in _ranked(parts, f)], columns=["field_name", "entry", "fixed", "by_congress"])

    return spread(distinct).mapInPandas(look, _FOUND)


def _found_in_shards(distinct: DataFrame, tables: dict[str, DataFrame], shards: int) -> DataFrame:
    """Every shard of a list gives the rows of its best evidence; of all shards the best evidence counts, with its rows of all shards."""
    blocks = blocks_of(distinct)
    out = None
    for field, table in tables.items():
        kind, cols = LISTS[field]
        own = distinct.where(F.col("field_name") == field).select("entry", F.pmod(F.xxhash64("entry"), F.lit(blocks)).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
        ref = table.select(*cols, F.pmod(F.xxhash64(cols[0]), F.lit(shards)).cast("int").alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))

        def search(_: tuple, asked: pd.DataFrame, part: pd.DataFrame, field=field, kind=kind, cols=cols) -> pd.DataFrame:
            rows = [tuple(x) for x in part[cols].astype(object).where(part[cols].notna(), None).itertuples(index=False)]
            hits = _ranked({field: kind(rows)}, asked.assign(field_name=field))
            dicts = lambda rs: [dict(zip(("ref_id", "congress", "number", "year", "title"), r)) for r in rs]
            return pd.DataFrame([(f, e, {"level": h[0], "distance": h[1], "key": h[2]}, dicts(h[3])) for f, e, h in hits], columns=["field_name", "entry", "rank", "rows"])

        found = own.groupBy("shard", "block").cogroup(ref.groupBy("shard", "block")).applyInPandas(search, _RANKED)
        out = found if out is None else out.unionByName(found)
    best = out.groupBy("field_name", "entry").agg(F.min("rank").alias("best"), F.collect_list(F.struct("rank", "rows")).alias("x"))
    best = best.select("field_name", "entry", F.col("best.level").alias("level"), F.flatten(F.transform(F.filter("x", lambda x: x["rank"] == F.col("best")), lambda x: x["rows"])).alias("rows"))

    def settle(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        whole = lambda v: None if v is None or v != v else int(v)
        for f in frames:
            rows = [[(int(r["ref_id"]), whole(r["congress"]), r["number"], whole(r["year"]), r["title"]) for r in rs] for rs in f["rows"]]
            yield pd.DataFrame([_settled(*x) for x in zip(f.field_name, f.entry, f.level, rows)], columns=["field_name", "entry", "fixed", "by_congress"])

    return best.mapInPandas(settle, _FOUND)


def resolve_entries(rules: DataFrame, years: DataFrame, bills: DataFrame, agencies: DataFrame, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """Rows (activity_id, field_name, pos, ref_id), one per entry of legislation and entities; ref_id 0: not listed.

    Distinct entries are looked up once and joined back. rules: activity_id, legislation, entities. years: activity_id,
    year (of the filing; without one, an entry that needs the Congress is not listed). A short form that several titles of one
    Congress have is read as that of the smallest ref_id. Null arrays give no rows, null,
    empty and vague entries are not listed. Lists of up to most_broadcast rows are broadcast; longer ones are cut into shards
    of that size, with the same result.
    """
    tables = {field: t.select(*LISTS[field][1]).where("ref_id is not null") for field, t in (("legislation", bills), ("entities", agencies))}
    one = lambda c: rules.where("activity_id is not null").select("activity_id", F.lit(c).alias("field_name"), F.posexplode(c).alias("p", "entry"))
    entries = one("legislation").unionByName(one("entities"))
    distinct = entries.where("entry is not null").select("field_name", "entry").distinct()
    lists = {field: [tuple(r) for r in t.limit(most_broadcast + 1).collect()] for field, t in tables.items()}
    if max(map(len, lists.values())) <= most_broadcast:
        found = _found_by_broadcast(distinct, lists)
    else:
        found = _found_in_shards(distinct, tables, max(-(-t.count() // most_broadcast) for t in tables.values()))
    year = years.where("activity_id is not null").groupBy("activity_id").agg(F.max("year").alias("year"))
    joined = entries.join(found, ["field_name", "entry"], "left")
    plain_rows = joined.where("by_congress is null").select("activity_id", "field_name", (F.col("p") + 1).alias("pos"), F.coalesce("fixed", F.lit(0).cast("long")).alias("ref_id"))
    own = F.expr("get(filter(by_congress, x -> x.congress = int(floor((year - 1789) / 2)) + 1), 0).ref_id")
    dated = joined.where("by_congress is not null").join(year, "activity_id", "left").select("activity_id", "field_name", (F.col("p") + 1).alias("pos"), F.coalesce(own, F.lit(0).cast("long")).alias("ref_id"))
    return plain_rows.unionByName(dated)
