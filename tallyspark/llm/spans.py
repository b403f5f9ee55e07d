"""Long exact spans shared between records (problem 10).

Every run of at least RUN characters holds at least one anchor: of each RUN - K + 1 consecutive windows of K characters
the one of smallest hash is an anchor, wherever the run stands. So two texts that share such a run share an anchor in it.

1. Each partition counts its anchors in a count-min sketch of saturating counters; the merged sketch never
   underestimates. Its cells grow with the anchors. 2. A second pass keeps the anchors estimated to occur twice or more,
   groups these exactly, and extends each match to both sides. None is lost: the sketch only spares the shuffle what occurs
   once. Up to MOST_CELLS the sketch is broadcast; beyond it stays in blocks, which the anchors are joined with.

Copies of one text form a class first and are worked on once. An anchor that stands in many surroundings is not compared in
pairs: its runs of RUN characters, at most STEP for each place, are grouped themselves. Which way is taken is a matter of
cost alone; both find the same.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from tallyspark.session import cut_lineage

RUN, K = 200, 150
STEP = RUN - K + 1
MAX = np.uint64(0xFFFFFFFFFFFFFFFF)
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INVERSE = pow(BASE, -1, 1 << 64)
#: A sketch of up to so many cells in a row is broadcast: 2 rows of this many bits, 16 MB.
MOST_CELLS = 1 << 26
#: Anchors counted before a partition hands on its blocks.
ANCHORS_AT_ONCE = 1 << 21
BLOCK = 1 << 16
CHARS_AT_ONCE = 1 << 19
#: An anchor in more surroundings than this has its runs grouped, which costs up to STEP rows for each, instead of its surroundings compared in pairs.
MANY = 2 * STEP
#: Members of a group that meet in one task.
TOGETHER = 500


def _powers(b: int, n: int) -> np.ndarray:
    out = np.full(n, b, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _slide(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over each width consecutive values."""
    done = 1
    while 2 * done <= width:
        x = pick(x[:-done], x[done:])
        done *= 2
    return pick(x[: len(x) - (width - done)], x[width - done :]) if done < width else x


def anchors(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the text, position, hash) of the anchors of texts of at least RUN characters each."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    n = len(codes)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_mix(codes.astype(np.uint64) + np.uint64(1)) * _powers(BASE, n), dtype=np.uint64, out=sums[1:])
    h = _mix((sums[K:] - sums[:-K]) * _powers(BASE_INVERSE, n - K + 1))
    ends = np.cumsum(sizes)
    lowest = _slide(h, STEP, np.minimum)  # at i: of the windows that begin in i .. i + STEP - 1
    inside = np.zeros(len(lowest) + 1, dtype=np.int32)  # only runs that lie within one text count
    np.add.at(inside, ends - sizes, 1)
    np.add.at(inside, np.minimum(ends - RUN + 1, len(lowest)), -1)
    lowest = np.where(np.cumsum(inside[:-1]) > 0, lowest, np.uint64(0))
    pad = np.zeros(STEP - 1, dtype=np.uint64)
    at = np.flatnonzero((_slide(np.concatenate([pad, lowest, pad]), STEP, np.maximum) == h) & (h > 0))
    who = np.searchsorted(ends, at, side="right")
    return who, at - (ends - sizes)[who], h[at]


def _chunks(ids: list, texts: list) -> Iterator[tuple[list, list]]:
    """Texts long enough, in groups of bounded size."""
    some_ids, some, size = [], [], 0
    for i, t in zip(ids, texts):
        if t is not None and len(t) >= RUN:
            some_ids.append(i)
            some.append(t)
            size += len(t)
            if size >= CHARS_AT_ONCE:
                yield some_ids, some
                some_ids, some, size = [], [], 0
    if some:
        yield some_ids, some


def _cells(h: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    m = np.uint64(cells - 1)
    return (h & m).astype(np.int64), ((h >> np.uint64(32)) * np.uint64(0x9E3779B1) >> np.uint64(4) & m).astype(np.int64)


def sketch(docs: DataFrame, cells: int, text_col: str = "text") -> DataFrame:
    """The merged sketch as rows (block, bits): of each block of either row of cells, which counted two anchors or more."""
    block = min(BLOCK, cells)
    per_row = cells // block

    def flush(some: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        ks, packed = [], []
        for r, at in enumerate(_cells(np.concatenate(some), cells)):
            which, n = np.unique(at, return_counts=True)
            for k, lo, hi in zip(*_groups(which // block)):
                counted = np.zeros(block, dtype=np.uint8)
                counted[which[lo:hi] % block] = np.minimum(n[lo:hi], 2)
                ks.append(r * per_row + int(k))
                packed.append(zlib.compress(np.concatenate([np.packbits(counted > 0), np.packbits(counted > 1)]).tobytes(), 1))
        yield pa.RecordBatch.from_arrays([pa.array(ks, pa.int64()), pa.array(packed, pa.binary())], names=["block", "bits"])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some, size = [], 0
        for b in batches:
            for _, texts in _chunks([0] * b.num_rows, b.column(0).to_pylist()):
                some.append(anchors(texts)[2])
                size += len(some[-1])
                if size >= ANCHORS_AT_ONCE:
                    yield from flush(some)
                    some, size = [], 0
        if some:
            yield from flush(some)

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = {}, {}
        for b in batches:
            for k, bits in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                new = np.frombuffer(zlib.decompress(bits), dtype=np.uint8)
                o, t = new[: len(new) // 2], new[len(new) // 2 :]
                twice[k] = (twice[k] | t | (once[k] & o)) if k in once else t
                once[k] = once[k] | o if k in once else o
        for k, t in twice.items():
            if t.any():
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([zlib.compress(t.tobytes(), 1)], pa.binary())], names=["block", "bits"])

    parts = docs.select(text_col)
    if cells <= MOST_CELLS:  # few blocks: few partitions hand on fewer of them
        parts = parts.coalesce(max(8, docs.sparkSession.sparkContext.defaultParallelism * 2))
    return parts.mapInArrow(count, "block long, bits binary").repartition("block").mapInArrow(merge, "block long, bits binary")


def _groups(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(value, first, last + 1) of the runs of equal values of a sorted array."""
    first = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.empty(0, int)
    return x[first], first, np.append(first[1:], len(x))


def _bits(merged: DataFrame, cells: int) -> list[np.ndarray]:
    """The sketch as two rows of packed bits, at most 2 * MOST_CELLS / 8 bytes."""
    block = min(BLOCK, cells)
    out = [np.zeros(cells // 8, dtype=np.uint8) for _ in range(2)]
    for k, bits in merged.collect():
        r, k = divmod(k, cells // block)
        out[r][k * block // 8 : (k + 1) * block // 8] = np.frombuffer(zlib.decompress(bits), dtype=np.uint8)
    return out


def sketch_cells(docs: DataFrame, text_col: str = "text") -> int:
    """About 8 cells in a row for each anchor."""
    chars = docs.agg(F.sum(F.length(text_col).cast("long"))).first()[0] or 0
    want = max(BLOCK, 8 * 2 * chars // STEP)
    return 1 << (want - 1).bit_length()


def text_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, rep, n_chars) of the texts of at least RUN characters: rep is the smallest id with the same text."""
    d = docs.where(F.length(text_col) >= RUN).select(F.col(id_col).alias("id"), F.unhex(F.sha2(text_col, 256)).alias("digest"), F.length(text_col).cast("long").alias("n_chars"))
    reps = d.groupBy("digest").agg(F.min("id").alias("rep"))
    return d.join(reps, "digest").select("id", "rep", "n_chars")


def _anchors_of(ids: list, texts: list[str], keep, kind: pa.DataType) -> pa.RecordBatch:
    """Rows of repeated_anchors; keep(who, h) tells which anchors to give."""
    who, pos, h = anchors(texts)
    kept = keep(who, h)
    places: dict[tuple, list[int]] = {}  # a text that repeats itself: equal surroundings make one row
    for w, p, x in zip(who[kept].tolist(), pos[kept].tolist(), h[kept].astype(np.int64).tolist()):
        t = texts[w]
        places.setdefault((w, x, t[max(0, p - STEP + 1) : p], t[p + K : p + RUN]), []).append(p)
    out = {n: [] for n in ("id", "pos", "h", "g", "left", "right")}
    for (w, x, left, right), ps in places.items():
        g = xxhash.xxh3_64_intdigest(texts[w][ps[0] : ps[0] + K].encode("utf-8", "surrogatepass")) - (1 << 63)
        for n, v in zip(out, (ids[w], ps, x, g, left, right)):
            out[n].append(v)
    return pa.RecordBatch.from_pydict(out, schema=pa.schema([("id", kind), ("pos", pa.list_(pa.int32())), ("h", pa.int64()), ("g", pa.int64()), ("left", pa.string()), ("right", pa.string())]))


def repeated_anchors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", cells: int | None = None, most_cells: int = MOST_CELLS) -> DataFrame:
    """Anchors estimated to occur more than once: id, pos (its places), h (hash), g (another hash of the window), and the RUN - K characters on each side."""
    cells = cells or sketch_cells(docs, text_col)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, pos array<int>, h long, g long, left string, right string"
    merged = sketch(docs, cells, text_col)
    if cells <= most_cells:
        known = docs.sparkSession.sparkContext.broadcast(_bits(merged, cells))

        def often(_: np.ndarray, h: np.ndarray) -> np.ndarray:
            keep = np.ones(len(h), dtype=bool)
            for row, at in zip(known.value, _cells(h, cells)):
                keep &= (row[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
            return keep

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for ids, texts in _chunks(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    yield _anchors_of(ids, texts, often, b.schema.field(0).type)

        return docs.select(id_col, text_col).mapInArrow(run, schema)

    block = min(BLOCK, cells)

    def set_cells(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, bits in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                r, k = divmod(k, cells // block)
                at = np.flatnonzero(np.unpackbits(np.frombuffer(zlib.decompress(bits), dtype=np.uint8))) + k * block
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), r), pa.int32()), pa.array(at, pa.int64())], names=["r", "cell"])

    def all_cells(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, texts in _chunks(b.column(0).to_pylist(), b.column(1).to_pylist()):
                who, _, h = anchors(texts)
                yield pa.RecordBatch.from_arrays([pa.array(ids, b.schema.field(0).type).take(pa.array(who)), pa.array(h.astype(np.int64)), *map(pa.array, _cells(h, cells))], names=["id", "h", "c0", "c1"])

    def chosen(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, t, hs in zip(*(b.column(k).to_pylist() for k in range(3))):
                yield _anchors_of([i], [t], lambda _, h: np.isin(h, np.array(hs, dtype=np.int64).astype(np.uint64)), b.schema.field(0).type)  # noqa: B023

    twice = cut_lineage(merged.mapInArrow(set_cells, "r int, cell long"))
    every = docs.select(id_col, text_col).mapInArrow(all_cells, f"id {kind}, h long, c0 long, c1 long")
    for r in range(2):
        every = every.join(twice.where(f"r = {r}").select(F.col("cell").alias(f"c{r}")), f"c{r}", "left_semi")
    hs = every.groupBy("id").agg(F.collect_set("h").alias("hs"))
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.length("text") >= RUN).join(hs, "id").select("id", "text", "hs").mapInArrow(chosen, schema)


def _shared_anchors(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Anchors in two different texts or more (columns of repeated_anchors and n, the number of rows with the same window), each text once; the classes of copies."""
    classes = cut_lineage(text_classes(docs, id_col, text_col).distinct())
    found = cut_lineage(repeated_anchors(docs, id_col, text_col).join(classes.where("id = rep").select("id"), "id", "left_semi"))
    many = found.groupBy("h", "g").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count(F.lit(1)).alias("n")).where("lo < hi").select("h", "g", "n")
    return cut_lineage(found.join(many, ["h", "g"])), classes


def _runs(rows: DataFrame) -> DataFrame:
    """rows with one row for each run of RUN characters around the anchor: l characters before it; x, y tell it from the others of its anchor."""
    side = STEP - 1
    every = rows.withColumn("l", F.explode(F.sequence(F.greatest(F.lit(0), side - F.length("right")), F.least(F.lit(side), F.length("left")))))
    before, after = F.expr("right(`left`, l)"), F.expr(f"substring(`right`, 1, {side} - l)")
    return every.withColumn("x", F.xxhash64(before, after)).withColumn("y", F.xxhash64(F.lit(1), after, before)).drop("left", "right")


def _lengths(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of the pairs of surroundings with a common run, the characters before and after the anchor that are common, in place of the surroundings."""
    for f in frames:
        f["before"] = np.array([_common(x[::-1], y[::-1]) for x, y in zip(f.left_a, f.left_b)], dtype=np.int32)
        f["after"] = np.array([_common(x, y) for x, y in zip(f.right_a, f.right_b)], dtype=np.int32)
        yield f[f.before + f.after >= RUN - K].drop(columns=["left_a", "left_b", "right_a", "right_b"])


def pairs_within(members: DataFrame, together: int = TOGETHER) -> DataFrame:
    """Pairs (a, b), a < b, of the members (k, id) of each group k: its members in blocks, two blocks in a task, so that no task gets a large group."""
    sized = members.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("k", F.ceil(F.col("n") / together).cast("int").alias("blocks"))
    m = members.join(sized, "k").withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    a = m.select("k", F.col("own").alias("i"), F.explode(F.sequence(F.col("own"), F.col("blocks") - 1)).alias("j"), F.col("id").alias("a"))
    b = m.select("k", F.explode(F.sequence(F.lit(0), F.col("own"))).alias("i"), F.col("own").alias("j"), F.col("id").alias("b"))
    met = a.join(b, ["k", "i", "j"]).where("a <> b and (i < j or a < b)")
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def linked_texts(kept: DataFrame) -> DataFrame:
    """Distinct pairs (a, b), a < b, of texts that share a run, from the anchors they share."""
    kind = kept.schema["id"].dataType.simpleString()
    few = kept.where(F.col("n") <= MANY)
    side = lambda s: few.select("h", "g", F.col("id").alias(s), F.col("left").alias(f"left_{s}"), F.col("right").alias(f"right_{s}"))
    compared = side("a").join(side("b"), ["h", "g"]).where("a < b").drop("h", "g").mapInPandas(_lengths, f"a {kind}, b {kind}, before int, after int").select("a", "b")
    # of the runs of an anchor in many texts, those that stand in the same texts say the same
    runs = _runs(kept.where(F.col("n") > MANY).select("h", "g", "id", "left", "right")).select("h", "g", "l", "x", "y", "id").distinct()
    mark = F.xxhash64("id").cast("decimal(38,0)")
    texts = runs.groupBy("h", "g", "l", "x", "y").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("id")).alias("u"), F.sum(mark).alias("v")).where("n > 1")
    one = texts.groupBy("n", "u", "v").agg(F.min(F.struct("h", "g", "l", "x", "y")).alias("r")).select("r.*", F.struct("n", "u", "v").alias("k"))
    return compared.unionByName(pairs_within(runs.join(one, ["h", "g", "l", "x", "y"]).select("k", "id"))).distinct()


def shared_pieces(kept: DataFrame) -> DataFrame:
    """Rows (id, s, e): the places of runs that a text shares with any other, as pieces that overlap and together cover them. Linear in the anchors."""
    kept = kept.withColumn("c", F.xxhash64("left", "right"))
    key = ["h", "g", "c", "left", "right"]
    around = kept.groupBy(*key).agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
    sizes = around.groupBy("h", "g").agg(F.count(F.lit(1)).alias("ways"))
    around = cut_lineage(around.join(sizes, ["h", "g"]))
    ends = lambda df, *more: df.select("h", "g", "c", *more)
    # equal surroundings in two texts: all of them is shared; else what is common with other surroundings
    whole = ends(around.where("lo < hi"), F.length("left").alias("before"), F.length("right").alias("after"))
    few = around.where(F.col("ways").between(2, MANY))
    side = lambda s, df: df.select("h", "g", F.struct("c", "lo", "hi").alias(f"k_{s}"), F.col("left").alias(f"left_{s}"), F.col("right").alias(f"right_{s}"))
    met = side("a", few.where("lo = hi")).join(side("b", few), ["h", "g"]).where("k_a.c <> k_b.c and (k_b.lo <> k_a.lo or k_b.hi <> k_a.lo)")
    compared = met.select("h", "g", F.col("k_a.c").alias("c"), "left_a", "left_b", "right_a", "right_b")
    some = compared.mapInPandas(_lengths, "h long, g long, c long, before int, after int")
    runs = _runs(around.where(F.col("ways") > MANY).select(*key, "lo", "hi"))
    twice = runs.groupBy("h", "g", "l", "x", "y").agg(F.min("lo").alias("least"), F.max("hi").alias("most")).where("least < most")
    grouped = ends(runs.join(twice, ["h", "g", "l", "x", "y"]).where("lo = hi"), F.col("l").alias("before"), (STEP - 1 - F.col("l")).alias("after"))
    reach = whole.unionByName(some).unionByName(grouped).groupBy("h", "g", "c").agg(F.max("before").alias("before"), F.max("after").alias("after"))
    return kept.join(reach, ["h", "g", "c"]).select("id", F.explode("pos").alias("p"), "before", "after").select("id", (F.col("p") - F.col("before")).alias("s"), (F.col("p") + K + F.col("after")).alias("e"))


def _common(x: str, y: str) -> int:
    """Length of the common prefix."""
    if x == y:
        return len(x)
    lo, hi = 0, min(len(x), len(y))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if x[:mid] == y[:mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


def sharing_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Distinct pairs (doc_a, doc_b) of documents that share a run: every pair, copies included.

    Its rows are as many as there are such pairs; text_links and text_classes say the same in a row for each pair of different
    texts and for each document. Null and short texts share nothing.
    """
    kept, classes = _shared_anchors(docs, id_col, text_col)
    member = lambda s: classes.select(F.col("rep").alias(s), F.col("id").alias(f"doc_{s}"))
    out = linked_texts(kept).join(member("a"), "a").join(member("b"), "b").select(F.least("doc_a", "doc_b").alias("doc_a"), F.greatest("doc_a", "doc_b").alias("doc_b"))
    copies = pairs_within(classes.select(F.col("rep").alias("k"), "id"))
    return out.unionByName(copies.select(F.col("a").alias("doc_a"), F.col("b").alias("doc_b")))


def text_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Distinct pairs (class_a, class_b) of different texts that share a run, each by the smallest id with that text."""
    return linked_texts(_shared_anchors(docs, id_col, text_col)[0]).select(F.col("a").alias("class_a"), F.col("b").alias("class_b"))


def shared_share(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, n_spans, shared_chars, share) of all documents: how much of each stands elsewhere in runs of at least RUN characters.

    No pair of documents is made. Null and short texts have 0.
    """
    kept, classes = _shared_anchors(docs, id_col, text_col)
    pieces = shared_pieces(kept).withColumnRenamed("id", "rep")
    copied = classes.where("id <> rep").groupBy("rep").agg(F.max("n_chars").alias("n_chars")).select("rep", F.lit(0).alias("s"), F.col("n_chars").cast("int").alias("e"))
    # of pieces with one start only the longest matters; a text has no more starts than characters
    pieces = pieces.unionByName(copied).groupBy("rep", "s").agg(F.max("e").alias("e"))
    w = Window.partitionBy("rep").orderBy("s")
    reach = F.coalesce(F.max("e").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans = pieces.withColumn("reach", reach).select("rep", F.greatest(F.col("e") - F.greatest("s", "reach"), F.lit(0)).alias("more"), ((F.col("s") > F.col("reach")) | (F.col("reach") == 0)).cast("int").alias("new"))
    per = spans.groupBy("rep").agg(F.sum("new").alias("n_spans"), F.sum("more").alias("shared_chars"))
    by_doc = classes.join(per, "rep").select("id", "n_spans", "shared_chars")
    every = docs.select(F.col(id_col).alias("id"), F.length(text_col).alias("n"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    return every.join(by_doc, "id", "left").select(F.col("id").alias(id_col), zero("n_spans"), zero("shared_chars"), F.coalesce(F.try_divide("shared_chars", "n"), F.lit(0.0)).alias("share"))
