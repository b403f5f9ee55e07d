"""Tagging texts by rules: topics with scores and evidence, legislation, entities; mining and measuring dictionaries.

Rules and dictionaries are short lists that come as literals; matching is one pass of built-in higher-order functions per
text, without a join.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyspark.functions.canon import coarse_topic, fallback_topic
from tallyspark.functions.text import let, squeeze
from tallyspark.operators.versioning import pending
from tallyspark.session import cut_lineage

# Fixed values.
SIGNAL_WORDS = ("cybersecurity", "privacy", "methane", "tariff", "sanctions", "immigration", "medicare", "medicaid", "telehealth", "blockchain", "cryptocurrency", "semiconductor", "fiduciary", "telemedicine", "ransomware", "usmca")
STRICT = {"act": 2.8, "program": 2.2, "phrase": 1.6, "signal": 1.1, "support": 0.45, "code": 0.6}
RELAXED = {"act": 2.4, "program": 1.9, "phrase": 1.3, "signal": 0.9, "support": 0.3, "code": 0.4}
CAPS = {"keywords": 8, "programs": 5, "acts": 4}
#: Values of a block of near_variants; two blocks are held at once.
VARIANT_BLOCK = 500
MOST_TOPICS, MOST_LAWS, MOST_ENTITIES = 8, 12, 8
LAW_PATTERNS = (
    r"(?i)\bH\.?\s*R\.?\s*\d+\b", r"(?i)\bS\.?\s*\d+\b", r"(?i)\bP\.?\s*L\.?\s*\d+\-\d+\b", r"(?i)\b\d+\s+U\.?S\.?C\.?\s+§?\s*[0-9A-Za-z\-\.\(\)]+\b", r"(?i)\b\d+\s+C\.?F\.?R\.?\s+§?\s*[0-9A-Za-z\-\.\(\)]+\b",
    r"(?i)\bSection\s+[0-9A-Za-z\-\(\)]+\b", r"\b[A-Z][A-Za-z0-9'&,\-]+(?:\s+[A-Z][A-Za-z0-9'&,\-]+){0,7}\s+Act(?:\s+of\s+\d{4})?\b",
)
STOP_WORDS = (
    "the and for with from that this these those are was were be been being will would could should can about into over under after before between through during including relating related issues issue federal program policy "
    "policies legislation rule rules regulation regulations quarter specific general monitoring outreach support efforts regarding activity activities act acts bill bills section title subtitle"
).split()
GENERIC_PAIRS = ("federal funding", "federal policy", "general issues", "specific legislation", "appropriations bill", "policy issues", "regulatory issues", "agency policy", "congressional outreach")
#: Names and short forms of offices, in the order in which they are looked for, and their labels.
ENTITY_PATTERNS = (
    ("senate", "Senate"), ("house of representatives", "House of Representatives"), ("congress", "Congress"), ("white house", "White House"), ("office of management and budget", "OMB"), ("omb", "OMB"),
    ("office of science and technology policy", "OSTP"), ("ostp", "OSTP"), ("department of defense", "Department of Defense"), ("dod", "Department of Defense"), ("pentagon", "Department of Defense"),
    ("department of state", "State Department"), ("state department", "State Department"), ("department of commerce", "Department of Commerce"), ("commerce, dept of", "Department of Commerce"), ("doc", "Department of Commerce"),
    ("department of justice", "DOJ"), ("doj", "DOJ"), ("department of treasury", "Treasury"), ("treasury, dept of", "Treasury"), ("treasury", "Treasury"), ("internal revenue service", "IRS"), ("irs", "IRS"),
    ("department of health and human services", "HHS"), ("health & human services", "HHS"), ("hhs", "HHS"), ("centers for medicare and medicaid services", "CMS"), ("cms", "CMS"), ("food and drug administration", "FDA"), ("fda", "FDA"),
    ("department of agriculture", "USDA"), ("agriculture, dept of", "USDA"), ("usda", "USDA"), ("department of energy", "Department of Energy"), ("energy, dept of", "Department of Energy"), ("doe", "Department of Energy"),
    ("environmental protection agency", "EPA"), ("epa", "EPA"), ("federal communications commission", "FCC"), ("fcc", "FCC"), ("federal trade commission", "FTC"), ("ftc", "FTC"), ("securities and exchange commission", "SEC"), ("sec", "SEC"),
    ("federal reserve", "Federal Reserve"), ("federal deposit insurance corporation", "FDIC"), ("fdic", "FDIC"), ("office of the comptroller of the currency", "OCC"), ("occ", "OCC"), ("consumer financial protection bureau", "CFPB"),
    ("cfpb", "CFPB"), ("federal aviation administration", "FAA"), ("faa", "FAA"), ("transportation, dept of", "Department of Transportation"), ("department of transportation", "Department of Transportation"), ("dot", "Department of Transportation"),
    ("federal railroad administration", "FRA"), ("department of labor", "Department of Labor"), ("labor, dept of", "Department of Labor"), ("dol", "Department of Labor"), ("occupational safety and health administration", "OSHA"),
    ("osha", "OSHA"), ("department of homeland security", "DHS"), ("dhs", "DHS"), ("customs and border protection", "CBP"), ("cbp", "CBP"), ("citizenship and immigration services", "USCIS"), ("federal energy regulatory commission", "FERC"),
    ("ferc", "FERC"), ("nuclear regulatory commission", "NRC"), ("nrc", "NRC"), ("executive office of the president", "Executive Office of the President"), ("eop", "Executive Office of the President"),
    ("interior, dept of", "Department of the Interior"), ("department of the interior", "Department of the Interior"), ("doi", "Department of the Interior"), ("army, dept of", "Army Corps of Engineers"), ("corps of engineers", "Army Corps of Engineers"),
    ("u.s. trade representative", "USTR"), ("ustr", "USTR"), ("veterans affairs, dept of", "Department of Veterans Affairs"), ("department of veterans affairs", "Department of Veterans Affairs"), ("va", "Department of Veterans Affairs"),
    ("national aeronautics and space administration", "NASA"), ("nasa", "NASA"),
)

PHRASES = "array<struct<p:string,needle:string,short:boolean>>"
RULE_TYPE = f"array<struct<id:string,issue_codes:array<string>,keywords:{PHRASES},programs:{PHRASES},acts:{PHRASES},exclude:{PHRASES},allow_single_support_relaxed:boolean>>"


def load_rules(source: str | dict) -> list[dict]:
    """The rules of a JSON file (or its content): phrases in lower case, lists present. Without any topic it is an error."""
    data = source if isinstance(source, dict) else json.loads(open(source, encoding="utf-8").read())
    topics = data.get("topics") or []
    if not isinstance(topics, list) or not topics:
        raise ValueError("no topics in the rules")
    tidy = lambda xs: [" ".join(x.lower().split()) for x in xs or [] if x and x.strip()]
    return [
        {"id": t["id"], "label": t.get("label") or t["id"], "issue_codes": sorted(set(t.get("issue_codes") or [])), "allow_single_support_relaxed": bool(t.get("allow_single_support_relaxed"))}
        | {k: tidy(t.get(k)) for k in ("keywords", "programs", "acts", "exclude")}
        for t in topics
    ]


def needle(phrase: str) -> dict:
    """What to look for: the phrase anywhere in the text; a single word of at most 4 characters only as a word, in the padded text."""
    short = " " not in phrase and len(phrase) <= 4
    return {"p": phrase, "needle": " " + re.sub("[^a-z0-9]+", " ", phrase) + " " if short else phrase, "short": short}


def _named(low: Column, padded: Column, phrase: Column) -> Column:
    """Whether a text (lower case; and its words between single blanks) names a phrase, a struct as needle gives."""
    return F.when(phrase["short"], padded.contains(phrase["needle"])).otherwise(low.contains(phrase["needle"]))


def _table(phrases: Sequence[tuple[str, str]]) -> Column:
    """A literal array of phrases and their labels."""
    return F.from_json(F.lit(json.dumps([needle(p) | {"n": n} for p, n in phrases])), "array<struct<p:string,needle:string,short:boolean,n:string>>")


def _padded(low: Column) -> Column:
    return F.concat(F.lit(" "), F.regexp_replace(low, "[^a-z0-9]+", " "), F.lit(" "))


def topics(df: DataFrame, rules: Sequence[dict], text: str = "description", code: str = "issue_code") -> DataFrame:
    """df with topics (array, best first), topic_scores (map) and topic_evidence (map of structs).

    Of each rule the first few hits of each list count (CAPS). A rule is assigned strictly, else relaxed, else not; the best
    MOST_TOPICS by score, then id, stay. Without any, the general topic of the issue code has score 0.2. Null texts name nothing.
    """
    x = df.withColumn("_low", F.trim(squeeze(F.lower(F.coalesce(F.col(text), F.lit("")))))).withColumn("_pad", _padded(F.col("_low")))
    key = F.coalesce(F.col(code), F.lit(""))
    literal = F.from_json(F.lit(json.dumps([r | {k: list(map(needle, r[k])) for k in ("keywords", "programs", "acts", "exclude")} for r in rules])), RULE_TYPE)
    hits = lambda phrases, most: F.transform(F.slice(F.filter(phrases, lambda p: _named(F.col("_low"), F.col("_pad"), p)), 1, most), lambda p: p["p"])
    found = F.transform(literal, lambda r: F.struct(
        r["id"].alias("id"), hits(r["keywords"], CAPS["keywords"]).alias("k"), hits(r["programs"], CAPS["programs"]).alias("p"), hits(r["acts"], CAPS["acts"]).alias("a"),
        F.array_contains(r["issue_codes"], key).alias("code"), F.exists(r["exclude"], lambda p: _named(F.col("_low"), F.col("_pad"), p)).alias("out"), r["allow_single_support_relaxed"].alias("single"),
    ))
    x = x.withColumn("_f", F.filter(found, lambda f: ~f["out"] & (F.size(f["k"]) + F.size(f["p"]) + F.size(f["a"]) > 0)))
    is_phrase = lambda h: h.rlike(r"[-/&()\d]|\s")
    split = F.transform("_f", lambda f: F.struct(
        f["id"].alias("id"), f["k"].alias("k"), f["p"].alias("p"), f["a"].alias("a"), f["code"].alias("code"), f["single"].alias("single"), F.filter(f["k"], is_phrase).alias("ph"),
        F.filter(f["k"], lambda h: ~is_phrase(h) & h.isin(*SIGNAL_WORDS)).alias("si"), F.filter(f["k"], lambda h: ~is_phrase(h) & ~h.isin(*SIGNAL_WORDS)).alias("su"),
    ))
    x = x.withColumn("_f", split)

    def score(f: Column, w: dict[str, float]) -> Column:
        return F.size(f["a"]) * w["act"] + F.size(f["p"]) * w["program"] + F.size(f["ph"]) * w["phrase"] + F.size(f["si"]) * w["signal"] + F.size(f["su"]) * w["support"] + F.when(f["code"], w["code"]).otherwise(0.0)

    x = x.withColumn("_f", F.transform("_f", lambda f: f.withField("strict", score(f, STRICT)).withField("relaxed", score(f, RELAXED))))

    def tier(f: Column) -> Column:
        n = lambda c: F.size(f[c])
        high = n("p") + n("a") > 0
        backed = f["code"] | (n("p") > 0) | (n("ph") > 0)
        gate = f["code"] | high | (n("ph") >= 2)
        strict = (high & (f["strict"] >= 2.2) & backed) | (f["code"] & (n("ph") + n("si") > 0) & (f["strict"] >= 2.0)) | ((n("ph") >= 2) & (f["strict"] >= 2.6)) | (f["code"] & (n("su") >= 2) & (f["strict"] >= 2.2))
        by_code = (n("si") + n("ph") > 0) | (n("su") >= 2) | (f["single"] & (n("su") == 1))
        first = high & (f["relaxed"] >= 2.0) & backed
        relaxed = first | F.when(f["code"] & (n("k") > 0), by_code).otherwise((n("ph") >= 2) & (f["relaxed"] >= 2.2))
        return F.when(~gate, None).when(strict, "strict").when(relaxed, "relaxed")

    x = x.withColumn("_f", F.filter(F.transform("_f", lambda f: f.withField("tier", tier(f))), lambda f: f["tier"].isNotNull()))
    rank = F.transform("_f", lambda f: F.struct((-F.when(f["tier"] == "strict", f["strict"]).otherwise(f["relaxed"])).alias("minus"), f["id"].alias("id"), f.alias("f")))
    general, none = fallback_topic(F.col(code)), F.array().cast("array<string>")

    def proof(r: Column) -> Column:
        return F.struct(
            r["f"]["k"].alias("keyword_hits"), r["f"]["ph"].alias("phrase_keyword_hits"), r["f"]["si"].alias("signal_keyword_hits"), r["f"]["su"].alias("support_keyword_hits"), r["f"]["p"].alias("program_hits"),
            r["f"]["a"].alias("act_hits"), r["f"]["code"].alias("issue_code_match"), r["f"]["tier"].alias("assignment_tier"),
        )

    bare = F.struct(*[none.alias(c) for c in ("keyword_hits", "phrase_keyword_hits", "signal_keyword_hits", "support_keyword_hits", "program_hits", "act_hits")], F.lit(True).alias("issue_code_match"), F.lit("fallback").alias("assignment_tier"))

    def outcome(ranked: Column) -> Column:
        ids, some = F.transform(ranked, lambda r: r["id"]), F.size(ranked) > 0
        scores = F.map_from_arrays(ids, F.transform(ranked, lambda r: F.round(-r["minus"], 3)))
        return F.struct(
            F.when(some, ids).when(general.isNotNull(), F.array(general)).otherwise(none).alias("topics"),
            F.when(some, scores).when(general.isNotNull(), F.create_map(general, F.lit(0.2))).otherwise(F.create_map().cast("map<string,double>")).alias("topic_scores"),
            F.when(some, F.map_from_arrays(ids, F.transform(ranked, proof))).when(general.isNotNull(), F.create_map(general, bare)).alias("topic_evidence"),
        )

    # inline makes the three columns of one evaluation; as fields of a struct they would each repeat it
    return x.select(*df.columns, F.inline(F.array(let(F.slice(F.array_sort(rank), 1, MOST_TOPICS), outcome))))


def laws(text: Column) -> Column:
    """References to bills, laws, codes and acts in a text: by pattern, then place, each once whatever its case, at most MOST_LAWS."""
    every = F.concat(*[F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(p), F.lit(0)) for p in LAW_PATTERNS])
    tidy = F.filter(F.transform(every, squeeze), lambda v: F.length(v) >= 4)
    once = F.aggregate(tidy, F.array().cast("array<string>"), lambda acc, v: F.when(F.exists(acc, lambda a: F.lower(a) == F.lower(v)), acc).otherwise(F.concat(acc, F.array(v))))
    return F.slice(once, 1, MOST_LAWS)


def entities(*sources: Column, patterns: Sequence[tuple[str, str]] = ENTITY_PATTERNS) -> Column:
    """Labels of the offices named in any of the sources, in the order of the patterns, at most MOST_ENTITIES."""
    def found(low: Column, padded: Column) -> Column:
        return F.transform(F.filter(_table(patterns), lambda e: _named(low, padded, e)), lambda e: e["n"])

    labels = let(F.lower(F.concat_ws(" ", *sources)), lambda low: let(_padded(low), lambda padded: found(low, padded)))
    return F.slice(F.array_distinct(labels), 1, MOST_ENTITIES)


def extract(activities: DataFrame, done: DataFrame, rules: Sequence[dict], version: str, least: int = 0) -> DataFrame:
    """Extraction rows of the activities (id, description, issue_code, agencies, houses_lobbied) that have none yet."""
    a = activities.where(F.length("description") > least) if least else activities
    a = pending(a.withColumn("activity_id", F.col("id")), done, "activity_id").withColumn("issue_code", F.upper(F.trim("issue_code")))
    x = topics(a, rules)
    found = entities(F.col("description"), F.col("agencies"), F.col("houses_lobbied"))
    return x.select("activity_id", F.col("issue_code").alias("l0_issue_code"), coarse_topic(F.col("issue_code")).alias("coarse_topic"), "topics", "topic_scores", "topic_evidence", found.alias("entities"), laws(F.col("description")).alias("legislation"), F.lit(version).alias("extractor_version"))


def dictionary_matches(df: DataFrame, id_col: str, text_col: str, phrases: Sequence[tuple[str, str]]) -> DataFrame:
    """Rows (id, label, phrase) of a dictionary of (phrase, label) found in texts."""
    x = df.select(F.col(id_col).alias("id"), F.lower(F.coalesce(F.col(text_col), F.lit(""))).alias("low"))
    hits = let(_padded(F.col("low")), lambda padded: F.filter(_table(phrases), lambda e: _named(F.col("low"), padded, e)))
    return x.select("id", F.explode(hits).alias("m")).select("id", F.col("m.n").alias("label"), F.col("m.p").alias("phrase"))


def mining_terms(text: Column) -> Column:
    """Words of 3 to 32 characters without stop words, and pairs of those that follow each other, but for generic pairs."""
    words = F.filter(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[a-z][a-z0-9\-]{2,}"), F.lit(0)), lambda w: ~w.isin(*STOP_WORDS) & (F.length(w) <= 32))
    pairs = F.filter(F.zip_with(words, F.slice(words, 2, 1_000_000), lambda a, b: F.concat(a, F.lit(" "), b)), lambda p: p.isNotNull() & ~p.isin(*GENERIC_PAIRS))
    return F.concat(words, pairs)


def mine_candidates(docs: DataFrame, per_code: int = 0, least_df: int = 5, least_lift: float = 2.0, top: int = 50, most_lift: float = 250.0) -> DataFrame:
    """Terms typical of a code: docs (id, code, text); per code the first per_code documents with any term (0: all) count.

    lift is the smoothed rate in the code over that outside it, score log1p(min(lift, most_lift)) * log1p(doc_freq).
    """
    x = docs.where("trim(code) <> ''").select("id", F.trim("code").alias("code"), F.array_distinct(mining_terms(F.col("text"))).alias("terms")).where(F.size("terms") > 0)
    if per_code:
        x = x.withColumn("n", F.row_number().over(Window.partitionBy("code").orderBy("id"))).where(F.col("n") <= per_code).drop("n")
    sizes = x.groupBy("code").agg(F.count(F.lit(1)).alias("issue_doc_count"))
    total = sizes.agg(F.sum("issue_doc_count").alias("corpus_doc_count"))
    per = x.select("code", F.explode("terms").alias("term")).groupBy("code", "term").agg(F.count(F.lit(1)).alias("doc_freq"))
    per = per.withColumn("all_freq", F.sum("doc_freq").over(Window.partitionBy("term")))
    y = per.where(F.col("doc_freq") >= least_df).where(~F.col("term").startswith("section ")).join(sizes, "code").crossJoin(F.broadcast(total))
    rest = F.greatest(F.col("corpus_doc_count") - F.col("issue_doc_count"), F.lit(1))
    lift = ((F.col("doc_freq") + 1.0) / (F.col("issue_doc_count") + 2.0)) / ((F.col("all_freq") - F.col("doc_freq") + 1.0) / (rest + 2.0))
    y = y.withColumn("lift", lift).where(F.col("lift") >= least_lift).withColumn("score", F.log1p(F.least("lift", F.lit(most_lift))) * F.log1p("doc_freq"))
    y = y.withColumn("ngram", F.when(F.col("term").contains(" "), 2).otherwise(1))
    y = y.withColumn("rank", F.row_number().over(Window.partitionBy("code").orderBy(F.desc(F.round("score", 6)), F.desc("doc_freq"), "term"))).where(F.col("rank") <= top)
    return y.select("code", "rank", "term", "ngram", "doc_freq", "issue_doc_count", "corpus_doc_count", "lift", "score")


def gap_report(coverage: DataFrame, candidates: DataFrame, snippets: DataFrame, codes: int = 10, terms: int = 10, texts: int = 3) -> DataFrame:
    """The least covered codes with their candidate terms and some untagged texts. coverage: code, n, pct. snippets: code, id, snippet."""
    worst = coverage.orderBy("pct", F.desc("n"), "code").limit(codes)
    t = candidates.where(F.col("rank") <= terms).groupBy("code").agg(F.expr("transform(array_sort(collect_list(struct(rank, term))), x -> x.term)").alias("terms"))
    order = Window.partitionBy("code").orderBy(F.md5(F.col("id").cast("string")), "id")
    s = snippets.withColumn("n", F.row_number().over(order)).where(F.col("n") <= texts).groupBy("code").agg(F.expr("transform(array_sort(collect_list(struct(n, snippet))), x -> x.snippet)").alias("snippets"))
    return worst.join(t, "code", "left").join(s, "code", "left")


def dictionary_loop(docs: DataFrame, seed: Sequence[tuple[str, str]], propose, target: float = 0.9, rounds: int = 5, least_hits: int = 3, banned: Sequence[str] = (), budget: float | None = None, cost: float = 0.0) -> tuple[list[tuple[str, str]], list[float]]:
    """Grow a dictionary until enough documents (id, text) are covered: apply, measure, let propose(uncovered) give (phrase, label)s, keep those that hit.

    propose gets the uncovered documents as a DataFrame. Ends at the target share, without new phrases, after the rounds, or
    before a proposal (of a cost each) would exceed the budget. Banned phrases, and those below 3 or above 60 characters, are
    never taken.
    Returns the phrases and the coverage of each round.
    """
    phrases, history, total = list(dict.fromkeys(seed)), [], max(1, docs.count())
    for _ in range(rounds):
        covered = dictionary_matches(docs, "id", "text", phrases).select("id").distinct()
        history.append(covered.count() / total)
        if history[-1] >= target:
            break
        if budget is not None and cost * len(history) > budget:
            break
        open_docs = docs.join(covered, "id", "left_anti")
        new = [(p, n) for p, n in propose(open_docs) if 3 <= len(p) <= 60 and p not in banned and (p, n) not in phrases]
        if new:
            hits = {r.phrase for r in dictionary_matches(open_docs, "id", "text", new).groupBy("phrase").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_hits).collect()}
            new = [x for x in new if x[0] in hits]
        if not new:
            break
        phrases += new
    return phrases, history


def _counts(words: Sequence[str], width: int, bins: int) -> np.ndarray:
    """Of each word how often its runs of some characters fall into each of some bins: shared bins are never fewer than shared runs."""
    out = np.zeros((len(words), bins), np.uint16)
    for k, w in enumerate(words):
        for i in range(len(w) - width + 1):
            out[k, sum(ord(c) * 31**j for j, c in enumerate(w[i : i + width])) % bins] += 1
    return out


def _common(masks: dict[str, int], n: int, b: str) -> int:
    """Length of the longest common subsequence of b and a word of n characters, masks having the positions of each."""
    full = v = (1 << n) - 1
    for c in b:
        u = v & masks.get(c, 0)
        v = ((v + u) | (v - u)) & full
    return n - v.bit_count()


def _close_pairs(left: list[str], right: list[str], ratio: float) -> Iterator[tuple[str, str, float]]:
    """(a, b, ratio) of the pairs of one word of each side; every filter before the matcher is an upper bound of what it can match."""
    low = [w.lower() for w in right]
    size, letters, twos = np.array([len(w) for w in low]), _counts(low, 1, 64), _counts(low, 2, 256)
    own = [w.lower() for w in left]
    for x, w, c1, c2 in zip(left, own, _counts(own, 1, 64), _counts(own, 2, 256)):
        total = size + len(w)
        need = ratio * total - 1e-9  # twice the matched characters exceed it
        at = np.flatnonzero(2 * np.minimum(size, len(w)) > need)
        at = at[2 * np.minimum(letters[at], c1).sum(1) > need[at]]
        # m matched characters of t in all have at least m - 1 - (t - 2m) neighbours in common
        at = at[np.minimum(twos[at], c2).sum(1, dtype=np.int64) > 1.5 * need[at] - total[at] - 1]
        masks: dict[str, int] = {}
        for i, c in enumerate(w):
            masks[c] = masks.get(c, 0) | 1 << i
        for k in at:
            if low[k] != w and 2 * _common(masks, len(w), low[k]) > need[k]:
                (a, s), (b, t) = sorted(((x, w), (right[k], low[k])))
                if ratio < (r := SequenceMatcher(None, s, t).ratio()) < 1:
                    yield a, b, r


def near_variants(values: DataFrame, col: str, least: int = 2, ratio: float = 0.8) -> DataFrame:
    """Pairs (a, b, ratio) of frequent values that differ but match by more than ratio of their characters in any case (of either order the first smaller).

    Every two values meet: they are dealt to blocks of bounded size and each two blocks are compared in one group.
    """
    v = cut_lineage(values.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("v")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least).select("v"))
    blocks, spark = 1 + v.count() // VARIANT_BLOCK, values.sparkSession
    dealt = v.withColumn("h", F.pmod(F.xxhash64("v"), F.lit(blocks))).withColumn("o", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    dealt = dealt.select("v", F.least("h", "o").alias("i"), F.greatest("h", "o").alias("j"), (F.col("h") <= F.col("o")).alias("first"))
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def match(f: pd.DataFrame) -> pd.DataFrame:
        left, right = f.v[f["first"]], f.v if f.i.iloc[0] == f.j.iloc[0] else f.v[~f["first"]]
        return pd.DataFrame(_close_pairs(list(left), list(right), ratio), columns=["a", "b", "ratio"]).drop_duplicates()

    return dealt.repartition(tasks, "i", "j").groupBy("i", "j").applyInPandas(match, "a string, b string, ratio double")


def rename_evidence(names: DataFrame, col: str = "name") -> DataFrame:
    """Rows (name, present, former) of names that give a former one."""
    mark = r"(?i)^(.*?)[\s(]+(?:formerly(?:\s+known\s+as)?|fka|f/k/a)\s+(.*?)\)?\s*$"
    n = lambda i: F.btrim(F.regexp_extract(col, mark, i), F.lit(" ,;()"))
    return names.where(F.col(col).rlike(mark)).select(F.col(col).alias("name"), n(1).alias("present"), n(2).alias("former"))


def prefix_pairs(keys: DataFrame, most_more: int = 3) -> DataFrame:
    """Pairs (shorter, longer) of keys where one begins with the other's words and has up to most_more more.

    A key is joined on its own beginnings, so its rows are few however many keys share a first word.
    """
    k = keys.select("key").where("key <> ''").distinct()
    words = F.split("key", " ")
    more = F.sequence(F.lit(1), F.least(F.lit(most_more), F.size(words) - 1))
    begins = k.where(F.size(words) > 1).select(F.col("key").alias("longer"), F.explode(F.transform(more, lambda n: F.array_join(F.slice(words, F.lit(1), F.size(words) - n), " "))).alias("shorter"))
    return begins.join(k.withColumnRenamed("key", "shorter"), "shorter").select("shorter", "longer").distinct()


def quoted(s: str) -> str:
    return re.sub(r"([^\w\s])", r"\\\1", s)


def group_tags(df: DataFrame, groups: Sequence[tuple[str, Sequence[str]]], text: str = "description", most: int = 5, name: str = "groups") -> DataFrame:
    """df with the labels of the groups of phrases that a text contains (anywhere, any case), the first few by the alphabet: a plain tagger without scores."""
    table = F.array(*[F.struct(F.lit(n).alias("n"), F.array(*map(F.lit, ps)).alias("ps")) for n, ps in groups])
    low = F.lower(F.coalesce(F.col(text), F.lit("")))
    hits = F.filter(table, lambda g: F.exists(g["ps"], lambda p: low.contains(p)))
    return df.withColumn(name, F.slice(F.array_sort(F.transform(hits, lambda g: g["n"])), 1, most))
