"""Queries of the text and name problems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyspark.llm import lookup, mixing, names, spans, subjects, tokens
from tallyspark.sources.tables import table


def _documents(spark: SparkSession, d: str, *more: str) -> DataFrame:
    return table(spark, d, "documents", "doc_id", "text", *more)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return subjects.subjects(
        table(spark, d, "activities", "id", "description", "issue_code"), _documents(spark, d, "lang"), table(spark, d, "subject_areas", "subject", "issue_codes"), table(spark, d, "subject_labels", "doc_id", "subject")
    )


def p1_volume(spark: SparkSession, d: str) -> DataFrame:
    """Records per kind and subject."""
    return p1_found(spark, d).groupBy("rec_kind", "subject").agg(F.count(F.lit(1)).alias("n_records"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    acts = table(spark, d, "activities", F.col("id").alias("activity_id"), "filing_id")
    years = acts.join(table(spark, d, "filings", F.col("id").alias("filing_id"), "year"), "filing_id").select("activity_id", "year")
    rules = table(spark, d, "activity_extractions_rules", "activity_id", "legislation", "entities")
    return lookup.resolve_entries(rules, years, table(spark, d, "legislation_ref"), table(spark, d, "agency_ref"))


def p3_unlisted(spark: SparkSession, d: str) -> DataFrame:
    """Entries that mean no listed row, with how often they occur."""
    rules = table(spark, d, "activity_extractions_rules", "activity_id", "legislation", "entities")
    typed = [rules.select("activity_id", F.lit(c).alias("field_name"), F.posexplode(c).alias("p", "entry")) for c in ("legislation", "entities")]
    rows = typed[0].unionByName(typed[1]).withColumn("pos", F.col("p") + 1)
    missed = p3_found(spark, d).where("ref_id = 0")
    return rows.join(missed, ["activity_id", "field_name", "pos"], "left_semi").groupBy("field_name", "entry").agg(F.count(F.lit(1)).alias("n_entries"))


def _parties(spark: SparkSession, d: str) -> DataFrame:
    return names.linked_rows({party: table(spark, d, t, "id", "name", "normalized_name") for party, t in (("client", "clients"), ("registrant", "registrants"))})


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return names.linked_pairs(_parties(spark, d))


def p5_parties(spark: SparkSession, d: str) -> DataFrame:
    """One row per client and registrant with the smallest id of its party."""
    linked = _parties(spark, d)
    smallest = linked.groupBy("party", "comp").agg(F.min("id").alias("party_id"), F.count(F.lit(1)).alias("n_rows"))
    return linked.join(smallest, ["party", "comp"]).select("party", "id", "party_id", "n_rows")


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode_texts(_documents(spark, d), tokens.vocabulary("byte_bpe_50k")).withColumnRenamed("id", "doc_id")


#: Slopes of the sources' weight schedules: bill summaries and fact sheets early, filing narratives late.
SLOPES = {"bill_summary": 0.5, "fact_sheet": 0.5, "filing_narrative": -0.25}


def _mixed(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    sized = tokens.count_tokens(_documents(spark, d, "source"), tokens.vocabulary("byte_bpe_50k"), keep=("source",))
    return mixing.mix(sized, table(spark, d, "mix_targets", "source", "target_share", "max_repeats"), SLOPES)


def p9_schedule(spark: SparkSession, d: str) -> DataFrame:
    """Each use of a document in the mix, in training order."""
    return _mixed(spark, d)[0]


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    """Of each source, the share asked and the share reached."""
    return _mixed(spark, d)[1]


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return spans.sharing_pairs(_documents(spark, d))


def p10_shares(spark: SparkSession, d: str) -> DataFrame:
    """Of each document, the characters that also stand elsewhere."""
    return spans.shared_share(_documents(spark, d))


def p10_links(spark: SparkSession, d: str) -> DataFrame:
    """The same as p10_found between different texts, by the smallest doc_id of each; p10_classes has the members."""
    return spans.text_links(_documents(spark, d))


def p10_classes(spark: SparkSession, d: str) -> DataFrame:
    """Of each document of at least 200 characters, the smallest doc_id with the same text."""
    return spans.text_classes(_documents(spark, d)).select(F.col("id").alias("doc_id"), F.col("rep").alias("class_id"))


QUERIES = {f.__name__: f for f in (p1_found, p1_volume, p3_found, p3_unlisted, p5_found, p5_parties, p8_ids, p9_schedule, p9_shares, p10_found, p10_shares, p10_links, p10_classes)}
