"""Schemas of the stored tables; arrays, maps and structs are native."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_TYPES = {"string": T.StringType(), "long": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "strings": T.ArrayType(T.StringType())}


def _fields(text: str, **nested: T.DataType) -> T.StructType:
    """'name type, name type': type is one of _TYPES or a nested one by its name."""
    return T.StructType([T.StructField(n, nested.get(t) or _TYPES[t]) for n, t in (f.split() for f in text.split(","))])


_PARTY = _fields("id string, name string")
_ENTITIES = T.ArrayType(_fields("name string"))
_LOBBYING = T.ArrayType(_fields("description string, specific_issues string, general_issue_code string, government_entities entities", entities=_ENTITIES))
_EVIDENCE = _fields("keyword_hits strings, phrase_keyword_hits strings, signal_keyword_hits strings, support_keyword_hits strings, program_hits strings, act_hits strings, issue_code_match boolean, assignment_tier string")

FILING = _fields(
    "filing_uuid string, filing_year int, filing_period string, filing_type string, income string, expenses string, dt_posted string, filing_date string, registrant party, client party, lobbying_activities lobbying",
    party=_PARTY, lobbying=_LOBBYING,
)
REGISTRANTS = _fields("id long, sopr_id string, name string, normalized_name string")
CLIENTS = _fields("id long, sopr_id string, name string, normalized_name string, industry string, general_description string, state string, country string")
FILINGS = _fields("id long, sopr_filing_id string, registrant_id long, client_id long, year int, quarter int, income double, expenses double, filing_date string, filing_type string, is_current boolean")
ACTIVITIES = _fields("id long, filing_id long, description string, issue_code string, houses_lobbied string, agencies string")
ISSUES = _fields("id long, activity_id long, issue_label string, confidence double")
EXTRACTIONS = _fields(
    "activity_id long, l0_issue_code string, coarse_topic string, topics strings, topic_scores scores, topic_evidence evidence, entities strings, legislation strings, extractor_version string",
    scores=T.MapType(T.StringType(), T.DoubleType()), evidence=T.MapType(T.StringType(), _EVIDENCE),
)
CANDIDATE_TERMS = _fields("issue_code string, term string, ngram int, doc_freq long, issue_doc_count long, corpus_doc_count long, lift double, score double, extractor_version string")
SIGNALS = _fields("signal_type string, entity string, current_value double, prior_value double, growth_rate double, historical_pct double, magnitude double, q int, year int, quarter int")
AUDIT_LOG = _fields("id long, ts string, sampled int, missing int, income_mismatch int, activity_mismatch int, errors int, details string")
TABLES = {"registrants": REGISTRANTS, "clients": CLIENTS, "filings": FILINGS, "activities": ACTIVITIES, "issues": ISSUES, "activity_extractions_rules": EXTRACTIONS, "topic_candidate_terms": CANDIDATE_TERMS, "signals": SIGNALS, "audit_log": AUDIT_LOG}


def migrate(df: DataFrame, schema: T.StructType) -> DataFrame:
    """df with the columns of a schema: missing ones null, others cast, unknown ones left out."""
    from pyspark.sql import functions as F

    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])
