"""A classifier of issue codes from descriptions, and the interface to a language model."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, IndexToString, NGram, RegexTokenizer, SQLTransformer, StopWordsRemover, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F


def labelled(activities: DataFrame, least: int = 20) -> DataFrame:
    """Rows (id, text, label) of described activities whose code occurs often enough; label is the code."""
    x = activities.where("length(description) > 20 and trim(issue_code) <> ''").select("id", F.col("description").alias("text"), F.upper(F.trim("issue_code")).alias("label"))
    often = x.groupBy("label").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    return x.join(often.select("label"), "label", "left_semi")


def split(x: DataFrame, test_share: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Train and test rows, split within each label by the order of a hash: the same in every run."""
    w = Window.partitionBy("label")
    y = x.withColumn("p", (F.row_number().over(w.orderBy(F.xxhash64("id", F.lit(seed)), "id")) - 1) / F.count(F.lit(1)).over(w))
    return y.where(F.col("p") >= test_share).drop("p"), y.where(F.col("p") < test_share).drop("p")


def train(rows: DataFrame, features: int = 1 << 14, iterations: int = 30) -> PipelineModel:
    """TF-IDF of words and pairs of words with a logistic regression, rare labels weighing as much as frequent ones."""
    n = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    total = n.agg(F.sum("n").alias("all"), F.count(F.lit(1)).alias("k"))
    weighted = rows.join(n, "label").crossJoin(F.broadcast(total)).withColumn("weight", F.col("all") / (F.col("k") * F.col("n")))
    index = StringIndexer(inputCol="label", outputCol="target", stringOrderType="alphabetAsc").fit(weighted)
    stages = [
        RegexTokenizer(inputCol="text", outputCol="raw", pattern=r"[^\p{L}\p{N}]+"), StopWordsRemover(inputCol="raw", outputCol="words"), NGram(n=2, inputCol="words", outputCol="pairs"),
        SQLTransformer(statement="select *, concat(words, pairs) as terms from __THIS__"), HashingTF(inputCol="terms", outputCol="tf", numFeatures=features), IDF(inputCol="tf", outputCol="features", minDocFreq=2),
        LogisticRegression(labelCol="target", featuresCol="features", weightCol="weight", maxIter=iterations, regParam=0.01), IndexToString(inputCol="prediction", outputCol="predicted", labels=index.labels),
    ]
    return Pipeline(stages=stages).fit(index.transform(weighted))


def predict(model: PipelineModel, rows: DataFrame, k: int = 3) -> DataFrame:
    """Rows (id, predicted, top: array of (label, p), best first)."""
    labels = F.array(*map(F.lit, model.stages[-1].getLabels()))
    p = F.zip_with(labels, vector_to_array("probability"), lambda n, v: F.struct((-v).alias("m"), n.alias("label")))
    top = F.transform(F.slice(F.array_sort(p), 1, k), lambda x: F.struct(x["label"].alias("label"), (-x["m"]).alias("p")))
    return model.transform(rows).select("id", "predicted", top.alias("top"))


def ask_model(df: DataFrame, id_col: str, prompt_col: str, answer: Callable[[list[str]], list[str | None]], taxonomy: list[str] | None = None, least: int = 20) -> DataFrame:
    """Rows (id, answer) of prompts put to a model in batches; prompts below least characters get none, and answers outside a taxonomy are null.

    answer(prompts) returns one string or None each; it runs on the executors.
    """
    kind = df.schema[id_col].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = answer(f["prompt"].tolist())
            yield pd.DataFrame({"id": f["id"], "answer": [a if a is not None and (taxonomy is None or a in taxonomy) else None for a in out]})

    x = df.select(F.col(id_col).alias("id"), F.col(prompt_col).alias("prompt")).where(F.length("prompt") >= least)
    return x.mapInPandas(run, f"id {kind}, answer string")


def phrase_prompt(samples: DataFrame, known: list[str], label_col: str = "label", text_col: str = "text", texts: int = 20, chars: int = 400) -> DataFrame:
    """Rows (label, prompt): for each label a request for phrases, with some of its texts (by a hash, cut to chars) and the phrases known already."""
    order = Window.partitionBy(label_col).orderBy(F.md5(text_col), text_col)
    few = samples.where(F.length(F.trim(text_col)) > 0).withColumn("n", F.row_number().over(order)).where(F.col("n") <= texts)
    lines = few.groupBy(F.col(label_col).alias("label")).agg(F.array_sort(F.collect_list(F.concat(F.lit("- "), F.substring(F.regexp_replace(text_col, r"\s+", " "), 1, chars)))).alias("lines"))
    head = F.format_string("Phrases that name the subject %s, as a JSON array of objects with phrase and label. Not these: %s\n", F.col("label"), F.lit(", ".join(known)))
    return lines.select("label", F.concat(head, F.array_join("lines", "\n")).alias("prompt"))


def reply_items(reply: Column, banned: list[str] | None = None, least: int = 3, most: int = 60) -> Column:
    """array<struct<phrase, label>> of a reply: JSON with or without a fence and words around it; items without a label, too short, too long or banned are left out, a reply that is no JSON gives none."""
    body = F.regexp_extract(F.coalesce(reply, F.lit("")), r"(?s)(\[.*\])", 1)
    items = F.coalesce(F.from_json(body, "array<struct<phrase:string,label:string>>"), F.array().cast("array<struct<phrase:string,label:string>>"))
    tidy = F.transform(items, lambda x: F.struct(F.lower(F.trim(F.regexp_replace(x["phrase"], r"\s+", " "))).alias("phrase"), F.trim(x["label"]).alias("label")))
    good = lambda x: F.length(x["phrase"]).between(least, most) & (F.length(x["label"]) > 0) & ~x["phrase"].isin(*(banned or [""]))
    return F.array_distinct(F.filter(tidy, good))


def spend(calls: DataFrame, price_in: float, price_out: float) -> DataFrame:
    """Cost of model calls (tokens_in, tokens_out) at prices per million tokens."""
    return calls.agg(F.count(F.lit(1)).alias("calls"), (F.sum("tokens_in") / 1e6 * price_in + F.sum("tokens_out") / 1e6 * price_out).alias("cost"))
