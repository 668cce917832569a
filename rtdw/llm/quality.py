"""Quality by hierarchical empirical Bayes: document evidence, host and path posteriors.

A logistic regression on text statistics gives each document its evidence: the factor by
which its text moves the odds away from the global rate. Hosts and paths get the mean
quality of their documents (the label where there is one, else the document's
probability), shrunk toward the level above: a path toward its host, a host toward the
global rate. How strongly is estimated from the spread of the groups themselves. A site
with few documents stays close to the prior, one with many shows its own rate.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rtdw.llm.logistic import bounded_sample, fit_logistic, margin, probability
from rtdw.llm.tables import stored, table, text_key

#: Labelled rows that the regression is fitted on, at most about this many.
MAX_LABELLED = 50_000
#: A site's rate is kept within these bounds before it becomes a prior.
LOWEST_RATE, HIGHEST_RATE = 0.02, 0.98

SYMBOLS = "#$%&*<>{}[]^~\\=+_@|!"


def _share(text: Column, chars: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, chars, ""))) / F.greatest(F.length(text), F.lit(1))


def text_statistics(text: Column) -> dict[str, Column]:
    """Statistics of a whole text; all are 0 for an empty one."""
    words = F.split(text, " ")
    n_words, different = F.size(words), F.size(F.array_distinct(words))
    lines = F.split(text, "\n")
    return {
        "log_chars": F.log1p(F.length(text)),
        "pipes": F.sqrt(_share(text, "|")),
        "symbols": F.sqrt(_share(text, SYMBOLS)),
        "upper": F.sqrt(_share(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ")),
        "digits": F.sqrt(_share(text, "0123456789")),
        "word_chars": F.log1p(F.length(text) / n_words),
        "repetition": 1 - different / n_words,
        "growth": F.log(different.cast("double")) / F.log(n_words + 1.0),
        "line_repetition": 1 - F.size(F.array_distinct(lines)) / F.size(lines),
    }


def statistics_table(docs: DataFrame, labels: DataFrame, host: str, path: str) -> DataFrame:
    """Per document: doc_id, text_key, host, path, its statistics, and its label or null.

    A document with several labels counts as good if at least half of them say so.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        "doc_id", text_key().alias("text_key"),
        F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"),
        F.coalesce(F.col(path).cast("string"), F.lit("")).alias("path"),
        *(column.cast("double").alias(name) for name, column in text_statistics(text).items()),
    )
    known = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.when(F.avg("quality") >= 0.5, 1.0).otherwise(0.0).alias("label")
    )
    return rows.join(known, "doc_id", "left")


def site_rates(rows: DataFrame, keys: list[str], prior: Column) -> DataFrame:
    """The mean quality of each group, shrunk toward its prior.

    ``rows`` holds per group: ``n``, ``total`` (of the quality) and what ``prior`` needs.
    The strength of the prior, in documents, is the method of moments' for groups whose
    rates spread around their priors.
    """
    p, n = prior, F.col("n")
    moments = rows.agg(
        F.sum(n).alias("n"), F.sum(n * n).alias("n2"), F.count("*").alias("groups"),
        F.sum(n * (F.col("total") / n - p) * (F.col("total") / n - p)).alias("between"),
        F.sum(n * p * (1 - p)).alias("within"),
    ).first()
    strength = 1e6
    if moments["groups"] and moments["within"]:
        spread = (moments["within"] / moments["n"])
        extra = (moments["between"] - moments["groups"] * spread) / moments["n"]
        if extra > 0:
            strength = min(max(spread / extra - 1, 1.0), 1e6)
    rate = (F.lit(float(strength)) * p + F.col("total")) / (F.lit(float(strength)) + n)
    return rows.select(*keys, rate.alias("rate"))


def quality(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang",
            threshold: float = 0.5, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """Per document: doc_id, text_key, evidence, host_rate, path_rate, score, keep.

    ``score`` is the posterior probability of good quality, ``keep`` whether it reaches the
    threshold. Repeated rows are documents of their own. A null text is an empty one, a
    null host or path is a site named ''. Without labels every document scores 0.5.
    """
    names = list(text_statistics(F.lit("")))
    rows = stored(statistics_table(docs, labels, host, path), "text-statistics")
    sample = bounded_sample(rows.filter("label is not null"), "doc_id", max_labelled)
    known = sample.select(*names, "label").toPandas().to_numpy(np.float64)
    model = fit_logistic(known[:, :-1], known[:, -1])
    rate = float((known[:, -1].sum() + 0.5) / (len(known) + 1))
    rate = min(max(rate, LOWEST_RATE), HIGHEST_RATE)
    scored = rows.select(
        "doc_id", "text_key", "host", "path", "label", margin(names, model).alias("margin")
    ).withColumn("believed", F.coalesce("label", probability(F.col("margin"))))
    paths = stored(
        scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("believed").alias("total")),
        "path-counts",
    )
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    host_rates = stored(site_rates(hosts, ["host"], F.lit(rate)), "host-rates")
    inside = paths.join(host_rates.withColumnRenamed("rate", "host_rate"), "host")
    path_rates = site_rates(inside, ["host", "path", "host_rate"], F.col("host_rate"))
    sites = stored(path_rates.withColumnRenamed("rate", "path_rate"), "path-rates")
    prior = F.greatest(F.lit(LOWEST_RATE), F.least(F.lit(HIGHEST_RATE), F.col("path_rate")))
    evidence = F.col("margin") - F.lit(float(np.log(rate / (1 - rate))))
    score = probability(evidence + F.log(prior / (1 - prior)))
    return scored.join(sites, ["host", "path"]).select(
        "doc_id", "text_key", evidence.alias("evidence"), "host_rate", "path_rate",
        score.alias("score"), (score >= threshold).alias("keep"),
    )


def op2_quality(spark, sf_dir: str) -> DataFrame:
    """Every document's quality; the host is its source, the path its language section."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality(docs, labels).drop("text_key")


def good_documents(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier does not reject."""
    judged = quality(docs, table(spark, sf_dir, "labels"))
    bad = judged.filter("not keep").select("doc_id", "text_key").distinct()
    same = [docs["doc_id"].eqNullSafe(bad["doc_id"]), text_key() == bad["text_key"]]
    return docs.join(bad, same, "left_anti")
