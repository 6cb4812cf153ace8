"""Document quality by hierarchical empirical Bayes.

A logistic classifier on text statistics gives each document's evidence: its log-odds beyond
the base rate. Grouped aggregation gives every host and every path of a host its rate of good
documents; a sparse path shrinks toward its host, a sparse host toward the global rate, with
strengths estimated from how much the rates really differ (method of moments). The posterior
log-odds of a document are its path's plus its own evidence.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aquifold.llm.common import shielded, unshielded, without
from aquifold.session import stage


def text_statistics(text: Column) -> dict[str, Column]:
    """Shares of a whole text that tell prose from tables, repetition, shouting and symbol noise; all 0 for an empty one."""
    characters = F.greatest(F.length(text), F.lit(1))
    words = F.greatest(F.regexp_count(text, F.lit(r"\S+")), F.lit(1))

    def share(pattern: str, of: Column) -> Column:
        return F.sqrt(F.regexp_count(text, F.lit(pattern)) / of)

    return {
        "symbols": share(r"[^\p{L}\p{N}\s.,;:!?'\"()|-]", characters),
        "bars": share(r"\|", words),
        "shouts": share(r"!", words),
        "capitals": share(r"\p{Lu}", characters),
        "digits": share(r"\p{N}", characters),
        "repeats": share(r"(?<!\S)(\S+)(?=\s+\1(?!\S))", words),
        "stops": share(r"[.](?!\S)", words),
        "lines": share(r"\n", words),
        "length": F.log1p(words) / 10,
    }


def host_of(source: Column) -> Column:
    return F.regexp_extract(F.coalesce(F.lower(source.cast("string")), F.lit("")), r"^(?:[a-z]+://)?([^/?#]*)", 1)


def path_of(source: Column, section: Column) -> Column:
    """First step of the source's path; of a source without one, the section (its language)."""
    step = F.regexp_extract(F.coalesce(source.cast("string"), F.lit("")), r"^(?:[A-Za-z]+://)?[^/?#]*/([^/?#]*)", 1)
    return F.when(step != "", step).otherwise(F.coalesce(section.cast("string"), F.lit("")))


@dataclass
class QualityModel:
    """Classifier weights, base rate, and the posterior rate of each (host, path)."""

    weights: dict[str, float]
    base: float
    paths: DataFrame

    def evidence(self, text: Column) -> Column:
        total = F.lit(self.weights.get("intercept", 0.0))
        for name, value in text_statistics(text).items():
            if name in self.weights:
                total = total + self.weights[name] * value
        return total - F.lit(math.log(self.base / (1 - self.base)))


def _strength(groups: DataFrame, rate: Column, prior: Column) -> float:
    """Pseudo-counts of a prior from groups with ``good`` of ``n``: variance between rates beyond that of sampling."""
    noise = prior * (1 - prior) / F.col("n")
    weight = F.col("n")
    row = groups.agg(
        F.sum(weight * ((rate - prior) ** 2 - noise)).alias("spread"), F.sum(weight * prior * (1 - prior)).alias("level"),
        F.sum(weight).alias("n"),
    ).first()
    if not row["n"]:
        return 1.0
    spread = max(row["spread"] / row["n"], 1e-6)
    return min(1e6, max(1.0, row["level"] / row["n"] / spread - 1))


def _posteriors(rows: DataFrame, base: float) -> DataFrame:
    """(host, path, rate) from rows of (host, path, good); each level one grouped aggregate of the one below."""
    paths = stage(rows.groupBy("host", "path").agg(F.sum("good").alias("good"), F.count("*").alias("n")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
    k = _strength(hosts, F.col("good") / F.col("n"), F.lit(base))
    host_rate = (F.col("good") + k * base) / (F.col("n") + k)
    both = paths.join(hosts.select("host", host_rate.alias("host_rate")), "host")
    k = _strength(both, F.col("good") / F.col("n"), F.col("host_rate"))
    rate = (F.col("good") + k * F.col("host_rate")) / (F.col("n") + k)
    return stage(both.select("host", "path", rate.alias("rate")), "posteriors")


def fit(docs: DataFrame, labels: DataFrame) -> QualityModel:
    """Classifier from all labelled documents; rates from all documents, the label where there is one, else the classifier.

    Without labels, or with labels of one class, the classifier has no weights and documents
    are judged by their sites alone. Several labels of one document are averaged.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    statistics = text_statistics(text)
    rows = stage(
        docs.select(
            "doc_id", host_of(F.col("source")).alias("host"), path_of(F.col("source"), F.col("lang")).alias("path"),
            *[c.alias(n) for n, c in statistics.items()],
        ),
        "statistics",
    )
    known = labels.filter("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.avg("quality").alias("quality"))
    marked = stage(rows.join(known, "doc_id", "left"), "marked")
    labelled = marked.filter("quality is not null").withColumn("label", (F.col("quality") >= 0.5).cast("double"))
    n, good = labelled.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    base = (good + 1) / (n + 2) if n else 0.5
    weights: dict[str, float] = {}
    if 0 < good < n:
        names = list(statistics)
        data = VectorAssembler(inputCols=names, outputCol="features").transform(labelled.select("label", *names))
        model = LogisticRegression(maxIter=60, regParam=1e-4).fit(data)
        weights = dict(zip(names, map(float, model.coefficients), strict=True)) | {"intercept": float(model.intercept)}
    if weights:
        total = F.lit(weights["intercept"])
        for name in statistics:
            total = total + weights[name] * F.col(name)
        chance = 1 / (1 + F.exp(-total))
    else:
        chance = F.lit(base)
    good_column = F.coalesce(F.col("quality"), chance)
    return QualityModel(weights, base, _posteriors(marked.select("host", "path", good_column.alias("good")), base))


_RESULTS = ("evidence", "site_rate", "quality_score", "keep")


def judge(model: QualityModel, docs: DataFrame, least: float = 0.5, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``evidence``, ``site_rate``, ``quality_score`` (posterior, 0 to 1) and ``keep``.

    Needs text, source and lang. Null texts count as empty, null sources and languages as the empty
    host and path; a site that was not fitted has the base rate. Columns of these names are replaced, others
    pass through (``keep`` selects some); rows are judged one by one, so repeats and null ids need
    no care. The evidence is written to the shared folder with them, so that texts are measured
    once however often it is used. They join only the table of sites, whose host and path keys
    Spark can split if one is hot.
    """
    docs = without(docs, *_RESULTS)
    columns = keep or docs.columns
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    placed = stage(
        docs.select(
            *[F.col(f"`{c}`") for c in columns], host_of(F.col("source")).alias("__host"),
            path_of(F.col("source"), F.col("lang")).alias("__path"), model.evidence(text).alias("evidence"),
        ),
        "evidence",
    )
    sites = model.paths.select(F.col("host").alias("__host"), F.col("path").alias("__path"), F.col("rate").alias("site_rate"))
    joined = placed.join(sites, ["__host", "__path"], "left").withColumn("site_rate", F.coalesce("site_rate", F.lit(model.base)))
    bounded = F.least(F.greatest("site_rate", F.lit(1e-6)), F.lit(1 - 1e-6))
    score = 1 / (1 + F.exp(-(F.col("evidence") + F.log(bounded / (1 - bounded)))))
    return joined.withColumn("quality_score", score).withColumn("keep", score >= least).select(
        *[F.col(f"`{c}`") for c in columns], "evidence", "site_rate", "quality_score", "keep"
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents judged good, with their own columns."""
    judged = judge(fit(docs, labels), shielded(docs, *_RESULTS))
    return unshielded(judged.filter("keep"), docs.columns)
