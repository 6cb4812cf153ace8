"""Isolation forest (Liu, Ting and Zhou, 2008) fitted and applied on Spark.

A tree needs only a small fixed-size sample, so fitting moves at most
``trees * sample_size`` rows however large the table is; each tree grows in its
own group. Scoring is a vectorised column function over the full table.

Every draw is the md5 of what it is drawn for: a row's key for the samples, the
node for its split. So the same table gives the same forest on any engine, and
the path lengths are whole numbers of a billionth, whose sums have no order.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from aquifold import schemas
from aquifold.functions.quantiles import unit_quantile
from aquifold.session import Staging, stage

_TREE_SCHEMA = "tree int, feature array<int>, threshold array<double>, path array<bigint>"
_SETTINGS_SCHEMA = "features array<string>, sample_size int, threshold double"
_OVERSAMPLING = 1.5
_UNIT = 10**9
_DIGITS = 13
_DENSE_LEVELS = 3


def _draws(*parts: str | Column) -> Column:
    """Number in [0, 1) drawn for the parts."""
    text = F.concat_ws("|", *[p if isinstance(p, Column) else F.lit(p) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, _DIGITS), 16, 10).cast("double") / float(16**_DIGITS)


def _draw(*parts: object) -> float:
    text = "|".join(map(str, parts))
    return int(hashlib.md5(text.encode()).hexdigest()[:_DIGITS], 16) / 16**_DIGITS


def row_key(keys: list[str]) -> Column:
    return F.concat_ws("|", *[F.col(k).cast("string") for k in keys])


def tree_samples(
    df: DataFrame, keys: list[str], trees: int, sample_size: int, rows: int, seed: int
) -> DataFrame:
    """``sample_size`` rows per tree, drawn without replacement by hash of the row key.

    A first draw keeps about as many rows as all trees need together; only those
    are offered to the trees, each of which takes its lowest hashes.
    """
    wanted = min(1.0, _OVERSAMPLING * sample_size / rows)
    keep = min(1.0, wanted * trees)
    per_tree = wanted / keep
    keyed = df.withColumn("key", row_key(keys))
    candidates = keyed.filter(_draws(str(seed), F.col("key")) < keep) if keep < 1.0 else keyed
    lowest = Window.partitionBy("tree").orderBy("draw", "key")
    return (
        candidates.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
        .withColumn("draw", _draws(str(seed), F.col("tree").cast("string"), F.col("key")))
        .filter(F.col("draw") < per_tree)
        .withColumn("place", F.row_number().over(lowest))
        .filter(F.col("place") <= sample_size)
        .drop("draw", "place", "key")
    )


def _expected_path(n: int) -> float:
    """Mean path length of an unsuccessful search among ``n`` points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + np.euler_gamma) - 2.0 * (n - 1.0) / n


def _grow(points: np.ndarray, depth_limit: int, seed: int, tree: int):
    """One tree as a complete binary layout: inner splits plus path length per bottom slot.

    A split takes one of the varying features, and a place between its ends, as drawn for the node. A branch that ends early keeps an infinite threshold, so every row reaches
    the bottom level by the same number of steps.
    """
    inner, slots = 2**depth_limit - 1, 2**depth_limit
    feature = np.zeros(inner, dtype=np.int32)
    threshold = np.full(inner, np.inf)
    path = np.zeros(slots, dtype=np.int64)
    pending = [(0, 0, points)]
    while pending:
        node, depth, rows = pending.pop()
        low, high = (rows.min(axis=0), rows.max(axis=0)) if len(rows) else (np.zeros(1), np.zeros(1))
        varying = np.flatnonzero(high > low)
        if depth == depth_limit or len(rows) <= 1 or not len(varying):
            slot = (node + 1) * 2 ** (depth_limit - depth) - slots
            path[slot] = round((depth + _expected_path(len(rows))) * _UNIT)
            continue
        chosen = int(varying[int(_draw(seed, tree, node, "feature") * len(varying))])
        cut = low[chosen] + _draw(seed, tree, node, "cut") * (high[chosen] - low[chosen])
        right = rows[:, chosen] > cut
        feature[node], threshold[node] = chosen, cut
        pending.append((2 * node + 1, depth + 1, rows[~right]))
        pending.append((2 * node + 2, depth + 1, rows[right]))
    return feature, threshold, path


def _path_sums(columns: list[np.ndarray], feature: np.ndarray, threshold: np.ndarray, path: np.ndarray) -> np.ndarray:
    """Path lengths of each row summed over the trees.

    Few nodes are cheaper compared for all rows at once, so the first levels are; below, each row's
    node is looked up, in arrays that all trees reuse.
    """
    flat, n, inner = np.concatenate(columns), len(columns[0]), feature.shape[1]
    depth = (inner + 1).bit_length() - 1
    dense = min(_DENSE_LEVELS, depth)
    starts, rows = feature.astype(np.intp) * n, np.arange(n)
    node, place = np.empty(n, dtype=np.intp), np.empty(n, dtype=np.intp)
    value, cut, right = np.empty(n), np.empty(n), np.empty(n, dtype=bool)
    length, total = np.empty(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    for f, start, t, p in zip(feature, starts, threshold, path):
        slot = np.zeros(n, dtype=np.uint8)
        for level in range(dense):
            first, beyond = 2**level - 1, np.zeros(n, dtype=bool)
            for i in range(2**level):
                beyond |= (columns[f[first + i]] > t[first + i]) & (slot == i)
            slot = 2 * slot + beyond
        np.add(slot, 2**dense - 1, out=node)
        for _ in range(depth - dense):
            np.take(start, node, out=place, mode="clip")
            np.add(place, rows, out=place)
            np.take(flat, place, out=value, mode="clip")
            np.take(t, node, out=cut, mode="clip")
            np.greater(value, cut, out=right)
            np.add(node, node, out=node)
            np.add(node, 1, out=node)
            np.add(node, right, out=node)
        np.subtract(node, inner, out=node)
        np.take(p, node, out=length, mode="clip")
        total += length
    return total


@dataclass
class IsolationForestModel:
    """Fitted trees (bounded by their number and depth) and the flagging threshold."""

    trees: DataFrame
    features: list[str]
    sample_size: int
    threshold: float | None = None

    def raw_score(self, df: DataFrame) -> Column:
        """Anomaly score in (0, 1] to nine digits, larger is more anomalous."""
        rows = self.trees.orderBy("tree").collect()
        packed = df.sparkSession.sparkContext.broadcast((
            np.array([r["feature"] for r in rows], dtype=np.int32),
            np.array([r["threshold"] for r in rows]),
            np.array([r["path"] for r in rows]),
        ))
        scale = _expected_path(self.sample_size) or 1.0

        @F.pandas_udf(DoubleType())
        def score(*columns: pd.Series) -> pd.Series:
            feature, threshold, path = packed.value
            total = _path_sums([c.to_numpy(dtype=float) for c in columns], feature, threshold, path)
            return pd.Series(np.exp2(-(total / _UNIT) / len(path) / scale))

        return F.round(score(*[F.col(name).cast("double") for name in self.features]), 9)

    def judged(self, scored: DataFrame) -> DataFrame:
        """Add anomaly_score (0 at the threshold) and is_anomaly to rows with a raw score."""
        if self.threshold is None:
            raise ValueError("the model has no threshold; fit it with a contamination")
        return (
            scored.withColumn("anomaly_score", F.col("raw") - F.lit(self.threshold))
            .withColumn("is_anomaly", F.col("anomaly_score") > 0).drop("raw")
        )

    def transform(self, df: DataFrame) -> DataFrame:
        return self.judged(df.withColumn("raw", self.raw_score(df)))

    def save(self, folder: str) -> None:
        """Write trees and settings as files that ``load`` reads back to the same scores."""
        self.trees.write.mode("overwrite").parquet(f"{folder}/trees")
        settings = [(self.features, self.sample_size, self.threshold)]
        frame = self.trees.sparkSession.createDataFrame(settings, _SETTINGS_SCHEMA)
        frame.write.mode("overwrite").parquet(f"{folder}/settings")

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> IsolationForestModel:
        trees = spark.read.schema(_TREE_SCHEMA).parquet(f"{folder}/trees")
        settings = spark.read.schema(_SETTINGS_SCHEMA).parquet(f"{folder}/settings").first()
        return cls(trees, list(settings["features"]), settings["sample_size"], settings["threshold"])


def fit_trees(
    df: DataFrame,
    features: list[str],
    keys: tuple[str, ...] = ("well_id", "reading_date"),
    trees: int = 300,
    max_samples: int = 256,
    seed: int = 0,
) -> IsolationForestModel:
    """Grow the trees on samples of ``df`` (a stored table: it is counted, then sampled)."""
    rows = df.count()
    if rows == 0:
        raise ValueError("cannot fit on an empty table")
    size = min(max_samples, rows)
    depth_limit = max(1, math.ceil(math.log2(size))) if size > 1 else 1
    samples = tree_samples(df.select(*keys, *features), list(keys), trees, size, rows, seed)
    def grow(group: pd.DataFrame) -> pd.DataFrame:
        tree = int(group["tree"].iloc[0])
        points = group[features].to_numpy(dtype=float)
        feature, threshold, path = _grow(points, depth_limit, seed, tree)
        return pd.DataFrame({
            "tree": [tree], "feature": [feature], "threshold": [threshold], "path": [path],
        })

    grown = samples.groupBy("tree").applyInPandas(grow, _TREE_SCHEMA).collect()
    return IsolationForestModel(df.sparkSession.createDataFrame(grown, _TREE_SCHEMA), features, size)


def fit_isolation_forest(
    df: DataFrame, features: list[str], contamination: float = 0.01, **options
) -> IsolationForestModel:
    """Trees plus the threshold above which the worst ``contamination`` of ``df`` lies."""
    model = fit_trees(df, features, **options)
    with Staging(df.sparkSession) as staging:
        scored = staging.write(df.select(model.raw_score(df).alias("raw")), "forest_scores")
        model.threshold = unit_quantile(scored, "raw", 1 - contamination)
    return model


def fit_and_score(
    df: DataFrame, features: list[str], contamination: float = 0.01, **options
) -> tuple[IsolationForestModel, DataFrame]:
    """The model with its threshold, and every row with score and flag; each row is scored once."""
    model = fit_trees(df, features, **options)
    scored = stage(df.withColumn("raw", model.raw_score(df)), "forest_scores")
    model.threshold = unit_quantile(scored, "raw", 1 - contamination)
    return model, model.judged(scored).select(*schemas.names(schemas.SCORES))


def isolation_forest_score(
    df: DataFrame, features: list[str], contamination: float = 0.01, **options
) -> DataFrame:
    """Every row of the feature table with its score and flag."""
    return fit_and_score(df, features, contamination, **options)[1]


def top_anomalies(scores: DataFrame, top: int = 10) -> DataFrame:
    return (
        scores.filter("is_anomaly")
        .orderBy(F.col("anomaly_score").desc(), "well_id", "reading_date").limit(top)
    )


def rediscovered_bores(scores: DataFrame, planted: DataFrame) -> DataFrame:
    """Bores of ``planted`` with at least one flagged row."""
    return scores.filter("is_anomaly").select("well_id").intersect(planted.select("well_id"))
