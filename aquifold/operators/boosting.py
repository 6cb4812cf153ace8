"""Gradient-boosted regression trees for squared error.

Rows become bin numbers of their features once; a job per level of a tree adds up
histograms, whose size depends on features and bins only. Where the shared folder is
one that files can be opened in, the binned rows and their residuals are mapped from
files there, so that a job hands no rows to its workers; elsewhere they are cached in
blocks. Models with different targets over the same features grow in the same jobs.
Residuals are whole numbers of a fixed unit, so neither the order of rows nor their
placement changes a tree.
"""

from __future__ import annotations

import contextlib
import hashlib
import os
import pickle
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from aquifold.session import delete_folder, new_folder

_TREE_SCHEMA = "tree int, feature array<int>, bin array<int>, value array<double>, gain array<double>"
_SETTINGS_SCHEMA = "features array<string>, edges array<array<double>>, base double"
#: Joint histograms of several features stay in a core's cache.
_JOINT = 4096
_BLOCK = 1 << 17
#: Partitions that quantiles of the inputs are taken from, or as many as there are cores.
_PARTS = 32
#: Rows worked on at a time, so that their arrays stay in a core's cache.
_CHUNK = 1 << 16
#: Residuals are cached anew every few trees, and from the first rows every so many, which bounds the lineage.
_REFRESH, _RESTART = 4, 60
#: Cut of a node that is not split: every bin lies on its left.
_WHOLE = 255
#: Residual of a row that a model does not learn from.
_UNUSED = np.int32(-(2**31))


@dataclass
class BoostedModel:
    """Fitted trees (bounded by their number and depth) over binned features."""

    trees: list
    features: list[str]
    edges: list[list[float]]
    base: float

    def predicted(self) -> Column:
        features, edges, base = self.features, [np.array(e) for e in self.edges], self.base
        trees = [(t["feature"], t["bin"], np.array(t["value"])) for t in self.trees]

        @F.pandas_udf(DoubleType())
        def value(*columns: pd.Series) -> pd.Series:
            bins = _bins([c.to_numpy(dtype=float) for c in columns], edges)
            total = np.full(bins.shape[1], base)
            for feature, cut, leaves in trees:
                total += leaves[_walk(len(total), lambda f, c: bins[f] > c, feature, cut)]
            return pd.Series(total)

        return value(*[F.col(f"`{name}`").cast("double") for name in features])

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("predicted", self.predicted())

    @property
    def importances(self) -> list[float]:
        """Share of each feature in the reduction of squared error."""
        gains = np.zeros(len(self.features))
        for tree in self.trees:
            np.add.at(gains, np.array(tree["feature"]), np.array(tree["gain"]))
        return list(gains / (gains.sum() or 1.0))

    def save(self, spark: SparkSession, folder: str) -> None:
        """Write trees and settings as files that ``load`` reads back to the same predictions."""
        spark.createDataFrame(self.trees, _TREE_SCHEMA).write.mode("overwrite").parquet(f"{folder}/trees")
        settings = [(self.features, self.edges, self.base)]
        spark.createDataFrame(settings, _SETTINGS_SCHEMA).write.mode("overwrite").parquet(f"{folder}/settings")

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> BoostedModel:
        trees = spark.read.schema(_TREE_SCHEMA).parquet(f"{folder}/trees").orderBy("tree").collect()
        settings = spark.read.schema(_SETTINGS_SCHEMA).parquet(f"{folder}/settings").first()
        return cls(trees, list(settings["features"]), [list(e) for e in settings["edges"]], settings["base"])


def _bins(columns: list[np.ndarray], edges: list[np.ndarray]) -> np.ndarray:
    """Per feature and row the number of edges below the value."""
    return np.stack([np.searchsorted(e, c).astype(np.uint8) for c, e in zip(columns, edges)])


def _walk(n: int, right: Callable[[int, int], np.ndarray], feature: list[int], cut: list[int]) -> np.ndarray:
    """Leaf of each of n rows in a complete tree, or its node on the level below the given splits.

    ``right`` tells which rows lie beyond a cut of a feature.
    """
    leaf = np.zeros(n, dtype=np.uint8)
    first = 0
    while first < len(feature):
        beyond = np.zeros(n, dtype=bool)
        for node in range(first, 2 * first + 1):
            if cut[node] < _WHOLE:
                side = right(feature[node], cut[node])
                beyond |= side if first == 0 else side & (leaf == node - first)
        leaf = 2 * leaf + beyond
        first = 2 * first + 1
    return leaf


def _groups(bits: list[int]) -> list[list[int]]:
    """Features that are counted together: the product of their bins stays within ``_JOINT``."""
    groups: list[tuple[int, list[int]]] = []
    for feature in sorted(range(len(bits)), key=lambda f: -bits[f]):
        for i, (held, members) in enumerate(groups):
            if 1 << (held + bits[feature]) <= _JOINT:
                groups[i] = (held + bits[feature], members + [feature])
                break
        else:
            groups.append((bits[feature], [feature]))
    return [members for _, members in groups]


class _Layout:
    """How the bins of a row's features are packed into a few codes, each in bits of its own."""

    def __init__(self, sizes: list[int]) -> None:
        self.sizes, self.bits = sizes, [(size - 1).bit_length() for size in sizes]
        self.groups = _groups(self.bits)
        self.place: dict[int, tuple[int, int]] = {}
        for g, members in enumerate(self.groups):
            shift = 0
            for feature in reversed(members):
                self.place[feature] = (g, shift)
                shift += self.bits[feature]

    def codes(self, bins: np.ndarray) -> np.ndarray:
        out = np.zeros((len(self.groups), bins.shape[1]), dtype=np.uint16)
        for feature, (g, shift) in self.place.items():
            out[g] |= bins[feature].astype(np.uint16) << np.uint16(shift)
        return out

    def node(self, codes: np.ndarray, feature: list[int], cut: list[int]) -> np.ndarray:
        """``_walk`` over packed rows: a feature's bits are compared where they are."""

        def right(f: int, c: int) -> np.ndarray:
            g, shift = self.place[f]
            mask = np.uint16(((1 << self.bits[f]) - 1) << shift)
            return (codes[g] & mask) > np.uint16(c << shift)

        return _walk(codes.shape[1], right, feature, cut)

    def histograms(self, codes: np.ndarray, rows: np.ndarray, residuals: list[np.ndarray]) -> list[tuple]:
        """Per model the counts, and sums of residuals, of those of the rows it learns from, per joint cell of each group."""
        weights = [residual[rows].astype(float) for residual in residuals]
        missing = [np.flatnonzero(w == _UNUSED) for w in weights]
        for w, without in zip(weights, missing):
            w[without] = 0.0
        counts, sums = [[] for _ in weights], [[] for _ in weights]
        for code, members in zip(codes, self.groups):
            cell = code[rows].astype(np.intp)
            cells = 1 << sum(self.bits[f] for f in members)
            every = np.bincount(cell, minlength=cells)
            for i, (w, without) in enumerate(zip(weights, missing)):
                counts[i].append(every - np.bincount(cell[without], minlength=cells) if len(without) else every)
                sums[i].append(np.bincount(cell, w, minlength=cells))
        return [(np.concatenate(c), np.concatenate(t)) for c, t in zip(counts, sums)]

    def per_feature(self, joint: np.ndarray) -> np.ndarray:
        """One value per feature and bin, feature after feature, from joint cells."""
        out, start = {}, 0
        for members in self.groups:
            shape = [1 << self.bits[f] for f in members]
            end = start + int(np.prod(shape))
            cube = joint[start:end].reshape(shape)
            for axis, feature in enumerate(members):
                every = cube.sum(axis=tuple(a for a in range(len(members)) if a != axis))
                out[feature] = every[:self.sizes[feature]]
            start = end
        return np.concatenate([out[f] for f in range(len(self.sizes))])


def _advanced(layout: _Layout, codes: np.ndarray, residuals: np.ndarray, trees: list[list[tuple]]) -> np.ndarray:
    """Residuals after the trees of each model."""
    if not any(trees):
        return residuals
    residuals = residuals.copy()
    for residual, grown in zip(residuals, trees):
        used = residual != _UNUSED
        for feature, cut, steps in grown:
            residual -= steps[layout.node(codes, feature, cut)] * used
    return residuals


def _best_split(counts: np.ndarray, sums: np.ndarray, sizes: list[int], unit: float) -> tuple[int, int, float]:
    """Feature, last bin of the left side and gain; without any gain all rows go left."""
    best, start = (0, _WHOLE, 0.0), 0
    for feature, size in enumerate(sizes):
        rows, total = counts[start:start + size].cumsum(), sums[start:start + size].cumsum() / unit
        start += size
        left = np.flatnonzero((rows > 0) & (rows < rows[-1]))
        if not len(left):
            continue
        gain = (
            total[left] ** 2 / rows[left] + (total[-1] - total[left]) ** 2 / (rows[-1] - rows[left])
            - total[-1] ** 2 / rows[-1]
        )
        at = int(np.argmax(gain))
        # Residuals are rounded to units, so a smaller gain is none.
        if gain[at] > max(best[2], 1e-9):
            best = (feature, int(left[at]), float(gain[at]))
    return best


class _Fit:
    """The trees of one model while they grow."""

    def __init__(self, sizes: list[int], unit: float, rate: float, depth: int) -> None:
        self.sizes, self.unit, self.rate, self.depth = sizes, unit, rate, depth
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        self.trees: list[dict] = []
        self.steps: list[tuple] = []
        self.open()

    def open(self) -> None:
        self.feature, self.cut, self.gain, self.known = [], [], [], []

    def wanted(self) -> list[int]:
        """Nodes of the next level to count: of two children the smaller, the other is what remains."""
        if not self.known:
            return [0]
        first = len(self.known) - 1
        nodes = []
        for i, (counts, _) in enumerate(self.known):
            left, right = self._sides(counts, first + i)
            nodes.append(2 * i + int(left > right))
        return nodes

    def _sides(self, values: np.ndarray, node: int) -> tuple[float, float]:
        start, end = self.starts[self.feature[node]], self.starts[self.feature[node] + 1]
        cells, edge = values[start:end], self.cut[node] + 1
        return cells[:edge].sum(), cells[edge:].sum()

    def take(self, nodes: list[int], counted: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """Split the level whose nodes were counted; after the last level the tree is done."""
        if self.known:
            children = []
            for parent, node, part in zip(self.known, nodes, counted):
                pair = [(parent[0] - part[0], parent[1] - part[1])] * 2
                pair[node % 2] = part
                children += pair
            self.known = children
        else:
            self.known = counted
        for counts, sums in self.known:
            feature, cut, gain = _best_split(counts, sums, self.sizes, self.unit)
            self.feature.append(feature), self.cut.append(cut), self.gain.append(gain)
        if len(self.known) == 2 ** (self.depth - 1):
            self._close()

    def _close(self) -> None:
        first, units = len(self.known) - 1, []
        for i, (counts, sums) in enumerate(self.known):
            for rows, total in zip(self._sides(counts, first + i), self._sides(sums, first + i)):
                units.append(int(np.rint(self.rate * total / rows)) if rows else 0)
        self.steps.append((self.feature, self.cut, np.array(units, dtype=np.int32)))
        self.trees.append({
            "tree": len(self.trees), "feature": self.feature, "bin": self.cut,
            "value": [u / self.unit for u in units], "gain": self.gain,
        })
        self.open()


@dataclass
class _Count:
    """What a level's job counts: per model the wanted nodes of rows drawn for the tree."""

    layout: _Layout
    wanted: list[tuple[list[int], list[int], list[int]]]
    word: int
    limit: int

    @classmethod
    def of(cls, layout: _Layout, fits: list[_Fit], subsample: float, seed: int) -> _Count:
        word = int.from_bytes(hashlib.md5(f"{seed}|{len(fits[0].trees)}".encode()).digest()[:4], "little") | 1
        return cls(layout, [(fit.wanted(), fit.feature, fit.cut) for fit in fits], word, int(subsample * 2**32))

    def __call__(self, blocks: Iterator[tuple]) -> Iterator[list]:
        """Counts and sums of all wanted nodes over blocks of draws, codes and residuals."""
        sums: list | None = None
        for draw, codes, residuals in blocks:
            drawn, found = draw * np.uint32(self.word) < self.limit, []
            if not self.wanted[0][1]:
                found = self.layout.histograms(codes, np.flatnonzero(drawn), list(residuals))
            else:
                for residual, (nodes, feature, cut) in zip(residuals, self.wanted):
                    chosen, leaf = drawn & (residual != _UNUSED), self.layout.node(codes, feature, cut)
                    for n in nodes:
                        found += self.layout.histograms(codes, np.flatnonzero(chosen & (leaf == n)), [residual])
            sums = found if sums is None else [(a + c, b + d) for (a, b), (c, d) in zip(sums, found)]
        if sums is not None:
            yield [(self.layout.per_feature(a).astype(np.int32), self.layout.per_feature(b)) for a, b in sums]

    def total(self, parts: list[list]) -> list[tuple]:
        """Per model its wanted nodes with the counts and sums of all tasks."""
        total = [tuple(sum(np.asarray(p[i][j], dtype=float) for p in parts) for j in (0, 1)) for i in range(len(parts[0]))]
        place, out = 0, []
        for nodes, _, _ in self.wanted:
            out.append((nodes, total[place:place + len(nodes)]))
            place += len(nodes)
        return out


class _CachedRows:
    """Binned rows as blocks of draws, codes and residuals in the executors' cache."""

    def __init__(self, rows: DataFrame, packed: Callable, layout: _Layout) -> None:
        def pickled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for block in packed(batches):
                yield pa.RecordBatch.from_pydict({"block": pa.array([pickle.dumps(block, protocol=5)], pa.binary())})

        cores = rows.sparkSession.sparkContext.defaultParallelism
        loaded = rows.mapInArrow(pickled, "block binary").rdd.map(lambda r: pickle.loads(r.block)).coalesce(cores)
        self.first = self.state = loaded.persist(StorageLevel.MEMORY_AND_DISK)
        self.layout, self.since, self.stale = layout, 0, None

    def counted(self, count: _Count, fits: list[_Fit]) -> list[list]:
        layout, tree = self.layout, len(fits[0].trees)
        if tree and tree % _REFRESH == 0 and tree != self.since:
            restart = tree % _RESTART == 0
            grown = [fit.steps[0 if restart else self.since:] for fit in fits]
            self.stale, self.since = self.state, tree
            self.state = self._after(self.first if restart else self.state, grown).persist(StorageLevel.MEMORY_AND_DISK)
        steps = [fit.steps[self.since:] for fit in fits]
        parts = self._after(self.state, steps).mapPartitions(lambda part: count(part)).collect()
        if self.stale is not None and self.stale is not self.first:
            self.stale.unpersist()
        self.stale = None
        return parts

    def _after(self, blocks: RDD, trees: list[list[tuple]]) -> RDD:
        layout = self.layout
        return blocks.map(lambda block: (*block[:2], _advanced(layout, block[1], block[2], trees)))

    def close(self) -> None:
        self.state.unpersist()
        self.first.unpersist()


class _MappedRows:
    """Binned rows in files of a folder that all executors share, in as many even shares as there are cores.

    A share's residuals after each tree are a file of its own, written by the tree's first job from the one
    before, which stays until the job after has ended: a task that is run again finds what it started from.
    """

    def __init__(self, rows: DataFrame, packed: Callable, layout: _Layout, models: int, folder: str) -> None:
        self.layout, self.models, self.folder = layout, models, folder

        def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            os.makedirs(folder, exist_ok=True)
            for draw, codes, residuals in packed(batches):
                name = f"{folder}/rows-{uuid.uuid4().hex}"
                with open(name, "wb") as file:
                    for array in (draw, residuals, codes):
                        file.write(np.ascontiguousarray(array).data)
                yield pa.RecordBatch.from_pydict({"name": [name], "rows": pa.array([len(draw)], pa.int32())})

        files = [tuple(row) for row in rows.mapInArrow(written, "name string, rows int").collect()]
        context, total = rows.sparkSession.sparkContext, sum(n for _, n in files)
        shares: list[list[tuple[str, int, int, int]]] = [[] for _ in range(max(1, min(context.defaultParallelism, total)))]
        before = 0
        for name, n in files:
            for k, share in enumerate(shares):
                first = max(0, total * k // len(shares) - before)
                last = min(n, total * (k + 1) // len(shares) - before)
                if first < last:
                    share.append((name, n, first, last))
            before += n
        self.shares = context.parallelize(list(enumerate(shares)), len(shares))

    def counted(self, count: _Count, fits: list[_Fit]) -> list[list]:
        layout, models, folder, tree = self.layout, self.models, self.folder, len(fits[0].trees)
        fresh = not fits[0].feature
        grown = [fit.steps[-1:] for fit in fits] if fresh else []

        def task(part: Iterator[tuple]) -> Iterator[list]:
            return count(block for k, share in part for block in _mapped(layout, models, f"{folder}/{k}", share, tree, grown))

        return self.shares.mapPartitions(task).collect()

    def close(self) -> None:
        """The folder is the caller's."""


def _mapped(layout: _Layout, models: int, name: str, share: list, tree: int, grown: list[list[tuple]]) -> Iterator[tuple]:
    """Blocks of a share with their residuals before a tree, which ``grown``, the tree before, brings up to date."""
    from_rows = tree == 0 or (grown and tree == 1)
    state = None if from_rows else np.memmap(f"{name}-{tree - 1 if grown else tree}", np.int32, "r")
    out = f"{name}-{tree}-{uuid.uuid4().hex}" if tree and grown else None
    file, place = open(out, "wb") if out else None, 0
    try:
        for rows, n, first, last in share:
            whole, groups = np.memmap(rows, np.uint8, "r"), len(layout.groups)
            draws, own, codes = np.split(whole, [4 * n, 4 * n * (1 + models)])
            draws, own = draws.view(np.uint32), own.view(np.int32).reshape(models, n)
            codes = codes.view(np.uint16).reshape(groups, n)
            for start in range(first, last, _CHUNK):
                chunk = slice(start, min(start + _CHUNK, last))
                code, size = np.asarray(codes[:, chunk]), chunk.stop - start
                if from_rows:
                    residuals = np.asarray(own[:, chunk])
                else:
                    residuals = np.asarray(state[place:place + models * size]).reshape(models, size)
                if file:
                    residuals = _advanced(layout, code, residuals, grown)
                    file.write(np.ascontiguousarray(residuals).data)
                place += models * size
                yield np.asarray(draws[chunk]), code, residuals
        if file:
            file.close()
            os.replace(out, f"{name}-{tree}")
            if tree > 2:
                with contextlib.suppress(FileNotFoundError):
                    os.remove(f"{name}-{tree - 2}")
    finally:
        if file:
            file.close()


def _opened_folder(spark: SparkSession) -> str | None:
    """A new folder below the shared one, if its files can be opened by path."""
    path = spark._jvm.org.apache.hadoop.fs.Path(new_folder(spark, "boosting"))
    files = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return path.toUri().getPath() if files.getScheme() == "file" else None


def fit_boosted(
    train: DataFrame,
    inputs: list[str],
    labels: tuple[str, ...] = ("target",),
    keys: tuple[str, ...] = ("well_id", "reading_date"),
    trees: int = 300,
    learning_rate: float = 0.05,
    depth: int = 3,
    subsample: float = 0.8,
    max_bins: int = 32,
    seed: int = 0,
) -> list[BoostedModel]:
    """One model per label, learnt from the rows that have it; a missing input is an error.

    ``keys`` identify the rows, for each tree's draw of them.
    """
    spark = train.sparkSession
    column = {name: F.col(f"`{name}`").cast("double") for name in [*inputs, *labels]}
    cuts = [(i + 1) / max_bins for i in range(max_bins - 1)]
    # Partial results meet in one task, which takes some 20 ms for each column of each, so there are not many.
    row = train.coalesce(max(_PARTS, spark.sparkContext.defaultParallelism)).agg(
        *[F.count_if(column[c].isNull() | F.isnan(column[c])).alias(f"missing_{i}") for i, c in enumerate(inputs)],
        *[F.percentile_approx(column[c], cuts, 10_000).alias(f"edges_{i}") for i, c in enumerate(inputs)],
        *[F.max(column[c]).alias(f"largest_{i}") for i, c in enumerate(inputs)],
        *[F.count(column[c]).alias(f"rows_{i}") for i, c in enumerate(labels)],
        *[F.avg(column[c]).alias(f"mean_{i}") for i, c in enumerate(labels)],
        *[F.min(column[c]).alias(f"low_{i}") for i, c in enumerate(labels)],
        *[F.max(column[c]).alias(f"high_{i}") for i, c in enumerate(labels)],
    ).first()
    many = range(len(labels))
    if not all(row[f"rows_{i}"] for i in many):
        raise ValueError("cannot fit on an empty table")
    holed = [name for i, name in enumerate(inputs) if row[f"missing_{i}"]]
    if holed:
        raise ValueError(f"null or NaN values in {', '.join(holed)}")
    # The largest value is no edge: nothing lies beyond it.
    edges = [sorted(set(row[f"edges_{i}"]) - {row[f"largest_{i}"]}) for i in range(len(inputs))]
    layout = _Layout([len(e) + 1 for e in edges])
    bases = [round(row[f"mean_{i}"], 9) for i in many]
    # A residual fits 31 bits, and the sum of all stays a whole number of a double.
    units = []
    for i in many:
        bits = min(30, 52 - int(row[f"rows_{i}"]).bit_length())
        spread = max(row[f"high_{i}"] - row[f"low_{i}"], 1e-6)
        units.append(2.0 ** int(np.floor(bits - np.log2(4 * spread))))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """Batches as blocks: draws, codes and residuals."""
        cut_at = [np.array(e) for e in edges]
        held: list[tuple] = []

        def block() -> tuple:
            joined = tuple(np.concatenate(p, axis=-1) for p in zip(*held))
            held.clear()
            return joined

        for batch in batches:
            values = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            residuals = np.full((len(labels), batch.num_rows), _UNUSED)
            for residual, target, base, unit in zip(residuals, values[1:], bases, units):
                known = ~np.isnan(target)
                residual[known] = np.rint((target[known] - base) * unit)
            codes = layout.codes(_bins(values[1 + len(labels):], cut_at))
            held.append((values[0].astype(np.uint32), codes, residuals))
            if sum(len(h[0]) for h in held) >= _BLOCK:
                yield block()
        if held:
            yield block()

    rows = train.select(
        (F.xxhash64(*keys, F.lit(seed)).bitwiseAND(F.lit(2**32 - 1))).alias("draw"),
        *[column[name].alias(f"label_{i}") for i, name in enumerate(labels)],
        *[column[name].alias(f"input_{i}") for i, name in enumerate(inputs)],
    )
    folder = _opened_folder(spark)
    fits = [_Fit(layout.sizes, unit, learning_rate, depth) for unit in units]
    try:
        if folder is None:
            held = _CachedRows(rows, packed, layout)
        else:
            held = _MappedRows(rows, packed, layout, len(labels), folder)
        for _ in range(trees * depth):
            count = _Count.of(layout, fits, subsample, seed)
            for fit, found in zip(fits, count.total(held.counted(count, fits))):
                fit.take(*found)
        held.close()
    finally:
        if folder is not None:
            delete_folder(spark, f"file:{folder}")
    return [BoostedModel(fit.trees, list(inputs), edges, base) for fit, base in zip(fits, bases)]
