"""N-gram Jaccard join of documents by the chosen-path method.

1. Every text becomes the set of its 5-word shingles; equal sets are one class.
2. Runs of the chosen-path recursion split the classes: a node draws one or two positions of
   the min-hash signature, and classes that agree there go to a child node together. Nodes of
   few classes, and nodes that no longer shrink, are compared in full on the signatures.
3. Classes linked by such candidates form loose groups. Inside each, all pairs are compared by
   exact set intersection, in blocks; links and groups come from these.

The number of runs follows from the target recall: a pair at the threshold survives one level
with probability ``0.75 * s * r + 0.25 * (1 - (1 - s * r)**2)``, where r is that of the level below.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aquifold.llm.common import append_columns, slices, texts_of
from aquifold.llm.components import components
from aquifold.llm.decontaminate import words_of
from aquifold.session import delete_folder, recorded_stages, stage

#: Min-hash positions of a signature.
POSITIONS = 64
#: Nodes of at most so many classes are compared in full.
SMALL_NODE = 256
#: A node with more than this share of its parent's classes no longer shrinks.
STUCK = 0.7
MAX_DEPTH = 10
#: Classes on either side of a block of comparisons.
BLOCK = 1000
#: Signatures may fall short of the threshold by so much (four standard deviations at 0.8).
SLACK = 0.2

_MAX_WORDS = 1_000_000
_BITMAP = 1 << 22


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= _MAX_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def shingle_sets(texts: list[str], size: int, hashes: _WordHashes) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles; a text of fewer words is one shingle, one of none has none."""
    get = hashes.__getitem__
    for text in texts:
        words = words_of(text)
        n = len(words)
        h = np.fromiter(map(get, words), np.uint64, n)
        k = min(size, n)
        value = np.full(n - k + 1 if n else 0, k, np.uint64)
        for i in range(k):
            value = _mixed(value ^ h[i : n - k + 1 + i])
        yield np.unique(value)


def _draws(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240517)
    return rng.integers(1, 1 << 63, count, np.uint64) | np.uint64(1), rng.integers(0, 1 << 63, count, np.uint64)


def min_hashes(shingles: np.ndarray, count: int = POSITIONS) -> np.ndarray:
    a, b = _draws(count)
    best = np.full(count, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 8192):
        part = shingles[None, at : at + 8192] * a[:, None] + b[:, None]
        best = np.minimum(best, part.min(axis=1))
    return (best >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _signed(docs: DataFrame, size: int) -> DataFrame:
    def make():
        import xxhash

        hashes = _WordHashes()

        def work(batch: pa.RecordBatch) -> list:
            texts, counts, keys, signatures = texts_of(batch), [], [], []
            for a, b in slices(texts):
                for shingles in shingle_sets(texts[a:b], size, hashes):
                    counts.append(len(shingles))
                    keys.append(xxhash.xxh3_128_digest(shingles.tobytes()))
                    signatures.append(min_hashes(shingles))
            flat = np.concatenate(signatures) if signatures else np.zeros(0, np.int32)
            offsets = np.arange(0, len(flat) + 1, POSITIONS, dtype=np.int32)
            return [counts, keys, pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))]

        return work

    # The text itself does not come back from Python.
    def run(batches):
        work = make()
        for batch in batches:
            if batch.num_rows:
                counts, keys, signatures = work(batch)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(keys, pa.binary()), signatures],
                    names=["doc_id", "n", "key", "signature"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, n bigint, key binary, signature array<int>")


def survival(threshold: float, depth: int) -> float:
    """Chance that a pair at the threshold meets in a node of this depth in one run."""
    r = 1.0
    for _ in range(depth):
        p = threshold * r
        r = 0.75 * p + 0.25 * (1 - (1 - p) ** 2)
    return r


def runs_for(threshold: float, recall: float, depth: int = MAX_DEPTH) -> int:
    return math.ceil(math.log(1 - recall) / math.log(1 - survival(threshold, depth)))


def _children(rows: DataFrame) -> DataFrame:
    """Children of each (node, key, signature): one drawn position, or two for a quarter of the nodes."""
    first = F.pmod(F.xxhash64("node", F.lit(1)), F.lit(POSITIONS)).cast("int")
    second = F.pmod(F.xxhash64("node", F.lit(2)), F.lit(POSITIONS)).cast("int")
    drawn = F.when(F.pmod(F.xxhash64("node", F.lit(3)), F.lit(4)) == 0, F.array_distinct(F.array(first, second))).otherwise(F.array(first))
    return rows.withColumn("at", F.explode(drawn)).withColumn(
        "node", F.xxhash64("node", "at", F.element_at("signature", F.col("at") + 1))
    ).drop("at")


def _in_blocks(rows: DataFrame, group: str, size: str) -> DataFrame:
    """Rows of each group dealt to blocks of about BLOCK rows a side, every two of which meet: columns ``g`` and ``side``.

    ``side`` is 0 in a block that is compared with itself, else 1 or 2.
    """
    parts = F.ceil(F.col(size) / BLOCK).cast("int")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("key"), parts).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), parts - 1))
    )
    return rows.withColumns({
        "g": F.xxhash64(group, F.least("own", "other"), F.greatest("own", "other")),
        "side": F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2),
    }).drop("own", "other")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Consecutive rows of equal ``g`` as one table each, across batches."""
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        if held is not None:
            rows = pa.concat_tables([held, rows])
        g = rows.column("g").to_numpy()
        cuts = np.concatenate([[0], np.flatnonzero(g[1:] != g[:-1]) + 1])
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            yield rows.slice(a, b - a)
        held = rows.slice(int(cuts[-1])).combine_chunks()
    if held is not None and held.num_rows:
        yield held


class _Stars:
    """Groups of rows of one block joined step by step; each as edges to its first row."""

    def __init__(self, count: int) -> None:
        self.label = np.arange(count)

    def join(self, row: int, others: np.ndarray) -> None:
        labels = np.unique(self.label[np.append(others, row)])
        if len(labels) > 1:
            self.label[np.isin(self.label, labels[1:])] = labels[0]

    def edges(self) -> np.ndarray:
        return np.flatnonzero(self.label != np.arange(len(self.label)))


def _partners(side: np.ndarray, row: int) -> slice | np.ndarray:
    """Rows after ``row`` that it has to be compared with."""
    if side[row] == 0:
        return np.arange(row + 1, len(side))
    return np.flatnonzero(side == 2) if side[row] == 1 else np.zeros(0, np.int64)


def _candidate_edges(leaves: DataFrame, threshold: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = [], []
        least = math.ceil((threshold - SLACK) * POSITIONS)
        for rows in _groups(batches):
            count = rows.num_rows
            side = rows.column("side").to_numpy()
            n = rows.column("n").to_numpy()
            signature = rows.column("signature").combine_chunks().flatten().to_numpy().reshape(count, POSITIONS).view(np.uint32)
            sketch = (signature & np.uint32(0xFF)).astype(np.uint8)
            stars = _Stars(count)
            for i in range(count):
                others = _partners(side, i)
                if not len(others):
                    continue
                close = (sketch[others] == sketch[i]).sum(axis=1) >= least
                close &= np.minimum(n[others], n[i]) >= threshold * np.maximum(n[others], n[i])
                if close.any():
                    stars.join(i, others[close])
            keys = rows.column("key")
            for i in stars.edges().tolist():
                left.append(keys[int(stars.label[i])].as_py())
                right.append(keys[i].as_py())
            if len(left) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(left, pa.binary()), pa.array(right, pa.binary())], names=["a", "b"])
                left, right = [], []
        yield pa.RecordBatch.from_arrays([pa.array(left, pa.binary()), pa.array(right, pa.binary())], names=["a", "b"])

    rows = leaves.select("g", "side", "key", "n", "signature").repartition("g").sortWithinPartitions("g")
    return rows.mapInArrow(run, "a binary, b binary").distinct()


def _verified(members: DataFrame, threshold: float) -> DataFrame:
    """(key, links, weight, other): exact links of each class in a block, and the class that leads its group there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for rows in _groups(batches):
            count = rows.num_rows
            side = rows.column("side").to_numpy()
            copies = rows.column("copies").to_numpy()
            sets = [np.frombuffer(x, np.uint64) for x in rows.column("shingles").to_pylist()]
            n = np.array([len(x) for x in sets], np.int64)
            owner = np.repeat(np.arange(count), n)
            _, shingle = np.unique(np.concatenate(sets), return_inverse=True)
            order = np.argsort(shingle, kind="stable")
            posting = owner[order]
            frequency = np.bincount(shingle)
            begin = np.cumsum(frequency) - frequency
            ends = np.cumsum(n)
            links, weight = np.zeros(count, np.int64), np.zeros(count, np.int64)
            stars = _Stars(count)
            for i in range(count):
                own = shingle[ends[i] - n[i] : ends[i]]
                own = own[frequency[own] > 1]
                if not len(own) or side[i] == 2:
                    continue
                f = frequency[own]
                at = np.repeat(begin[own] - np.concatenate([[0], np.cumsum(f)[:-1]]), f) + np.arange(f.sum())
                common = np.bincount(posting[at], minlength=count)
                others = _partners(side, i)
                union = n[others] + n[i] - common[others]
                near = others[common[others] >= threshold * union - 1e-9]
                if len(near):
                    links[i] += len(near)
                    weight[i] += copies[near].sum()
                    links[near] += 1
                    weight[near] += copies[i]
                    stars.join(i, near)
            keys = rows.column("key").to_pylist()
            out += [
                (keys[i], int(links[i]), int(weight[i]), keys[int(stars.label[i])]) for i in np.flatnonzero(links).tolist()
            ]
            if len(out) >= 10_000:
                yield batch_of(out)
                out = []
        yield batch_of(out)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        types = [pa.binary(), pa.int64(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=["key", "links", "weight", "other"]
        )

    rows = members.select("g", "side", "key", "copies", "shingles").repartition("g").sortWithinPartitions("g")
    return rows.mapInArrow(run, "key binary, links bigint, weight bigint, other binary")


def similar_documents(docs: DataFrame, threshold: float = 0.8, words: int = 5, recall: float = 0.98) -> DataFrame:
    """doc_id, copy_id, class_id and n_links of every document.

    ``copy_id`` is the smallest doc_id with the same shingle set; ``class_id`` the smallest of
    the group that links (Jaccard similarity of at least ``threshold`` between shingle sets)
    hold together; ``n_links`` the number of other documents so similar. ``recall`` is the
    least chance for a pair at the threshold at the deepest level; at the first it is far above.

    Needs ``doc_id`` and ``text``; other columns are left out. Texts without words (null, empty)
    and rows with null doc_id link to nothing; the latter have null ids. Rows that repeat a
    doc_id count as copies of one another when their texts agree; results then repeat per row.
    """
    return _similar(docs, threshold, words, recall).select("doc_id", "copy_id", "class_id", "n_links")


def _similar(docs: DataFrame, threshold: float, words: int, recall: float = 0.98) -> DataFrame:
    """Rows of ``similar_documents`` with ``key``, the class of the row (null if it links to nothing), and ``lead``, that of its group."""
    docs = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    signed = stage(_signed(docs, words), "signatures")
    classes = stage(
        signed.filter("n > 0 and doc_id is not null").groupBy("key").agg(
            F.min("doc_id").alias("copy_id"), F.count("*").alias("copies"), F.any_value("n").alias("n"),
            F.any_value("signature").alias("signature"),
        ),
        "classes",
    )
    with recorded_stages() as nodes:
        met = _candidates(classes, threshold, runs_for(threshold, recall))
    candidates = stage(met, "candidates")
    for folder in nodes:
        delete_folder(docs.sparkSession, folder)
    loose = components(candidates)
    sized = loose.join(loose.groupBy("root").agg(F.count("*").alias("size")), "root").withColumnRenamed("node", "key")
    members = stage(sized.join(classes.select("key", "copy_id", "copies"), "key"), "members")
    shingled = _sets_of(docs, members, words)
    verified = stage(_verified(_in_blocks(shingled, "root", "size"), threshold), "verified")
    groups = components(verified.select(F.col("key").alias("a"), F.col("other").alias("b")))
    links = verified.groupBy("key").agg(F.sum("weight").alias("weight"))
    grouped = groups.withColumnRenamed("node", "key").join(classes.select("key", "copy_id"), "key")
    # Two classes of one doc_id may share copy_id; the key decides between them.
    leads = grouped.groupBy("root").agg(F.min(F.struct("copy_id", "key")).alias("first")).select(
        "root", F.col("first.copy_id").alias("class_id"), F.col("first.key").alias("lead")
    )
    named = grouped.join(leads, "root").join(links, "key", "left")
    table = classes.select("key", "copy_id", "copies").join(named.select("key", "class_id", "lead", "weight"), "key", "left").select(
        "key", "copy_id", F.coalesce("class_id", "copy_id").alias("class_id"), F.coalesce("lead", "key").alias("lead"),
        (F.col("copies") - 1 + F.coalesce("weight", F.lit(0))).alias("n_links"),
    )
    known = F.col("doc_id").isNotNull()
    return (
        signed.select("doc_id", F.when(known & (F.col("n") > 0), F.col("key")).alias("key")).join(table, "key", "left")
        .select(
            "doc_id", F.coalesce("copy_id", "doc_id").alias("copy_id"), F.coalesce("class_id", "doc_id").alias("class_id"),
            F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), "key", "lead",
        )
    )


def _candidates(classes: DataFrame, threshold: float, runs: int) -> DataFrame:
    """Edges between classes whose signatures are close and that met in a leaf of some run."""
    roots = F.explode(F.array(*[F.xxhash64(F.lit("run"), F.lit(r)) for r in range(runs)]))
    rows = classes.select("key", "n", "signature", roots.alias("node"), F.lit(None).cast("bigint").alias("before"))
    leaves = []
    for depth in range(1, MAX_DEPTH + 1):
        # Only node and key travel until it is known which nodes hold more than one class.
        placed = _children(rows).select("node", "key", "before")
        sizes = placed.groupBy("node").agg(F.count("*").alias("size")).filter("size > 1")
        level = stage(placed.join(sizes, "node"), "nodes")
        done = F.lit(depth == MAX_DEPTH) | (F.col("size") <= SMALL_NODE) | (F.col("size") > STUCK * F.col("before"))
        done = F.coalesce(done, F.col("size") <= SMALL_NODE)
        leaves.append(level.filter(done).select("node", "key", "size"))
        large = level.filter(~done).select("node", "key", F.col("size").alias("before"))
        if depth == MAX_DEPTH or large.isEmpty():
            break
        rows = large.join(classes.select("key", "n", "signature"), "key")
    met = leaves[0]
    for more in leaves[1:]:
        met = met.union(more)
    # Nodes of equal members, as runs that repeat a group make, are compared once.
    small = met.filter(F.col("size") <= SMALL_NODE)
    same = small.groupBy("node").agg(F.sum(F.xxhash64("key").cast("decimal(38,0)")).alias("members"), F.count("*").alias("size"))
    once = same.groupBy("members", "size").agg(F.min("node").alias("node")).select("node")
    met = small.join(once, "node", "left_semi").union(met.filter(F.col("size") > SMALL_NODE))
    blocks = _in_blocks(met, "node", "size").join(classes.select("key", "n", "signature"), "key")
    return _candidate_edges(blocks, threshold)


def _sets_of(docs: DataFrame, members: DataFrame, words: int) -> DataFrame:
    """``members`` with their shingles, from the text of the document each class is named after.

    Texts are not shuffled: a bitmap of ``_BITMAP`` places over the hashed ids of those documents, of the
    same size for any corpus, spares most other texts the shingling; the join on the set's own key is exact.
    """
    place = F.pmod(F.xxhash64("copy_id"), F.lit(_BITMAP))
    used = members.select(place.alias("place")).distinct().toArrow().column("place").to_numpy()
    bitmap = np.zeros(_BITMAP, bool)
    bitmap[used] = True
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(bitmap))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        named, hashes = np.unpackbits(shared.value).astype(bool), _WordHashes()
        for batch in batches:
            batch = batch.filter(pa.array(named[batch.column("place").to_numpy()]))
            if not batch.num_rows:
                continue
            texts = texts_of(batch)
            for a, b in slices(texts):
                sets = [x.tobytes() for x in shingle_sets(texts[a:b], words, hashes)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([xxhash.xxh3_128_digest(x) for x in sets], pa.binary()), pa.array(sets, pa.binary())], names=["key", "shingles"]
                )

    place = F.pmod(F.xxhash64("doc_id"), F.lit(_BITMAP)).alias("place")
    sets = docs.filter("doc_id is not null").select("text", place).mapInArrow(run, "key binary, shingles binary")
    # A text that comes again, in a repeated row or by chance in the bitmap, gives its set again; one is enough.
    named = members.select("key", "copies", "root", "size")
    return sets.join(named, "key").dropDuplicates(["key"])


def _with_keys(docs: DataFrame, words: int) -> DataFrame:
    """``docs`` with ``__key``: the class of the text, or the text itself (after a sign) if it has no words; empty for null."""

    def make():
        import xxhash

        hashes = _WordHashes()

        def work(batch: pa.RecordBatch) -> list:
            given, texts, keys = batch.column("text").to_pylist(), texts_of(batch), []
            for a, b in slices(texts):
                for text, shingles in zip(given[a:b], shingle_sets(texts[a:b], words, hashes), strict=True):
                    plain = b"" if text is None else b"-" + text.encode()
                    keys.append(xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else plain)
            return [pa.array(keys, pa.binary())]

        return work

    return append_columns(docs, "__key binary", make)


def keep_one_of_each(docs: DataFrame, threshold: float = 0.8, words: int = 5) -> DataFrame:
    """One document of each group: the one whose doc_id is the group's smallest.

    Rows are told apart by doc_id and shingle set, so that of a doc_id with several texts each is decided
    by its own group; of rows that agree in both, the one with the smallest text stays. Rows with null
    doc_id all stay, as do texts without words, but for repeats of doc_id and text.
    """
    own = F.col("key").isNull() | ((F.col("key") == F.col("lead")) & (F.col("doc_id") == F.col("copy_id")))
    found = stage(_similar(docs, threshold, words).select("doc_id", "key", own.alias("kept")), "similar")
    # Decisions are ids, written before they meet the texts: Spark knows their size then, and shuffles the texts
    # only if they are too many to be sent to every executor.
    gone = stage(found.filter("not kept").select("doc_id", F.col("key").alias("__key")).distinct(), "gone")
    repeated = found.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    repeated = stage(repeated, "repeated")
    decided = stage(gone.select("doc_id").union(repeated).distinct(), "decided")
    single = docs.join(decided, "doc_id", "left_anti")
    several = _with_keys(docs.join(repeated, "doc_id", "left_semi"), words).join(gone, ["doc_id", "__key"], "left_anti")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    # min_by would pass over rows of null text.
    one = several.groupBy("doc_id", "__key").agg(F.min_by(row, F.coalesce(F.col("text"), F.lit(""))).alias("__row")).select("__row.*")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return single.select(*columns).unionByName(one)
