"""Merkle manifest of a table of documents, with leaf coordinates from bitmap ranks.

Per group (language) the doc_ids of each range of 32,768 are merged into a bitmap, whose zero
runs the shuffle's and Parquet's codecs squeeze out. A popcount directory holds the ids before
each range, and within a bitmap before each of its 64 blocks, so a leaf's place among its
group's leaves is two look-ups and the popcount of part of a block: leaves are never sorted.
Places then key slot arrays of 1,024 nodes that are hashed up to one node each, array by array,
until one node is left.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aquifold.llm.common import append_columns
from aquifold.llm.prefix_sums import joined, starts
from aquifold.session import stage
from aquifold.sources.store import number_rows

#: Nodes of one slot array, as a power of two.
SLOT_BITS = 10
#: Ids of one bitmap, as a power of two: what Spark's bitmap aggregate holds.
RANGE_BITS = 15
_BLOCK_BITS = 9
#: Bits of a range's number that each level of the directory's sums resolves.
_LEVEL_BITS = 12

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def leaf_hash(columns: dict[str, Column]) -> Column:
    """Hex sha256 of the values in turn, each ``-`` if null, else its number of UTF-8 bytes, ``:`` and itself."""
    texts = [c.cast("string") for c in columns.values()]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def _node(*digests: str) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def _levels(nodes: int, bits: int) -> int:
    """Levels above ``nodes`` nodes that one slot array goes through."""
    return min((nodes - 1).bit_length(), bits)


def _above(row: list[str]) -> list[str]:
    return [_node(*row[i : i + 2]) for i in range(0, len(row), 2)]


def reduced(slots: list[str], levels: int) -> str:
    """The node that a slot array's nodes become after so many levels."""
    for _ in range(levels):
        slots = _above(slots)
    return slots[0]


def paths(slots: list[str], levels: int) -> list[list[str]]:
    """For each slot, level by level upwards: ``l`` and the sibling's digest if that is left, ``r`` if right, or ``-`` if none."""
    rows = [slots]
    for _ in range(levels):
        rows.append(_above(rows[-1]))
    out = []
    for place in range(len(slots)):
        path = []
        for row in rows[:levels]:
            other = place ^ 1
            path.append(("l" if other < place else "r") + row[other] if other < len(row) else "-")
            place >>= 1
        out.append(path)
    return out


def fold(leaf: str, path: list[str]) -> str:
    """The root that a leaf and the siblings on its path make."""
    for step in path:
        if step == "-":
            leaf = _node(leaf)
        elif step[0] == "l":
            leaf = _node(step[1:], leaf)
        else:
            leaf = _node(leaf, step[1:])
    return leaf


def proof_hash(path: list[str]) -> str:
    return _node(*[step[1:] for step in path if step != "-"])


# leaf coordinates -------------------------------------------------------------


def positions(leaves: DataFrame) -> DataFrame:
    """``leaves`` (group_no, doc_id, leaf, further columns) with ``position``: their place from 0 in their group.

    The order is by doc_id, null first, then by leaf; equal rows get consecutive places. Ranges of
    ids without nulls or repeats are ranked by bitmap. In the others, rows are counted per id and
    leaf and placed by prefix sums.
    """
    leaves = leaves.withColumn("__range", F.shiftright("doc_id", RANGE_BITS))
    place = F.col("doc_id").bitwiseAND((1 << RANGE_BITS) - 1)
    ranges = leaves.groupBy("group_no", "__range").agg(
        F.bitmap_construct_agg(place).alias("__bits"), F.count("*").alias("__rows")
    )
    ranges = stage(ranges, "bitmaps")
    levels = []
    for i in range(3, 0, -1):
        ranges = ranges.withColumn(f"__l{i}", F.shiftright("__range", _LEVEL_BITS * i))
        levels.append(f"__l{i}")
    directory = starts(ranges.drop("__bits"), ["group_no"], [*levels, "__range"], "__rows")
    blocks = F.transform(
        F.sequence(F.lit(0), F.lit((1 << RANGE_BITS - _BLOCK_BITS) - 1)),
        lambda i: F.bitmap_count(F.substring("__bits", F.lit(1), i * (1 << _BLOCK_BITS - 3))),
    )
    plain = F.col("__range").isNotNull() & (F.bitmap_count("__bits") == F.col("__rows"))
    ranges = joined(
        ranges.drop("__rows", *levels), directory.select("group_no", "__range", "__rows", "start"), ["group_no", "__range"]
    ).select("group_no", "__range", "start", plain.alias("__plain"), F.when(plain, F.col("__bits")).alias("__bits"), F.when(plain, blocks).alias("__blocks"))
    ranges = stage(ranges, "directory")
    placed = joined(leaves, ranges, ["group_no", "__range"])

    block = F.shiftright(place, _BLOCK_BITS)
    byte = F.shiftright(place, 3)
    whole = F.bitmap_count(F.substring("__bits", (block * 64 + 1).cast("int"), (byte - block * 64).cast("int")))
    last = F.conv(F.hex(F.substring("__bits", (byte + 1).cast("int"), F.lit(1))), 16, 10).cast("bigint")
    below = F.bit_count(last.bitwiseAND(F.expr("shiftleft(1L, cast(doc_id & 7 as int)) - 1")))
    rank = F.col("start") + F.element_at("__blocks", (block + 1).cast("int")) + whole + below
    other = ["start", "__plain", "__bits", "__blocks"]
    ranked = placed.filter("__plain").withColumn("position", rank).drop("__range", *other)

    own = [c for c in leaves.columns if c not in ("group_no", "__range", "doc_id", "leaf")]
    crowded = placed.filter("NOT __plain").groupBy("group_no", "__range", "doc_id", "leaf", *own).agg(
        F.count("*").alias("__n"), F.min("start").alias("__from")
    )
    digits = [F.substring("leaf", 1, 3 * i).alias(f"__d{i}") for i in range(1, 5)]
    levels = ["doc_id", *[f"__d{i}" for i in range(1, 5)], "leaf"]
    same = starts(
        crowded.groupBy("group_no", "__range", "doc_id", "leaf", *digits).agg(F.sum("__n").alias("__n")), ["group_no", "__range"], levels, "__n"
    )
    crowded = joined(crowded, same.select("group_no", "__range", "doc_id", "leaf", "start"), ["group_no", "__range", "doc_id", "leaf"])
    first = F.col("__from") + F.col("start")
    spread = crowded.withColumn("position", F.explode(F.sequence(first, first + F.col("__n") - 1)))
    return ranked.unionByName(spread.select(ranked.columns))


# slot arrays --------------------------------------------------------------------


def _slot_arrays(nodes: DataFrame, sizes: DataFrame, bits: int) -> DataFrame:
    """Nodes (group_no, position, digest, further columns) as arrays of 2^``bits`` slots with the ``root`` of each.

    ``sizes`` (group_no, n) tells how many nodes each group has. Further columns go into the slots.
    """
    own = [c for c in nodes.columns if c not in ("group_no", "position")]
    slot = F.struct(F.col("position").bitwiseAND((1 << bits) - 1).alias("slot"), *own)
    arrays = nodes.groupBy("group_no", F.shiftright("position", bits).alias("block")).agg(
        F.sort_array(F.collect_list(slot)).alias("slots")
    )

    def make():
        def work(batch: pa.RecordBatch) -> list:
            slots, sizes = batch.column("slots"), batch.column("n").to_pylist()
            return [[reduced(slots[i].values.field("digest").to_pylist(), _levels(n, bits)) for i, n in enumerate(sizes)]]

        return work

    return stage(append_columns(joined(arrays, sizes, ["group_no"]), "root string", make), "slots")


def _slot_rows(arrays: DataFrame, upper: DataFrame | None, bits: int, ddl: str, add) -> DataFrame:
    """One row per slot: group_no, position, and what ``add(slots, paths)`` returns as ``ddl`` columns.

    ``upper`` (group_no, position, path) has the paths of the arrays' own roots; None means they have none.
    """
    if upper is None:
        arrays = arrays.withColumn("path", F.array().cast("array<string>"))
    else:
        arrays = joined(arrays, upper.select("group_no", F.col("position").alias("block"), "path"), ["group_no", "block"])
    schema = T.StructType.fromDDL(f"group_no bigint, position bigint, {ddl}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        kinds = to_arrow_schema(schema)
        for batch in batches:
            for i in range(batch.num_rows):
                group, block, n, above = (batch.column(c)[i].as_py() for c in ("group_no", "block", "n", "path"))
                slots = batch.column("slots")[i].values
                places = [(block << bits) + s for s in slots.field("slot").to_pylist()]
                own = [path + above for path in paths(slots.field("digest").to_pylist(), _levels(n, bits))]
                columns = [[group] * len(own), places, *add(slots, own)]
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, kinds, strict=True)], schema=kinds
                )

    return arrays.select("group_no", "block", "n", "path", "slots").mapInArrow(run, schema)


def _grown(nodes: DataFrame, bits: int) -> list[DataFrame]:
    """Slot arrays of every stage, until each group has one array, whose root is the group's."""
    sizes = stage(nodes.groupBy("group_no").agg(F.count("*").alias("n")), "sizes")
    stages = []
    while True:
        stages.append(_slot_arrays(nodes, sizes, bits))
        if (sizes.agg(F.max("n")).first()[0] or 0) <= 1 << bits:
            return stages
        # A group that is done has one node, which has no level above it.
        nodes = stages[-1].select("group_no", F.col("block").alias("position"), F.col("root").alias("digest"))
        sizes = sizes.withColumn("n", F.shiftright(F.col("n") + ((1 << bits) - 1), bits))


def _descended(stages: list[DataFrame], upper: DataFrame | None, bits: int) -> DataFrame | None:
    """Paths (group_no, position, path) of all nodes of the given stages' first, top down."""
    for arrays in reversed(stages):
        upper = stage(_slot_rows(arrays, upper, bits, "path array<string>", lambda _, own: [own]), "paths")
    return upper


def manifest(
    docs: DataFrame, fields: list[str] = FIELDS, id_column: str = "doc_id", group: str = "lang",
    changed: dict[str, Column] | None = None, is_changed: Column | None = None, slot_bits: int = SLOT_BITS,
) -> DataFrame:
    """One row per row of ``docs``: group value, id, position, leaf, subroot, root, proof (hash of the siblings),
    path (the siblings, each with its side), folded_root, verified.

    Within a group leaves ascend by id, null first, equal ids by leaf. Runs of two nodes, the last
    perhaps of one, become their hash until one is left, the subroot; subroots in the order of the
    group values (null first, bytewise) become the root likewise. Where ``is_changed`` holds, the
    root is folded from the leaf of ``fields`` with the ``changed`` columns in place of the table's;
    elsewhere from the leaf itself. ``verified`` tells whether that gives the root.

    Every column may be null; repeated rows have leaves of their own; an empty table has no rows and
    no root. Columns other than ``fields`` take no part and are not returned. Texts are read once;
    what is shuffled is ids and digests, and no task gets more than the rows of its ranges of ids or
    its slot arrays.
    """
    groups = docs.select(F.col(group).alias("group_value")).distinct()
    groups = stage(number_rows(groups, ["group_value"], F.lit(0).cast("bigint"), "group_no"), "groups")
    plain = {f: F.col(f"`{f}`") for f in fields}
    leaves = docs.select(
        F.col(f"`{group}`").alias("group_value"), F.col(f"`{id_column}`").cast("bigint").alias("doc_id"),
        leaf_hash(plain).alias("leaf"),
        (F.when(is_changed, leaf_hash(plain | changed)) if changed else F.lit(None).cast("string")).alias("changed"),
    )
    leaves = stage(joined(leaves, groups, ["group_value"]).drop("group_value"), "leaves")
    stages = _grown(positions(leaves).withColumnRenamed("leaf", "digest"), slot_bits)
    subroots = stage(stages[-1].select("group_no", F.col("root").alias("subroot")), "subroots")
    tops = subroots.select(F.lit(0).cast("bigint").alias("group_no"), F.col("group_no").alias("position"), F.col("subroot").alias("digest"))
    top = _grown(tops, slot_bits)
    root = top[-1].select("root").first()
    # The paths of the subroots, by group number, become those of the groups' last arrays, whose only block is 0.
    upper = _descended(top, None, slot_bits).select(F.col("position").alias("group_no"), F.lit(0).cast("bigint").alias("position"), "path")
    upper = _descended(stages[1:], upper, slot_bits)

    def leaf_columns(slots: pa.StructArray, own: list[list[str]]) -> list:
        digests, others = slots.field("digest").to_pylist(), slots.field("changed").to_pylist()
        folded = [fold(other or digest, path) for digest, other, path in zip(digests, others, own, strict=True)]
        return [slots.field("doc_id"), slots.field("digest"), own, [proof_hash(path) for path in own], folded]

    rows = _slot_rows(stages[0], upper, slot_bits, "doc_id bigint, leaf string, path array<string>, proof string, folded_root string", leaf_columns)
    rows = joined(joined(rows, subroots, ["group_no"]), groups, ["group_no"])
    root = F.lit(root[0] if root else None).cast("string")
    return rows.select(
        F.col("group_value").alias(group), F.col("doc_id").alias(id_column), "position", "leaf", "subroot", root.alias("root"),
        "proof", "path", "folded_root", (F.col("folded_root") == root).alias("verified"),
    )
