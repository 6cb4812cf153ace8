"""Compress integer vectors to codes, with exact distances from limb-split products.

A vector is cut into equal parts and each part replaced by the index of the nearest entry of its
position's codebook. Components are integers. For the products of parts and entries they are
broken into limbs so small that a float64 matrix product of limbs stays below 2^53 and is
therefore exact; the products of all limb pairs are shifted and added up in int64. Nearest is
the first smallest distance.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aquifold.llm.common import without
from aquifold.llm.prefix_sums import joined
from aquifold.session import stage

_BATCH = 8192


def limb_bits(width: int) -> int:
    """The most bits of a limb for which a sum of ``width`` products of limbs stays below 2^53."""
    return (53 - max(width - 1, 0).bit_length()) // 2


def limbs(values: np.ndarray, width: int) -> list[np.ndarray]:
    """Float64 limbs of int64 values, lowest first; the lower ones are non-negative, the last carries the sign."""
    bits = limb_bits(width)
    out = []
    while values.size and (values.max() >= 1 << bits or values.min() < -(1 << bits)):
        out.append((values & ((1 << bits) - 1)).astype(np.float64))
        values = values >> bits
    return [*out, values.astype(np.float64)]


def exact_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """``left @ right`` of (stacks of) int64 matrices, exact wherever the result fits int64."""
    width = left.shape[-1]
    bits = limb_bits(width)
    total = np.zeros((*left.shape[:-1], right.shape[-1]), np.int64)
    others = limbs(right, width)
    for i, a in enumerate(limbs(left, width)):
        for j, b in enumerate(others):
            # Bits beyond the 64th are lost on the way and cancel out in a sum that fits.
            if (shift := bits * (i + j)) < 64:
                total += np.matmul(a, b).astype(np.int64) << shift
    return total


@dataclass
class Codebooks:
    """Entries as int64 of shape (parts, entries, part width)."""

    entries: np.ndarray

    def assign(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry and its squared distance, both of shape (parts, rows)."""
        parts, _, width = self.entries.shape
        pieces = vectors.reshape(len(vectors), parts, width).transpose(1, 0, 2)
        scores = (self.entries**2).sum(2)[:, None, :] - 2 * exact_products(pieces, self.entries.transpose(0, 2, 1))
        code = scores.argmin(2)
        best = np.take_along_axis(scores, code[:, :, None], 2)[:, :, 0]
        return code, best + (pieces**2).sum(2)

    def digest(self) -> str:
        """Hex sha256 of all components as decimals, by part, entry and place, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def integer_rows(df: DataFrame, column: str = "embedding", scale: int = 256) -> DataFrame:
    """``df`` with ``__vector``: floor(scale * x) of each component, for vectors without null or non-finite components."""
    vector = F.col(f"`{column}`").cast("array<double>")
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.filter(vector.isNotNull() & sound).withColumn(
        "__vector", F.transform(vector, lambda x: F.floor(x * F.lit(float(scale))))
    )


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, _BATCH):
            yield batch.slice(at, _BATCH)


def _refined(rows: DataFrame, books: Codebooks) -> Codebooks:
    """Every used entry replaced by the floor of the mean of its parts; a task sends one sum per used entry."""
    parts, entries, width = books.entries.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts * entries, width), np.int64)
        counts = np.zeros(parts * entries, np.int64)
        for piece in _pieces(batches):
            vectors = _matrix(piece.column(0), parts * width)
            code, _ = books.assign(vectors)
            slots = (code + np.arange(parts)[:, None] * entries).ravel()
            members = vectors.reshape(-1, parts, width).transpose(1, 0, 2).reshape(-1, width)
            order = np.argsort(slots, kind="stable")
            used, first = np.unique(slots[order], return_index=True)
            sums[used] += np.add.reduceat(members[order], first, axis=0)
            counts += np.bincount(slots, minlength=len(counts))
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict(
            {"slot": pa.array(at), "n": pa.array(counts[at]), "sums": pa.array(sums[at].tolist(), pa.list_(pa.int64()))}
        )

    found = rows.select("__vector").mapInArrow(run, "slot bigint, n bigint, sums array<bigint>")
    whole = [F.sum(F.col("sums")[i].cast("decimal(38,0)")) for i in range(width)]
    out = books.entries.copy().reshape(-1, width)
    # One row per entry: as many as the codebooks have, whatever the table's size.
    for slot, n, *totals in found.groupBy("slot").agg(F.sum("n"), *whole).collect():
        out[slot] = [int(t) // n for t in totals]
    return Codebooks(out.reshape(books.entries.shape))


def fit(rows: DataFrame, id_column: str, parts: int = 16, entries: int = 64, rounds: int = 2) -> Codebooks | None:
    """Codebooks from ``integer_rows``: they start as the vectors of the smallest ids; None without rows."""
    order = [F.col(id_column).asc_nulls_last(), F.col("__vector")]
    first = np.array([r[0] for r in rows.orderBy(*order).limit(entries).select("__vector").collect()], np.int64)
    if not first.size:
        return None
    width = first.shape[1] // parts
    books = Codebooks(first.reshape(len(first), parts, width).transpose(1, 0, 2).copy())
    for _ in range(rounds):
        books = _refined(rows, books)
    return books


def _usual_length(rows: DataFrame, parts: int) -> tuple[int, int]:
    """The length most vectors have (the longer of equally frequent ones) and the largest component's size."""
    lengths = rows.filter(F.size("__vector") > 0).groupBy(F.size("__vector").alias("length"))
    # Vectors' lengths are few; only the first row of their counts is fetched.
    top = lengths.agg(F.count("*").alias("n"), F.max(_largest()).alias("largest"))
    found = top.filter(F.col("length") % parts == 0).orderBy(F.desc("n"), F.desc("length")).first()
    return (found["length"], found["largest"]) if found else (0, 0)


def _largest() -> Column:
    return F.array_max(F.transform("__vector", lambda x: F.abs(x)))


def compress(
    vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding", group: str = "label",
    parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256,
) -> tuple[DataFrame, Codebooks | None]:
    """The coded rows and the codebooks.

    Rows keep their other columns and get code (one index per part), error (squared distance to the
    coded vector) and group_error (sum of errors over equal ``group``, nulls together); columns of
    these names are replaced. Vectors that are null or hold null or non-finite components are
    left out. So are vectors of another length than most of those that can be cut into ``parts``:
    an empty one has no parts. Repeated rows count as often as they occur; null ids come last in the
    choice of the first entries; fewer rows than entries make smaller codebooks, and no rows give
    none. Distances must fit 64 bits; components too large for that are an error.

    The rows are read once per round; a task sends one sum per entry it used, and only the codebooks
    (``parts`` times ``entries`` times the part's width numbers) reach the driver.
    """
    rows = integer_rows(without(vectors, "code", "error", "group_error"), column, scale)
    length, largest = _usual_length(rows, parts)
    # A part's squared distance is at most its width times the square of twice the largest component.
    if length and length * (2 * (largest + 1)) ** 2 >= 2**63:
        raise ValueError(f"components up to {largest} are too large for 64-bit distances")
    rows = rows.filter(F.size("__vector") == (length or -1))
    books = fit(rows, id_column, parts, entries, rounds)
    schema = T.StructType([*rows.drop("__vector").schema.fields, *T.StructType.fromDDL("code array<int>, error bigint").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _pieces(batches):
            code, error = books.assign(_matrix(piece.column("__vector"), length))
            kept = piece.drop_columns(["__vector"])
            codes = pa.FixedSizeListArray.from_arrays(pa.array(code.T.astype(np.int32).ravel()), parts)
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, codes.cast(pa.list_(pa.int32())), pa.array(error.sum(0))], names=[*kept.schema.names, "code", "error"]
            )

    if books is None:
        return rows.drop("__vector").selectExpr("*", "array(0) code", "0L error", "0L group_error"), None
    coded = stage(rows.mapInArrow(run, schema), "coded")
    sums = stage(coded.groupBy(group).agg(F.sum("error").alias("group_error")), "sums")
    return joined(coded, sums, [group]), books


def code_text(column: str = "code") -> Column:
    """Indexes as two hexadecimal digits each."""
    return F.array_join(F.transform(column, lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
