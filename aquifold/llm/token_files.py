"""Token-id files coded by a static range asymmetric numeral system.

A file set is a folder with two tables:

* ``blocks``: one row per block of whole documents in ascending doc_id order, with the
  documents' ids and lengths and one binary payload;
* ``frequencies``: the frequency of every id, scaled to 2**20 in total, shared by all blocks.

A payload is a header (magic, ids, lanes, steps, steps between checkpoints, crc32 of the
ids as little-endian uint32, 32-bit words), then for every checkpoint the offset of its next
word and the state of every lane, then the words. Id i belongs to lane ``i mod lanes``; the
lanes share one stream of words, each step's in lane order. Decoding can start at any
checkpoint, and the decoder below runs all stretches between checkpoints at once.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from aquifold.llm.common import slices
from aquifold.llm.tokens import corpus_tokenizer
from aquifold.session import new_folder, stage

_HEADER = struct.Struct("<4sIIIIII")
_MAGIC = b"TRS1"
_BITS = 20
_LOW = np.uint64(1 << 32)
_MASK = np.uint64((1 << _BITS) - 1)
_WORD = np.uint64(32)
_SHIFT = np.uint64(_BITS)
_COUNTED_BYTES = 4_000_000


def scaled_frequencies(counts: np.ndarray) -> np.ndarray:
    """Counts scaled to 2**20 in total; every id that occurs keeps at least 1."""
    counts = np.asarray(counts, dtype=np.float64)
    total, present = counts.sum(), counts > 0
    if not total:
        return np.zeros(len(counts), np.int64)
    if present.sum() > 1 << _BITS:
        raise ValueError("more ids in use than the frequency table has places")
    scaled = np.where(present, np.maximum(1, np.floor(counts / total * (1 << _BITS))), 0).astype(np.int64)
    order = np.argsort(-scaled, kind="stable")
    spare = (1 << _BITS) - int(scaled.sum())
    if spare >= 0:
        scaled[order[0]] += spare
    for i in order if spare < 0 else ():
        given = min(-spare, int(scaled[i]) - 1)
        scaled[i] -= given
        spare += given
        if not spare:
            break
    return scaled


class RangeCoder:
    """Encodes and decodes blocks under one frequency table."""

    def __init__(self, frequencies: np.ndarray, lanes: int = 1024, checkpoint_steps: int = 64) -> None:
        self._frequency = np.asarray(frequencies, np.uint64)
        self._start = (np.cumsum(self._frequency) - self._frequency).astype(np.uint64)
        self._id_at = np.repeat(np.arange(len(frequencies), dtype=np.uint32), self._frequency.astype(np.int64))
        self._lanes, self._every = lanes, checkpoint_steps

    def encode(self, ids: np.ndarray) -> bytes:
        n = len(ids)
        lanes = max(1, min(self._lanes, n // 64))
        steps = -(-n // lanes)
        filler = ids[-1:] if n else ids
        padded = np.concatenate([ids, np.repeat(filler, steps * lanes - n)]).astype(np.int64).reshape(steps, lanes)
        frequency, start = self._frequency[padded], self._start[padded]
        if n and not frequency.all():
            raise ValueError("an id has no place in the frequency table")
        state = np.full(lanes, _LOW, np.uint64)
        words: list[np.ndarray] = []
        checkpoints: list[tuple[int, np.ndarray]] = []
        written = 0
        for step in range(steps - 1, -1, -1):
            f = frequency[step]
            over = state >= f << np.uint64(64 - _BITS)
            out = state[over].astype(np.uint32)
            words.append(out)
            written += len(out)
            state = np.where(over, state >> _WORD, state)
            quotient = state // f
            state = (quotient << _SHIFT) + (state - quotient * f) + start[step]
            if step % self._every == 0:
                checkpoints.append((written, state))
        table = b"".join(
            struct.pack("<I", written - left) + states.astype("<u8").tobytes() for left, states in reversed(checkpoints)
        )
        stream = np.concatenate(words[::-1]).astype("<u4").tobytes() if words else b""
        crc = zlib.crc32(ids.astype("<u4").tobytes())
        return _HEADER.pack(_MAGIC, n, lanes, steps, self._every, crc, written) + table + stream

    def decode(self, payload: bytes) -> np.ndarray:
        """The ids of a block; raises if its checksum does not hold."""
        magic, n, lanes, steps, every, crc, written = _HEADER.unpack_from(payload)
        if magic != _MAGIC:
            raise ValueError("not a block of token ids")
        count, width, at = -(-steps // every), 4 + 8 * lanes, _HEADER.size
        table = np.frombuffer(payload, np.uint8, count * width, at).reshape(count, width)
        cursor = table[:, :4].copy().view("<u4").astype(np.int64).ravel()
        state = table[:, 4:].copy().view("<u8").astype(np.uint64)
        stream = np.concatenate([np.frombuffer(payload, "<u4", written, at + count * width), np.zeros(1, "<u4")])
        out = np.zeros((count, every, lanes), np.uint32)
        for k in range(every):
            slot = state & _MASK
            ids = self._id_at[slot]
            out[:, k] = ids
            state = self._frequency[ids] * (state >> _SHIFT) + slot - self._start[ids]
            under = state < _LOW
            place = np.cumsum(under, axis=1)
            index = np.minimum(cursor[:, None] + place - 1, written)
            state = np.where(under, (state << _WORD) | stream[np.maximum(index, 0)], state)
            cursor = cursor + place[:, -1]
            if steps % every and k + 1 == steps % every:  # the last stretch ends here; keep its state harmless
                state[-1] = _LOW
        ids = out.reshape(-1)[:n]
        if zlib.crc32(ids.astype("<u4").tobytes()) != crc:
            raise ValueError("checksum of a block of token ids does not hold")
        return ids


BLOCKS = (
    "part bigint, block bigint, part_start bigint, doc_ids array<bigint>, lengths array<int>, n_ids bigint, "
    "payload binary"
)


def tokenise(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """doc_id and ids (packed little-endian) of every document, with the end id; a null text is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = corpus_tokenizer(tokenizer)
        end = np.array([end_id], encoder.dtype).tobytes()
        for batch in batches:
            ids = [x + end for x in encoder.encode_column(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.binary()), pa.array([encoder.dtype.itemsize] * len(ids), pa.int32())],
                names=["doc_id", "ids", "width"],
            )

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id bigint, ids binary, width int"
    )


def _id_counts(staged: DataFrame) -> np.ndarray:
    """How often each id occurs; one row per id and task meets in the shuffle, one per id at the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << 16, np.int64)
        for batch in batches:
            ids, widths = batch.column("ids"), batch.column("width")
            for width in pc.unique(widths).to_pylist():
                rows = ids.filter(pc.equal(widths, width)).to_pylist()
                # A count makes an array of all ids, so many texts share one.
                for start, end in slices(rows, _COUNTED_BYTES):
                    found = np.bincount(np.frombuffer(b"".join(rows[start:end]), f"<u{width}"))
                    if len(found) > len(counts):
                        counts = np.concatenate([counts, np.zeros(len(found) - len(counts), np.int64)])
                    counts[: len(found)] += found
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(counts[used], pa.int64())], names=["id", "n"])

    rows = staged.select("ids", "width").mapInArrow(run, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max((r["id"] for r in rows), default=0) + 1, np.int64)
    for r in rows:
        counts[r["id"]] = r["n"]
    return counts


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str = "byte_bpe_50k.json", end_id: int = 2,
    block_ids: int = 1 << 18, lanes: int = 1024, checkpoint_steps: int = 64,
) -> None:
    """Encode every document's ids and write them to ``folder`` in ascending doc_id order.

    Rows with equal or null doc_id are all kept (nulls first, equal ones in the order read).
    The texts are tokenised once into the shared folder; counts and the ordering read that
    copy. Ordering is a range partitioning on (doc_id, row), so a doc_id with very many rows
    spreads over partitions. A block holds whole documents, ``block_ids`` ids or the last
    document beyond.
    """
    spark = docs.sparkSession
    staged = stage(tokenise(docs, tokenizer, end_id).withColumn("row", F.monotonically_increasing_id()), "token-ids")
    frequencies = scaled_frequencies(_id_counts(staged))
    used = np.flatnonzero(frequencies)
    spark.createDataFrame(
        [(int(i), int(frequencies[i])) for i in used], "id bigint, frequency bigint"
    ).coalesce(1).write.parquet(f"{folder}/frequencies")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = RangeCoder(frequencies, lanes, checkpoint_steps)
        part, block, part_start = TaskContext.get().partitionId(), 0, 0
        doc_ids: list[int | None] = []
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal block, part_start, doc_ids, held, size
            row = pa.RecordBatch.from_arrays([
                pa.array([part], pa.int64()), pa.array([block], pa.int64()), pa.array([part_start], pa.int64()),
                pa.array([doc_ids], pa.list_(pa.int64())), pa.array([[len(x) for x in held]], pa.list_(pa.int32())),
                pa.array([size], pa.int64()), pa.array([coder.encode(np.concatenate(held))], pa.binary()),
            ], names=["part", "block", "part_start", "doc_ids", "lengths", "n_ids", "payload"])
            block, part_start, doc_ids, held, size = block + 1, part_start + size, [], [], 0
            return row

        for batch in batches:
            for doc_id, ids, width in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "ids", "width")), strict=True):
                doc_ids.append(doc_id)
                held.append(np.frombuffer(ids, f"<u{width}").astype(np.uint32))
                size += len(held[-1])
                if size >= block_ids:
                    yield flush()
        if held:
            yield flush()

    (
        staged.repartitionByRange("doc_id", "row").sortWithinPartitions("doc_id", "row")
        .select("doc_id", "ids", "width").mapInArrow(run, BLOCKS)
        .write.option("compression", "none").parquet(f"{folder}/blocks")
    )


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it) and ids (little-endian uint32) of every document written."""
    rows = spark.read.schema("id bigint, frequency bigint").parquet(f"{folder}/frequencies").collect()
    frequencies = np.zeros(max((r["id"] for r in rows), default=0) + 1, np.int64)
    for r in rows:
        frequencies[r["id"]] = r["frequency"]
    blocks = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = RangeCoder(frequencies)
        for batch in batches:
            for row in batch.to_pylist():
                ids = coder.decode(row["payload"]).astype("<u4")
                ends = np.cumsum(row["lengths"], dtype=np.int64)
                starts = ends - np.asarray(row["lengths"], np.int64)
                yield pa.RecordBatch.from_arrays([
                    pa.array(row["doc_ids"], pa.int64()), pa.array([row["part"]] * len(ends), pa.int64()),
                    pa.array(starts + row["part_start"], pa.int64()),
                    pa.array([ids[a:b].tobytes() for a, b in zip(starts, ends, strict=True)], pa.binary()),
                ], names=["doc_id", "part", "place", "ids"])

    # One row for each task that wrote, which bounds the broadcast; without it the ids would be shuffled for this join.
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = parts.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("before"))
    return (
        blocks.mapInArrow(run, "doc_id bigint, part bigint, place bigint, ids binary").join(F.broadcast(before), "part")
        .select("doc_id", (F.col("before") + F.col("place")).alias("start"), "ids")
    )


def token_file_digest(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", end_id: int = 2) -> DataFrame:
    """Write ``docs`` as token files and read them back: doc_id, start, n_tokens, ids_crc32."""
    folder = new_folder(docs.sparkSession, "token-files")
    write_token_files(docs, folder, tokenizer, end_id)
    return read_token_files(docs.sparkSession, folder).select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )
