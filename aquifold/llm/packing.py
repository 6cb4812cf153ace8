"""Cost-balanced packing of token ids into training sequences.

A sequence of one document with n tokens costs ``linear * n + quadratic * n * n``
(attention stays within a document). Documents are taken in descending length and
each goes to the sequence of lowest cost so far that has room for it.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aquifold.llm.tokens import corpus_tokenizer

#: Pieces handed on together; each may hold a whole sequence of ids.
_YIELDED = 500
_NO_COST = (float("inf"), -1)


class _OpenSequences:
    """Sequences by remaining room; finds the cheapest with at least so much room in log time."""

    def __init__(self, count: int, capacity: int) -> None:
        self._leaves = 1 << capacity.bit_length()
        self._heaps: list[list[tuple[float, int]]] = [[] for _ in range(capacity + 1)]
        self._best = [_NO_COST] * (2 * self._leaves)
        self._heaps[capacity] = [(0.0, i) for i in range(count)]
        self._refresh(capacity)
        self.capacity = capacity

    def _refresh(self, room: int) -> None:
        heap, i = self._heaps[room], room + self._leaves
        self._best[i] = heap[0] if heap else _NO_COST
        i >>= 1
        while i:
            self._best[i] = min(self._best[2 * i], self._best[2 * i + 1])
            i >>= 1

    def cheapest(self, least: int) -> tuple[float, int]:
        """Lowest (cost, sequence) among those with room for ``least``; sequence -1 if there is none."""
        a, b, best = least + self._leaves, 2 * self._leaves, _NO_COST
        while a < b:
            if a & 1:
                best = min(best, self._best[a])
                a += 1
            if b & 1:
                b -= 1
                best = min(best, self._best[b])
            a >>= 1
            b >>= 1
        return best

    def roomiest(self) -> int:
        i = 1
        while i < self._leaves:
            i = 2 * i + 1 if self._best[2 * i + 1] != _NO_COST else 2 * i
        return i - self._leaves

    def take(self, room: int) -> tuple[float, int]:
        found = heapq.heappop(self._heaps[room])
        self._refresh(room)
        return found

    def put(self, room: int, cost: float, sequence: int) -> None:
        if room:
            heapq.heappush(self._heaps[room], (cost, sequence))
            self._refresh(room)


def assign(
    lengths: list[int], capacity: int = 4096, linear: float = 1.0, quadratic: float = 1 / 4096
) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Place documents of these lengths; returns (document, start, length, sequence, offset) and the number of sequences.

    As many sequences are opened as the tokens need at least, so all but ``capacity - 1``
    places are filled. Whole multiples of the capacity are cut off long documents first; a
    rest that fits nowhere whole is cut at the room of the emptiest sequence.
    """
    pieces: list[tuple[int, int, int, int, int]] = []
    opened, rests = 0, []
    for document, length in enumerate(lengths):
        full = length // capacity
        for k in range(full):
            pieces.append((document, k * capacity, capacity, opened, 0))
            opened += 1
        if length % capacity:
            rests.append((length % capacity, document, full * capacity))
    count = -(-sum(r[0] for r in rests) // capacity)
    sequences = _OpenSequences(count, capacity)
    room_of = [capacity] * count
    waiting = [(-length, document, start) for length, document, start in rests]
    heapq.heapify(waiting)
    while waiting:
        negative, document, start = heapq.heappop(waiting)
        length = -negative
        _, sequence = sequences.cheapest(length)
        if sequence < 0:
            room = sequences.roomiest()
            heapq.heappush(waiting, (-(length - room), document, start + room))
            length = room
        else:
            room = room_of[sequence]
        cost, sequence = sequences.take(room)
        pieces.append((document, start, length, opened + sequence, capacity - room))
        room_of[sequence] = room - length
        sequences.put(room - length, cost + linear * length + quadratic * length * length, sequence)
    return pieces, opened + count


PIECES = (
    "doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"
)


def pack(
    docs: DataFrame, tokenizer: str = "word_bpe_49k.json", end_id: int = 2, capacity: int = 4096,
    linear: float = 1.0, quadratic: float = 1 / 4096, group_tokens: int = 4_000_000,
) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, doc_tokens, sequence_id, offset, ids (little-endian uint32).

    Needs columns ``doc_id`` and ``text``; others are left out. A null text is empty (its
    only id is ``end_id``); a null or repeated doc_id is kept row by row. Each task packs its
    own rows in groups of about ``group_tokens`` ids, which bounds its memory and leaves less
    than one sequence of padding per group, so no row is shuffled and a hot key does not
    matter. ``sequence_id`` is the task's number times 2**33 plus a counter from 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = corpus_tokenizer(tokenizer)
        end = np.array([end_id], encoder.dtype).tobytes()
        width = encoder.dtype.itemsize
        first = TaskContext.get().partitionId() << 33
        held: list[tuple[int | None, bytes]] = []
        tokens = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal first, held, tokens
            pieces, opened = assign([len(ids) // width for _, ids in held], capacity, linear, quadratic)
            for at in range(0, len(pieces), _YIELDED):
                part = pieces[at : at + _YIELDED]
                yield pa.RecordBatch.from_arrays([
                    pa.array([held[p[0]][0] for p in part], pa.int64()),
                    pa.array([p[1] for p in part], pa.int64()),
                    pa.array([p[2] for p in part], pa.int64()),
                    pa.array([len(held[p[0]][1]) // width for p in part], pa.int64()),
                    pa.array([first + p[3] for p in part], pa.int64()),
                    pa.array([p[4] for p in part], pa.int64()),
                    pa.array([
                        np.frombuffer(held[p[0]][1], encoder.dtype, p[2], p[1] * width).astype("<u4").tobytes()
                        for p in part
                    ], pa.binary()),
                ], names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])
            first, held, tokens = first + opened, [], 0

        for batch in batches:
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode_column(batch.column("text")), strict=True):
                held.append((doc_id, ids + end))
                tokens += len(ids) // width + 1
                if tokens >= group_tokens:
                    yield from flush()
        if held:
            yield from flush()

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, PIECES)
