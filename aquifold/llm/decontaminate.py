"""Benchmark decontamination with suffix arrays over shards of the training words.

Every slice of documents is a shard: the words that occur in a benchmark are numbered, the
stretches of such words that are long enough to hold a whole window form the shard's text,
and its suffixes are sorted by prefix doubling. All windows of the benchmark items are then
searched at once by binary search for the interval of suffixes that begin with them.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aquifold.llm.common import append_columns, shielded, slices, texts_of, unshielded, without

#: Words of benchmark text that one pass holds; a larger benchmark is searched in several passes.
PASS_WORDS = 2_000_000

# Bytes that belong to words stay (letters in lower case), all others become blanks.
_WORD_BYTES = bytes(
    b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)
)


def words_of(text: str) -> list[bytes]:
    """Runs of digits, ASCII letters (lower-cased) and characters beyond ASCII, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


class SuffixArray:
    """Suffixes of a sequence of positive numbers in which 0 ends a stretch, sorted within stretches."""

    def __init__(self, text: np.ndarray) -> None:
        self.text = np.asarray(text, np.int64)
        n = len(self.text)
        rank = self.text
        ends = np.flatnonzero(self.text == 0)
        longest = int(np.diff(np.concatenate([[-1], ends, [n]])).max(initial=1))
        depth = 1
        while depth < longest:
            after = np.zeros(n, np.int64)
            after[: n - depth] = rank[depth:]
            values, rank = np.unique(rank * (int(rank.max(initial=0)) + 1) + after, return_inverse=True)
            depth *= 2
            if len(values) == n:
                break
        self.order = np.argsort(rank, kind="stable")

    def interval(self, pattern: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """For each start in ``at``, the range of places in ``order`` whose suffixes begin with that window of ``pattern``."""
        padded = np.concatenate([self.text, np.zeros(length, np.int64)])

        def bound(above: bool) -> np.ndarray:
            low, high = np.zeros(len(at), np.int64), np.full(len(at), len(self.order), np.int64)
            while (active := np.flatnonzero(low < high)).size:
                middle = (low[active] + high[active]) // 2
                suffix, window = self.order[middle], at[active]
                less = np.full(len(active), above)
                open_ = np.arange(len(active))
                for k in range(length):
                    a, b = padded[suffix[open_] + k], pattern[window[open_] + k]
                    less[open_[a < b]] = True
                    less[open_[a > b]] = False
                    open_ = open_[a == b]
                    if not open_.size:
                        break
                low[active[less]] = middle[less] + 1
                high[active[~less]] = middle[~less]
            return low

        return bound(False), bound(True)


class BenchmarkWindows:
    """Windows of benchmark items, and their occurrences in a list of texts."""

    def __init__(self, items: list[tuple[str, str]], window: int) -> None:
        self.vocabulary: dict[bytes, int] = {}
        pattern: list[int] = []
        self.names: list[str] = []
        starts: dict[int, list[tuple[int, int, int]]] = {}
        for name, text in items:
            words = words_of(text)
            if not words:
                continue
            length, base = min(window, len(words)), len(pattern)
            starts.setdefault(length, []).extend(
                (base + i, len(self.names), i) for i in range(len(words) - length + 1)
            )
            pattern += [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
            self.names.append(name)
        self.pattern = np.array(pattern, np.int64)
        self.windows = {length: np.array(rows, np.int64).reshape(-1, 3) for length, rows in starts.items()}
        self.shortest = min(self.windows, default=0)

    def search(self, texts: list[str]) -> list[tuple[int, list[tuple[int, int]], list[str], list[tuple[str, int, int, int]]]]:
        """Per text: words, merged hit ranges, items found, maximal verbatim matches (item, place there, place here, length)."""
        counts, parts = [], []
        zero = np.zeros(1, np.int64)
        get = self.vocabulary.get
        for text in texts:
            words = words_of(text)
            counts.append(len(words))
            parts += [np.fromiter(map(get, words, repeat(0)), np.int64, len(words)), zero]
        found = [(n, [], [], []) for n in counts]
        if not self.windows or not parts:
            return found
        numbers = np.concatenate(parts)
        breaks = np.concatenate([[-1], np.flatnonzero(numbers == 0)])
        long_enough = np.flatnonzero(np.diff(breaks) > self.shortest)
        if not len(long_enough):
            return found
        first, last = breaks[long_enough] + 1, breaks[long_enough + 1]
        lengths = last - first + 1  # with the 0 that ends the stretch
        origin = np.repeat(first - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
        shard = SuffixArray(numbers[origin])
        doc_start = np.concatenate([[0], np.cumsum(np.array(counts, np.int64) + 1)])
        hits = []
        for length, rows in self.windows.items():
            low, high = shard.interval(self.pattern, rows[:, 0], length)
            n = high - low
            which = np.repeat(np.arange(len(rows)), n)
            places = np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            at = origin[shard.order[places]]
            hits.append(np.stack([at, rows[which, 1], rows[which, 2], np.full(len(at), length)], axis=1))
        hits = np.concatenate(hits)
        if not len(hits):
            return found
        docs = np.searchsorted(doc_start, hits[:, 0], side="right") - 1
        # Windows that follow one another in the item and in the text are one verbatim match.
        order = np.lexsort((hits[:, 0], hits[:, 0] - hits[:, 2], hits[:, 1], docs))
        hits, docs = hits[order], docs[order]
        new = np.ones(len(hits), bool)
        new[1:] = (np.diff(docs) != 0) | (np.diff(hits[:, 1]) != 0) | (np.diff(hits[:, 0]) != 1) | (np.diff(hits[:, 2]) != 1)
        heads = np.flatnonzero(new)
        tails = np.concatenate([heads[1:], [len(hits)]]) - 1
        for head, tail in zip(heads.tolist(), tails.tolist(), strict=True):
            doc = int(docs[head])
            at, item, place, length = hits[head].tolist()
            at -= int(doc_start[doc])
            found[doc][3].append((self.names[item], place, at, tail - head + length))
        for _, spans, items, matches in found:
            if matches:
                items += sorted({m[0] for m in matches})
                for a, b in sorted((m[2], m[2] + m[3]) for m in matches):
                    if spans and a <= spans[-1][1]:
                        spans[-1] = (spans[-1][0], max(b, spans[-1][1]))
                    else:
                        spans.append((a, b))
        return found


_RESULTS = ("n_words", "n_hit", "item_ids", "matches", "contaminated")
_SPAN = "array<struct<start:int,end:int>>"
_MATCH = "array<struct<item_id:string,item_start:int,doc_start:int,length:int>>"


def _covered(spans: Column) -> Column:
    """Number of words in a sorted list of possibly overlapping ranges."""
    state = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("int").alias("upto"))
    return F.aggregate(
        spans, state,
        lambda s, x: F.struct(
            (s["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(x["start"], s["upto"]))).cast("bigint").alias("n"),
            F.greatest(s["upto"], x["end"]).alias("upto"),
        ),
        lambda s: s["n"],
    )


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, keep: list[str] | None = None, pass_words: int = PASS_WORDS
) -> DataFrame:
    """Documents with the benchmark passages they hold verbatim.

    Adds ``n_words``, ``n_hit`` (words inside an occurrence of any ``window`` consecutive item
    words; an item of fewer words is one window), ``item_ids`` (sorted as strings), ``matches``
    (longest verbatim matches: item_id, item_start, doc_start, length in words) and
    ``contaminated``. Null texts have no words; items without words, and null or empty
    benchmarks, match nothing; a null item_id counts as the empty string. Columns of those names in
    ``docs`` are replaced, others pass through (``keep`` selects some). Rows are not shuffled.
    """
    docs = without(docs, *_RESULTS)
    columns = keep or docs.columns
    docs = docs.select(*dict.fromkeys([*columns, "text"]))
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    chars = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    passes = -(-chars // (2 * pass_words)) or 1  # a word and its blank take two characters at least
    numbered = items.withColumn("pass", F.pmod(F.monotonically_increasing_id(), F.lit(passes)))

    def search(rows: list[tuple[str, str]]) -> Callable:
        def make():
            windows = BenchmarkWindows(rows, window)

            def work(batch: pa.RecordBatch) -> list:
                texts = texts_of(batch)
                found = [x for a, b in slices(texts) for x in windows.search(texts[a:b])]
                return [[x[i] for x in found] for i in range(4)]

            return work

        return make

    out = docs
    for k in range(passes):
        rows = [(r["item_id"], r["text"]) for r in numbered.filter(F.col("pass") == k).select("item_id", "text").collect()]
        out = append_columns(
            out, f"__words{k} bigint, __spans{k} {_SPAN}, __items{k} array<string>, __matches{k} {_MATCH}", search(rows)
        )
    spans, item_ids, matches = (F.concat(*[F.col(f"{c}{k}") for k in range(passes)]) for c in ("__spans", "__items", "__matches"))
    n_hit = _covered(F.array_sort(spans))
    return out.select(
        *[F.col(f"`{c}`") for c in columns], F.col("__words0").alias("n_words"), n_hit.alias("n_hit"),
        F.array_sort(F.array_distinct(item_ids)).alias("item_ids"), matches.alias("matches"),
        (n_hit > 0).alias("contaminated"),
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The documents without any benchmark window, with their own columns only."""
    found = find_contamination(shielded(docs, *_RESULTS), benchmark, window)
    return unshielded(found.filter(~F.col("contaminated")), docs.columns)
