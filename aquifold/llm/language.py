"""Language identification with interpolated Kneser-Ney character models.

Texts are lower-cased, everything but letters becomes a single blank, and the four characters
up to each position form a 64-bit gram (16 bits a character, those beyond folded). Spark counts
the grams of each language; lower orders use the number of distinct grams that end in them. A model
is a table in the shared folder, one row per order and gram with an entry for each language, so it
grows with the corpus and is never held as a whole. Texts are scored in chunks: the distinct grams of
each are joined with the model, order by order, and come back to the chunk. A text goes to the
language of lowest cross-entropy per character.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aquifold.llm.common import extended, slices, texts_of, without
from aquifold.session import stage

ORDER = 4
#: Characters of the texts that look up their grams together; a longer text is a chunk of its own.
CHUNK_CHARS = 8_000_000
#: Parts in which the chunks are scored; only one part's texts are on their way through a shuffle at a time.
ROUNDS = 4
_KEEP = np.uint64((1 << 16) - 1)


class _Letters:
    """Which code points are letters, looked up in bulk."""

    _table: np.ndarray | None = None

    @classmethod
    def table(cls) -> np.ndarray:
        if cls._table is None:
            cls._table = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
        return cls._table


def grams_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Grams of all positions, where each text's begin (one more entry at the end), and each text's letters."""
    raw = "\x00".join(texts).lower().encode("utf-32-le", "surrogatepass")
    codes = np.frombuffer(raw, np.uint32)
    # A text may hold the separator itself; lengths after lower-casing tell the texts apart.
    sizes = np.fromiter((len(t.lower()) if "İ" in t else len(t) for t in texts), np.int64, len(texts))
    ends = np.cumsum(sizes + 1)
    letter = _Letters.table()[codes]
    symbols = np.where(letter, codes.astype(np.uint64) & _KEEP, np.uint64(32))
    breaks = ends[:-1] - 1
    letter_like = letter.copy()
    letter_like[breaks] = False
    first = np.ones(len(codes), bool)
    first[1:] = letter_like[1:] | letter_like[:-1]  # a blank stays only after a letter
    begin = np.concatenate([[0], ends[:-1]])
    first[begin[begin < len(codes)]] = True
    keep = letter_like | first
    keep[breaks] = False
    owner = np.repeat(np.arange(len(texts)), np.append(sizes[:-1] + 1, sizes[-1:]) if len(texts) else [])
    symbols, owner = symbols[keep], owner[keep]
    counts = np.bincount(owner, minlength=len(texts))
    starts = np.concatenate([[0], np.cumsum(counts)])
    grams = symbols.copy()
    place = np.arange(len(symbols)) - np.repeat(starts[:-1], counts)
    for k in range(1, ORDER):
        earlier = np.zeros(len(symbols), np.uint64)
        earlier[k:] = symbols[:-k] if k else symbols
        earlier[place < k] = 0
        grams |= earlier << np.uint64(16 * k)
    letters = np.bincount(owner, weights=letter[keep], minlength=len(texts)).astype(np.int64)
    return grams, starts, letters


@dataclass
class LanguageModel:
    """Rows (size, gram, counts, totals, followers): count as predicted gram, total and distinct followers as context, an entry per language."""

    languages: list[str]
    table: DataFrame

    def prepare(self) -> None:
        """Discount of each order and language, and what the first order needs of the whole."""
        width = len(self.languages)
        rows = self.table.select("size", F.posexplode("counts").alias("lang", "n")).groupBy("size", "lang").agg(
            *[F.count_if(F.col("n") == k).alias(name) for k, name in ((1, "ones"), (2, "twos"))],
            F.sum("n").alias("total"), F.count_if(F.col("n") > 0).alias("types"), F.count("*").alias("rows"),
        ).collect()
        self._discount = {n: [0.5] * width for n in range(1, ORDER + 1)}
        self._first, self._letters = ([1] * width, [1] * width), 2
        for r in rows:
            if r.ones:
                self._discount[r["size"]][r.lang] = r.ones / (r.ones + 2 * r.twos)
            if r["size"] == 1:
                self._first[0][r.lang], self._first[1][r.lang] = max(1, r.total), max(1, r.types)
                self._letters = max(1, r.rows) + 1

    def chances(self, grams: DataFrame, n: int = ORDER) -> DataFrame:
        """(gram, chance) of distinct grams of n characters: that of the last character given those before, in each language."""

        def fixed(values: list, kind: str) -> Column:
            return F.array(*[F.lit(v) for v in values]).cast(f"array<{kind}>")

        width = len(self.languages)
        rows = grams.join(self.table.filter(F.col("size") == n).select("gram", "counts"), "gram", "left")
        if n == 1:
            rows = rows.withColumns({
                "totals": fixed(self._first[0], "bigint"), "followers": fixed(self._first[1], "bigint"),
                "lower": fixed([1.0 / self._letters] * width, "double"),
            })
        else:
            mask = F.lit((1 << 16 * (n - 1)) - 1)
            contexts = self.table.filter(F.col("size") == n - 1).select(F.col("gram").alias("context"), "totals", "followers")
            shorter = self.chances(grams.select(F.col("gram").bitwiseAND(mask).alias("gram")).distinct(), n - 1)
            rows = rows.withColumns({"context": F.shiftrightunsigned("gram", 16), "shorter": F.col("gram").bitwiseAND(mask)})
            rows = rows.join(contexts, "context", "left").join(shorter.toDF("shorter", "lower"), "shorter")
        discount = fixed(self._discount[n], "double")

        def chance(lower: Column, i: Column) -> Column:
            count, total = F.coalesce(F.get("counts", i), F.lit(0)), F.get("totals", i)
            spare = F.get(discount, i) * F.get("followers", i)
            value = (F.greatest(count - F.get(discount, i), F.lit(0.0)) + spare * lower) / total
            return F.when(total > 0, value).otherwise(lower)

        return rows.select("gram", F.transform("lower", chance).alias("chance"))

    def log_probability(self, grams: np.ndarray) -> np.ndarray:
        """Natural logarithm of each gram's last character given those before, one column per language. For a few grams."""
        distinct, inverse = np.unique(grams, return_inverse=True)
        wanted = self.table.sparkSession.createDataFrame(pa.table({"gram": distinct.view(np.int64)}))
        found = {r.gram: r.chance for r in self.chances(wanted).collect()}
        return np.log(np.array([found[g] for g in distinct.view(np.int64).tolist()]))[inverse]


def count_grams(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) of the documents; each task adds up its own grams before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        pending: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

        def merge(lang: str) -> None:
            parts = pending.pop(lang, [])
            if lang in held:
                parts.append(held[lang])
            grams, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            held[lang] = grams, np.bincount(inverse, np.concatenate([p[1] for p in parts]), len(grams)).astype(np.int64)

        for batch in batches:
            langs = batch.column("lang").to_pylist()
            by_lang: dict[str, list[str]] = {}
            for lang, text in zip(langs, texts_of(batch), strict=True):
                by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                for a, b in slices(texts):
                    pending.setdefault(lang, []).append(np.unique(grams_of(texts[a:b])[0], return_counts=True))
                    if len(pending[lang]) >= 16:
                        merge(lang)
        for lang in {*held, *pending}:
            if lang in pending:
                merge(lang)
            grams, counts = held[lang]
            for at in range(0, len(grams), 50_000):
                part = grams[at : at + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(part)), pa.array(part.view(np.int64)), pa.array(counts[at : at + 50_000])],
                    names=["lang", "gram", "n"],
                )

    rows = docs.select(F.col("lang").cast("string"), F.col("text").cast("string")).filter("lang is not null")
    return rows.mapInArrow(run, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _as_predicted_and_context(grams: DataFrame) -> DataFrame:
    """Rows (lang, size, gram, n, total, followers) of all orders: counts as predicted gram and as context."""
    zero = F.lit(0).cast("bigint")
    parts, current = [], grams
    for n in range(ORDER, 0, -1):
        parts.append(current.select("lang", F.lit(n).alias("size"), "gram", "n", zero.alias("total"), zero.alias("followers")))
        if n > 1:
            context = current.groupBy("lang", F.shiftrightunsigned("gram", 16).alias("gram")).agg(
                F.sum("n").alias("total"), F.count("*").alias("followers")
            )
            parts.append(context.select("lang", F.lit(n - 1).alias("size"), "gram", zero.alias("n"), "total", "followers"))
            current = current.groupBy("lang", F.col("gram").bitwiseAND(F.lit((1 << 16 * (n - 1)) - 1)).alias("gram")).agg(
                F.count("*").alias("n")
            )
    out = parts[0]
    for more in parts[1:]:
        out = out.union(more)
    return out


def fit(docs: DataFrame) -> LanguageModel:
    """Model of the documents' text and non-null lang. Only the languages' names reach the driver."""
    grams = stage(count_grams(docs), "grams")
    languages = sorted(r.lang for r in grams.select("lang").distinct().collect())
    names = F.array(*[F.lit(x) for x in languages]).cast("array<string>")
    value = F.struct("n", "total", "followers")
    summed = _as_predicted_and_context(grams).groupBy("size", "gram", "lang").agg(
        *[F.sum(c).alias(c) for c in ("n", "total", "followers")]
    )
    by_lang = summed.groupBy("size", "gram").agg(F.map_from_entries(F.collect_list(F.struct("lang", value))).alias("held"))

    def of(field: str) -> Column:
        return F.transform(names, lambda lang: F.coalesce(F.try_element_at("held", lang)[field], F.lit(0)))

    table = by_lang.select("size", "gram", of("n").alias("counts"), of("total").alias("totals"), of("followers").alias("followers"))
    return LanguageModel(languages, stage(table, "model"))


def _chunks(docs: DataFrame) -> DataFrame:
    """(chunk, docs, grams): rows of ``docs`` as a compressed Arrow stream, with the distinct grams of their texts."""

    def packed(chunk: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks()
        texts = [t or "" for t in rows.column("text").to_pylist()]
        grams = np.unique(np.concatenate([np.unique(grams_of(texts[a:b])[0]) for a, b in slices(texts)]))
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
            writer.write_table(rows)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([chunk], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary()),
                pa.ListArray.from_arrays(pa.array([0, len(grams)], pa.int32()), pa.array(grams.view(np.int64))),
            ],
            names=["chunk", "docs", "grams"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, held, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            start = 0
            for i, text in enumerate(texts_of(batch)):
                size += len(text) + 64  # rows without text end a chunk as well
                if size >= CHUNK_CHARS:
                    yield packed(chunk, [*held, batch.slice(start, i + 1 - start)])
                    chunk, held, size, start = chunk + 1, [], 0, i + 1
            if start < batch.num_rows:
                held.append(batch.slice(start))
        if held:
            yield packed(chunk, held)

    return docs.mapInArrow(run, "chunk bigint, docs binary, grams array<bigint>")


def cross_entropies(model: LanguageModel, docs: DataFrame) -> DataFrame:
    """``docs`` without ``text``, with ``letters`` (number) and ``entropies`` (nats per character, in the model's order).

    Columns of these names are replaced, others pass through; repeated rows are all scored; null text
    counts as empty; an empty table gives an empty one. The outcome is written to the shared folder.
    """
    docs = without(docs, "letters", "entropies")
    rest = [c for c in docs.columns if c != "text"]
    width = len(model.languages)
    chunks = stage(_chunks(docs), "chunks")
    wanted = chunks.select("chunk", F.explode("grams").alias("gram"))
    if width:
        model.prepare()
        priced = model.chances(stage(wanted.select("gram").distinct(), "wanted"))
        logs = stage(priced.select("gram", F.transform("chance", lambda p: F.log(p).cast("float")).alias("logs")), "logs")
        known = wanted.join(logs, "gram").select("chunk", "gram", "logs")
    else:
        known = wanted.limit(0).withColumn("logs", F.array().cast("array<float>"))

    def score(chunk: pa.Table, known: pa.Table) -> pa.Table:
        grams = known.column("gram").to_numpy().view(np.uint64)
        order = np.argsort(grams)
        grams = grams[order]
        logs = known.column("logs").combine_chunks().flatten().to_numpy().reshape(len(grams), width)[order]
        out = []
        for rows in chunk.column("docs"):
            rows = pa.ipc.open_stream(rows.as_buffer()).read_all()
            texts, letters, values = [t or "" for t in rows.column("text").to_pylist()], [], []
            for a, b in slices(texts):
                own, starts, found = grams_of(texts[a:b])
                letters.append(found)
                at = np.searchsorted(grams, own)
                sums = np.stack([
                    np.diff(np.concatenate([[0.0], np.cumsum(logs[at, k], dtype=np.float64)])[starts]) for k in range(width)
                ], axis=1) if width else np.zeros((b - a, 0))
                values.append(-sums / np.maximum(1, np.diff(starts))[:, None])
            offsets = np.arange(rows.num_rows + 1, dtype=np.int32) * np.int32(width)
            entropies = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(values).ravel()))
            out.append(pa.table([*(rows.column(c) for c in rest), pa.array(np.concatenate(letters)), entropies], names=[*rest, "letters", "entropies"]))
        return pa.concat_tables(out)

    schema = extended(docs.select(*[F.col(f"`{c}`") for c in rest]).schema, "letters bigint, entropies array<double>")
    texts = chunks.select(F.col("chunk").alias("of"), "docs")
    scored = []
    for part in range(ROUNDS):
        of_part, known_part = (df.filter(F.pmod(F.xxhash64(key), F.lit(ROUNDS)) == part) for df, key in ((texts, "of"), (known, "chunk")))
        scored.append(stage(of_part.groupBy("of").cogroup(known_part.groupBy("chunk")).applyInArrow(score, schema), "entropies"))
    return reduce(DataFrame.union, scored)


def identify(
    model: LanguageModel, docs: DataFrame, calibration: DataFrame | None = None, percentile: float = 0.999, sharpness: float = 20.0
) -> DataFrame:
    """``docs`` without text, with lang_pred, score and rejected as ``judge`` gives them.

    Columns named lang_pred, score, rejected, letters or entropies are replaced; other columns pass
    through, repeated rows are all kept, and an empty table gives an empty one.
    """
    return judge(model, cross_entropies(model, docs), calibration, percentile, sharpness)


def judge(
    model: LanguageModel, scored: DataFrame, calibration: DataFrame | None = None, percentile: float = 0.999, sharpness: float = 20.0
) -> DataFrame:
    """Rows of ``cross_entropies`` with lang_pred, score and rejected in place of what they were scored by.

    ``lang_pred`` is the language of lowest cross-entropy (ties: first by name), ``und`` for null texts
    and texts without a letter. ``score`` weighs the languages by the entropies' difference over
    ``sharpness`` characters, fewer for shorter texts. ``calibration`` (scored rows with ``lang``, none of
    them learned from) gives each language the cross-entropy that ``percentile`` of its own texts stay under;
    ``rejected`` is true for ``und`` and above it.
    """
    scored = without(scored, "lang_pred", "score", "rejected")
    names = F.array(*[F.lit(x) for x in model.languages]) if model.languages else F.array().cast("array<string>")
    best = F.array_position("entropies", F.array_min("entropies")).cast("int")
    known = (F.col("letters") > 0) & (F.size("entropies") > 0)
    lowest = F.array_min("entropies")
    weight = F.aggregate(
        "entropies", F.lit(0.0), lambda s, e: s + F.exp((lowest - e) * F.least(F.lit(sharpness), F.col("letters").cast("double")))
    )
    out = scored.withColumn("lang_pred", F.when(known, F.get(names, best - 1)).otherwise("und")).withColumn(
        "score", F.when(known, 1.0 / weight).otherwise(F.lit(0.0))
    )
    limits = {}
    if calibration is not None and model.languages:
        own = F.get("entropies", F.array_position(names, F.col("lang")).cast("int") - 1)
        rows = calibration.filter("letters > 0").groupBy("lang").agg(F.percentile_approx(own, percentile, 10_000).alias("limit"))
        limits = {r["lang"]: r["limit"] for r in rows.collect() if r["limit"] is not None}
    above = F.lit(False)
    for lang, limit in sorted(limits.items()):
        above = above | ((F.col("lang_pred") == lang) & (lowest > limit))
    return out.withColumn("rejected", ~known | above).drop("letters", "entropies")


def fold(doc_id: str, folds: int):
    """Fold of a document: crc32 of its id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds


def identify_held_out(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected: folds 2 to 4 of 5 train, fold 1 calibrates, fold 0 is held out."""
    folded = docs.select("doc_id", F.col("text").cast("string"), F.col("lang").cast("string"), fold("doc_id", 5).alias("fold"))
    model = fit(folded.filter("fold >= 2"))
    scored = cross_entropies(model, folded)
    return judge(model, scored, scored.filter("fold = 1 and lang is not null")).select(
        "doc_id", (F.col("fold") == 0).alias("held_out"), "lang_pred", "score", "rejected"
    )
