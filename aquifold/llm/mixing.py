"""Mix sources to target weights: hash-random order within a source, prefix sums, cut at the budget.

Sources share a word budget by weight; a source takes at most so many repeats of its words, and
what it cannot take is shared again among the others. Every document has a random key from the
hash of its id and text. A source's budget is whole repeats of all its documents plus the first
words of its documents in key order, cut at the exact word.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from aquifold.llm.common import without
from aquifold.llm.prefix_sums import joined, starts
from aquifold.session import stage
from aquifold.sources.store import number_rows

#: Hexadecimal digits of the key per level of the prefix sums, so a window covers at most 4096 bins.
LEVEL_DIGITS = 3
#: A bin of the finest level holds about so many documents.
BIN_ROWS = 1024
_WORD = "[^\\x20\\x09-\\x0D]+"


def word_count(text: str | Column = "text") -> Column:
    """Runs of characters other than blanks and the control characters from tab to carriage return."""
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("bigint")


def cyclic_weights(docs: DataFrame, weights: list[int]) -> DataFrame:
    """(source, weight): the sources in code-point order, null last, weighted by the list over and over."""
    named = docs.select("source").distinct().select("source", F.col("source").isNull().alias("__last"))
    ranked = number_rows(named, ["__last", "source"], F.lit(0), "__rank")
    cycle = F.array(*[F.lit(w).cast("bigint") for w in weights])
    return ranked.select("source", F.element_at(cycle, (F.col("__rank") % len(weights) + 1).cast("int")).alias("weight"))


def targets(sources: DataFrame, percent: int, epochs: int) -> DataFrame:
    """Each source's ``target`` (double) and ``__budget`` (its whole words).

    ``sources`` has source, weight and source_size. The shares add up to ``percent`` of all words.
    A source whose share exceeds ``epochs`` times its size gets just that, and the rest is shared
    by weight among the others until no share is too large. Each round is one aggregate;
    comparisons are exact in whole numbers. No source or no word gives targets of 0.
    """
    sources = stage(sources, "sources")

    def exact(value: str | int) -> Column:
        return (F.col(value) if isinstance(value, str) else F.lit(Decimal(value))).cast("decimal(38,0)")

    def wide(value: str | int) -> Column:
        return (F.col(value) if isinstance(value, str) else F.lit(Decimal(value))).cast("decimal(19,0)")

    limit, over, full = exact("source_size") * epochs, F.lit(False), -1
    while True:
        size, held, weight, now = sources.agg(
            F.sum(exact("source_size")), F.sum(F.when(over, limit)), F.sum(F.when(~over, exact("weight"))),
            F.count_if(over),
        ).first()
        # What is left to share, and among how much weight, both in hundredths.
        rest, among = int(size or 0) * percent - 100 * int(held or 0), 100 * int(weight or 0) or 1
        share = wide("weight") * wide(rest)
        if now == full or not weight:
            break
        full, over = now, wide("source_size") * epochs * wide(among) < share
    return sources.select(
        "source", "source_size",
        F.when(over, limit.cast("double")).otherwise(F.col("weight") * F.lit(float(rest)) / F.lit(float(among))).alias("target"),
        F.when(over, limit.cast("bigint")).otherwise(F.call_function("div", share, wide(among))).alias("__budget"),
    )


def ordered(sized: DataFrame, rows: int, bin_rows: int = BIN_ROWS) -> DataFrame:
    """``sized`` (with source, __key, size) with ``start``: the words before each document in its source's key order.

    Keys are cut into bins by their first digits, few enough rows to a bin for one window; bins
    get their start from sums over the digits' hierarchy. ``rows`` is the table's size.
    """
    depth = 0
    while rows > bin_rows * 16 ** (LEVEL_DIGITS * depth):
        depth += 1
    levels = [f"__d{i}" for i in range(depth)]
    sized = sized.select("*", *[F.substring("__key", 1, LEVEL_DIGITS * (i + 1)).alias(n) for i, n in enumerate(levels)])
    within = ["source", *levels[-1:]]
    window = W.partitionBy(*within).orderBy("__key").rowsBetween(W.unboundedPreceding, -1)
    placed = sized.withColumn("start", F.coalesce(F.sum("size").over(window), F.lit(0)))
    if levels:
        bins = starts(sized.groupBy("source", *levels).agg(F.sum("size").alias("size")), ["source"], levels, "size")
        placed = joined(placed.withColumnRenamed("start", "__in_bin"), bins.select(*within, "start"), within)
        placed = placed.withColumn("start", F.col("start") + F.col("__in_bin")).drop("__in_bin")
    return placed.drop(*levels)


def mix(
    docs: DataFrame, weights: DataFrame, percent: int = 150, epochs: int = 2, seed: int = 0,
    bin_rows: int = BIN_ROWS, texts: bool = False,
) -> DataFrame:
    """The rows of ``docs`` with what the mix takes of them.

    Added columns: size (words), source_size, target (double), start (words of the source before
    the document in the mix's order), repeats (times it is taken whole), first_words (words taken
    from its beginning after the repeats), taken (all its words in the mix, repeats counted).
    Columns of ``docs`` with these names are replaced. ``weights`` has source and weight; sources
    without weight take nothing.

    A null text has no words, null is a source of its own, and an empty table gives no rows.
    Rows that repeat id and text in a source are interchangeable in its order. Everything
    follows from the rows and ``seed``, so that reruns agree. What is shuffled is the documents'
    other columns, sizes and keys; the texts travel only with ``texts``.
    """
    names = ["size", "source_size", "target", "start", "repeats", "first_words", "taken"]
    docs = without(docs, *names)
    identity = F.concat_ws(
        ":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.md5(F.coalesce("text", F.lit("-")))
    )
    sized = stage(docs.withColumns({"size": word_count(), "__key": F.md5(identity)}).drop(*[] if texts else ["text"]), "sized")
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("__n"))
    sources = stage(joined(sources, weights.select("source", "weight"), ["source"], "left"), "sources")
    rows = sources.agg(F.max("__n")).first()[0] or 0
    goals = targets(sources.select("source", F.coalesce("weight", F.lit(0)).alias("weight"), "source_size"), percent, epochs)
    placed = joined(ordered(sized, rows, bin_rows), goals, ["source"])
    whole = F.when(F.col("source_size") > 0, F.call_function("div", F.col("__budget"), F.col("source_size"))).otherwise(0)
    placed = placed.withColumn("repeats", whole.cast("bigint"))
    left = F.col("__budget") - F.col("repeats") * F.col("source_size") - F.col("start")
    placed = placed.withColumn("first_words", F.greatest(F.lit(0), F.least("size", left)))
    return placed.withColumn("taken", F.col("repeats") * F.col("size") + F.col("first_words")).drop("__budget", "__key")


def mixed_texts(mixed: DataFrame) -> DataFrame:
    """One row per copy in the mix: the whole texts as often as repeated, then the cut one's first words, blank-joined.

    ``mixed`` comes from ``mix`` with texts; ``copy`` counts a document's copies from 1.
    """
    words = F.slice(F.regexp_extract_all("text", F.lit(f"({_WORD})")), 1, F.col("first_words").cast("int"))
    part = F.when(F.col("first_words") == F.col("size"), F.col("text")).otherwise(F.array_join(words, " "))
    copies = F.array_repeat(F.col("text"), F.col("repeats").cast("int"))
    copies = F.when(F.col("first_words") > 0, F.concat(copies, F.array(part))).otherwise(copies)
    other = [F.col(f"`{c}`") for c in mixed.columns if c not in ("text", "copy")]
    return mixed.select(*other, F.posexplode(copies).alias("copy", "text")).withColumn("copy", F.col("copy") + 1)
