"""Corpus pipeline: quality, near duplicates, benchmark passages, personal data, packing.

Each stage works on what the one before kept and is written as Parquet to the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aquifold.llm.common import table
from aquifold.llm.decontaminate import remove_contaminated
from aquifold.llm.jaccard_join import keep_one_of_each
from aquifold.llm.packing import pack
from aquifold.llm.personal_data import redact
from aquifold.llm.quality import keep_good
from aquifold.session import arrow_rows, delete_folder, recorded_stages, stage


#: Intermediate tables of the last stage that ran, by application.
_HELD: dict[str, list[str]] = {}


def _clean_after(function: Callable[[SparkSession, DataFrame, str], DataFrame]):
    """Remove a stage's intermediate tables when the next stage starts, whose input has been written by then.

    An input that still reads them, because it was not written, keeps them.
    """

    @wraps(function)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        application = spark.sparkContext.applicationId
        held = _HELD.pop(application, [])
        if held:
            read = docs.inputFiles()
            for folder in held:
                if not any(folder.split("/")[-1] in file for file in read):
                    delete_folder(spark, folder)
        with recorded_stages() as folders:
            result = function(spark, docs, sf_dir)
        _HELD[application] = folders
        return result

    return run


@_clean_after
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, table(spark, sf_dir, "labels"))


@_clean_after
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_of_each(docs)


@_clean_after
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


@_clean_after
def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact(docs)


@_clean_after
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = pack(docs).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
    # Staged, for the batches are set when a plan runs; without the ids a piece is a few numbers.
    with arrow_rows(spark, 1000):
        return stage(pieces, "pieces")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: SQL cannot fit the classifiers or run the tokenizer; the stages are tested against brute force instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name.replace("_", "-"))
    return docs
