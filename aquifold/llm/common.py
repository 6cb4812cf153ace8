"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Texts are worked through in slices of about so many characters, so that lists of words stay small.
SLICE_CHARS = 2_000_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns an operator is about to write; other columns pass through."""
    own = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in own])


def shielded(df: DataFrame, *names: str) -> DataFrame:
    """``df`` with columns of these names renamed, so that an operator that writes them leaves their values alone."""
    own = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`").alias(f"__own_{c}" if c.lower() in own else c) for c in df.columns])


def unshielded(df: DataFrame, columns: list[str]) -> DataFrame:
    """The given columns of ``shielded`` rows under their own names again."""
    return df.select(*[F.col(f"`__own_{c}`" if f"__own_{c}" in df.columns else f"`{c}`").alias(c) for c in columns])


def extended(schema: T.StructType, ddl: str) -> T.StructType:
    return T.StructType(schema.fields + T.StructType.fromDDL(ddl).fields)


def slices(texts: list[str] | list[bytes], limit: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Index ranges of consecutive texts that hold about ``limit`` characters together."""
    start = held = 0
    for i, text in enumerate(texts):
        held += len(text)
        if held >= limit:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def append_columns(
    df: DataFrame, ddl: str, make: Callable[[], Callable[[pa.RecordBatch], list[pa.Array]]], read: list[str] | None = None
) -> DataFrame:
    """Append columns that a Python function computes batch by batch.

    ``make`` runs once per task and returns the function from a batch to the arrays
    of the ``ddl`` columns. ``read`` keeps only those columns of ``df`` first.
    """
    df = df.select(*[F.col(f"`{c}`") for c in read]) if read else df
    schema = extended(df.schema, ddl)
    kinds = [(f.name, f.dataType) for f in T.StructType.fromDDL(ddl).fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        types = [to_arrow_type(kind) for _, kind in kinds]
        work = make()
        for batch in batches:
            if not batch.num_rows:
                continue
            arrays = [
                a if isinstance(a, (pa.Array, pa.ChunkedArray)) else pa.array(a, type=t)
                for a, t in zip(work(batch), types, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *arrays], names=[*batch.schema.names, *[n for n, _ in kinds]]
            )

    return df.mapInArrow(run, schema)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch, null as the empty text."""
    return [t or "" for t in batch.column(column).to_pylist()]
