"""Mean and deviation over a bore's rows, in batches of sorted rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, StructField, StructType


def with_moments(
    df: DataFrame, of: dict[tuple[str, str], tuple[str, int, int, int]], key: str = "well_id", order: str = "reading_date"
) -> DataFrame:
    """Mean and sample deviation of a column over some rows up to the current one of its key, named by the keys of ``of``.

    ``of`` gives column, farthest and nearest row back, and the number of present values below which both are NULL.
    All rows of a key lie in one partition, as a window over it leaves them. A sliding frame updates its aggregates
    for every row in it; here a batch is added up shifted by one row at a time. The last rows of a batch are kept
    for the next one.
    """
    fields = df.schema.fields + [StructField(name, DoubleType()) for pair in of for name in pair]
    reach = max(far for _, far, _, _ in of.values())
    used = sorted({column for column, *_ in of.values()})

    def computed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail: pa.Table | None = None
        for batch in batches:
            n, here = batch.num_rows, pa.Table.from_batches([batch.select([key, *used])])
            joined = (here if tail is None else pa.concat_tables([tail, here])).combine_chunks()
            tail = joined.slice(max(0, len(joined) - reach))
            extra = len(joined) - n
            keys = joined.column(key).to_numpy()
            values = {c: joined.column(c).fill_null(0.0).to_numpy() for c in used}
            present = {c: joined.column(c).is_valid().to_numpy() for c in used}
            arrays = list(batch.columns)
            for column, far, near, enough in of.values():

                def shifted(back: int) -> tuple[slice, slice, np.ndarray]:
                    """Rows that have one so far back, that row, and whether it counts."""
                    skipped = max(0, back - extra)
                    to, of_it = slice(skipped, n), slice(extra + skipped - back, extra + n - back)
                    return to, of_it, present[column][of_it] & (keys[of_it] == keys[extra + skipped:])

                rows, total, squares = (np.zeros(n) for _ in range(3))
                steps = [shifted(back) for back in range(far, near - 1, -1) if back < extra + n]
                for to, source, counts in steps:
                    rows[to] += counts
                    total[to] += np.where(counts, values[column][source], 0.0)
                with np.errstate(divide="ignore", invalid="ignore"):
                    mean = total / rows
                    for to, source, counts in steps:
                        squares[to] += np.where(counts, (values[column][source] - mean[to]) ** 2, 0.0)
                    deviation = np.sqrt(squares / (rows - 1))
                arrays.append(pa.array(mean, mask=rows < max(1, enough), from_pandas=False))
                arrays.append(pa.array(deviation, mask=rows < max(2, enough), from_pandas=False))
            yield pa.RecordBatch.from_arrays(arrays, [f.name for f in fields])

    return df.sortWithinPartitions(key, order).mapInArrow(computed, StructType(fields))
