"""Running per-text work inside Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Texts handed to the work function at a time, so that batches of long texts stay small.
SLICE = 512


def per_text(df: DataFrame, keep: Sequence[tuple[str, str]], text_col: str, fields: str, start: Callable[[], Callable]) -> DataFrame:
    """Run work over the texts of df, carrying other columns along unread.

    keep: (column, its name in the result) of what is carried along.  fields:
    DDL of the columns that work makes.  start() is called once in each task
    and returns work(texts) -> (index, columns): for each result row the
    position of its text, or None for one row a text in order, and a list
    of values for each field.
    """
    made = StructType.fromDDL(fields)
    kept = df.select(*(F.col(a).alias(b) for a, b in keep)).schema
    arrow = to_arrow_schema(StructType(kept.fields + made.fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                index, columns = work(batch.column(batch.num_columns - 1).to_pylist())
                rows = [batch.column(i) for i in range(batch.num_columns - 1)]
                if index is not None:
                    rows = [c.take(pa.array(index, pa.int64())) for c in rows]
                fresh = [pa.array(c, f.type) for c, f in zip(columns, list(arrow)[len(rows):], strict=True)]
                yield pa.RecordBatch.from_arrays([*(c.cast(f.type) for c, f in zip(rows, arrow, strict=False)), *fresh], schema=arrow)

    source = df.select(*(F.col(a).alias(b) for a, b in keep), F.col(text_col).alias("_text"))
    return source.mapInArrow(run, StructType(kept.fields + made.fields))
