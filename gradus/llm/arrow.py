"""Row batches through Python workers, as Arrow."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Bytes of text worked on at once inside a task; one longer text is a piece of its own.
PIECE_BYTES = 1 << 20
#: Bytes of a batch that is computed and given back at once, if it has several rows.
BATCH_BYTES = 4 << 20


def extend(
    df: DataFrame, fields: str, compute: Callable[[pa.RecordBatch], list[Iterable]], forget: Callable[[], None] | None = None
) -> DataFrame:
    """``df`` plus the columns ``fields`` that ``compute`` makes of each batch, a list each.

    Workers serve one task after the other, of this stage and of others: ``forget`` gives
    back, at the end of a task, what ``compute`` has remembered.
    """
    added = T._parse_datatype_string(fields)
    schema = T.StructType(list(df.schema.fields) + list(added.fields))
    types = [field.type for field in to_arrow_schema(added)]
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for whole in batches:
                rows = max(1, whole.num_rows * BATCH_BYTES // max(whole.nbytes, 1))
                for start in range(0, whole.num_rows, rows):
                    batch = whole.slice(start, rows)
                    made = [
                        v if isinstance(v, pa.Array) else pa.array(v, type=t)
                        for v, t in zip(compute(batch), types, strict=True)
                    ]
                    yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=names)
        finally:
            if forget:
                forget()
                pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def texts(batch: pa.RecordBatch, column: str) -> list[str]:
    """The column's values, NULL as an empty text."""
    return [value or "" for value in batch.column(column).to_pylist()]


def pieces(values: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of ``values`` of about PIECE_BYTES, at least one value each."""
    start, size = 0, 0
    for i, value in enumerate(values):
        if size and size + len(value) > PIECE_BYTES:
            yield start, i
            start, size = i, 0
        size += len(value) + 1
    if start < len(values):
        yield start, len(values)
