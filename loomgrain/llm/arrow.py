"""Applying a plain function to whole texts, one Arrow batch at a time."""

from __future__ import annotations

import contextlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


ROWS_AT_ONCE = 256
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextlib.contextmanager
def small_batches(spark: SparkSession):
    """What runs inside sends wide rows to Python a few at a time, so neither side holds thousands of texts or sets."""
    before = spark.conf.get(BATCH_ROWS)
    if not 0 < int(before) <= ROWS_AT_ONCE:
        spark.conf.set(BATCH_ROWS, str(ROWS_AT_ONCE))
    try:
        yield
    finally:
        spark.conf.set(BATCH_ROWS, before)


def map_texts(rows: DataFrame, schema: str, start: Callable[[], Callable[..., tuple]]) -> DataFrame:
    """One output row per input row: ``start()`` runs once per task and gives the function for a row's values.

    ``schema`` names the columns that the function returns. Nothing is kept
    between rows, so memory is one Arrow batch and a lost task is run again.
    """
    wanted = T.StructType.fromDDL(schema)
    names = wanted.names

    def work(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(wanted)
        each = start()
        for batch in batches:
            # a batch may hold very long texts: a few rows at a time become Python objects
            for first in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(first, ROWS_AT_ONCE)
                made = [each(*values) for values in zip(*[column.to_pylist() for column in part.columns])]
                columns = list(zip(*made))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[i], arrow.field(i).type) for i in range(len(names))], schema=arrow
                )

    return rows.mapInArrow(work, wanted)


def with_computed(rows: DataFrame, name: str, kind: T.DataType, column: str, start: Callable[[], Callable]) -> DataFrame:
    """``rows`` with one more column computed from ``column``; the others pass through as they are."""
    wanted = T.StructType([*rows.schema.fields, T.StructField(name, kind)])
    place = rows.columns.index(column)

    def work(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type

        arrow = to_arrow_type(kind)
        each = start()
        for batch in batches:
            made = []
            for first in range(0, batch.num_rows, ROWS_AT_ONCE):
                made += [each(value) for value in batch.column(place).slice(first, ROWS_AT_ONCE).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, arrow)], names=[*batch.schema.names, name])

    return rows.mapInArrow(work, wanted)
