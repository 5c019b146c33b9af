"""Rows made by a function the user writes, summed up by Spark's own aggregates."""

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Rows that a task gathers before it hands them on.
HANDED_ON = 10_000

Mapper = Callable[..., Iterable[tuple]]


def map_rows(df: DataFrame, mapper: Mapper, schema: str | T.StructType, skip: tuple[type[Exception], ...] = ()) -> DataFrame:
    """The rows that ``mapper`` yields for every row of ``df``, none or many, as tuples of the schema.

    The function gets the columns as its arguments. A row for which it raises one of ``skip`` is
    passed over, with what it has not yielded yet; any other error fails the job. Rows travel in
    Arrow batches and are handed on before they pile up, however many a row makes.
    """
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    fields = to_arrow_schema(wanted)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * len(fields)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)], schema=fields)

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[tuple] = []
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                try:
                    for out in mapper(*row):
                        made.append(tuple(out))
                        if len(made) >= HANDED_ON:
                            yield batch_of(made)
                            made = []
                except skip:
                    continue
        yield batch_of(made)

    return df.mapInArrow(mapped, wanted)


def map_reduce(
    df: DataFrame, mapper: Mapper, schema: str | T.StructType, keys: list[str], *measures: Column, skip: tuple[type[Exception], ...] = ()
) -> DataFrame:
    """What ``mapper`` yields, grouped by ``keys``: one row a key with the ``measures``, built-in aggregates.

    Spark combines the measures within every task before it shuffles them, which takes the part of
    a combiner. Steps are chained: the result is a frame like any other.
    """
    return map_rows(df, mapper, schema, skip).groupBy(*keys).agg(*measures)
