"""Column expressions and helpers that several operators share."""

import ctypes
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space between words: the six ASCII characters and no others.
SPACE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
# Bytes of an Arrow batch that goes to a Python worker, a little less than the slices of most operators.
BATCH_BYTES = 7 << 19


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words, 0 for null: each word with the space behind it becomes one letter."""
    marks = F.regexp_replace(text, r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", "x")
    return F.coalesce(F.length(F.ltrim(marks, F.lit(SPACE))).cast("long"), F.lit(0).cast("long"))


def remainder_of_id(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def row_key(doc_id: Column, *others: Column) -> Column:
    """One text, never null, for a row's id and other values; a null value differs from any other."""
    return F.concat_ws(" ", *[F.coalesce(F.concat(F.lit("="), v.cast("string")), F.lit("")) for v in (doc_id, *others)])


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@contextmanager
def small_batches(spark: SparkSession, limit: int = BATCH_BYTES) -> Iterator[None]:
    """Actions inside send rows to Python workers in batches of about ``limit`` bytes; a longer row stays whole.

    Left alone, Spark sends 10,000 rows at once, which for whole texts is tens of megabytes, several times
    over in the executor's buffers and in the worker. A limit that the session has already is kept.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is not None:
        yield
        return
    spark.conf.set(key, str(limit))
    try:
        yield
    finally:
        spark.conf.unset(key)


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The batches cut so that ``column`` holds about ``limit`` bytes in each; a longer row stays whole."""
    for batch in batches:
        values = batch.column(batch.schema.get_field_index(column))
        sizes = pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)
    give_back()


def give_back() -> None:
    """Hand freed memory back to the system, as far as its allocators can.

    Python workers live on from task to task; what one task has freed would count against
    the executor's bound while another stage runs.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)
