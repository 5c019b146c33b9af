"""CSV records that go on over line ends inside quotes, cut in parallel.

A file is read in the byte ranges that Spark gives its tasks. Whether a range begins
inside quotes depends on all quotes before it, so two passes are made: the first
counts the quotes of every range, and sums of their parity along the file tell how
each range begins; in the second, every task cuts its ranges at the line ends that lie outside
quotes. What a range holds of a record that began or ends elsewhere are pieces, at
most two a range; only these are shuffled and joined up. No task reads a file as a whole.

Lines end in a newline, with or without a carriage return before it, which inside quotes
is kept. Quotes inside a field are doubled, and a field with a quote is quoted; with other uses
of quotes their parity says nothing. A quote that is never closed reaches to the end of its file.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from foralytics.scratch import stage

# Ranges whose beginnings are broadcast, 16 bytes each; more are joined by shuffle.
BROADCAST_RANGES = 200_000
# A whole record, the end of one that began before the range, its beginning, or a range inside it.
WHOLE, END, BEGIN, MIDDLE = range(4)


def raw_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file, start, key, value): lines without their newline, in order within the range of (file, start)."""
    lines = spark.read.option("lineSep", "\n").text(paths)
    at = (F.col("_metadata.file_path"), F.col("_metadata.file_block_start"))
    return lines.select(at[0].alias("file"), at[1].alias("start"), F.xxhash64(*at).alias("key"), "value")


def quote_count(value: str = "value") -> Column:
    return F.length(value) - F.length(F.replace(F.col(value), F.lit('"'), F.lit("")))


def range_starts(lines: DataFrame) -> DataFrame:
    """(file, start, key, inside, open) of every range: whether it begins, and ends, inside quotes."""
    ranges = lines.groupBy("file", "start", "key").agg((F.sum(quote_count()) % 2).alias("odd"))
    along = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    quotes = F.sum("odd").over(along)
    return ranges.select("file", "start", "key", ((quotes - F.col("odd")) % 2 == 1).alias("inside"), (quotes % 2 == 1).alias("open"))


def _cut(pieces: bool):
    """Whole records of (key, inside, value) lines, or with ``pieces`` the parts of the others."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, within, begun, held = None, False, False, []
        for batch in batches:
            if not batch.num_rows:
                continue
            found: list[tuple[int, str, int]] = []
            keys = batch.column(0).to_numpy()
            inside = batch.column(1).to_numpy(zero_copy_only=False)
            values = batch.column(2)
            odd = pc.count_substring(values, '"').to_numpy() % 2 == 1
            texts = values.to_pylist()
            edges = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])).tolist() + [len(keys)]
            for a, b in zip(edges, edges[1:]):
                if keys[a] != key:
                    if held:
                        found.append((BEGIN if begun else MIDDLE, "\n".join(held), key))
                    key, within, begun, held = int(keys[a]), bool(inside[a]), not inside[a], []
                # The state behind every line; records end where it is outside quotes.
                after = (np.cumsum(odd[a:b]) + within) % 2 == 1
                last = a
                for end in (np.flatnonzero(~after) + a + 1).tolist():
                    if held or not begun:
                        found.append((WHOLE if begun else END, "\n".join(held + texts[last:end]), key))
                        held, begun = [], True
                    else:
                        found.append((WHOLE, texts[last] if end == last + 1 else "\n".join(texts[last:end]), key))
                    last = end
                held += texts[last:b]
                within = bool(after[-1])
            yield _batch(found, pieces)
        if held:
            yield _batch([(BEGIN if begun else MIDDLE, "\n".join(held), key)], pieces)

    return cut


def _batch(found: list[tuple[int, str, int]], pieces: bool) -> pa.RecordBatch:
    kept = [row for row in found if (row[0] != WHOLE) == pieces]
    if not pieces:
        return pa.RecordBatch.from_arrays([pa.array([r[1] for r in kept], pa.string())], names=["value"])
    columns = [pa.array([r[k] for r in kept], kind) for k, kind in enumerate((pa.int32(), pa.string(), pa.int64()))]
    return pa.RecordBatch.from_arrays(columns, names=["kind", "value", "key"])


def _with_starts(lines: DataFrame, starts: DataFrame, broadcast_ranges: int) -> DataFrame:
    """Lines of (key, inside, value), still in the order of their range."""
    known = starts.select("key", F.col("inside").alias("known"))
    # A range that the first pass has not seen means that the files have changed or been cut anew.
    inside = F.coalesce("known", F.raise_error(F.lit("the files are not cut as they were counted")).cast("boolean")).alias("inside")
    if starts.count() <= broadcast_ranges:
        return lines.select("key", "value").join(F.broadcast(known), "key", "left").select("key", inside, "value")
    numbered = lines.select("key", "value", F.monotonically_increasing_id().alias("at"))
    return numbered.join(known, "key", "left").sortWithinPartitions("key", "at").select("key", inside, "value")


def read_records(spark: SparkSession, paths: str | list[str], broadcast_ranges: int = BROADCAST_RANGES) -> DataFrame:
    """(value): the records of the files as texts; blank lines outside quotes are no records.

    The quotes are counted at once, and the files are read when the result is used: once, or
    where a record crosses ranges a second time for the pieces.
    """
    lines = raw_lines(spark, paths)
    starts = stage(range_starts(lines), "ranges")
    if not starts.groupBy("key").count().where("count > 1").isEmpty():
        raise ValueError("two ranges of files share a hash")
    if starts.where("open").isEmpty():
        # No record leaves its range.
        known = lines.select("key", F.lit(False).alias("inside"), "value")
        return _clean(known.mapInArrow(_cut(False), "value string"))
    known = _with_starts(lines, starts, broadcast_ranges)
    pieces = known.mapInArrow(_cut(True), "kind int, value string, key long")
    along = Window.partitionBy("file").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    number = F.sum((F.col("kind") == BEGIN).cast("int")).over(along)
    numbered = pieces.join(starts.select("key", "file", "start"), "key").withColumn("number", number)
    parts = F.array_sort(F.collect_list(F.struct("start", "kind", "value")))
    joined = numbered.groupBy("file", "number").agg(F.array_join(F.transform(parts, lambda p: p["value"]), "\n").alias("value"))
    return _clean(known.mapInArrow(_cut(False), "value string").unionAll(joined.select("value")))


def _clean(records: DataFrame) -> DataFrame:
    return records.select(F.rtrim("value", F.lit("\r")).alias("value")).where(F.length(F.trim("value")) > 0)
