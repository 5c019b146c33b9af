"""Word count."""

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foralytics.functions.text import words


def word_count(lines: DataFrame, text: str = "value") -> DataFrame:
    """Lower-cased words and how often they occur: ``word``, ``count``."""
    return (
        lines.select(F.explode(words(F.col(text))).alias("word"))
        .groupBy(F.lower("word").alias("word"))
        .agg(F.count(F.lit(1)).alias("count"))
    )


# The word pattern in the syntax of Python's own engine.
_PYTHON_WORD = re.compile(r"\b[a-zA-Z\u00c0-\uffff]+\b")


def word_count_udf(lines: DataFrame) -> DataFrame:
    """The same count with a user-written mapper; Spark sums up what it emits."""

    def emit_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = Counter()
            for text in batch.column(0).to_pylist():
                found.update(word.lower() for word in _PYTHON_WORD.findall(text or ""))
            words_and_counts = [pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())]
            yield pa.RecordBatch.from_arrays(words_and_counts, names=["word", "count"])

    emitted = lines.select("value").mapInArrow(emit_words, "word string, count bigint")
    return emitted.groupBy("word").agg(F.sum("count").alias("count"))
