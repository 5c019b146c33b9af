"""Mergeable quantile summaries of rows in the order of any columns.

A summary holds some rows of the table, each standing for a power of two of them. When a
level has too many, they are sorted and every second one moves up, standing for twice as
many. That shifts the rank of any row by at most what one of them stood for, so the sum of
these shifts, the slack, bounds the error of every rank, whatever the values are.
Summaries of parts are merged level by level; slacks add up.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows of a level from which on it is thinned out are twice as many; a summary that is handed on has four times as many.
SIZE = 2048


class Levels:
    """Rows by what they stand for: level l for 2 ** l rows each."""

    def __init__(self, size: int) -> None:
        self.size, self.slack = size, 0
        self.rows: dict[int, pa.Table] = {}
        self.odd: dict[int, int] = {}

    def add(self, rows: pa.Table, level: int) -> None:
        self.rows[level] = pa.concat_tables([self.rows[level], rows]) if level in self.rows else rows
        if self.rows[level].num_rows >= 2 * self.size:
            self.thin(level)

    def thin(self, level: int) -> None:
        rows = self.rows[level].sort_by([(name, "ascending") for name in self.rows[level].column_names])
        even = rows.num_rows - rows.num_rows % 2
        # First and second ones in turn, so that shifts cancel out.
        first = self.odd[level] = 1 - self.odd.get(level, 1)
        self.slack += 1 << level
        self.rows[level] = rows.slice(even)
        self.add(rows.take(pa.array(np.arange(first, even, 2))), level + 1)

    def shrink(self) -> None:
        """Thin out the lowest levels until few enough rows are left to be handed on."""
        while sum(rows.num_rows for rows in self.rows.values()) > 4 * self.size:
            self.thin(min(level for level, rows in self.rows.items() if rows.num_rows > 1))

    def batches(self) -> Iterator[pa.RecordBatch]:
        slack = self.slack
        for level, rows in self.rows.items():
            if rows.num_rows:
                weights = pa.array(np.full(rows.num_rows, 1 << level, np.int64))
                slacks = np.zeros(rows.num_rows, np.int64)
                slacks[0], slack = slack, 0
                table = rows.append_column("weight", weights).append_column("slack", pa.array(slacks))
                yield from table.combine_chunks().to_batches()


def _summarise(size: int):
    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = Levels(size)
        for batch in batches:
            levels.add(pa.Table.from_batches([batch]), 0)
        levels.shrink()
        yield from levels.batches()

    return summarise


def _merge(size: int):
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = Levels(size)
        for batch in batches:
            table = pa.Table.from_batches([batch])
            weights, keys = table.column("weight").to_numpy(), table.drop_columns(["weight", "slack"])
            levels.slack += int(table.column("slack").to_numpy().sum())
            for weight in np.unique(weights).tolist():
                levels.add(keys.take(pa.array(np.flatnonzero(weights == weight))), weight.bit_length() - 1)
        levels.shrink()
        yield from levels.batches()

    return merge


@dataclass
class Summary:
    """Rows of a table in order, with what each stands for; any rank read off is at most ``slack`` off."""

    rows: list[tuple]
    weights: list[int]
    slack: int

    @property
    def count(self) -> int:
        return sum(self.weights)

    def bracket(self, position: int) -> tuple[tuple | None, tuple | None]:
        """Rows that the one at a 0-based position is surely not before, and not after; None is no bound."""
        low = high = None
        before = 0
        for row, weight in zip(self.rows, self.weights):
            if before + self.slack <= position:
                low = row
            before += weight
            if before - self.slack > position:
                high = row
                break
        return low, high

    def commonest(self) -> tuple:
        """The row that most are equal to, as far as can be told."""
        total: dict[tuple, int] = {}
        for row, weight in zip(self.rows, self.weights):
            total[row] = total.get(row, 0) + weight
        return max(total, key=total.__getitem__)


def summary(keys: DataFrame, size: int = SIZE) -> Summary:
    """Summary of the rows of ``keys`` in the order of all their columns, none of which may hold a NULL.

    One scan; every task hands on at most four times ``size`` rows, which are merged in
    two steps, so the driver gets as many.
    """
    schema = T.StructType([*keys.schema.fields, T.StructField("weight", T.LongType()), T.StructField("slack", T.LongType())])
    watch = Observation()
    empty = F.lit(False)
    for name in keys.columns:
        empty |= F.col(name).isNull()
    parts = keys.observe(watch, F.count_if(empty).alias("empty")).mapInArrow(_summarise(size), schema)
    steps = isqrt(int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions")) - 1) + 1
    merged = parts.repartition(steps).mapInArrow(_merge(size), schema).repartition(1).mapInArrow(_merge(size), schema)
    found = merged.sortWithinPartitions(*keys.columns, "weight").collect()
    if watch.get["empty"]:
        raise ValueError(f"one of the columns {keys.columns} holds NULLs")
    k = len(keys.columns)
    return Summary([tuple(r)[:k] for r in found], [r["weight"] for r in found], sum(r["slack"] for r in found))


def compared(names: list[str], values: list[Column], strict: bool) -> Column:
    """Whether a row is after ``values`` in the order of its columns, or unless ``strict`` equal to them."""
    after = F.col(names[-1]) > values[-1] if strict else F.col(names[-1]) >= values[-1]
    for name, value in zip(names[-2::-1], values[-2::-1]):
        after = (F.col(name) > value) | ((F.col(name) == value) & after)
    return after
