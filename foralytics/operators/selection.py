"""Halves of an ordered table, found without sorting the table or moving its rows."""

from collections.abc import Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foralytics.operators.quantiles import SIZE, Summary, compared, summary
from foralytics.scratch import discard, scratch_path, stage

# Types that order a half as they are.
PLAIN = (T.DecimalType, T.StringType)


def as_key(df: DataFrame, name: str) -> Column:
    """The column as a value that Python holds exactly and that has the same order."""
    return F.col(name) if isinstance(df.schema[name].dataType, PLAIN) else as_number(df, name)


def as_literal(df: DataFrame, name: str, value: object) -> Column:
    """A key's value as a literal of the key's type."""
    return F.lit(value).cast(df.schema[name].dataType)


def as_number(df: DataFrame, name: str) -> Column:
    """The column as a bigint of the same order: a date in days, a timestamp in microseconds."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.col(name).cast("bigint")
    if isinstance(kind, T.DateType):
        return F.unix_date(name).cast("bigint")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(name)
    if isinstance(kind, T.TimestampNTZType):
        # No time zone may come in: days, whole minutes and the seconds of the minute.
        minutes = (F.unix_date(F.col(name).cast("date")).cast("bigint") * 24 + F.hour(name)) * 60 + F.minute(name)
        return minutes * 60_000_000 + (F.extract(F.lit("SECOND"), name) * 1_000_000).cast("bigint")
    raise ValueError(f"column {name} of type {kind.simpleString()} cannot order a half: integers, decimals, texts, dates and timestamps can")


def as_value(df: DataFrame, name: str, number: object) -> Column:
    """The literal of the column's type that :func:`as_key` gave ``number`` for."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.DateType):
        return F.date_from_unix_date(F.lit(number).cast("int"))
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(F.lit(number).cast("bigint"))
    if isinstance(kind, T.TimestampNTZType):
        moment = datetime(1970, 1, 1) + timedelta(microseconds=number)
        return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(number).cast(kind)


def lower_half(df: DataFrame, order: Sequence[str], size: int = SIZE) -> DataFrame:
    """Rows at 0-based positions floor(n / 2) and up of the ordered table.

    ``order`` names non-NULL columns of integers, decimals, texts, dates or timestamps that
    together identify a row; other types are refused before any job runs. The key columns are
    scanned twice, however the values are spread: a quantile summary brackets the row at
    the cut, then the rows before the bracket are counted while those inside are written
    to a table, a few hundredths of the keys, in which the search goes on. The half
    itself is a plain filter, which reaches the file scan. A costly ``df`` should be written to a table first.
    """
    keys = df.select(*[as_key(df, name).alias(name) for name in order])
    whole = summary(keys, size)
    if whole.count == 0:
        return df
    cut, equal = row_at(keys, whole.count // 2, whole, size)
    if equal != 1:
        raise ValueError(f"columns {list(order)} do not identify a row")
    return df.where(at_or_after(order, [as_value(df, k, v) for k, v in zip(order, cut)]))


def row_at(keys: DataFrame, position: int, known: Summary | None = None, size: int = SIZE) -> tuple[tuple, int]:
    """The row at a 0-based position in the order of all columns, and how many are equal to it."""
    known = known or summary(keys, size)
    names, spark = keys.columns, keys.sparkSession
    if known.slack == 0:
        # Nothing has been thinned out: these are all rows.
        rows = [row for row, weight in zip(known.rows, known.weights) for _ in range(weight)]
        return rows[position], rows.count(rows[position])
    low, high = known.bracket(position)
    if low is not None and low == high:
        equal = reduce(Column.__and__, [F.col(n) == as_literal(keys, n, v) for n, v in zip(names, low)])
        return low, keys.where(equal).count()
    start = F.lit(True) if low is None else compared(names, [as_literal(keys, n, v) for n, v in zip(names, low)], strict=False)
    end = F.lit(False) if high is None else compared(names, [as_literal(keys, n, v) for n, v in zip(names, high)], strict=True)
    watch, path = Observation(), scratch_path(spark, "bracket")
    watched = keys.observe(watch, F.count_if(~start).alias("before"), F.count_if(start & ~end).alias("inside"))
    bracket = stage(watched.where(start & ~end), "", path)
    counted = watch.get
    try:
        if 2 * counted["inside"] > known.count:
            # Very many rows are equal: they are one side of a cut of their own.
            return _around(bracket, position - counted["before"], known.commonest(), size)
        return row_at(bracket, position - counted["before"], None, size)
    finally:
        discard(spark, path)


def _around(keys: DataFrame, position: int, row: tuple, size: int) -> tuple[tuple, int]:
    """As :func:`row_at`, by the rows before, equal to and after ``row``."""
    values = [as_literal(keys, n, v) for n, v in zip(keys.columns, row)]
    at_least, after = compared(keys.columns, values, strict=False), compared(keys.columns, values, strict=True)
    before, equal = keys.agg(F.count_if(~at_least), F.count_if(at_least & ~after)).first()
    if position < before:
        return row_at(keys.where(~at_least), position, None, size)
    if position < before + equal:
        return row, equal
    return row_at(keys.where(after), position - before - equal, None, size)


def at_or_after(order: Sequence[str], cut: Sequence[Column]) -> Column:
    """Lexicographic ``(order) >= (cut)``."""
    alternatives = []
    for i, name in enumerate(order):
        same = [F.col(p) == v for p, v in zip(order[:i], cut[:i])]
        last = i == len(order) - 1
        here = F.col(name) >= cut[i] if last else F.col(name) > cut[i]
        alternatives.append(reduce(Column.__and__, [*same, here]))
    return reduce(Column.__or__, alternatives)
