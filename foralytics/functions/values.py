"""Small scalar helpers shared by the analyses."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The labels of a technology trend.
GROWTH = "CRECIMIENTO"
DECLINE = "DECLIVE"
STABLE = "ESTABLE"


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def year(ts: Column) -> Column:
    return F.year(ts)


def month_start(ts: Column) -> Column:
    """First day of the month, as a date that orders and groups cheaply."""
    return F.trunc(ts, "month")


def year_month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def trend_label(mean: Column) -> Column:
    """Label by the sign of the unrounded mean."""
    return F.when(mean > 0, GROWTH).when(mean < 0, DECLINE).otherwise(STABLE)


def fixed_decimals(value: Column, digits: int) -> Column:
    """Text with a fixed number of decimals, signed only when negative.

    Rounding first avoids the text ``-0.0``.
    """
    return F.format_string(f"%.{digits}f", F.round(value, digits))


def bucket_of(key: Column, buckets: int) -> Column:
    """Hash bucket of a key, 0 to ``buckets - 1``."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def pair_text(*parts: Column) -> Column:
    """Composite key or value as text: ``(a,b)``; a NULL part is empty and keeps its comma."""
    texts = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.concat(F.lit("("), F.concat_ws(",", *texts), F.lit(")"))
