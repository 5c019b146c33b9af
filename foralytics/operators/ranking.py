"""Orders, top-k lists and ranks that never put a whole group in one task."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foralytics.functions.values import bucket_of, or_zero

# Rows that one slice of a group's ids holds, about.
SLICE_ROWS = 1 << 20


def total_order(df: DataFrame, measure: str, tie_break: str) -> DataFrame:
    """All rows, largest measure first, by a parallel range-partitioned sort.

    The tie break is part of the sort key, so equal measures spread over tasks.
    """
    return df.orderBy(F.desc(measure), F.asc(tie_break))


def top_k(df: DataFrame, measure: str, tie_break: str, k: int) -> DataFrame:
    """The k first rows of the total order; each task keeps only its k best."""
    return total_order(df, measure, tie_break).limit(k)


def top_k_by_bucket(
    df: DataFrame, measure: str, tie_break: str, k: int, buckets: int
) -> DataFrame:
    """The same k rows by way of one top-k list per hash bucket of the tie break."""
    best = W.partitionBy("_bucket").orderBy(F.desc(measure), F.asc(tie_break))
    lists = (
        df.withColumn("_bucket", bucket_of(F.col(tie_break), buckets))
        .withColumn("_place", F.row_number().over(best))
        .where(F.col("_place") <= k)
    )
    return top_k(lists.drop("_bucket", "_place"), measure, tie_break, k)


def last_per_group(df: DataFrame, groups: Sequence[str], order: str, n: int) -> DataFrame:
    """The n latest rows of every group."""
    latest = W.partitionBy(*groups).orderBy(F.desc(order))
    return df.withColumn("_place", F.row_number().over(latest)).where(f"_place <= {n}").drop("_place")


def rank_in_group(
    df: DataFrame,
    groups: Sequence[str],
    measure: str,
    tie_break: str,
    ties: str = "rank",
    out: str = "rank",
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Position of each row in its group, largest measure first.

    ``ties`` is ``rank``, ``dense_rank`` or ``row_number``, as in the window
    functions of these names; ``row_number`` breaks ties by the integer
    ``tie_break``, which must be unique within a group.  The ids of a group, from
    its least to its greatest, are cut into as many slices as hold about
    ``slice_rows`` rows each, and a slice is sorted at a time.

    A window over the rows would sort a hot group in one task.  Instead the rows
    are counted per distinct measure, the window runs over these few counts, and
    the result is joined back.
    """
    if ties not in ("rank", "dense_rank", "row_number"):
        raise ValueError(f"unknown treatment of ties: {ties}")
    keys = [*groups, measure]
    order: list[Column] = [F.desc(measure)]
    if ties == "row_number":
        # Equal measures are numbered slice by slice of the group's id range.
        df = df.join(_slice_widths(df, groups, tie_break, slice_rows), [F.col(g).eqNullSafe(F.col(f"_{g}_")) for g in groups])
        place_in_range = F.col(tie_break).cast("decimal(20,0)") - F.col("_least")
        df = df.withColumn("_slice", F.call_function("div", place_in_range, F.col("_width")))
        df = df.drop("_least", "_width", *[f"_{g}_" for g in groups])
        keys.append("_slice")
        order.append(F.asc("_slice"))
    by_group = W.partitionBy(*groups).orderBy(*order)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    if ties == "dense_rank":
        place = F.row_number().over(by_group).cast("bigint")
    else:
        before = by_group.rowsBetween(W.unboundedPreceding, -1)
        place = or_zero(F.sum("_n").over(before)) + 1
    places = counts.select(*[F.col(k).alias(f"_{k}_") for k in keys], place.alias("_first"))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}_")) for k in keys]
    if ties == "row_number":
        within = W.partitionBy(*keys).orderBy(F.asc(tie_break))
        df = df.withColumn("_within", F.row_number().over(within) - 1)
        rank = F.col("_first") + F.col("_within")
    else:
        rank = F.col("_first")
    return df.join(places, same).select(
        *[c for c in df.columns if c not in ("_slice", "_within")], rank.alias(out)
    )


def _slice_widths(df: DataFrame, groups: Sequence[str], tie_break: str, slice_rows: int) -> DataFrame:
    """Least id and ids of a slice for every group; the ids' distance may not fit a bigint."""
    number = F.col(tie_break).cast("decimal(20,0)")
    spread = F.max(number) - F.min(number) + 1
    slices = F.ceil(F.count(F.lit(1)) / slice_rows).cast("decimal(20,0)")
    width = F.call_function("div", spread + slices - 1, slices).cast("decimal(20,0)")
    return df.groupBy(*[F.col(g).alias(f"_{g}_") for g in groups]).agg(
        F.min(number).alias("_least"), F.greatest(width, F.lit(1).cast("decimal(20,0)")).alias("_width")
    )
