"""Tags of a question, held as ``<a><b>`` in one string."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: one tag inside the string.
TAG_PATTERN = "<([^<>]+)>"


def parse_tags(tags: Column) -> Column:
    """Distinct tags as an array; NULL stays NULL, which ``explode`` drops."""
    return F.array_distinct(F.regexp_extract_all(tags, F.lit(TAG_PATTERN), F.lit(1)))


def tag_string(tags: Column) -> Column:
    """Inverse of :func:`parse_tags`: ``[a, b]`` becomes ``<a><b>``."""
    return F.concat(F.lit("<"), F.array_join(tags, "><"), F.lit(">"))


def tag_list(argument: str) -> list[str]:
    """Tags of a comma-separated command-line argument."""
    return [t.strip() for t in argument.split(",") if t.strip()]


def pair_rows(df: DataFrame, items: Column, first: str, second: str) -> DataFrame:
    """``df`` repeated for each unordered pair of the distinct items of its rows.

    ``first < second`` holds, so (a, b) and (b, a) are the same pair.  The pairs
    are streamed by two generators; no array of all pairs is ever built.
    """
    kept = df.columns
    heads = df.select(*kept, F.sort_array(items).alias("_items")).select(
        *kept, "_items", F.posexplode("_items").alias("_at", first)
    )
    rest = F.slice("_items", F.col("_at") + 2, F.size("_items"))
    return heads.select(*kept, first, F.explode(rest).alias(second))
