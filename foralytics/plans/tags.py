"""Counts over the tags of questions."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foralytics.functions.tags import pair_rows, parse_tags
from foralytics.functions.values import pair_text, year
from foralytics.plans.posts import questions
from foralytics.sinks.files import key_value_lines


def questions_by_year_tag(posts: DataFrame) -> DataFrame:
    """Number of questions per year and tag."""
    return (
        questions(posts)
        .where(F.col("CreationDate").isNotNull())
        .select(year(F.col("CreationDate")).alias("year"), F.explode(parse_tags(F.col("Tags"))).alias("tag"))
        .groupBy("year", "tag")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def tag_cooccurrence(posts: DataFrame, min_count: int = 1) -> DataFrame:
    """How many questions carry both tags of a pair, ``tag1 < tag2``.

    Questions with the very same tag string are counted first, so a popular
    combination is parsed and paired once, with its number of questions. With
    ``min_count``, tags on fewer questions than that are taken out before any pair is
    made, as no pair of theirs can be on more.
    """
    combinations = (
        questions(posts).where(F.col("Tags").isNotNull()).groupBy("Tags").agg(F.count(F.lit(1)).alias("n"))
    ).select("Tags", "n", parse_tags(F.col("Tags")).alias("items"))
    if min_count > 1:
        combinations = of_frequent_tags(combinations, min_count)
    counts = (
        pair_rows(combinations.select("n", "items"), F.col("items"), "tag1", "tag2")
        .groupBy("tag1", "tag2")
        .agg(F.sum("n").alias("count"))
    )
    return counts if min_count <= 1 else counts.where(F.col("count") >= min_count)


def of_frequent_tags(combinations: DataFrame, min_count: int) -> DataFrame:
    """(items, n) with only the tags of at least ``min_count`` questions, where two or more are left.

    Combinations that are alike after that are counted as one.
    """
    single = combinations.select("Tags", "n", F.explode("items").alias("tag"))
    frequent = single.groupBy("tag").agg(F.sum("n").alias("total")).where(F.col("total") >= min_count)
    # A combination has few tags, each in it once.
    kept = single.join(frequent, "tag", "left_semi").groupBy("Tags", "n").agg(F.array_sort(F.collect_list("tag")).alias("items"))
    return kept.where(F.size("items") > 1).groupBy("items").agg(F.sum("n").alias("n"))


def question_tags(posts: DataFrame) -> DataFrame:
    """Bridge of questions and tags out of the tag strings: ``Id``, ``TagName``."""
    return questions(posts).select("Id", F.explode(parse_tags(F.col("Tags"))).alias("TagName"))


def year_tag_lines(counts: DataFrame) -> DataFrame:
    """``(year,tag) <tab> count`` lines."""
    return key_value_lines(counts, pair_text(F.col("year"), F.col("tag")), F.col("count"))


def pair_lines(counts: DataFrame) -> DataFrame:
    """``tag1,tag2 <tab> count`` lines."""
    return key_value_lines(counts, F.concat_ws(",", F.coalesce("tag1", F.lit("")), F.coalesce("tag2", F.lit(""))), F.col("count"))
