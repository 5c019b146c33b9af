"""Monthly activity of tags and its trend.

Activity is a question or half an answer; it is held in whole half points, so
sums and differences are exact, and divided when a result is shown.
"""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foralytics.functions.tags import parse_tags
from foralytics.functions.values import fixed_decimals, month_start, trend_label, year_month
from foralytics.operators.ranking import last_per_group
from foralytics.plans.posts import questions
from foralytics.schemas import ANSWER, QUESTION
from foralytics.sinks.files import key_value_lines


def _until(events: DataFrame, as_of: str | None) -> DataFrame:
    """Dated events, up to and including the month ``as_of`` (``yyyy-MM``)."""
    if as_of is None:
        return events.where(F.col("CreationDate").isNotNull())
    end = F.add_months(F.to_date(F.lit(f"{as_of}-01")), 1)
    return events.where(F.col("CreationDate") < end)


def _half_points(posts: DataFrame, as_of: str | None) -> DataFrame:
    """``tag``, ``month`` (a date) and the activity in half points.

    Questions and answers are counted per question and month in one pass over the
    posts; these few rows take the tags of their question, split after the join.
    """
    asked = F.col("PostTypeId") == QUESTION
    question = F.when(asked, F.col("Id")).when(F.col("PostTypeId") == ANSWER, F.col("ParentId"))
    events = (
        _until(posts, as_of)
        .select(
            question.alias("QuestionId"),
            month_start(F.col("CreationDate")).alias("month"),
            F.when(asked, 2).otherwise(1).alias("half"),
        )
        .where("QuestionId IS NOT NULL")
        .groupBy("QuestionId", "month")
        .agg(F.sum("half").alias("half"))
    )
    tagged = questions(posts).select("Id", "Tags").where(F.col("Tags").isNotNull())
    return (
        events.join(tagged, F.col("QuestionId") == F.col("Id"))
        .select("month", F.explode(parse_tags(F.col("Tags"))).alias("tag"), "half")
        .groupBy("tag", "month")
        .agg(F.sum("half").alias("half"))
    )


def _half_deltas(posts: DataFrame, as_of: str | None) -> DataFrame:
    """Change to the month before that had activity; a tag has few months."""
    by_month = W.partitionBy("tag").orderBy("month")
    delta = F.col("half") - F.lag("half").over(by_month)
    return _half_points(posts, as_of).select("tag", "month", delta.alias("half")).where("half IS NOT NULL")


def tag_activity(posts: DataFrame, as_of: str | None = None) -> DataFrame:
    """``tag``, ``month``, ``activity`` = questions + answers x 0.5."""
    return _half_points(posts, as_of).select(
        "tag", year_month(F.col("month")).alias("month"), (F.col("half") / 2).alias("activity")
    )


def tag_delta(posts: DataFrame, as_of: str | None = None) -> DataFrame:
    """``tag``, ``month``, ``delta`` to the previous month of the tag."""
    return _half_deltas(posts, as_of).select(
        "tag", year_month(F.col("month")).alias("month"), (F.col("half") / 2).alias("delta")
    )


def tag_trend(posts: DataFrame, as_of: str | None = None, periods: int = 6) -> DataFrame:
    """Trend of every tag by the mean of its last deltas.

    ``as_of`` keeps a last month that is not complete out of the comparison.
    """
    recent = last_per_group(_half_deltas(posts, as_of), ["tag"], "month", periods)
    mean = F.sum("half") / (F.count(F.lit(1)) * 2)
    return (
        recent.groupBy("tag")
        .agg(mean.alias("mean"), F.count(F.lit(1)).alias("months"))
        .select(
            "tag",
            trend_label(F.col("mean")).alias("trend"),
            F.round("mean", 1).alias("mean_delta"),
            "months",
        )
        .orderBy("tag")
    )


def trend_lines(trend: DataFrame) -> DataFrame:
    """The trend table as tab-separated lines."""
    return key_value_lines(
        trend, F.col("tag"), F.col("trend"), fixed_decimals(F.col("mean_delta"), 1), F.col("months")
    )
