"""Questions, answers, and the two tables the reports start from."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foralytics.functions.values import or_zero, year
from foralytics.operators.ranking import top_k, top_k_by_bucket, total_order
from foralytics.schemas import ANSWER, QUESTION


def _asked() -> Column:
    return F.col("PostTypeId") == QUESTION


def _answered() -> Column:
    return F.col("PostTypeId") == ANSWER


def questions(posts: DataFrame) -> DataFrame:
    return posts.where(_asked())


def answers(posts: DataFrame) -> DataFrame:
    """Answers that name their question."""
    return posts.where(_answered() & F.col("ParentId").isNotNull())


def answer_counts(posts: DataFrame) -> DataFrame:
    """Answers per question, also of questions that are not in the table."""
    return (
        answers(posts)
        .groupBy(F.col("ParentId").alias("QuestionId"))
        .agg(F.count(F.lit(1)).alias("AnswerCount"))
    )


def answer_counts_ordered(posts: DataFrame) -> DataFrame:
    return total_order(answer_counts(posts), "AnswerCount", "QuestionId")


def answer_counts_topk(posts: DataFrame, k: int = 20) -> DataFrame:
    return top_k(answer_counts(posts), "AnswerCount", "QuestionId", k)


def answer_counts_topk_buckets(posts: DataFrame, k: int = 20, buckets: int = 100) -> DataFrame:
    return top_k_by_bucket(answer_counts(posts), "AnswerCount", "QuestionId", k, buckets)


def _by_question(posts: DataFrame, *measures: Column) -> DataFrame:
    """One row per question id, asked or only answered, in one scan and shuffle.

    A question and its answers share the key, so whether it exists and what its
    answers amount to come out of the same map-side combined aggregation, where
    a join would scan the posts twice and sort both sides.
    """
    key = F.when(_asked(), F.col("Id")).when(_answered(), F.col("ParentId"))
    return (
        posts.where(F.col("PostTypeId").isin(QUESTION, ANSWER) & key.isNotNull())
        .groupBy(key.alias("QuestionId"))
        .agg(F.max(_asked()).alias("exists"), F.count(F.when(_answered(), 1)).alias("n"), *measures)
    )


def answers_score(posts: DataFrame, include_unanswered: bool = False) -> DataFrame:
    """Answers and their summed score for every existing, answered question."""
    scored = _by_question(posts, F.sum(F.when(_answered(), F.col("Score"))).alias("score")).where("exists")
    total = F.col("score")
    if include_unanswered:
        total = F.when(F.col("n") == 0, 0).otherwise(total)
    else:
        scored = scored.where("n > 0")
    return scored.select("QuestionId", F.col("n").alias("NRespuestas"), total.alias("ScoreTotal"))


def question_year(posts: DataFrame) -> DataFrame:
    """Owner and year of every question."""
    return questions(posts).select(
        F.col("Id").alias("QuestionId"),
        F.col("OwnerUserId").alias("UserId"),
        year(F.col("CreationDate")).alias("Año"),
    )


def answered_questions(posts: DataFrame) -> DataFrame:
    """The questions, with all their columns, that have an answer."""
    return questions(posts).join(
        answer_counts(posts).select(F.col("QuestionId").alias("Id")), "Id", "left_semi"
    )


def answer_audit(posts: DataFrame) -> DataFrame:
    """Answered questions whose declared number of answers is wrong."""
    declared = F.max(F.when(_asked(), F.col("AnswerCount"))).cast("bigint")
    return (
        _by_question(posts, or_zero(declared).alias("declared"))
        .where("exists AND n > 0 AND declared != n")
        .select("QuestionId", "declared", F.col("n").alias("actual"))
    )
