"""Yearly reports on users."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foralytics.functions.values import or_zero


def year_order() -> list[Column]:
    """Order of the yearly report, down to single rows."""
    return [F.desc("MaxRespuestas"), F.asc("Usuario"), F.asc("Año"), F.asc("UserId")]


def tag_order() -> list[Column]:
    """Order of the report by tag, down to single rows."""
    return [F.asc("Usuario"), F.asc("Tag"), F.asc("Año"), F.asc("UserId")]


def comment_counts(comments: DataFrame) -> DataFrame:
    """Comments per post."""
    return comments.groupBy(F.col("PostId").alias("QuestionId")).agg(
        F.count(F.lit(1)).alias("NComentarios")
    )


def user_names(users: DataFrame) -> DataFrame:
    return users.select(F.col("Id").alias("UserId"), F.col("DisplayName").alias("Usuario"))


def user_year_stats(
    respuestas: DataFrame, preguntas: DataFrame, users: DataFrame, comments: DataFrame
) -> DataFrame:
    """Answered questions of each user and year, with their answers and comments.

    Comments are counted per post before the join: joined raw they would repeat
    the questions.  The names are joined to the finished groups, so a user with
    very many questions is a handful of rows by then.  ``UserId`` tells users of
    one name apart.
    """
    per_question = preguntas.join(respuestas, "QuestionId").join(
        comment_counts(comments), "QuestionId", "left"
    )
    stats = per_question.groupBy("UserId", "Año").agg(
        F.count(F.lit(1)).alias("NumPreguntas"),
        F.sum("NRespuestas").alias("TotalRespuestas"),
        F.sum(or_zero(F.col("NComentarios"))).alias("TotalComentarios"),
        F.max("NRespuestas").alias("MaxRespuestas"),
    )
    mean = F.round(F.col("TotalRespuestas") / F.col("NumPreguntas"), 2)
    return stats.join(user_names(users), "UserId").select(
        "Usuario",
        "Año",
        "NumPreguntas",
        "TotalRespuestas",
        "TotalComentarios",
        mean.alias("MediaRespuestas"),
        "MaxRespuestas",
        "UserId",
    )


def active_users(preguntas: DataFrame, minimum: int) -> DataFrame:
    """Users who asked at least ``minimum`` questions, tagged or not."""
    totals = preguntas.groupBy("UserId").agg(F.count(F.lit(1)).alias("n"))
    return totals.where(F.col("n") >= minimum).select("UserId")


def user_tag_year_diff(
    preguntas: DataFrame,
    tags: DataFrame,
    users: DataFrame,
    min_questions: int | None = None,
    calendar: bool = False,
) -> DataFrame:
    """Questions per user, tag and year, and the change to the year before.

    The year before is the previous one with questions, or with ``calendar`` the
    calendar year, absent meaning none.  A first year has change 0.
    """
    bridge = tags.select(F.col("Id").alias("QuestionId"), F.col("TagName").alias("Tag"))
    counts = (
        preguntas.select("QuestionId", "UserId", "Año")
        .join(bridge, "QuestionId")
        .groupBy("UserId", "Tag", "Año")
        .agg(F.count(F.lit(1)).alias("NPreguntas"))
    )
    by_year = W.partitionBy("UserId", "Tag").orderBy("Año")
    previous = F.lag("NPreguntas").over(by_year)
    if calendar:
        year_before = or_zero(F.sum("NPreguntas").over(by_year.rangeBetween(-1, -1)))
        previous = F.when(previous.isNotNull(), year_before)
    change = or_zero(F.col("NPreguntas") - previous)
    names = user_names(users)
    if min_questions is not None:
        # Narrowing the users leaves the questions where they are.
        names = names.join(active_users(preguntas, min_questions), "UserId", "left_semi")
    return counts.withColumn("Dif", change).join(names, "UserId").select(
        "Usuario", "Tag", "Año", "NPreguntas", "Dif", "UserId"
    )
