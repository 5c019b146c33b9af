"""Questions of chosen tags, ranked by their answers."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foralytics.operators.ranking import rank_in_group


def tag_year_rank(
    respuestas: DataFrame,
    preguntas: DataFrame,
    tags: DataFrame,
    wanted: Sequence[str],
    ties: str = "rank",
) -> DataFrame:
    """Rank of each question within its tag and year, most answers first."""
    bridge = tags.where(F.col("TagName").isin(list(wanted))).select(
        F.col("Id").alias("QuestionId"), F.col("TagName").alias("Tag")
    )
    rows = (
        bridge.join(preguntas.select("QuestionId", "Año"), "QuestionId")
        .join(respuestas.select("QuestionId", "NRespuestas"), "QuestionId")
        .select("Tag", "Año", "QuestionId", "NRespuestas")
    )
    # Ranking reads the rows more than once; from this exchange on they are shared.
    # A question has few tags, so its key is never hot.
    rows = rows.repartition("QuestionId", "Tag")
    return rank_in_group(rows, ["Tag", "Año"], "NRespuestas", "QuestionId", ties, out="Rango")
