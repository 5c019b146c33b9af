"""Questions with their owner."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from foralytics.functions.values import bucket_of, pair_text
from foralytics.plans.posts import questions
from foralytics.schemas import POSTS, QUESTION, USERS
from foralytics.sinks.files import key_value_lines
from foralytics.sources.csv import POST_PREFIX, USER_PREFIX, tagged_structs

# Partitions that the questions of one owner are dealt over.
SALTS = 8


def question_owner(posts: DataFrame, users: DataFrame) -> DataFrame:
    """``QuestionId``, ``Reputation``, ``DisplayName``; ownerless questions drop out.

    A plain join: AQE broadcasts the users when they are small and otherwise
    splits the partition of an owner with very many questions.
    """
    asked = questions(posts).select(F.col("Id").alias("QuestionId"), "OwnerUserId")
    owners = users.select(F.col("Id").alias("OwnerUserId"), "Reputation", "DisplayName")
    return asked.join(owners, "OwnerUserId").select("QuestionId", "Reputation", "DisplayName")


def question_owner_tagged(
    lines: DataFrame, post_schema: T.StructType = POSTS, user_schema: T.StructType = USERS, salts: int = SALTS
) -> DataFrame:
    """The same table out of one mixed input of prefixed post and user lines, read once.

    Questions and users meet in the partition of the owner, users first, and every
    question takes the fields of the users before it. Users are sent to ``salts``
    partitions each and the questions of an owner are dealt over them by their id, so an
    owner with very many questions is no single task. As in a join, a question whose
    owner occurs twice comes out twice.
    """
    both = tagged_structs(lines, post=(POST_PREFIX, post_schema), user=(USER_PREFIX, user_schema))
    is_user = F.col("user.Id").isNotNull()
    asked = (F.col("post.PostTypeId") == QUESTION) & F.col("post.OwnerUserId").isNotNull()
    everywhere = F.sequence(F.lit(0), F.lit(salts - 1))
    met = both.where(is_user | asked).select(
        F.coalesce("user.Id", "post.OwnerUserId").alias("owner"),
        is_user.alias("is_user"),
        F.col("post.Id").alias("QuestionId"),
        F.when(is_user, F.struct("user.Reputation", "user.DisplayName")).alias("fields"),
        F.explode(F.when(is_user, everywhere).otherwise(F.array(bucket_of(F.col("post.Id"), salts)))).alias("salt"),
    )
    before = Window.partitionBy("owner", "salt").orderBy(F.desc("is_user")).rowsBetween(Window.unboundedPreceding, 0)
    owned = met.withColumn("users", F.collect_list("fields").over(before)).where(~F.col("is_user"))
    return owned.select("QuestionId", F.inline("users"))


def owner_lines(owned: DataFrame) -> DataFrame:
    """``question <tab> (reputation,name)`` lines."""
    return key_value_lines(owned, F.col("QuestionId"), pair_text(F.col("Reputation"), F.col("DisplayName")))
