"""The star-schema tables read as forum tables.

An order is a question, a line item flagged N an answer to its order, one
flagged R a comment on it; the brands of an order are its tags and customers
are users.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foralytics.functions.tags import tag_string
from foralytics.schemas import ANSWER, QUESTION


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("Id"),
        F.lit(QUESTION).alias("PostTypeId"),
        F.lit(None).cast("bigint").alias("ParentId"),
        F.col("o_custkey").alias("OwnerUserId"),
        F.col("o_orderdate").alias("CreationDate"),
        F.lit(None).cast("bigint").alias("Score"),
    )


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "N")
    return lines.select(
        F.lit(None).cast("bigint").alias("Id"),
        F.lit(ANSWER).alias("PostTypeId"),
        F.col("l_orderkey").alias("ParentId"),
        F.lit(None).cast("bigint").alias("OwnerUserId"),
        F.col("l_shipdate").alias("CreationDate"),
        F.col("l_quantity").cast("bigint").alias("Score"),
    )


def _brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bridge of questions and tags, one row per pair."""
    return (
        _brands(spark, sf_dir)
        .select(F.col("l_orderkey").alias("Id"), F.col("p_brand").alias("TagName"))
        .distinct()
    )


def posts(
    spark: SparkSession, sf_dir: str, with_tags: bool = False, with_declared: bool = False
) -> DataFrame:
    """Questions and answers in one table; tags and declared counts on demand."""
    asked = questions(spark, sf_dir)
    if with_tags:
        # An order has at most as many tags as there are brands.
        strings = _brands(spark, sf_dir).groupBy("l_orderkey").agg(
            tag_string(F.array_sort(F.collect_set("p_brand"))).alias("Tags")
        )
        asked = asked.join(strings, F.col("Id") == F.col("l_orderkey"), "left").drop("l_orderkey")
    if with_declared:
        declared = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
            F.count(F.lit(1)).alias("AnswerCount")
        )
        asked = asked.join(declared, F.col("Id") == F.col("l_orderkey"), "left").drop("l_orderkey")
    return asked.unionByName(answers(spark, sf_dir), allowMissingColumns=True)


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "R")
    return lines.select(F.col("l_orderkey").alias("PostId"))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("Id"),
        F.col("c_name").alias("DisplayName"),
        F.col("c_acctbal").alias("Reputation"),
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("text").alias("value"))
