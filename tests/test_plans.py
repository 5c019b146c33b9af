"""Shape of the physical plans, and results under heavily skewed keys."""

import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from foralytics.queries import QUERIES
from foralytics.plans import owners, posts as p, rankings, tags as tag_plans, trends, users as u
from helpers import final_plan, plan

SF_DIR = "/root/testdata/sf0.001"
PYTHON = "ArrowEvalPython|BatchEvalPython|MapInPandas|MapInArrow|FlatMapGroupsIn"
# Mappers written by the user, and records cut along a byte range, whose state no expression carries from line to line.
WITH_PYTHON = {"word_count_udf", "answer_counts_mapper", "posts_csv_bodies", "answer_counts_bodies", "documents_csv"}
# Global counts end in one row; everything else stays partitioned.
ONE_PARTITION = {"table_counts", "file_report"}


@contextmanager
def settings(spark, **conf):
    before = {k.replace("__", "."): spark.conf.get(k.replace("__", "."), None) for k in conf}
    for k, value in conf.items():
        spark.conf.set(k.replace("__", "."), value)
    try:
        yield
    finally:
        for k, value in before.items():
            spark.conf.unset(k) if value is None else spark.conf.set(k, value)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_shape(spark, name):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        text = plan(QUERIES[name](spark, SF_DIR))
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", text)
    if name not in WITH_PYTHON:
        assert not re.search(PYTHON, text)
    if name not in ONE_PARTITION:
        assert "SinglePartition" not in text


def test_scans_read_only_the_needed_columns(spark):
    text = plan(QUERIES["answer_counts"](spark, SF_DIR))
    assert "ReadSchema: struct<l_orderkey:bigint,l_returnflag:string>" in text
    assert "EqualTo(l_returnflag,N)" in text
    text = plan(QUERIES["tag_year_rank"](spark, SF_DIR))
    assert "In(p_brand, [Brand#1,Brand#2,Brand#3])" in text


def test_unused_tags_are_not_computed(spark):
    from foralytics.sources import star_schema

    both = star_schema.posts(spark, SF_DIR, with_tags=True, with_declared=True)
    text = plan(p.question_year(both))
    assert "Join" not in text and "lineitem" not in text


HOT = 30_000


def hot_forum(spark):
    """A third of the questions by one user, of the answers on one question, of the tags alike."""
    n = 3 * HOT
    hot = F.col("id") < HOT
    day = F.expr("timestamp_ntz'2010-01-01' + make_interval(0, 0, 0, cast(pmod(id, 600) as int))")
    questions = spark.range(n).select(
        F.col("id").alias("Id"), F.lit(1).alias("PostTypeId"), F.lit(None).cast("bigint").alias("ParentId"),
        F.when(hot, 0).otherwise(F.col("id")).alias("OwnerUserId"), day.alias("CreationDate"),
        F.lit(None).cast("bigint").alias("Score"),
        F.when(hot, "<hot><b>").otherwise(F.concat(F.lit("<t"), F.col("id") % 40, F.lit("><b>"))).alias("Tags"),
    )
    answers = spark.range(n).select(
        F.lit(None).cast("bigint").alias("Id"), F.lit(2).alias("PostTypeId"),
        F.when(hot, 0).otherwise(F.col("id")).alias("ParentId"), F.lit(None).cast("bigint").alias("OwnerUserId"),
        day.alias("CreationDate"), F.lit(1).cast("bigint").alias("Score"), F.lit(None).cast("string").alias("Tags"),
    )
    users = spark.range(n).select(
        F.col("id").alias("Id"), F.concat(F.lit("u"), F.col("id")).alias("DisplayName"), F.col("id").alias("Reputation")
    )
    return questions.unionByName(answers), users


SPLIT_SMALL = dict(
    spark__sql__autoBroadcastJoinThreshold="-1",
    spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
    spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
    spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
    spark__sql__adaptive__coalescePartitions__enabled="false",
)


def test_hot_owner_is_split_by_the_join(spark):
    posts, users = hot_forum(spark)
    with settings(spark, **SPLIT_SMALL):
        df = owners.question_owner(posts, users)
        assert "skew=true" in final_plan(df)
        assert df.count() == 3 * HOT
        assert df.where("DisplayName = 'u0'").count() == HOT


def test_hot_tag_and_year_is_split_by_the_rank_join(spark):
    posts, _ = hot_forum(spark)
    respuestas, preguntas = p.answers_score(posts), p.question_year(posts)
    with settings(spark, **SPLIT_SMALL):
        df = rankings.tag_year_rank(respuestas, preguntas, tag_plans.question_tags(posts), ["b"])
        assert "skew=true" in final_plan(df)
        assert df.count() == respuestas.count()
        assert df.where("Rango = 1").count() + df.where("Rango = 2").count() == df.count()


def test_hot_keys_give_whole_results(spark):
    posts, users = hot_forum(spark)
    respuestas, preguntas = p.answers_score(posts), p.question_year(posts)
    bridge = tag_plans.question_tags(posts)
    comments = posts.where("PostTypeId = 2").select(F.col("ParentId").alias("PostId"))
    assert respuestas.where("QuestionId = 0").first().NRespuestas == HOT
    stats = u.user_year_stats(respuestas, preguntas, users, comments)
    hot = stats.where("Usuario = 'u0'").agg(F.sum("TotalRespuestas"), F.sum("TotalComentarios")).first()
    assert tuple(hot) == (HOT, HOT)
    pairs = {(r.tag1, r.tag2): r["count"] for r in tag_plans.tag_cooccurrence(posts).collect()}
    assert pairs["b", "hot"] == HOT and sum(pairs.values()) == 3 * HOT
    activity = trends.tag_activity(posts).groupBy("tag").agg(F.sum("activity").alias("a"))
    total = {r.tag: r.a for r in activity.collect()}
    assert total["b"] == 4.5 * HOT and total["hot"] == 1.5 * HOT
    ranked = rankings.tag_year_rank(respuestas, preguntas, bridge, ["b"])
    first = ranked.where("Rango = 1").orderBy("Año").first()
    assert (first.QuestionId, first.NRespuestas) == (0, HOT)
    diff = u.user_tag_year_diff(preguntas, bridge, users)
    assert diff.where("Usuario = 'u0' AND Tag = 'hot'").agg(F.sum("NPreguntas")).first()[0] == HOT


def test_rank_never_windows_over_the_rows(spark):
    posts, _ = hot_forum(spark)
    ranked = rankings.tag_year_rank(
        p.answers_score(posts), p.question_year(posts), tag_plans.question_tags(posts), ["b"]
    )
    windows = [l for l in plan(ranked).splitlines() if "Window [" in l]
    assert len(windows) == 1
    assert "sum(_n" in windows[0]


def test_ranked_rows_are_joined_once(spark):
    posts, _ = hot_forum(spark)
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false"):
        ranked = rankings.tag_year_rank(
            p.answers_score(posts), p.question_year(posts), tag_plans.question_tags(posts), ["b"]
        )
        text = plan(ranked)
    assert "ReusedExchange" in text and text.count("SortMergeJoin") <= 5


def test_activity_reads_the_posts_twice(spark):
    posts, _ = hot_forum(spark)
    text = plan(trends.tag_activity(posts))
    assert text.count("Scan") <= 2 and text.count("Generate") == 1


def test_answers_are_counted_before_the_tag_join(spark):
    posts, _ = hot_forum(spark)
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        text = plan(trends.tag_activity(posts))
    join = text.index("SortMergeJoin")
    assert "partial_sum" in text[join:]
