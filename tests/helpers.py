"""Small forum tables for the tests."""

from datetime import datetime

POSTS_DDL = (
    "Id bigint, PostTypeId int, ParentId bigint, OwnerUserId bigint, "
    "CreationDate timestamp_ntz, Score bigint, Tags string, AnswerCount bigint"
)


def day(text):
    return None if text is None else datetime.fromisoformat(text)


def question(id, owner=1, created="2008-05-01", tags=None, declared=None):
    return (id, 1, None, owner, day(created), None, tags, declared)


def answer(parent, score=0, created="2008-05-01", id=None):
    return (id, 2, parent, None, day(created), score, None, None)


def posts(spark, *rows):
    return spark.createDataFrame(list(rows), POSTS_DDL)


def rows(df):
    return [tuple(r) for r in df.collect()]


def unordered(df):
    return sorted(rows(df), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return plan(df)
