import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foralytics.operators.ranking import _slice_widths, rank_in_group
from foralytics.plans import owners, posts as p, rankings, users as u
from helpers import answer, posts, question, rows, unordered


def people(spark, *names):
    return spark.createDataFrame(
        [(i + 1, n, 10.0 * i) for i, n in enumerate(names)], "Id bigint, DisplayName string, Reputation double"
    )


def bridge(spark, *pairs):
    return spark.createDataFrame(list(pairs), "Id bigint, TagName string")


def asked(spark, *triples):
    return spark.createDataFrame(list(triples), "QuestionId bigint, UserId bigint, `Año` int")


def test_yearly_stats_do_not_multiply_by_comments(spark):
    table = posts(spark, question(1), question(2), question(3), answer(1, id=50), answer(1), answer(2))
    comments = spark.createDataFrame([(1,), (1,), (1,), (50,)], "PostId bigint")
    df = u.user_year_stats(p.answers_score(table), p.question_year(table), people(spark, "Ana"), comments)
    assert df.columns == [
        "Usuario", "Año", "NumPreguntas", "TotalRespuestas", "TotalComentarios", "MediaRespuestas", "MaxRespuestas", "UserId",
    ]
    assert rows(df) == [("Ana", 2008, 2, 3, 3, 1.5, 2, 1)]


def test_same_name_is_two_users_and_ownerless_drops_out(spark):
    table = posts(
        spark, question(1, 1), question(2, 2), question(3, None), question(4, 9), *[answer(q) for q in (1, 2, 2, 3, 4)]
    )
    comments = spark.createDataFrame([], "PostId bigint")
    df = u.user_year_stats(p.answers_score(table), p.question_year(table), people(spark, "Ana", "Ana"), comments)
    assert rows(df.orderBy(*u.year_order())) == [("Ana", 2008, 1, 2, 0, 2.0, 2, 2), ("Ana", 2008, 1, 1, 0, 1.0, 1, 1)]


def test_stats_order(spark):
    table = posts(
        spark, question(1, 2, "2010-01-01"), question(2, 1, "2011-01-01"), question(3, 1, "2009-01-01"),
        *[answer(q) for q in (1, 2, 3, 3)],
    )
    comments = spark.createDataFrame([], "PostId bigint")
    df = u.user_year_stats(p.answers_score(table), p.question_year(table), people(spark, "A", "B"), comments)
    assert [(r[0], r[1]) for r in rows(df.orderBy(*u.year_order()))] == [("A", 2009), ("A", 2011), ("B", 2010)]


def test_rank_ties(spark):
    respuestas = spark.createDataFrame(
        [(1, 5, 0), (2, 5, 0), (3, 3, 0), (4, 9, 0)], "QuestionId bigint, NRespuestas bigint, ScoreTotal bigint"
    )
    preguntas = asked(spark, (1, 1, 2008), (2, 1, 2008), (3, 1, 2008), (4, 1, 2009))
    tags = bridge(spark, (1, "py"), (2, "py"), (3, "py"), (4, "py"), (1, "java"), (2, "other"))
    for ties, ranks in (("rank", [1, 1, 3]), ("dense_rank", [1, 1, 2]), ("row_number", [1, 2, 3])):
        df = rankings.tag_year_rank(respuestas, preguntas, tags, ["py", "java"], ties)
        assert df.columns == ["Tag", "Año", "QuestionId", "NRespuestas", "Rango"]
        assert rows(df.orderBy("Tag", "Año", "QuestionId")) == [
            ("java", 2008, 1, 5, 1),
            ("py", 2008, 1, 5, ranks[0]), ("py", 2008, 2, 5, ranks[1]), ("py", 2008, 3, 3, ranks[2]),
            ("py", 2009, 4, 9, 1),
        ]


def test_slices_follow_the_ids_that_occur(spark):
    """A hot group with ids spread over 2^62 has as many slices as its rows need."""
    data = [("hot", i * 2**50, 1) for i in range(4000)]
    df = spark.createDataFrame(data, "g string, id bigint, n bigint")
    widths = _slice_widths(df, ["g"], "id", 100).first()
    assert 4000 * 2**50 / int(widths["_width"]) <= 41
    ranked = rank_in_group(df, ["g"], "n", "id", "row_number", out="r", slice_rows=100)
    assert ranked.where("r <> id / power(2, 50) + 1").count() == 0


@pytest.mark.parametrize("spread", [1, 37, 2**50])
@pytest.mark.parametrize("ties", ["rank", "dense_rank", "row_number"])
def test_rank_equals_a_window_over_the_rows(spark, ties, spread):
    draw = random.Random(7)
    data = [
        (draw.choice(["hot", "hot", "a", None]), draw.choice([1, 1, None]), i * spread - 2**61, draw.choice([1, 1, 1, 2, 5]))
        for i in range(3000)
    ]
    df = spark.createDataFrame(data, "g string, y int, id bigint, n bigint").repartition(5)
    order = [F.desc("n")] + ([F.asc("id")] if ties == "row_number" else [])
    window = W.partitionBy("g", "y").orderBy(*order)
    expected = df.withColumn("r", getattr(F, ties)().over(window).cast("bigint"))
    got = rank_in_group(df, ["g", "y"], "n", "id", ties, out="r", slice_rows=100)
    assert got.columns == expected.columns
    assert unordered(got) == unordered(expected)


def test_unknown_ties(spark):
    with pytest.raises(ValueError):
        rank_in_group(spark.range(1), ["id"], "id", "id", "first")


def tag_years(spark, counts, tags=("t",)):
    """Questions of user 1: so many per year, each with all the tags."""
    triples, pairs = [], []
    for year, n in counts.items():
        for _ in range(n):
            id = len(triples) + 1
            triples.append((id, 1, year))
            pairs += [(id, tag) for tag in tags]
    return asked(spark, *triples), bridge(spark, *pairs)


def test_yearly_change_over_a_gap(spark):
    preguntas, tags = tag_years(spark, {2008: 12, 2009: 18, 2012: 5})
    names = people(spark, "Jon")
    df = u.user_tag_year_diff(preguntas, tags, names)
    assert df.columns == ["Usuario", "Tag", "Año", "NPreguntas", "Dif", "UserId"]
    assert rows(df.orderBy(*u.tag_order())) == [
        ("Jon", "t", 2008, 12, 0, 1), ("Jon", "t", 2009, 18, 6, 1), ("Jon", "t", 2012, 5, -13, 1),
    ]
    calendar = u.user_tag_year_diff(preguntas, tags, names, calendar=True)
    assert [r[4] for r in rows(calendar.orderBy(*u.tag_order()))] == [0, 6, 5]


def test_minimum_counts_questions_not_tags(spark):
    preguntas, tags = tag_years(spark, {2008: 9}, tags=("a", "b", "c"))
    names = people(spark, "Jon")
    assert rows(u.user_tag_year_diff(preguntas, tags, names, min_questions=10)) == []
    assert len(rows(u.user_tag_year_diff(preguntas, tags, names, min_questions=9))) == 3


def test_question_owner(spark):
    table = posts(spark, question(1, 1), question(2, 2), question(3, None), question(4, 1), answer(1))
    df = owners.question_owner(table, people(spark, "Ana", "Bo"))
    assert unordered(df) == [(1, 0.0, "Ana"), (2, 10.0, "Bo"), (4, 0.0, "Ana")]
    lines = owners.owner_lines(df.withColumn("Reputation", F.col("Reputation").cast("int")))
    assert unordered(lines) == [("1\t(0,Ana)",), ("2\t(10,Bo)",), ("4\t(0,Ana)",)]
