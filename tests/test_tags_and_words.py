import pytest
from pyspark.sql import functions as F

from foralytics.functions.tags import pair_rows, parse_tags, tag_list, tag_string
from foralytics.functions.text import words
from foralytics.functions import values as v
from foralytics.plans import tags as t
from foralytics.plans.words import word_count, word_count_udf
from helpers import posts, question, rows, unordered


@pytest.mark.parametrize(
    "text, expected",
    [
        ("<python><c#><python>", ["python", "c#"]),
        (None, None),
        ("", []),
        ("<c++>", ["c++"]),
        ("broken<", []),
        ("<.net><a-b>", [".net", "a-b"]),
    ],
)
def test_parse_tags(spark, text, expected):
    df = spark.createDataFrame([(text,)], "s string").select(parse_tags(F.col("s")))
    assert df.first()[0] == expected


def test_tag_string_is_the_inverse(spark):
    df = spark.createDataFrame([(["a", "b#"],)], "a array<string>")
    assert df.select(tag_string(F.col("a"))).first()[0] == "<a><b#>"
    assert tag_list("python, java,,c#") == ["python", "java", "c#"]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("abc123 def", ["def"]),
        ("a_b c", ["c"]),
        ("über straße", ["über", "straße"]),
        ("ñandú, l'été", ["ñandú", "l", "été"]),
        ("a\U0001f600b", ["a", "b"]),
        ("“hello” x—y", ["hello", "x—y"]),
        ("", []),
    ],
)
def test_words(spark, text, expected):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(words(F.col("s"))).first()[0] == expected


def test_word_count_both_ways(spark):
    df = spark.createDataFrame(
        [("The cat the DOG",), (None,), ("",), ("Été été 1a",), ("dog",)], "value string"
    )
    expected = [("cat", 1), ("dog", 2), ("the", 2), ("été", 2)]
    assert unordered(word_count(df)) == expected
    assert unordered(word_count_udf(df)) == expected


def test_pairs(spark):
    df = spark.createDataFrame([(1, ["b", "a", "c"]), (2, ["z"]), (3, []), (4, None)], "k int, a array<string>")
    got = unordered(pair_rows(df.drop("k"), F.col("a"), "x", "y").drop("a"))
    assert got == [("a", "b"), ("a", "c"), ("b", "c")]


def test_cooccurrence(spark):
    table = posts(
        spark, question(1, tags="<b><a>"), question(2, tags="<a><b><c>"), question(3, tags="<a>"),
        question(4), question(5, tags="<a><b><a>"), question(6, tags="<b><a>"),
    )
    assert unordered(t.tag_cooccurrence(table)) == [("a", "b", 4), ("a", "c", 1), ("b", "c", 1)]
    assert rows(t.tag_cooccurrence(table, min_count=2)) == [("a", "b", 4)]


def test_year_tag_counts_a_repeated_tag_once_and_skips_undated(spark):
    table = posts(
        spark, question(1, created="2010-01-01", tags="<a><a>"), question(2, created="2010-12-31", tags="<a><b>"),
        question(3, created=None, tags="<a>"), question(4, created="2011-01-01"),
    )
    assert unordered(t.questions_by_year_tag(table)) == [(2010, "a", 2), (2010, "b", 1)]


def test_scalar_helpers(spark):
    df = spark.createDataFrame([(" 12 ", -0.04), ("x", 0.25), (None, -8.27)], "s string, m double")
    got = df.select(
        v.fixed_decimals(F.col("m"), 1), v.trend_label(F.col("m"))
    )
    assert rows(got) == [("0.0", "DECLIVE"), ("0.3", "CRECIMIENTO"), ("-8.3", "DECLIVE")]
    buckets = spark.range(1000).select(v.bucket_of(F.col("id"), 7).alias("b")).groupBy("b").count()
    assert sorted(r.b for r in buckets.collect()) == list(range(7))
    pair = spark.createDataFrame([(39, "Daniel")], "r int, n string")
    assert pair.select(v.pair_text(F.col("r"), F.col("n"))).first()[0] == "(39,Daniel)"
    nothing = F.lit(None).cast("string")
    assert pair.select(v.pair_text(nothing, F.col("n"))).first()[0] == "(,Daniel)"
    assert pair.select(v.pair_text(F.col("r"), nothing)).first()[0] == "(39,)"


def test_rare_tags_make_no_pair(spark):
    # Two frequent tags, and on every question 30 that are on no other.
    rows = [question(i, tags="<a><b>" * (i % 4 > 0) + "".join(f"<r{i}x{k}>" for k in range(30))) for i in range(60)]
    table = posts(spark, *rows, question(100, tags="<c><a>"), question(101, tags="<c><b>"), question(102, tags="<c>"))
    assert unordered(t.tag_cooccurrence(table, 2)) == [("a", "b", 45)]
    assert unordered(t.tag_cooccurrence(table, 46)) == []
    every = {(a, b): n for a, b, n in unordered(t.tag_cooccurrence(table))}
    assert len(every) > 60 * 30 * 29 / 2 and every["a", "b"] == 45
    counted = table.where("PostTypeId = 1").groupBy("Tags").count().select("Tags", F.col("count").alias("n"), parse_tags(F.col("Tags")).alias("items"))
    # All combinations shrink to those of frequent tags, and alike ones to one.
    assert unordered(t.of_frequent_tags(counted, 3)) == [(["a", "b"], 45), (["a", "c"], 1), (["b", "c"], 1)]
    for least in (2, 3, 4, 45):
        assert unordered(t.tag_cooccurrence(table, least)) == sorted((a, b, n) for (a, b), n in every.items() if n >= least)
