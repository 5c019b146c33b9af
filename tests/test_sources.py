import bz2

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foralytics.plans import owners, posts as p, words
from foralytics.schemas import COMMENTS, POSTS, PREGUNTAS, TAGS, check_schema
from foralytics.sources import csv, parquet, text
from helpers import unordered

SMALL = T.StructType(
    [
        T.StructField("Id", T.LongType()),
        T.StructField("Body", T.StringType()),
        T.StructField("Tags", T.StringType()),
        T.StructField("Score", T.LongType()),
    ]
)
HEADER = "Id,Body,Tags,Score\n"


@pytest.fixture
def dump(tmp_path):
    def write(name, content):
        (tmp_path / name).write_text(content, encoding="utf8")
        return str(tmp_path / name)

    return write


def test_text_glob_and_bzip2(spark, tmp_path):
    (tmp_path / "p1.txt").write_text("one\ntwo\n")
    (tmp_path / "p2.txt").write_text("two\n")
    (tmp_path / "q.txt").write_text("skipped\n")
    (tmp_path / "p3.txt.bz2").write_bytes(bz2.compress(b"two\nthree\n" * 50))
    lines = text.read_lines(spark, f"file:{tmp_path}/p*")
    assert unordered(words.word_count(lines)) == [("one", 1), ("three", 50), ("two", 52)]
    names = text.read_lines(spark, f"{tmp_path}/p1.txt", f"{tmp_path}/q.txt", with_file=True)
    got = {(r.file.rsplit("/", 1)[1], r.value) for r in names.collect()}
    assert got == {("p1.txt", "one"), ("p1.txt", "two"), ("q.txt", "skipped")}


def test_csv_dialect(spark, dump):
    path = dump("d.csv", HEADER + '1,"say ""hi"", ok", <a><b> ,3\n2,plain,,\n')
    df = csv.read_csv_table(spark, path, SMALL)
    assert unordered(df) == [(1, 'say "hi", ok', "<a><b>", 3), (2, "plain", None, None)]


def test_csv_without_header_keeps_the_first_row(spark, dump):
    assert csv.read_csv_table(spark, dump("d.csv", "7,x,<a>,1\n"), SMALL).count() == 1


def test_csv_newline_in_a_field(spark, dump):
    path = dump("d.csv", HEADER + '1,"two\nlines",<a>,3\n2,b,<c>,4\n')
    df = csv.read_csv_table(spark, path, SMALL, multi_line=True)
    assert unordered(df) == [(1, "two\nlines", "<a>", 3), (2, "b", "<c>", 4)]


def test_csv_bad_rows(spark, dump):
    path = dump("d.csv", HEADER + "1,a,<a>,3\n2,short\nx,bad id,<a>,3\n4,bad score,<a>,many\n")
    default = csv.read_csv_table(spark, path, SMALL)
    assert sorted(r.Id for r in default.collect()) == [1, 2, 4]
    scored = csv.read_csv_table(spark, path, SMALL, required=["Id", "Score"])
    assert [r.Id for r in scored.collect()] == [1]
    strict = csv.read_csv_table(spark, path, SMALL, strict=True)
    assert [r.Id for r in strict.collect()] == [1]
    assert [r.Id for r in strict.select("Id").collect()] == [1]
    assert strict.count() == 1
    both = csv.read_csv_table(spark, path, SMALL, strict=True, multi_line=True)
    assert [r.Id for r in both.collect()] == [1]


def test_csv_line_mode_never_loses_a_record(spark, dump):
    path = dump("d.csv", HEADER + '1,a,<a>,3\n2,"two\nlines",<a>,3\n')
    with pytest.raises(Exception, match="--multi-line"):
        csv.read_csv_table(spark, path, SMALL).collect()
    assert csv.read_csv_table(spark, path, SMALL, multi_line=True).count() == 2


def test_csv_header_goes_whatever_the_types(spark, tmp_path):
    table = spark.createDataFrame([("a", "b"), ("c", None)], "k string, v string").repartition(2)
    path = str(tmp_path / "t")
    csv.write_csv_table(table, path)
    for multi_line in (False, True):
        got = csv.read_csv_table(spark, path, table.schema, ["k"], multi_line=multi_line)
        assert unordered(got) == [("a", "b"), ("c", None)]
        kept = csv.read_csv_table(spark, path, table.schema, ["k"], multi_line=multi_line, header=False)
        assert kept.count() == 4


def post_line(**fields):
    return ",".join(str(fields.get(n, "")) for n in POSTS.names)


def test_posts_dump(spark, dump):
    path = dump(
        "Posts.csv",
        "\n".join(
            [
                ",".join(POSTS.names),
                post_line(Id=1, PostTypeId=1, OwnerUserId=5, CreationDate="2015-10-29T15:56:52.933", Tags="<c#>"),
                post_line(Id=2, PostTypeId=2, ParentId=1, Score=4),
                post_line(Id=3, PostTypeId=2, ParentId=1, Score=-1),
                "garbage",
            ]
        ),
    )
    table = csv.read_posts_csv(spark, path)
    assert unordered(p.answer_counts(table)) == [(1, 2)]
    assert unordered(p.answers_score(table)) == [(1, 2, 3)]
    assert unordered(p.question_year(table)) == [(1, 5, 2015)]


def test_users_by_header_name(spark, dump):
    path = dump("Users.csv", 'Id,AboutMe,DisplayName,Reputation\n1,"x, y",Ana,39\nz,bad,Bo,1\n2,,Eva,\n')
    assert unordered(csv.read_users_csv(spark, path)) == [(1, "Ana", 39), (2, "Eva", None)]


def test_users_with_newlines(spark, dump):
    path = dump("Users.csv", 'Id,AboutMe,DisplayName,Reputation\n1,"x,\ny",Ana,39\n2,,"E\nva",\n')
    assert unordered(csv.read_users_csv(spark, path, multi_line=True)) == [(1, "Ana", 39), (2, "E\nva", None)]
    with pytest.raises(Exception, match="--multi-line"):
        csv.read_users_csv(spark, path).collect()


def test_header_of_prefixed_lines(spark):
    lines = spark.createDataFrame([("P|Id,x",), ("U|1,2",), ("U|Id, Reputation,DisplayName",)], "value string")
    assert csv.header_of(lines, csv.USER_PREFIX) == ["Id", "Reputation", "DisplayName"]
    assert csv.header_of(lines.limit(2), csv.USER_PREFIX) is None


def test_answers_without_id_stay_in_both_paths(spark, dump):
    line = post_line(PostTypeId=2, ParentId=7)
    tagged = spark.createDataFrame([("P|" + line,)], "value string")
    assert csv.read_posts_csv(spark, dump("p.csv", line + "\n")).count() == 1
    assert csv.tagged_rows(tagged, csv.POST_PREFIX, POSTS, csv.POST_KEY).count() == 1


def test_layout_check(spark, tmp_path):
    path = str(tmp_path / "c")
    spark.range(3).select(F.col("id").cast("int").alias("PostId")).write.parquet(path)
    assert parquet.read_columns(spark, path, COMMENTS).count() == 3
    with pytest.raises(ValueError, match="TagName"):
        parquet.read_columns(spark, path, TAGS)


def test_tagged_files(spark, dump):
    posts = dump(
        "Posts_prefixed.csv",
        "\n".join(
            "P|" + line
            for line in [
                ",".join(POSTS.names),
                post_line(Id=10, PostTypeId=1, OwnerUserId=2),
                post_line(Id=11, PostTypeId=1, OwnerUserId=9),
                post_line(Id=12, PostTypeId=2, OwnerUserId=2, ParentId=10),
            ]
        ),
    )
    users = dump("Users_prefixed.csv", 'U|Id,DisplayName,Reputation\nU|2,"Daniel, ""D""",39\n')
    lines = text.read_lines(spark, posts, users)
    df = owners.question_owner_tagged(lines)
    assert unordered(df) == [(10, 39, 'Daniel, "D"')]


def test_parquet_schema_check(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).select(F.col("id").alias("QuestionId")).write.parquet(path)
    assert parquet.read_table(spark, path).count() == 3
    with pytest.raises(ValueError, match="UserId"):
        parquet.read_table(spark, path, PREGUNTAS)
    check_schema(spark.createDataFrame([], PREGUNTAS), PREGUNTAS)


def test_samples(spark):
    table = spark.range(10_000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    part = parquet.sample_rows(table, 0.2)
    assert 1_700 < part.count() < 2_300
    assert part.join(table, ["k", "v"], "left_anti").count() == 0
    assert unordered(part) == unordered(parquet.sample_rows(table.select("v", "k").repartition(5), 0.2).select("k", "v"))
    by_key = parquet.sample_by_key(table.unionByName(table), "k", 0.2)
    assert 3_400 < by_key.count() < 4_600
    assert by_key.groupBy("k").count().where("count <> 2").count() == 0
    assert unordered(by_key) == unordered(parquet.sample_by_key(table.unionByName(table).repartition(7), "k", 0.2))


def test_samples_by_block_read_few_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(40_000).select(F.col("id").alias("k"), F.rand(1).alias("v")).repartition(40).write.parquet(path)
    table, sizes = spark.read.parquet(path), parquet.stored_files(spark, path)
    assert len(sizes) == 40 and all(size > 0 for _, size in sizes)
    for fraction in (0.0, 0.01, 0.2, 0.5, 1.0):
        part = parquet.sample_by_block(spark, path, fraction)
        read = {r[0] for r in part.select("k").join(table.select("k", "_metadata.file_name"), "k").select("file_name").distinct().collect()}
        # One file is 1,000 rows, and all but the last file come whole.
        assert abs(part.count() - fraction * 40_000) <= 1000
        assert len(read) <= fraction * 40 + 1
        assert unordered(part) == unordered(parquet.sample_by_block(spark, path, fraction))
        assert part.join(table, ["k", "v"], "left_anti").isEmpty()
    assert unordered(parquet.sample_by_block(spark, path, 0.2, 1)) != unordered(parquet.sample_by_block(spark, path, 0.2, 2))


def test_counts_come_from_footers(spark, tmp_path):
    for name, n in (("a", 700), ("b", 0)):
        spark.range(n).repartition(3).write.parquet(str(tmp_path / name))
    counts = parquet.stored_row_counts(spark, {name: str(tmp_path / name) for name in "ab"})
    text = counts._jdf.queryExecution().executedPlan().toString()
    assert text.count("PushedAggregation: [COUNT(*)]") == 2
    assert unordered(counts) == [("a", 700), ("b", 0)]
    # The session of the caller reads as before.
    assert "PushedAggregation" not in spark.read.parquet(str(tmp_path / "a")).agg(F.count(F.lit(1)))._jdf.queryExecution().executedPlan().toString()


def test_inspection(spark):
    table = spark.range(30).select(F.col("id").alias("Id"))
    assert [r.Id for r in parquet.first_rows(table.repartition(4), ["Id"]).collect()] == list(range(10))
    assert unordered(parquet.row_counts({"a": table, "b": table.limit(0)})) == [("a", 30), ("b", 0)]


def test_tagged_lines_survive_the_round_trip(spark):
    names = [(1, 'An "a", b', 5), (2, None, None), (3, "back\\slash", 0)]
    users = spark.createDataFrame(names, "Id bigint, DisplayName string, Reputation bigint")
    lines = csv.tagged_lines(users, csv.USER_PREFIX)
    assert all(r.value.startswith("U|") for r in lines.collect())
    assert unordered(csv.tagged_rows(lines, csv.USER_PREFIX, users.schema)) == names
    assert csv.tagged_rows(lines, csv.POST_PREFIX, users.schema).count() == 0
