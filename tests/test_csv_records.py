import csv as plain_csv
import io
import random
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foralytics.plans import owners
from foralytics.schemas import POSTS, USERS
from foralytics.sources import csv
from foralytics.sources.csv_records import range_starts, raw_lines, read_records
from helpers import plan, unordered

FIELDS = T.StructType([T.StructField(n, T.StringType()) for n in ("Id", "Body", "Tags")])


@pytest.fixture
def small_ranges(spark):
    """Byte ranges of 2 KB, so that a file is many of them."""
    names = {"spark.sql.files.maxPartitionBytes": "2048", "spark.sql.files.openCostInBytes": "1"}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield 2048
    for name in names:
        spark.conf.unset(name)


def nasty(draw, i, length):
    """A body of quotes, commas, line ends of both kinds, and sometimes longer than a range."""
    text = "".join(draw.choice(['"', '""', ",", "\n", "\n\n", "\r\n", "a", "ü", "漢", " b", "\\", "|"]) for _ in range(draw.randint(0, length)))
    return (str(i), "x" + text + "y", draw.choice(["<a><b>", None]))


def written(path, rows, ends="\n"):
    out = io.StringIO(newline="")
    writer = plain_csv.writer(out, lineterminator=ends)
    writer.writerow(FIELDS.names)
    writer.writerows(rows)
    path.write_bytes(out.getvalue().encode())
    return str(path)


@pytest.mark.parametrize("ends", ["\n", "\r\n"])
@pytest.mark.parametrize("broadcast_ranges", [200_000, 0])
def test_one_file_in_many_tasks(spark, tmp_path, small_ranges, ends, broadcast_ranges):
    draw = random.Random(len(ends))
    rows = [nasty(draw, i, 9000 if i % 97 == 5 else 60) for i in range(600)]
    path = written(tmp_path / "d.csv", rows, ends)
    assert spark.read.text(path).rdd.getNumPartitions() > 20
    records = read_records(spark, path, broadcast_ranges)
    assert "multiLine" not in plan(records)
    want = [(i, body, tags) for i, body, tags in rows]
    texts = T.StructType([*FIELDS.fields, T.StructField(csv.CORRUPT, T.StringType())])
    got = csv.parsed(records, "value", texts, multiLine="true", columnNameOfCorruptRecord=csv.CORRUPT).drop(csv.CORRUPT)
    assert unordered(got.where("Id <> 'Id'")) == sorted(want, key=repr)


def test_same_rows_as_a_reader_of_whole_files(spark, tmp_path, small_ranges):
    draw = random.Random(4)
    folder = tmp_path / "dump"
    folder.mkdir()
    for k in range(3):
        written(folder / f"p{k}.csv", [nasty(draw, 1000 * k + i, 40 + 4000 * (i == 9)) for i in range(150)])
    (folder / "empty.csv").write_text("")
    whole = spark.read.schema(FIELDS).options(**csv.DIALECT, multiLine=True, header=True).csv(str(folder))
    got = csv.read_csv_table(spark, str(folder), FIELDS, multi_line=True)
    assert got.count() == 450
    assert unordered(got) == unordered(whole)


def test_a_record_over_several_ranges_and_one_never_closed(spark, tmp_path, small_ranges):
    lines = "\n".join(f"line {i} of the body" for i in range(900))
    (tmp_path / "a.csv").write_text(f'Id,Body,Tags\n1,"{lines}",<a>\n2,b,<c>\n3,"open {lines}')
    (tmp_path / "b.csv").write_text('7,"two\nlines",\n\n\n8,,\n')
    got = {r["Id"]: r["Body"] for r in csv.read_csv_table(spark, str(tmp_path), FIELDS, multi_line=True).collect()}
    assert got["1"] == lines and got["2"] == "b" and got["7"] == "two\nlines" and got["8"] is None
    assert set(got) == {"1", "2", "3", "7", "8"} and "line 899" in got["3"]
    starts = range_starts(raw_lines(spark, str(tmp_path)))
    assert starts.where("inside").count() > 10
    # Every range takes over the state in which the one before it ends.
    files = {}
    for r in sorted(starts.collect(), key=lambda r: (r["file"], r["start"])):
        assert r["inside"] == files.get(r["file"], False)
        files[r["file"]] = r["open"]


def test_files_that_have_changed_fail(spark, tmp_path, small_ranges):
    path = written(tmp_path / "d.csv", [(str(i), "one\ntwo" * 9, None) for i in range(200)])
    got = csv.read_csv_table(spark, path, FIELDS, multi_line=True)
    assert got.count() == 200
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    with pytest.raises(Exception, match="not cut as they were counted"):
        csv.read_csv_table(spark, path, FIELDS, multi_line=True).unionAll(got).count()


def parses(df):
    return len(re.findall(r"from_csv\(", df._jdf.queryExecution().optimizedPlan().toString()))


@pytest.mark.parametrize("how", [{}, {"strict": True}, {"multi_line": True}, {"multi_line": True, "strict": True}])
def test_a_record_is_parsed_once(spark, tmp_path, how):
    path = str(tmp_path / "Posts.csv")
    (tmp_path / "Posts.csv").write_text(",".join(POSTS.names) + "\n" + ",".join("1" if n in ("Id", "PostTypeId") else "" for n in POSTS.names) + "\n")
    read = csv.read_posts_csv(spark, path, **how).where("Score is null and Id > 0").select("Id", "Tags", "CreationDate")
    assert parses(read) == 1 and read.count() == 1


def test_prefixed_lines_are_read_and_parsed_once(spark, tmp_path):
    (tmp_path / "l.txt").write_text("P|1\nU|2\n")
    lines = spark.read.text(str(tmp_path / "l.txt"))
    owned = owners.question_owner_tagged(lines, POSTS, USERS)
    text = owned._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan text") == 1
    # One for each of the two layouts.
    assert parses(owned) == 2
    assert parses(csv.tagged_rows(lines, csv.POST_PREFIX, POSTS, csv.POST_KEY)) == 1


def test_a_hot_owner_is_split_and_owners_repeat_as_in_a_join(spark):
    users = [(1, "Ana", 5), (2, 'B "b"', None), (3, None, 7), (3, "twice", 8), (4, "nobody's", 1), (None, "no id", 2)]
    posts = [(i, 1, 1) for i in range(3000)] + [(3000 + i, 1, i % 6) for i in range(60)] + [(9000, 1, None), (9001, 2, 1), (None, 1, 2), (7, 1, 2), (7, 1, 2)]
    user_df = spark.createDataFrame(users, "Id long, DisplayName string, Reputation long")
    post_df = spark.createDataFrame(posts, "Id long, PostTypeId int, OwnerUserId long")
    lines = csv.tagged_lines(csv.in_layout(post_df, POSTS), csv.POST_PREFIX).unionAll(csv.tagged_lines(user_df, csv.USER_PREFIX))
    schema = user_df.schema
    wanted = unordered(owners.question_owner(post_df, user_df))
    for salts in (1, 8):
        assert unordered(owners.question_owner_tagged(lines.repartition(5), POSTS, schema, salts)) == wanted
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        most = []
        for salts in (1, 8):
            placed = owners.question_owner_tagged(lines, POSTS, schema, salts).groupBy(F.spark_partition_id()).count()
            most.append(max(r["count"] for r in placed.collect()))
        assert most[1] < 0.6 * most[0]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
