import csv
import glob
import os

import pytest
from pyspark.sql import functions as F

from foralytics import scratch
from foralytics.schemas import PREGUNTAS
from foralytics.sinks import files
from foralytics.sources import parquet
from helpers import unordered


def parts(path, suffix=""):
    return sorted(glob.glob(os.path.join(path, f"part-*{suffix}")))


def read(path):
    with open(path, encoding="utf8") as f:
        return f.read().splitlines()


@pytest.fixture
def report(spark):
    data = [(f'u "{i % 7}", x', 2000 + i % 5, i) for i in range(200)]
    return spark.createDataFrame(data, "Usuario string, `Año` int, n bigint").repartition(6)


def order():
    return [F.desc("n"), F.asc("Usuario")]


def test_report_is_one_ordered_file(report, tmp_path):
    path = str(tmp_path / "out")
    for _ in range(2):
        files.write_report(report, path, order(), single_file=True)
    (file,) = parts(path, ".csv")
    lines = read(file)
    assert lines[0] == "Usuario,Año,n"
    assert lines[1] == '"u ""3"", x",2004,199'
    assert [int(l.rsplit(",", 1)[1]) for l in lines[1:]] == list(range(199, -1, -1))


def test_a_hidden_column_orders_the_report(report, tmp_path):
    files.write_report(report, str(tmp_path / "out"), order(), ["Usuario"], single_file=True)
    (file,) = parts(str(tmp_path / "out"), ".csv")
    assert read(file)[:2] == ["Usuario", '"u ""3"", x"']


def test_report_is_sorted_once(report):
    from helpers import plan

    assert plan(report.orderBy(*order())).count("rangepartitioning") == 1


def test_report_in_ordered_parts(spark, report, tmp_path):
    path = str(tmp_path / "out")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        files.write_report(report, path, order())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    names = parts(path, ".csv")
    assert len(names) > 1
    numbers = []
    for name in names:
        lines = read(name)
        assert lines[0] == "Usuario,Año,n"
        numbers += [int(l.rsplit(",", 1)[1]) for l in lines[1:]]
    assert numbers == list(range(199, -1, -1))


def test_key_values_and_fixed_files(spark, tmp_path):
    path = str(tmp_path / "kv")
    df = spark.createDataFrame([(i, i * i, None if i == 3 else "z") for i in range(40)], "k int, v int, t string")
    files.write_by_key(df, path, "k", 3, F.col("k"), F.col("v"), F.col("t"))
    names = parts(path, ".txt")
    assert len(names) == 3
    lines = [read(n) for n in names]
    for part in lines:
        keys = [l.split("\t")[0] for l in part]
        assert keys == sorted(keys)
    everything = sorted(l for part in lines for l in part)
    assert everything == sorted(f"{i}\t{i * i}\t{'' if i == 3 else 'z'}" for i in range(40))


def test_lines_hold_one_row_and_their_fields(spark):
    df = spark.createDataFrame([("a\tb", "c\nd\r\\"), (None, "x")], "k string, v string")
    found = [r.value for r in files.key_value_lines(df, F.col("k"), F.col("v")).collect()]
    assert found == ["a\\tb\tc\\nd\\r\\\\", "\tx"]


def test_empty_partitions_and_files_without_rows_count(spark, tmp_path):
    path = str(tmp_path / "t")
    assert files.write_gzip_parquet(spark.range(5).repartition(40, F.lit(1)), path) == 1
    spark.range(0).write.mode("append").parquet(path)
    # Spark writes a file without rows where the first partition is empty.
    assert len(files.written_files(spark, path)) >= 2
    assert files.file_report(spark, path).count() == 1


def test_gzip_parquet_and_reports(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(300).repartition(3, "id")
    assert files.write_gzip_parquet(df, path) == 3
    assert len(parts(path, ".gz.parquet")) == len(files.written_files(spark, path)) == 3
    before, after = files.partition_report(df), files.file_report(spark, path)
    assert before.count() == after.count() == 3
    assert sorted(r.n_rows for r in before.collect()) == sorted(r.n_rows for r in after.collect())


def test_stage_and_scratch(spark):
    path = scratch.scratch_path(spark, "x")
    staged = scratch.stage(spark.range(5), "x", path)
    assert unordered(staged) == [(i,) for i in range(5)]
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch.scratch_root(spark).startswith(root)
    assert scratch.scratch_path(spark, "a") != scratch.scratch_path(spark, "a")
    scratch.discard(spark, path)
    assert not os.path.exists(path)


def test_one_file_without_one_task(spark, tmp_path):
    from helpers import plan

    table = spark.range(5000).select(F.col("id").alias("n"), F.concat(F.lit("a,\"b\"\n"), "id").alias('odd "name", x')).repartition(9)
    path = str(tmp_path / "out")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert "SinglePartition" not in plan(table.orderBy(F.desc("n")))
        files.write_report(table, path, [F.desc("n")], single_file=True)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    (file,) = parts(path)
    assert sorted(n for n in os.listdir(path) if not n.startswith(".")) == ["part-00000.csv"]
    with open(file, encoding="utf8", newline="") as f:
        rows = list(csv.reader(f))
    assert rows[0] == ["n", 'odd "name", x']
    assert rows[1:] == [[str(i), f'a,"b"\n{i}'] for i in range(4999, -1, -1)]


def test_one_file_of_no_rows(spark, tmp_path):
    files.write_report(spark.range(0), str(tmp_path / "out"), ["id"], single_file=True)
    assert read(parts(str(tmp_path / "out"))[0]) == ["id"]


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path, no_broadcast):
    from helpers import final_plan

    left = spark.range(3000).select(F.col("id").alias("QuestionId"), (F.col("id") % 5).alias("`Año`".strip("`")))
    right = spark.range(2000).select((F.col("id") * 2).alias("QuestionId"), F.lit("x").alias("v"))
    for name, table in (("l", left), ("r", right)):
        files.write_buckets(table, str(tmp_path / name), "QuestionId", 4)
        assert len(parts(str(tmp_path / name), ".gz.parquet")) == 4
    a, b = (parquet.read_buckets(spark, str(tmp_path / name)) for name in "lr")
    joined = a.join(b, "QuestionId")
    assert "Exchange" not in final_plan(joined)
    assert unordered(joined) == unordered(left.join(right, "QuestionId"))
    grouped = a.groupBy("QuestionId").count()
    assert "Exchange" not in final_plan(grouped) and grouped.count() == 3000
    # Written again, and by a frame that is grouped already.
    files.write_buckets(right.groupBy("QuestionId").count(), str(tmp_path / "r"), "QuestionId", grouped=True)
    assert parquet.read_buckets(spark, str(tmp_path / "r")).where("count = 1").count() == 2000
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("buckets_")]
    with pytest.raises(ValueError, match="UserId"):
        parquet.read_buckets(spark, str(tmp_path / "r"), PREGUNTAS)


def test_plain_tables_are_read_as_they_are(spark, tmp_path):
    path = str(tmp_path / "plain")
    spark.range(7).write.parquet(path)
    assert parquet.read_buckets(spark, path).count() == 7
    assert parquet.read_buckets(spark, path).dtypes == [("id", "bigint")]


def test_yearly_report_over_bucketed_tables_moves_no_question(spark, no_broadcast):
    from foralytics import queries
    from helpers import plan

    report = queries.user_year_stats_extracted(spark, "/root/testdata/sf0.001")
    text = plan(report)
    moved = [line for line in text.splitlines() if "Exchange hashpartitioning(QuestionId" in line]
    assert not moved and text.count("Bucketed: true") == 2
