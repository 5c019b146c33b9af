import glob

import pytest
from pyspark.sql import functions as F

from foralytics import cli
from foralytics.schemas import POSTS
from foralytics.sources import csv, star_schema

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("inputs"))
    table = star_schema.posts(spark, SF_DIR, with_tags=True, with_declared=True)
    table.write.parquet(f"{root}/posts")
    csv.write_csv_table(csv.in_layout(table, POSTS), f"{root}/posts_csv")
    star_schema.users(spark, SF_DIR).write.parquet(f"{root}/users")
    star_schema.comments(spark, SF_DIR).write.parquet(f"{root}/comments")
    star_schema.tags(spark, SF_DIR).write.parquet(f"{root}/tags")
    star_schema.documents(spark, SF_DIR).write.text(f"{root}/text")
    posts = csv.tagged_lines(csv.in_layout(table, POSTS), csv.POST_PREFIX)
    users = star_schema.users(spark, SF_DIR).withColumn("Reputation", F.col("Reputation").cast("bigint"))
    both = posts.unionByName(csv.tagged_lines(users, csv.USER_PREFIX))
    both.write.text(f"{root}/no_header")
    header = spark.createDataFrame([("U|" + ",".join(users.columns),)], "value string")
    both.unionByName(header).write.text(f"{root}/tagged")
    return root


@pytest.fixture(scope="module")
def extracted(spark, inputs):
    cli.main(["extract", f"{inputs}/posts", f"{inputs}/respuestas", f"{inputs}/preguntas", "--report"])
    return inputs


def lines(path):
    out = []
    for name in sorted(glob.glob(f"{path}/part-*")):
        with open(name, encoding="utf8") as f:
            out += f.read().splitlines()
    return out


def test_extract(spark, extracted, capsys):
    assert glob.glob(f"{extracted}/respuestas/*.gz.parquet")
    assert spark.read.parquet(f"{extracted}/preguntas").count() == 1500


def test_reports(extracted, tmp_path):
    root, out = extracted, str(tmp_path)
    e1 = [f"{root}/respuestas", f"{root}/preguntas"]
    cli.main(["user-years", *e1, f"{root}/users", f"{root}/comments", f"{out}/years", "--single-file"])
    years = lines(f"{out}/years")
    assert years[0] == "Usuario,Año,NumPreguntas,TotalRespuestas,TotalComentarios,MediaRespuestas,MaxRespuestas"
    most = [int(l.rsplit(",", 1)[1]) for l in years[1:]]
    assert most == sorted(most, reverse=True)
    assert all(len(l.split(",")[5].split(".")[1]) == 2 for l in years[1:])
    cli.main(["tag-ranks", *e1, f"{root}/tags", "Brand#1, Brand#2", f"{out}/ranks", "--ties", "row_number", "--single-file"])
    ranks = lines(f"{out}/ranks")
    assert ranks[0] == "Tag,Año,QuestionId,NRespuestas,Rango"
    assert {l.split(",")[0] for l in ranks[1:]} == {"Brand#1", "Brand#2"}
    cli.main(["user-tags", f"{root}/preguntas", f"{root}/tags", f"{root}/users", f"{out}/tags", "--min-questions", "10"])
    table = lines(f"{out}/tags")
    assert table[0] == "Usuario,Tag,Año,NPreguntas,Dif"
    assert [l.split(",")[:2] for l in table[1:]] == sorted(l.split(",")[:2] for l in table[1:])


def test_posts_jobs(inputs, tmp_path):
    root, out = f"{inputs}/posts_csv", str(tmp_path)
    cli.main(["answer-counts", root, f"{out}/counts"])
    cli.main(["answer-counts", root, f"{out}/ordered", "--ordered"])
    cli.main(["answer-counts", root, f"{out}/top", "--top-k", "20", "--num-buckets", "100"])
    ordered = lines(f"{out}/ordered")
    assert sorted(lines(f"{out}/counts")) == sorted(ordered)
    assert lines(f"{out}/top") == ordered[:20]
    cli.main(["answer-counts", f"{inputs}/posts", f"{out}/parquet", "--format", "parquet"])
    assert sorted(lines(f"{out}/parquet")) == sorted(ordered)
    cli.main(["convert", root, f"{out}/converted", "--multi-line"])
    cli.main(["answer-counts", f"{out}/converted", f"{out}/again", "--format", "parquet"])
    assert sorted(lines(f"{out}/again")) == sorted(ordered)
    cli.main(["year-tags", root, f"{out}/years"])
    assert lines(f"{out}/years")[0].startswith("(1995,Brand#1)\t")
    cli.main(["tag-pairs", root, f"{out}/pairs", "--strict"])
    counts = [int(l.split("\t")[1]) for l in lines(f"{out}/pairs")]
    assert len(counts) == 300 and counts == sorted(counts, reverse=True)
    cli.main(["tag-trends", root, f"{out}/trends", "--as-of", "2001-07"])
    trends = [l.split("\t") for l in lines(f"{out}/trends")]
    assert len(trends) == 25 and {t[1] for t in trends} <= {"CRECIMIENTO", "DECLIVE", "ESTABLE"}
    cli.main(["answer-audit", root, f"{out}/audit"])
    assert all(int(l.split("\t")[1]) > int(l.split("\t")[2]) for l in lines(f"{out}/audit"))


def test_text_jobs(spark, inputs, tmp_path):
    out = str(tmp_path)
    cli.main(["word-count", f"{inputs}/text/part-*", f"{out}/words"])
    assert len(glob.glob(f"{out}/words/part-*")) == 3
    cli.main(["question-owners", f"{inputs}/tagged", f"{out}/owners"])
    owned = lines(f"{out}/owners")
    assert len(owned) == 1500 and owned[0].split("\t")[1].startswith("(")
    cli.main(["question-owners", f"{inputs}/no_header", f"{out}/named", "--user-columns", "Id,DisplayName,Reputation"])
    assert sorted(lines(f"{out}/named")) == sorted(owned)
    with pytest.raises(SystemExit):
        cli.main(["question-owners", f"{inputs}/no_header", f"{out}/none"])
    cli.main(["lines", f"{inputs}/text", f"{out}/lines"])
    assert spark.read.parquet(f"{out}/lines").columns == ["file", "value"]


def test_table_jobs(spark, inputs, tmp_path, capsys):
    out = str(tmp_path)
    cli.main(["inspect", f"{inputs}/users"])
    assert "rows: 150" in capsys.readouterr().out
    cli.main(["half", f"{inputs}/users", f"{out}/half", "--order", "Id"])
    assert spark.read.parquet(f"{out}/half").count() == 75
    cli.main(["sample", f"{inputs}/users", f"{out}/sample", "--fraction", "0.5"])
    assert 40 < spark.read.parquet(f"{out}/sample").count() < 110


def test_wrong_arguments():
    with pytest.raises(SystemExit):
        cli.main(["extract", "only-one"])


def test_reports_over_buckets_are_the_same(spark, extracted, tmp_path):
    root, out = extracted, str(tmp_path)
    cli.main(["extract", f"{root}/posts", f"{out}/respuestas", f"{out}/preguntas", "--buckets", "4", "--report"])
    assert len(glob.glob(f"{out}/preguntas/*.gz.parquet")) == 4
    for tables in (root, out):
        cli.main(["user-years", f"{tables}/respuestas", f"{tables}/preguntas", f"{root}/users", f"{root}/comments", f"{out}/years-{len(tables)}", "--single-file"])
    assert lines(f"{out}/years-{len(root)}") == lines(f"{out}/years-{len(out)}")


def test_sample_by_block(spark, inputs, tmp_path):
    cli.main(["sample", f"{inputs}/posts", f"{tmp_path}/part", "--fraction", "0.3", "--by-block"])
    part, whole = (spark.read.parquet(p).count() for p in (f"{tmp_path}/part", f"{inputs}/posts"))
    assert 0 < part < whole
