"""The queries of the driver contract, over the star-schema tables."""

import csv as plain_csv
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foralytics.operators.mapping import map_reduce
from foralytics.operators.ranking import last_per_group
from foralytics.operators.selection import lower_half
from foralytics.functions.tags import tag_list
from foralytics.plans import owners, posts, rankings, tags, trends, users, words
from foralytics.scratch import scratch_path
from foralytics.schemas import ANSWER, POSTS, PREGUNTAS, RESPUESTAS
from foralytics.sinks import files
from foralytics.sources import csv, parquet, star_schema, text

Query = Callable[[SparkSession, str], DataFrame]

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# The last months of the test data are cut off; trends end before them.
AS_OF = "2001-07"
WANTED_TAGS = "Brand#1,Brand#2,Brand#3"

# Customers stand in for users; their reputation is an account balance.
USER_LINE = T.StructType(
    [
        T.StructField("Id", T.LongType()),
        T.StructField("DisplayName", T.StringType()),
        T.StructField("Reputation", T.DoubleType()),
    ]
)


def _respuestas(spark: SparkSession, sf: str) -> DataFrame:
    return posts.answers_score(star_schema.posts(spark, sf))


def _preguntas(spark: SparkSession, sf: str) -> DataFrame:
    return posts.question_year(star_schema.posts(spark, sf))


def _tagged(spark: SparkSession, sf: str) -> DataFrame:
    return star_schema.posts(spark, sf, with_tags=True)


def _partitions(spark: SparkSession) -> int:
    """A fixed number of partitions that suits the cluster."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# Words


def word_count(spark: SparkSession, sf: str) -> DataFrame:
    return words.word_count(star_schema.documents(spark, sf))


def word_count_udf(spark: SparkSession, sf: str) -> DataFrame:
    return words.word_count_udf(star_schema.documents(spark, sf))


def word_count_files(spark: SparkSession, sf: str) -> DataFrame:
    """Word count of compressed text files, read by a glob."""
    path = scratch_path(spark, "words")
    docs = star_schema.table(spark, sf, "documents").select("lang", "text")
    docs.write.partitionBy("lang").option("compression", "bzip2").text(path)
    return words.word_count(text.read_lines(spark, f"{path}/lang=*/part-*"))


def word_count_by_key(spark: SparkSession, sf: str) -> DataFrame:
    """Tab-separated word counts in a fixed number of files, read back as lines."""
    path = scratch_path(spark, "word-files")
    counts = word_count(spark, sf)
    files.write_by_key(counts, path, "word", _partitions(spark), F.col("word"), F.col("count"))
    return text.read_lines(spark, path).withColumnRenamed("value", "line")


def text_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Lines and characters of text files, per folder they come from."""
    path = scratch_path(spark, "text")
    docs = star_schema.table(spark, sf, "documents").select("lang", "text")
    docs.write.partitionBy("lang").text(path)
    lines = text.read_lines(spark, f"{path}/lang=*/", with_file=True)
    folder = F.regexp_extract("file", "/lang=([^/]+)/", 1)
    return lines.groupBy(folder.alias("lang")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(F.length("value")).alias("n_chars")
    )


# Answers and questions


def answer_counts(spark: SparkSession, sf: str) -> DataFrame:
    return posts.answer_counts(star_schema.posts(spark, sf))


def answer_counts_ordered(spark: SparkSession, sf: str) -> DataFrame:
    return posts.answer_counts_ordered(star_schema.posts(spark, sf))


def answer_counts_topk(spark: SparkSession, sf: str) -> DataFrame:
    return posts.answer_counts_topk(star_schema.posts(spark, sf), k=20)


def answer_counts_topk_buckets(spark: SparkSession, sf: str) -> DataFrame:
    return posts.answer_counts_topk_buckets(star_schema.posts(spark, sf), k=20, buckets=100)


def answer_count_lines(spark: SparkSession, sf: str) -> DataFrame:
    counts = answer_counts(spark, sf)
    return files.key_value_lines(counts, F.col("QuestionId"), F.col("AnswerCount"))


def answer_counts_mapper(spark: SparkSession, sf: str) -> DataFrame:
    """Answers per question out of a CSV dump, line by line, by a mapper in plain Python."""
    path = scratch_path(spark, "mapper")
    csv.write_csv_table(csv.in_layout(star_schema.posts(spark, sf), POSTS), path)
    kind, parent = POSTS.names.index("PostTypeId"), POSTS.names.index("ParentId")

    def answered(line: str):
        row = next(plain_csv.reader([line]))
        if row[0].strip().lower() != "id" and int(row[kind]) == ANSWER:
            yield int(row[parent]), 1

    return map_reduce(
        text.read_lines(spark, path), answered, "QuestionId long, n long", ["QuestionId"],
        F.sum("n").alias("AnswerCount"), skip=(ValueError, IndexError, plain_csv.Error),
    )


def answers_score(spark: SparkSession, sf: str) -> DataFrame:
    return _respuestas(spark, sf)


def answers_score_all(spark: SparkSession, sf: str) -> DataFrame:
    return posts.answers_score(star_schema.posts(spark, sf), include_unanswered=True)


def answered_questions(spark: SparkSession, sf: str) -> DataFrame:
    answered = posts.answered_questions(star_schema.posts(spark, sf))
    return answered.select("Id", "OwnerUserId", "CreationDate")


def question_year(spark: SparkSession, sf: str) -> DataFrame:
    return _preguntas(spark, sf)


def answer_audit(spark: SparkSession, sf: str) -> DataFrame:
    return posts.answer_audit(star_schema.posts(spark, sf, with_declared=True))


def ordered_half(spark: SparkSession, sf: str) -> DataFrame:
    return lower_half(star_schema.table(spark, sf, "orders"), ["o_orderkey"])


def ordered_half_tied(spark: SparkSession, sf: str) -> DataFrame:
    """Ordered by owner, a column with ties, then by key."""
    return lower_half(star_schema.table(spark, sf, "orders"), ["o_custkey", "o_orderkey"])


def ordered_half_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Ordered by time, then by key."""
    return lower_half(star_schema.table(spark, sf, "orders"), ["o_orderdate", "o_orderkey"])


def ordered_half_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Ordered by a text, then by a decimal, then by key."""
    priced = star_schema.table(spark, sf, "orders").withColumn("price", F.col("o_totalprice").cast("decimal(15,2)"))
    half = lower_half(priced, ["o_orderpriority", "price", "o_orderkey"])
    return half.select("o_orderkey", "o_orderpriority", "o_totalprice")


# Owners


def question_owner(spark: SparkSession, sf: str) -> DataFrame:
    return owners.question_owner(star_schema.posts(spark, sf), star_schema.users(spark, sf))


def question_owner_tagged(spark: SparkSession, sf: str) -> DataFrame:
    """Two files of prefixed lines read as one input and joined by prefix."""
    path = scratch_path(spark, "tagged")
    asked = csv.in_layout(star_schema.posts(spark, sf), POSTS)
    people = csv.in_layout(star_schema.users(spark, sf), USER_LINE)
    csv.tagged_lines(asked, csv.POST_PREFIX).write.text(f"{path}/posts")
    csv.tagged_lines(people, csv.USER_PREFIX).write.text(f"{path}/users")
    lines = text.read_lines(spark, f"{path}/posts", f"{path}/users")
    return owners.question_owner_tagged(lines, POSTS, USER_LINE)


def question_owner_lines(spark: SparkSession, sf: str) -> DataFrame:
    return owners.owner_lines(question_owner(spark, sf))


# Tags


def questions_by_year_tag(spark: SparkSession, sf: str) -> DataFrame:
    return tags.questions_by_year_tag(_tagged(spark, sf))


def tag_cooccurrence(spark: SparkSession, sf: str) -> DataFrame:
    return tags.tag_cooccurrence(_tagged(spark, sf))


def year_tag_lines(spark: SparkSession, sf: str) -> DataFrame:
    return tags.year_tag_lines(questions_by_year_tag(spark, sf))


def tag_pair_lines(spark: SparkSession, sf: str) -> DataFrame:
    return tags.pair_lines(tag_cooccurrence(spark, sf))


def tag_cooccurrence_frequent(spark: SparkSession, sf: str) -> DataFrame:
    return tags.tag_cooccurrence(_tagged(spark, sf), min_count=350)


def question_tags(spark: SparkSession, sf: str) -> DataFrame:
    return tags.question_tags(_tagged(spark, sf))


def tag_activity(spark: SparkSession, sf: str) -> DataFrame:
    return trends.tag_activity(_tagged(spark, sf))


def tag_delta(spark: SparkSession, sf: str) -> DataFrame:
    return trends.tag_delta(_tagged(spark, sf))


def tag_recent_deltas(spark: SparkSession, sf: str) -> DataFrame:
    """The deltas of the last six months of every tag."""
    return last_per_group(trends.tag_delta(_tagged(spark, sf)), ["tag"], "month", 6)


def tag_trend(spark: SparkSession, sf: str) -> DataFrame:
    return trends.tag_trend(_tagged(spark, sf))


def tag_trend_as_of(spark: SparkSession, sf: str) -> DataFrame:
    """The trend with the months after a last complete one left out, as the job's option does."""
    return trends.tag_trend(_tagged(spark, sf), AS_OF)


def tag_trend_lines(spark: SparkSession, sf: str) -> DataFrame:
    return trends.trend_lines(tag_trend(spark, sf))


def _ranked(spark: SparkSession, sf: str, ties: str) -> DataFrame:
    wanted = tag_list(WANTED_TAGS)
    return rankings.tag_year_rank(
        _respuestas(spark, sf), _preguntas(spark, sf), star_schema.tags(spark, sf), wanted, ties
    )


def tag_year_rank(spark: SparkSession, sf: str) -> DataFrame:
    return _ranked(spark, sf, "rank")


def tag_year_rank_dense(spark: SparkSession, sf: str) -> DataFrame:
    return _ranked(spark, sf, "dense_rank")


def tag_year_rank_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _ranked(spark, sf, "row_number")


# Users


def comment_counts(spark: SparkSession, sf: str) -> DataFrame:
    return users.comment_counts(star_schema.comments(spark, sf))


def user_year_stats(spark: SparkSession, sf: str) -> DataFrame:
    return users.user_year_stats(
        _respuestas(spark, sf),
        _preguntas(spark, sf),
        star_schema.users(spark, sf),
        star_schema.comments(spark, sf),
    ).drop("UserId")


def _user_tags(spark: SparkSession, sf: str, **how) -> DataFrame:
    return users.user_tag_year_diff(
        _preguntas(spark, sf), star_schema.tags(spark, sf), star_schema.users(spark, sf), **how
    ).drop("UserId")


def user_tag_year_diff(spark: SparkSession, sf: str) -> DataFrame:
    return _user_tags(spark, sf)


def user_tag_year_diff_calendar(spark: SparkSession, sf: str) -> DataFrame:
    return _user_tags(spark, sf, calendar=True)


def user_tag_year_diff_min10(spark: SparkSession, sf: str) -> DataFrame:
    return _user_tags(spark, sf, min_questions=10)


# Sources and sinks


def posts_csv(spark: SparkSession, sf: str) -> DataFrame:
    """The whole posts table written as a 22-column CSV dump and read back."""
    path = scratch_path(spark, "posts-csv")
    csv.write_csv_table(csv.in_layout(_tagged(spark, sf), POSTS), path)
    return csv.read_posts_csv(spark, path).select(
        "Id", "PostTypeId", "ParentId", "OwnerUserId", "CreationDate", "Score", "Tags"
    )


def posts_csv_strict(spark: SparkSession, sf: str) -> DataFrame:
    """The whole dump, read with every field of every line checked."""
    path = scratch_path(spark, "posts-csv")
    csv.write_csv_table(csv.in_layout(_tagged(spark, sf), POSTS), path)
    return csv.read_posts_csv(spark, path, strict=True).select(
        "Id", "PostTypeId", "ParentId", "OwnerUserId", "CreationDate", "Score", "Tags"
    )


def _dump_with_bodies(spark: SparkSession, sf: str) -> DataFrame:
    """A dump whose questions have the documents as bodies, with quotes, commas and newlines."""
    path = scratch_path(spark, "posts-bodies")
    bodies = star_schema.table(spark, sf, "documents").select(F.col("doc_id").alias("Id"), F.col("text").alias("Body"))
    table = star_schema.posts(spark, sf).join(bodies, "Id", "left")
    csv.write_csv_table(csv.in_layout(table, POSTS), path)
    return csv.read_posts_csv(spark, path, multi_line=True)


def posts_csv_bodies(spark: SparkSession, sf: str) -> DataFrame:
    return _dump_with_bodies(spark, sf).select("Id", "PostTypeId", "ParentId", "Score", "Body")


def answer_counts_bodies(spark: SparkSession, sf: str) -> DataFrame:
    """Answers per question out of that dump."""
    return posts.answer_counts(_dump_with_bodies(spark, sf))


def users_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Users written as CSV, read back by position and stripped."""
    path = scratch_path(spark, "users-csv")
    csv.write_csv_table(star_schema.users(spark, sf), path)
    return csv.read_users_csv(spark, path, USER_LINE)


def documents_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Texts with quotes, commas and newlines through CSV and back."""
    path = scratch_path(spark, "documents-csv")
    docs = star_schema.table(spark, sf, "documents")
    csv.write_csv_table(docs, path)
    return csv.read_csv_table(spark, path, docs.schema, ["doc_id"], multi_line=True)


def extract_parquet(spark: SparkSession, sf: str) -> DataFrame:
    """Both tables of the extraction job saved as gzip Parquet, read back, joined."""
    root = scratch_path(spark, "extract")
    files.write_gzip_parquet(_respuestas(spark, sf), f"{root}/respuestas")
    files.write_gzip_parquet(_preguntas(spark, sf), f"{root}/preguntas")
    respuestas = parquet.read_table(spark, f"{root}/respuestas", RESPUESTAS)
    preguntas = parquet.read_table(spark, f"{root}/preguntas", PREGUNTAS)
    return preguntas.join(respuestas, "QuestionId").select(
        "QuestionId", "UserId", F.col("Año"), "NRespuestas", "ScoreTotal"
    )


def user_year_stats_extracted(spark: SparkSession, sf: str) -> DataFrame:
    """The yearly report out of the tables that the extraction job hands over in buckets of the question."""
    root = scratch_path(spark, "handed-over")
    files.write_buckets(_respuestas(spark, sf), f"{root}/respuestas", "QuestionId", grouped=True)
    files.write_buckets(_preguntas(spark, sf), f"{root}/preguntas", "QuestionId")
    return users.user_year_stats(
        parquet.read_buckets(spark, f"{root}/respuestas", RESPUESTAS),
        parquet.read_buckets(spark, f"{root}/preguntas", PREGUNTAS),
        star_schema.users(spark, sf),
        star_schema.comments(spark, sf),
    ).drop("UserId")


def file_report(spark: SparkSession, sf: str) -> DataFrame:
    """Partitions with rows, counted while hash partitions are written, and the files there are.

    The key is the year, so that most partitions stay empty.
    """
    path = scratch_path(spark, "files")
    placed = _preguntas(spark, sf).repartition(_partitions(spark) + 100, "Año")
    partitions = files.write_gzip_parquet(placed, path)
    found = len(files.written_files(spark, path))
    return files.file_report(spark, path).agg(
        (F.count(F.lit(1)) == partitions).alias("one_file_per_partition"),
        # An empty first partition leaves a file without rows.
        (F.lit(found) - F.count(F.lit(1)) <= 1).alias("no_more_files"),
        F.sum("n_rows").alias("rows_in_files"),
    )


def _report(spark: SparkSession, sf: str, single_file: bool) -> DataFrame:
    path = scratch_path(spark, "report")
    report = users.user_year_stats(
        _respuestas(spark, sf), _preguntas(spark, sf), star_schema.users(spark, sf), star_schema.comments(spark, sf)
    )
    shown = [c for c in report.columns if c != "UserId"]
    files.write_report(report, path, users.year_order(), shown, single_file)
    return csv.read_csv_table(spark, path, report.select(*shown).schema, ["NumPreguntas"])


def report_csv(spark: SparkSession, sf: str) -> DataFrame:
    """The yearly user report written as one ordered CSV file and read back."""
    return _report(spark, sf, single_file=True)


def report_csv_parts(spark: SparkSession, sf: str) -> DataFrame:
    """The same report as ordered part files."""
    return _report(spark, sf, single_file=False)


def table_counts(spark: SparkSession, sf: str) -> DataFrame:
    return parquet.stored_row_counts(spark, {name: f"{sf}/{name}.parquet" for name in TABLES})


def first_posts(spark: SparkSession, sf: str) -> DataFrame:
    """The first rows of the posts in the order of all of their columns."""
    order = ["CreationDate", "PostTypeId", "Id", "ParentId", "Score"]
    return parquet.first_rows(star_schema.posts(spark, sf), order).select(*order)


def post_sample(spark: SparkSession, sf: str) -> DataFrame:
    return parquet.sample_rows(star_schema.posts(spark, sf), 0.1)


def post_sample_by_question(spark: SparkSession, sf: str) -> DataFrame:
    """A tenth of the questions together with all their answers."""
    both = star_schema.posts(spark, sf).select(
        F.coalesce("ParentId", "Id").alias("QuestionId"), "PostTypeId", "Score"
    )
    return parquet.sample_by_key(both, "QuestionId", 0.1)


def orders_sample_by_block(spark: SparkSession, sf: str) -> DataFrame:
    """A tenth of the bytes of the orders' files: of a table in one file, rows drawn from it."""
    return parquet.sample_by_block(spark, f"{sf}/orders.parquet", 0.1)


# Name of each query in the driver contract.
QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        answers_score,
        answers_score_all,
        answered_questions,
        question_year,
        answer_counts,
        answer_counts_ordered,
        answer_counts_topk,
        answer_counts_topk_buckets,
        answer_count_lines,
        answer_counts_mapper,
        answer_audit,
        word_count,
        word_count_udf,
        word_count_files,
        word_count_by_key,
        text_scan,
        question_owner,
        question_owner_tagged,
        question_owner_lines,
        question_tags,
        questions_by_year_tag,
        tag_cooccurrence,
        tag_cooccurrence_frequent,
        year_tag_lines,
        tag_pair_lines,
        tag_activity,
        tag_delta,
        tag_recent_deltas,
        tag_trend,
        tag_trend_as_of,
        tag_trend_lines,
        comment_counts,
        user_year_stats,
        tag_year_rank,
        tag_year_rank_dense,
        tag_year_rank_rows,
        user_tag_year_diff,
        user_tag_year_diff_calendar,
        user_tag_year_diff_min10,
        ordered_half,
        ordered_half_tied,
        ordered_half_dates,
        ordered_half_texts,
        posts_csv,
        posts_csv_strict,
        posts_csv_bodies,
        answer_counts_bodies,
        users_csv,
        documents_csv,
        extract_parquet,
        user_year_stats_extracted,
        file_report,
        report_csv,
        report_csv_parts,
        table_counts,
        first_posts,
        post_sample,
        post_sample_by_question,
        orders_sample_by_block,
    )
}
