"""Command-line jobs: read, call one analysis, write."""

import argparse
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foralytics.functions.tags import tag_list
from foralytics.functions.values import fixed_decimals
from foralytics.operators.selection import lower_half
from foralytics.plans import owners, posts, rankings, tags, trends, users, words
from foralytics.schemas import COMMENTS, POST_COLUMNS, POSTS, PREGUNTAS, RESPUESTAS, TAGS, USER_COLUMNS, USERS
from foralytics.session import job_session
from foralytics.sinks import files
from foralytics.sources import csv, parquet, text


def _posts(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.format == "parquet":
        return parquet.read_columns(spark, args.posts, POST_COLUMNS)
    return csv.read_posts_csv(spark, args.posts, multi_line=args.multi_line, strict=args.strict)


def _respuestas(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    return parquet.read_buckets(spark, args.respuestas, RESPUESTAS)


def _preguntas(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    return parquet.read_buckets(spark, args.preguntas, PREGUNTAS)


def extract(spark: SparkSession, args: argparse.Namespace) -> None:
    """Answers per question and owner and year per question, as gzip Parquet."""
    table = parquet.read_columns(spark, args.posts, POST_COLUMNS)
    outputs = (
        (posts.answers_score(table), args.respuestas, RESPUESTAS),
        (posts.question_year(table), args.preguntas, PREGUNTAS),
    )
    for frame, path, schema in outputs:
        frame = frame.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
        if args.buckets:
            files.write_buckets(frame, path, "QuestionId", args.buckets)
            if args.report:
                print(f"{path}: {args.buckets} buckets, {len(files.written_files(spark, path))} files")
            continue
        partitions = files.write_gzip_parquet(frame, path)
        if args.report:
            found = files.written_files(spark, path)
            print(f"{path}: {partitions} partitions with rows, {len(found)} files")


def _write_by_user(report: DataFrame, args: argparse.Namespace, order: list[Column]) -> None:
    """The id orders users of one name and is not written."""
    shown = [c for c in report.columns if c != "UserId"]
    files.write_report(report, args.output, order, shown, args.single_file)


def user_years(spark: SparkSession, args: argparse.Namespace) -> None:
    """Yearly questions, answers and comments of every user, as CSV."""
    report = users.user_year_stats(
        _respuestas(spark, args),
        _preguntas(spark, args),
        parquet.read_columns(spark, args.users, USER_COLUMNS),
        parquet.read_columns(spark, args.comments, COMMENTS),
    )
    report = report.withColumn("MediaRespuestas", fixed_decimals(F.col("MediaRespuestas"), 2))
    _write_by_user(report, args, users.year_order())


def tag_ranks(spark: SparkSession, args: argparse.Namespace) -> None:
    """Questions of the given tags ranked by answers per tag and year, as CSV."""
    report = rankings.tag_year_rank(
        _respuestas(spark, args),
        _preguntas(spark, args),
        parquet.read_columns(spark, args.tags, TAGS),
        tag_list(args.wanted),
        args.ties,
    )
    order = [F.asc("Tag"), F.asc("Año"), F.desc("NRespuestas"), F.asc("QuestionId")]
    files.write_report(report, args.output, order, single_file=args.single_file)


def user_tags(spark: SparkSession, args: argparse.Namespace) -> None:
    """Questions per user, tag and year with the yearly change, as CSV."""
    report = users.user_tag_year_diff(
        _preguntas(spark, args),
        parquet.read_columns(spark, args.tags, TAGS),
        parquet.read_columns(spark, args.users, USER_COLUMNS),
        args.min_questions,
        args.calendar,
    )
    _write_by_user(report, args, users.tag_order())


def word_count(spark: SparkSession, args: argparse.Namespace) -> None:
    """Words of text files and their counts, tab-separated."""
    counts = words.word_count(text.read_lines(spark, *args.inputs))
    files.write_by_key(
        counts, args.output, "word", args.partitions, F.col("word"), F.col("count")
    )


def answer_counts(spark: SparkSession, args: argparse.Namespace) -> None:
    """Answers per question, tab-separated; ordered or only the top on demand."""
    table = _posts(spark, args)
    if args.top_k is not None:
        counts = posts.answer_counts_topk_buckets(table, args.top_k, args.num_buckets)
    elif args.ordered:
        counts = posts.answer_counts_ordered(table)
    else:
        counts = posts.answer_counts(table)
    files.write_key_values(counts, args.output, F.col("QuestionId"), F.col("AnswerCount"))


def answer_audit(spark: SparkSession, args: argparse.Namespace) -> None:
    """Questions whose declared number of answers is wrong, tab-separated."""
    wrong = posts.answer_audit(_posts(spark, args))
    files.write_key_values(wrong, args.output, *[F.col(c) for c in wrong.columns])


def year_tags(spark: SparkSession, args: argparse.Namespace) -> None:
    """Questions per year and tag: ``(year,tag) <tab> count``."""
    counts = tags.questions_by_year_tag(_posts(spark, args)).orderBy("year", "tag")
    tags.year_tag_lines(counts).write.mode("overwrite").text(args.output)


def question_owners(spark: SparkSession, args: argparse.Namespace) -> None:
    """Questions with reputation and name of their owner, from prefixed lines."""
    types = {f.name: f.dataType for f in USERS.fields}
    found = text.read_lines(spark, *args.inputs)
    columns = args.user_columns.split(",") if args.user_columns else csv.header_of(found, csv.USER_PREFIX)
    if not columns:
        raise SystemExit("the user lines have no header: name their columns with --user-columns")
    layout = T.StructType([T.StructField(c.strip(), types.get(c.strip(), T.StringType())) for c in columns])
    owned = owners.question_owner_tagged(found, POSTS, layout)
    owners.owner_lines(owned).write.mode("overwrite").text(args.output)


def tag_pairs(spark: SparkSession, args: argparse.Namespace) -> None:
    """Tags used together: ``tag1,tag2 <tab> count``, most frequent first."""
    counts = tags.tag_cooccurrence(_posts(spark, args), args.min_count)
    counts = counts.orderBy(F.desc("count"), "tag1", "tag2")
    tags.pair_lines(counts).write.mode("overwrite").text(args.output)


def tag_trends(spark: SparkSession, args: argparse.Namespace) -> None:
    """Trend of every tag over its last months, tab-separated."""
    trend = trends.tag_trend(_posts(spark, args), args.as_of, args.periods)
    trends.trend_lines(trend).write.mode("overwrite").text(args.output)


def convert(spark: SparkSession, args: argparse.Namespace) -> None:
    """A CSV dump of posts as Parquet, once: the other jobs then split it over tasks."""
    rows = csv.read_posts_csv(spark, args.posts, multi_line=args.multi_line, strict=args.strict)
    rows.write.mode("overwrite").parquet(args.output)


def lines(spark: SparkSession, args: argparse.Namespace) -> None:
    """Lines behind any URI with the file they come from, as Parquet."""
    found = text.read_lines(spark, *args.inputs, with_file=True)
    found.write.mode("overwrite").parquet(args.output)


def half(spark: SparkSession, args: argparse.Namespace) -> None:
    """The second half of a Parquet table in the order of columns that identify a row."""
    order = [c.strip() for c in args.order.split(",")]
    table = parquet.read_table(spark, args.input)
    lower_half(table, order).orderBy(*order).write.mode("overwrite").parquet(args.output)


def inspect(spark: SparkSession, args: argparse.Namespace) -> None:
    """Schema, first rows and number of rows of a Parquet table."""
    table = parquet.read_table(spark, args.input)
    table.printSchema()
    table.show(10)
    print(f"rows: {parquet.stored_row_counts(spark, {args.input: args.input}).first()['n_rows']}")


def sample(spark: SparkSession, args: argparse.Namespace) -> None:
    """A smaller version of a Parquet table."""
    if args.by_block:
        part = parquet.sample_by_block(spark, args.input, args.fraction, args.seed)
    else:
        part = parquet.sample_rows(parquet.read_table(spark, args.input), args.fraction, args.seed)
    part.write.mode("overwrite").parquet(args.output)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="run_job.py", description=__doc__)
    commands = top.add_subparsers(required=True, metavar="job")

    def job(function, *positional: str) -> argparse.ArgumentParser:
        command = commands.add_parser(function.__name__.replace("_", "-"), help=function.__doc__)
        command.set_defaults(run=function)
        for name in positional:
            command.add_argument(name, nargs="+" if name == "inputs" else None)
        return command

    def posts_job(function) -> argparse.ArgumentParser:
        command = job(function, "posts", "output")
        command.add_argument("--format", choices=("csv", "parquet"), default="csv")
        command.add_argument("--multi-line", action="store_true", help="quoted newlines in the CSV")
        command.add_argument("--strict", action="store_true", help="drop lines with any bad field")
        return command

    command = job(extract, "posts", "respuestas", "preguntas")
    command.add_argument("--report", action="store_true", help="count partitions and files")
    command.add_argument("--buckets", type=int, help="files by the hash of the question, which the reports join as they lie")
    command = job(user_years, "respuestas", "preguntas", "users", "comments", "output")
    command.add_argument("--single-file", action="store_true", help="one file, joined up from sorted parts")
    command = job(tag_ranks, "respuestas", "preguntas", "tags", "wanted", "output")
    command.add_argument("--single-file", action="store_true", help="one file, joined up from sorted parts")
    command.add_argument("--ties", choices=("rank", "dense_rank", "row_number"), default="rank")
    command = job(user_tags, "preguntas", "tags", "users", "output")
    command.add_argument("--single-file", action="store_true", help="one file, joined up from sorted parts")
    command.add_argument("--min-questions", type=int)
    command.add_argument("--calendar", action="store_true", help="compare with the calendar year before")
    command = job(word_count, "inputs", "output")
    command.add_argument("--partitions", type=int, default=3)
    command = posts_job(answer_counts)
    command.add_argument("--ordered", action="store_true")
    command.add_argument("--top-k", type=int)
    command.add_argument("--num-buckets", type=int, default=100)
    posts_job(answer_audit)
    posts_job(year_tags)
    command = job(question_owners, "inputs", "output")
    command.add_argument("--user-columns", help="names of the user columns, if the lines have no header")
    command = posts_job(tag_pairs)
    command.add_argument("--min-count", type=int, default=1)
    command = posts_job(tag_trends)
    command.add_argument("--as-of", help="last complete month, yyyy-MM")
    command.add_argument("--periods", type=int, default=6)
    command = job(convert, "posts", "output")
    command.add_argument("--multi-line", action="store_true", help="quoted newlines in the CSV")
    command.add_argument("--strict", action="store_true", help="drop records with any bad field")
    job(lines, "inputs", "output")
    command = job(half, "input", "output")
    command.add_argument("--order", required=True)
    job(inspect, "input")
    command = job(sample, "input", "output")
    command.add_argument("--fraction", type=float, default=0.1)
    command.add_argument("--seed", type=int, default=42)
    command.add_argument("--by-block", action="store_true", help="read only as many files as hold the fraction")
    return top


def main(argv: Sequence[str] | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(job_session(args.run.__name__), args)
