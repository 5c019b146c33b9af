"""CSV dumps of the forum tables.

Quotes inside a field are doubled and fields are stripped.  Every record is first read
as texts and then typed, so nothing is lost without a word: a record is dropped
only when it is the header, or when a field the caller requires is missing or does
not parse; ``strict`` drops every record with any bad field.  Reading line by line
fails on a line whose quotes are open at its end.  A record is parsed once, by a
generator in the plan that no filter and no projection crosses.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foralytics.schemas import POSTS, USERS
from foralytics.sources.csv_records import quote_count, read_records

# The CSV dialect, doubled quotes and stripped fields.
DIALECT = {
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
    "mode": "PERMISSIVE",
}
WRITING = {
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
CORRUPT = "_corrupt_record"


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    for name in columns:
        df = df.where(F.col(name).isNotNull())
    return df


def read_csv_table(
    spark: SparkSession,
    paths: str | list[str],
    schema: T.StructType,
    required: Sequence[str] = ("Id",),
    multi_line: bool = False,
    strict: bool = False,
    header: bool = True,
) -> DataFrame:
    """Records of CSV files with a positional schema.

    By default every line is one record, and a newline inside quotes is an error;
    ``multi_line`` accepts it, at the price of a pass that counts quotes. Large files
    are split over tasks either way. With ``header``, records whose
    first field is the name of the first column are headers, in any file or in none.
    ``strict`` drops records with too few or too many fields or any that does not parse.
    """
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields] + [T.StructField(CORRUPT, T.StringType())])
    records = read_records(spark, paths) if multi_line else whole_lines(spark.read.text(paths))
    rows = parsed(records, "value", texts, columnNameOfCorruptRecord=CORRUPT, multiLine="true")
    if header:
        first = schema.fields[0].name
        rows = rows.where(F.coalesce(F.trim(first) != first, F.lit(True)))
    return require(typed(rows, schema, strict), required)


def whole_lines(lines: DataFrame) -> DataFrame:
    """Lines as records; one that ends inside quotes fails the job."""
    value = F.col("value")
    whole = F.when(quote_count() % 2 == 0, value).otherwise(
        F.raise_error(F.concat(F.lit("a CSV record goes on after its line, read it with --multi-line: "), F.substring(value, 1, 200)))
    )
    return lines.where(F.length(F.trim(value)) > 0).select(whole.alias("value"))


def parsed(lines: DataFrame, value: str | Column, schema: T.StructType, **options: str) -> DataFrame:
    """One row a line in the columns of the schema, each line parsed once.

    The parsed struct goes through a generator of one row: what is asked of its fields
    later is asked of its output, where an expression would be parsed again for each use.
    """
    line = F.col(value) if isinstance(value, str) else value
    return lines.select(F.inline(F.array(parse_csv(line, schema, **options))))


def typed(rows: DataFrame, schema: T.StructType, strict: bool = False) -> DataFrame:
    """Texts in the types of the schema; what does not parse is NULL, or with ``strict`` drops its record."""
    values = {f.name: F.col(f.name).try_cast(f.dataType) for f in schema.fields}
    if strict:
        good = F.col(CORRUPT).isNull()
        for name, value in values.items():
            good &= value.isNotNull() | F.col(name).isNull() | (F.col(name) == "")
        rows = rows.where(good)
    return rows.select(*[value.alias(name) for name, value in values.items()])


def parse_csv(line: Column, schema: T.StructType, **options: str) -> Column:
    """Struct of one CSV line held in a column."""
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return F.from_csv(line, ddl, {**DIALECT, **options})


# A post is any record of a known type, also an answer without an id of its own.
POST_KEY = ("PostTypeId",)


def read_posts_csv(
    spark: SparkSession, paths: str | list[str], required: Sequence[str] = POST_KEY, **how: bool
) -> DataFrame:
    return read_csv_table(spark, paths, POSTS, required, **how)


def read_users_csv(
    spark: SparkSession, paths: str | list[str], schema: T.StructType | None = None, multi_line: bool = False
) -> DataFrame:
    """Users, picked by header name, or by position when ``schema`` is given."""
    if schema is not None:
        return read_csv_table(spark, paths, schema, multi_line=multi_line).select(*USERS.names)
    # Only the first record is read for the names.
    names = spark.read.options(**DIALECT, header=True, inferSchema=False, multiLine=multi_line).csv(paths).columns
    texts = T.StructType([T.StructField(name, T.StringType()) for name in names])
    rows = read_csv_table(spark, paths, texts, required=(), multi_line=multi_line)
    return require(typed(rows, USERS), ["Id"])


# The prefixes that tell the sources of a mixed file apart.
POST_PREFIX = "P|"
USER_PREFIX = "U|"


def tagged_lines(df: DataFrame, prefix: str) -> DataFrame:
    """Rows of ``df`` as CSV lines behind a source prefix."""
    line = F.to_csv(F.struct(*df.columns), WRITING)
    return df.select(F.concat(F.lit(prefix), line).alias("value"))


def header_of(lines: DataFrame, prefix: str, first: str = "Id") -> list[str] | None:
    """Column names of a source, from its header line if it has one."""
    start = F.col("value").startswith(f"{prefix}{first},")
    found = lines.where(start).select("value").first()
    return [c.strip().strip('"') for c in found["value"][len(prefix) :].split(",")] if found else None


def tagged_rows(
    lines: DataFrame, prefix: str, schema: T.StructType, required: Sequence[str] = ("Id",)
) -> DataFrame:
    """The rows of one source out of prefixed lines of several."""
    mine = lines.where(F.col("value").startswith(prefix))
    return require(parsed(mine, F.col("value").substr(len(prefix) + 1, 2**31 - 1), schema), required)


def tagged_structs(lines: DataFrame, **sources: tuple[str, T.StructType]) -> DataFrame:
    """A struct column for each source (prefix, schema), in one pass: of a line all but its own are NULL."""
    value = F.col("value")
    structs = [
        F.when(value.startswith(prefix), parse_csv(value.substr(len(prefix) + 1, 2**31 - 1), schema)).alias(name)
        for name, (prefix, schema) in sources.items()
    ]
    # One generator over all of them, so each line is parsed once and by one schema.
    return lines.select(F.inline(F.array(F.struct(*structs))))


def in_layout(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in the columns, order and types of a dump; absent columns are NULL."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def write_csv_table(df: DataFrame, path: str) -> None:
    """Write in the dialect the readers expect, with a header in every file."""
    df.write.mode("overwrite").options(header=True, **WRITING).csv(path)
