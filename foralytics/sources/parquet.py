"""Parquet tables, samples and a first look at a table."""

import hashlib
import json
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foralytics.schemas import check_layout, check_schema
from foralytics.scratch import read_bytes

# Beside the files of a bucketed table: its key and number of buckets. Readers of the folder pass over it.
LAYOUT = "_buckets.json"


def read_table(
    spark: SparkSession, path: str, expected: T.StructType | None = None
) -> DataFrame:
    """A Parquet table; with ``expected``, columns and types are checked first."""
    df = spark.read.parquet(path)
    return df if expected is None else check_schema(df, expected)


def read_buckets(spark: SparkSession, path: str, expected: T.StructType | None = None) -> DataFrame:
    """A table of :func:`foralytics.sinks.files.write_buckets` whose files Spark knows as buckets of the key.

    Joins and groups by the key take them as they lie. A plain Parquet table is read
    as one, so a job need not know how its input was written.
    """
    layout = read_bytes(spark, f"{path.rstrip('/')}/{LAYOUT}")
    if layout is None:
        return read_table(spark, path, expected)
    how, plain = json.loads(layout), spark.read.parquet(path)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields)
    name = f"buckets_{uuid.uuid4().hex}"
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{how['key']}`) SORTED BY (`{how['key']}`) "
        f"INTO {how['buckets']} BUCKETS LOCATION '{path}'"
    )
    df = spark.table(name)
    # The frame keeps the layout; dropping an external table leaves its files.
    spark.sql(f"DROP TABLE {name}")
    return df if expected is None else check_schema(df, expected)


def read_columns(spark: SparkSession, path: str, needed: T.StructType) -> DataFrame:
    """A Parquet table that has at least the ``needed`` columns, in like types."""
    return check_layout(spark.read.parquet(path), needed)


def drawn(key: Column, fraction: float, seed: int) -> Column:
    """Whether the text of a key falls into the sample."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), key))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") < int(fraction * 2**32)


def sample_rows(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """A smaller version of a table for quick trials.

    The draw depends on the values of the row alone, in the order of the column
    names, so repeating it on other partitions gives the same rows; equal rows
    are drawn together.
    """
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in sorted(df.columns)]
    return df.where(drawn(F.concat_ws(",", *texts), fraction, seed))


def sample_by_key(df: DataFrame, key: str, fraction: float, seed: int = 42) -> DataFrame:
    """A sample of whole keys: every row of a drawn key is kept.

    The draw depends on the key alone, so tables sampled by the same key still
    join, and repeating it on other partitions gives the same rows.
    """
    return df.where(drawn(F.col(key).cast("string"), fraction, seed))


def stored_files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(path, bytes) of the files that a Parquet reader finds, by path, from their listing."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    found = []
    for file in spark.read.parquet(path).inputFiles():
        place = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
        found.append((file, place.getFileSystem(conf).getFileStatus(place).getLen()))
    return sorted(found)


def sample_by_block(spark: SparkSession, path: str, fraction: float, seed: int = 42) -> DataFrame:
    """About a ``fraction`` of a Parquet table, out of the fewest files that hold as much of its bytes.

    Files are taken in the order of a hash of their name, so repeating it gives the same rows. All
    but the last are taken whole, and of that one rows are drawn by their values, at the
    rate that is still missing: the bytes taken differ from the fraction only by what
    that draw is off, which is within one file. Rows that lie together are taken
    together, so it suits trials and not estimates of tables that are sorted.
    """
    files = stored_files(spark, path)
    wanted = fraction * sum(size for _, size in files)
    order = sorted(files, key=lambda f: hashlib.md5(f"{seed}:{f[0].rsplit('/', 1)[-1]}".encode()).digest())
    whole, rate, last = [], 0.0, None
    for name, size in order:
        if size > wanted:
            last, rate = name, wanted / size
            break
        whole.append(name)
        wanted -= size
    schema = spark.read.parquet(path).schema
    reader = spark.read.schema(schema)
    if files and files[0][0].rstrip("/").rsplit("/", 1)[-1] != path.rstrip("/").rsplit("/", 1)[-1]:
        # Of a folder, so that columns in the names of its folders are kept.
        reader = reader.option("basePath", path)
    parts = [reader.parquet(*whole)] if whole else []
    if last and rate > 0:
        parts.append(sample_rows(reader.parquet(last), rate, seed))
    return reduce(DataFrame.unionAll, parts) if parts else spark.createDataFrame([], schema)


def first_rows(df: DataFrame, order: list[str], n: int = 10) -> DataFrame:
    return df.orderBy(*order).limit(n)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


# Settings under which Spark answers counts, minima and maxima from the footers of Parquet files.
FOOTER_READS = {"spark.sql.parquet.aggregatePushdown": "true", "spark.sql.sources.useV1SourceList": "avro,csv,json,orc,text"}


def stored_row_counts(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """One row per Parquet table with its number of rows, from the footers of its files alone.

    The frame lives in a session of its own, whose reader pushes the count into the
    scan; the settings of ``spark`` stay as they are.
    """
    session = spark.newSession()
    for name, value in FOOTER_READS.items():
        session.conf.set(name, value)
    counts = row_counts({name: session.read.parquet(path) for name, path in paths.items()})
    # Without a row group there is no count to add up; Spark takes the count for never NULL, a sum may be.
    return counts.groupBy("table_name").agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"))
