"""Parquet, CSV and tab-separated output."""

import json
import uuid
from collections.abc import Sequence

from pyspark.errors import UnsupportedOperationException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from foralytics.scratch import discard, write_bytes
from foralytics.sources.csv import WRITING
from foralytics.sources.parquet import LAYOUT

OrderKey = str | Column


def write_buckets(df: DataFrame, path: str, key: str, buckets: int | None = None, grouped: bool = False) -> None:
    """Gzip Parquet in ``buckets`` files by the hash of ``key``, each sorted by it, for :func:`read_buckets`.

    Tables in the same number of buckets are joined by the key without another
    shuffle. By default there are as many as shuffle partitions; with ``grouped`` the rows
    lie in these already, as they do behind a ``groupBy`` of the key, and are not moved again.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = df if grouped else df.repartition(buckets, key)
    name = f"buckets_{uuid.uuid4().hex}"
    discard(spark, path)
    writer = placed.write.format("parquet").bucketBy(buckets, key).sortBy(key)
    writer.option("compression", "gzip").option("path", path).saveAsTable(name)
    # The layout goes beside the files; the table's name is of no use to another job.
    spark.sql(f"DROP TABLE {name}")
    write_bytes(spark, f"{path}/{LAYOUT}", json.dumps({"key": key, "buckets": buckets}).encode())


def write_gzip_parquet(df: DataFrame, path: str) -> int:
    """Gzip Parquet; returns the number of partitions that had rows, counted during the write."""
    seen = Observation()
    # One number for each task.
    placed = df.withColumn("_partition", F.spark_partition_id())
    watched = placed.observe(seen, F.collect_set("_partition").alias("partitions")).drop("_partition")
    watched.write.mode("overwrite").option("compression", "gzip").parquet(path)
    return len(seen.get["partitions"])


def write_report(
    df: DataFrame, path: str, order: Sequence[OrderKey], columns: Sequence[str] | None = None, single_file: bool = False
) -> None:
    """Ordered, uncompressed CSV with a header in every file.

    The rows are sorted once, by all tasks: into part files whose names follow the order
    of the rows, which ``single_file`` then joins up. ``columns`` are the ones written; ``order``
    may use others.
    """
    placed = df.orderBy(*order)
    report = placed.select(*columns) if columns else placed
    writer = report.write.mode("overwrite").options(header=not single_file, compression="none", **WRITING)
    if not single_file:
        writer.csv(path)
        return
    spark = df.sparkSession
    discard(spark, path)
    # A name that readers of the folder pass over.
    parts = f"{path.rstrip('/')}/_parts"
    writer.csv(parts)
    join_files(spark, header_line(report.columns), parts, f"{path.rstrip('/')}/part-00000.csv")
    discard(spark, parts)


def header_line(names: Sequence[str]) -> bytes:
    """Names as a line of CSV."""
    quoted = ['"' + n.replace('"', '""') + '"' if set(n) & set(',"\n\r') or n != n.strip() else n for n in names]
    return (",".join(quoted) + "\n").encode()


def join_files(spark: SparkSession, head: bytes, folder: str, target: str) -> None:
    """``head`` and then the data files of a folder, by name, as one file.

    A file system that can join files does so without moving a byte (HDFS does).
    Others have no way but to copy the bytes in a row, through a buffer of 1 MB.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(target)
    fs = place.getFileSystem(conf)
    parts = [jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}") for name in written_files(spark, folder)]
    parts = [p for p in parts if fs.getFileStatus(p).getLen() > 0]
    write_bytes(spark, target, head)
    if not parts:
        return
    sources = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(parts))
    for i, part in enumerate(parts):
        sources[i] = part
    try:
        fs.concat(place, sources)
    except UnsupportedOperationException:
        _copy_in_a_row(spark, fs, head, parts, place)


def _copy_in_a_row(spark: SparkSession, fs, head: bytes, parts: list, place) -> None:
    out = fs.create(place, True)
    try:
        out.write(bytearray(head))
        for part in parts:
            source = fs.open(part)
            try:
                spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, 1 << 20, False)
            finally:
                source.close()
    finally:
        out.close()


def escaped(text: Column) -> Column:
    """One line and one field: backslash, tab, newline and carriage return as backslash sequences."""
    for raw, sign in (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")):
        text = F.replace(text, F.lit(raw), F.lit(sign))
    return text


def key_value_lines(df: DataFrame, *fields: Column) -> DataFrame:
    """Tab-separated text lines, one per row; a NULL field is left empty, others are escaped."""
    texts = [F.coalesce(escaped(f.cast("string")), F.lit("")) for f in fields]
    return df.select(F.concat_ws("\t", *texts).alias("value"))


def write_key_values(df: DataFrame, path: str, *fields: Column) -> None:
    """Tab-separated text in the partitions and the order ``df`` has."""
    key_value_lines(df, *fields).write.mode("overwrite").text(path)


def write_by_key(df: DataFrame, path: str, key: str, files: int, *fields: Column) -> None:
    """Tab-separated text in a fixed number of files, sorted by key in each."""
    placed = by_key(df, key, files)
    write_key_values(placed, path, *fields)


def by_key(df: DataFrame, key: str, partitions: int) -> DataFrame:
    """Hash partitions by key, each in the lexicographic order of its keys."""
    text = F.col(key).cast("string")
    return df.repartition(partitions, key).sortWithinPartitions(text)


def partition_report(df: DataFrame) -> DataFrame:
    """Rows of every non-empty partition of a frame."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def written_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the data files under a path, with rows or without, from its file system."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    names = [status.getPath().getName() for status in found]
    return sorted(n for n in names if not n.startswith(("_", ".")))


def file_report(spark: SparkSession, path: str) -> DataFrame:
    """Rows of every non-empty Parquet file under a path."""
    return (
        spark.read.parquet(path)
        .groupBy(F.col("_metadata.file_name").alias("file"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
