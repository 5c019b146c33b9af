"""Text files as rows, one per line."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, *paths: str, with_file: bool = False) -> DataFrame:
    """Lines of one or more paths, globs or URIs of any file system Spark knows.

    Compressed files are recognised by their extension; bzip2 files are split
    like plain text.
    """
    lines = spark.read.text(list(paths))
    if with_file:
        return lines.select(F.col("_metadata.file_path").alias("file"), "value")
    return lines
