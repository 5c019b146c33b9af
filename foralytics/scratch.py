"""Intermediate tables in a folder that all executors share."""

import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``, else its warehouse folder.

    Both lie on the cluster's own file system. Everything of one application is
    kept in one sub-folder, so that it can be removed as a whole.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/scratch-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path no other run uses."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` once and read it back, so later actions do not recompute it."""
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, *paths: str) -> None:
    """Remove scratch tables whose readers have finished."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)


def write_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    """A small file on the path's file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray(content))
    finally:
        out.close()


def read_bytes(spark: SparkSession, path: str) -> bytes | None:
    """Content of a small file, None if there is none."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    source = jvm.org.apache.hadoop.fs.Path(path)
    fs = source.getFileSystem(conf)
    if not fs.exists(source):
        return None
    stream = fs.open(source)
    try:
        return bytes(stream.readAllBytes())
    finally:
        stream.close()
