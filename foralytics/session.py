"""Spark session for the command-line jobs."""

from pyspark.sql import SparkSession


def job_session(name: str) -> SparkSession:
    """Session with the settings the jobs rely on; ``spark-submit`` sets the rest.

    AQE sizes the shuffle partitions, splits skewed join partitions and turns a
    join into a broadcast when the measured side is small enough.
    """
    spark = (
        SparkSession.builder.appName(name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("WARN")
    return spark
