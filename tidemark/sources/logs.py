"""Job logs as lines of text."""

from pyspark.sql import DataFrame, SparkSession


def read_log(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.text(list(paths))
