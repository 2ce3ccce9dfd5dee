"""Status records of upstream tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas


def read_status(spark: SparkSession, path: str) -> DataFrame:
    """Status records stored one JSON object per line."""
    return spark.read.schema(schemas.STATUS).json(path)


def status_records(responses: DataFrame, domain: str) -> DataFrame:
    """Unfold poll responses, JSON objects of table to record, tagged with domain and table."""
    response = T.MapType(T.StringType(), schemas.STATUS_RECORD)
    return (
        responses.select(F.explode(F.from_json("value", response)).alias("table", "record"))
        .select("record.*", F.lit(domain).alias("domain"), "table")
    )
