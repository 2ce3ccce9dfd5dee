"""Deliver the log of running jobs piece by piece, every line once."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.times import as_date
from tidemark.operators.text_lines import classify_log
from tidemark.sinks.partitions import replace_partition


def arriving_log(spark: SparkSession, folder: str, files_at_once: int = 1000) -> DataFrame:
    """Lines of the files that appear in a folder, each read once.

    A file must be whole when it appears: jobs write elsewhere and move, or rotate. What is
    added to a file later is not seen.
    """
    return spark.readStream.option("maxFilesPerTrigger", files_at_once).text(folder)


def deliver_log(
    lines: DataFrame,
    root: str,
    as_of: dt.date | str,
    domain: str,
    job: str,
    checkpoint: str,
    every: str | None = None,
    upper_domain: bool = False,
) -> StreamingQuery:
    """Classify arriving lines and deliver each batch as a partition of its own.

    The partition is named by date, job and the number of the batch, which the checkpoint
    keeps. A batch that is repeated after a crash has the same number and the same lines, and takes
    the place of what it left: no line is lost, none is delivered twice. ``every=None``
    delivers what has arrived and ends. There is no shuffle and no state.
    """
    def deliver(batch: DataFrame, batch_id: int) -> None:
        classified = classify_log(batch, as_of, domain, job, upper_domain=upper_domain)
        replace_partition(
            classified, root,
            {"as_of_date": as_date(as_of), "job": f"{domain}_{job}", "batch": batch_id}, "text")

    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return (
        lines.writeStream.option("checkpointLocation", checkpoint)
        .trigger(**trigger).foreachBatch(deliver).start()
    )
