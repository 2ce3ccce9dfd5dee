"""Watch a domain's readiness while status events keep arriving, and when none arrive any more."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.freshness import WAIT, status_summary
from tidemark.plans.readiness import check_domain

# Fixed value: time between two looks at the status.
POLL_INTERVAL = "60 seconds"
_EVENT = ("domain", "table", "status", "ts")


def watch_domain(
    events: DataFrame,
    root: str,
    domain: str,
    as_of: dt.date | str,
    clock: Callable[[], dt.datetime | str],
    checkpoint: str,
    every: str | None = POLL_INTERVAL,
    on_verdict: Callable[[str], None] = lambda verdict: None,
    expected: DataFrame | None = None,
) -> StreamingQuery:
    """Judge a domain after each batch of (domain, table, status, ts) events.

    Each batch rewrites the domain's ready or failed list from the summary of all
    events so far and reports the verdict; ``clock`` gives the moment in UTC. State
    holds one row of times per upstream table. ``expected`` (domain, table) names the tables
    that must report: those that have not yet are stale, so a domain of which nothing is
    heard is not ready.

    A batch needs something new, so a beat of one row joins the events: every interval has
    a batch, also after the last event, and the deadline is noticed in silence. Beats keep no
    state; a query that starts again judges at once by what its checkpoint holds.
    ``every=None`` handles what has arrived, without beats, and ends; a checkpoint serves one
    of the two kinds. The caller stops the query once the verdict is final, or leaves
    that to :func:`await_verdict`.
    """
    def judge(summary: DataFrame, batch_id: int) -> None:
        # The list and the verdict both read the summary, whose state is updated once.
        status = summary if expected is None else with_expected(summary, expected, domain)
        status.persist()
        try:
            on_verdict(check_domain(status, root, domain, as_of, clock()))
        finally:
            status.unpersist()

    arriving = events.select(*_EVENT)
    if every is None:
        trigger = {"availableNow": True}
    else:
        trigger = {"processingTime": every}
        arriving = arriving.unionByName(_beats(arriving))
    # A beat names no domain, so it is counted nowhere.
    return (
        status_summary(arriving.where(F.col("domain") == domain))
        .writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .foreachBatch(judge)
        .start()
    )


def await_verdict(
    events: DataFrame,
    root: str,
    domain: str,
    as_of: dt.date | str,
    clock: Callable[[], dt.datetime | str],
    checkpoint: str,
    every: str = POLL_INTERVAL,
    expected: DataFrame | None = None,
) -> str:
    """Watch until the domain is READY, or FAILED because the cut-off has come.

    A query that fails raises its error here. Started again with the same checkpoint it goes on
    from the events it has seen.
    """
    verdicts: list[str] = []
    query = watch_domain(
        events, root, domain, as_of, clock, checkpoint, every, verdicts.append, expected)
    try:
        while not (verdicts and verdicts[-1] != WAIT):
            if query.awaitTermination(0.2):
                raise RuntimeError(f"the watch of {domain} ended without a verdict")
    finally:
        query.stop()
    return next(verdict for verdict in verdicts if verdict != WAIT)


def with_expected(status: DataFrame, expected: DataFrame, domain: str) -> DataFrame:
    """A record for each expected table, with empty times where none is known; others stay."""
    wanted = expected.where(F.col("domain") == domain).select("domain", "table").distinct()
    return wanted.join(status, ["domain", "table"], "full").select(*status.columns)


def _beats(events: DataFrame) -> DataFrame:
    beats = events.sparkSession.readStream.format("rate-micro-batch").options(
        rowsPerBatch=1, numPartitions=1).load()
    return beats.select(*[F.lit(None).cast(events.schema[name].dataType).alias(name) for name in _EVENT])
