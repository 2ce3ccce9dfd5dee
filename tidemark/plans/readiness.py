"""Freshness check of a domain: verdict, list of tables, published status."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import as_date, wall_clock
from tidemark.operators.freshness import READY, classify_freshness, readiness, verdict
from tidemark.sinks.partitions import replace_partitions


def check_domains(
    status: DataFrame, root: str, as_of: dt.date | str, now_utc: dt.datetime | str
) -> dict[str, str]:
    """Judge every domain's status records at a moment, write the lists, return the verdicts.

    READY writes the fresh tables to ``ready``; WAIT and FAILED write the stale ones to
    ``failed``. The status is read once and kept, so that verdicts and lists agree; the number
    of jobs does not depend on the number of domains.
    """
    judged = classify_freshness(status.where(F.col("domain").isNotNull()), as_of).persist()
    try:
        outcomes = {r["domain"]: r["verdict"] for r in readiness(judged, now_utc).collect()}
        for name, fresh in (("ready", True), ("failed", False)):
            domains = [d for d, outcome in outcomes.items() if (outcome == READY) == fresh]
            listed = judged.where(F.col("is_fresh") if fresh else ~F.col("is_fresh"))
            write_lists(listed.drop("is_fresh"), f"{root}/{name}", domains)
    finally:
        judged.unpersist()
    return outcomes


def check_domain(
    status: DataFrame, root: str, domain: str, as_of: dt.date | str, now_utc: dt.datetime | str
) -> str:
    """The same for one domain. One without records has no stale table."""
    own = status.where(F.col("domain") == domain)
    outcomes = check_domains(own, root, as_of, now_utc)
    if domain in outcomes:
        return outcomes[domain]
    outcome = status.sparkSession.range(1).select(
        verdict(F.lit(0), wall_clock(now_utc)).alias("verdict")).first()["verdict"]
    write_lists(own, f"{root}/{'ready' if outcome == READY else 'failed'}", [domain])
    return outcome


def write_lists(tables: DataFrame, root: str, domains: Sequence[str]) -> int:
    """Replace the lists of domains, one JSON object per table."""
    if not domains:
        return 0
    own = tables.where(F.col("domain").isin(list(domains)))
    return replace_partitions(own.hint("rebalance", "domain"), root, {"domain": domains}, "json")


def publish_status(
    status: DataFrame, root: str, as_of: dt.date | str, domain: str | None = None
) -> int:
    """Publish the fresh tables' records of a date, of one domain or of all in one write.

    A domain's end up in one file, or in several where it has very many tables.
    """
    own = status.where(F.col("domain").isNotNull() if domain is None else F.col("domain") == domain)
    domains = [domain] if domain is not None else [
        row["domain"] for row in own.select("domain").distinct().collect()]
    if not domains:
        return 0
    # The record has a time of its own under the name of the partition key.
    rows = classify_freshness(own, as_of).where("is_fresh").drop("is_fresh").withColumnRenamed(
        "as_of_date", "status_as_of_date")
    day = as_date(as_of)
    keyed = rows.withColumns({"as_of_date": F.lit(day), "dest_tbl": F.col("domain")})
    return replace_partitions(
        keyed.hint("rebalance", "dest_tbl"), root, {"as_of_date": [day], "dest_tbl": domains})
