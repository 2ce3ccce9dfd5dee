"""Compare rows an ingestion produced with rows readable afterwards."""

from __future__ import annotations

import datetime as dt

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.times import day_in, timestamp

# Fixed value: the message written when nothing went wrong.
NO_ERROR = " "
ROWS_DIFFER = "stored rows differ from the rows produced"


TARGET = ("dest_db", "dest_tbl")


def rows_print(df: DataFrame, leave_out: Sequence[str] = ("as_of_date",)) -> Column:
    """An aggregate that tells multisets of rows apart, in whatever order and parts they come.

    The sum of 64-bit hashes of whole rows, which no number of rows can overflow; 0 without
    rows. A column counts with its name's place in the alphabet, its value, and whether that is null,
    so neither a value that moved to a neighbour nor a reordered table is mistaken. Equal
    multisets have equal sums; different ones share theirs with a chance of one in 2^64.
    """
    names = sorted(set(df.columns) - set(leave_out))
    columns = [F.col("`" + name.replace("`", "``") + "`") for name in names]
    hashed = F.xxhash64(F.lit(len(names)), *[part for c in columns for part in (c, c.isNull())])
    return F.coalesce(F.sum(hashed.cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)")


def stored_counts(
    df: DataFrame, database: str, table: str, as_of: dt.date | str | None = None, prints: bool = False
) -> DataFrame:
    """Rows per snapshot as (dest_db, dest_tbl, as_of_date, dest_count).

    One row for ``as_of``, 0 when nothing is stored; one per date in ``df`` otherwise.
    Reads no column but the partition key, so row counts come from file footers. With ``prints``
    all columns are read for ``dest_print``, the :func:`rows_print` of each snapshot.
    """
    sizes = [F.count(F.lit(1)).alias("dest_count")] + [rows_print(df).alias("dest_print")] * prints
    if as_of is None:
        counted = df.groupBy("as_of_date").agg(*sizes)
    else:
        day = day_in(df, as_of)
        counted = df.where(F.col("as_of_date") == day).agg(*sizes).withColumn("as_of_date", day)
    return counted.select(
        F.lit(database).alias("dest_db"), F.lit(table).alias("dest_tbl"),
        F.col("as_of_date").cast("date"), "dest_count", *["dest_print"] * prints,
    )


def transform_counts(
    produced: DataFrame, stored: DataFrame, mapping: DataFrame, run_ts: dt.datetime | str
) -> DataFrame:
    """One metric row per target table and date, produced or stored.

    ``produced`` holds (dest_db, dest_tbl, as_of_date, src_count), ``stored`` what
    :func:`stored_counts` returns, ``mapping`` ingestion mapping rows, one per target. A
    date on one side only counts 0 on the other; a target that no mapping names fails the
    job. The inputs hold one row per table and date, never data rows. Every stored row
    counts as added; edits and deletes are not tracked and stay 0.

    Where ``produced`` has a ``src_print`` and ``stored`` a ``dest_print``, both of
    :func:`rows_print`, the message of a date also tells whether its rows are the same, whatever
    their numbers; a side that has none of a date counts as one without rows.
    """
    names = mapping.select(
        F.col("source_database").alias("src_db"),
        F.col("source_table").alias("src_tbl"),
        F.col("target_database").alias("dest_db"),
        F.col("target_table").alias("dest_tbl"),
        F.lit(True).alias("is_mapped"),
    )
    unmapped = F.raise_error(F.concat(
        F.lit("no mapping names the table "), F.concat_ws(".", *TARGET)))
    untracked = F.lit(0).cast("long")
    message = F.lit(NO_ERROR)
    if "src_print" in produced.columns and "dest_print" in stored.columns:
        differ = F.coalesce("src_print", F.lit(0)) != F.coalesce("dest_print", F.lit(0))
        message = F.when(differ, ROWS_DIFFER).otherwise(NO_ERROR)
    counted = (
        produced.join(stored, [*TARGET, "as_of_date"], "full")
        .join(names, [*TARGET], "left")
        .withColumns({
            "src_count": F.when(F.col("is_mapped"), F.coalesce("src_count", untracked))
            .otherwise(unmapped),
            "dest_count": F.coalesce("dest_count", untracked),
        })
        .withColumns({
            "dest_add": F.col("dest_count"),
            "lst_updt_ts": timestamp(run_ts),
            "error_msg": message,
        })
    )
    zeros = set(schemas.TRANSFORM_COUNTS.names) - set(counted.columns)
    return counted.withColumns({name: untracked for name in sorted(zeros)}).select(
        *schemas.TRANSFORM_COUNTS.names
    )
