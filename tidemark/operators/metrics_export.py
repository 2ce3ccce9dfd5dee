"""The 21-column metric report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.reconcile import TARGET

# Report columns in order, and the text for "no earlier snapshot".
EXPORT_COLUMNS = (
    "as_of_date", "src_db", "src_tbl", "src_count", "src_add", "src_edit", "src_delete",
    "dest_db", "dest_tbl", "dest_count", "dest_add", "dest_edit", "dest_delete",
    "dest_edit_add", "dest_delete_add", "dest_add_change", "lst_updt_ts", "yest_count",
    "today_total", "yest_ingest_dt", "today_count",
)
NO_DATE = "NULL"


def metrics_export(counts: DataFrame, previous: DataFrame, mapping: DataFrame) -> DataFrame:
    """Counts of the mapped tables with the date of each table's previous snapshot.

    ``counts`` holds transform-count rows, ``previous`` (dest_db, dest_tbl, as_of_date,
    yest_ingest_dt), ``mapping`` metric mapping rows of one batch. All of them have at
    most one row per table and date; tables of one name in several databases are different. The count of the previous day is not kept, so 0.
    """
    wanted = mapping.select(
        F.col("target_database").alias("dest_db"), F.col("target_table").alias("dest_tbl"))
    return (
        counts.join(wanted, [*TARGET], "left_semi")
        .join(previous, [*TARGET, "as_of_date"], "left")
        .withColumns({
            "lst_updt_ts": F.col("lst_updt_ts").cast("string"),
            "yest_count": F.lit(0),
            "today_total": F.col("dest_count"),
            "today_count": F.col("dest_count"),
            "yest_ingest_dt": F.coalesce(F.col("yest_ingest_dt").cast("string"), F.lit(NO_DATE)),
        })
        .select(*EXPORT_COLUMNS)
    )
