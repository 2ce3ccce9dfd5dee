"""Delimited text for the log indexer: classified log lines and quality errors."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import as_date

# Texts looked for in a log line, exact in case, and the level each stands for.
LOG_LEVELS = {
    "Error": "ERROR",
    "WARN": "WARN",
    "NOTE": "NOTE",
    "Exception": "Exception",
}
LOG_CODE = "99"

# Code of a domain's quality errors, and the columns of an error line.
ERROR_CODES = {"transaction": "2000", "account": "2003"}
ERROR_COLUMNS = (
    "as_of_date", "source_type", "tbl_nm", "error_type", "null_count", "error_detail",
    "lst_updt_ts",
)
MISSING = "NULL"


def classify_log(
    lines: DataFrame,
    as_of: dt.date | str,
    domain: str,
    job: str,
    levels: dict[str, str] = LOG_LEVELS,
    upper_domain: bool = False,
) -> DataFrame:
    """Prefix each line with date, code, domain, job and level, once per level it shows.

    Lines that show none are left out. One pass over the log, no shuffle.
    """
    shown = F.array_compact(F.array(*[
        F.when(F.contains(F.col("value"), F.lit(text)), F.lit(level))
        for text, level in levels.items()
    ]))
    name = domain.upper() if upper_domain else domain
    head = f"{as_date(as_of)}|INFO|{LOG_CODE}|{name}|{domain}_{job}|"
    return lines.select("value", F.explode(shown).alias("level")).select(
        F.concat(F.lit(head), F.col("level"), F.lit("|"), F.col("value")).alias("value")
    )


def error_lines(errors: DataFrame, code: str) -> DataFrame:
    """Quality errors as bar-delimited lines, the code inserted after the date.

    Returns (as_of_date, value). Tabs inside a value turn into bars as well.
    """
    first, *rest = [
        F.coalesce(F.col(name).cast("string"), F.lit(MISSING)) for name in ERROR_COLUMNS
    ]
    line = F.concat_ws("|", first, F.lit("INFO"), F.lit(code), *rest)
    return errors.select("as_of_date", F.translate(line, "\t", "|").alias("value"))


def error_code(domain: str) -> str:
    if domain not in ERROR_CODES:
        raise ValueError(f"no error code is known for domain {domain!r}")
    return ERROR_CODES[domain]
