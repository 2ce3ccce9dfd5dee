"""The blank test: NULL, empty, the words null/NULL, or nothing but spaces."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Words that count as blank, matched exactly, beside empty and all-space text.
BLANK_WORDS = ("null", "NULL")

# A value of these types never prints as a blank text, so only NULL is blank.
_NULL_ONLY = (
    T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType,
    T.ArrayType, T.MapType, T.StructType,
)


def is_blank(column: Column, data_type: T.DataType | None = None) -> Column:
    """True for a blank value, never NULL.

    Giving the type of a number, date or nested column reduces the test to IS NULL,
    which spares formatting every value as text and can be pushed to the scan.
    """
    if isinstance(data_type, _NULL_ONLY):
        return column.isNull()
    text = column.cast("string")
    return text.isNull() | text.isin(*BLANK_WORDS) | (F.trim(text) == "")


def any_blank(df: DataFrame, fields: Sequence[str]) -> Column:
    """True where at least one of the named columns of ``df`` is blank."""
    types = df.select(*fields).schema
    return reduce(or_, [is_blank(F.col(name), types[i].dataType) for i, name in enumerate(fields)])


def normalise_space(df: DataFrame) -> DataFrame:
    """Strip ordinary and non-breaking spaces from both ends of every text column."""
    def strip(field):
        column = F.col(f"`{field.name}`")
        if not isinstance(field.dataType, T.StringType):
            return column
        return F.regexp_replace(column, r"^[ \u00a0]+|[ \u00a0]+$", "").alias(field.name)

    return df.select([strip(field) for field in df.schema])
