"""Text and time clean-up, one expression per rule."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.schema import TIMESTAMP_FORMAT


def trimmed(value: Column) -> Column:
    """Strips spaces only, no other white space."""
    return F.trim(value)


def upper_code(value: Column) -> Column:
    return F.upper(value)


def digits_only(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def as_double(value: Column) -> Column:
    """NULL where the value is no number, also under ANSI mode."""
    return value.try_cast("double")


def as_timestamp(value: Column, data_type: T.DataType) -> Column:
    """Parses text; a column that already is a timestamp passes through."""
    if isinstance(data_type, T.StringType):
        return F.try_to_timestamp(value, F.lit(TIMESTAMP_FORMAT))
    return value


def hour_label(hour: Column) -> Column:
    """Two-digit hour text, as in the stored list of active hours."""
    return F.lpad(hour.cast("string"), 2, "0")
