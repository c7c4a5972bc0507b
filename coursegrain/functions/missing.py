"""What counts as a missing value, and how to turn it into NULL."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that mean "no value", compared after trim and lower.
MISSING_SENTINELS = (
    "n/a",
    "na",
    "n.a.",
    "none",
    "null",
    "unknown",
    "unspecified",
    "missing",
)


def blank_or_sentinel(value: Column, extra: Iterable[str] | None = None) -> Column:
    """True for space-only text and for sentinel text; NULL stays NULL."""
    words = ["", *MISSING_SENTINELS, *(w.lower() for w in extra or ())]
    return F.lower(F.trim(value)).isin(list(dict.fromkeys(words)))


def is_missing(value: Column, dtype: T.DataType) -> Column:
    """NULL in any column; also blank or sentinel text in a string column."""
    if isinstance(dtype, T.StringType):
        return value.isNull() | blank_or_sentinel(value)
    return value.isNull()


def null_if_missing(value: Column, extra: Iterable[str] | None = None) -> Column:
    return F.when(~blank_or_sentinel(value, extra), value)


def is_filled(value: Column) -> Column:
    """Present and not the empty string; never NULL."""
    return value.isNotNull() & (value != "")


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)
