"""Value canonicalisation: one projection per operator, no job."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates, text
from ..functions.missing import null_if_missing
from ..functions.names import col
from .columns import TEMPORAL, existing, require_columns, select_kind


def _rewrite(
    df: DataFrame, names: Iterable[str], change: Callable[[Column], Column]
) -> DataFrame:
    """Replace the named columns in place, keeping the column order."""
    chosen = set(names)
    if not chosen:
        return df
    return df.select(
        *[change(col(c)).alias(c) if c in chosen else col(c) for c in df.columns]
    )


def canonicalize_nulls(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    *,
    extra_sentinels: Sequence[str] | None = None,
) -> DataFrame:
    """Blank and sentinel text becomes NULL in the given string columns."""
    names = select_kind(df, columns, T.StringType)
    return _rewrite(df, names, lambda c: null_if_missing(c, extra_sentinels))


def trim_whitespace(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    *,
    collapse_internal: bool = True,
) -> DataFrame:
    """Trim string columns and, by default, squeeze inner whitespace."""
    names = select_kind(df, columns, T.StringType)
    return _rewrite(df, names, lambda c: text.tidy_spaces(c, collapse_internal))


def normalize_booleans(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    *,
    true_values: Sequence[str] | None = None,
    false_values: Sequence[str] | None = None,
    output_type: str = "boolean",
) -> DataFrame:
    """Yes/no text as booleans (other text NULL) or as true/false text (other
    text kept)."""
    if output_type not in ("boolean", "string"):
        raise ValueError(f"output_type must be boolean or string, not {output_type!r}")

    def change(value: Column) -> Column:
        truth = text.truth_value(value, true_values, false_values)
        if output_type == "boolean":
            return truth
        return F.coalesce(truth.cast("string"), value)

    return _rewrite(df, select_kind(df, columns, T.StringType), change)


def normalize_numeric_strings(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    *,
    output_type: str = "double",
) -> DataFrame:
    """Formatted number text as numbers; NULL where no number is left."""
    names = select_kind(df, columns, T.StringType)
    return _rewrite(df, names, lambda c: text.parse_number(c, output_type))


def standardize_datetimes_iso(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    *,
    output_format: str = dates.ISO_SECONDS,
) -> DataFrame:
    """Dates and timestamps as ISO text in the session time zone."""
    names = select_kind(df, columns, *TEMPORAL)
    return _rewrite(df, names, lambda c: F.date_format(c, output_format))


def parse_timestamps(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text columns as timestamps; NULL where the text does not parse."""
    names = require_columns(df, columns)
    return _rewrite(df, names, dates.lenient_timestamp)


def clamp_years(
    df: DataFrame, columns: Sequence[str], *, first: int = 1, last: int = 9999
) -> DataFrame:
    """Timestamps outside the year range become NULL; absent columns are skipped."""
    names = existing(df, columns)
    return _rewrite(df, names, lambda c: dates.keep_years(c, first, last))


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop by name; absent names are ignored."""
    return df.drop(*columns)
