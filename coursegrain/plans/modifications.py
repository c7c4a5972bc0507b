"""Media revisions over time."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.dates import lenient_timestamp
from ..functions.names import col
from ..operators import ranking, series

LAST_YEAR = 2025
RECENT_MONTHS = 60

_WHEN = "last_modified"


def revision_events(media: DataFrame) -> DataFrame:
    return series.first_and_later(media, "revision_number", lenient_timestamp(col(_WHEN)))


def by_year(media: DataFrame, *, last_year: int = LAST_YEAR) -> DataFrame:
    return series.year_counts(media, lenient_timestamp(col(_WHEN)), last_year)


def by_month(media: DataFrame) -> DataFrame:
    return series.month_counts(media, lenient_timestamp(col(_WHEN)))


def recent_months(media: DataFrame, *, months: int = RECENT_MONTHS) -> DataFrame:
    """The last months that have revisions, not calendar months."""
    return ranking.last_buckets(by_month(media), "month_start", months)
