"""Calendar expressions: clamps, terms, intervals and periods."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"

# The closed periods of the linkage trend.
LINKAGE_PERIODS = ((2010, 2015), (2016, 2020), (2021, 2025))
# The left-closed interval edges of the naming trend.
NAME_INTERVAL_EDGES = (2010, 2015, 2020, 2025)


def keep_years(value: Column, first: int = 1, last: int = 9999) -> Column:
    """NULL for a date outside the year range."""
    return F.when(F.year(value).between(first, last), value)


def lenient_timestamp(value: Column) -> Column:
    """Timestamp of ISO text (or of a timestamp); NULL where it does not parse."""
    return value.try_cast("timestamp")


def term(month: Column) -> Column:
    """Academic term of a month number."""
    return (
        F.when(month.between(1, 4), "Winter")
        .when(month.between(5, 8), "Summer")
        .when(month.isNotNull(), "Fall")
        .otherwise("Unknown")
    )


def year_term(value: Column) -> Column:
    """``2021 Winter``; just ``Unknown`` when there is no date."""
    return F.concat_ws(" ", F.year(value).cast("string"), term(F.month(value)))


def year_interval(year: Column, edges: Sequence[int] = NAME_INTERVAL_EDGES) -> Column:
    """Interval ``[edge, next edge)`` of a year, with open ends and Unknown."""
    label = F.when(year < edges[0], f"Before {edges[0]}")
    for low, high in zip(edges, edges[1:]):
        label = label.when(year < high, f"{low}-{high}")
    return label.when(year >= edges[-1], f"{edges[-1]}+").otherwise("Unknown")


def year_interval_order(edges: Sequence[int] = NAME_INTERVAL_EDGES) -> list[str]:
    inner = [f"{low}-{high}" for low, high in zip(edges, edges[1:])]
    return [f"Before {edges[0]}", *inner, f"{edges[-1]}+", "Unknown"]


def year_period(
    year: Column, periods: Sequence[tuple[int, int]] = LINKAGE_PERIODS
) -> Column:
    """Closed period holding a year; Other outside all, Unknown for NULL."""
    label = F.when(year.isNull(), "Unknown")
    for first, last in periods:
        label = label.when(year.between(first, last), f"{first}-{last}")
    return label.otherwise("Other")


def period_names(periods: Sequence[tuple[int, int]] = LINKAGE_PERIODS) -> list[str]:
    return [f"{first}-{last}" for first, last in periods]


def month_start(value: Column) -> Column:
    return F.date_trunc("month", value)
