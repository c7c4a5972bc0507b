"""Shares and unit conversions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MEGABYTE = 1024 * 1024
GIGABYTE = 1024 * MEGABYTE


def row_count() -> Column:
    return F.count(F.lit(1))


def share(part: Column, whole: Column) -> Column:
    """Ratio as double; NULL when the whole is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percent(part: Column, whole: Column) -> Column:
    return share(part, whole) * 100


def minutes(seconds: Column) -> Column:
    return seconds / 60


def megabytes(size: Column) -> Column:
    return size / MEGABYTE


def gigabytes(size: Column) -> Column:
    return size / GIGABYTE


def megabits_per_second(size: Column, seconds: Column) -> Column:
    """NULL where there is no positive duration."""
    return F.try_divide(size * 8, F.when(seconds > 0, seconds)) / 1e6
