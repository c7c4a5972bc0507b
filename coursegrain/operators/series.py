"""Counts over calendar buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import month_start
from ..functions.measures import row_count
from ..functions.names import as_column


def year_counts(df: DataFrame, when: str | Column, last_year: int) -> DataFrame:
    """``year, n, part``: rows per year of a present date; ``part`` says whether
    the year is within the reporting horizon or after it."""
    return (
        df.groupBy(F.year(as_column(when)).alias("year"))
        .agg(row_count().alias("n"))
        .where(F.col("year").isNotNull())
        .withColumn(
            "part", F.when(F.col("year") <= last_year, "shown").otherwise("after")
        )
    )


def month_counts(df: DataFrame, when: str | Column) -> DataFrame:
    """``month_start, year, month, n`` for every month that has rows."""
    return (
        df.groupBy(month_start(as_column(when)).alias("month_start"))
        .agg(row_count().alias("n"))
        .where(F.col("month_start").isNotNull())
        .select(
            "month_start",
            F.year("month_start").alias("year"),
            F.month("month_start").alias("month"),
            "n",
        )
    )


def first_and_later(df: DataFrame, number: str | Column, when: str | Column) -> DataFrame:
    """One row: all events, those with number 1, the rest, and those with a
    usable date."""
    return df.agg(
        row_count().alias("n_events"),
        F.count_if(as_column(number) == 1).alias("n_initial"),
        F.count(as_column(when)).alias("n_dated"),
    ).select(
        "n_events",
        "n_initial",
        (F.col("n_events") - F.col("n_initial")).alias("n_subsequent"),
        "n_dated",
    )
