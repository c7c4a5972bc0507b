"""Organisational units: kinds, ratios, cross-listing hints, activation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import lenient_timestamp
from ..functions.measures import row_count, share
from ..functions.names import col
from ..functions.text import has_keyword, token_count
from ..operators import crosstab, frequency, ranking

COURSE, SECTION, GROUP = "Course Offering", "Section", "Group"
CROSS_LIST_WORD = "x-list"
SAMPLE_ROWS = 10
START_YEARS = 15


def usual_types(units: DataFrame, *, kind: str = "type") -> DataFrame:
    """Units without the types that occur once."""
    return frequency.drop_rare(units, kind)


def type_counts(units: DataFrame, *, kind: str = "type") -> DataFrame:
    return frequency.value_counts(units, kind)


def ratios(
    units: DataFrame,
    *,
    kind: str = "type",
    kinds: tuple[str, str, str] = (COURSE, SECTION, GROUP),
) -> DataFrame:
    """One row of global counts, ratios (NULL over zero) and a difference."""
    counts = units.agg(
        *[
            F.count_if(col(kind) == value).alias(name)
            for name, value in zip(("n_courses", "n_sections", "n_groups"), kinds)
        ]
    )
    courses, sections, groups = map(F.col, counts.columns)
    return counts.select(
        "*",
        share(sections, courses).alias("sections_per_course"),
        share(groups, courses).alias("groups_per_course"),
        share(groups, sections).alias("groups_per_section"),
        (sections - courses).alias("sections_minus_courses"),
    )


def of_kind(units: DataFrame, value: str = COURSE, *, kind: str = "type") -> DataFrame:
    return units.where(col(kind) == value)


def with_cross_list_hints(
    courses: DataFrame, *, code: str = "code", name: str = "name"
) -> DataFrame:
    """Add ``code_token_count`` and ``has_xlist_keyword``."""
    return courses.select(
        "*",
        token_count(col(code)).alias("code_token_count"),
        has_keyword(col(name), CROSS_LIST_WORD).alias("has_xlist_keyword"),
    )


def cross_list_counts(hinted: DataFrame) -> DataFrame:
    return hinted.agg(
        F.count_if(F.col("code_token_count") > 1).alias("n_many_tokens"),
        F.count_if("has_xlist_keyword").alias("n_keyword"),
    )


def token_distribution(hinted: DataFrame, *, k: int = 10) -> DataFrame:
    return frequency.most_common(hinted, "code_token_count", k)


def cross_list_sample(
    hinted: DataFrame, *, key: str = "org_unit_id", k: int = SAMPLE_ROWS
) -> DataFrame:
    return ranking.first_rows(
        hinted.where(F.col("code_token_count") > 1).select(
            key, "name", "code", "code_token_count"
        ),
        [F.asc(key)],
        k,
    )


def active_by(units: DataFrame, group: str | Column = "type") -> DataFrame:
    return crosstab.active_by_group(units, group, "is_active")


def active_shares(courses: DataFrame) -> DataFrame:
    """``is_active, n, pct`` with the percent rounded to one place."""
    return frequency.value_shares(courses, "is_active").withColumn(
        "pct", F.round("pct", 1)
    )


def active_by_start_year(courses: DataFrame, *, k: int = START_YEARS) -> DataFrame:
    """The last k start years that have courses."""
    year = F.year(lenient_timestamp(col("start_date")))
    return ranking.last_buckets(active_by(courses, year), "group_value", k)


def group_sample(units: DataFrame, *, k: int = SAMPLE_ROWS) -> DataFrame:
    groups = of_kind(units, GROUP).select("org_unit_id", "name", "code", "is_active")
    return ranking.first_rows(groups, [F.asc("org_unit_id")], k)
