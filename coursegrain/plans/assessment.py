"""Quiz names over time, and how quizzes link to the gradebook."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates
from ..functions.measures import percent, row_count
from ..functions.names import col
from ..operators import crosstab, frequency, joins

TOP_NAMES = 10


def common_names(quizzes: DataFrame, *, name: str = "quiz_name", k: int = TOP_NAMES):
    return frequency.top_with_other(quizzes, name, k)


def _cells_of_common_names(df: DataFrame, row: str, name: str, k: int):
    """The common names, and their cells by ``row``."""
    top = frequency.most_common(df, name, k).select(name)
    return top, crosstab.row_percent_long(df.join(top, name, "left_semi"), row, name)


def names_by_term(
    quizzes: DataFrame,
    *,
    name: str = "quiz_name",
    created: str = "creation_date",
    k: int = TOP_NAMES,
) -> DataFrame:
    """``year_term, first_seen, name, n, pct``: every common name in every term, with
    its share of the term's common names, 0 where it does not occur. ``first_seen``
    sorts terms by when they begin."""
    when = dates.lenient_timestamp(col(created))
    rows = quizzes.select(
        col(name), when.alias("created"), dates.year_term(when).alias("year_term")
    )
    order = crosstab.bucket_order(rows, "year_term", "created")
    top, cells = _cells_of_common_names(rows, "year_term", name, k)
    return crosstab.full_matrix(cells, order, "year_term", top, name).select(
        "year_term", "first_seen", col(name), "n", "pct"
    )


def names_by_interval(
    quizzes: DataFrame,
    *,
    name: str = "quiz_name",
    created: str = "creation_date",
    k: int = TOP_NAMES,
    edges: Sequence[int] = dates.NAME_INTERVAL_EDGES,
) -> DataFrame:
    """``interval, name, n, pct, position``: every common name in every year interval
    that occurs, with its share of the interval's common names."""
    year = F.year(dates.lenient_timestamp(col(created)))
    rows = quizzes.select(col(name), dates.year_interval(year, edges).alias("interval"))
    top, cells = _cells_of_common_names(rows, "interval", name, k)
    intervals = cells.select("interval").distinct()
    full = crosstab.full_matrix(cells, intervals, "interval", top, name)
    return crosstab.in_given_order(full, "interval", dates.year_interval_order(edges))


def linked_share(quizzes: DataFrame, linked: Column) -> DataFrame:
    """One row: linked and unlinked counts and percents."""
    counts = quizzes.agg(
        row_count().alias("total"), F.count_if(linked).alias("linked")
    )
    unlinked = F.col("total") - F.col("linked")
    return counts.select(
        "total",
        "linked",
        unlinked.alias("not_linked"),
        percent(F.col("linked"), F.col("total")).alias("linked_pct"),
        percent(unlinked, F.col("total")).alias("not_linked_pct"),
    )


def course_linkage(
    quizzes: DataFrame,
    grades: DataFrame,
    *,
    course: str = "org_unit_id",
    link: str = "grade_object_id",
) -> DataFrame:
    """Courses with quizzes, with grade items, with both, linking, not linking."""
    return joins.linkage_summary(
        joins.key_linkage(quizzes, grades, course, col(link).isNotNull())
    )


def linkage_by_period(
    quizzes: DataFrame,
    *,
    created: str = "creation_date",
    link: str = "grade_object_id",
    periods: Sequence[tuple[int, int]] = dates.LINKAGE_PERIODS,
) -> DataFrame:
    year = F.year(dates.lenient_timestamp(col(created)))
    return crosstab.linked_by_period(
        quizzes,
        dates.year_period(year, periods),
        col(link).isNotNull(),
        dates.period_names(periods),
    )
