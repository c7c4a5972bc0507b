"""Quiz configuration flags overall, together, and by school."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..functions.names import col
from ..functions.text import leading_word
from ..operators import flags, joins
from ..operators.columns import existing

# The configuration flags looked at.
QUIZ_FLAGS = (
    "has_password",
    "ip_restricted",
    "time_limit_enforced",
    "prevent_moving_backwards",
    "allow_hints",
    "display_in_calendar",
    "is_retake_incorrect_only",
)
GIVEN_FLAG = "ip_restricted"
MANY = 3
TOP_SCHOOLS = 15
NO_SCHOOL = "UNKNOWN"


def feature_use(quizzes: DataFrame, names: Sequence[str] = QUIZ_FLAGS) -> DataFrame:
    return flags.prevalence(quizzes, existing(quizzes, names))


def features_per_quiz(quizzes: DataFrame, names: Sequence[str] = QUIZ_FLAGS) -> DataFrame:
    return flags.flags_per_row(quizzes, existing(quizzes, names))


def many_features(
    quizzes: DataFrame, names: Sequence[str] = QUIZ_FLAGS, *, at_least: int = MANY
) -> DataFrame:
    return flags.many_flags(quizzes, existing(quizzes, names), at_least)


def features_given(
    quizzes: DataFrame, given: str = GIVEN_FLAG, names: Sequence[str] = QUIZ_FLAGS
) -> DataFrame:
    return flags.cooccurrence(quizzes, given, existing(quizzes, names))


def schools(units: DataFrame) -> DataFrame:
    """``org_unit_id, school``: the course-code family of each unit."""
    school = leading_word(col("code"), col("name"), default=NO_SCHOOL)
    return units.select("org_unit_id", school.alias("school"))


def school_rates(
    quizzes: DataFrame,
    units: DataFrame,
    names: Sequence[str] = QUIZ_FLAGS,
    *,
    k: int = TOP_SCHOOLS,
) -> DataFrame:
    """Flag rates of the k schools with the most quizzes."""
    used = existing(quizzes, names)
    slim = quizzes.select("org_unit_id", "quiz_id", *used)
    placed = joins.left_join_default(slim, schools(units), "org_unit_id", "school", NO_SCHOOL)
    return flags.rates_by_group(placed, "school", "quiz_id", used, k)
