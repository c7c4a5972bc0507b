"""Detectors of personal data. Each is a builder from column names to a Column."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from .names import as_column

Detector = Callable[..., Column]

# The two detection patterns.
EMAIL_PATTERN = r"(?i)[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
STUDENT_ID_PATTERN = r"\bA\d{8}\b"


def pattern_detector(pattern: str, needs: str | None = None) -> Detector:
    """Detector that is true when any given column matches ``pattern``.

    ``needs`` is a character every match holds: texts without it are settled by a
    plain search, and only the others meet the regular expression.
    """

    def matches(value: Column) -> Column:
        found = value.rlike(pattern)
        return F.contains(value, F.lit(needs)) & found if needs else found

    def detect(*columns: str | Column) -> Column:
        if not columns:
            raise ValueError("a detector needs at least one column")
        return reduce(or_, (matches(as_column(c)) for c in columns))

    return detect


has_email_pattern = pattern_detector(EMAIL_PATTERN, needs="@")
has_student_id_pattern = pattern_detector(STUDENT_ID_PATTERN, needs="A")


def has_any_pii(*columns: str | Column) -> Column:
    """Email or student id in any given column."""
    return has_email_pattern(*columns) | has_student_id_pattern(*columns)
