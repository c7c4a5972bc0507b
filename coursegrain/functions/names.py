"""References to columns whose names may hold dots, spaces or back-ticks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(name: str) -> Column:
    """Column called exactly ``name``: dots are not struct access."""
    return F.col("`" + name.replace("`", "``") + "`")


def as_column(value: str | Column) -> Column:
    return col(value) if isinstance(value, str) else value
