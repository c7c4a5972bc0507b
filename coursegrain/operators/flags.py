"""Boolean feature sets: prevalence, flags per row, co-occurrence, rates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.measures import percent, row_count
from ..functions.names import col
from ..functions.text import title_label


def on(flag: str) -> Column:
    """The flag with NULL as off."""
    return F.coalesce(col(flag), F.lit(False))


def flags_on(flags: Sequence[str]) -> Column:
    return reduce(add, [on(f).cast("int") for f in flags])


def _by_flag(row: DataFrame, flags: Sequence[str]) -> DataFrame:
    lines = [
        F.struct(
            F.lit(f).alias("flag"),
            title_label(F.lit(f)).alias("feature"),
            F.col(f"f{i}").alias("n"),
            percent(F.col(f"f{i}"), F.col("n_rows")).alias("pct"),
        )
        for i, f in enumerate(flags)
    ]
    return row.select(F.inline(F.array(*lines)))


def prevalence(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """``flag, feature, n, pct``: rows with each flag on, percent of all rows."""
    return _by_flag(
        df.agg(
            row_count().alias("n_rows"),
            *[F.count_if(on(f)).alias(f"f{i}") for i, f in enumerate(flags)],
        ),
        flags,
    )


def flags_per_row(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """``n_flags, n, pct``: how many rows have each number of flags on."""
    counts = df.groupBy(flags_on(flags).alias("n_flags")).agg(row_count().alias("n"))
    # One row for each number of flags: their total is a window over a handful.
    total = F.sum("n").over(Window.partitionBy())
    return counts.select("n_flags", "n", percent(F.col("n"), total).alias("pct"))


def many_flags(df: DataFrame, flags: Sequence[str], at_least: int = 3) -> DataFrame:
    """One row ``n_rows, n_many, pct_many``."""
    return df.agg(
        row_count().alias("n_rows"),
        F.count_if(flags_on(flags) >= at_least).alias("n_many"),
    ).withColumn("pct_many", percent(F.col("n_many"), F.col("n_rows")))


def cooccurrence(df: DataFrame, given: str, flags: Sequence[str]) -> DataFrame:
    """``flag, feature, n, pct`` among the rows where ``given`` is on."""
    others = [f for f in flags if f != given]
    subset = df.where(on(given))
    counted = prevalence(subset, others)
    return counted.withColumn("pct", F.coalesce("pct", F.lit(0.0)))


def rates_by_group(
    df: DataFrame, group: str, item: str, flags: Sequence[str], k: int
) -> DataFrame:
    """``group, n_items, n_rows, pct_<flag>...`` for the k groups with the most
    distinct items. One aggregate ranks the groups and holds their rates."""
    rates = df.where(col(group).isNotNull()).groupBy(col(group)).agg(
        F.count_distinct(col(item)).alias("n_items"),
        row_count().alias("n_rows"),
        *[(F.avg(on(f).cast("int")) * 100).alias(f"pct_{f}") for f in flags],
    )
    return rates.orderBy(F.desc("n_items"), F.asc(group)).limit(k)
