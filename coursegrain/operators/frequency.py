"""Counts by category: shares, top categories with a remainder, rare values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.measures import percent, row_count, share
from ..functions.names import col


def value_counts(df: DataFrame, *columns: str) -> DataFrame:
    """``columns..., n`` per non-NULL value combination."""
    counted = df
    for name in columns:
        counted = counted.where(col(name).isNotNull())
    return counted.groupBy(*[col(c) for c in columns]).agg(row_count().alias("n"))


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """Counts with ``pct``, the percent of the non-NULL rows."""
    counts = value_counts(df, column)
    total = counts.agg(F.sum("n")).scalar()
    return counts.select("*", percent(F.col("n"), total).alias("pct"))


def most_common(df: DataFrame, column: str, k: int) -> DataFrame:
    """The k most frequent values with their counts, ties by value."""
    return value_counts(df, column).orderBy(F.desc("n"), F.asc(column)).limit(k)


def top_with_other(df: DataFrame, column: str, k: int, other: str = "Other"):
    """``label, n, n_values``: the k most frequent values, then one row that sums
    the rest and tells how many distinct values it stands for."""
    counts = value_counts(df, column)
    top = counts.orderBy(F.desc("n"), F.asc(column)).limit(k)
    rest = counts.join(top.select(column), column, "left_anti")
    shown = top.select(
        col(column).cast("string").alias("label"), "n", F.lit(1).cast("long").alias("n_values")
    )
    remainder = rest.agg(
        F.lit(other).alias("label"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        row_count().alias("n_values"),
    )
    return shown.union(remainder)


def drop_rare(df: DataFrame, column: str, min_count: int = 2) -> DataFrame:
    """Rows whose value occurs at least ``min_count`` times; NULL rows stay.

    A rare value has few rows, so the values to drop meet the table in an anti join whose
    hot keys match nothing and can be split; NULL rows go round the join.
    """
    rare = value_counts(df, column).where(F.col("n") < min_count).select(column)
    held = df.where(col(column).isNotNull()).join(rare, column, "left_anti")
    return held.select(*map(col, df.columns)).union(df.where(col(column).isNull()))


def use_by_group(df: DataFrame, group: str, unit: str) -> DataFrame:
    """``group, n, n_units, intensity``: rows, distinct units using the group,
    and rows per unit."""
    return (
        df.where(col(group).isNotNull())
        .groupBy(col(group))
        .agg(row_count().alias("n"), F.count_distinct(col(unit)).alias("n_units"))
        .withColumn("intensity", share(F.col("n"), F.col("n_units")))
    )


def distinct_totals(df: DataFrame, **columns: str) -> DataFrame:
    """One row: ``n_rows`` and, per keyword, the distinct count of its column, from one
    reading of the table."""
    return df.agg(
        row_count().alias("n_rows"),
        *[F.count_distinct(col(c)).alias(name) for name, c in columns.items()],
    )


def items_per_key(
    df: DataFrame, key: str, counted: str, *, carried: str | None = None
) -> DataFrame:
    """``key, item_count``: non-NULL ``counted`` values per key; NULL keys are
    dropped. ``carried`` adds the smallest value of one more column."""
    extra = [F.min(col(carried)).alias(carried)] if carried else []
    return (
        df.where(col(key).isNotNull())
        .groupBy(col(key))
        .agg(F.count(col(counted)).alias("item_count"), *extra)
    )


def count_of_counts(per_key: DataFrame, count: str = "item_count") -> DataFrame:
    """``item_count, n_keys``: how many keys have each count."""
    return per_key.groupBy(count).agg(row_count().alias("n_keys"))


def complexity(per_key: DataFrame, count: str = "item_count") -> DataFrame:
    """One row on keys with one, several and three or more items."""
    n = F.col(count)
    return per_key.agg(
        row_count().alias("n_keys"),
        F.count_if(n == 1).alias("n_single"),
        F.count_if(n > 1).alias("n_multiple"),
        F.count_if(n >= 3).alias("n_three_plus"),
        F.avg(n).alias("mean_items"),
        F.max(n).alias("max_items"),
    ).select(
        "n_keys",
        "n_single",
        "n_multiple",
        "n_three_plus",
        percent(F.col("n_single"), F.col("n_keys")).alias("pct_single"),
        percent(F.col("n_multiple"), F.col("n_keys")).alias("pct_multiple"),
        "mean_items",
        "max_items",
    )


def split_by_flag(df: DataFrame, flag: Column) -> DataFrame:
    """One row ``n_positive, n_negative`` where ``flag`` marks the negatives;
    NULL is positive, so the two add up to all rows."""
    return df.agg(
        row_count().alias("n_rows"), F.count_if(flag).alias("n_negative")
    ).select((F.col("n_rows") - F.col("n_negative")).alias("n_positive"), "n_negative")


def status_long(df: DataFrame, flags: dict[str, Column]) -> DataFrame:
    """``requirement, status, n, pct``: Required and Not Required rows for each
    named flag, percent of all rows, from one aggregate."""
    row = df.agg(
        row_count().alias("n_rows"),
        *[F.count_if(flag).alias(f"f{i}") for i, flag in enumerate(flags.values())],
    )

    def line(i: int, name: str, status: str) -> Column:
        n = F.col(f"f{i}")
        n = n if status == "Required" else F.col("n_rows") - n
        return F.struct(
            F.lit(name).alias("requirement"),
            F.lit(status).alias("status"),
            n.alias("n"),
            percent(n, F.col("n_rows")).alias("pct"),
        )

    lines = [
        line(i, name, status)
        for i, name in enumerate(flags)
        for status in ("Required", "Not Required")
    ]
    return row.select(F.inline(F.array(*lines)))


def need_by_group(
    df: DataFrame, group: str, flag: Column, overall: str = "(all)"
) -> DataFrame:
    """``group, total, n_need, pct_need`` per non-NULL group, and one row over
    the whole frame (NULL groups included) labelled ``overall``."""
    figures = [row_count().alias("total"), F.count_if(flag).alias("n_need")]
    parts = df.groupBy(col(group).cast("string").alias(group)).agg(*figures)
    # The overall row sums the group rows; the table is read once.
    whole = parts.agg(
        F.lit(overall).alias(group),
        F.sum("total").alias("total"),
        F.sum("n_need").alias("n_need"),
    )
    return (
        parts.where(col(group).isNotNull())
        .union(whole.where("total is not null"))
        .withColumn("pct_need", percent(F.col("n_need"), F.col("total")))
    )


def weighted_mean(
    df: DataFrame, value: str, weight: str, by: Sequence[str] = ()
) -> DataFrame:
    """``by..., weighted_mean``: sum of value times weight over sum of weights,
    over rows having both; NULL when the weights sum to zero."""
    both = df.where(col(value).isNotNull() & col(weight).isNotNull())
    product = F.sum(col(value) * col(weight))
    return both.groupBy(*map(col, by)).agg(
        share(product, F.sum(col(weight))).alias("weighted_mean")
    )
