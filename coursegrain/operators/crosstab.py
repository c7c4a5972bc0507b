"""Two-way tables with row shares, and period tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.measures import percent, row_count
from ..functions.names import as_column, col


def pivot_row_percent(
    df: DataFrame, row: str, column: str, values: Sequence[str]
) -> DataFrame:
    """Rows by the given column values: a count ``n_<i>`` and a percent of the
    row's total ``pct_<i>`` for value i, absent cells 0, and the count of all other
    values ``n_other``, which is part of the total. NULLs are left out.

    The values are given, so the table is one aggregate and no job looks for them.
    """
    wanted = df.where(col(row).isNotNull() & col(column).isNotNull())
    counts = wanted.groupBy(col(row)).agg(
        *[F.count_if(col(column) == v).alias(f"n_{i}") for i, v in enumerate(values)],
        F.count_if(~col(column).isin(list(values))).alias("n_other"),
    )
    total = reduce(add, [F.col(f"n_{i}") for i in range(len(values))], F.col("n_other"))
    return counts.select(
        "*",
        *[
            percent(F.col(f"n_{i}"), total).alias(f"pct_{i}")
            for i in range(len(values))
        ],
    )


def row_percent_long(df: DataFrame, row: str, column: str) -> DataFrame:
    """``row, column, n, pct``: the same table in long form, for column values
    that are only known from the data. Empty cells are left out."""
    cells = (
        df.where(col(row).isNotNull() & col(column).isNotNull())
        .groupBy(col(row), col(column))
        .agg(row_count().alias("n"))
    )
    total = F.sum("n").over(Window.partitionBy(col(row)))
    return cells.select(col(row), col(column), "n", percent(F.col("n"), total).alias("pct"))


def full_matrix(cells: DataFrame, rows: DataFrame, row: str, columns: DataFrame, column: str):
    """Every cell of ``rows`` by ``columns``, ``n`` and ``pct`` 0 where there is none.

    ``columns`` is gathered into one array, so it must be a short list, such as the most
    common values; rows are laid out by it without a join of all with all.
    """
    listed = columns.agg(F.collect_set(col(column))).scalar()
    grid = rows.select("*", F.explode(listed).alias(column))
    joined = grid.join(cells.select(col(row), col(column), "n", "pct"), [row, column], "left")
    return joined.withColumns({"n": F.coalesce("n", F.lit(0)), "pct": F.coalesce("pct", F.lit(0.0))})


def bucket_order(df: DataFrame, bucket: str, by: str) -> DataFrame:
    """``bucket, first_seen``: the smallest ``by`` in each bucket, to sort
    buckets by when they begin. Buckets without any are left out."""
    firsts = df.groupBy(col(bucket)).agg(F.min(col(by)).alias("first_seen"))
    return firsts.where(F.col("first_seen").isNotNull())


def in_given_order(
    df: DataFrame, column: str, order: Sequence[str], position: str = "position"
) -> DataFrame:
    """Add the place of ``column`` in the list; other values, NULL too, come after."""
    place = reduce(
        lambda chain, item: chain.when(col(column) == item[1], item[0]),
        list(enumerate(order))[1:],
        F.when(col(column) == order[0], 0),
    )
    return df.withColumn(position, place.otherwise(len(order)))


def active_by_group(
    df: DataFrame, group: str | Column, active: str, name: str = "group_value"
) -> DataFrame:
    """``group_value, n_active, n_inactive, total, pct_active`` per non-NULL
    group; rows with a NULL flag are left out, as in a cross-table."""
    return (
        df.select(as_column(group).alias(name), col(active).alias("active"))
        .where(F.col(name).isNotNull() & F.col("active").isNotNull())
        .groupBy(name)
        .agg(
            F.count_if(F.col("active")).alias("n_active"),
            F.count_if(~F.col("active")).alias("n_inactive"),
            row_count().alias("total"),
        )
        .withColumn("pct_active", percent(F.col("n_active"), F.col("total")))
    )


def linked_by_period(
    df: DataFrame, period: Column, linked: Column, periods: Sequence[str]
) -> DataFrame:
    """``period, linked, not_linked, total, linked_pct`` for every listed period,
    zeros where there are no rows.

    One row of conditional counts, laid out by period: no join with a period
    list, and an empty period needs no special case.
    """
    tagged = df.select(period.alias("p"), linked.alias("l"))
    row = tagged.agg(
        *[F.count_if(F.col("p") == p).alias(f"t{i}") for i, p in enumerate(periods)],
        *[
            F.count_if((F.col("p") == p) & F.col("l")).alias(f"l{i}")
            for i, p in enumerate(periods)
        ],
    )
    zero = F.lit(0.0)
    lines = [
        F.struct(
            F.lit(p).alias("period"),
            F.col(f"l{i}").alias("linked"),
            (F.col(f"t{i}") - F.col(f"l{i}")).alias("not_linked"),
            F.col(f"t{i}").alias("total"),
            F.coalesce(percent(F.col(f"l{i}"), F.col(f"t{i}")), zero).alias(
                "linked_pct"
            ),
        )
        for i, p in enumerate(periods)
    ]
    return row.select(F.inline(F.array(*lines)))
