"""Quality scorecard parts: duplicates, parse success, outliers, allow-lists and
orphans. Totals come from the same aggregate as the figure they divide."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.measures import row_count, share
from ..functions.missing import nan_to_null
from ..functions.names import col
from .columns import TEMPORAL, require_columns, select_kind
from .profiling import one_row_per_column, profile_missingness


def metric_rows(row: DataFrame, *, names: Sequence[str] | None = None) -> DataFrame:
    """A one-row frame as ``(metric, value)`` text rows, in column order."""
    shown = names or row.columns
    return row.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("metric"),
                        F.coalesce(col(c).cast("string"), F.lit("")).alias("value"),
                    )
                    for c in shown
                ]
            )
        )
    )


def duplicate_stats(df: DataFrame, key_columns: Sequence[str]) -> DataFrame:
    """One row: ``total_rows, distinct_keys, duplicate_rows, duplicate_row_pct,
    keys_with_duplicates``. NULL is one key value."""
    names = require_columns(df, key_columns)
    per_key = (
        df.select(*[col(c).alias(f"k{i}") for i, c in enumerate(names)])
        .groupBy(*[f"k{i}" for i in range(len(names))])
        .agg(row_count().alias("n"))
    )
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        row_count().alias("distinct_keys"),
        F.count_if(F.col("n") > 1).alias("keys_with_duplicates"),
    ).select(
        "total_rows",
        "distinct_keys",
        (F.col("total_rows") - F.col("distinct_keys")).alias("duplicate_rows"),
        share(
            F.col("total_rows") - F.col("distinct_keys"), F.col("total_rows")
        ).alias("duplicate_row_pct"),
        "keys_with_duplicates",
    )


def parse_success(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``column, parse_success_pct``: share of values present after typed
    parsing; numeric and temporal columns by default."""
    names = (
        require_columns(df, columns)
        if columns is not None
        else select_kind(df, None, T.NumericType, *TEMPORAL)
    )
    return profile_missingness(df.select(*map(col, names))).select(
        "column", (1 - F.col("pct_missing")).alias("parse_success_pct")
    )


def numeric_outliers(
    df: DataFrame,
    *,
    numeric_columns: Sequence[str] | None = None,
    z_threshold: float = 3.0,
) -> DataFrame:
    """``column, n_outliers, pct_outliers, rule``: values further than
    ``z_threshold`` sample deviations from the mean, as a share of all rows.
    Columns without a positive deviation are left out.

    Two passes: means and deviations first, then one conditional count that
    reads them as constants.
    """
    names = select_kind(df, numeric_columns, T.NumericType)
    if not names:
        return df.sparkSession.createDataFrame(
            [], "column string, n_outliers long, pct_outliers double, rule string"
        )
    numbers = df.select(*[col(c).cast("double").alias(c) for c in names])
    spread = numbers.agg(
        F.struct(
            *[nan_to_null(F.avg(col(c))).alias(f"m{i}") for i, c in enumerate(names)],
            *[
                nan_to_null(F.stddev_samp(col(c))).alias(f"s{i}")
                for i, c in enumerate(names)
            ],
        )
    ).scalar()

    def far(i: int, name: str) -> Column:
        limit = F.col(f"__spread.s{i}") * z_threshold
        return F.abs(col(name) - F.col(f"__spread.m{i}")) > limit

    # One column holds the constants, so the plan holds the subquery once.
    summary = numbers.withColumn("__spread", spread).agg(
        row_count().alias("n_rows"),
        F.first("__spread").alias("spread"),
        *[F.count_if(far(i, c)).alias(f"o{i}") for i, c in enumerate(names)],
    )
    rule = f"|value-mean|>{z_threshold}*std"
    found = one_row_per_column(
        summary,
        {
            c: [
                F.col(f"o{i}").alias("n_outliers"),
                share(F.col(f"o{i}"), F.col("n_rows")).alias("pct_outliers"),
                F.lit(rule).alias("rule"),
                F.col(f"spread.s{i}").alias("spread"),
            ]
            for i, c in enumerate(names)
        },
    )
    return found.where("spread > 0").drop("spread")


def keep_allowed(df: DataFrame, column: str, allowed: Iterable) -> DataFrame:
    require_columns(df, [column])
    return df.where(col(column).isin(list(allowed)))


def allowed_summary(df: DataFrame, column: str, allowed: Iterable) -> DataFrame:
    """One row of before, after and removed counts; NULL counts as removed."""
    require_columns(df, [column])
    return df.agg(
        row_count().alias("total_rows_before_filter"),
        F.count_if(col(column).isin(list(allowed))).alias("rows_after_filter"),
    ).select(
        "*",
        (F.col("total_rows_before_filter") - F.col("rows_after_filter")).alias(
            "rows_removed"
        ),
        share(
            F.col("total_rows_before_filter") - F.col("rows_after_filter"),
            F.col("total_rows_before_filter"),
        ).alias("pct_rows_removed"),
    )


def filter_allowed_values(
    df: DataFrame, column: str, allowed_values: Iterable
) -> tuple[DataFrame, DataFrame]:
    """Rows whose value is allowed, and the one-row summary of the filter."""
    allowed = list(allowed_values)
    return keep_allowed(df, column, allowed), allowed_summary(df, column, allowed)


def orphans(
    child: DataFrame, child_key: str, parent: DataFrame, parent_key: str
) -> DataFrame:
    """Child rows whose key is set but has no parent row."""
    referenced = child.where(col(child_key).isNotNull())
    known = parent.select(col(parent_key).alias(child_key)).distinct()
    return referenced.join(known, child_key, "left_anti")


def orphan_summary(
    child: DataFrame, child_key: str, parent: DataFrame, parent_key: str
) -> DataFrame:
    """One row: ``n_referencing, n_orphans, pct_orphans`` of a reference.

    Child keys are counted first, so the join sees each key once however often
    it is used.
    """
    uses = (
        child.where(col(child_key).isNotNull())
        .groupBy(col(child_key).alias("key"))
        .agg(row_count().alias("n"))
    )
    known = parent.select(col(parent_key).alias("key")).distinct()
    matched = uses.join(known.withColumn("known", F.lit(True)), "key", "left")
    return matched.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_referencing"),
        F.coalesce(F.sum(F.when(F.col("known").isNull(), F.col("n"))), F.lit(0)).alias(
            "n_orphans"
        ),
    ).withColumn("pct_orphans", share(F.col("n_orphans"), F.col("n_referencing")))
