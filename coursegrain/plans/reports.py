"""Structural profile and quality scorecard as long report frames.

Every report has the columns ``section, column, metric, value`` with text values,
so reports of different tables stack and need no renderer.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import col
from ..operators import profiling, quality
from ..operators.columns import TEMPORAL, rename_suggestions, require_columns, select_kind

_SCHEMA = ("section", "column", "metric", "value")


def _line(section: str, column: Column, metric: Column, value: Column) -> Column:
    values = (F.lit(section), column, metric, value.cast("string"))
    return F.struct(*[v.alias(name) for v, name in zip(values, _SCHEMA)])


def _lines(df: DataFrame, lines: Sequence[Column]) -> DataFrame:
    return df.select(F.inline(F.array(*lines)))


def _figures(
    df: DataFrame, section: str, figures: Iterable[str], column: str = "column"
) -> DataFrame:
    """One line per row and named figure."""
    return _lines(
        df, [_line(section, F.col(column), F.lit(f), F.col(f)) for f in figures]
    )


def _stack(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def structural_report(
    df: DataFrame,
    *,
    top_values_k: int = 5,
    top_value_columns: Sequence[str] | None = None,
) -> DataFrame:
    """Shape, missingness, cardinality, numeric distribution, top values (of all
    columns unless some are named) and suggested names: one aggregate pass plus
    the value counts."""
    per_column = profiling.profile_columns(df)
    figures = {
        "missingness": ("n_missing", "pct_missing"),
        "cardinality": ("n_distinct", "pct_distinct"),
        "distribution": ("count", "mean", "stddev", "min", "max"),
    }
    lines = [
        _line(section, F.col("column"), F.lit(f), col(f))
        for section, names in figures.items()
        for f in names
    ]
    # The row count rides on the first column's row.
    lines.append(
        F.when(
            F.col("column") == df.columns[0],
            _line("shape", F.lit(None).cast("string"), F.lit("n_rows"), F.col("n_rows")),
        )
    )
    summary = _lines(per_column, lines).where("section is not null")
    # Non-numeric columns have no distribution.
    numeric = select_kind(df, None, T.NumericType)
    summary = summary.where(
        (F.col("section") != "distribution") | F.col("column").isin(numeric)
    )
    width = df.sparkSession.createDataFrame(
        [("shape", None, "n_columns", str(len(df.columns)))],
        ", ".join(f"{name} string" for name in _SCHEMA),
    )
    top = profiling.profile_top_values(
        df, k=top_values_k, columns=top_value_columns
    )
    top_lines = _lines(
        top,
        [
            _line("top_value_count", F.col("column"), F.col("value"), F.col("count")),
            _line("top_value_share", F.col("column"), F.col("value"), F.col("pct")),
        ],
    )
    names = _lines(
        rename_suggestions(df),
        [_line("names", F.col("original"), F.lit("suggested"), F.col("suggested"))],
    )
    return _stack([summary, width, top_lines, names])


def quality_report(
    df: DataFrame,
    *,
    key_columns: Sequence[str] | None = None,
    parsed_columns: Sequence[str] | None = None,
    numeric_columns: Sequence[str] | None = None,
    extra_sections: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Missingness, parse success, duplicate keys, outliers, and one-row extra
    sections by name. Parts that do not apply have no lines."""
    parsed = (
        require_columns(df, parsed_columns)
        if parsed_columns is not None
        else select_kind(df, None, T.NumericType, *TEMPORAL)
    )
    missing = profiling.profile_missingness(df)
    success = F.when(
        F.col("column").isin(parsed),
        _line(
            "parse_success",
            F.col("column"),
            F.lit("parse_success_pct"),
            1 - F.col("pct_missing"),
        ),
    )
    parts = [
        _lines(
            missing,
            [
                *[
                    _line("missingness", F.col("column"), F.lit(f), F.col(f))
                    for f in ("n_missing", "pct_missing")
                ],
                success,
            ],
        ).where("section is not null")
    ]
    if key_columns is not None:
        parts.append(
            section_of("duplicates", quality.duplicate_stats(df, key_columns))
        )
    outliers = quality.numeric_outliers(df, numeric_columns=numeric_columns)
    parts.append(_figures(outliers, "outliers", ("n_outliers", "pct_outliers", "rule")))
    parts += [section_of(name, row) for name, row in (extra_sections or {}).items()]
    return _stack(parts)


def section_of(section: str, row: DataFrame) -> DataFrame:
    """A one-row frame as report lines."""
    none = F.lit(None).cast("string")
    return _lines(
        row, [_line(section, none, F.lit(name), col(name)) for name in row.columns]
    )
