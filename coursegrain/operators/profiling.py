"""Column profiles.

A profile needs one aggregate over the table, however many columns it covers:
every figure is an expression of the same aggregate, and the single result row
is then laid out as one row per column. Only counts of values need a shuffle, and
most of those are left out where a sketch shows that they do not matter.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.measures import row_count, share
from ..functions.missing import is_missing, nan_to_null
from ..functions.names import col
from .columns import column_types, columns_of, require_columns
from .ranking import top_per_group


def _chosen(df: DataFrame, columns: Sequence[str] | None) -> list[str]:
    return df.columns if columns is None else list(require_columns(df, columns))


def one_row_per_column(summary: DataFrame, rows: dict[str, list[Column]]) -> DataFrame:
    """Lay a one-row summary out as ``(column, ...)`` rows.

    ``rows`` maps each column name to its aliased output values. A summary of
    zero input rows gives no rows.
    """
    structs = [
        F.struct(F.lit(name).alias("column"), *values) for name, values in rows.items()
    ]
    return summary.where("n_rows > 0").select(F.inline(F.array(*structs)))


def _no_rows(df: DataFrame, schema: str) -> DataFrame:
    return df.sparkSession.createDataFrame([], schema)


def profile_shape(df: DataFrame) -> DataFrame:
    """``n_rows`` and ``n_columns`` in one row."""
    return df.agg(row_count().alias("n_rows")).withColumn(
        "n_columns", F.lit(len(df.columns)).cast("long")
    )


def profile_missingness(
    df: DataFrame, *, columns: Sequence[str] | None = None
) -> DataFrame:
    """``column, n_missing, pct_missing`` in column order; pct is a 0-1 share."""
    names, types = _chosen(df, columns), column_types(df)
    if not names:
        return _no_rows(df, "column string, n_missing long, pct_missing double")
    summary = df.agg(
        row_count().alias("n_rows"),
        *[
            F.count_if(is_missing(col(c), types[c])).alias(f"m{i}")
            for i, c in enumerate(names)
        ],
    )
    return one_row_per_column(
        summary,
        {
            c: [
                F.col(f"m{i}").alias("n_missing"),
                share(F.col(f"m{i}"), F.col("n_rows")).alias("pct_missing"),
            ]
            for i, c in enumerate(names)
        },
    )


def _cells_by_type(
    df: DataFrame,
    names: list[str],
    shown: Callable[[str], Column],
    without: Collection[str] = (),
) -> list[DataFrame]:
    """Long frames ``(place, value)``, one per data type: a row per cell that
    ``shown`` leaves non-NULL, with the column's place among ``names`` as text.

    Cells of one type stay in that type, so they are grouped as numbers or
    booleans rather than as text, and each frame scans its own columns only.
    """
    types = column_types(df)
    members: dict[T.DataType, list[tuple[str, str]]] = {}
    for place, name in enumerate(names):
        if name in without:
            continue
        members.setdefault(types[name], []).append((str(place), name))
    frames = []
    for chosen in members.values():
        wide = df.select(*[shown(name).alias(place) for place, name in chosen])
        long = wide.unpivot([], [place for place, _ in chosen], "place", "value")
        frames.append(long.where(F.col("value").isNotNull()))
    return frames


def profile_cardinality(
    df: DataFrame, *, columns: Sequence[str] | None = None, use_approx: bool = True
) -> DataFrame:
    """``column, n_distinct, pct_distinct``: distinct non-NULL values, and their
    share of all rows. The approximate form is one pass of sketches; the exact
    form shuffles each column's distinct values once."""
    names = _chosen(df, columns)
    if not names:
        return _no_rows(df, "column string, n_distinct long, pct_distinct double")
    if not use_approx:
        return _exact_cardinality(df, names)
    summary = df.agg(
        row_count().alias("n_rows"),
        *[F.approx_count_distinct(col(c)).alias(f"d{i}") for i, c in enumerate(names)],
    )
    return one_row_per_column(summary, _cardinality_values(names))


def _exact_cardinality(df: DataFrame, names: list[str]) -> DataFrame:
    distinct = [
        cells.distinct().select("place") for cells in _cells_by_type(df, names, col)
    ]
    summary = reduce(DataFrame.union, distinct).agg(
        df.agg(row_count()).scalar().alias("n_rows"),
        *[F.count_if(F.col("place") == str(i)).alias(f"d{i}") for i in range(len(names))],
    )
    return one_row_per_column(summary, _cardinality_values(names))


def _cardinality_values(names: list[str]) -> dict[str, list[Column]]:
    return {
        c: [
            F.col(f"d{i}").alias("n_distinct"),
            share(F.col(f"d{i}"), F.col("n_rows")).alias("pct_distinct"),
        ]
        for i, c in enumerate(names)
    }


# Values a sketch keeps apart, and the share of all rows its counts may be off by: it keeps
# at most 3.5 / size of the rows out, where its table has at least 4 / 3 places a value.
TRACKED = 1024
_OFF = 3.5 * 3 / 4
# Sketches of tasks are merged by this many tasks before the last one merges those.
_MERGERS = 64


def _present(df: DataFrame) -> Callable[[str], Column]:
    types = column_types(df)
    return lambda name: F.when(~is_missing(col(name), types[name]), col(name))


def frequent_hashes(
    df: DataFrame, names: Sequence[str], k: int, *, tracked: int = TRACKED
) -> tuple[int, dict[str, list[int]]]:
    """Rows of the table, and for each column whose k most frequent non-missing values
    are sure to be among a few, the hashes of those.

    One read. Frequency sketches hold hashes, so their size does not depend on the
    values; what comes to the driver is at most ``tracked`` numbers a column. A sketched
    count is never too small and at most ``off`` too large, and a value the sketch does not
    list has at most twice ``off`` or the last listed count. A column is proven if
    its k-th count stays above that even when ``off`` is taken away. Columns with fewer
    than k values, or of rare values only, are not.
    """
    tracked = max(tracked, k)
    shown = _present(df)
    sketches = df.groupBy(F.pmod(F.spark_partition_id(), F.lit(_MERGERS))).agg(
        row_count().alias("n_rows"),
        *[
            F.call_function(
                "approx_top_k_accumulate",
                F.when(shown(c).isNotNull(), F.xxhash64(shown(c))),
                F.lit(tracked),
            ).alias(f"s{i}")
            for i, c in enumerate(names)
        ],
    )
    merged = [
        F.call_function(
            "approx_top_k_estimate",
            F.call_function("approx_top_k_combine", F.col(f"s{i}"), F.lit(tracked)),
            F.lit(tracked),
        ).alias(f"s{i}")
        for i in range(len(names))
    ]
    # Grouped, as there is no sketch to merge where there is no row.
    found = sketches.groupBy(F.lit(1)).agg(F.sum("n_rows").alias("n_rows"), *merged).first()
    if found is None:
        return 0, {}
    n_rows = found["n_rows"]
    proven, off = {}, _OFF * n_rows / tracked
    for i, name in enumerate(names):
        listed = sorted((r["count"] for r in found[f"s{i}"]), reverse=True)
        unlisted = max(2 * off, listed[-1] if len(listed) >= tracked else 0)
        counts = {r["item"]: r["count"] for r in found[f"s{i}"] if r["item"] is not None}
        least = sorted(counts.values(), reverse=True)[k - 1 : k]
        if least and least[0] - off > unlisted:
            proven[name] = [item for item, n in counts.items() if n >= least[0] - off]
    return n_rows, proven


def _counts_of(df: DataFrame, hashes: dict[str, list[int]], places: dict[str, str]) -> DataFrame:
    """``place, value, count`` of the values with the given hashes: one read for all
    columns, combined in the map tasks to a few rows."""
    shown = _present(df)

    def cell(name: str) -> Column:
        item = F.xxhash64(shown(name))
        # Zeros of both signs are one value and have one hash.
        value = shown(name)
        if isinstance(column_types(df)[name], (T.FloatType, T.DoubleType)):
            value = F.when(value == 0, F.lit(0).cast(column_types(df)[name])).otherwise(value)
        return F.struct(
            F.lit(places[name]).alias("place"),
            item.alias("item"),
            F.when(item.isin(hashes[name]), value.cast("string")).alias("value"),
        )

    cells = df.select(F.inline(F.array(*map(cell, hashes)))).where("value is not null")
    counts = cells.groupBy("place", "item", "value").agg(row_count().alias("count"))
    return counts.select("place", "value", "count")


def profile_top_values(
    df: DataFrame,
    *,
    k: int = 5,
    columns: Sequence[str] | None = None,
    tracked: int = TRACKED,
) -> DataFrame:
    """``column, value, count, pct``: the k most frequent non-missing values of
    each column, ties by value; pct is the share of all rows.

    A sketch of all columns, made when the function is called, tells which values can be
    among the k (``frequent_hashes``); only those are then counted, exactly, in a second
    read. Columns where the sketch proves nothing have all their values counted, those of
    one type in one scan: cheap for few values, nearly a whole shuffle for keys. Name the
    ``columns`` to look at to leave keys out.
    """
    if k <= 0:
        raise ValueError("k must be positive")
    names = _chosen(df, columns)
    if not names:
        return _no_rows(df, "column string, value string, count long, pct double")
    n_rows, proven = frequent_hashes(df, names, k, tracked=tracked)
    parts = []
    if proven:
        places = {name: str(i) for i, name in enumerate(names)}
        parts.append(_counts_of(df, proven, places))
    parts += [
        cells.groupBy("place", "value")
        .agg(row_count().alias("count"))
        .select("place", F.col("value").cast("string").alias("value"), "count")
        for cells in _cells_by_type(df, names, _present(df), without=set(proven))
    ]
    counts = reduce(DataFrame.union, parts)
    top = top_per_group(counts, ["place"], [F.desc("count"), F.asc("value")], k)
    column = F.element_at(F.array(*map(F.lit, names)), F.col("place").cast("int") + 1)
    return top.select(
        column.alias("column"),
        "value",
        "count",
        share(F.col("count"), F.lit(n_rows)).alias("pct"),
    )


def numeric_summary_columns(name: str, tag: str) -> list[Column]:
    """Aggregates of the numeric distribution of one column."""
    value = col(name).cast("double")
    return [
        F.count(value).alias(f"{tag}_count"),
        F.avg(value).alias(f"{tag}_mean"),
        F.stddev_samp(value).alias(f"{tag}_stddev"),
        F.min(value).alias(f"{tag}_min"),
        F.max(value).alias(f"{tag}_max"),
    ]


def _numeric_values(tag: str) -> list[Column]:
    figures = [
        nan_to_null(F.col(f"{tag}_{f}")).alias(f)
        for f in ("mean", "stddev", "min", "max")
    ]
    return [F.col(f"{tag}_count").alias("count"), *figures]


def profile_numeric_distribution(
    df: DataFrame, *, columns: Sequence[str] | None = None
) -> DataFrame:
    """``column, count, mean, stddev, min, max`` of each numeric column; sample
    deviation, NaN shown as NULL, all-NULL columns kept with count 0."""
    numeric = columns_of(df, T.NumericType)
    names = [c for c in _chosen(df, columns) if c in numeric]
    if not names:
        return _no_rows(
            df,
            "column string, count long, mean double, stddev double, "
            "min double, max double",
        )
    summary = df.agg(
        row_count().alias("n_rows"),
        *[x for i, c in enumerate(names) for x in numeric_summary_columns(c, f"v{i}")],
    )
    return one_row_per_column(
        summary, {c: _numeric_values(f"v{i}") for i, c in enumerate(names)}
    )


def profile_columns(df: DataFrame) -> DataFrame:
    """Missingness, approximate cardinality and numeric distribution of every
    column from a single pass: one wide row per column, NULL where a figure does
    not apply."""
    types = column_types(df)
    numeric = set(columns_of(df, T.NumericType))
    aggregates, rows = [row_count().alias("n_rows")], {}
    for i, c in enumerate(df.columns):
        aggregates += [
            F.count_if(is_missing(col(c), types[c])).alias(f"m{i}"),
            F.approx_count_distinct(col(c)).alias(f"d{i}"),
        ]
        if c in numeric:
            aggregates += numeric_summary_columns(c, f"v{i}")
            figures = _numeric_values(f"v{i}")
        else:
            figures = [
                F.lit(None).cast("long").alias("count"),
                *[
                    F.lit(None).cast("double").alias(f)
                    for f in ("mean", "stddev", "min", "max")
                ],
            ]
        rows[c] = [
            F.col("n_rows"),
            F.col(f"m{i}").alias("n_missing"),
            share(F.col(f"m{i}"), F.col("n_rows")).alias("pct_missing"),
            F.col(f"d{i}").alias("n_distinct"),
            share(F.col(f"d{i}"), F.col("n_rows")).alias("pct_distinct"),
            *figures,
        ]
    return one_row_per_column(df.agg(*aggregates), rows)
