"""Column names and column checks, on metadata but for ``column_report``."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import col

# A word ends before a capital that follows a lower-case letter or digit, before
# a capital that opens a lower-case run, and at anything not alphanumeric.
_WORD_BREAK = re.compile(
    r"(?<=[a-z0-9])(?=[A-Z])|(?<=.)(?=[A-Z][a-z])|[^0-9A-Za-z]+"
)

TEMPORAL = (T.DateType, T.TimestampType, T.TimestampNTZType)


def _snake(name: str) -> str:
    return "_".join(word for word in _WORD_BREAK.split(name) if word).lower()


_STYLES = {"snake": _snake, "lower": str.lower, "upper": str.upper}


def standardize_column_names(
    columns: Iterable[str], *, case: str = "snake", strip_whitespace: bool = True
) -> list[str]:
    """Names in the wanted style: ``snake``, ``lower`` or ``upper``."""
    if case not in _STYLES:
        raise ValueError(f"unknown case style {case!r}; use one of {sorted(_STYLES)}")
    style = _STYLES[case]
    return [style(str(c).strip() if strip_whitespace else str(c)) for c in columns]


def normalize_column_names(
    df: DataFrame, *, case: str = "snake", strip_whitespace: bool = True
) -> DataFrame:
    """Rename every column; names that collide afterwards are an error."""
    names = standardize_column_names(
        df.columns, case=case, strip_whitespace=strip_whitespace
    )
    clashes = sorted(name for name, times in Counter(names).items() if times > 1)
    if clashes:
        raise ValueError(f"columns collide after renaming: {', '.join(clashes)}")
    return df.toDF(*names)


def rename_suggestions(df: DataFrame) -> DataFrame:
    """``(original, suggested)`` for each name the standardiser would change."""
    pairs = zip(df.columns, standardize_column_names(df.columns))
    return df.sparkSession.createDataFrame(
        [(old, new) for old, new in pairs if old != new],
        "original string, suggested string",
    )


def column_types(df: DataFrame) -> dict[str, T.DataType]:
    return {field.name: field.dataType for field in df.schema}


def columns_of(df: DataFrame, *kinds: type[T.DataType]) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, kinds)]


def existing(df: DataFrame, wanted: Iterable[str]) -> list[str]:
    """The wanted columns that the frame has, in the wanted order."""
    present = set(df.columns)
    return [c for c in wanted if c in present]


def require_columns(
    df: DataFrame, wanted: Iterable[str], *kinds: type[T.DataType]
) -> list[str]:
    """The wanted columns; an error if one is absent or of another kind."""
    names, types = list(wanted), column_types(df)
    absent = sorted(set(names) - set(types))
    if absent:
        raise ValueError(f"no such columns: {', '.join(absent)}")
    if kinds:
        wrong = sorted(c for c in names if not isinstance(types[c], kinds))
        if wrong:
            kind_names = " or ".join(k.__name__ for k in kinds)
            raise TypeError(f"not {kind_names}: {', '.join(wrong)}")
    return names


def column_report(df: DataFrame, wanted: Mapping[str, str]) -> DataFrame:
    """``column, expected, found, status, n_filled`` for each wanted column and its type
    in DDL: ``ok``, ``absent`` or ``other_type``; ``n_filled`` counts what is not NULL. The
    frame is read once, whatever is wanted; unlike ``require_columns`` nothing is raised.
    """
    types = column_types(df)
    counts = df.agg(
        *[F.count(col(c) if c in types else F.lit(None)).alias(f"n{i}") for i, c in enumerate(wanted)]
    )
    lines = []
    for i, (name, ddl) in enumerate(wanted.items()):
        expected = T.StructType.fromDDL(f"x {ddl}")[0].dataType.simpleString()
        found = types[name].simpleString() if name in types else None
        status = "absent" if found is None else "ok" if found == expected else "other_type"
        values = {"column": name, "expected": expected, "found": found, "status": status}
        lines.append(
            F.struct(
                *[F.lit(v).cast("string").alias(k) for k, v in values.items()],
                F.when(F.lit(found is not None), F.col(f"n{i}")).alias("n_filled"),
            )
        )
    return counts.select(F.inline(F.array(*lines)))


def select_kind(
    df: DataFrame, wanted: Sequence[str] | None, *kinds: type[T.DataType]
) -> list[str]:
    """Checked wanted columns, or every column of the kinds when none are named."""
    if wanted is None:
        return columns_of(df, *kinds)
    return require_columns(df, wanted, *kinds)
