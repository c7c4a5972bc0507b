"""Redaction of personal data and the account of it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.detectors import (
    Detector,
    has_any_pii,
    has_email_pattern,
    has_student_id_pattern,
)
from ..functions.measures import percent, row_count
from ..functions.names import col
from .columns import require_columns


def placeholder(column: str) -> str:
    return f"[PII_REDACTED_{column.upper()}]"


def redact(
    df: DataFrame, fields: Mapping[str, str], detector: Detector = has_email_pattern
) -> DataFrame:
    """Replace the whole value of a field where the detector fires."""
    require_columns(df, fields)
    return df.select(
        *[
            F.when(detector(col(c)), F.lit(fields[c])).otherwise(col(c)).alias(c)
            if c in fields
            else col(c)
            for c in df.columns
        ]
    )


def count_columns(fields: Sequence[str], detector: Detector) -> list[Column]:
    """Aggregates ``e<i>, s<i>, t<i>`` of the detections in each field."""
    checks = (("e", has_email_pattern), ("s", has_student_id_pattern), ("t", detector))
    return [
        F.count_if(check(col(c))).alias(f"{tag}{i}")
        for i, c in enumerate(fields)
        for tag, check in checks
    ]


def counts_from_row(row: DataFrame, fields: Sequence[str]) -> DataFrame:
    """``column, email_pattern, student_id_pattern, total, n_rows`` from the row
    holding ``n_rows`` and the aggregates above."""
    if not fields:
        return row.sparkSession.createDataFrame(
            [],
            "column string, email_pattern long, student_id_pattern long, "
            "total long, n_rows long",
        )
    return row.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column"),
                        F.col(f"e{i}").alias("email_pattern"),
                        F.col(f"s{i}").alias("student_id_pattern"),
                        F.col(f"t{i}").alias("total"),
                        F.col("n_rows"),
                    )
                    for i, c in enumerate(fields)
                ]
            )
        )
    )


def _counted(
    df: DataFrame, fields: Sequence[str], detector: Detector
) -> DataFrame:
    names = require_columns(df, fields)
    row = df.agg(row_count().alias("n_rows"), *count_columns(names, detector))
    return counts_from_row(row, names)


def pii_counts(
    df: DataFrame, fields: Sequence[str], detector: Detector = has_any_pii
) -> DataFrame:
    """``column, email_pattern, student_id_pattern, total`` before redaction, all
    fields in one pass."""
    return _counted(df, fields, detector).drop("n_rows")


def redact_pii_fields(
    df: DataFrame,
    field_redactions: Mapping[str, str],
    detection_func: Detector = has_email_pattern,
) -> tuple[DataFrame, DataFrame]:
    """The redacted frame and its counts; neither is computed here."""
    return (
        redact(df, field_redactions, detection_func),
        pii_counts(df, list(field_redactions), detection_func),
    )


def report_from_counts(
    counts: DataFrame,
    *,
    dataset: str,
    table: str,
    dropped: Sequence[str],
) -> DataFrame:
    """``dataset, table, action, column, email_pattern, student_id_pattern,
    total, pct_of_rows``: a row per dropped column and per redacted field."""
    redacted = counts.select(
        F.lit("redacted").alias("action"),
        "column",
        "email_pattern",
        "student_id_pattern",
        "total",
        F.round(percent(F.col("total"), F.col("n_rows")), 2).alias("pct_of_rows"),
    )
    gone = counts.sparkSession.createDataFrame(
        [("dropped", c) for c in dropped], "action string, column string"
    )
    return redacted.unionByName(gone, allowMissingColumns=True).select(
        F.lit(dataset).alias("dataset"), F.lit(table).alias("table"), "*"
    )


def pii_report(
    df: DataFrame,
    *,
    dataset: str,
    table: str,
    dropped: Sequence[str],
    fields: Sequence[str],
    detector: Detector = has_any_pii,
) -> DataFrame:
    """What would be dropped and redacted in ``df``, in one pass."""
    return report_from_counts(
        _counted(df, fields, detector), dataset=dataset, table=table, dropped=dropped
    )
