"""The two tiers of the pipeline and their order.

ETL: typed raw scan, structural report, canonical names and values, quality
report, publish. De-identification: scan the clean tier, drop and redact, publish,
account for it. The eight jobs of a tier differ only in their ``TableSpec``.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.detectors import EMAIL_PATTERN, STUDENT_ID_PATTERN, has_any_pii
from ..functions.measures import row_count
from ..functions.missing import is_filled
from ..functions.names import col
from ..operators import cleaning, quality, redaction
from ..operators.columns import TEMPORAL, columns_of, normalize_column_names
from ..sources.contracts import TABLES, TableSpec
from ..sources.files import data_path, publish, remove, scan, scratch_folder, write_report
from . import reports

PROFILE_TOP_VALUES = 10


def typed_clean(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """Canonical names and values with types still in place.

    Whitespace is squeezed before sentinels are looked up, so text of nothing but
    tabs ends as NULL as well. No line break survives: the clean tier needs no
    multi-line reader.
    """
    df = normalize_column_names(raw)
    df = cleaning.clamp_years(df, spec.clamped)
    df = cleaning.trim_whitespace(df)
    return cleaning.canonicalize_nulls(df, list(spec.null_columns))


def publishable(typed: DataFrame, spec: TableSpec) -> DataFrame:
    """Derived flag, allow-list and ISO timestamps."""
    df = typed
    if spec.filled_flag:
        source = spec.filled_flag
        df = df.withColumn(f"has_{source}", is_filled(col(source)))
    if spec.allowed:
        df = quality.keep_allowed(df, *spec.allowed)
    # Timestamps outside the ISO list get the same form: one format per table.
    return cleaning.standardize_datetimes_iso(df, columns_of(df, *TEMPORAL))


def clean_table(raw: DataFrame, spec: TableSpec) -> DataFrame:
    return publishable(typed_clean(raw, spec), spec)


def scorecard(typed: DataFrame, spec: TableSpec) -> DataFrame:
    """Quality report on the typed rows: as text, dates could not count as parsed."""
    extra, kept = {}, typed
    if spec.allowed:
        column, values = spec.allowed
        extra[f"{column}_allowed"] = quality.allowed_summary(typed, column, values)
        kept = quality.keep_allowed(typed, column, values)
    return reports.quality_report(
        kept,
        key_columns=spec.keys,
        numeric_columns=spec.outlier_columns,
        extra_sections=extra,
    )


def run_etl(
    spark: SparkSession,
    raw_base: str,
    out_base: str,
    spec: TableSpec,
    *,
    fmt: str = "csv",
    scratch: str | None = None,
) -> str:
    """One table from its raw export to the clean tier with both reports.

    The raw text is parsed once, into a typed columnar copy; the profile, the scorecard
    and the published rows read that copy. It holds what later tiers leave out, so it is
    kept in ``scratch`` (the session's shared folder unless given) and deleted at the end.
    """
    raw = scan(
        spark,
        f"{raw_base.rstrip('/')}/{spec.raw_file}",
        spec.raw_schema,
        multiline=spec.multiline,
    )
    where = (out_base, spec.dataset, spec.table)
    copy = f"{(scratch or scratch_folder(spark)).rstrip('/')}/staged-{uuid.uuid4().hex}"
    raw.write.parquet(copy)
    try:
        raw = spark.read.parquet(copy)
        profile = reports.structural_report(raw, top_values_k=PROFILE_TOP_VALUES)
        write_report(profile, *where, "structural")
        # The scorecard needs types that the text tier no longer has.
        write_report(scorecard(typed_clean(raw, spec), spec), *where, "quality")
        return publish(clean_table(raw, spec), *where, fmt=fmt)
    finally:
        remove(spark, copy)


def deidentified(clean: DataFrame, spec: TableSpec) -> DataFrame:
    """Drop and redact per the table's settings; lazy."""
    kept = cleaning.drop_columns(clean, spec.dropped)
    fields = {c: redaction.placeholder(c) for c in spec.redacted}
    return redaction.redact(kept, fields, has_any_pii)


def run_deidentify(
    spark: SparkSession,
    in_base: str,
    out_base: str,
    spec: TableSpec,
    *,
    fmt: str = "csv",
    single_file: bool = False,
) -> str:
    """One table from the clean tier to the published tier with its PII report.

    The counts are observed while the rows are written, so the table is read
    once. Nothing is shuffled between, so each task reports exactly once.
    """
    clean = scan(
        spark, data_path(in_base, spec.dataset, spec.table), spec.clean_schema, fmt=fmt
    )
    seen = Observation()
    watched = clean.observe(
        seen,
        row_count().alias("n_rows"),
        *redaction.count_columns(spec.redacted, has_any_pii),
    )
    where = (out_base, spec.dataset, spec.table)
    path = publish(deidentified(watched, spec), *where, fmt=fmt, single_file=single_file)
    figures = seen.get
    row = spark.range(1).select(
        *[F.lit(n).cast("long").alias(name) for name, n in figures.items()]
    )
    report = redaction.report_from_counts(
        redaction.counts_from_row(row, spec.redacted),
        dataset=spec.dataset,
        table=spec.table,
        dropped=spec.dropped,
    ).select(
        "*",
        F.lit(figures["n_rows"]).cast("long").alias("total_records"),
        F.current_timestamp().alias("generated_at"),
        F.lit(EMAIL_PATTERN).alias("email_regex"),
        F.lit(STUDENT_ID_PATTERN).alias("student_id_regex"),
    )
    write_report(report, *where, "pii")
    return path


def run_pipeline(
    spark: SparkSession,
    raw_base: str,
    clean_base: str,
    out_base: str,
    *,
    specs: Iterable[TableSpec] = tuple(TABLES.values()),
    fmt: str = "csv",
    at_once: int = 4,
) -> list[str]:
    """All ETL jobs, then all de-identification jobs; the published paths.

    Tables do not depend on each other within a tier, so ``at_once`` of them are handed
    to Spark together: the tasks of small tables fill what a large one leaves idle. The
    second tier starts when the first is whole; a failed job is raised then.
    """
    specs = list(specs)

    def etl(spec: TableSpec) -> str:
        return run_etl(spark, raw_base, clean_base, spec, fmt=fmt)

    def deidentify(spec: TableSpec) -> str:
        return run_deidentify(spark, clean_base, out_base, spec, fmt=fmt)

    inheriting = inheritable_thread_target(spark)
    with ThreadPoolExecutor(at_once) as pool:
        list(pool.map(inheriting(etl), specs))
        return list(pool.map(inheriting(deidentify), specs))
