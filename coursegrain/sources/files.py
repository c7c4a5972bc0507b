"""Typed scans and publishing, under one quoting policy for both directions.

Text files use ``"`` as quote and as escape on every read and every write, so a
value with quotes, commas or line breaks comes back as it was. Parquet is the
better tier format at scale (pruning, push-down, splittable): every function
takes it as ``fmt``.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import col

# Writers would strip white space around values otherwise.
_QUOTING = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def scratch_folder(spark: SparkSession) -> str:
    """A folder every executor can reach: the configured checkpoint folder. A session
    that runs in one process may do without; it then uses its warehouse folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
        raise ValueError("spark.checkpoint.dir must name a folder all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it is."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def data_path(base: str, dataset: str, table: str, part: str = "data") -> str:
    return f"{base.rstrip('/')}/{dataset}/{table}/{part}"


def report_path(base: str, dataset: str, table: str, name: str) -> str:
    return f"{base.rstrip('/')}/{dataset}/{table}/reports/{name}"


def scan(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    *,
    fmt: str = "csv",
    multiline: bool = False,
    check_header: bool = True,
) -> DataFrame:
    """Read a file or a directory of part files.

    With a schema nothing is inferred and malformed values become NULL; header
    names that differ from it are an error unless ``check_header`` is off (the
    columns then bind by position). A missing path is an error. Multi-line files
    are not splittable: they are read one file per task.
    """
    if fmt == "parquet":
        found = spark.read.parquet(path)
        return found.select(*schema.names) if schema else found
    reader = spark.read.options(**_QUOTING, mode="PERMISSIVE")
    reader = reader.option("multiLine", str(multiline).lower())
    if schema is None:
        return reader.option("inferSchema", "true").csv(path)
    return reader.option("enforceSchema", str(not check_header).lower()).csv(
        path, schema=schema
    )


def try_scan(spark: SparkSession, path: str, schema: T.StructType, **options):
    """The scan, or None where there is no input."""
    try:
        return scan(spark, path, schema, **options)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def input_status(
    spark: SparkSession, inputs: Mapping[str, tuple[str, T.StructType]], **options
) -> DataFrame:
    """``input, found, n_rows`` for each named path: a part of an export that has not come
    is a row of the result rather than the end of the job."""
    parts = []
    for name, (path, schema) in inputs.items():
        df = try_scan(spark, path, schema, **options)
        rows = F.count(F.lit(1)) if df is not None else F.lit(None).cast("long")
        parts.append(
            (df if df is not None else spark.range(1)).agg(
                F.lit(name).alias("input"),
                F.lit(df is not None).alias("found"),
                rows.alias("n_rows"),
            )
        )
    return reduce(DataFrame.union, parts)


def contract_report(
    spark: SparkSession, path: str, schema: T.StructType, *, multiline: bool = False
) -> DataFrame:
    """How text files keep to a contract: ``column, expected, place, found_at, status,
    n_filled, n_malformed``, one row per column of either side.

    ``status`` is ``ok``, ``moved`` (another place in the file), ``missing`` or
    ``unexpected``. Values that are there but cannot be read in the contract's type are
    malformed. The files are read twice, as text and as the contract has them.
    """
    text = spark.read.options(**_QUOTING, multiLine=str(multiline).lower()).csv(path)
    header, wanted = text.columns, {f.name: f.dataType for f in schema}
    arranged = T.StructType([T.StructField(c, wanted.get(c, T.StringType())) for c in header])
    typed = scan(spark, path, arranged, multiline=multiline)
    filled, parsed = (
        df.agg(*[F.count(col(c)).alias(f"{tag}{i}") for i, c in enumerate(header)])
        for df, tag in ((text, "f"), (typed, "p"))
    )
    lines = []
    for name in [*wanted, *(c for c in header if c not in wanted)]:
        place = schema.names.index(name) if name in wanted else None
        at = header.index(name) if name in header else None
        status = (
            "missing" if at is None else "unexpected" if place is None else "ok" if at == place else "moved"
        )
        seen = F.col(f"f{at}") if at is not None else F.lit(None).cast("long")
        read = F.col(f"p{at}") if at is not None else F.lit(None).cast("long")
        expected = wanted[name].simpleString() if name in wanted else None
        lines.append(
            F.struct(
                F.lit(name).alias("column"),
                F.lit(expected).cast("string").alias("expected"),
                F.lit(place).cast("int").alias("place"),
                F.lit(at).cast("int").alias("found_at"),
                F.lit(status).alias("status"),
                seen.alias("n_filled"),
                (seen - read).alias("n_malformed"),
            )
        )
    figures = [parsed.select(f"p{i}").scalar().alias(f"p{i}") for i in range(len(header))]
    return filled.select("*", *figures).select(F.inline(F.array(*lines)))


def publish(
    df: DataFrame,
    base: str,
    dataset: str,
    table: str,
    *,
    fmt: str = "csv",
    single_file: bool = False,
    files: int | None = None,
    part: str = "data",
) -> str:
    """Overwrite a table's data directory; every text value is quoted and NULL
    and empty text are both written empty.

    Writers keep the scan's parallelism. ``files`` reshuffles into that many
    files; ``single_file`` sends the whole table through one task and is only for
    small tables.
    """
    path = data_path(base, dataset, table, part)
    if single_file:
        df = df.coalesce(1)
    elif files:
        df = df.repartition(files)
    writer = df.write.mode("overwrite")
    if fmt == "parquet":
        writer.parquet(path)
    else:
        writer.options(**_QUOTING, quoteAll="true", emptyValue="", nullValue="").csv(
            path
        )
    return path


def write_report(
    report: DataFrame, base: str, dataset: str, table: str, name: str, *, fmt: str = "json"
) -> str:
    """Write a report frame beside its table, on the cluster's file system."""
    path = report_path(base, dataset, table, name)
    report.repartition(1).write.mode("overwrite").format(fmt).save(path)
    return path
