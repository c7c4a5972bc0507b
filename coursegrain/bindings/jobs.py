"""Files, reports and the two tiers as queries."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import profiling
from ..operators.columns import column_report, standardize_column_names
from ..operators.redaction import placeholder
from ..plans import jobs, reports
from ..sources.contracts import TABLES, TableSpec
from ..sources.files import (
    contract_report,
    data_path,
    input_status,
    publish,
    remove,
    report_path,
    scan,
    scratch_folder,
)
from .privacy import _any, _email, _student
from .profiling import _MISSING_WORDS, _TEXT, MISSINGNESS_SQL
from .registry import query

CUSTOMERS = TableSpec(
    dataset="sample",
    table="customers",
    raw_file="Customers.csv",
    raw_ddl="""
        CustKey bigint, NameRaw string, Contact string, FlagRaw string,
        AmountRaw string, Balance double, Segment string, IsActive boolean,
        CreatedDate timestamp
    """,
    keys=("cust_key",),
    null_columns=("name_raw", "segment"),
    iso_columns=("created_date",),
    outlier_columns=("balance",),
    clamped=("created_date",),
    allowed=("flag_raw", ("Yes", "no", "T")),
    filled_flag="name_raw",
    dropped=("amount_raw",),
    redacted=("contact", "name_raw"),
)


def _raw_customers(t):
    stamp = F.make_timestamp(
        (F.col("c_custkey") % 30 + 1995).cast("int"),
        *[F.lit(n) for n in (2, 3, 4, 5, 6)],
    )
    return t.dirty_customer.withColumn("created", stamp).toDF(*CUSTOMERS.raw_schema.names)


_CLEAN_SQL = f"""clean AS (SELECT c_custkey AS cust_key,
    CASE WHEN lower(n) IN ({_MISSING_WORDS}) THEN NULL ELSE n END AS name_raw,
    contact, trim(flag_raw) AS flag_raw, amount_raw, balance,
    CASE WHEN lower(segment) IN ({_MISSING_WORDS}) THEN NULL ELSE segment END AS segment,
    is_active, CAST(1995 + c_custkey % 30 AS VARCHAR) || '-02-03T04:05:06' AS created_date
    FROM (SELECT *, trim(regexp_replace(name_raw, '\\s+', ' ', 'g')) AS n
        FROM {{dirty_customer}}))"""


@query(
    "etl_clean",
    f"""WITH {_CLEAN_SQL} SELECT *, name_raw IS NOT NULL AND name_raw <> '' AS has_name_raw
    FROM clean WHERE flag_raw IN ('Yes', 'no', 'T')""",
)
def _(t):
    return jobs.clean_table(_raw_customers(t), CUSTOMERS)


@query(
    "etl_then_deidentify",
    f"""WITH {_CLEAN_SQL} SELECT cust_key,
    CASE WHEN {_any('name_raw')} THEN '[PII_REDACTED_NAME_RAW]' ELSE name_raw END AS name_raw,
    CASE WHEN {_any('contact')} THEN '[PII_REDACTED_CONTACT]' ELSE contact END AS contact,
    flag_raw, balance, segment, is_active, created_date,
    name_raw IS NOT NULL AND name_raw <> '' AS has_name_raw
    FROM clean WHERE flag_raw IN ('Yes', 'no', 'T')""",
)
def _(t):
    return jobs.deidentified(jobs.clean_table(_raw_customers(t), CUSTOMERS), CUSTOMERS)


_PUBLISHED_SQL = f"""SELECT cust_key,
    CASE WHEN {_any('name_raw')} THEN '[PII_REDACTED_NAME_RAW]' ELSE name_raw END AS name_raw,
    CASE WHEN {_any('contact')} THEN '[PII_REDACTED_CONTACT]' ELSE contact END AS contact,
    flag_raw, balance, segment, is_active, CAST(created_date AS TIMESTAMP) AS created_date,
    name_raw IS NOT NULL AND name_raw <> '' AS has_name_raw
    FROM clean WHERE flag_raw IN ('Yes', 'no', 'T')"""


def _run_jobs(t) -> str:
    """Both jobs over the customers as a raw export; the folder they wrote to. The export
    holds personal data and goes when the jobs have read it."""
    base = f"{scratch_folder(t.spark)}/jobs-{uuid.uuid4().hex}"
    raw = _raw_customers(t).write.options(
        header="true", quote='"', escape='"', quoteAll="true",
        ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false",
    )
    try:
        raw.csv(f"{base}/raw/{CUSTOMERS.raw_file}")
        jobs.run_etl(t.spark, f"{base}/raw", f"{base}/clean", CUSTOMERS)
        jobs.run_deidentify(t.spark, f"{base}/clean", f"{base}/published", CUSTOMERS)
    finally:
        remove(t.spark, f"{base}/raw")
    return base


@query(
    "etl_job",
    f"""WITH {_CLEAN_SQL} SELECT * REPLACE (CAST(created_date AS TIMESTAMP) AS created_date), name_raw IS NOT NULL AND name_raw <> '' AS has_name_raw
    FROM clean WHERE flag_raw IN ('Yes', 'no', 'T')""",
)
def _(t):
    path = data_path(f"{_run_jobs(t)}/clean", CUSTOMERS.dataset, CUSTOMERS.table)
    return scan(t.spark, path, CUSTOMERS.clean_schema)


@query("deidentify_job", f"WITH {_CLEAN_SQL} {_PUBLISHED_SQL}")
def _(t):
    base = _run_jobs(t)
    remove(t.spark, f"{base}/clean/{CUSTOMERS.dataset}/{CUSTOMERS.table}/data")
    path = data_path(f"{base}/published", CUSTOMERS.dataset, CUSTOMERS.table)
    fields = [f for f in CUSTOMERS.clean_schema.fields if f.name not in CUSTOMERS.dropped]
    return scan(t.spark, path, T.StructType(fields))


def _numbered(report):
    """Report lines with numbers rounded, so that their text does not matter."""
    number = F.col("value").try_cast("double")
    return report.select(
        "section",
        F.coalesce("column", F.lit("")).alias("column"),
        F.coalesce("metric", F.lit("")).alias("metric"),
        # A most frequent value is no figure, even if it reads like one.
        F.round(number, 4).alias("number"),
        F.when(number.isNull(), F.col("value")).alias("text"),
    )


def _exactly(lines, df):
    """Approximate cardinalities within three standard errors of the sketch are shown as
    the exact ones, so that they can be compared."""
    exact = profiling.profile_cardinality(df, use_approx=False).select(
        "column", F.explode(F.create_map(F.lit("n_distinct"), F.col("n_distinct").cast("double"),
        F.lit("pct_distinct"), "pct_distinct")).alias("metric", "exact"),
    )
    near = F.abs(F.col("number") - F.col("exact")) <= 0.15 * F.col("exact") + 1e-4
    number = F.when((F.col("section") == "cardinality") & near, F.round("exact", 4)).otherwise(F.col("number"))
    return lines.join(exact, ["column", "metric"], "left").select("section", "column", "metric", number.alias("number"), "text")


def _missing_sql(column: str, texts) -> str:
    blank = f" OR lower(trim({column})) IN ({_MISSING_WORDS})" if column in texts else ""
    return f"({column} IS NULL{blank})"


def _line_sql(section: str, column: str, metric: str, number: str, source: str) -> str:
    return f"""SELECT '{section}' AS section, '{column}' AS "column", '{metric}' AS metric,
        round(CAST({number} AS DOUBLE), 4) AS number, NULL AS text FROM {source}"""


def _structural_sql(source: str, columns, texts, numbers, k: int, suggested=()) -> str:
    """The lines of a structural report over ``source``."""
    parts = [
        _line_sql("shape", "", "n_rows", "count(*)", source),
        _line_sql("shape", "", "n_columns", str(len(columns)), "(SELECT 1)"),
    ]
    cells = []
    for c in columns:
        missing = _missing_sql(c, texts)
        figures = [
            ("missingness", "n_missing", f"count(*) FILTER (WHERE {missing})"),
            ("missingness", "pct_missing", f"count(*) FILTER (WHERE {missing}) / count(*)"),
            ("cardinality", "n_distinct", f"count(DISTINCT {c})"),
            ("cardinality", "pct_distinct", f"count(DISTINCT {c}) / count(*)"),
        ]
        if c in numbers:
            figures += [
                ("distribution", name, figure)
                for name, figure in (
                    ("count", f"count({c})"), ("mean", f"avg({c})"), ("stddev", f"stddev_samp({c})"),
                    ("min", f"min({c})"), ("max", f"max({c})"),
                )
            ]
        parts += [_line_sql(section, c, metric, figure, source) for section, metric, figure in figures]
        cells.append(f"""SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS value FROM {source} WHERE NOT {missing}""")
    tops = f"""(SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS place
        FROM (SELECT "column", value, count(*) AS n FROM ({" UNION ALL ".join(cells)}) GROUP BY 1, 2))"""
    for section, figure in (
        ("top_value_count", "CAST(n AS DOUBLE)"),
        ("top_value_share", f"round(n / (SELECT count(*) FROM {source}), 4)"),
    ):
        parts.append(f"""SELECT '{section}', "column", value, {figure}, NULL FROM {tops} WHERE place <= {k}""")
    parts += [f"SELECT 'names', '{a}', 'suggested', NULL, '{b}'" for a, b in suggested]
    return " UNION ALL ".join(parts)


_RAW_SQL = """raw AS (SELECT c_custkey AS CustKey, nullif(name_raw, '') AS NameRaw, contact AS Contact,
    flag_raw AS FlagRaw, amount_raw AS AmountRaw, balance AS Balance, segment AS Segment,
    is_active AS IsActive, make_timestamp(1995 + c_custkey % 30, 2, 3, 4, 5, 6) AS CreatedDate
    FROM {dirty_customer})"""
# Raw names and what the jobs make of them.
_NAMES = {
    "CustKey": "cust_key", "NameRaw": "name_raw", "Contact": "contact", "FlagRaw": "flag_raw",
    "AmountRaw": "amount_raw", "Balance": "balance", "Segment": "segment", "IsActive": "is_active",
    "CreatedDate": "created_date",
}
_RAW_TEXT = ("NameRaw", "Contact", "FlagRaw", "AmountRaw", "Segment")
_CLEAN_TEXT = ("name_raw", "contact", "flag_raw", "amount_raw", "segment")


def _quality_sql() -> str:
    parts = []
    for c in _NAMES.values():
        missing = _missing_sql(c, _CLEAN_TEXT)
        parts.append(_line_sql("missingness", c, "n_missing", f"count(*) FILTER (WHERE {missing})", "kept"))
        parts.append(_line_sql("missingness", c, "pct_missing", f"count(*) FILTER (WHERE {missing}) / count(*)", "kept"))
    for c in ("cust_key", "balance", "created_date"):
        parts.append(_line_sql("parse_success", c, "parse_success_pct", f"count({c}) / count(*)", "kept"))
    keys = "(SELECT sum(n) AS total, count(*) AS keys_, count(*) FILTER (WHERE n > 1) AS again FROM (SELECT count(*) AS n FROM kept GROUP BY cust_key))"
    for metric, figure in (
        ("total_rows", "total"), ("distinct_keys", "keys_"), ("duplicate_rows", "total - keys_"),
        ("duplicate_row_pct", "(total - keys_) / total"), ("keys_with_duplicates", "again"),
    ):
        parts.append(_line_sql("duplicates", "", metric, figure, keys))
    far = """(SELECT count(*) FILTER (WHERE abs(balance - m) > 3 * s) AS n, count(*) AS total FROM kept,
        (SELECT avg(balance) AS m, stddev_samp(balance) AS s FROM kept))"""
    parts.append(_line_sql("outliers", "balance", "n_outliers", "n", far))
    parts.append(_line_sql("outliers", "balance", "pct_outliers", "n / total", far))
    parts.append("SELECT 'outliers', 'balance', 'rule', NULL, '|value-mean|>3.0*std'")
    sizes = "(SELECT count(*) AS total, count(*) FILTER (WHERE flag_raw IN ('Yes', 'no', 'T')) AS held FROM clean)"
    for metric, figure in (
        ("total_rows_before_filter", "total"), ("rows_after_filter", "held"),
        ("rows_removed", "total - held"), ("pct_rows_removed", "(total - held) / total"),
    ):
        parts.append(_line_sql("flag_raw_allowed", "", metric, figure, sizes))
    return " UNION ALL ".join(parts)


def _pii_sql() -> str:
    parts = []
    for c in ("contact", "name_raw"):
        for metric, figure in (
            ("email_pattern", f"count(*) FILTER (WHERE {_email(c)})"),
            ("student_id_pattern", f"count(*) FILTER (WHERE {_student(c)})"),
            ("total", f"count(*) FILTER (WHERE {_any(c)})"),
            ("pct_of_rows", f"round(100 * count(*) FILTER (WHERE {_any(c)}) / count(*), 2)"),
        ):
            parts.append(_line_sql("redacted", c, metric, figure, "kept"))
    parts += [_line_sql("redacted" if c != "amount_raw" else "dropped", c, "total_records", "count(*)", "kept") for c in ("contact", "name_raw", "amount_raw")]
    return " UNION ALL ".join(parts)


@query(
    "job_reports",
    f"""WITH {_RAW_SQL}, {_CLEAN_SQL}, kept AS (SELECT * FROM clean WHERE flag_raw IN ('Yes', 'no', 'T'))
    SELECT 'structural' AS report, * FROM ({_structural_sql(
        "raw", _NAMES, _RAW_TEXT, ("CustKey", "Balance"), jobs.PROFILE_TOP_VALUES, _NAMES.items())})
    UNION ALL SELECT 'quality', * FROM ({_quality_sql()})
    UNION ALL SELECT 'pii', * FROM ({_pii_sql()})""",
)
def _(t):
    """Every line of the three reports that the two jobs leave."""
    base = _run_jobs(t)

    def report(tier: str, name: str):
        return t.spark.read.json(report_path(f"{base}/{tier}", CUSTOMERS.dataset, CUSTOMERS.table, name))

    pii = report("published", "pii")
    figures = ["email_pattern", "student_id_pattern", "total", "pct_of_rows", "total_records"]
    pii = pii.select(
        F.col("action").alias("section"), "column", *[F.col(f).cast("double") for f in figures]
    ).unpivot(["section", "column"], figures, "metric", "number").where("number IS NOT NULL")
    parts = {
        # Empty text is no value in a file.
        "structural": _exactly(_numbered(report("clean", "structural")), _raw_customers(t).replace("", None)),
        "quality": _numbered(report("clean", "quality")),
        "pii": pii.select("section", "column", "metric", F.round("number", 4).alias("number"), F.lit(None).cast("string").alias("text")),
    }
    named = [df.select(F.lit(name).alias("report"), "*") for name, df in parts.items()]
    return reduce(DataFrame.unionByName, named)


@query(
    "csv_round_trip",
    """SELECT conv_id, turn, nullif(role, '') AS role, nullif(text, '') AS text
    FROM conversations""",
)
def _(t):
    folder = f"{scratch_folder(t.spark)}/round-trip-{uuid.uuid4().hex}"
    source = t.conversations
    path = publish(source, folder, "sample", "conversations")
    return scan(t.spark, path, source.schema, multiline=True)


@query(
    "inferred_scan",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
    'int, int, string, double, string' AS types FROM orders""",
)
def _(t):
    folder = f"{scratch_folder(t.spark)}/inferred-{uuid.uuid4().hex}"
    source = t.orders.drop("o_orderdate")
    found = scan(t.spark, publish(source, folder, "sample", "orders"))
    types = ", ".join(kind for _, kind in found.dtypes)
    wide = found.select(*[F.col(c).cast(kind) for c, kind in source.dtypes])
    return wide.withColumn("types", F.lit(types))


_PARTS = ("customer", "orders", "lineitem")


@query(
    "input_guard",
    " UNION ALL ".join(f"SELECT '{n}' AS input, true AS found, count(*) AS n_rows FROM {n}" for n in _PARTS)
    + " UNION ALL SELECT 'returns', false, CAST(NULL AS BIGINT)",
)
def _(t):
    """Three tables that are there and one that has not come."""
    inputs = {n: (t.path(n), getattr(t, n).schema) for n in _PARTS}
    inputs["returns"] = (t.path("returns"), t.orders.schema)
    return input_status(t.spark, inputs, fmt="parquet")


_WHOLE = r"regexp_full_match(amount_raw, '-?[0-9]+')"


@query(
    "contract_drift",
    f"""WITH n AS (SELECT count(c_custkey) AS k, count(nullif(amount_raw, '')) AS a,
        count(nullif(amount_raw, '')) - count(*) FILTER (WHERE {_WHOLE}) AS bad,
        count(balance) AS b, count(nullif(segment, '')) AS s FROM {{dirty_customer}})
    SELECT 'c_custkey' AS "column", 'bigint' AS expected, 0 AS place, 0 AS found_at,
        'ok' AS status, k AS n_filled, CAST(0 AS BIGINT) AS n_malformed FROM n
    UNION ALL SELECT 'amount_raw', 'int', 1, 2, 'moved', a, bad FROM n
    UNION ALL SELECT 'balance', 'double', 2, NULL, 'missing', NULL, NULL FROM n
    UNION ALL SELECT 'segment', 'string', 3, 1, 'moved', s, 0 FROM n
    UNION ALL SELECT 'balance_eur', NULL, NULL, 3, 'unexpected', b, 0 FROM n""",
)
def _(t):
    """An export with two columns changed over and one renamed."""
    folder = f"{scratch_folder(t.spark)}/drift-{uuid.uuid4().hex}"
    source = t.dirty_customer.select(
        "c_custkey", "segment", "amount_raw", F.col("balance").alias("balance_eur")
    )
    path = publish(source, folder, "sample", "customers")
    contract = T.StructType.fromDDL("c_custkey bigint, amount_raw int, balance double, segment string")
    return contract_report(t.spark, path, contract)


@query(
    "column_validation",
    """SELECT 'l_orderkey' AS "column", 'bigint' AS expected, 'bigint' AS found, 'ok' AS status,
        count(l_orderkey) AS n_filled FROM lineitem
    UNION ALL SELECT 'l_returnflag', 'boolean', 'string', 'other_type', count(l_returnflag) FROM lineitem
    UNION ALL SELECT 'l_currency', 'string', NULL, 'absent', NULL""",
)
def _(t):
    wanted = {"l_orderkey": "bigint", "l_returnflag": "boolean", "l_currency": "string"}
    return column_report(t.lineitem, wanted)


# Cells of a made-up export, by type: SQL that both sides read alike. ``{i}`` is the
# column's place.
_CELLS = {
    "bigint": "c_custkey * ({i} + 1)",
    "int": "CAST((c_custkey * ({i} + 3)) % 17 AS INT)",
    "double": "CAST(c_custkey AS DOUBLE) / 4",
    "boolean": "(c_custkey + {i}) % 2 = 0",
    "timestamp": "make_timestamp(CAST(2000 + (c_custkey + {i}) % 20 AS INT), CAST(1 + c_custkey % 12 AS INT), 5, 6, 7, 8)",
    "string": """CASE (c_custkey + {i}) % 5 WHEN 0 THEN 'N/A' WHEN 1 THEN 'mail user' || c_custkey || '@example.org now'
        WHEN 2 THEN '  Some ' || chr(9) || ' text ' || c_custkey || ' ' WHEN 3 THEN c_name ELSE 'word' END""",
}
_ALLOWED = "CASE c_custkey % 3 WHEN 0 THEN 'Auto' WHEN 1 THEN 'Module' ELSE 'Other' END"


def _cells(spec: TableSpec) -> list[tuple[str, str, str]]:
    """Clean name, type and SQL of every column of a table's export."""
    # From the text, as queries are registered before there is a session.
    fields = [field.split() for field in spec.raw_ddl.split(",")]
    clean = standardize_column_names([name for name, _ in fields])
    return [
        (name, kind, _ALLOWED if spec.allowed and name == spec.allowed[0] else _CELLS[kind].format(i=i))
        for i, (name, (_, kind)) in enumerate(zip(clean, fields))
    ]


def _published_lines_sql(spec: TableSpec) -> str:
    clean, published = [], []
    for name, kind, cell in _cells(spec):
        if kind == "string":
            cell = f"trim(regexp_replace({cell}, '\\s+', ' ', 'g'))"
            if name in spec.null_columns:
                cell = f"CASE WHEN lower({cell}) IN ({_MISSING_WORDS}) THEN NULL ELSE {cell} END"
        clean.append(f"{cell} AS {name}")
    source = f"(SELECT {', '.join(clean)} FROM customer)"
    if spec.allowed:
        name, values = spec.allowed
        source = f"(SELECT * FROM {source} WHERE {name} IN ({', '.join(repr(v) for v in values)}))"
    kinds = [(name, kind) for name, kind, _ in _cells(spec)]
    if spec.filled_flag:
        source = f"(SELECT *, coalesce({spec.filled_flag} <> '', false) AS has_{spec.filled_flag} FROM {source})"
        kinds.append((f"has_{spec.filled_flag}", "boolean"))
    for name, kind in kinds:
        if name in spec.dropped:
            continue
        mark = f"'[PII_REDACTED_{name.upper()}]'"
        pii = f"coalesce({_any(name)}, false)" if name in spec.redacted else "false"
        total = {
            "string": f"CASE WHEN {pii} THEN length({mark}) ELSE length({name}) END",
            "boolean": f"CAST({name} AS INT)",
            "timestamp": f"epoch({name})",
        }.get(kind, name)
        missing = _missing_sql(name, [name] if kind == "string" else [])
        no = "CAST(NULL AS BIGINT)"
        counted = no if name == f"has_{spec.filled_flag}" else f"count(*) FILTER (WHERE {missing})"
        reported = f"count(*) FILTER (WHERE {pii})" if name in spec.redacted else no
        published.append(
            f"""SELECT '{spec.table}' AS "table", '{name}' AS "column", count(*) AS n_rows,
            count({name}) AS n_filled, count(*) FILTER (WHERE {pii}) AS n_redacted,
            CAST(sum({total}) AS DOUBLE) AS total, {counted} AS n_missing, {reported} AS n_reported FROM {source}"""
        )
    return " UNION ALL ".join(published)


def _published_lines(t, base: str, spec: TableSpec) -> DataFrame:
    """One line per published column: rows, values, redacted values and a sum of the data,
    and what the quality and PII reports say of it."""
    where = (spec.dataset, spec.table)
    published = scan(t.spark, data_path(f"{base}/published", *where), spec.published_schema)
    figures, lines = [F.count(F.lit(1)).alias("n_rows")], []
    for i, field in enumerate(published.schema):
        value, kind = F.col(field.name), field.dataType.simpleString()
        number = {"string": F.length(value), "boolean": value.cast("int"), "timestamp": F.unix_timestamp(value)}
        mark = F.lit(placeholder(field.name))
        figures += [
            F.count(value).alias(f"f{i}"),
            F.count_if(value.cast("string") == mark).alias(f"r{i}"),
            F.sum(number.get(kind, value).cast("double")).alias(f"t{i}"),
        ]
        lines.append(
            F.struct(
                F.lit(field.name).alias("column"), "n_rows", F.col(f"f{i}").alias("n_filled"),
                F.col(f"r{i}").alias("n_redacted"), F.col(f"t{i}").alias("total"),
            )
        )
    data = published.agg(*figures).select(F.inline(F.array(*lines)))
    missing = (
        t.spark.read.schema("section string, column string, metric string, value string")
        .json(report_path(f"{base}/clean", *where, "quality"))
        .where("section = 'missingness' AND metric = 'n_missing'")
        .select("column", F.col("value").cast("long").alias("n_missing"))
    )
    seen = (
        t.spark.read.schema("action string, column string, total long")
        .json(report_path(f"{base}/published", *where, "pii"))
        .where("action = 'redacted'")
        .select("column", F.col("total").alias("n_reported"))
    )
    joined = data.join(missing, "column", "left").join(seen, "column", "left")
    return joined.select(F.lit(spec.table).alias("table"), *joined.columns)


def export(t, base: str, at_once: int = 4) -> None:
    """The exports of all tables, as text. Files with line breaks are read by one task each
    and the customers may come in few splits, so rows are dealt to as many files as there
    are cores, more where a file would have over a million; tables are written together."""
    parts = max(t.spark.sparkContext.defaultParallelism, -(-t.customer.count() // 1_000_000))

    def write(spec: TableSpec) -> None:
        names = [f.name for f in spec.raw_schema]
        rows = t.customer.repartition(parts)
        raw = rows.select(*[F.expr(cell).alias(n) for n, (_, _, cell) in zip(names, _cells(spec))])
        raw.write.options(
            header="true", quote='"', escape='"', quoteAll="true",
            ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false",
        ).csv(f"{base}/{spec.raw_file}")

    with ThreadPoolExecutor(at_once) as pool:
        list(pool.map(inheritable_thread_target(t.spark)(write), TABLES.values()))


@query("pipeline_all_tables", " UNION ALL ".join(_published_lines_sql(spec) for spec in TABLES.values()))
def _(t):
    """Both tiers of all eight tables, under their own contracts."""
    base = f"{scratch_folder(t.spark)}/tiers-{uuid.uuid4().hex}"
    try:
        export(t, f"{base}/raw")
        jobs.run_pipeline(t.spark, f"{base}/raw", f"{base}/clean", f"{base}/published")
    finally:
        remove(t.spark, f"{base}/raw")
    return reduce(DataFrame.unionByName, [_published_lines(t, base, spec) for spec in TABLES.values()])


_NUMBERS = ("c_custkey", "balance")
_DIRTY_COLUMNS = ("c_custkey", "name_raw", "contact", "flag_raw", "amount_raw", "balance", "segment", "is_active")


@query("structural_report", _structural_sql("{dirty_customer}", _DIRTY_COLUMNS, _TEXT, _NUMBERS, 3))
def _(t):
    return _exactly(_numbered(reports.structural_report(t.dirty_customer, top_values_k=3)), t.dirty_customer)


@query(
    "quality_report",
    f"""WITH missed AS ({MISSINGNESS_SQL}),
    d AS (SELECT sum(n) AS total, count(*) AS keys_, count(*) FILTER (WHERE n > 1) AS rep
        FROM (SELECT count(*) AS n FROM {{dirty_customer}} GROUP BY segment)),
    o AS (SELECT count(*) FILTER (WHERE abs(balance - m) > 3 * s) AS n, count(*) AS total
        FROM {{dirty_customer}}, (SELECT avg(balance) AS m, stddev_samp(balance) AS s
        FROM {{dirty_customer}}))
    SELECT 'missingness' AS section, "column", 'n_missing' AS metric,
        CAST(n_missing AS DOUBLE) AS number, NULL AS text FROM missed
    UNION ALL SELECT 'missingness', "column", 'pct_missing', round(pct_missing, 4), NULL
        FROM missed
    UNION ALL SELECT 'parse_success', "column", 'parse_success_pct',
        round(1 - pct_missing, 4), NULL FROM missed WHERE "column" IN {_NUMBERS}
    UNION ALL SELECT 'duplicates', '', 'total_rows', CAST(total AS DOUBLE), NULL FROM d
    UNION ALL SELECT 'duplicates', '', 'distinct_keys', CAST(keys_ AS DOUBLE), NULL FROM d
    UNION ALL SELECT 'duplicates', '', 'duplicate_rows', CAST(total - keys_ AS DOUBLE), NULL FROM d
    UNION ALL SELECT 'duplicates', '', 'duplicate_row_pct',
        round((total - keys_) / total, 4), NULL FROM d
    UNION ALL SELECT 'duplicates', '', 'keys_with_duplicates', CAST(rep AS DOUBLE), NULL FROM d
    UNION ALL SELECT 'outliers', 'balance', 'n_outliers', CAST(n AS DOUBLE), NULL FROM o
    UNION ALL SELECT 'outliers', 'balance', 'pct_outliers', round(n / total, 4), NULL FROM o
    UNION ALL SELECT 'outliers', 'balance', 'rule', NULL, '|value-mean|>3.0*std'
    UNION ALL SELECT 'extra', '', 'rows', CAST(count(*) AS DOUBLE), NULL
        FROM {{dirty_customer}}""",
)
def _(t):
    report = reports.quality_report(
        t.dirty_customer,
        key_columns=["segment"],
        numeric_columns=["balance"],
        extra_sections={"extra": t.dirty_customer.agg(F.count(F.lit(1)).alias("rows"))},
    )
    return _numbered(report)
