"""Profiles and quality figures as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import profiling, quality
from .registry import query, rounded

_MISSING_WORDS = (
    "'', 'n/a', 'na', 'n.a.', 'none', 'null', 'unknown', 'unspecified', 'missing'"
)
_TEXT = ("name_raw", "contact", "flag_raw", "amount_raw", "segment")
_DIRTY = {
    "c_custkey": "c_custkey IS NULL",
    "balance": "balance IS NULL",
    "is_active": "is_active IS NULL",
    **{c: f"{c} IS NULL OR lower(trim({c})) IN ({_MISSING_WORDS})" for c in _TEXT},
}
_ORDERS = (
    "o_orderkey",
    "o_custkey",
    "o_orderstatus",
    "o_totalprice",
    "o_orderdate",
    "o_orderpriority",
)
_LINE_NUMBERS = (
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
)


def _each(template: str, items) -> str:
    return " UNION ALL ".join(template.format(c=c) for c in items)


MISSINGNESS_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE {miss}) AS n_missing,
        round(count(*) FILTER (WHERE {miss}) / count(*), 6) AS pct_missing
        FROM {{dirty_customer}}"""
    for c, miss in _DIRTY.items()
)


@query(
    "profile_shape",
    "SELECT count(*) AS n_rows, CAST(11 AS BIGINT) AS n_columns FROM lineitem",
)
def _(t):
    return profiling.profile_shape(t.lineitem)


@query("profile_missingness", MISSINGNESS_SQL)
def missingness(t):
    return rounded(profiling.profile_missingness(t.dirty_customer), "pct_missing")


@query(
    "profile_cardinality_exact",
    _each(
        """SELECT '{c}' AS "column", count(DISTINCT {c}) AS n_distinct,
        round(count(DISTINCT {c}) / count(*), 6) AS pct_distinct FROM orders""",
        _ORDERS,
    ),
)
def _(t):
    return rounded(
        profiling.profile_cardinality(t.orders, use_approx=False), "pct_distinct"
    )


_ORDER_COLUMNS = "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority".split()


@query(
    "profile_cardinality_approx",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_exact, true AS within_bound FROM orders"
        for c in _ORDER_COLUMNS
    ),
)
def _(t):
    """The sketch's default relative deviation is 5 %; three times that is the bound."""
    orders = t.orders.select(*_ORDER_COLUMNS)
    found = profiling.profile_cardinality(orders)
    exact = profiling.profile_cardinality(orders, use_approx=False).select(
        "column", F.col("n_distinct").alias("n_exact")
    )
    off = F.abs(F.col("n_distinct") - F.col("n_exact")) <= 0.15 * F.col("n_exact") + 1
    return found.join(exact, "column").select("column", "n_exact", off.alias("within_bound"))


@query(
    "profile_numeric",
    _each(
        """SELECT '{c}' AS "column", count({c}) AS "count",
        round(avg(CAST({c} AS DOUBLE)), 4) AS mean,
        round(stddev_samp(CAST({c} AS DOUBLE)), 4) AS stddev,
        round(CAST(min({c}) AS DOUBLE), 4) AS min,
        round(CAST(max({c}) AS DOUBLE), 4) AS max FROM lineitem""",
        _LINE_NUMBERS,
    ),
)
def _(t):
    found = profiling.profile_numeric_distribution(t.lineitem)
    return rounded(found, "mean", "stddev", "min", "max", places=4)


@query(
    "profile_top_values",
    f"""
    WITH cells AS ({_each('''SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS value
        FROM orders''', _ORDERS)}),
    counts AS (SELECT "column", value, count(*) AS "count" FROM cells GROUP BY 1, 2),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY "column"
        ORDER BY "count" DESC, value) AS place FROM counts)
    SELECT "column", value, "count",
        round("count" / (SELECT count(*) FROM orders), 6) AS pct
    FROM ranked WHERE place <= 5""",
)
def _(t):
    return rounded(profiling.profile_top_values(t.orders, k=5), "pct")


def _duplicates_sql(table: str, keys: str) -> str:
    return f"""
        WITH per_key AS (SELECT {keys}, count(*) AS n FROM {table} GROUP BY {keys})
        SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(*) AS distinct_keys,
            CAST(sum(n) AS BIGINT) - count(*) AS duplicate_rows,
            round((sum(n) - count(*)) / sum(n), 6) AS duplicate_row_pct,
            count(*) FILTER (WHERE n > 1) AS keys_with_duplicates FROM per_key"""


@query("quality_duplicates", _duplicates_sql("lineitem", "l_orderkey, l_linenumber"))
def _(t):
    found = quality.duplicate_stats(t.lineitem, ["l_orderkey", "l_linenumber"])
    return rounded(found, "duplicate_row_pct")


@query(
    "quality_duplicates_null_key",
    _duplicates_sql("{dirty_customer}", "flag_raw, segment"),
)
def _(t):
    found = quality.duplicate_stats(t.dirty_customer, ["flag_raw", "segment"])
    return rounded(found, "duplicate_row_pct")


@query(
    "quality_duplicates_metrics",
    """
    WITH per_key AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1),
    totals AS (SELECT sum(n) AS rows_, count(*) AS keys_,
        count(*) FILTER (WHERE n > 1) AS repeated FROM per_key)
    SELECT 'total_rows' AS metric, CAST(CAST(rows_ AS BIGINT) AS VARCHAR) AS value FROM totals
    UNION ALL SELECT 'distinct_keys', CAST(keys_ AS VARCHAR) FROM totals
    UNION ALL SELECT 'duplicate_rows', CAST(CAST(rows_ - keys_ AS BIGINT) AS VARCHAR) FROM totals
    UNION ALL SELECT 'keys_with_duplicates', CAST(repeated AS VARCHAR) FROM totals""",
)
def _(t):
    stats = quality.duplicate_stats(t.orders, ["o_custkey"])
    return quality.metric_rows(stats.drop("duplicate_row_pct"))


@query(
    "quality_parse_success",
    _each(
        """SELECT '{c}' AS "column",
        round(1 - count(*) FILTER (WHERE {c} IS NULL) / count(*), 6)
        AS parse_success_pct FROM {{dirty_customer}}""",
        ("c_custkey", "balance"),
    ),
)
def _(t):
    return rounded(quality.parse_success(t.dirty_customer), "parse_success_pct")


def _outliers_sql(table: str, columns, z: float) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE
        abs({c} - (SELECT avg({c}) FROM {table})) >
        {z} * (SELECT stddev_samp({c}) FROM {table})) AS n_outliers,
        round(count(*) FILTER (WHERE abs({c} - (SELECT avg({c}) FROM {table})) >
        {z} * (SELECT stddev_samp({c}) FROM {table})) / count(*), 6) AS pct_outliers,
        '|value-mean|>{z}*std' AS rule FROM {table}"""
        for c in columns
    )


@query("quality_outliers", _outliers_sql("lineitem", _LINE_NUMBERS, 1.5))
def _(t):
    found = quality.numeric_outliers(t.lineitem, z_threshold=1.5)
    return rounded(found, "pct_outliers")


@query(
    "quality_outliers_default",
    _outliers_sql("events", ("value",), 3.0),
)
def _(t):
    found = quality.numeric_outliers(t.events, numeric_columns=["value"])
    return rounded(found, "pct_outliers")


@query(
    "filter_allowed_values",
    """SELECT o_orderkey, o_orderpriority FROM orders
    WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""",
)
def _(t):
    kept, _summary = quality.filter_allowed_values(
        t.orders, "o_orderpriority", ["1-URGENT", "2-HIGH"]
    )
    return kept.select("o_orderkey", "o_orderpriority")


@query(
    "filter_allowed_values_summary",
    """SELECT count(*) AS total_rows_before_filter,
    count(*) FILTER (WHERE flag_raw IN ('Yes', 'no')) AS rows_after_filter,
    count(*) - count(*) FILTER (WHERE flag_raw IN ('Yes', 'no')) AS rows_removed,
    round((count(*) - count(*) FILTER (WHERE flag_raw IN ('Yes', 'no'))) / count(*), 6)
        AS pct_rows_removed FROM {dirty_customer}""",
)
def _(t):
    _kept, summary = quality.filter_allowed_values(
        t.dirty_customer, "flag_raw", ["Yes", "no"]
    )
    return rounded(summary, "pct_rows_removed")


@query(
    "orphan_check",
    """SELECT count(*) AS n_referencing,
    count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM {strayed_orders} e
        WHERE e.o_custkey = c.c_custkey)) AS n_orphans,
    round(count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM {strayed_orders} e
        WHERE e.o_custkey = c.c_custkey)) / count(*), 6) AS pct_orphans
    FROM customer c""",
)
def _(t):
    found = quality.orphan_summary(
        t.customer, "c_custkey", t.strayed_orders, "o_custkey"
    )
    return rounded(found, "pct_orphans")


@query(
    "orphan_rows",
    """SELECT doc_id FROM documents d
    WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
)
def _(t):
    found = quality.orphans(t.documents.select("doc_id"), "doc_id", t.labels, "doc_id")
    return found.select("doc_id")
