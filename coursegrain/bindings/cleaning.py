"""Canonicalisers, naming and row filters as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, text
from ..functions.missing import is_filled
from ..operators import cleaning, columns, profiling
from .profiling import _MISSING_WORDS
from .registry import query


@query(
    "canonicalize_nulls",
    f"""SELECT c_custkey,
    CASE WHEN lower(trim(name_raw)) IN ({_MISSING_WORDS}) THEN NULL ELSE name_raw END
        AS name_raw,
    CASE WHEN lower(trim(segment)) IN ({_MISSING_WORDS}, 'furniture') THEN NULL
        ELSE segment END AS segment FROM {{dirty_customer}}""",
)
def _(t):
    df = t.dirty_customer.select("c_custkey", "name_raw", "segment")
    df = cleaning.canonicalize_nulls(df, ["name_raw"])
    return cleaning.canonicalize_nulls(df, ["segment"], extra_sentinels=["Furniture"])


@query(
    "trim_whitespace",
    r"""SELECT c_custkey, trim(regexp_replace(name_raw, '\s+', ' ', 'g')) AS name_raw,
    trim(regexp_replace(flag_raw, '\s+', ' ', 'g')) AS flag_raw FROM {dirty_customer}""",
)
def _(t):
    return cleaning.trim_whitespace(t.dirty_customer.select("c_custkey", "name_raw", "flag_raw"))


@query(
    "trim_whitespace_outer",
    "SELECT c_custkey, trim(name_raw) AS name_raw FROM {dirty_customer}",
)
def _(t):
    return cleaning.trim_whitespace(
        t.dirty_customer.select("c_custkey", "name_raw"), collapse_internal=False
    )


_BOOLEAN_SQL = """CASE WHEN lower(trim(flag_raw)) IN ('y', 'yes', 'true', 't', '1'{t})
    THEN {yes} WHEN lower(trim(flag_raw)) IN ('n', 'no', 'false', 'f', '0')
    THEN {no} ELSE {rest} END AS flag_raw"""


@query(
    "normalize_booleans",
    "SELECT c_custkey, "
    + _BOOLEAN_SQL.format(t="", yes="true", no="false", rest="NULL")
    + " FROM {dirty_customer}",
)
def _(t):
    df = t.dirty_customer.select("c_custkey", "flag_raw")
    return cleaning.normalize_booleans(df, ["flag_raw"])


@query(
    "normalize_booleans_text",
    "SELECT c_custkey, "
    + _BOOLEAN_SQL.format(t=", 'maybe'", yes="'true'", no="'false'", rest="flag_raw")
    + " FROM {dirty_customer}",
)
def _(t):
    df = t.dirty_customer.select("c_custkey", "flag_raw")
    return cleaning.normalize_booleans(
        df, ["flag_raw"], true_values=["Maybe"], output_type="string"
    )


@query(
    "normalize_numeric_strings",
    r"""SELECT c_custkey, TRY_CAST(regexp_replace(amount_raw, '[^0-9+\-.]', '', 'g')
    AS DOUBLE) AS amount_raw FROM {dirty_customer}""",
)
def _(t):
    df = t.dirty_customer.select("c_custkey", "amount_raw")
    return cleaning.normalize_numeric_strings(df, ["amount_raw"])


@query(
    "standardize_datetimes",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS o_orderdate
    FROM orders""",
)
def _(t):
    return cleaning.standardize_datetimes_iso(t.orders.select("o_orderkey", "o_orderdate"))


@query(
    "parse_timestamps",
    """SELECT c_custkey, TRY_CAST(CASE WHEN c_custkey % 4 = 0 THEN '1-2' ELSE
    CAST(2000 + c_custkey % 30 AS VARCHAR) || '-02-29 10:00:00' END AS TIMESTAMP) AS stamp
    FROM customer""",
)
def _(t):
    made = F.when(F.col("c_custkey") % 4 == 0, "1-2").otherwise(
        F.concat((F.col("c_custkey") % 30 + 2000).cast("string"), F.lit("-02-29 10:00:00"))
    )
    df = t.customer.select("c_custkey", made.alias("stamp"))
    return cleaning.parse_timestamps(df, ["stamp"])


@query(
    "normalize_column_names",
    """SELECT OrderKey AS order_key, LineNumber AS line_number, partKey2 AS part_key2,
    RFlag AS r_flag, price FROM {camel_lines}""",
)
def _(t):
    return columns.normalize_column_names(t.camel_lines)


@query(
    "rename_suggestions",
    """SELECT original, suggested, CASE WHEN original = 'RFlag' THEN
    (SELECT count(*) FROM lineitem WHERE l_linenumber = 3) ELSE 0 END AS n_missing
    FROM (VALUES ('OrderKey', 'order_key'), ('LineNumber', 'line_number'),
    ('partKey2', 'part_key2'), ('RFlag', 'r_flag')) AS s(original, suggested)""",
)
def _(t):
    lines = t.camel_lines
    missing = profiling.profile_missingness(lines).select(
        F.col("column").alias("original"), "n_missing"
    )
    return columns.rename_suggestions(lines).join(missing, "original")


@query(
    "clamp_years",
    """SELECT o_orderkey, CASE WHEN year(o_orderdate) BETWEEN 1996 AND 2000
    THEN o_orderdate END AS o_orderdate FROM orders""",
)
def _(t):
    df = t.orders.select("o_orderkey", "o_orderdate")
    return cleaning.clamp_years(df, ["o_orderdate", "not_there"], first=1996, last=2000)


@query(
    "non_empty_flag",
    """SELECT c_custkey, name_raw IS NOT NULL AND name_raw <> '' AS has_name,
    contact IS NOT NULL AND contact <> '' AS has_contact FROM {dirty_customer}""",
)
def _(t):
    return t.dirty_customer.select(
        "c_custkey",
        is_filled(F.col("name_raw")).alias("has_name"),
        is_filled(F.col("contact")).alias("has_contact"),
    )


@query("drop_columns", "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer")
def _(t):
    return cleaning.drop_columns(t.customer, ["c_name", "c_acctbal", "not_there"])


@query(
    "basic_filters",
    """SELECT c_custkey, segment, contact, balance, is_active FROM {dirty_customer}
    WHERE is_active AND segment = 'MACHINERY' AND contact IS NOT NULL
    AND (balance IS NULL OR (balance >= 1000 AND balance < 8000))
    AND coalesce(flag_raw NOT IN ('no', 'maybe'), true)""",
)
def _(t):
    excluded = F.coalesce(F.col("flag_raw").isin("no", "maybe"), F.lit(False))
    in_range = (F.col("balance") >= 1000) & (F.col("balance") < 8000)
    return t.dirty_customer.where(
        F.col("is_active")
        & (F.col("segment") == "MACHINERY")
        & F.col("contact").isNotNull()
        & (F.col("balance").isNull() | in_range)
        & ~excluded
    ).select("c_custkey", "segment", "contact", "balance", "is_active")


@query(
    "year_term_label",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) || ' ' ||
    CASE WHEN month(o_orderdate) <= 4 THEN 'Winter' WHEN month(o_orderdate) <= 8
    THEN 'Summer' ELSE 'Fall' END AS year_term,
    CASE WHEN year(o_orderdate) < 1996 THEN 'Before 1996' WHEN year(o_orderdate) < 1998
    THEN '1996-1998' WHEN year(o_orderdate) < 2000 THEN '1998-2000' ELSE '2000+' END
        AS half_open,
    CASE WHEN year(o_orderdate) BETWEEN 1996 AND 1997 THEN '1996-1997'
    WHEN year(o_orderdate) BETWEEN 1998 AND 1999 THEN '1998-1999' ELSE 'Other' END
        AS closed FROM orders""",
)
def _(t):
    when = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey",
        dates.year_term(when).alias("year_term"),
        dates.year_interval(F.year(when), (1996, 1998, 2000)).alias("half_open"),
        dates.year_period(F.year(when), ((1996, 1997), (1998, 1999))).alias("closed"),
    )


@query(
    "school_prefix",
    """SELECT org_unit_id, upper(coalesce(
    nullif(regexp_extract(code, '^([A-Za-z]{3,})', 1), ''),
    nullif(regexp_extract(name, '^([A-Za-z]{3,})', 1), ''), 'UNKNOWN')) AS school
    FROM {units}""",
)
def _(t):
    school = text.leading_word(F.col("code"), F.col("name"))
    return t.units.select("org_unit_id", school.alias("school"))


@query(
    "token_count",
    r"""SELECT org_unit_id, CAST(CASE WHEN trim(coalesce(code, '')) = '' THEN 0
    ELSE len(regexp_split_to_array(trim(code), '\s+')) END AS INTEGER) AS n_tokens
    FROM {units}""",
)
def _(t):
    return t.units.select("org_unit_id", text.token_count(F.col("code")).alias("n_tokens"))


@query(
    "keyword_flag",
    """SELECT org_unit_id, coalesce(contains(lower(name), 'x-list'), false) AS is_xlist
    FROM {units}""",
)
def _(t):
    flag = text.has_keyword(F.col("name"), "X-List")
    return t.units.select("org_unit_id", flag.alias("is_xlist"))
