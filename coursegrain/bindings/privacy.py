"""Detection, redaction and their accounts as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.detectors import has_any_pii, has_email_pattern, has_student_id_pattern
from ..operators import redaction
from .registry import query

_EMAIL = r"'(?i)[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{{2,}}'".format()
_STUDENT = r"'\bA\d{{8}}\b'".format()


def _email(c: str) -> str:
    return f"regexp_matches({c}, {_EMAIL})"


def _student(c: str) -> str:
    return f"regexp_matches({c}, {_STUDENT})"


def _any(c: str) -> str:
    return f"({_email(c)} OR {_student(c)})"


@query(
    "detect_email",
    f"SELECT doc_id, {_email('text')} AS has_email FROM documents",
)
def _(t):
    return t.documents.select("doc_id", has_email_pattern("text").alias("has_email"))


@query(
    "detect_email_conversations",
    f"SELECT conv_id, turn FROM conversations WHERE {_email('text')} OR {_email('role')}",
)
def _(t):
    return t.conversations.where(has_email_pattern("text", "role")).select("conv_id", "turn")


@query(
    "detect_student_id",
    f"""SELECT c_custkey, {_student('contact')} AS in_contact,
    {_student('name_raw')} OR {_student('contact')} AS in_either
    FROM {{dirty_customer}}""",
)
def _(t):
    return t.dirty_customer.select(
        "c_custkey",
        has_student_id_pattern("contact").alias("in_contact"),
        has_student_id_pattern("name_raw", "contact").alias("in_either"),
    )


@query(
    "detect_any",
    f"SELECT c_custkey FROM {{dirty_customer}} WHERE {_any('contact')}",
)
def _(t):
    return t.dirty_customer.where(has_any_pii("contact")).select("c_custkey")


@query(
    "redact_texts",
    f"""SELECT doc_id, CASE WHEN {_any('text')} THEN '[PII_REDACTED_TEXT]' ELSE text END
    AS text FROM documents""",
)
def _(t):
    df = t.documents.select("doc_id", "text")
    return redaction.redact(df, {"text": redaction.placeholder("text")}, has_any_pii)


@query(
    "redact_pii",
    f"""SELECT c_custkey, CASE WHEN {_email('contact')} THEN '[GONE]' ELSE contact END
    AS contact, CASE WHEN {_email('name_raw')} THEN '[PII_REDACTED_NAME_RAW]'
    ELSE name_raw END AS name_raw FROM {{dirty_customer}}""",
)
def _(t):
    df = t.dirty_customer.select("c_custkey", "contact", "name_raw")
    fields = {"contact": "[GONE]", "name_raw": redaction.placeholder("name_raw")}
    redacted, _counts = redaction.redact_pii_fields(df, fields)
    return redacted


def _counts_sql(table: str, fields) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column",
        count(*) FILTER (WHERE {_email(c)}) AS email_pattern,
        count(*) FILTER (WHERE {_student(c)}) AS student_id_pattern,
        count(*) FILTER (WHERE {_any(c)}) AS total FROM {table}"""
        for c in fields
    )


@query("pii_counts", _counts_sql("{dirty_customer}", ("contact", "name_raw", "segment")))
def _(t):
    return redaction.pii_counts(t.dirty_customer, ["contact", "name_raw", "segment"])


@query("pii_counts_texts", _counts_sql("documents", ("text", "source")))
def _(t):
    return redaction.pii_counts(t.documents, ["text", "source"])


@query(
    "pii_report",
    f"""WITH counts AS ({_counts_sql('{dirty_customer}', ('contact', 'name_raw'))})
    SELECT 'sample' AS dataset, 'customer' AS "table", 'redacted' AS action, "column",
    email_pattern, student_id_pattern, total,
    round(total * 100 / (SELECT count(*) FROM customer), 2) AS pct_of_rows FROM counts
    UNION ALL SELECT 'sample', 'customer', 'dropped', 'balance', NULL, NULL, NULL, NULL""",
)
def _(t):
    return redaction.pii_report(
        t.dirty_customer,
        dataset="sample",
        table="customer",
        dropped=["balance"],
        fields=["contact", "name_raw"],
    )
