from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from coursegrain.functions.detectors import (
    has_any_pii,
    has_email_pattern,
    has_student_id_pattern,
    pattern_detector,
)
from coursegrain.operators import redaction


@pytest.fixture
def notes(spark):
    return spark.createDataFrame(
        [
            ("mail JOE.x+1@EXAMPLE.Org now", "A00123456"),
            ("id A00123456, joe@example.org", None),
            ("BA00123456 a00123456 A001234567", "x@y"),
            (None, "x@y.zz"),
        ],
        "note string, other string",
    )


def flags(df, condition):
    return [r[0] for r in df.select(condition).collect()]


def test_detectors(notes):
    assert flags(notes, has_email_pattern("note")) == [True, True, False, None]
    assert flags(notes, has_student_id_pattern("note")) == [False, True, False, None]
    assert flags(notes, has_any_pii("other")) == [True, None, False, True]
    assert flags(notes, has_email_pattern("note", "other"))[3] is True
    with pytest.raises(ValueError):
        has_email_pattern()


def test_needed_character_only_saves_work(notes):
    plain = pattern_detector(r"(?i)[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}")
    for name in notes.columns:
        assert flags(notes, plain(name)) == flags(notes, has_email_pattern(name))


def test_whole_value_is_replaced(notes):
    out, counts = redaction.redact_pii_fields(
        notes, {"note": redaction.placeholder("note")}, has_any_pii
    )
    assert [r[0] for r in out.collect()] == [
        "[PII_REDACTED_NOTE]",
        "[PII_REDACTED_NOTE]",
        "BA00123456 a00123456 A001234567",
        None,
    ]
    assert [tuple(r) for r in counts.collect()] == [("note", 2, 1, 2)]
    assert out.columns == notes.columns


def test_default_detector_is_email(notes):
    out, counts = redaction.redact_pii_fields(notes, {"other": "gone"})
    assert [r[1] for r in out.collect()] == ["A00123456", None, "x@y", "gone"]
    assert tuple(counts.first()) == ("other", 1, 1, 1)


def test_total_is_at_most_the_sum_of_parts(notes):
    for r in redaction.pii_counts(notes, notes.columns).collect():
        assert r["total"] <= r["email_pattern"] + r["student_id_pattern"]


def test_report(notes):
    report = redaction.pii_report(
        notes, dataset="d", table="t", dropped=["a", "b"], fields=["note"]
    )
    lines = {r["column"]: r for r in report.collect()}
    assert lines["note"]["pct_of_rows"] == 50.0 and lines["a"]["action"] == "dropped"
    nothing = redaction.pii_report(notes, dataset="d", table="t", dropped=[], fields=[])
    assert nothing.count() == 0


def test_custom_detector(notes):
    shouting = lambda *cs: F.upper(F.col(cs[0]) if isinstance(cs[0], str) else cs[0]) == cs[0]
    out = redaction.redact(notes, {"other": "caps"}, shouting)
    assert [r[1] for r in out.collect()] == ["caps", None, "x@y", "x@y.zz"]
