from __future__ import annotations

import re

import pytest
from hypothesis import given
from hypothesis import strategies as st

from coursegrain.operators import columns


@pytest.mark.parametrize(
    ("name", "snake"),
    [
        ("ContentObjectId", "content_object_id"),
        ("AIUtilization", "ai_utilization"),
        ("IPRestricted", "ip_restricted"),
        ("ObjectId1", "object_id1"),
        ("AccessInactiveCO", "access_inactive_co"),
        ("  Two  Words ", "two_words"),
        ("already_snake", "already_snake"),
        ("a-b.c", "a_b_c"),
        ("__x__", "x"),
        ("HTTPServer2Go", "http_server2_go"),
        ("", ""),
    ],
)
def test_snake(name, snake):
    assert columns.standardize_column_names([name]) == [snake]


def test_other_styles():
    assert columns.standardize_column_names([" Ab C "], case="lower") == ["ab c"]
    assert columns.standardize_column_names([" ab "], case="upper") == ["AB"]
    assert columns.standardize_column_names([" a "], case="lower", strip_whitespace=False) == [
        " a "
    ]
    with pytest.raises(ValueError):
        columns.standardize_column_names(["a"], case="camel")


@given(st.text(alphabet="aBcD12_ -é.", max_size=12))
def test_snake_is_stable_and_clean(name):
    (once,) = columns.standardize_column_names([name])
    assert columns.standardize_column_names([once]) == [once]
    assert re.fullmatch(r"([a-z0-9]+(_[a-z0-9]+)*)?", once)


def test_collision_is_an_error(spark):
    df = spark.createDataFrame([(1, 2)], "UserId int, user_id int")
    with pytest.raises(ValueError, match="user_id"):
        columns.normalize_column_names(df)


def test_checks(spark):
    df = spark.createDataFrame([(1, "x")], "n int, s string")
    from pyspark.sql import types as T

    assert columns.existing(df, ["z", "s"]) == ["s"]
    assert columns.select_kind(df, None, T.StringType) == ["s"]
    with pytest.raises(ValueError, match="z"):
        columns.require_columns(df, ["z"])
    with pytest.raises(TypeError, match="n"):
        columns.require_columns(df, ["n"], T.StringType)


def test_column_report(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "`a.b` int, s string")
    wanted = {"a.b": "int", "s": "boolean", "none": "string"}
    assert [tuple(r) for r in columns.column_report(df, wanted).collect()] == [
        ("a.b", "int", "int", "ok", 2),
        ("s", "boolean", "string", "other_type", 1),
        ("none", "string", None, "absent", None),
    ]
