from __future__ import annotations

import math
import random
from collections import Counter

import pytest

from coursegrain.operators import profiling, quality
from coursegrain.plans import reports


@pytest.fixture
def odd(spark):
    """Column names and values that break careless profilers."""
    return spark.createDataFrame(
        [
            (1, "a", 1.0, None, "n/a"),
            (1, "b", float("nan"), None, "x"),
            (2, "a", -0.0, None, " "),
            (None, None, 0.0, None, "x"),
        ],
        "`count` int, `a.b` string, summary double, empty double, `column` string",
    )


def test_missingness_keeps_column_order(odd):
    found = [tuple(r) for r in profiling.profile_missingness(odd).collect()]
    assert found == [
        ("count", 1, 0.25),
        ("a.b", 1, 0.25),
        ("summary", 0, 0.0),
        ("empty", 4, 1.0),
        ("column", 2, 0.5),
    ]
    assert profiling.profile_missingness(odd, columns=odd.columns[:2]).count() == 2


def test_missing_and_present_add_up(odd):
    miss = {r["column"]: r["n_missing"] for r in profiling.profile_missingness(odd).collect()}
    top = profiling.profile_top_values(odd, k=10).groupBy("column").sum("count").collect()
    for r in top:
        assert miss[r["column"]] + r[1] == 4


def test_cardinality(odd):
    exact = profiling.profile_cardinality(odd, use_approx=False).collect()
    assert [(r["column"], r["n_distinct"]) for r in exact] == [
        ("count", 2), ("a.b", 2), ("summary", 3), ("empty", 0), ("column", 3),
    ]
    approx = profiling.profile_cardinality(odd).collect()
    assert [r["n_distinct"] for r in approx] == [2, 2, 3, 0, 3]


def test_top_values(odd):
    top = [tuple(r) for r in profiling.profile_top_values(odd, k=1).collect()]
    assert ("count", "1", 2, 0.5) in top and ("a.b", "a", 2, 0.5) in top
    assert not any(r[0] == "empty" for r in top)
    with pytest.raises(ValueError):
        profiling.profile_top_values(odd, k=0)


def test_top_values_of_named_columns(odd):
    found = profiling.profile_top_values(odd, k=9, columns=["a.b"]).collect()
    assert {r["column"] for r in found} == {"a.b"}


def test_top_values_prune_before_the_shuffle(tables):
    plan = profiling.profile_top_values(tables.orders, k=5)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in text


def counted(pairs, k):
    """Most frequent values by hand."""
    counts = Counter(pairs)
    return sorted(counts.items(), key=lambda item: (-item[1], item[0]))[:k]


def test_top_values_of_skewed_columns_come_from_the_sketch(spark):
    n = 60_000
    df = spark.range(n, numPartitions=6).selectExpr(
        "if(id % 10 < 7, concat('heavy ', id % 3), concat('rare ', id)) AS s",
        "cast(if(id % 4 = 0, -0.0, if(id % 4 = 1, 0.0, id)) AS double) AS d",
        "id AS key",
        "if(id % 2 = 0, null, 'x') AS half",
    )
    total, proven = profiling.frequent_hashes(df, df.columns, 1)
    assert total == n and set(proven) == {"s", "d", "half"}
    assert all(len(hashes) <= 3 for hashes in proven.values())
    found = [tuple(r) for r in profiling.profile_top_values(df, k=3).collect()]
    texts = [f"heavy {i % 3}" if i % 10 < 7 else f"rare {i}" for i in range(n)]
    assert [r[1:3] for r in found if r[0] == "s"] == counted(texts, 3)
    assert [r[1:3] for r in found if r[0] == "d"][0] == ("0.0", n // 2)
    assert [r[1:3] for r in found if r[0] == "key"] == [("0", 1), ("1", 1), ("10", 1)]
    assert [r[1:] for r in found if r[0] == "half"] == [("x", n // 2, 0.5)]


@pytest.mark.parametrize("seed", range(6))
def test_top_values_are_exact_whatever_the_sketch_holds(spark, seed):
    """Few tracked values, so that counts are off and ties meet the bound."""
    draw = random.Random(seed)
    heavy = [draw.randint(20, 400) for _ in range(12)]
    values = [f"v{i:02d}" for i, n in enumerate(heavy) for _ in range(n)]
    values += [f"w{draw.randint(0, 300)}" for _ in range(1500)]
    draw.shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], "v string").repartition(5)
    for k in (1, 4, 12):
        found = profiling.profile_top_values(df, k=k, tracked=32).collect()
        assert [(r["value"], r["count"]) for r in found] == counted(values, k)


def test_numeric(odd):
    found = {r["column"]: r for r in profiling.profile_numeric_distribution(odd).collect()}
    assert list(found) == ["count", "summary", "empty"]
    assert found["count"]["count"] == 3 and found["count"]["mean"] == pytest.approx(4 / 3)
    assert found["summary"]["mean"] is None and found["summary"]["max"] is None
    assert found["empty"]["count"] == 0 and found["empty"]["min"] is None


def test_empty_input_gives_empty_profiles(odd):
    none = odd.limit(0)
    for profile in (
        profiling.profile_missingness(none),
        profiling.profile_cardinality(none),
        profiling.profile_cardinality(none, use_approx=False),
        profiling.profile_numeric_distribution(none),
        profiling.profile_top_values(none),
        quality.numeric_outliers(none),
        quality.parse_success(none),
    ):
        assert profile.count() == 0


def test_fused_profile_equals_its_parts(odd):
    fused = profiling.profile_columns(odd)
    parts = {
        ("n_missing", "pct_missing"): profiling.profile_missingness(odd),
        ("n_distinct", "pct_distinct"): profiling.profile_cardinality(odd),
    }
    for names, part in parts.items():
        assert fused.select("column", *names).collect() == part.collect()
    numeric = fused.where("`column` in ('count', 'summary', 'empty')")
    figures = ["column", "count", "mean", "stddev", "min", "max"]
    assert (
        numeric.select(*[f"`{f}`" for f in figures]).collect()
        == profiling.profile_numeric_distribution(odd).collect()
    )


def test_duplicates(spark, one):
    df = spark.createDataFrame([(1, None), (1, None), (1, 2), (2, 2)], "a int, b int")
    stats = one(quality.duplicate_stats(df, ["a", "b"]))
    assert stats == {
        "total_rows": 4,
        "distinct_keys": 3,
        "duplicate_rows": 1,
        "duplicate_row_pct": 0.25,
        "keys_with_duplicates": 1,
    }
    empty = one(quality.duplicate_stats(df.limit(0), ["a"]))
    assert empty["total_rows"] == 0 and empty["duplicate_row_pct"] is None
    lines = [tuple(r) for r in quality.metric_rows(quality.duplicate_stats(df, ["a"])).collect()]
    assert lines[0] == ("total_rows", "4")
    with pytest.raises(ValueError):
        quality.duplicate_stats(df, ["zz"])


def test_outliers(spark):
    data = [(float(i % 3), 5.0, "x") for i in range(100)] + [(1000.0, 5.0, "x"), (None, 5.0, "x")]
    df = spark.createDataFrame(data, "v double, flat double, s string")
    (row,) = quality.numeric_outliers(df).collect()
    assert tuple(row) == ("v", 1, 1 / 102, "|value-mean|>3.0*std")
    with pytest.raises(TypeError):
        quality.numeric_outliers(df, numeric_columns=["s"])


def test_allow_list_counts_nulls_as_removed(spark, one):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "s string")
    kept, summary = quality.filter_allowed_values(df, "s", ["a"])
    assert kept.count() == 1
    assert one(summary) == {
        "total_rows_before_filter": 3,
        "rows_after_filter": 1,
        "rows_removed": 2,
        "pct_rows_removed": 2 / 3,
    }
    assert one(quality.allowed_summary(df.limit(0), "s", ["a"]))["pct_rows_removed"] is None


def test_orphans(spark, one, rows):
    child = spark.createDataFrame([(1, 9), (2, 9), (3, 7), (4, None)], "id int, up int")
    parent = spark.createDataFrame([(7,), (7,)], "pid int")
    assert rows(quality.orphans(child, "up", parent, "pid").select("id")) == [(1,), (2,)]
    assert one(quality.orphan_summary(child, "up", parent, "pid")) == {
        "n_referencing": 3,
        "n_orphans": 2,
        "pct_orphans": 2 / 3,
    }


def test_structural_report(odd):
    report = reports.structural_report(odd, top_values_k=2)
    assert report.columns == ["section", "column", "metric", "value"]
    lines = {(r[0], r[1], r[2]): r[3] for r in report.collect()}
    assert lines["shape", None, "n_rows"] == "4"
    assert lines["shape", None, "n_columns"] == "5"
    assert lines["names", "a.b", "suggested"] == "a_b"
    assert ("distribution", "a.b", "mean") not in lines


def test_quality_report_leaves_out_what_does_not_apply(spark):
    df = spark.createDataFrame([("a",), ("b",)], "s string")
    sections = {r[0] for r in reports.quality_report(df).collect()}
    assert sections == {"missingness"}
    keyed = {r[0] for r in reports.quality_report(df, key_columns=["s"]).collect()}
    assert keyed == {"missingness", "duplicates"}


def test_nan_is_not_missing(odd):
    assert not any(
        math.isnan(r["pct_missing"]) for r in profiling.profile_missingness(odd).collect()
    )
