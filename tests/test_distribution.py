"""Percentiles against numpy, and what is derived from them."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from coursegrain.operators import distribution

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


def frame(spark, values):
    return spark.createDataFrame([(float(v),) for v in values], "v double")


def cases():
    rng = np.random.default_rng(7)
    yield "one", [3.0]
    yield "two", [1.0, 2.0]
    yield "constant", [5.0] * 1000
    yield "hot", [1.0] * 700 + list(rng.normal(size=300))
    yield "steps", list(rng.integers(0, 4, 999))
    yield "normal", list(rng.normal(size=3001))
    yield "tail", list(rng.pareto(0.5, 2500))
    for n in (3, 101, 150, 151):
        yield f"n{n}", list(rng.normal(size=n))


@pytest.mark.parametrize(("name", "values"), list(cases()), ids=lambda c: c if isinstance(c, str) else "")
def test_percentiles_equal_numpy(spark, name, values):
    found = tuple(distribution.percentiles(frame(spark, values), "v", PROBS).first())
    assert found == pytest.approx([np.quantile(values, p) for p in PROBS], rel=1e-12)


@pytest.mark.parametrize(("accuracy", "margin"), [(50, 8 / 50), (50, 1e-4), (2, 1e-6)])
def test_a_bad_sketch_still_gives_exact_answers(spark, monkeypatch, accuracy, margin):
    """The narrow ranges are wide, or miss the ranks, which are then found by counting."""
    monkeypatch.setattr(distribution, "ACCURACY", accuracy)
    monkeypatch.setattr(distribution, "_MARGIN", margin)
    values = np.random.default_rng(3).normal(size=20_000)
    values[:7000] = 0.25
    found = tuple(distribution.percentiles(frame(spark, values), "v", PROBS).first())
    assert found == pytest.approx([np.quantile(values, p) for p in PROBS], rel=1e-12)


def reads(spark, df, work):
    """How often ``work`` reads the rows of ``df``, by a counter in a function of a column."""
    seen = spark.sparkContext.accumulator(0)

    def count(v):
        seen.add(1)
        return v

    counted = df.withColumn("v", F.udf(count, "double").asNondeterministic()("v"))
    n, result = df.count(), work(counted)
    return seen.value / n, result


def test_several_measures_in_two_reads(spark, monkeypatch):
    values = np.random.default_rng(4).normal(size=5000)
    df = frame(spark, values).withColumn("w", F.col("v") * 2 + 1).repartition(3).cache()
    wanted = {"v": [0.01, 0.5], "w": [0.99]}
    n, found = reads(spark, df, lambda d: distribution.percentile_values(d, wanted))
    assert n == 2
    assert found["v"] == pytest.approx([np.quantile(values, p) for p in (0.01, 0.5)])
    assert found["w"] == pytest.approx([np.quantile(values * 2 + 1, 0.99)])
    # Where the sketch misses, a third.
    monkeypatch.setattr(distribution, "ACCURACY", 2)
    n, found = reads(spark, df, lambda d: distribution.percentile_values(d, wanted))
    assert n <= 3 and found["v"] == pytest.approx([np.quantile(values, p) for p in (0.01, 0.5)])
    n, _ = reads(spark, df, lambda d: distribution.central_or_outlier(d, ["v"]).groupBy("region").count().collect())
    assert n <= 4


@pytest.mark.parametrize("few", [1000, 0])
def test_a_group_with_most_rows(spark, monkeypatch, few):
    """90 % of the rows in one group, which is split by range."""
    monkeypatch.setattr(distribution, "_FEW", few)
    monkeypatch.setattr(distribution, "_LARGE_GROUP", 1000)
    rng = np.random.default_rng(6)
    data = [("hot" if i % 10 else f"g{i % 70}", float(v)) for i, v in enumerate(rng.normal(size=20_000))]
    df = spark.createDataFrame(data, "g string, v double").repartition(4).cache()
    n, found = reads(spark, df, lambda d: distribution.percentiles(d, "v", [0.25, 0.5], by=["g"]).collect())
    # One to count the groups, one for small groups, three for large ones.
    assert n <= 5
    for r in found:
        own = [v for g, v in data if g == r["g"]]
        assert tuple(r)[1:] == pytest.approx(tuple(np.quantile(own, [0.25, 0.5])))
    assert len(found) == 8
    boxes = {r["g"]: r for r in distribution.box_plot(df, "v", "g").collect()}
    assert sum(r["n"] for r in boxes.values()) == 20_000


def test_groups_and_missing_values(spark):
    rng = np.random.default_rng(5)
    data = [("a", float(v)) for v in rng.normal(size=500)]
    data += [("b", 2.0), ("b", None), ("c", None), (None, 9.0), ("b", float("nan"))]
    df = spark.createDataFrame(data, "g string, v double")
    found = {r[0]: r[1:] for r in distribution.percentiles(df, "v", [0.5, 0.9], by=["g"]).collect()}
    a = [v for g, v in data if g == "a"]
    assert found["a"] == pytest.approx((np.quantile(a, 0.5), np.quantile(a, 0.9)))
    assert found["b"] == (2.0, 2.0)
    assert "c" not in found


@pytest.mark.parametrize("name", ["v", "n", "i", "rank", "zone", "at", "a.b", "group", "brackets"])
def test_group_names_cannot_clash(spark, name):
    df = spark.createDataFrame([("x", 1.0), ("x", 3.0)], ["key", "amount"]).toDF(name, "amount")
    found = distribution.percentiles(df, "amount", [0.5], by=[name])
    assert found.columns == [name, "p0"] and tuple(found.first()) == ("x", 2.0)
    if name not in ("n",):
        assert distribution.box_plot(df, "amount", name).first()["median"] == 2.0


def test_no_values(spark):
    none = frame(spark, []).agg(F.count("v").alias("n"))
    value = distribution.percentile_value(frame(spark, []), "v", 0.5)
    assert tuple(none.select(value).first()) == (None,)


def test_approximate(spark):
    df = frame(spark, range(1001))
    (found,) = distribution.percentiles(df, "v", [0.5], approximate=True).first()
    assert abs(found - 500) <= 1


def test_histogram_counts_every_value_once(spark):
    values = np.random.default_rng(1).normal(size=997)
    bins = distribution.histogram(frame(spark, values), "v", 13).orderBy("bin").collect()
    counts, edges = np.histogram(values, 13)
    assert [r["n"] for r in bins] == list(counts)
    assert [r["low"] for r in bins] == pytest.approx(edges[:-1])


def test_histogram_corner_cases(spark):
    flat = distribution.histogram(frame(spark, [4.0, 4.0]), "v", 2).orderBy("bin").collect()
    assert [(r["low"], r["high"], r["n"]) for r in flat] == [(3.5, 4.0, 0), (4.0, 4.5, 2)]
    assert distribution.histogram(frame(spark, []), "v", 5).count() == 0


def test_box_plot(spark):
    values = [1.0, 2.0, 3.0, 4.0, 100.0]
    df = frame(spark, values).withColumn("g", F.lit("x"))
    (r,) = distribution.box_plot(df, "v", "g").collect()
    assert (r["n"], r["q1"], r["median"], r["q3"]) == (5, 2.0, 3.0, 4.0)
    assert (r["whisker_low"], r["whisker_high"], r["n_outliers"]) == (1.0, 4.0, 1)


def test_partition_keeps_every_row(spark):
    df = spark.createDataFrame(
        [(float(i), float(i % 7) if i % 5 else None) for i in range(200)], "a double, b double"
    )
    found = distribution.central_or_outlier(df, ["a", "b"], 0.9).groupBy("region").count()
    counts = {r["region"]: r["count"] for r in found.collect()}
    assert sum(counts.values()) == 200 and set(counts) == {"central", "outlier"}
