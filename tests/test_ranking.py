from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from coursegrain.operators import ranking, series


def test_large_k_splits_groups_first(spark):
    df = spark.range(6000).select((F.col("id") % 2).alias("g"), "id")
    top = ranking.top_per_group(df, ["g"], [F.desc("id")], 1500)
    found = {r[0]: (r[1], r[2]) for r in top.groupBy("g").agg(F.count("*"), F.min("id")).collect()}
    assert found == {0: (1500, 3000), 1: (1500, 3001)}


def test_rank_column(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("b", 2)], "g string, v int")
    top = ranking.top_per_group(df, ["g"], [F.desc("v")], 1, rank="place")
    assert rows(top) == [("a", 3, 1), ("b", 2, 1)]


def test_latest_prunes_before_the_shuffle(tables):
    df = ranking.latest_per_key(tables.events, ["user_id"], [F.desc("ts"), F.desc("event_id")])
    assert "WindowGroupLimit" in df._jdf.queryExecution().executedPlan().toString()


def test_last_buckets_counts_present_buckets(spark):
    stamps = [datetime(2020, m, 2) for m in (1, 1, 5, 9)] + [None]
    df = spark.createDataFrame([(s,) for s in stamps], "d timestamp")
    tail = ranking.last_buckets(series.month_counts(df, "d"), "month_start", 2).collect()
    assert [(r["month"], r["n"]) for r in tail] == [(5, 1), (9, 1)]


def test_event_split_counts_undated_rows(spark, one):
    df = spark.createDataFrame([(1, "2020-01-01"), (2, None), (None, "x")], "n int, d string")
    when = F.col("d").try_cast("timestamp")
    assert one(series.first_and_later(df, "n", when)) == {
        "n_events": 3, "n_initial": 1, "n_subsequent": 2, "n_dated": 1,
    }
