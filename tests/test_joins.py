from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from coursegrain.operators import frequency, joins
from coursegrain.operators.membership import bitmap


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_left_join_equals_the_plain_one(spark, rows):
    left = spark.createDataFrame([(1, 10), (2, None), (3, 30), (4, None), (5, 10)], "id int, k int")
    right = spark.createDataFrame([(10, "a"), (10, "b"), (None, "never")], "k int, v string")
    found = joins.left_join(left, right, "k")
    assert found.columns == ["id", "k", "v"]
    assert rows(found) == rows(left.join(right, "k", "left").select("id", "k", "v"))
    renamed = joins.left_join(left, right.toDF("kk", "v"), {"k": "kk"})
    assert renamed.columns == ["id", "k", "kk", "v"]


def test_left_join_spreads_null_keys(spark, rows):
    left = spark.range(2000).select("id", F.lit(None).cast("long").alias("k"))
    right = spark.range(10).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = joins.left_join(left, right, "k")
        used = joined.select(F.spark_partition_id().alias("p")).distinct().count()
        assert joined.count() == 2000 and used == 8
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_default_join_does_not_fan_out(spark, rows):
    facts = spark.createDataFrame([(1, 7), (2, 8), (3, None)], "id int, u int")
    dims = spark.createDataFrame([(7, "B"), (7, "A")], "u int, s string")
    assert rows(joins.left_join_default(facts, dims, "u", "s", "UNKNOWN")) == [
        (1, 7, "A"), (2, 8, "UNKNOWN"), (3, None, "UNKNOWN"),
    ]


def test_linkage(spark, one):
    quizzes = spark.createDataFrame(
        [(1, 5), (1, None), (2, None), (3, 5), (None, 5)], "u int, g int"
    )
    grades = spark.createDataFrame([(1,), (2,), (2,), (4,)], "u int")
    linkage = joins.key_linkage(quizzes, grades, "u", F.col("g").isNotNull())
    assert one(joins.linkage_summary(linkage)) == {
        "n_left": 3, "n_right": 3, "n_both": 2, "n_linked": 1, "n_unlinked": 1,
        "pct_unlinked": 50.0,
    }
    assert [r[0] for r in joins.keys_in_both(quizzes, grades, "u").orderBy("u").collect()] == [1, 2]
    assert [r[0] for r in joins.keys_only_left(quizzes, grades, "u").collect()] == [3]


@pytest.mark.parametrize("name", ["k", "l", "r", "x.y"])
def test_linkage_key_names_cannot_clash(spark, one, name):
    df = spark.createDataFrame([(1,), (2,)], "u int").toDF(name)
    assert one(joins.linkage_summary(joins.key_linkage(df, df, name, F.lit(True))))["n_linked"] == 2


def test_lookup(spark, rows):
    df = spark.createDataFrame([(2000,), (5,), (None,)], "tool int")
    assert rows(joins.lookup(df, "tool", {2000: "Assignments"}, "name")) == [
        (2000, "Assignments"), (5, None), (None, None),
    ]


def brute(texts, needles):
    return sorted(
        (i, j)
        for i, t in texts
        for j, s in needles
        if t is not None and s is not None and s in t
    )


def contains(spark, texts, needles):
    t = spark.createDataFrame(texts, "i int, t string")
    n = spark.createDataFrame(needles, "j int, s string")
    found = joins.contains_join(t, "i", "t", n, "j", "s")
    return sorted((r["i"], r["j"]) for r in found.collect())


def test_contains_by_hand(spark):
    texts = [
        (1, "the quick brown fox jumps over the lazy dog"),
        (2, "xthe quick brown fox jumps overx"),
        (3, ""),
        (4, None),
        (5, "ab"),
        (6, "naïve Größe — über alles, 日本語テキスト、です"),
    ]
    needles = [
        (1, "quick brown fox jumps over"),
        (2, "ick brown fox jumps ov"),
        (3, "ab"),
        (4, ""),
        (5, None),
        (6, "fox jumps"),
        (7, "日本"),
        (8, "e — ü"),
        (9, "quick brown fox jumped over"),
        (10, "the quick brown fox"),
        (11, "%"),
    ]
    assert contains(spark, texts, needles) == brute(texts, needles)


@pytest.mark.parametrize("seed", range(3))
def test_contains_at_random(spark, seed):
    rng = random.Random(seed)

    def words(n, alphabet):
        return "".join(rng.choice(alphabet) for _ in range(n))

    texts = [(i, words(rng.randint(0, 120), "aab  .é")) for i in range(150)]
    needles = []
    for j in range(80):
        source = rng.choice(texts)[1]
        if rng.random() < 0.7 and source:
            a = rng.randrange(len(source))
            needles.append((j, source[a : a + rng.randint(1, 60)]))
        else:
            needles.append((j, words(rng.randint(1, 30), "aab  .é")))
    assert contains(spark, texts, needles) == brute(texts, needles)


def test_contains_with_a_hot_text(spark):
    # A third of the texts are copies that hold the same passage.
    passage = "alpha beta gamma delta epsilon zeta"
    texts = [(i, f"copy {passage} end" if i % 3 == 0 else f"other text {i}") for i in range(300)]
    needles = [(1, passage), (2, "other text 2 ")]
    assert contains(spark, texts, needles) == brute(texts, needles)


def test_contains_with_a_shared_template(spark):
    # One template in most texts and in many needles; what is rare in each still decides.
    template = "we hereby grant the right to use this text in any way"
    texts = [(i, f"{template} as of number {i} in the list") for i in range(400)] + [(900, template)]
    needles = [(j, f"any way as of number {j} in") for j in range(0, 60, 3)]
    needles += [(1000 + j, template) for j in range(5)] + [(2000, "right to use this text in any way at all")]
    assert contains(spark, texts, needles) == brute(texts, needles)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_split_join_equals_the_plain_one_and_spreads_hot_keys(spark, rows, how):
    """60 % of the rows have one key; no task of the join meets more than a part of them."""
    data = [(i, 1 if i % 5 < 3 else i % 97) for i in range(5000)] + [(-1, None)]
    left = spark.createDataFrame(data, "id int, k int")
    right = spark.createDataFrame([(k, f"v{k}") for k in range(60)] + [(1, "again"), (None, "never")], "k int, v string")
    assert joins.hot_keys(left, "k", 100)[1] >= 30
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = joins.split_join(left, right, "k", how=how, rows=100)
        assert found.columns == ["k", "id", "v"]
        assert rows(found) == rows(left.join(right, "k", how))
        per_task = found.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        plain = left.join(right, "k", how).groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert per_task < plain / 2
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    with pytest.raises(ValueError):
        joins.split_join(left, right, "k", how="full")


def test_few_rows_leave_the_texts_but_hits(spark, tables):
    t = tables.documents.select(F.col("doc_id").alias("tid"), F.col("text").alias("t"))
    n = spark.createDataFrame([(1, "and the")], "nid int, s string").withColumn("cut", F.lit(7))
    wanted = n.select("nid", F.explode(F.array(F.xxhash64("cut", F.split("s", "")))).alias("sig"))
    runs = joins._signatures(F.col("t"), joins._words(F.col("t")), F.lit(7))
    all_runs = t.select("tid", F.explode(runs).alias("sig"))
    exact = all_runs.join(wanted, "sig", "left_semi").count()
    left = joins.text_hits(t, n, wanted).count()
    assert exact <= left <= exact + all_runs.count() / 10_000


def test_bitmaps_never_lose_a_value(spark):
    df = spark.range(3000).select((F.col("id") * 7).alias("x"))
    some = df.where("x % 2 = 0")
    for bits in (1 << 12, 1 << 20):
        found = df.where(bitmap(some, "x", bits).might_hold(F.col("x")))
        assert found.where("x % 2 = 0").count() == 1500
        assert bits < 1 << 20 or found.count() < 1510
    assert df.where(bitmap(df.limit(0), "x").might_hold(F.col("x"))).count() == 0


def test_contains_makes_no_cross_join(tables):
    df = joins.contains_join(tables.documents, "doc_id", "text", tables.benchmark, "item_id", "text")
    text = plan_of(df)
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_rare_values_keep_null_rows(spark, rows):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "s string")
    assert rows(frequency.drop_rare(df, "s")) == [(None,), ("a",), ("a",)]


def test_top_with_other(spark, rows):
    df = spark.createDataFrame([(s,) for s in "aaabbcd"] + [(None,)], "s string")
    assert rows(frequency.top_with_other(df, "s", 2)) == [
        ("Other", 2, 2), ("a", 3, 1), ("b", 2, 1),
    ]


def test_weighted_mean_of_zero_weights(spark):
    df = spark.createDataFrame([(1.0, 0.0), (2.0, None)], "x double, w double")
    assert frequency.weighted_mean(df, "x", "w").first()[0] is None
