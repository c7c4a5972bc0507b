from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from coursegrain.operators import hierarchy


def chains(spark, edges):
    df = spark.createDataFrame(edges, "id int, up int")
    return {r[0]: tuple(r)[1:] for r in hierarchy.resolve_chains(df, "id", "up").collect()}


def test_kinds_of_chain(spark):
    found = chains(
        spark,
        [(1, None), (2, 1), (3, 2), (4, 99), (5, 4), (6, 7), (7, 6), (8, 6), (9, 9), (10, None)],
    )
    assert found == {
        1: (1, 0, "rooted"),
        2: (1, 1, "rooted"),
        3: (1, 2, "rooted"),
        4: (99, 1, "orphan"),
        5: (99, 2, "orphan"),
        6: (None, None, "cycle"),
        7: (None, None, "cycle"),
        8: (None, None, "cycle"),
        9: (None, None, "cycle"),
        10: (10, 0, "rooted"),
    }


@pytest.mark.parametrize("depth", [1, 7, 8, 9, 100])
def test_deep_chain(spark, depth):
    found = chains(spark, [(0, None)] + [(i, i - 1) for i in range(1, depth + 1)])
    assert found == {i: (0, i, "rooted") for i in range(depth + 1)}


def test_hot_parent(spark):
    found = chains(spark, [(0, None), (1, 0)] + [(i, 1) for i in range(2, 600)])
    assert all(found[i] == (0, 2, "rooted") for i in range(2, 600))


def test_parent_columns(spark, rows):
    df = spark.createDataFrame([(1, None, "a"), (2, 1, "b"), (3, 9, "c")], "id int, up int, t string")
    shown = hierarchy.with_parent(df, "id", "up", {"t": "parent_t"})
    assert rows(shown.select("id", "parent_t")) == [(1, None), (2, "a"), (3, None)]


def test_reach(spark, rows):
    df = spark.createDataFrame(
        [(1, 2), (2, 3), (1, 3), (3, 4), (4, 1), (5, None), (1, 2)], "a int, b int"
    )
    found = rows(hierarchy.prerequisite_reach(df, "a", "b"))
    assert (1, 3, 1) in found and (1, 4, 2) in found and (4, 3, 2) in found
    assert (1, 1, 3) in found and len(found) == len(set(f[:2] for f in found)) == 16


def test_reach_of_a_long_chain(spark, rows):
    df = spark.createDataFrame([(i, i + 1) for i in range(12)], "a int, b int")
    found = rows(hierarchy.prerequisite_reach(df, "a", "b"))
    assert len(found) == 12 * 13 // 2 and (0, 12, 12) in found


def reach_by_brute_force(edges):
    onward = {}
    for a, b in edges:
        onward.setdefault(a, set()).add(b)
    out = set()
    for start in onward:
        seen, front, steps = {}, {start}, 0
        while front:
            steps += 1
            front = {b for a in front for b in onward.get(a, ())} - set(seen)
            seen |= dict.fromkeys(front, steps)
        out |= {(start, b, n) for b, n in seen.items()}
    return out


@pytest.mark.parametrize("seed", range(3))
def test_reach_at_random(spark, seed):
    import random

    rng = random.Random(seed)
    edges = {(rng.randrange(40), rng.randrange(40)) for _ in range(30 + 30 * seed)} | {(i, i + 1) for i in range(50, 67)}
    df = spark.createDataFrame(sorted(edges), "a int, b int")
    found = hierarchy.prerequisite_reach(df, "a", "b", hub_rows=3).collect()
    assert len(found) == len(set(found)) and set(map(tuple, found)) == reach_by_brute_force(edges)


def test_rounds_of_reach_grow_with_the_logarithm(spark, monkeypatch):
    rounds = []
    plain = hierarchy.split_join
    monkeypatch.setattr(hierarchy, "split_join", lambda *a, **k: rounds.append(1) or plain(*a, **k))
    n = 2000
    df = spark.range(n).selectExpr("CAST(id AS int) AS a", "CAST(id + 1 AS int) AS b")
    found = hierarchy.prerequisite_reach(df, "a", "b")
    pairs, longest, total = found.selectExpr("count(*)", "max(steps)", "sum(steps)").first()
    assert pairs == n * (n + 1) // 2 and longest == n
    assert total == sum(d * (n + 1 - d) for d in range(1, n + 1))
    assert len(rounds) == 11


def test_reach_through_a_hub(spark):
    edges = [(i, 1000) for i in range(300)] + [(1000, 2000 + i) for i in range(200)]
    df = spark.createDataFrame(edges, "a int, b int")
    found = hierarchy.prerequisite_reach(df, "a", "b", hub_rows=20)
    counts = {r["steps"]: r["count"] for r in found.groupBy("steps").count().collect()}
    assert counts == {1: 500, 2: 60_000}


def test_reach_makes_tasks_by_the_paths(spark, monkeypatch):
    asked = []
    plain = hierarchy.split_join
    monkeypatch.setattr(hierarchy, "split_join", lambda *a, **k: asked.append(k["tasks"]) or plain(*a, **k))
    edges = [(i, 1000 + i % 10) for i in range(300)] + [(1000 + i, 2000 + j) for i in range(10) for j in range(20)]
    df = spark.createDataFrame(edges, "a int, b int")
    found = hierarchy.prerequisite_reach(df, "a", "b", task_rows=100)
    # 500 ends, 500 ways on and 6,000 paths; none is left for a second round.
    assert asked == [70]
    assert found.rdd.getNumPartitions() == 70
    assert set(map(tuple, found.collect())) == reach_by_brute_force(edges)
    assert max(r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()) < 200


def test_checkpoint_folder_comes_from_the_session():
    from types import SimpleNamespace

    from coursegrain.sources.files import scratch_folder

    given = {"spark.checkpoint.dir": "/shared/x"}
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: given.get(k, d)))
    assert scratch_folder(session) == "/shared/x"
    given = {"spark.master": "local[2]", "spark.sql.warehouse.dir": "file:/here/"}
    session.conf.get = lambda k, d=None: given.get(k, d)
    assert scratch_folder(session) == "file:/here/scratch"
    given["spark.master"] = "spark://somewhere:7077"
    with pytest.raises(ValueError):
        scratch_folder(session)
