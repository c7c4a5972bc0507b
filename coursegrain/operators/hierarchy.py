"""Parent-child structures: parents of rows, whole chains, reach.

Chains are resolved by pointer doubling: after round r each node knows its
ancestor 2^r levels up, so a tree of depth d takes about log2(d) self-joins
instead of d. Each round's result is checkpointed, so the plan stays one join
deep and a lost executor repeats one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.measures import row_count
from ..functions.names import col
from ..sources.files import scratch_folder
from .joins import left_join, split_join, tasks_for


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint into the session's shared folder."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_folder(spark))
    return df.checkpoint()


def with_parent(
    df: DataFrame, id_column: str, parent_column: str, shown: dict[str, str]
) -> DataFrame:
    """Add columns of the parent row: ``shown`` maps parent column to new name.
    Rows without a parent get NULLs."""
    parents = df.select(
        col(id_column).alias("__parent_id"),
        *[col(c).alias(alias) for c, alias in shown.items()],
    )
    return left_join(df, parents, {parent_column: "__parent_id"}).drop("__parent_id")


def resolve_chains(edges: DataFrame, id_column: str, parent_column: str) -> DataFrame:
    """``id, root, depth, status`` per node. Of several rows with one id the smallest
    parent counts, a missing one last.

    ``depth`` counts steps to the root. ``status`` is ``rooted`` for a chain that
    ends at a node without parent, ``orphan`` when it ends at a parent id that is
    no node, and ``cycle`` when it never ends (root and depth are then NULL).

    Round r ends every chain of depth below 2^r. A longer chain passes through
    all smaller depths, so a round that ends none leaves only cycles.
    """
    # `up` is where the chain goes on (NULL: it ended), `root` its end so far.
    state = cut_lineage(
        edges.select(col(id_column).alias("id"), col(parent_column).alias("up"))
        .where(F.col("id").isNotNull())
        .groupBy("id")
        .agg(F.min("up").alias("up"))
        .select(
            "id",
            "up",
            F.coalesce("up", "id").alias("root"),
            F.col("up").isNotNull().cast("long").alias("depth"),
            F.lit(False).alias("orphan"),
        )
    )
    still_open, before = state.where("up is not null").count(), None
    while still_open and still_open != before:
        state = cut_lineage(_double(state))
        before, still_open = still_open, state.where("up is not null").count()
    ended = F.col("up").isNull()
    return state.select(
        F.col("id").alias(id_column),
        F.when(ended, F.col("root")).alias("root"),
        F.when(ended, F.col("depth")).alias("depth"),
        F.when(~ended, "cycle")
        .when(F.col("orphan"), "orphan")
        .otherwise("rooted")
        .alias("status"),
    )


def _double(state: DataFrame) -> DataFrame:
    """Follow each open pointer by the pointer found where it leads."""
    ahead = state.select(
        F.col("id").alias("at"),
        F.col("up").alias("next_up"),
        F.col("root").alias("next_root"),
        F.col("depth").alias("next_depth"),
        F.col("orphan").alias("next_orphan"),
    )
    joined = left_join(state, ahead, {"up": "at"})
    found = F.col("at").isNotNull()
    return joined.select(
        "id",
        F.col("next_up").alias("up"),
        F.when(found, F.col("next_root")).otherwise(F.col("root")).alias("root"),
        (F.col("depth") + F.when(found, F.col("next_depth")).otherwise(0)).alias("depth"),
        F.when(F.col("up").isNull(), F.col("orphan"))
        .otherwise(~found | F.col("next_orphan"))
        .alias("orphan"),
    )


def prerequisite_reach(
    edges: DataFrame, source: str, target: str, *, hub_rows: int | None = None, task_rows: int | None = None
) -> DataFrame:
    """``source, target, steps``: every target that can be reached and the fewest steps
    to it, for a graph where nodes may have several prerequisites.

    The result is the graph's closure, so it is as large as that. Once all pairs up to s
    steps apart are known, a pair up to 2 s apart passes through a node exactly s steps
    from its start: the pairs of s steps are joined with all known ones. So rounds grow
    with the logarithm of the longest distance, and a pair is made once for each node in
    its middle. Nodes that more than ``hub_rows`` such paths meet in are split. Paths are
    counted by their middle before they are made: none ends the search, and their number
    says how many tasks are needed for ``task_rows`` rows in each.
    """
    links = edges.select(col(source).alias("a"), col(target).alias("b")).dropna().distinct()
    known, reached = cut_lineage(links.withColumn("steps", F.lit(1).cast("long"))), 1
    while True:
        ends = known.where(F.col("steps") == reached).select("a", F.col("b").alias("mid"))
        onward = known.select(F.col("a").alias("mid"), "b", F.col("steps").alias("more"))
        paths, met = _paths(ends, onward)
        if not paths:
            break
        tasks = tasks_for(known, met + paths, task_rows)
        longer = split_join(ends, onward, "mid", rows=hub_rows, tasks=tasks).select(
            "a", "b", (F.col("more") + reached).alias("steps")
        )
        # Shorter distances were known before; a pair's fewest steps stay.
        pairs = known.unionByName(longer)
        pairs = pairs.repartition(tasks, "a", "b") if tasks else pairs
        known = cut_lineage(pairs.groupBy("a", "b").agg(F.min("steps").alias("steps")))
        reached *= 2
    return known.select(F.col("a").alias(source), F.col("b").alias(target), "steps")


def _paths(ends: DataFrame, onward: DataFrame) -> tuple[int, int]:
    """How many rows the two have for each other, and how many they have, by their counts of
    each middle node."""
    counted = (
        ends.select("mid", F.lit(1).cast("long").alias("n"), F.lit(0).cast("long").alias("m"))
        .unionByName(onward.select("mid", F.lit(0).cast("long").alias("n"), F.lit(1).cast("long").alias("m")))
        .groupBy("mid")
        .agg(F.sum("n").alias("n"), F.sum("m").alias("m"))
    )
    row = counted.agg(F.sum(F.col("n") * F.col("m")).alias("paths"), F.sum(F.col("n") + F.col("m")).alias("met")).first()
    return row["paths"] or 0, row["met"] or 0


def depth_distribution(df: DataFrame, depth: str) -> DataFrame:
    """``depth, n`` per level, NULL levels left out."""
    return (
        df.where(col(depth).isNotNull())
        .groupBy(col(depth).alias("depth"))
        .agg(row_count().alias("n"))
    )
