"""Top-k, latest-per-key and other order-dependent picks.

Per-group picks filter on ``row_number() <= k``: Spark then keeps only k rows per
group in every map task before it shuffles (WindowGroupLimit), so a group that
holds a third of the table still sends k rows per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_PRE_SPLITS = 256


def _pruned_k(df: DataFrame) -> int:
    """Up to this k Spark prunes before the shuffle; the session may have changed it."""
    return int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))


def top_per_group(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    k: int,
    *,
    rank: str | None = None,
) -> DataFrame:
    """First k rows of each group. ``order`` must be total for a stable result;
    ``rank`` names an optional 1-based rank column."""
    if k <= 0:
        raise ValueError("k must be positive")
    if k > _pruned_k(df):
        # No pruning in the map tasks here, so split each group first: the final
        # window sees at most k rows of every split.
        split = F.pmod(F.spark_partition_id(), F.lit(_PRE_SPLITS))
        within = Window.partitionBy(*group, split).orderBy(*order)
        df = (
            df.withColumn("__rank", F.row_number().over(within))
            .where(F.col("__rank") <= k)
            .drop("__rank")
        )
    name = rank or "__rank"
    ranked = df.withColumn(
        name, F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    ).where(F.col(name) <= k)
    return ranked if rank else ranked.drop(name)


def first_rows(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """First k rows of the whole frame: a per-task heap, then one merge."""
    return df.orderBy(*order).limit(k)


def last_buckets(df: DataFrame, bucket: str, k: int) -> DataFrame:
    """The last k buckets present in a bucketed series, in rising order."""
    return df.orderBy(F.desc(bucket)).limit(k).orderBy(bucket)


def latest_per_key(
    df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]
) -> DataFrame:
    """One row per key: the first in the given order."""
    return top_per_group(df, keys, newest_first, 1)


# Keeping one row per duplicated key is the same pick.
deduplicate = latest_per_key
