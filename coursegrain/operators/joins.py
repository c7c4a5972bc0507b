"""Joins with the skew cases handled: NULL keys, fan-out, text containment."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.measures import row_count
from ..functions.names import col
from .membership import bitmap

_SPREAD = 1024


def left_join(
    left: DataFrame, right: DataFrame, keys: Mapping[str, str] | str
) -> DataFrame:
    """Left equi-join, ``keys`` mapping left to right columns. Right key columns
    of another name are kept, those of the same name are not repeated.

    Optional references are often NULL for a large share of the rows, and a
    plain shuffle sends all of those to one task. They match nothing, so here a
    second key part spreads them by row hash. It reads every column of ``left``:
    select what is needed before the join.
    """
    pairs = {keys: keys} if isinstance(keys, str) else dict(keys)
    no_key = reduce(or_, [col(name).isNull() for name in pairs])
    row_hash = F.pmod(F.xxhash64(*map(col, left.columns)), F.lit(_SPREAD)) + 1
    salted = left.withColumn("__spread", F.when(no_key, row_hash).otherwise(F.lit(0)))
    # Always 0; written so that it stays a join key instead of a constant.
    zero = F.pmod(F.xxhash64(*map(col, pairs.values())), F.lit(1))
    other = (
        right.dropna(subset=list(pairs.values()))
        .withColumn("__zero", zero)
        .withColumns({f"__k{i}": col(r) for i, r in enumerate(pairs.values())})
        .drop(*[r for l, r in pairs.items() if l == r])
    )
    match = reduce(
        and_,
        [col(l) == F.col(f"__k{i}") for i, l in enumerate(pairs)],
        F.col("__spread") == F.col("__zero"),
    )
    helpers = ["__spread", "__zero", *[f"__k{i}" for i in range(len(pairs))]]
    return salted.join(other, match, "left").drop(*helpers)


#: Tables of this many rows at most are sent to every task.
FEW_ROWS = 1_000
_SALTS = 32


def with_small(df: DataFrame, small: DataFrame, key: str) -> DataFrame:
    """Inner join with a stored table of one row per key. If that has few rows, which is
    counted, it goes to all tasks; else both sides are salted, so that a key which most
    rows have is met in many tasks."""
    if small.count() <= FEW_ROWS:
        return df.join(F.broadcast(small), key)
    salt = F.pmod(F.xxhash64(*map(col, df.columns)), F.lit(_SALTS)).cast("int")
    salts = F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1)))
    both = df.withColumn("__salt", salt).join(small.withColumn("__salt", salts), [key, "__salt"])
    return both.drop("__salt")


#: Rows of one key that are met in one task at most, or so.
HOT_ROWS = 1_000_000
_HOT_KEYS = 10_000


def hot_keys(df: DataFrame, key: str, rows: int | None = None) -> dict:
    """The keys that more than ``rows`` rows have, with the number of parts to cut each in;
    the ``_HOT_KEYS`` most frequent at most. Counted in the map tasks."""
    rows = rows or HOT_ROWS
    found = (
        df.where(col(key).isNotNull())
        .groupBy(col(key).alias("key"))
        .agg(row_count().alias("n"))
        .where(F.col("n") > rows)
        .orderBy(F.desc("n"))
        .limit(_HOT_KEYS)
    )
    return {r["key"]: -(-r["n"] // rows) for r in found.collect()}


def tasks_for(df: DataFrame, rows: int, most: int | None = None) -> int | None:
    """How many tasks a shuffle of so many rows takes where none is given more than ``most``
    on average; None where one could have them all. Spark merges small partitions by their
    compressed bytes, which says little of what repetitive rows take in memory."""
    wanted = -(-rows // (most or HOT_ROWS))
    return max(wanted, df.sparkSession.sparkContext.defaultParallelism) if wanted > 1 else None


def split_join(
    df: DataFrame, other: DataFrame, key: str, *, how: str = "inner", rows: int | None = None, tasks: int | None = None
) -> DataFrame:
    """Inner or left join on one key whose hot values are spread. Keys that many rows of
    ``df`` have are counted when this is called; their rows are dealt to parts by a hash,
    and what ``other`` has for such a key is repeated for each part. Everything else moves
    as in a plain join. Skew handling at run time would not do where an aggregate of the
    same key follows, and does not know of rows that are few but wide. ``tasks`` is the
    number of tasks that join, left to Spark unless given.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"cannot split a join of kind {how!r}")
    hot = hot_keys(df, key, rows)

    def dealt(side: DataFrame, *keys: str) -> DataFrame:
        return side.repartition(tasks, *map(col, keys)) if tasks else side

    if not hot:
        return dealt(df, key).join(dealt(other, key), key, how)
    pairs = [F.lit(x) for item in hot.items() for x in item]
    parts = F.coalesce(F.try_element_at(F.create_map(*pairs), col(key)), F.lit(1))
    part = F.pmod(F.xxhash64(*map(col, df.columns)), parts).cast("int")
    each = F.explode(F.sequence(F.lit(0), parts.cast("int") - 1))
    left = df.withColumn("__part", F.when(parts > 1, part).otherwise(0))
    right = other.withColumn("__part", each)
    keys = [key, "__part"]
    return dealt(left, *keys).join(dealt(right, *keys), keys, how).drop("__part")


def left_join_default(
    left: DataFrame,
    dimension: DataFrame,
    key: str,
    attribute: str,
    default: str,
) -> DataFrame:
    """Add ``attribute`` of a dimension, or ``default`` where there is none. Of
    several dimension rows per key the smallest attribute is used, so the row
    count does not change."""
    single = dimension.groupBy(col(key)).agg(F.min(col(attribute)).alias(attribute))
    joined = left_join(left, single, key)
    filled = F.coalesce(col(attribute), F.lit(default)).alias(attribute)
    return joined.select(*map(col, left.columns), filled)


def count_per_key(
    hub: DataFrame, fact: DataFrame, keys: Mapping[str, str], name: str, counted: str
) -> DataFrame:
    """Hub rows with the number of non-NULL ``counted`` values of their fact
    rows, 0 when there are none. Facts are counted before they are joined, so a
    key with many facts crosses the network as one row per task."""
    counts = fact.groupBy(*[col(r).alias(f"__{r}") for r in keys.values()]).agg(
        F.count(col(counted)).alias(name)
    )
    joined = left_join(hub, counts, {l: f"__{r}" for l, r in keys.items()})
    return joined.select(
        *map(col, hub.columns), F.coalesce(col(name), F.lit(0)).alias(name)
    )


def key_linkage(
    left: DataFrame, right: DataFrame, key: str, linked: Column
) -> DataFrame:
    """``key, has_left, has_right, has_link`` for every key in either frame:
    ``has_link`` says whether any left row of the key is linked.

    Presence on both sides is one union and one group-by; set operations and the
    group-wise ``any`` all read from it.
    """
    yes, no = F.lit(True), F.lit(False)
    sides = (
        left.select(col(key), yes.alias("__l"), no.alias("__r"), linked.alias("__k"))
        .unionByName(
            right.select(col(key), no.alias("__l"), yes.alias("__r"), no.alias("__k"))
        )
        .where(col(key).isNotNull())
    )
    return sides.groupBy(col(key)).agg(
        F.bool_or("__l").alias("has_left"),
        F.bool_or("__r").alias("has_right"),
        F.bool_or("__k").alias("has_link"),
    )


def linkage_summary(linkage: DataFrame) -> DataFrame:
    """One row: keys on either side, on both, linked, and unlinked with share."""
    both = F.col("has_left") & F.col("has_right")
    counts = linkage.agg(
        F.count_if("has_left").alias("n_left"),
        F.count_if("has_right").alias("n_right"),
        F.count_if(both).alias("n_both"),
        F.count_if(both & F.col("has_link")).alias("n_linked"),
    )
    unlinked = F.col("n_both") - F.col("n_linked")
    return counts.select(
        "*",
        unlinked.alias("n_unlinked"),
        (F.try_divide(unlinked, F.col("n_both")) * 100).alias("pct_unlinked"),
    )


def _distinct_keys(df: DataFrame, key: str) -> DataFrame:
    """Combined in the map tasks, so that a hot key crosses the network once a task."""
    return df.select(col(key)).where(col(key).isNotNull()).distinct()


def keys_in_both(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct non-NULL keys of the left frame that the right frame has."""
    return _distinct_keys(left, key).join(_distinct_keys(right, key), key, "left_semi")


def keys_only_left(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct non-NULL keys of the left frame that the right frame lacks."""
    return _distinct_keys(left, key).join(_distinct_keys(right, key), key, "left_anti")


def lookup(
    df: DataFrame, key: str, entries: Mapping, name: str, default: str | None = None
) -> DataFrame:
    """Add ``name`` from a fixed dictionary. The dictionary is a constant map in
    the projection: nothing is joined or shuffled."""
    pairs = [F.lit(x) for item in entries.items() for x in item]
    found = F.try_element_at(F.create_map(*pairs), col(key))
    value = F.coalesce(found, F.lit(default)) if default is not None else found
    return df.withColumn(name, value)


# ---------------------------------------------------------------- containment

_TEXT_GRAM = 8
_WORD_RUN = 3
_BY_WORDS = -1


def _words(text: Column) -> Column:
    return F.split(text, r"[^\p{L}\p{N}]+")


def _runs(items: Column, width: Column, kind: Column) -> Column:
    """Hashes of each run of ``width`` neighbouring items, apart by ``kind``."""

    def hashed(held: Column) -> Column:
        starts = F.when(
            F.size(held) >= width, F.sequence(F.lit(1), F.size(held) - width + 1)
        ).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.xxhash64(kind, F.slice(held, i, width)))

    # Wrapped so that the items are built once, not once per run.
    return F.flatten(F.transform(F.array(items), hashed))


def _signatures(text: Column, words: Column, cut: Column) -> Column:
    """The distinct runs of words, or of ``cut`` characters."""
    by_words = cut == _BY_WORDS
    items = F.when(by_words, words).otherwise(F.split(text, ""))
    width = F.when(by_words, _WORD_RUN).otherwise(cut)
    return F.array_distinct(_runs(items, width, cut))


def contains_join(
    texts: DataFrame,
    text_id: str,
    text: str,
    needles: DataFrame,
    needle_id: str,
    needle: str,
) -> DataFrame:
    """``text_id, needle_id`` for every pair where the text contains the needle
    exactly, ids being unique on their side. The needles are read when this is called.

    No pair is compared that shares no signature. A needle of five words or more
    is sought by its inner runs of three words, since an inner word stands whole
    in any text that holds the needle. A shorter needle is sought by substrings
    of its own length (at most eight), and texts are cut into substrings only
    for the lengths that occur. Every needle uses the one signature that is
    rarest in the texts; what remains is verified on the full strings.
    """
    t = texts.select(col(text_id).alias("tid"), col(text).alias("t")).where(
        "tid is not null and t is not null"
    )
    n = needles.select(col(needle_id).alias("nid"), col(needle).alias("s")).where(
        "nid is not null and s is not null"
    )

    # First and last words may be cut, so they are not part of a signature.
    words = _words(F.col("s"))
    n = n.withColumn("inner", F.slice(words, 2, F.greatest(F.size(words) - 2, F.lit(0))))
    by_words = F.size("inner") >= _WORD_RUN
    size = F.least(F.length("s"), F.lit(_TEXT_GRAM))
    n = n.withColumn("cut", F.when(by_words, _BY_WORDS).otherwise(size))
    wanted = n.select("nid", F.explode(_signatures(F.col("s"), F.col("inner"), F.col("cut"))).alias("sig"))
    # Shuffled by text, evenly, so that both uses below read one shuffle of one text scan.
    hits = text_hits(t, n, wanted).repartition("tid")
    frequency = hits.groupBy("sig").agg(row_count().alias("df"))
    rarest = (
        wanted.join(frequency, "sig")
        .groupBy("nid")
        .agg(F.min(F.struct("df", "sig")).getField("sig").alias("sig"))
    )
    # The needle travels with its signature, and a signature that very many texts have
    # is met in several tasks.
    salts = F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1)))
    sought = rarest.join(n.select("nid", "s"), "nid").withColumn("salt", salts)
    salt = F.pmod(F.xxhash64("tid"), F.lit(_SALTS)).cast("int")
    candidates = hits.withColumn("salt", salt).join(sought, ["sig", "salt"]).select("tid", "nid", "s")
    return (
        candidates.join(t, "tid")
        .where(F.contains("t", "s"))
        .select(F.col("tid").alias(text_id), F.col("nid").alias(needle_id))
    )


def text_hits(t: DataFrame, n: DataFrame, wanted: DataFrame) -> DataFrame:
    """``tid, sig``: the signatures of texts ``tid, t`` that a needle may have. The needles'
    signatures are a bitmap, looked up before a text's signatures become rows, so that few
    more rows leave the scan than there are hits."""
    # The cuts in use: ten at most, whatever the number of needles.
    cuts = n.agg(F.collect_set("cut")).scalar()
    own = _signatures(F.col("t"), _words(F.col("t")), F.col("cut"))
    held = bitmap(wanted, "sig")
    return (
        t.select("tid", "t", F.explode(cuts).alias("cut"))
        .select("tid", F.explode(F.filter(own, held.might_hold)).alias("sig"))
    )
