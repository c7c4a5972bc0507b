"""Hard negatives by exact inner-product search with coordinate pruning.

Vectors become whole numbers, ``floor(scale * x)``. Rows of one label are cut into buckets
of vectors of similar length. A bucket keeps, for each coordinate of its normalised
vectors, the sorted list of values. An anchor that needs a score of at least t from a
bucket whose longest vector has length m needs a cosine of at least ``t / (|anchor| m)``;
at the anchor's largest coordinates, its focus, that leaves a range of feasible values.
The rows in all of the focus ranges are candidates, and their scores are computed exactly.
The threshold is the worst of the best scores that the bucket has shown so far, so that no
row of the answer is lost.

1. Positives: anchors meet the buckets of their own label; the first ``positives`` stay.
2. Negatives: anchors meet the buckets of other labels. Scores between ``low`` and ``high``
   per cent of a positive's count; for each positive the first ``negatives`` stay.

Buckets hold about ``BUCKET`` rows: those of one label, size and length to 10 %, split by
a hash where there are more, so that a label that holds most rows is many buckets. Anchors
are a stated query set; they travel in blocks of about ``BLOCK``, and a task reads a bucket
against some ``TOGETHER`` blocks and returns the best rows of the bucket only. The best of
all are picked with a limit in the map tasks.

Edge cases: rows without a label or vector, or with components that are NULL or not finite,
take no part; nor do vectors whose squared length reaches 2**62, as scores would pass 64
bits, and the empty vector, which has no score. Vectors of different sizes do not meet. Rows
that share an id are rows of their own. A row without an id is no anchor, and comes after
those with one. A negative positive score leaves no range, so no negatives. An empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coursegrain.operators.ranking import top_per_group

from .common import cut

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90
BUCKET, BLOCK, TOGETHER = 4096, 512, 16
LENGTH_STEP = 1.1
FOCUS = 4
_LAST = (1 << 63) - 1

class Bucket:
    """Vectors of a bucket with the sorted lists of their normalised coordinates."""

    def __init__(self, vectors: np.ndarray) -> None:
        self.vectors = vectors
        wide = vectors.astype(np.float64)
        norms = np.sqrt(np.einsum("ij,ij->i", wide, wide))
        self.longest = float(norms.max(initial=0))
        # A vector of length 0 is at 0 everywhere; its score is 0.
        self.unit = wide / np.where(norms > 0, norms, 1)[:, None]
        self._lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        # Products below 2**53 are exact in floating point, and faster.
        largest = float(np.abs(wide).max(initial=0))
        self.wide = wide if largest < 2**20 else None

    def sorted_list(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        if f not in self._lists:
            order = np.argsort(self.unit[:, f], kind="stable")
            self._lists[f] = self.unit[order, f], order
        return self._lists[f]

    def scores(self, anchor: np.ndarray, rows: np.ndarray | slice) -> np.ndarray:
        if self.wide is not None and len(anchor) <= 1 << 12 and np.abs(anchor).max(initial=0) < 2**20:
            return (self.wide[rows] @ anchor.astype(np.float64)).astype(np.int64)
        return self.vectors[rows] @ anchor

    def candidates(self, anchor: np.ndarray, least: int | None, focus: int) -> np.ndarray:
        """Rows that can score ``least`` or more, in rising order; a few that cannot stay."""
        everything = np.arange(len(self.vectors))
        length = float(np.sqrt(np.dot(anchor.astype(np.float64), anchor.astype(np.float64))))
        if least is None or least <= 0 or not length:
            return everything
        cosine = least / (length * self.longest) if self.longest else np.inf
        cosine -= 1e-9
        if cosine > 1:
            return everything[:0]
        unit = anchor / length
        slack = np.arccos(min(cosine, 1.0))
        ranges = []
        for f in np.argsort(-np.abs(unit), kind="stable")[:focus]:
            angle = np.arccos(np.clip(unit[f], -1, 1))
            low, high = np.cos(min(angle + slack, np.pi)) - 1e-9, np.cos(max(angle - slack, 0.0)) + 1e-9
            values, order = self.sorted_list(int(f))
            at, end = np.searchsorted(values, low, "left"), np.searchsorted(values, high, "right")
            ranges.append((end - at, at, end, f, low, high, order))
        ranges.sort(key=lambda r: r[0])
        _, at, end, _, _, _, order = ranges[0]
        if end - at > len(self.vectors) // 2:
            return everything
        found = np.sort(order[at:end])
        for _, _, _, f, low, high, _ in ranges[1:]:
            x = self.unit[found, f]
            found = found[(x >= low) & (x <= high)]
        return found


def _first(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k: higher scores first, then smaller ids."""
    if len(scores) > 4 * k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        few = np.flatnonzero(scores >= edge)
        return few[np.lexsort((ids[few], -scores[few]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def _kth(scores: np.ndarray, k: int) -> int | None:
    return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else None


_SEED = 256


def best_in_bucket(bucket: Bucket, ids: np.ndarray, rows: np.ndarray, anchor: np.ndarray, own: int, k: int, focus: int) -> tuple[np.ndarray, np.ndarray]:
    """The first k rows of a bucket other than ``own``, and their scores."""
    # The best of a part of the bucket are a threshold for the rest.
    seed = np.flatnonzero(rows[:_SEED] != own)
    threshold = _kth(bucket.scores(anchor, seed), k)
    at = bucket.candidates(anchor, threshold, focus)
    at = at[rows[at] != own]
    scores = bucket.scores(anchor, at)
    first = _first(scores, ids[at], k)
    return at[first], scores[first]


def between_in_bucket(
    bucket: Bucket, ids: np.ndarray, anchor: np.ndarray, bounds: list[tuple[int, int]], k: int, focus: int
) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each range of scores, the first k rows of a bucket inside it, and their scores."""
    seed = bucket.scores(anchor, slice(0, _SEED))
    least = []
    for low, high in bounds:
        inside = seed[(seed >= low) & (seed <= high)]
        least.append(max(low, t) if (t := _kth(inside, k)) is not None else low)
    at = bucket.candidates(anchor, min(least), focus)
    scores = bucket.scores(anchor, at)
    out = []
    for (_, high), low in zip(bounds, least, strict=True):
        inside = np.flatnonzero((scores >= low) & (scores <= high))
        first = inside[_first(scores[inside], ids[at[inside]], k)]
        out.append((at[first], scores[first]))
    return out


class _Members:
    """The rows of a bucket or block."""

    def __init__(self, label: object, dim: int, members: pa.Array) -> None:
        self.label, self.dim = label, dim
        self.rows = members.field("row").to_numpy()
        self.ids = members.field("id").to_numpy()
        self.vectors = members.field("vector").flatten().to_numpy().reshape(-1, dim)
        asked = members.type.get_field_index("bounds") >= 0
        self.bounds = members.field("bounds").to_pylist() if asked else []


def _members(table: pa.Table) -> list[_Members]:
    if not table.num_rows:  # and no columns, where only the other side has rows
        return []
    lists = [m for chunk in table["members"].chunks for m in chunk]
    labels, dims = table["label"].to_pylist(), table["dim"].to_pylist()
    return [_Members(*x) for x in zip(labels, dims, (m.values for m in lists), strict=True)]


def _meet(
    buckets: DataFrame, blocks: DataFrame, on: list[str], slots: Column, batches: Column,
    compare: Callable[[Bucket, _Members, _Members], list[tuple]], related: Callable[[object, object], bool],
    names: list[str],
) -> DataFrame:
    """What ``compare`` returns for every bucket and every block with ``related`` labels.

    Buckets are dealt to slots and blocks to batches; a bucket is sent once for each batch,
    a block once for each slot, and a task holds one slot and one batch.
    """
    number = F.xxhash64("label", "dim", "length", "part")
    left = buckets.withColumn("slot", F.pmod(number, slots).cast("int"))
    left = left.withColumn("batch", F.explode(F.sequence(F.lit(0), batches.cast("int") - 1)))
    right = blocks.withColumn("batch", F.pmod(F.xxhash64("label", "dim", "block"), batches).cast("int"))
    right = right.withColumn("slot", F.explode(F.sequence(F.lit(0), slots.cast("int") - 1)))

    def run(held: pa.Table, asking: pa.Table) -> pa.Table:
        found: list[tuple] = []
        blocks = _members(asking)
        for members in _members(held):
            bucket = Bucket(members.vectors)
            for block in blocks:
                if block.dim == members.dim and related(members.label, block.label):
                    found += compare(bucket, members, block)
        columns = zip(*found, strict=True) if found else [()] * len(names)
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns, strict=True)})

    keys = [*on, "slot", "batch"]
    schema = ", ".join(f"{n} long" for n in names)
    return (
        left.select(*dict.fromkeys([*keys, "label", "dim", "members"]))
        .groupBy(keys)
        .cogroup(right.select(*dict.fromkeys([*keys, "label", "dim", "members"])).groupBy(keys))
        .applyInArrow(run, schema)
    )


def _numbers(embeddings: DataFrame, scale: int) -> DataFrame:
    """``row, id, label, dim, vector`` of the rows that take part."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    squared = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    return (
        embeddings.select(F.col("vec_id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), "embedding")
        .where(F.col("label").isNotNull() & F.coalesce(finite, F.lit(False)) & (F.size("embedding") > 0))
        .select("id", "label", whole.alias("vector"))
        .withColumn("squared", squared)
        .where(F.col("squared") < float(1 << 62))
        .select(
            F.monotonically_increasing_id().alias("row"), F.coalesce("id", F.lit(_LAST)).alias("id"), "label",
            F.size("vector").alias("dim"), "vector",
            F.floor(F.log1p("squared") / (2 * math.log(LENGTH_STEP))).alias("length"),
        )
    )


def hard_negatives(
    embeddings: DataFrame,
    *,
    anchors: Column | None = None,
    label: Column | None = None,
    scale: int = SCALE,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    bucket: int = BUCKET,
    block: int = BLOCK,
    focus: int = FOCUS,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``anchors`` says which rows are anchors, by ``id`` and ``label``; without it all are.
    ``label`` replaces the label before anything else.
    """
    rows = _numbers(embeddings, scale)
    if label is not None:
        rows = rows.withColumn("label", label)
    asking = (anchors if anchors is not None else F.lit(True)) & (F.col("id") != _LAST)
    rows = cut(rows.withColumn("anchor", F.coalesce(asking, F.lit(False))))
    # Counts are few, and met 32 times, so that the rows of a large group do so in many tasks.
    kind = ["label", "dim", "length"]
    counted = rows.groupBy(kind).agg(F.count(F.lit(1)).alias("held"), F.sum(F.col("anchor").cast("long")).alias("asked"))
    counted = counted.withColumn("parts", F.ceil(F.col("held") / bucket))
    summed = counted.groupBy("label", "dim").agg(
        F.sum("parts").alias("slots"), F.greatest(F.ceil(F.sum("asked") / block), F.lit(1)).alias("blocks")
    )
    total = summed.agg(F.sum("slots"), F.sum("blocks")).first()
    slots, batches = F.lit(int(total[0] or 1)), F.lit(math.ceil(int(total[1] or 1) / TOGETHER))
    counted = counted.join(summed, ["label", "dim"]).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(31))))
    placed = cut(
        rows.withColumn("salt", F.pmod("row", F.lit(32)).cast("int"))
        .join(counted, [*kind, "salt"])
        .withColumns({"part": F.pmod(F.xxhash64("row"), "parts"), "block": F.pmod(F.xxhash64("row", F.lit(1)), "blocks")})
        .withColumn("batches", F.ceil(F.col("blocks") / TOGETHER))
        .drop("held", "asked", "parts", "salt")
    )
    buckets = placed.groupBy(*kind, "part").agg(
        F.collect_list(F.struct("row", "id", "vector")).alias("members"),
        F.first("slots").alias("slots"), F.first("batches").alias("batches"),
    )
    buckets = cut(buckets)
    asked = placed.where("anchor")
    blocks = asked.groupBy("label", "dim", "block").agg(
        F.collect_list(F.struct("row", "id", "vector")).alias("members"),
        F.first("slots").alias("slots"), F.first("batches").alias("batches"),
    )

    def alike(held: Bucket, members: _Members, block: _Members) -> list[tuple]:
        found = []
        for row, anchor_id, anchor in zip(block.rows, block.ids, block.vectors, strict=True):
            at, scores = best_in_bucket(held, members.ids, members.rows, anchor, row, positives, focus)
            found += [(row, anchor_id, members.ids[i], members.rows[i], s) for i, s in zip(at, scores, strict=True)]
        return found

    names = ["anchor", "anchor_id", "positive_id", "positive", "positive_score"]
    near = _meet(buckets, blocks, ["label", "dim"], F.col("slots"), F.col("batches"), alike, lambda a, b: a == b, names)
    order = [F.desc("positive_score"), F.asc("positive_id"), F.asc("positive")]
    best = top_per_group(near, ["anchor"], order, positives, rank="place")
    bounds = best.groupBy("anchor").agg(
        F.collect_list(F.struct("place", "positive_id", "positive_score")).alias("bounds")
    )
    asked = asked.drop("anchor").join(bounds, F.col("row") == F.col("anchor"))
    blocks = cut(
        asked.groupBy("label", "dim", "block").agg(F.collect_list(F.struct("row", "id", "vector", "bounds")).alias("members"))
    )

    def between(held: Bucket, members: _Members, block: _Members) -> list[tuple]:
        found = []
        for row, anchor_id, anchor, bounds in zip(block.rows, block.ids, block.vectors, block.bounds, strict=True):
            # low * p <= 100 * s <= high * p, in whole numbers of any size.
            ranges = [(-(-low * b["positive_score"] // 100), high * b["positive_score"] // 100) for b in bounds]
            for b, (at, scores) in zip(bounds, between_in_bucket(held, members.ids, anchor, ranges, negatives, focus), strict=True):
                start = (row, anchor_id, b["place"], b["positive_id"], b["positive_score"])
                found += [(*start, members.ids[i], members.rows[i], s) for i, s in zip(at, scores, strict=True)]
        return found

    names = ["anchor", "anchor_id", "place", "positive_id", "positive_score", "negative_id", "negative", "negative_score"]
    found = _meet(buckets, blocks, [], slots, batches, between, lambda a, b: a != b, names)
    order = [F.desc("negative_score"), F.asc("negative_id"), F.asc("negative")]
    first = top_per_group(found, ["anchor", "place"], order, negatives, rank="rank")
    known = [F.nullif(F.col(c), F.lit(_LAST)).alias(c) for c in ("positive_id", "negative_id")]
    return first.select("anchor_id", known[0], F.col("rank").cast("int"), known[1], "positive_score", "negative_score")
