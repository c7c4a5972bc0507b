"""Near-duplicate documents by ProbMinHash signatures, bands and verification.

A document's different shingles (runs of five words) arrive as Poisson processes of one
rate each: candidates are for the similarity of sets, by which pairs are linked, so how
often a shingle occurs does not weigh. ``signatures`` takes any weights. Each arrival draws
a register; a register keeps the shingle that came first. Arrivals end once all registers
are older than the next one. Two documents agree in a register with the probability Jaccard
similarity of their shingles, which with equal weights is close to that of the sets, and
equal to it for sets of one size. Documents that agree in a band of registers are candidates.

Documents with equal shingle sets are one class from the start, known by its smallest
id. In each bucket every class is paired with the smallest id. Then all pairs of a bucket
that are not yet in one component are compared, block against block inside the tasks:
what leaves a task is a link for each class it joined to another, not the pairs. Blocks
hold like numbers of shingles, and a component that fills blocks has them to itself, so
that blocks which cannot link are not compared. Buckets with the same members are one.

A pair is linked if its sets of shingles have a Jaccard similarity of ``similarity``
or more, computed from both texts. Classes are the components of links.

Rows are nodes by a hash of id and text: rows that share an id are documents of their own
unless their texts are the same too. A class is named by the smallest id in it; a row without
an id is named by a hash of its text, above all usual ids.

Edge cases: texts without words (NULL, empty) link with nothing; a text under five
words is one shingle. Very long texts are read whole, one at a time. Of equal rows each is
returned, and one is kept. Ties between rows of one id in a class go to the smaller node.
An empty table gives no rows. Other columns of the input are not touched.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_row, by_batch, components, cut, from_row
from .hashing import mix, shingles, text_chunks
from .vectors import local_components

SHINGLE = 5
SIMILARITY = 0.8
#: At similarity 0.8 a pair of sets of one size shares a band with probability 0.9998.
BANDS, ROWS = 28, 6
#: Classes, and shingles, that a block of a bucket holds.
BLOCK, BLOCK_SHINGLES = 512, 1_000_000

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def signatures(
    text: np.ndarray, element: np.ndarray, weight: np.ndarray, texts: int, registers: int
) -> np.ndarray:
    """Signatures of ``texts`` documents at once, ``texts`` by ``registers``; zeros for a
    document without elements."""
    first = np.full(texts * registers, np.inf)
    kept = np.zeros(texts * registers, np.uint64)
    time = np.zeros(len(text))
    state = element.copy()
    while len(text):
        state += _GOLDEN
        random = mix(state)
        uniform = ((random >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
        time = time - np.log(uniform) / weight
        register = text * registers + (mix(random) % np.uint64(registers)).astype(np.int64)
        early = np.flatnonzero(time < first[register])
        early = early[np.argsort(-time[early], kind="stable")]
        first[register[early]] = time[early]  # the earliest is written last
        kept[register[early]] = element[early]
        latest = first.reshape(texts, registers).max(axis=1)
        going = time < latest[text]
        text, element, weight, time = text[going], element[going], weight[going], time[going]
        state = state[going]
    return kept.reshape(texts, registers)


def _distinct(text: np.ndarray, hashed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of each text once."""
    order = np.lexsort((hashed, text))
    text, hashed = text[order], hashed[order]
    new = np.r_[True, (text[1:] != text[:-1]) | (hashed[1:] != hashed[:-1])] if len(text) else np.zeros(0, bool)
    return text[new], hashed[new]


def sketches(
    rows: DataFrame, *, width: int = SHINGLE, bands: int = BANDS, band_rows: int = ROWS
) -> DataFrame:
    """``id, set_a, set_b, held, keys``: two hashes of the set of shingles, its size, and a
    key for each band; ``keys`` is NULL for a text without words."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets: list[np.ndarray] = []
            keys: list[np.ndarray] = []
            sizes: list[np.ndarray] = []
            for at, end, data, offsets in text_chunks(batch["text"]):
                n = end - at
                text, hashed = _distinct(*shingles(data, offsets, width))
                own = np.zeros((n, 2), np.uint64)
                np.add.at(own[:, 0], text, mix(hashed + _GOLDEN))
                np.add.at(own[:, 1], text, mix(hashed ^ _GOLDEN))
                signed = signatures(text, hashed, np.ones(len(text)), n, bands * band_rows)
                band = np.zeros((n, bands), np.uint64)
                signed = signed.reshape(n, bands, band_rows)
                for k in range(band_rows):
                    band = mix(band * _GOLDEN + signed[:, :, k])
                sets.append(own), keys.append(band), sizes.append(np.bincount(text, minlength=n))
            own, band, size = np.concatenate(sets), np.concatenate(keys), np.concatenate(sizes)
            flat = pa.array(band.view(np.int64).ravel())
            listed = pa.ListArray.from_arrays(
                pa.array(np.arange(len(band) + 1, dtype=np.int32) * bands), flat,
                mask=pa.array(size == 0),
            )
            columns = [batch["id"], pa.array(own[:, 0].view(np.int64)), pa.array(own[:, 1].view(np.int64)), pa.array(size.astype(np.int64)), listed]
            return pa.record_batch(columns, ["id", "set_a", "set_b", "held", "keys"])

        return work

    return by_batch(rows, make, "id long, set_a long, set_b long, held long, keys array<long>")


def _packed(rows: DataFrame) -> DataFrame:
    """``id, packed``: texts, compressed for the shuffles that verification needs."""

    def make():
        codec = pa.Codec("zstd")

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            packed, sizes = [], []
            for text in batch["text"].to_pylist():
                data = (text or "").encode()
                packed.append(codec.compress(data, asbytes=True))
                sizes.append(len(data))
            columns = [batch["id"], pa.array(packed, pa.binary()), pa.array(sizes, pa.int64())]
            return pa.record_batch(columns, ["id", "packed", "size"])

        return work

    return by_batch(rows, make, "id long, packed binary, size long")


def _verified(pairs: DataFrame, texts: DataFrame, similarity: float, width: int) -> DataFrame:
    """The pairs ``a, b`` whose texts are as similar as that."""
    one = texts.select(F.col("id").alias("a"), F.col("packed").alias("pa"), F.col("size").alias("sa"))
    two = texts.select(F.col("id").alias("b"), F.col("packed").alias("pb"), F.col("size").alias("sb"))
    both = pairs.join(one, "a").join(two, "b").select("a", "b", "pa", "sa", "pb", "sb")

    def make():
        codec = pa.Codec("zstd")

        def sets(packed: bytes, size: int) -> np.ndarray:
            data = np.frombuffer(codec.decompress(packed, size, asbytes=True) if size else b"", np.uint8)
            return np.unique(shingles(data, np.array([0, size]), width)[1])

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            keep, last, known = [], None, None
            for k, (b, x, nx, y, ny) in enumerate(
                zip(*(batch[c].to_pylist() for c in ("b", "pa", "sa", "pb", "sb")), strict=True)
            ):
                if last != b:
                    last, known = b, sets(y, ny)
                own = sets(x, nx)
                shared = len(np.intersect1d(own, known, assume_unique=True))
                if shared >= similarity * (len(own) + len(known) - shared) - 1e-9:
                    keep.append(k)
            return pa.record_batch([batch["a"], batch["b"]], ["a", "b"]).take(pa.array(keep, pa.int64()))

        return work

    return by_batch(both, make, "a long, b long")


def _node() -> Column:
    return F.xxhash64(F.col("doc_id").cast("long"), "text")


def _ident() -> Column:
    hashed = F.xxhash64("text").bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
    return F.coalesce(F.col("doc_id").cast("long"), hashed)


def near_classes(
    docs: DataFrame,
    *,
    similarity: float = SIMILARITY,
    width: int = SHINGLE,
    bands: int = BANDS,
    band_rows: int = ROWS,
    block: int = BLOCK,
) -> DataFrame:
    """``node, class_id, kept``, one row per node: the smallest id of its class, and whether
    the node stands for it."""
    rows = docs.select(_node().alias("id"), "text")
    marks = cut(sketches(rows, width=width, bands=bands, band_rows=band_rows))
    held = marks.where("keys IS NOT NULL")
    # One member for each set of shingles; all rows of an id belong together.
    least = held.groupBy("set_a", "set_b").agg(
        F.min("id").alias("node"), F.first("held").alias("held"), F.first("keys").alias("keys")
    )
    least = cut(least)
    member = held.select("id", "set_a", "set_b").join(
        least.select("set_a", "set_b", "node"), ["set_a", "set_b"]
    )
    equal = member.where("id <> node").select(F.col("id").alias("a"), F.col("node").alias("b"))
    buckets = least.select("node", "held", F.posexplode("keys").alias("band", "key"))
    crowded = buckets.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    buckets = cut(buckets.join(crowded.select("band", "key"), ["band", "key"]))
    candidates = buckets.select(F.col("node").alias("id")).distinct()
    texts = cut(_packed(rows).join(candidates, "id", "left_semi").dropDuplicates(["id"]))

    leaders = buckets.groupBy("band", "key").agg(F.min("node").alias("b"))
    met = buckets.join(leaders, ["band", "key"]).where("node <> b")
    tried = cut(met.select(F.col("node").alias("a"), "b").distinct())
    links = cut(_verified(tried, texts, similarity, width))
    parts = cut(components(candidates, links))
    links = links.unionByName(cut(_between(buckets, parts, texts, similarity, width, block)))
    nodes = docs.select(_node().alias("id"), _ident().alias("name")).distinct()
    found = components(nodes.select("id"), equal.unionByName(links)).withColumnRenamed("id", "node")
    named = cut(nodes.withColumnRenamed("id", "node").join(found, "node"))
    least = named.groupBy("component").agg(F.min(F.struct("name", "node")).alias("least"))
    # Minima are combined in the map tasks; a large class is spread by AQE.
    return named.join(least, "component").select(
        "node", F.col("least.name").alias("class_id"), (F.col("least.node") == F.col("node")).alias("kept")
    )


def _between(
    buckets: DataFrame, parts: DataFrame, texts: DataFrame, similarity: float, width: int, block: int
) -> DataFrame:
    """Links ``a, b`` that join what the pairs of each bucket join, leaving out pairs of one
    component. A class that was linked in a task is returned once."""
    where = ["band", "key"]
    placed = buckets.join(parts.withColumnRenamed("id", "node"), "node")
    members = [F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y")]
    # In a bucket of two the smallest id has met the other.
    open_ = (
        placed.groupBy(where)
        .agg(F.count(F.lit(1)).alias("n"), F.min("component").alias("low"), F.max("component").alias("high"), *members)
        .where("n > 2 AND low <> high")
        .groupBy("n", "x", "y")
        .agg(F.min(F.struct(*where)).alias("at"))
        .select("at.*", "n")
    )
    placed = cut(placed.join(open_, where))
    own = placed.groupBy(*where, "component").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") >= block)
    # Sets that link are of one class of sizes or of neighbouring ones.
    sizes = F.floor(F.log("held") / F.log(F.lit(1.001 / similarity)))
    placed = placed.join(own, [*where, "component"], "left").select(
        *where, "node", "component", "held",
        F.col("m").isNotNull().alias("alone"),
        F.when(F.col("m").isNotNull(), F.col("component")).otherwise(0).alias("own"),
        F.when(F.col("n") > block, sizes).otherwise(0).alias("sizes"),
    )
    group = [*where, "alone", "own", "sizes"]
    share = F.greatest(F.ceil(F.count(F.lit(1)) / block), F.ceil(F.sum("held") / BLOCK_SHINGLES))
    pieces = placed.groupBy(group).agg(share.alias("pieces"))
    cells = pieces.select(*group, F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)).alias("piece"))
    cell = F.struct("alone", "own", "sizes", "piece").alias("cell")
    cells = cells.select(*where, cell)
    one, two = F.col("one"), F.col("two")
    met = cells.withColumnRenamed("cell", "one").join(cells.withColumnRenamed("cell", "two"), where).where(
        (one <= two)
        & (F.abs(one["sizes"] - two["sizes"]) <= 1)
        & ~(one["alone"] & two["alone"] & (one["own"] == two["own"]))
    )
    sides = F.array_distinct(F.array("one", "two"))
    met = met.select(*where, F.explode(sides).alias("cell"), "one", "two")
    placed = placed.join(pieces, group).select(
        *where, "node", "component", "alone", "own", "sizes",
        F.pmod(F.xxhash64("node", "band"), F.col("pieces")).alias("piece"),
    ).select(*where, "node", "component", cell)
    sent = placed.join(met, [*where, "cell"]).select(
        *where, F.col("node").alias("id"), "component", F.xxhash64("one").alias("one"), F.xxhash64("two").alias("two"),
        (F.col("cell") == one).alias("first"), (F.col("cell") == two).alias("second"),
    )

    def work(table: pa.Table) -> pa.Table:
        return _block_links(table, similarity, width)

    return sent.join(texts, "id").groupBy(*where, "one", "two").applyInArrow(work, "a long, b long")


def _block_links(table: pa.Table, similarity: float, width: int, columns: int = 4096) -> pa.Table:
    """Each class that is linked to another of a block, or of the other block, with the
    representative of those it is joined to."""
    codec = pa.Codec("zstd")
    data = [
        codec.decompress(packed, size, asbytes=True) if size else b""
        for packed, size in zip(table["packed"].to_pylist(), table["size"].to_pylist(), strict=True)
    ]
    text, hashed = [], []
    for at, _, body, offsets in text_chunks(pa.array(data, pa.large_binary())):
        of, own = _distinct(*shingles(body, offsets, width))
        text.append(of + at), hashed.append(own)
    text, hashed = np.concatenate(text), np.concatenate(hashed)
    ids, component, first, second = (table[c].to_numpy() for c in ("id", "component", "first", "second"))
    held = np.bincount(text, minlength=len(ids)).astype(np.float64)
    # Only shingles of more than one component can be shared by a pair that counts.
    order = np.argsort(hashed, kind="stable")
    text, hashed = text[order], hashed[order]
    starts = np.flatnonzero(np.r_[True, hashed[1:] != hashed[:-1]])
    of = component[text]
    mixed = np.minimum.reduceat(of, starts) != np.maximum.reduceat(of, starts)
    kept = np.repeat(mixed, np.diff(np.r_[starts, len(text)]))
    text = text[kept]
    column = np.repeat(np.arange(mixed.sum()), np.diff(np.r_[starts, len(kept)])[mixed])
    rows, others = np.flatnonzero(first), np.flatnonzero(second)
    shared = np.zeros((len(rows), len(others)), np.float32)
    for low in range(0, int(mixed.sum()), columns):
        here = slice(*np.searchsorted(column, [low, low + columns]))
        dense = np.zeros((len(ids), columns), np.float32)
        dense[text[here], column[here] - low] = 1
        shared += dense[rows] @ dense[others].T
    union = held[rows][:, None] + held[others][None, :] - shared
    near = (shared >= similarity * union - 1e-9) & (component[rows][:, None] != component[others][None, :])
    a, b = np.nonzero(near)
    a, b = rows[a], others[b]
    least = local_components(len(ids), a, b)
    hit = np.unique(np.r_[a, b])
    return pa.table({"a": ids[hit], "b": ids[least[hit]]})


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stand for their class, columns unchanged: the smallest
    id, once."""
    gone = near_classes(docs, **options).where("NOT kept").select("node")
    rows = docs.select(_node().alias("node"), as_row(docs))
    return rows.join(gone, "node", "left_anti").dropDuplicates(["node"]).select(from_row(docs))


def classified(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, class_id, kept`` of every row. Of equal rows all that stand for a class
    say so."""
    rows = docs.select("doc_id", _node().alias("node"))
    return rows.join(near_classes(docs, **options), "node").select("doc_id", "class_id", "kept")
