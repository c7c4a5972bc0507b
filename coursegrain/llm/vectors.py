"""Near-duplicate vectors by Euclidean p-stable hashing.

Vectors of length one fall into buckets of several tables: a table's key is ``width``-wide
cells of random Gaussian projections. Vectors of one label and one bucket are compared
by exact cosine in double precision.

At the default cosine of 0.98 the distance is 0.2; a cell of width 1 keeps such a pair
together with probability 0.84, a table of 10 cells with 0.18, one of 24 tables with
0.99. More alike pairs are found more surely. At larger tables ``cells`` should grow with
the logarithm of the rows.

Equal vectors of a label are one class from the start. A bucket is cut into blocks of
``BLOCK`` classes, and a task compares two blocks, counting links without emitting pairs;
a pair that meets in several tables counts in the first of them. Blocks return the number
of links of each class and one representative for each of their components, from which the
components of all are found.

Edge cases: vectors that are NULL, empty, zero, or hold NULL or non-finite values, and rows
without a label, link with nothing. Vectors of different sizes do not link.
Rows that share an id are vectors of their own. An empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_batch, components, cut
from .hashing import mix

COSINE = 0.98
TABLES, CELLS, WIDTH = 24, 10, 1.0
BLOCK = 512


def bucket_keys(vectors: np.ndarray, tables: int, cells: int, width: float, seed: int = 7) -> np.ndarray:
    """Keys of unit vectors, one column for each table."""
    random = np.random.default_rng((seed, vectors.shape[1]))
    lines = random.standard_normal((vectors.shape[1], tables * cells))
    shift = random.uniform(0, width, tables * cells)
    cell = np.floor((vectors @ lines + shift) / width).astype(np.int64).view(np.uint64)
    cell = cell.reshape(len(vectors), tables, cells)
    key = np.zeros((len(vectors), tables), np.uint64)
    for k in range(cells):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + cell[:, :, k])
    return key.view(np.int64)


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest member of each one's component."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if np.array_equal(label, before):
            break
    return label


def _keyed(classes: DataFrame, tables: int, cells: int, width: float) -> DataFrame:
    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            vectors = batch["embedding"].to_pylist()
            keys = np.zeros((len(vectors), tables), np.int64)
            sizes = np.array([len(v) for v in vectors])
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                held = np.array([vectors[i] for i in at], np.float64)
                # Scaled first, so that squares neither overflow nor vanish.
                held /= np.abs(held).max(axis=1, keepdims=True)
                held /= np.linalg.norm(held, axis=1, keepdims=True)
                keys[at] = bucket_keys(held, tables, cells, width)
            ends = pa.array(np.arange(len(keys) + 1, dtype=np.int32) * tables)
            listed = pa.ListArray.from_arrays(ends, pa.array(keys.ravel()))
            return pa.record_batch([batch["cls"], listed], ["cls", "keys"])

        return work

    return by_batch(classes.select("cls", "embedding"), make, "cls long, keys array<long>")


def _block_links(key: tuple, frame: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """Links between two blocks of a bucket, or within one: ``cls, found, other``."""
    table, one, two = int(key[2]), int(key[4]), int(key[5])
    frame = frame.sort_values("cls", kind="stable").reset_index(drop=True)
    vectors = np.array(frame["embedding"].tolist(), np.float64)
    vectors /= np.abs(vectors).max(axis=1, keepdims=True)
    norms = np.linalg.norm(vectors, axis=1)
    keys = np.array(frame["keys"].tolist(), np.int64)[:, :table]
    block = frame["block"].to_numpy()
    rows, columns = np.flatnonzero(block == one), np.flatnonzero(block == two)
    near = (vectors[rows] @ vectors[columns].T) / np.outer(norms[rows], norms[columns]) >= cosine
    for t in range(table):  # counted in an earlier table
        near &= keys[rows, t][:, None] != keys[columns, t][None, :]
    if one == two:
        near &= ~np.eye(len(rows), dtype=bool)
    weight = frame["n"].to_numpy(np.int64)
    found = np.zeros(len(frame), np.int64)
    found[rows] += near @ weight[columns]
    if one != two:
        found[columns] += near.T @ weight[rows]
    a, b = np.nonzero(near)
    least = local_components(len(frame), rows[a], columns[b])
    hit = found > 0
    cls = frame["cls"].to_numpy()
    return pd.DataFrame({"cls": cls[hit], "found": found[hit], "other": cls[least[hit]]})


def near_vectors(
    embeddings: DataFrame,
    *,
    cosine: float = COSINE,
    tables: int = TABLES,
    cells: int = CELLS,
    width: float = WIDTH,
    block: int = BLOCK,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept``, one row per row of the input."""
    vector = F.transform("embedding", lambda x: x.cast("double"))
    rows = embeddings.select("vec_id", "label", vector.alias("embedding"))
    sound = (
        F.col("label").isNotNull()
        & F.coalesce(F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))), F.lit(False))
        & F.coalesce(F.exists("embedding", lambda x: x != 0), F.lit(False))
    )
    rows = rows.withColumns({"sound": sound, "h": F.xxhash64("embedding"), "g": F.xxhash64(F.lit(1), "embedding", F.lit(2))})
    classes = (
        rows.where("sound")
        .groupBy("label", "h", "g")
        .agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least"), F.first("embedding").alias("embedding"))
        .withColumn("cls", F.monotonically_increasing_id())
    )
    classes = cut(classes)
    keyed = cut(_keyed(classes, tables, cells, width))
    described = classes.select("cls", "label", F.size("embedding").alias("dim"))
    places = keyed.join(described, "cls").select("cls", "label", "dim", F.posexplode("keys").alias("table", "key"))
    where = ["label", "dim", "table", "key"]
    crowded = places.groupBy(where).agg(F.count(F.lit(1)).alias("held")).where("held > 1")
    blocks = F.ceil(F.col("held") / block).cast("int")
    placed = places.join(crowded, where).select(
        *where, "cls", blocks.alias("blocks"), F.pmod(F.xxhash64("cls", "table"), blocks).cast("int").alias("block")
    )
    # A class goes to the comparison of its block with each block.
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("with")
    sent = placed.select(*where, "cls", "block", other).select(
        *where, "cls", "block", F.least("block", "with").alias("one"), F.greatest("block", "with").alias("two")
    )
    full = sent.join(keyed, "cls").join(classes.select("cls", "n", "embedding"), "cls")
    found = cut(
        full.groupBy(*where, "one", "two").applyInPandas(
            lambda key, frame: _block_links(key, frame, cosine), "cls long, found long, other long"
        )
    )
    counts = found.groupBy("cls").agg(F.sum("found").alias("found"))
    parts = components(classes.select(F.col("cls").alias("id")), found.select(F.col("cls").alias("a"), F.col("other").alias("b")))
    joined = cut(
        classes.select("cls", "label", "h", "g", "n", "least")
        .join(parts.withColumnRenamed("id", "cls"), "cls")
        .join(counts, "cls", "left")
    )
    least = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    known = joined.join(least, "component").select(
        "label", "h", "g", "component_id", (F.col("n") - 1 + F.coalesce("found", F.lit(0))).alias("n_links")
    )
    # Rows without a class go round the join: they could be many of one kind.
    linked = rows.where("sound").join(known, ["label", "h", "g"])
    return linked.select("vec_id", "n_links", "component_id").unionByName(
        rows.where(~F.col("sound")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
