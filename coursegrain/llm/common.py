"""What the operators share: shared scratch space, Arrow batches, components."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

WHITE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def use_checkpoints(spark: SparkSession) -> None:
    """Checkpoints go to ``spark.checkpoint.dir``. Only a session in one process may do
    without; it then uses its warehouse folder."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder all executors share")
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    context.setCheckpointDir(folder)


def cut(df: DataFrame) -> DataFrame:
    """The rows, written once to the shared checkpoint folder; lineage ends there."""
    use_checkpoints(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Like ``cut``, for large tables: a compressed columnar table, in the same folder.
    It stays until that folder is cleared, or ``discard`` is called."""
    spark = df.sparkSession
    use_checkpoints(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    df.write.parquet(folder, compression=compression)
    return spark.read.schema(df.schema).parquet(folder)


def discard(table: DataFrame) -> None:
    """Deletes what ``stored`` returned."""
    spark = table.sparkSession
    for folder in {name.rsplit("/", 1)[0] for name in table.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def as_row(docs: DataFrame) -> Column:
    """All columns in one named ``row``, so that none can clash with a new one."""
    return F.struct(*[docs[c] for c in docs.columns]).alias("row")


def from_row(docs: DataFrame, **changed: Column) -> list[Column]:
    """The columns of ``docs`` out of ``row``, some of them changed."""
    return [changed.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns]


def schema_of(*frames_or_fields: DataFrame | str) -> str:
    """A schema text from frames' columns and written-out fields."""
    parts = []
    for x in frames_or_fields:
        if isinstance(x, str):
            parts.append(x)
        else:
            parts += [f"`{f.name}` {f.dataType.simpleString()}" for f in x.schema]
    return ", ".join(parts)


def by_batch(
    df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str
) -> DataFrame:
    """``mapInArrow`` with a function built once in each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            if batch.num_rows:
                out = work(batch)
                if out is not None:
                    yield out

    return df.mapInArrow(run, schema)


def by_batches(
    df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]], schema: str
) -> DataFrame:
    """``by_batch`` for functions that return a batch in parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            if batch.num_rows:
                out = work(batch)
                yield from [out] if isinstance(out, pa.RecordBatch) else out

    return df.mapInArrow(run, schema)


def crc_remainder(col: Column, n: int) -> Column:
    """crc32 of the value as text, modulo n; NULL counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")), F.lit(n))


def crc_remainder_of(value: object, n: int) -> int:
    return zlib.crc32(("" if value is None else str(value)).encode()) % n


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``id, component``: the smallest id reachable over links ``a, b``.

    Each round gives a node the smallest label among itself and its neighbours,
    then jumps to the label of that label, so that rounds grow with the logarithm
    of the longest path. Minima are combined in the map tasks, so that the many
    links of one node are not gathered. ``nodes`` has one row per id.
    """
    both = cut(
        links.select("a", "b")
        .unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        .where("a <> b")
        .distinct()
    )
    labels = both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("label"))
    while True:
        near = (
            both.join(labels, both["b"] == labels["id"])
            .groupBy(F.col("a").alias("id"))
            .agg(F.min("label").alias("near"))
        )
        better = labels.join(near, "id").select("id", "label", F.least("label", "near").alias("new"))
        above = labels.select(F.col("id").alias("new"), F.col("label").alias("above"))
        step = better.join(above, "new", "left").select(
            "id", F.least("new", F.coalesce("above", "new")).alias("new"), "label"
        )
        changes = Observation()
        step = cut(step.observe(changes, F.count(F.when(F.col("label") != F.col("new"), 1)).alias("n")))
        labels = step.select("id", F.col("new").alias("label"))
        if not changes.get["n"]:
            break
    return nodes.join(labels, "id", "left").select(
        "id", F.coalesce("label", "id").alias("component")
    )
