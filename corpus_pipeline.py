"""A corpus from raw documents to packed sequences, stage by stage.

Each stage takes what the one before kept, as a table. All but the last return the
columns of ``documents``: toxic documents go, repeated passages of lines go, one
document of each group of near copies stays, repeated strings of bytes go, and the
rest is packed.

SQL can express neither the classifier nor the tokenizer, so there is no SQL twin;
the stages are tested against brute force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from coursegrain.llm import lines, minhash, packing, suffixes, toxicity
from coursegrain.llm.common import read, stored
from coursegrain.llm.queries import byte_bpe

#: Bytes of a string that counts as a repeated passage, well below the shortest passage of
#: 50 words (about 250 bytes).
PASSAGE = 200

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def without_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return toxicity.keep_clean(docs, read(spark, folder, "labels"))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return lines.drop_repeated_lines(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return minhash.keep_one(docs)


def without_repeated_strings(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return suffixes.keep_unrepeated(docs, length=PASSAGE)


def packed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return packing.pack_documents(docs, **byte_bpe())


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("line dedup", without_repeated_lines),
    ("near-dedup", without_near_copies),
    ("suffix dedup", without_repeated_strings),
    ("packing", packed),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, folder)
        if name != STAGES[-1][0]:
            docs = stored(docs)
    return docs
