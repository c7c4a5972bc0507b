"""Removal of repeated passages of lines, by overlapping windows.

Every ``width`` consecutive lines of a text form a window. A window that occurs
earlier, in a row with a smaller id or further up in the same text, is a repeat, and
all lines of repeats go; what overlapping repeats cover is merged. First occurrences
are told from the input, not from what is left.

Lines are compared as they are, and blank lines, which hold nothing but white space,
are passed over: they are in no window and always stay. Only texts with ``width``
lines that are not blank have windows.

Windows are known by two 64-bit hashes. Only windows found twice or more meet again, and
Spark splits the join where one window is in very many rows.

Edge cases: a NULL text stays NULL with no lines. NULL ids come first in the order.
Rows with equal ids but different texts are told apart by a hash of the text; rows
equal in both are one document: they lose the same lines, and are no repeats of each
other. Columns of the input stay, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_row, from_row

WIDTH = 3
_BLANK = r"^\s*$"


def windows(rows: DataFrame, width: int = WIDTH) -> DataFrame:
    """Each window's hashes ``h, g``, place ``at`` among the row's windows, and numbers
    of its lines, from 0; the row is known by ``doc_id, _text``."""
    lines = F.split("text", "\n", -1)
    held = F.filter(
        F.transform(lines, lambda line, i: F.struct(i.alias("i"), line.alias("line"))),
        lambda x: ~x["line"].rlike(_BLANK),
    )
    base = rows.select("doc_id", "_text", held.alias("held")).where(F.size("held") >= width)
    many = F.transform(
        F.sequence(F.lit(0), F.size("held") - width),
        lambda i: F.struct(
            i.alias("at"),
            F.xxhash64(*[F.col("held")[i + k]["line"] for k in range(width)]).alias("h"),
            F.xxhash64(*[F.col("held")[i + k]["line"] for k in reversed(range(width))], F.lit(1)).alias("g"),
            F.array(*[F.col("held")[i + k]["i"] for k in range(width)]).alias("lines"),
        ),
    )
    return base.select("doc_id", "_text", F.inline(many))


def covered_lines(rows: DataFrame, width: int = WIDTH) -> DataFrame:
    """``_doc, _text, gone``: the numbers of the lines that repeats cover."""
    found = windows(rows, width)
    place = F.struct("doc_id", "_text", "at")
    first = (
        found.groupBy("h", "g")
        .agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("h", "g", "first")
    )
    later = found.join(first, ["h", "g"]).where(~F.col("first").eqNullSafe(place))
    # Windows overlap: each line is listed once for a row.
    return later.groupBy(F.col("doc_id").alias("_doc"), "_text").agg(
        F.array_distinct(F.flatten(F.collect_set("lines"))).alias("gone")
    )


def without_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``row`` with all columns of the input, ``kept`` with what is left of the text,
    ``n_lines`` and ``n_removed``."""
    rows = docs.select(as_row(docs), "doc_id", "text", F.xxhash64("text").alias("_text"))
    gone = covered_lines(rows.select("doc_id", "text", "_text"), width).withColumnRenamed("_text", "_gone_text")
    same = rows["doc_id"].eqNullSafe(gone["_doc"]) & (rows["_text"] == gone["_gone_text"])
    lines = F.split("text", "\n", -1)
    rest = F.array_join(F.filter(lines, lambda _, i: ~F.array_contains("gone", i)), "\n")
    return rows.join(gone, same, "left").select(
        "row",
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(rest).alias("kept"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).alias("n_removed"),
    )


def drop_repeated_lines(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """The rows of ``docs``, all columns as they are but for the text."""
    return without_repeats(docs, width).select(from_row(docs, text=F.col("kept")))
