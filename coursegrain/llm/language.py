"""Language of a text by prediction by partial matching over bytes.

Each language has a tree of byte contexts of up to ``ORDER`` bytes with the bytes that
followed them. A text's code length under a tree is the sum over its bytes of -log2 of
their probability: the longest context known gives a byte its share ``n / (n + kinds)``,
and an escape its ``kinds / (n + kinds)``, where ``n`` counts what followed and ``kinds``
the different bytes among it. After an escape the next shorter context is asked, without
the bytes that have been ruled out; below the empty context all bytes left are alike. Trees do
not change while texts are scored, so that the bytes ruled out at a context are those of
the context one byte longer, and all that a context needs are four numbers. The text whose
code is shortest tells the language; ``score`` is the language's posterior probability when all are
as likely beforehand.

Learning: each language gives up to ``ROWS`` texts, those with the smallest hashes of id and
text, and ``BYTES`` bytes of all languages are shared equally; longer texts than a share are
passed over. Repeated rows count once. Of more than ``LANGUAGES`` values of ``lang`` those
with the most rows are learned. That bounds the trees, which are sent to all tasks. Nothing
else is sampled: all texts are scored, whole.

Edge cases: a NULL text or one without a letter is ``und`` with score 0, and so is everything
when nothing could be learned. Rows without ``lang`` are not learned from. Of languages with equal code lengths
the first by name is predicted. Repeated rows are scored each. Texts of any length are read
some megabytes at a time, one text in parts. An empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursegrain.operators.ranking import top_per_group

from .common import as_row, by_batch, crc_remainder, cut, schema_of
from .hashing import text_chunks

ORDER = 4
LANGUAGES, ROWS, BYTES = 1000, 1000, 16 << 20
PART = 4 << 20
UNKNOWN = "und"

_WIDTH = np.uint64(8)


def windows(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Each byte with the ``ORDER`` before it in its text, in one number; NUL bytes
    stand before a text."""
    wide = data.astype(np.uint64)
    code = wide.copy()
    place = np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))
    for k in range(1, ORDER + 1):
        before = np.zeros_like(wide)
        before[k:] = wide[:-k] if k < len(wide) else wide[:0]
        before[place < k] = 0
        code |= before << np.uint64(8 * k)
    return code


class Tree:
    """A frozen context tree, from windows and how often each was seen."""

    def __init__(self, levels: list[tuple[np.ndarray, ...]], ruled_out: list[np.ndarray]) -> None:
        self.levels, self.ruled_out = levels, ruled_out

    @classmethod
    def grown(cls, code: np.ndarray, count: np.ndarray) -> Tree:
        levels = []
        for order in range(ORDER + 1):
            low = code & np.uint64((1 << (8 * (order + 1))) - 1)
            seen, at = np.unique(low, return_inverse=True)
            n = np.bincount(at, weights=count, minlength=len(seen))
            context, owner = np.unique(seen >> _WIDTH, return_inverse=True)
            total = np.bincount(owner, weights=n, minlength=len(context))
            kinds = np.bincount(owner, minlength=len(context)).astype(float)
            levels.append((seen, n, context, total, kinds))
        # What the bytes known at a longer context weigh at the shorter one.
        ruled_out = [np.zeros(0)]
        for order in range(1, ORDER + 1):
            seen, _, context, _, _ = levels[order]
            shorter = seen & np.uint64((1 << (8 * order)) - 1)
            weight = levels[order - 1][1][np.searchsorted(levels[order - 1][0], shorter)]
            owner = np.searchsorted(context, seen >> _WIDTH)
            ruled_out.append(np.bincount(owner, weights=weight, minlength=len(context)))
        return cls(levels, ruled_out)

    def bits(self, code: np.ndarray) -> np.ndarray:
        """The code length of each window's last byte after the bytes before it."""
        out = np.zeros(len(code))
        going = np.arange(len(code))
        # Weight and kinds that earlier escapes have ruled out.
        gone, gone_kinds = np.zeros(len(code)), np.zeros(len(code))
        for order in range(ORDER, -1, -1):
            seen, n, context, total, kinds = self.levels[order]
            low = code[going] & np.uint64((1 << (8 * (order + 1))) - 1)
            owner = np.minimum(np.searchsorted(context, low >> _WIDTH), len(context) - 1)
            known = context[owner] == low >> _WIDTH
            place = np.minimum(np.searchsorted(seen, low), len(seen) - 1)
            found = known & (seen[place] == low)
            # A context that knows no more than the longer one is passed for free.
            new = kinds[owner] - gone_kinds[going]
            weight = total[owner] - gone[going] + new
            out[going[found]] += np.log2(weight[found] / n[place[found]])
            escapes = known & ~found & (new > 0)
            out[going[escapes]] += np.log2(weight[escapes] / new[escapes])
            at = going[known]
            gone_kinds[at] = kinds[owner[known]]
            if order:
                gone[at] = self.ruled_out[order][owner[known]]
            going = going[~found]
        out[going] += np.log2(256 - gone_kinds[going])
        return out


def learn(
    docs: DataFrame, *, languages: int = LANGUAGES, rows: int = ROWS, size: int = BYTES
) -> dict[str, Tree]:
    """The tree of each language in ``lang``."""
    given = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.octet_length("text") > 0))
    given = given.select(
        F.col("lang").cast("string").alias("lang"), F.col("text"),
        F.struct(F.xxhash64("doc_id", "text"), F.xxhash64("text", "doc_id")).alias("h"), F.octet_length("text").alias("size"),
    )
    by_rows = given.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages)
    names = [r["lang"] for r in by_rows.collect()]
    given = given.where(F.col("lang").isin(names))
    share = size // max(1, len(names))
    listed = given.where(F.col("size") <= share).select("lang", "h", "size").distinct()
    first = cut(top_per_group(listed, ["lang"], [F.asc("h"), F.asc("size")], rows, rank="place"))
    # Of these, the first that fit: few rows, so a window over each language is small.
    held = first.withColumn("sum", F.expr("sum(size) OVER (PARTITION BY lang ORDER BY place)")).where(F.col("sum") <= share)
    last = held.groupBy("lang").agg(F.max("h").alias("last"))
    # One row for each language, so that the texts stay where they are.
    chosen = given.where(F.col("size") <= share).join(F.broadcast(last), "lang").where(F.col("h") <= F.col("last"))
    texts = chosen.groupBy("lang", "h").agg(F.first("text").alias("text"))

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            coded = batch["lang"].dictionary_encode()
            codes = coded.indices.to_numpy()
            frames = []
            for at, end, data, offsets in text_chunks(batch["text"], PART):
                lang = np.repeat(codes[at:end], np.diff(offsets))
                frame = pd.DataFrame({"lang": lang, "code": windows(data, offsets)})
                frames.append(frame.groupby(["lang", "code"], sort=False).size().rename("n").reset_index())
            seen = pd.concat(frames)
            columns = [coded.dictionary.take(pa.array(seen["lang"])), pa.array(seen["code"].to_numpy().view(np.int64)), pa.array(seen["n"])]
            return pa.record_batch(columns, ["lang", "code", "n"])

        return work

    counted = by_batch(texts.select("lang", "text"), make, "lang string, code long, n long")
    counted = counted.groupBy("lang", "code").agg(F.sum("n").alias("n")).toArrow()
    langs = counted["lang"].combine_chunks().dictionary_encode()
    codes, n = counted["code"].to_numpy().view(np.uint64), counted["n"].to_numpy().astype(float)
    number = langs.indices.to_numpy()
    named = {name: number == k for k, name in enumerate(langs.dictionary.to_pylist())}
    return {name: Tree.grown(codes[named[name]], n[named[name]]) for name in sorted(named)}


def _text_bits(trees: list[Tree], data: np.ndarray, offsets: np.ndarray, lead: int) -> np.ndarray:
    """Code lengths of texts, one column for each tree, without the first ``lead`` bytes."""
    total = np.zeros((len(offsets) - 1, len(trees)))
    code = windows(data, offsets)
    # A window is looked up once however often it occurs.
    at, kinds = pd.factorize(code)
    first = offsets[:-1] + lead
    some = np.flatnonzero(np.diff(offsets) > lead)
    if len(some):
        for k, tree in enumerate(trees):
            total[some, k] = np.add.reduceat(tree.bits(kinds)[at], first[some])
    return total


def _parts(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, int]]:
    """Parts of a text column; a longer text in several, each after ``ORDER`` bytes of the
    one before, which are not to be counted again."""
    for at, end, data, offsets in text_chunks(column, PART):
        if len(data) <= PART or end - at > 1:
            yield at, end, data, offsets, 0
            continue
        for start in range(0, len(data), PART):
            lead = min(start, ORDER)
            piece = data[start - lead : start + PART]
            yield at, end, piece, np.array([0, len(piece)]), lead


def predict(docs: DataFrame, trees: dict[str, Tree]) -> DataFrame:
    """The columns of ``docs`` in ``row``, ``lang_pred`` and ``score``."""
    names = list(trees)
    shared = docs.sparkSession.sparkContext.broadcast([(t.levels, t.ruled_out) for t in trees.values()])

    def make():
        trees = [Tree(*held) for held in shared.value]

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            bits = np.zeros((batch.num_rows, len(trees)))
            for at, end, data, offsets, lead in _parts(batch["text"]):
                bits[at:end] += _text_bits(trees, data, offsets, lead)
            best = bits.argmin(axis=1)
            shorter = bits[np.arange(len(bits)), best]
            score = 1 / np.exp2(np.minimum(shorter[:, None] - bits, 0)).sum(axis=1)
            spelt = batch["spelt"].to_numpy(zero_copy_only=False)
            predicted = [names[k] if some else UNKNOWN for k, some in zip(best, spelt, strict=True)]
            columns = [batch["row"], pa.array(predicted, pa.string()), pa.array(np.where(spelt, score, 0.0))]
            return pa.record_batch(columns, ["row", "lang_pred", "score"])

        return work

    kept = as_row(docs.drop("text"))
    if not names:
        return docs.select(kept, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    spelt = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    given = docs.select(kept, "text", spelt.alias("spelt"))
    return by_batch(given, make, schema_of(given.select("row"), "lang_pred string, score double"))


def languages(docs: DataFrame, *, languages: int = LANGUAGES, rows: int = ROWS, size: int = BYTES) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``: learned from two thirds of the rows, by
    crc32 of the id, and applied to all."""
    held_out = crc_remainder(F.col("doc_id"), 3) == 1
    trees = learn(docs.where(~held_out), languages=languages, rows=rows, size=size)
    found = predict(docs.select("doc_id", "text"), trees)
    return found.select("row.doc_id", (crc_remainder(F.col("row.doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score")
