"""Collocations of two to four words by stripes.

A stripe is a prefix of words with a counter of the words that follow it; the empty
prefix counts single words. Tasks count the stripes of some megabytes of text, ship them
whole by ``(lang, prefix)``, and add them element by element where they meet. What is
left of a stripe are the extensions of its prefix seen ``least`` times or more. An
extension's counter is the total of the prefix that is one word longer, so that one table
holds candidates, the totals of all their parts, and the frequencies of longer candidates
that may subsume shorter ones.

Three passes over the texts: words, pairs, then three and four words. A phrase can be
frequent only if its parts are, so a pass counts only what the pass before left open. The
frequent phrases travel as a bitmap of their hashes, of ``bits`` bits whatever the corpus;
a collision keeps a phrase that is dropped after its exact count. Stripes of prefixes seen
``crowded`` times or more are shipped in segments, by a hash of the next word.

Arithmetic on counts is in decimals of 38 digits.

Edge cases: a NULL text is empty, a NULL ``lang`` is ``und`` and counts with rows that say
so. Repeated rows count each. Very long texts are counted alone, whole. An empty table, or
one without frequent phrases, gives no rows. Ties are broken by score, count and phrase.
Columns other than ``text`` and ``lang`` are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursegrain.operators.ranking import top_per_group

from .common import by_batches, stored
from .hashing import Prefixes, mix, text_chunks

LEAST, TOP = 30, 2000
LONGEST = 4
BITS = 1 << 26
CROWDED, SEGMENTS = 1 << 16, 64
CHUNK = 6 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ENDS = np.zeros(256, bool)
_ENDS[[*b".,;:!?\n\v\f\r"]] = True
_BETWEEN = _ENDS.copy()
_BETWEEN[[*b" \t"]] = True

# Words and counts of a stripe are joined by spaces: smaller to ship than arrays.
_STRIPES = "lang string, prefix string, segment int, next string, n string"


def _hashes(words: pa.Array) -> np.ndarray:
    """A hash of each string."""
    out = np.zeros(len(words), np.uint64)
    for at, end, data, offsets in text_chunks(words):
        out[at:end] = Prefixes(data).span(offsets[:-1], offsets[1:]) + np.diff(offsets).astype(np.uint64)
    return out


def _followed(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a phrase from those of its prefix and last word."""
    return mix(prefix * np.uint64(0x9E3779B97F4A7C15) + word)


class Bitmap:
    """A set of hashes in bits; what was put in is always found."""

    def __init__(self, packed: np.ndarray) -> None:
        self.packed = packed

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        slot = hashes % np.uint64(8 * len(self.packed))
        return (self.packed[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 > 0


def _phrase_hashes(lang: pa.Array, phrases: pa.Array) -> np.ndarray:
    words = pa.compute.split_pattern(phrases, " ")
    ends = words.offsets.to_numpy().astype(np.int64)
    each = _hashes(words.flatten())
    ends, hashed = ends - ends[0], _hashes(lang)
    count = np.diff(ends)
    for k in range(int(count.max(initial=0))):
        at = np.flatnonzero(count > k)
        hashed[at] = _followed(hashed[at], each[ends[at] + k])
    return hashed


def _bitmap(phrases: DataFrame, bits: int) -> Bitmap:
    """The phrases as a bitmap of a fixed size, put together by Spark in pieces of 4 KB."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            slot = _phrase_hashes(batch["lang"], batch["phrase"]) % np.uint64(bits)
            return pa.record_batch([pa.array(slot.view(np.int64))], ["slot"])

        return work

    slots = by_batches(phrases.select("lang", "phrase"), make, "slot long")
    pieces = slots.groupBy(F.shiftright("slot", 15).alias("piece")).agg(
        F.bitmap_construct_agg(F.col("slot").bitwiseAND(F.lit((1 << 15) - 1))).alias("bits")
    )
    packed = np.zeros(bits // 8, np.uint8)
    for piece, held in pieces.toLocalIterator():
        packed[piece * 4096 : (piece + 1) * 4096] = np.frombuffer(held, np.uint8)
    return Bitmap(packed)


class _Texts:
    """The words of a chunk of texts: number of each distinct ``(lang, word)``, and
    whether the next word continues the piece."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, langs: np.ndarray) -> None:
        data = _LOWER[data]
        inside = ~_BETWEEN[data]
        opens, closes = inside.copy(), inside.copy()
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        edges = offsets[1:-1]
        edges = edges[(edges > 0) & (edges < len(data))]
        opens[edges] |= inside[edges]
        closes[edges - 1] |= inside[edges - 1]
        start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        text = np.searchsorted(offsets, start, side="right") - 1
        piece = np.cumsum(_ENDS[data])[start] + text if len(start) else start
        self.joined = piece[1:] == piece[:-1]
        at = np.zeros(len(start) + 1, np.int64)
        np.cumsum(end - start, out=at[1:])
        spelt = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(at), pa.py_buffer(data[inside].tobytes()))
        coded = spelt.dictionary_encode()
        self.spelling = coded.dictionary
        size = max(1, len(coded.dictionary))
        self.ids, kinds = pd.factorize(langs[text] * size + coded.indices.to_numpy().astype(np.int64))
        self.lang, self.word = kinds // size, kinds % size
        self.kinds = len(kinds)

    def words(self, ids: np.ndarray) -> pa.Array:
        return self.spelling.take(pa.array(self.word[ids]))


def _joined(ends: pa.Array, values: pa.Array) -> pa.Array:
    return pa.compute.binary_join(pa.ListArray.from_arrays(ends, values), " ")


def _stripes(
    texts: _Texts, langs: pa.Array, prefixes: list[np.ndarray], lang: np.ndarray, prefix: np.ndarray,
    following: np.ndarray, count: np.ndarray, segment: np.ndarray,
) -> pa.RecordBatch:
    """Entries as stripes. ``prefixes``: ids of the words of each prefix, one array a place."""
    order = np.lexsort((segment, prefix))
    prefix, following, count, segment = prefix[order], following[order], count[order], segment[order]
    fresh = np.r_[True, (prefix[1:] != prefix[:-1]) | (segment[1:] != segment[:-1])]
    first = np.flatnonzero(fresh)
    ends = pa.array(np.r_[first, len(prefix)].astype(np.int32))
    named = prefix[first]
    if prefixes:
        words = [texts.words(p[named]) for p in prefixes]
        spelt = pa.compute.binary_join_element_wise(*words, pa.scalar(" ", pa.large_string()))
    else:
        spelt = pa.array([""] * len(first))
    columns = [
        langs.take(pa.array(lang[named])).cast(pa.string()),
        spelt.cast(pa.string()),
        pa.array(segment[first].astype(np.int32)),
        _joined(ends, texts.words(following).cast(pa.string())),
        _joined(ends, pa.array(count).cast(pa.string())),
    ]
    return pa.record_batch(columns, ["lang", "prefix", "segment", "next", "n"])


def _totals(texts: _Texts, langs: pa.Array) -> pa.RecordBatch:
    """All words of each language, as the counter of the empty word."""
    n = np.bincount(texts.lang[texts.ids], minlength=len(langs))
    at = np.flatnonzero(n)
    empty = pa.array([""] * len(at))
    columns = [
        langs.take(pa.array(at)).cast(pa.string()), empty, pa.array(np.zeros(len(at), np.int32)),
        empty, pa.array(n[at]).cast(pa.string()),
    ]
    return pa.record_batch(columns, ["lang", "prefix", "segment", "next", "n"])


def _counted(texts: _Texts, langs: pa.Array, words: Bitmap | None, pairs: Bitmap | None, crowded: Bitmap | None):
    """The stripes of one chunk: words, or pairs of frequent words, or what frequent pairs allow."""
    spelt = _hashes(texts.spelling)[texts.word]
    part = (spelt % np.uint64(SEGMENTS)).astype(np.int64)
    if words is None:
        count = np.bincount(texts.ids, minlength=texts.kinds)
        yield _totals(texts, langs)
        where = texts.lang
        yield _stripes(texts, langs, [], np.arange(len(langs)), where, np.arange(texts.kinds), count, part)
        return
    hashed = _followed(_hashes(langs)[texts.lang], spelt)
    frequent = words.holds(hashed)[texts.ids]
    at = np.flatnonzero(texts.joined & frequent[:-1] & frequent[1:])
    if not len(at):
        return
    size = np.int64(texts.kinds)
    found, pair, count = np.unique(texts.ids[at] * size + texts.ids[at + 1], return_inverse=True, return_counts=True)
    one, two = found // size, found % size
    if pairs is None:
        segment = np.where(crowded.holds(hashed)[one], part[two], 0)
        yield _stripes(texts, langs, [np.arange(size)], texts.lang, one, two, count, segment)
        return
    # Positions where a frequent pair starts, and its number.
    hashed = _followed(hashed[one], spelt[two])
    held = pairs.holds(hashed)[pair]
    at, pair = at[held], pair[held]
    prefixes, prefix = [one, two], pair
    heavy = crowded.holds(hashed)
    for _ in range(3, LONGEST + 1):
        # A prefix grows where the one that starts a word later is there too.
        grows = np.flatnonzero(at[1:] == at[:-1] + 1)
        if not len(grows):
            return
        following = texts.ids[at[grows] + len(prefixes)]
        found, longer, count = np.unique(prefix[grows] * size + following, return_inverse=True, return_counts=True)
        head, last = found // size, found % size
        segment = np.where(heavy[head], part[last], 0)
        yield _stripes(texts, langs, prefixes, texts.lang[prefixes[0]], head, last, count, segment)
        at, prefix, heavy = at[grows], longer, heavy[head]
        prefixes = [p[head] for p in prefixes] + [last]


def _merged(
    docs: DataFrame, least: int, words: Bitmap | None = None, pairs: Bitmap | None = None, crowded: Bitmap | None = None
) -> DataFrame:
    """``lang, prefix, next, phrase, n``: one pass over the texts, its stripes added up;
    extensions seen ``least`` times or more, and the totals of all words."""
    bitmaps = [b.packed if b else None for b in (words, pairs, crowded)]
    shared = docs.sparkSession.sparkContext.broadcast(bitmaps)

    def make():
        bitmaps = [Bitmap(b) if b is not None else None for b in shared.value]

        def work(batch: pa.RecordBatch):
            coded = batch["lang"].dictionary_encode()
            codes = coded.indices.to_numpy().astype(np.int64)
            for at, end, data, offsets in text_chunks(batch["text"], CHUNK):
                texts = _Texts(data, offsets, codes[at:end])
                if len(texts.ids):
                    yield from _counted(texts, coded.dictionary, *bitmaps)

        return work

    read = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text")
    )
    stripes = by_batches(read, make, _STRIPES).repartition("lang", "prefix", "segment")
    entries = F.arrays_zip(F.split("next", " "), F.split("n", " "))
    each = stripes.select("lang", "prefix", "segment", F.inline(entries).alias("next", "n"))
    added = each.groupBy("lang", "prefix", "segment", "next").agg(F.sum(F.col("n").cast("long")).alias("n"))
    phrase = F.when(F.col("prefix") == "", F.col("next")).otherwise(F.concat_ws(" ", "prefix", "next"))
    return stored(
        added.where((F.col("n") >= least) | (F.col("next") == "")).select("lang", "prefix", "next", phrase.alias("phrase"), "n")
    )


def frequent_phrases(
    docs: DataFrame, *, least: int = LEAST, bits: int = BITS, crowded: int = CROWDED
) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, words, f`` of all phrases of one to four words seen ``least``
    times or more, and ``lang, n``, the words of each language."""
    counted = _merged(docs, least)
    words = counted.where("next <> ''")
    held = _bitmap(words, bits)
    heads = _bitmap(words.where(F.col("n") >= crowded), bits)
    pairs = _merged(docs, least, held, None, heads)
    both = _bitmap(pairs, bits)
    # A prefix of three words is split as its first two are.
    heads = _bitmap(pairs.where(F.col("n") >= crowded), bits)
    longer = _merged(docs, least, held, both, heads)
    all_phrases = words.unionByName(pairs).unionByName(longer)
    size = F.size(F.split("phrase", " "))
    return (
        all_phrases.select("lang", "phrase", size.alias("words"), F.col("n").alias("f")),
        counted.where("next = ''").select("lang", "n"),
    )


def _exact(column: str):
    return F.col(column).cast("decimal(38,0)")


def collocations(
    docs: DataFrame,
    *,
    least: int = LEAST,
    top: int = TOP,
    subsumed: int = 80,
    bits: int = BITS,
    crowded: int = CROWDED,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's first ``top`` phrases.

    A phrase's score is that of its lowest-scoring cut; it is dropped when a longer
    candidate around it has ``subsumed`` per cent of its occurrences or more.
    """
    phrases, sizes = frequent_phrases(docs, least=least, bits=bits, crowded=crowded)
    words = F.split("phrase", " ")
    candidates = phrases.where("words >= 2").select("lang", "phrase", "words", F.col("f").alias("a"))
    inner = F.expr(
        "flatten(transform(sequence(2, words - 1), k -> transform(sequence(1, words - k + 1),"
        " i -> array_join(slice(split(phrase, ' '), i, k), ' '))))"
    )
    # Maxima are combined in the map tasks: a phrase inside very many is no hot key.
    around = (
        candidates.where("words > 2")
        .select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("longer"))
        .groupBy("lang", "phrase")
        .agg(F.max("longer").alias("longer"))
    )
    # At least one occurrence in `subsumed` of a hundred is around it: not on its own.
    alone = (
        candidates.join(around, ["lang", "phrase"], "left")
        .where(F.coalesce(100 * _exact("longer") < subsumed * _exact("a"), F.lit(True)))
        .drop("longer")
    )
    cuts = alone.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).select(
        "lang", "phrase", "a", "cut",
        F.array_join(F.slice(words, F.lit(1), F.col("cut")), " ").alias("left"),
        F.array_join(F.slice(words, F.col("cut") + 1, F.col("words") - F.col("cut")), " ").alias("right"),
    )
    left = phrases.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = phrases.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    valued = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"])
    # The divisor of two 64-bit counts and the product take more than 64 bits.
    valued = valued.withColumns({"up": 2_000_000 * _exact("a"), "down": _exact("l") + _exact("r")})
    scored = (
        valued.select("lang", "phrase", "a", "cut", "l", "r", F.expr("up div down").alias("score"))
        .groupBy("lang", "phrase")
        .agg(F.min(F.struct("score", "cut", "a", "l", "r")).alias("lowest"))
        .select("lang", "phrase", "lowest.a", "lowest.l", "lowest.r", "lowest.score")
    )
    best = top_per_group(scored, ["lang"], [F.desc("score"), F.desc("a"), F.asc("phrase")], top, rank="rank")
    return best.join(sizes, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
