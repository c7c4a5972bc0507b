"""Best-fit packing of tokenised documents, improved by swaps.

Documents become token pieces of at most ``capacity``; pieces are packed into
sequences. A group of some thousand pieces is packed by one task: best fit in
order of falling length, then local search. The emptiest sequence that can gives its
pieces away: a piece moves where it fits, is exchanged for a smaller one, for two
smaller ones together, or two of its pieces for one. Each step moves tokens from an emptier
sequence to a fuller one, so that the sum of squared fills grows, until sequences are empty.

Edge cases: NULL and empty texts are the single token ``end_id``; rows with equal or
NULL ids are packed like any others; texts of any length are cut into pieces, of
which only the first may be short; an empty table gives no rows. Columns other than
the two that are named are not read.
"""

from __future__ import annotations

import base64
import zlib
from array import array
from bisect import bisect_left, insort

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_batch, cut

CAPACITY = 2048
#: Pieces that one task packs; the loss is below one sequence a group.
GROUP = 8192
#: Words whose ids a task remembers at once.
_REMEMBERED = 600_000

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class _Odd(Exception):
    """White space beside a space: such texts are cut more carefully."""


class _Words(dict):
    """Ids, as bytes, of a space and the word after it, found once per word.

    A space between two visible characters always starts a new unit of the
    byte-level pattern, so that ids of a text are those of its words in turn. Words of
    plain Latin letters take the faster of two libraries with the same vocabulary.
    """

    def __init__(self, tokenizer: str, ranks: str | None, pattern: str | None) -> None:
        super().__init__()
        from tokenizers import Tokenizer

        self._slow = Tokenizer.from_file(tokenizer)
        self._fast = None
        if ranks and pattern:
            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self._fast = tiktoken.Encoding(
                "own", pat_str=pattern, mergeable_ranks=table, special_tokens={}
            )
        self._careful = regex.compile(r"(?<=\S) (?=\S)")

    def listed(self, text: str) -> list[int]:
        if self._fast is not None and (not text or max(text) < "ɐ") and "<|" not in text:
            return self._fast.encode_ordinary(text)
        return self._slow.encode(text, add_special_tokens=False).ids

    def ids(self, text: str) -> bytes:
        return array("I", self.listed(text)).tobytes()

    def __missing__(self, word: str) -> bytes:
        if not word or word[0].isspace() or word[-1].isspace():
            raise _Odd
        found = self.ids(" " + word)
        if len(word) <= 64:
            if len(self) >= _REMEMBERED:
                self.clear()
            self[word] = found
        return found

    def of_text(self, text: str) -> bytes:
        if not text:
            return b""
        words = text.split(" ")
        try:
            if words[0] and words[0][-1].isspace():
                raise _Odd
            return self.ids(words[0]) + b"".join(map(self.__getitem__, words[1:])) if words[0] else self._rest(text)
        except _Odd:
            return self._rest(text)

    def _rest(self, text: str) -> bytes:
        first, *rest = self._careful.split(text)
        out = [self.ids(first)]
        for word in rest:
            known = self.get(word)
            out.append(self.ids(" " + word) if known is None else known)
        return b"".join(out)


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    *,
    ranks: str | None = None,
    pattern: str | None = None,
    end_id: int = 0,
    capacity: int = CAPACITY,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: each text's ids and ``end_id``,
    cut into pieces; of a longer text the first piece takes what is over.

    ``ranks`` and ``pattern`` name the same vocabulary for a faster library.
    """

    def make():
        words = _Words(tokenizer, ranks, pattern)
        end = array("I", [end_id]).tobytes()

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            out: tuple[list, ...] = ([], [], [], [], [])
            for doc_id, text in zip(batch[0].to_pylist(), batch[1].to_pylist(), strict=True):
                ids = words.of_text(text or "") + end
                total = len(ids) // 4
                at, piece = 0, 0
                size = total if total <= capacity else total % capacity or capacity
                while at < total:
                    row = (doc_id, piece, at, size, zlib.crc32(ids[4 * at : 4 * (at + size)]))
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
                    at, piece, size = at + size, piece + 1, capacity
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            return pa.record_batch([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names)

        return work

    return by_batch(docs.select(F.col("doc_id").cast("long"), "text"), make, _PIECES)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The bin of each length, and the fill of each bin: longest first, each into the
    bin that it leaves the least room in."""
    bin_of = np.empty(len(lengths), np.int64)
    fills: list[int] = []
    with_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms: list[int] = []
    for i in np.argsort(-lengths, kind="stable"):
        size = int(lengths[i])
        at = bisect_left(rooms, size)
        if at == len(rooms):
            b, room = len(fills), capacity
            fills.append(0)
        else:
            room = rooms[at]
            b = with_room[room].pop()
            if not with_room[room]:
                rooms.pop(at)
        bin_of[i] = b
        fills[b] += size
        room -= size
        if room:
            if not with_room[room]:
                insort(rooms, room)
            with_room[room].append(b)
    return bin_of, np.array(fills, np.int64)


def improve(
    lengths: np.ndarray, bin_of: np.ndarray, fill: np.ndarray, capacity: int, *, patience: int = 200
) -> int:
    """Empty underfull bins in place; returns how many were emptied.

    Each step takes tokens out of an underfull bin into one as full or fuller: out of the
    emptiest that can give, so that fills drift apart and squared fill grows. The search ends
    when no step is left, when as few bins are left as the tokens need, or after
    ``patience`` steps between other bins that did not empty one.
    """
    least = -(-int(lengths.sum()) // capacity)
    bins, emptied, spent = len(fill), 0, 0
    while bins - emptied > least and spent <= patience:
        underfull = np.flatnonzero((fill > 0) & (fill < capacity))
        underfull = underfull[np.argsort(fill[underfull], kind="stable")]
        donor = next((int(b) for b in underfull if _give(int(b), lengths, bin_of, fill, capacity)), None)
        if donor is None:
            break
        if not fill[donor]:
            emptied, spent = emptied + 1, 0
        elif donor != underfull[0]:
            spent += 1
    return emptied


def _give(
    donor: int, lengths: np.ndarray, bin_of: np.ndarray, fill: np.ndarray, capacity: int
) -> bool:
    """One step that takes tokens out of ``donor``; False if there is none."""
    own = np.flatnonzero(bin_of == donor)
    room = capacity - fill
    takers = (room > 0) & (fill >= fill[donor])
    takers[donor] = False
    if not takers.any():
        return False
    # A document moves to where it leaves the least room.
    fits = np.where(takers, room, capacity + 1)
    for x in own[np.argsort(-lengths[own])]:
        left = np.where(fits >= lengths[x], fits, capacity + 1)
        b = int(np.argmin(left))
        if left[b] <= capacity:
            _move(x, b, lengths, bin_of, fill)
            return True
    others = np.flatnonzero(takers[bin_of])
    size, slack = lengths[others], room[bin_of[others]]
    best_gain, best = 0, ()
    # One for one: the taker's document is shorter, by no more than its room.
    for x in own:
        gain = lengths[x] - size
        gain = np.where(gain <= slack, gain, 0)
        k = int(np.argmax(gain)) if len(gain) else 0
        if len(gain) and gain[k] > best_gain:
            best_gain, best = int(gain[k]), ((int(x),), (int(others[k]),))
    # Two of the donor's for one of the taker's.
    for i, x in enumerate(own):
        for y in own[i + 1 :]:
            gain = lengths[x] + lengths[y] - size
            gain = np.where(gain <= slack, gain, 0)
            k = int(np.argmax(gain)) if len(gain) else 0
            if len(gain) and gain[k] > best_gain:
                best_gain, best = int(gain[k]), ((int(x), int(y)), (int(others[k]),))
    # One of the donor's for two neighbours in a taker.
    order = others[np.lexsort((lengths[others], bin_of[others]))]
    pairs = np.flatnonzero(bin_of[order[:-1]] == bin_of[order[1:]])
    if len(pairs):
        first, second = order[pairs], order[pairs + 1]
        both, slack = lengths[first] + lengths[second], room[bin_of[first]]
        for x in own:
            gain = lengths[x] - both
            gain = np.where(gain <= slack, gain, 0)
            k = int(np.argmax(gain))
            if gain[k] > best_gain:
                best_gain, best = int(gain[k]), ((int(x),), (int(first[k]), int(second[k])))
    if not best_gain:
        return False
    given, taken = best
    taker = int(bin_of[taken[0]])
    for x in taken:
        _move(x, donor, lengths, bin_of, fill)
    for x in given:
        _move(x, taker, lengths, bin_of, fill)
    return True


def _move(x: int, to: int, lengths: np.ndarray, bin_of: np.ndarray, fill: np.ndarray) -> None:
    fill[bin_of[x]] -= lengths[x]
    fill[to] += lengths[x]
    bin_of[x] = to


def pack(
    pieces: DataFrame, *, capacity: int = CAPACITY, group: int = GROUP, length: str = "length"
) -> DataFrame:
    """The rows with ``sequence_id`` and ``offset``: no two overlap, each sequence is
    gapless from 0 and holds ``capacity`` at most.

    Rows get a number as they are stored and go to groups by its hash, as many as the
    row count asks for, so that equal rows and equal ids spread. Full pieces are
    sequences of their own and take no part. ``pieces`` must come from a checkpoint or
    table (the numbers are those of its stored rows).
    """
    numbered = pieces.withColumn("_row", F.monotonically_increasing_id())
    full = F.col(length) >= capacity
    rest = numbered.where(~full)
    groups = max(1, -(-rest.count() // group))
    schema = rest.schema
    names = rest.columns
    packed_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)

    def of_group(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("_row", kind="stable")
        sizes = frame[length].to_numpy(np.int64)
        bin_of, fill = best_fit(sizes, capacity)
        improve(sizes, bin_of, fill, capacity)
        order = np.argsort(bin_of, kind="stable")
        ends = np.cumsum(sizes[order])
        starts = ends - sizes[order]
        first = np.r_[True, bin_of[order][1:] != bin_of[order][:-1]] if len(order) else []
        base = np.maximum.accumulate(np.where(first, starts, 0))
        offset = np.empty(len(sizes), np.int64)
        offset[order] = starts - base
        frame = frame[names].assign(
            sequence_id=(int(key[0]) << 32) + bin_of, offset=offset
        )
        return frame

    spread = rest.withColumn("_group", F.pmod(F.xxhash64("_row"), F.lit(groups)))
    packed = spread.groupBy("_group").applyInPandas(
        lambda key, frame: of_group(key, frame.drop(columns="_group")),
        f"{packed_schema}, sequence_id long, offset long",
    )
    alone = numbered.where(full).select(
        *names, (-1 - F.col("_row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return packed.unionByName(alone).drop("_row")


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    *,
    ranks: str | None = None,
    pattern: str | None = None,
    end_id: int = 0,
    capacity: int = CAPACITY,
    group: int = GROUP,
) -> DataFrame:
    """Tokenised, cut and packed: one row per piece."""
    pieces = token_pieces(
        docs, tokenizer, ranks=ranks, pattern=pattern, end_id=end_id, capacity=capacity
    )
    return pack(cut(pieces), capacity=capacity, group=group)
