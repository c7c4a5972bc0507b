"""Removal of byte strings that occur more than once, found by suffix sorting.

A byte goes if a string of ``length`` bytes that covers it starts anywhere else too, in
the same document or another. Strings are judged on the input.

*Anchors.* Of the half-length strings within each window of ``length`` bytes, the one
with the smallest hash (the first of equals) is the window's anchor. Equal windows have
equal anchors at equal places, so that only windows whose anchor occurs twice
can be equal; anchors are some 2 in ``length`` positions and are all that is shuffled.
An anchor speaks for a run of neighbouring windows; if the stretch of text under the
whole run occurs twice, all its windows do.

*Suffix sort.* Where an anchor occurs in different stretches, the suffixes that begin
at the anchor are sorted by mergesort. Two suffixes are compared by prefix polynomial hashes: a
binary search finds their common extension, the next byte decides. Neighbours'
extensions then tell, for each distance a window begins before the anchor, which
suffixes agree far enough to the right; the hash of the bytes to the left
does the rest. Pairs found equal are compared byte by byte; should a hash have
misled, that distance is settled on the bytes themselves.

*Hot anchors.* An anchor with more than ``group`` different stretches is not
given to one task: its windows are counted by two 64-bit hashes, combined in the map tasks.

Edge cases: NULL and empty texts have no bytes; texts shorter than ``length`` lose
nothing. Equal rows are documents of their own, so that both lose what they share; NULL
ids are ids like others. An empty table gives no rows. Other columns are kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_batch, by_batches, schema_of, stored
from .hashing import Prefixes, mix, text_chunks

LENGTH = 400
#: Different stretches of one anchor that a task sorts.
GROUP = 2000

_LOW = np.uint64(0xFFFFFFFF)


def anchors_of(
    data: np.ndarray, offsets: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``anchor, first, last, hash, stretch``: an anchor's place, the first and last
    start of the windows it speaks for, its hash, and that of the whole stretch."""
    half = length // 2
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    prefix = Prefixes(data)
    at = np.arange(len(data) - half + 1)
    rank = (prefix.span(at, at + half) & ~_LOW) | at.astype(np.uint64)
    span = length - half + 1
    width = 1
    while width * 2 <= span:
        rank = np.minimum(rank[:-width], rank[width:])
        width *= 2
    starts = len(data) - length + 1
    rank = np.minimum(rank[:starts], rank[span - width : span - width + starts])
    anchor = (rank & _LOW).astype(np.int64)
    inside = np.zeros(starts + 1, np.int64)
    begins, ends = offsets[:-1], offsets[1:] - length + 1
    real = ends > begins
    np.add.at(inside, begins[real], 1)
    np.add.at(inside, ends[real], -1)
    valid = np.flatnonzero(np.cumsum(inside)[:starts] > 0)
    if not len(valid):
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    anchor = anchor[valid]
    new = np.r_[True, (anchor[1:] != anchor[:-1]) | (valid[1:] != valid[:-1] + 1)]
    opens = np.flatnonzero(new)
    closes = np.r_[opens[1:], len(valid)] - 1
    anchor, first, last = anchor[opens], valid[opens], valid[closes]
    hashed = prefix.span(anchor, anchor + half)
    place = ((anchor - first) * (1 << 20) + (last - first)).astype(np.uint64)
    stretch = mix(prefix.span(first, last + length) + mix(place))
    return anchor, first, last, hashed, stretch


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text"
    )


def anchor_rows(rows: DataFrame, length: int) -> DataFrame:
    """Anchors of all texts, places counted from the text's first byte."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            parts = []
            for at, end, data, offsets in text_chunks(batch["text"], 1 << 20):
                anchor, first, last, hashed, stretch = anchors_of(data, offsets, length)
                doc = np.searchsorted(offsets, anchor, side="right") - 1
                base = offsets[doc]
                parts.append((doc + at, anchor - base, first - base, last - base, hashed, stretch))
            doc, anchor, first, last, hashed, stretch = (np.concatenate(c) for c in zip(*parts))
            at = pa.array(doc)
            columns = [batch["doc_id"].take(at), batch["text_hash"].take(at)]
            columns += [pa.array(c.astype(np.int32)) for c in (anchor, first, last)]
            columns += [pa.array(c.view(np.int64)) for c in (hashed, stretch)]
            return pa.record_batch(columns, ["doc_id", "text_hash", "at", "first", "last", "anchor", "stretch"])

        return work

    schema = "doc_id long, text_hash long, at int, first int, last int, anchor long, stretch long"
    return by_batch(rows, make, schema)


class Suffixes:
    """Suffixes of one buffer, each up to its own end, compared by prefix hashes."""

    def __init__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, group: np.ndarray) -> None:
        self.data, self.prefix = data, Prefixes(data)
        self.start, self.size, self.group = start, end - start, group

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Bytes that suffixes a and b have in common, by binary search."""
        low = np.zeros(len(a), np.int64)
        high = np.minimum(self.size[a], self.size[b])
        sa, sb = self.start[a], self.start[b]
        while (low < high).any():
            middle = (low + high + 1) >> 1
            same = self.prefix.raw(sa, sa + middle) == self.prefix.raw(sb, sb + middle)
            low = np.where(same, middle, low)
            high = np.where(same, high, middle - 1)
        return low

    def before(self, a: np.ndarray, b: np.ndarray, or_equal: bool) -> np.ndarray:
        """Whether suffix a comes before b, in the order (group, bytes)."""
        out = self.group[a] < self.group[b]
        tie = np.flatnonzero(self.group[a] == self.group[b])
        if len(tie):
            x, y = a[tie], b[tie]
            n = self.common(x, y)
            over_x, over_y = n == self.size[x], n == self.size[y]
            limit = len(self.data) - 1
            less = self.data[np.minimum(self.start[x] + n, limit)] < self.data[np.minimum(self.start[y] + n, limit)]
            out[tie] = np.where(over_x, ~over_y | or_equal, np.where(over_y, False, less))
        return out

    def sorted(self) -> np.ndarray:
        """Mergesort from below; in each round all merges are done at once, every
        suffix finding its rank in the neighbouring run."""
        n = len(self.start)
        order, width = np.arange(n), 1
        while width < n:
            run = np.arange(n) // width
            left = run % 2 == 0
            low = np.minimum(np.where(left, (run + 1) * width, (run - 1) * width), n)
            high = np.minimum(low + width, n)
            begin = low.copy()
            going = np.flatnonzero(low < high)
            while len(going):
                middle = (low[going] + high[going]) >> 1
                other, own = order[middle], order[going]
                ahead = np.empty(len(going), bool)
                side = left[going]
                # Of equals the left run's come first.
                ahead[side] = self.before(other[side], own[side], False)
                ahead[~side] = self.before(other[~side], own[~side], True)
                low[going] = np.where(ahead, middle + 1, low[going])
                high[going] = np.where(ahead, high[going], middle)
                going = going[low[going] < high[going]]
            place = np.arange(n) + (low - begin) - np.where(left, 0, width)
            # A right run's element moves ahead of the left elements after it.
            merged = np.empty_like(order)
            merged[place] = order
            order, width = merged, width * 2
        return order


def repeated_windows(
    stretches: list[bytes], before: np.ndarray, group: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray]:
    """``stretch, window``: windows, counted from their stretch's start, whose bytes are
    also a window of another stretch of the group at the same distance from the anchor,
    which is ``before`` bytes into the stretch."""
    size = np.array([len(s) for s in stretches], np.int64)
    base = np.cumsum(size) - size
    data = np.frombuffer(b"".join(stretches), np.uint8)
    suffixes = Suffixes(data, base + before, base + size, group)
    order = suffixes.sorted()
    extension = suffixes.common(order[:-1], order[1:])
    extension[group[order[:-1]] != group[order[1:]]] = -1
    found_at, found_window = [], []
    windows = size - length + 1
    for distance in range(int(before.max()) + 1 if len(before) else 0):
        window = before[order] - distance
        takes_part = np.flatnonzero((window >= 0) & (window < windows[order]))
        if len(takes_part) < 2:
            continue
        run = np.r_[0, np.cumsum(extension < length - distance)][takes_part]
        who = order[takes_part]
        start = base[who] + before[who]
        left = suffixes.prefix.raw(start - distance, start)
        by = np.lexsort((left, run))
        same = (run[by][1:] == run[by][:-1]) & (left[by][1:] == left[by][:-1])
        pairs = np.flatnonzero(same)
        if not len(pairs):
            continue
        a, b = who[by][pairs], who[by][pairs + 1]
        if _equal(data, base[a] + before[a] - distance, base[b] + before[b] - distance, length):
            hit = np.unique(np.r_[a, b])
        else:
            hit = _settle(data, who, base + before - distance, group, length)
        found_at.append(hit)
        found_window.append(before[hit] - distance)
    if not found_at:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_at), np.concatenate(found_window)


def _equal(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: int, block: int = 4096) -> bool:
    reach = np.arange(length)
    return all(
        np.array_equal(data[a[i : i + block, None] + reach], data[b[i : i + block, None] + reach])
        for i in range(0, len(a), block)
    )


def _settle(data: np.ndarray, who: np.ndarray, start: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    seen: dict[tuple[int, bytes], list[int]] = {}
    for x in who:
        seen.setdefault((int(group[x]), data[start[x] : start[x] + length].tobytes()), []).append(int(x))
    return np.array([x for xs in seen.values() if len(xs) > 1 for x in xs], np.int64)


def _few(work: Callable[[pa.RecordBatch], pa.RecordBatch], rows: int = 1000) -> Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]:
    """``work`` on some rows at a time, so that few texts are unpacked at once."""
    return lambda batch: (work(batch.slice(low, rows)) for low in range(0, batch.num_rows, rows))


def _stretches(rows: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The wanted stretches with their bytes, cut from the texts where they are."""
    asked = wanted.groupBy("doc_id", "text_hash").agg(
        F.collect_list(F.struct("at", "first", "last", "anchor", "single", "hot")).alias("asked")
    )
    packed = packed_texts(rows)
    asked = asked.withColumnRenamed("doc_id", "_doc").withColumnRenamed("text_hash", "_hash")
    joined = packed.join(
        asked, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("text_hash") == F.col("_hash"))
    ).select("doc_id", "text_hash", "packed", "size", "asked")

    def make():
        codec = pa.Codec("zstd")

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            out: list[dict] = []
            for row in batch.to_pylist():
                body = codec.decompress(row["packed"], row["size"], asbytes=True) if row["size"] else b""
                for x in row["asked"]:
                    x["bytes"] = body[x["first"] : x["last"] + length]
                    x["doc_id"], x["text_hash"] = row["doc_id"], row["text_hash"]
                    out.append(x)
            return pa.RecordBatch.from_pylist(out, schema=shape)

        shape = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("at", pa.int32()), ("first", pa.int32()), ("anchor", pa.int64()), ("single", pa.bool_()), ("hot", pa.bool_()), ("bytes", pa.binary())])
        return _few(work)

    return by_batches(
        joined, make,
        "doc_id long, text_hash long, at int, first int, anchor long, single boolean, hot boolean, bytes binary",
    )


def packed_texts(rows: DataFrame) -> DataFrame:
    """Texts compressed, for the shuffles that carry them."""

    def make():
        codec = pa.Codec("zstd")

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            bodies = [(t or "").encode() for t in batch["text"].to_pylist()]
            packed = pa.array([codec.compress(b, asbytes=True) for b in bodies], pa.binary())
            size = pa.array([len(b) for b in bodies], pa.int64())
            rest = [n for n in batch.schema.names if n != "text"]
            return pa.record_batch([*(batch[n] for n in rest), packed, size], [*rest, "packed", "size"])

        return _few(work)

    return by_batches(rows, make, schema_of(rows.drop("text"), "packed binary, size long"))


_RANGES = "doc_id long, text_hash long, begin int, until int"


def _merged(
    doc: pa.Array, text: pa.Array, first: np.ndarray, who: np.ndarray, window: np.ndarray, length: int
) -> pa.RecordBatch:
    """Ranges of bytes under windows of the rows ``who``, neighbours merged."""
    order = np.lexsort((window, who))
    who, window = who[order], window[order]
    new = np.r_[True, (who[1:] != who[:-1]) | (window[1:] > window[:-1] + length)] if len(who) else np.zeros(0, bool)
    opens = np.flatnonzero(new)
    closes = np.r_[opens[1:], len(who)] - 1 if len(opens) else opens
    rows = who[opens]
    begin = (first[rows] + window[opens]).astype(np.int32)
    until = (first[rows] + window[closes] + length).astype(np.int32)
    at = pa.array(rows)
    return pa.record_batch([doc.take(at), text.take(at), pa.array(begin), pa.array(until)], ["doc_id", "text_hash", "begin", "until"])


def _sorted_ranges(stretches: DataFrame, length: int) -> DataFrame:
    """Repeats among the stretches of each anchor, by suffix sort in the tasks."""

    def run(batches):
        held: list[pa.RecordBatch] = []
        rows, last = 0, None

        def finish(table: pa.Table) -> pa.RecordBatch:
            table = table.combine_chunks()
            anchor = table["anchor"].to_numpy()
            group = np.r_[0, np.cumsum(anchor[1:] != anchor[:-1])]
            first = table["first"].to_numpy().astype(np.int64)
            before = table["at"].to_numpy().astype(np.int64) - first
            who, window = repeated_windows(table["bytes"].to_pylist(), before, group, length)
            keep = table["single"].to_numpy()[who]  # the others have gone already
            doc, text = (table[c].combine_chunks() for c in ("doc_id", "text_hash"))
            return _merged(doc, text, first, who[keep], window[keep], length)

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows += batch.num_rows
            if rows >= 8192:  # whole anchors only; the last one may go on
                table = pa.Table.from_batches(held)
                anchor = table["anchor"].to_numpy()
                whole = int(np.flatnonzero(anchor != anchor[-1])[-1]) + 1 if (anchor != anchor[-1]).any() else 0
                if whole:
                    yield finish(table.slice(0, whole))
                held = table.slice(whole).to_batches()
                rows = table.num_rows - whole
        if held:
            yield finish(pa.Table.from_batches(held))

    return stretches.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, _RANGES)


def _counted_ranges(stretches: DataFrame, length: int) -> DataFrame:
    """Repeats among the stretches of hot anchors, by counting windows."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
            bodies = batch["bytes"].to_pylist()
            size = np.array([len(b) for b in bodies], np.int64)
            base = np.cumsum(size) - size
            prefix = Prefixes(np.frombuffer(b"".join(bodies), np.uint8))
            many = size - length + 1
            who = np.repeat(np.arange(len(bodies)), many)
            window = np.arange(len(who)) - np.repeat(np.cumsum(many) - many, many)
            start = base[who] + window
            one = prefix.span(start, start + length)
            half = length // 2
            two = mix(prefix.span(start, start + half) ^ mix(prefix.span(start + half, start + length)))
            at = pa.array(who)
            begin = batch["first"].to_numpy()[who] + window.astype(np.int32)
            columns = [batch["doc_id"].take(at), batch["text_hash"].take(at), batch["single"].take(at), pa.array(begin), pa.array(one.view(np.int64)), pa.array(two.view(np.int64))]
            return pa.record_batch(columns, ["doc_id", "text_hash", "single", "begin", "one", "two"])

        return work

    windows = by_batch(stretches, make, "doc_id long, text_hash long, single boolean, begin int, one long, two long")
    often = windows.groupBy("one", "two").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("one", "two")
    return windows.where("single").join(often, ["one", "two"]).select(
        "doc_id", "text_hash", "begin", (F.col("begin") + length).cast("int").alias("until")
    )


def repeated_ranges(rows: DataFrame, *, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """``doc_id, text_hash, begin, until``: what repeats, in ranges that may overlap."""
    found = stored(anchor_rows(rows, length))
    often = (
        found.groupBy("anchor")
        .agg(F.count(F.lit(1)).alias("n"), (F.min("stretch") != F.max("stretch")).alias("mixed"))
        .where("n > 1")
        .select("anchor", "mixed")
    )
    again = stored(found.join(often, "anchor"))
    alike = again.where("NOT mixed")
    mixed = again.where("mixed")
    place = F.struct("doc_id", "text_hash", "at", "first", "last")
    kinds = mixed.groupBy("anchor", "stretch").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("place"))
    kinds = stored(kinds.select("anchor", "stretch", "n", "place.*"))
    twice = mixed.join(kinds.where("n > 1").select("anchor", "stretch"), ["anchor", "stretch"])
    hot = kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).select(
        "anchor", (F.col("kinds") > group).alias("hot")
    )
    wanted = kinds.join(hot, "anchor").withColumn("single", F.col("n") == 1)
    stretches = stored(_stretches(rows, wanted, length))
    whole = alike.select(place_columns := ["doc_id", "text_hash", "first", "last"]).unionByName(
        twice.select(place_columns)
    )
    return (
        whole.select("doc_id", "text_hash", F.col("first").alias("begin"), (F.col("last") + length).cast("int").alias("until"))
        .unionByName(_sorted_ranges(stretches.where("NOT hot"), length))
        .unionByName(_counted_ranges(stretches.where("hot"), length))
    )


def cut_repeats(docs: DataFrame, *, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """``row`` with all columns of the input but the text, ``n_bytes, n_removed, n_spans``,
    and ``kept``: the remaining bytes of the text as they are."""
    rows = _rows(docs)
    gone = repeated_ranges(rows, length=length, group=group).groupBy(
        F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash")
    ).agg(F.collect_list(F.struct("begin", "until")).alias("_gone"))
    held = packed_texts(docs.select(
        F.struct(*[docs[c] for c in docs.columns if c != "text"]).alias("row"),
        F.col("doc_id").cast("long").alias("_id"), F.xxhash64("text").alias("_text"),
        F.col("text").isNull().alias("_null"), "text",
    ))
    joined = held.join(
        gone, F.col("_id").eqNullSafe(F.col("_doc")) & (F.col("_text") == F.col("_hash")), "left"
    ).select("row", "_null", "packed", "size", "_gone")

    def make():
        codec = pa.Codec("zstd")

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            sizes, removed, spans, kept = [], [], [], []
            for packed, size, gone, null in zip(
                *(batch[c].to_pylist() for c in ("packed", "size", "_gone", "_null")), strict=True
            ):
                body = codec.decompress(packed, size, asbytes=True) if size else b""
                parts, at, runs, lost = [], 0, 0, 0
                until = -1
                for begin, end in sorted((x["begin"], x["until"]) for x in gone or ()):
                    if begin > until:
                        parts.append(body[max(at, 0) : begin])
                        runs += 1
                        lost += end - begin
                    else:
                        lost += max(0, end - until)
                    until = max(until, end)
                    at = until
                parts.append(body[at:])
                sizes.append(size), removed.append(lost), spans.append(runs)
                kept.append(None if null else b"".join(parts))
            columns = [batch["row"], *(pa.array(c, pa.int64()) for c in (sizes, removed, spans))]
            return pa.record_batch([*columns, pa.array(kept, pa.binary())], ["row", "n_bytes", "n_removed", "n_spans", "kept"])

        return _few(work)

    return by_batches(joined, make, schema_of(joined.select("row"), "n_bytes long, n_removed long, n_spans long, kept binary"))


def keep_unrepeated(docs: DataFrame, *, length: int = LENGTH) -> DataFrame:
    """The columns of ``docs``, texts without what repeats. Characters cut in half at the
    edge of a repeat are replaced by U+FFFD."""
    left = cut_repeats(docs, length=length)
    others = {c: F.col("row").getField(c) for c in docs.columns if c != "text"}
    return left.select([others.get(c, kept_text()).alias(c) for c in docs.columns])


def kept_text() -> Column:
    """The remaining bytes as text. Broken characters are replaced, whatever the session
    thinks of them."""
    return F.make_valid_utf8(F.col("kept").cast("string"))
