"""Sampled SentencePiece segmentations without replacement, and their decoding.

A text's lattice has the vocabulary's pieces as edges; a path from its start to its
end is a segmentation, and its probability is the product of its pieces' weights, over
all paths. Pieces never cross a word's beginning or a line's end, so that lattices are built
once for each distinct word of a batch. A character that is no piece is spelt in bytes.

Samples come in the order of Gumbel-perturbed log probabilities, largest first. The
largest is a fresh sample. What is left of the space falls apart into regions, one for each
place where a path can first leave the sampled one; the bound of a region, its largest
perturbed value, is a Gumbel variable cut off at the value of the sample it leaves. The
search takes the region with the largest bound next, draws a path in it and splits it again
(A* with perturbed bounds). The first bound not taken is the threshold
for inclusion: a segmentation of log probability p has the score 1 - exp(-exp(p - bound)).

Random numbers are hashes of the row's key, the sample and the place in the text, so that a
row is sampled alike wherever and whenever it is.

The vocabulary's scores are ranks; a piece of rank r weighs (r + ``OFFSET``) ** -``alpha``.
Rows whose text is NULL are read as empty: their only segmentation has the one piece that
stands for the leading space. Equal rows with equal keys get equal samples. A text with
fewer than ``k`` segmentations gets them all, with score 1. An empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_batches
from .hashing import mix, mix_one

K = 2
#: Characters that are segmented at a time.
PART = 1 << 20
ALPHA, OFFSET = 1.0, 10.0
_SPACE = 0x2581
_SPELT = 0xFFFFFFFF  # the space's sign itself, where a text has it
_STEP = np.uint64(0x9E3779B97F4A7C15)
_UNIT = re.compile(r" *[^ \n]+|\n| +")


class Vocabulary:
    """Pieces of a model by length, as hashes of their characters, and what ids mean."""

    def __init__(self, model: str, alpha: float = ALPHA) -> None:
        import sentencepiece

        held = sentencepiece.SentencePieceProcessor(model_file=model)
        n = held.get_piece_size()
        self.bytes = np.zeros(256, np.int64)
        self.surface: list[bytes] = [b""] * n
        rank = np.zeros(n)
        by_length: dict[int, list[tuple[str, int]]] = {}
        for i in range(n):
            piece = held.id_to_piece(i)
            if held.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.surface[i] = bytes([int(piece[3:5], 16)])
            elif not (held.is_control(i) or held.is_unknown(i) or held.is_unused(i)):
                self.surface[i] = piece.replace("▁", " ").encode()
                by_length.setdefault(len(piece), []).append((piece, i))
            rank[i] = min(max(-held.get_score(i), 0.0), float(n))
        weight = -alpha * np.log(rank + OFFSET)
        self.weight = weight - np.logaddexp.reduce(weight)
        self.byte_weight = float(-alpha * np.log(n + OFFSET) - np.logaddexp.reduce(weight))
        # Keys of all beginnings of pieces by length, and the piece that one is, or -1.
        begun: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for size, pieces in by_length.items():
            keys, none = np.zeros(len(pieces), np.uint64), np.full(len(pieces), -1)
            letters = np.array([[ord(c) for c in p] for p, _ in pieces], np.uint64)
            for k in range(1, size + 1):
                keys = _longer(keys, letters[:, k - 1])
                whole = np.array([i for _, i in pieces]) if k == size else none
                begun.setdefault(k, []).append((keys, whole))
        self.beginnings: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for size, parts in begun.items():
            keys, whole = (np.concatenate(c) for c in zip(*parts, strict=True))
            # A piece stands before the beginnings that are spelt alike.
            order = np.lexsort((-whole, keys))
            keys, whole = keys[order], whole[order]
            first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            self.beginnings[size] = keys[first], whole[first]
        # Where the keys with the same leading bits start, some four places a key.
        self.slots: dict[int, tuple[np.uint64, np.ndarray]] = {}
        for size, (keys, _) in self.beginnings.items():
            bits = len(keys).bit_length() + 2
            heads = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
            self.slots[size] = np.uint64(64 - bits), np.searchsorted(keys, heads)
        self.spelling = pa.array(self.surface, pa.binary())
        self.surface_size = np.array([len(x) for x in self.surface], np.int64)

    def look_up(self, length: int, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which keys are beginnings of that length, and for those the piece that one is,
        or -1."""
        keys, ids = self.beginnings[length]
        shift, starts = self.slots[length]
        last = len(keys) - 1
        place = np.minimum(starts[key >> shift], last)
        behind = np.flatnonzero((keys[place] < key) & (place < last))
        while len(behind):
            place[behind] += 1
            at = place[behind]
            behind = behind[(keys[at] < key[behind]) & (at < last)]
        begins = keys[place] == key
        return begins, ids[place[begins]]

    def spelt(self, ids: np.ndarray) -> memoryview:
        """The bytes of the pieces, one after another."""
        held = self.spelling.take(pa.array(ids))
        return memoryview(held.buffers()[2]).cast("B")[: int(self.surface_size[ids].sum())]

    def decode(self, ids: list[int]) -> str:
        """The text; the space that stands before every text goes."""
        return bytes(self.spelt(np.array(ids, np.int64))[1:]).decode()


def _longer(key: np.ndarray, letter: np.ndarray) -> np.ndarray:
    return (key ^ (letter + np.uint64(1))) * _STEP + np.uint64(0x7F4A7C15)


@lru_cache(maxsize=2)
def vocabulary(model: str, alpha: float) -> Vocabulary:
    return Vocabulary(model, alpha)


class Lattices:
    """Edges of the lattices of distinct units, one after another. A node is a place
    before a character, or a unit's end."""

    def __init__(self, units: list[str], vocab: Vocabulary) -> None:
        size = np.fromiter(map(len, units), np.int64, len(units))
        code = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32).astype(np.uint64)
        code = np.where(code == _SPACE, np.uint64(_SPELT), np.where(code == 32, np.uint64(_SPACE), code))
        n = len(code)
        unit = np.repeat(np.arange(len(units)), size)
        char_end = np.cumsum(size)[unit]
        self.start = np.cumsum(size) - size + np.arange(len(units))
        self.size = size
        at, key = np.arange(n), np.zeros(n, np.uint64)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        single = np.zeros(n, bool)
        for length in range(1, max(vocab.beginnings, default=0) + 1):
            fits = at + length <= char_end[at]
            at, key = at[fits], key[fits]
            if not len(at):
                break
            key = _longer(key, code[at + length - 1])
            # What no piece begins with is not looked at again.
            begins, ids = vocab.look_up(length, key)
            at, key = at[begins], key[begins]
            hit = ids >= 0
            found.append((at[hit], np.full(hit.sum(), length), ids[hit]))
            if length == 1:
                single[at[hit]] = True
        spelt = np.flatnonzero(~single)
        found.append((spelt, np.ones(len(spelt), np.int64), -1 - code[spelt].astype(np.int64)))
        # Edges by their node, shorter ones first.
        held = np.zeros(n, np.int64)
        ranks = []
        for source, _, _ in found:
            ranks.append(held[source])
            held[source] += 1
        begins = np.cumsum(held) - held
        total = int(held.sum())
        length, piece = np.empty(total, np.int64), np.empty(total, np.int64)
        for (own, size_of, ids), rank in zip(found, ranks, strict=True):
            to = begins[own] + rank
            length[to], piece[to] = size_of, ids
        weight = vocab.weight[np.maximum(piece, 0)]
        own = code[spelt]
        many = 1 + (own > 0x7F).astype(int) + (own > 0x7FF) + (own > 0xFFFF)
        weight[begins[spelt] + ranks[-1]] = vocab.byte_weight * np.where(own == _SPELT, 3, many)
        # From the ends back: what lies behind a node is known before it is needed.
        left = char_end - np.arange(n)
        kind = np.uint16 if left.max(initial=0) < 1 << 16 else np.int64
        left = np.repeat(left.astype(kind), held)
        back = np.argsort(left, kind="stable")
        every, every_length = np.repeat(np.arange(n) + unit, held), length
        left, node, length, weight = left[back], every[back], length[back], weight[back]
        beta = np.zeros(n + len(units))
        value = np.empty(len(node))
        cut = np.flatnonzero(np.r_[True, left[1:] != left[:-1]]) if len(left) else np.zeros(0, np.int64)
        for low, high in zip(cut, [*cut[1:], len(left)], strict=True):
            own = node[low:high]
            v = weight[low:high] + beta[own + length[low:high]]
            first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            top = np.maximum.reduceat(v, first)
            many_of = np.diff(np.r_[first, len(own)])
            sums = np.add.reduceat(np.exp(v - np.repeat(top, many_of)), first)
            beta[own[first]] = top + np.log(sums)
            value[low:high] = v
        # A node's likeliest edges come first, so that few are looked at.
        log_p = np.empty(total)
        log_p[back] = value - beta[node]
        order = np.argsort((every << 10) + np.minimum(-16 * log_p, 1023).astype(np.int64), kind="stable")
        self.node, self.length, self.piece, self.log_p = every[order], every_length[order], piece[order], log_p[order]
        first = np.flatnonzero(np.r_[True, self.node[1:] != self.node[:-1]]) if len(node) else np.zeros(0, np.int64)
        count = np.diff(np.r_[first, len(node)])
        self.within = np.exp(self.log_p)
        for k in range(1, int(count.max(initial=0))):
            at = first[count > k] + k
            self.within[at] += self.within[at - 1]
        # A node's last edge ends at 1, whatever the rounding.
        self.within[first + count - 1] = 1.0
        self.first = np.zeros(n + len(units) + 1, np.int64)
        self.first[self.node[first]] = first
        self.count = np.zeros(n + len(units), np.int64)
        self.count[self.node[first]] = count

    def draw_one(self, node: int, uniform: float) -> int:
        edge = int(self.first[node])
        while uniform > self.within[edge]:
            edge += 1
        return edge

    def draw(self, node: np.ndarray, uniform: np.ndarray) -> np.ndarray:
        """An edge out of each node, by its probability."""
        edge = self.first[node]
        going = np.flatnonzero(uniform > self.within[edge])
        while len(going):
            edge[going] += 1
            going = going[uniform[going] > self.within[edge[going]]]
        return edge


def _uniform(key: np.ndarray, place: np.ndarray, salt: int) -> np.ndarray:
    x = mix(key + place.astype(np.uint64) * _STEP + np.uint64(salt * 0x51ED2701 & 0xFFFFFFFF))
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def _one_uniform(key: int, place: int, salt: int) -> float:
    """``_uniform`` of one place."""
    x = (key + place * int(_STEP) + (salt * 0x51ED2701 & 0xFFFFFFFF)) & 0xFFFFFFFFFFFFFFFF
    return ((mix_one(x) >> 11) + 0.5) * 2.0**-53


def fresh_paths(
    lattices: Lattices, unit: np.ndarray, place: np.ndarray, key: np.ndarray, salt: int
) -> tuple[np.ndarray, np.ndarray]:
    """A sampled path through each unit: its edges, and where each unit's end. ``place``
    is the unit's place in its text and ``key`` its row's."""
    going = np.arange(len(unit))
    node = lattices.start[unit]
    end = node + lattices.size[unit]
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    while len(going):
        offset = place[going] + node - lattices.start[unit[going]]
        edge = lattices.draw(node, _uniform(key[going], offset, salt))
        steps.append((going, edge))
        node = node + lattices.length[edge]
        more = node < end[going]
        going, node = going[more], node[more]
    many = np.zeros(len(unit), np.int64)
    for held, _ in steps:
        many[held] += 1
    ends = np.cumsum(many)
    begins = ends - many
    edges = np.empty(int(ends[-1]) if len(ends) else 0, np.int64)
    for k, (held, edge) in enumerate(steps):
        edges[begins[held] + k] = edge
    return edges, ends


class Fresh:
    """Fresh paths through some units of texts: their edges and the places of those, where
    each unit's end, and for each edge the logarithms of an exponential variable and of the
    share of its node's probability that is not its own."""

    def __init__(self, lattices: Lattices, unit: np.ndarray, place: np.ndarray, key: np.ndarray, salt: int) -> None:
        self.edges, self.ends = fresh_paths(lattices, unit, place, key, salt)
        many = np.diff(np.r_[0, self.ends])
        length = lattices.length[self.edges]
        at = np.cumsum(length) - length
        self.place = at + np.repeat(place - at[self.ends - many], many)
        self.waits, self.rest = _leaving(lattices, self.edges, self.place, np.repeat(key, many), salt)

    def of(self, low: int, high: int) -> tuple[np.ndarray, ...]:
        """Those of the units from ``low`` to ``high``."""
        x, y = (int(self.ends[low - 1]) if low else 0), int(self.ends[high - 1])
        return self.edges[x:y], self.place[x:y], self.waits[x:y], self.rest[x:y], self.ends[low:high] - x


def _leaving(
    lattices: Lattices, edges: np.ndarray, place: np.ndarray, key: np.ndarray, salt: int
) -> tuple[np.ndarray, np.ndarray]:
    log_p = lattices.log_p[edges]
    rest = -np.expm1(np.minimum(log_p, 0.0))
    rest[lattices.count[lattices.node[edges]] == 1] = 0.0
    with np.errstate(divide="ignore"):
        return np.log(-np.log(_uniform(key, place, 1000 + salt))), np.log(rest)


class _Path:
    """A sample: its edges, their log probabilities so far, and the regions of what leaves
    it from ``since`` on; ``taken`` holds other edges gone from the first place.

    A region is met after a waiting time: an exponential variable over its mass. The sooner,
    the larger its bound."""

    def __init__(self, lattices: Lattices, edges: np.ndarray, place: np.ndarray, waits: np.ndarray, rest: np.ndarray, value: float, since: int, taken: list[int]) -> None:
        """``waits`` and ``rest`` are those of the edges from ``since`` on."""
        self.edges, self.place, self.value, self.taken, self.since = edges, place, value, taken, since
        log_p = lattices.log_p[edges]
        self.so_far = np.cumsum(log_p)
        mass = (self.so_far - log_p)[since:] + rest
        if taken:
            gone = float(np.exp(lattices.log_p[[*taken, edges[since]]]).sum())
            left = 0.0 if len(taken) + 1 >= lattices.count[lattices.node[edges[since]]] else max(1.0 - gone, 0.0)
            mass[0] = self.so_far[since] - log_p[since] + (np.log(left) if left else -np.inf)
        self.waits = waits - mass
        self.waits[np.isneginf(mass)] = np.inf
        self._find()

    def _find(self) -> None:
        """The region that is met first, ``at`` places after ``since``, and its bound: the
        largest perturbed value in it, cut off at the path's own."""
        self.at = int(np.argmin(self.waits))
        soonest = self.waits[self.at]
        self.bound = -np.inf if soonest == np.inf else float(-np.logaddexp(-self.value, soonest))

    def use(self) -> None:
        """The region found has been gone into."""
        self.waits[self.at] = np.inf
        self._find()

    @property
    def log_prob(self) -> float:
        return float(self.so_far[-1])


def sample_text(
    lattices: Lattices, key: np.uint64, fresh: list[tuple[np.ndarray, ...]],
    unit_place: np.ndarray, unit: np.ndarray, k: int,
) -> tuple[list[_Path], float]:
    """The best ``k`` samples of one text and the threshold. ``fresh`` has for each
    sample a fresh path as ``Fresh.of`` gives it."""
    edges, place, waits, rest, _ = fresh[0]
    gumbel = float(-np.log(-np.log(_one_uniform(int(key), 0, 999))))
    paths = [_Path(lattices, edges, place, waits, rest, gumbel, 0, [])]
    while True:
        best = max(paths, key=lambda p: p.bound)
        at, value = best.at, best.bound
        if len(paths) == k or value == -np.inf:
            return paths, value
        best.use()
        s = len(paths)
        leave = best.since + at
        taken = [*(best.taken if at == 0 else []), int(best.edges[leave])]
        # Another edge from there, then on to the unit's end, then fresh.
        node, where = int(lattices.node[best.edges[leave]]), int(best.place[leave])
        first = int(lattices.first[node])
        others = [e for e in range(first, first + int(lattices.count[node])) if e not in taken]
        p = np.cumsum(np.exp(lattices.log_p[others]))
        turn = _one_uniform(int(key), where, 2000 + s) * p[-1]
        own = [others[min(int(np.searchsorted(p, turn, side="right")), len(others) - 1)]]
        own_place = [where]
        u = int(np.searchsorted(unit_place, where, side="right")) - 1
        end = int(unit_place[u] + lattices.size[unit[u]])
        while own_place[-1] + lattices.length[own[-1]] < end:
            where = int(own_place[-1] + lattices.length[own[-1]])
            node = int(lattices.node[own[-1]] + lattices.length[own[-1]])
            own.append(lattices.draw_one(node, _one_uniform(int(key), where, s)))
            own_place.append(where)
        edges, place, waits, rest, ends = fresh[s]
        on = int(ends[u])
        own, own_place = np.array(own, np.int64), np.array(own_place, np.int64)
        own_waits, own_rest = _leaving(lattices, own, own_place, np.full(len(own), key), s)
        paths.append(
            _Path(
                lattices,
                np.concatenate([best.edges[:leave], own, edges[on:]]),
                np.concatenate([best.place[:leave], own_place, place[on:]]),
                np.concatenate([own_waits, waits[on:]]),
                np.concatenate([own_rest, rest[on:]]),
                value, leave, taken,
            )
        )


def ids_of(lattices: Lattices, edges: np.ndarray, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of paths and how many each edge has; characters that are no piece are spelt in
    bytes."""
    piece = lattices.piece[edges]
    many = np.ones(len(piece), np.int64)
    spelt = np.flatnonzero(piece < 0)
    if not len(spelt):
        return piece, many
    letters, which = np.unique(piece[spelt], return_inverse=True)
    bodies = [chr(_SPACE if -1 - p == _SPELT else -1 - p).encode() for p in letters.tolist()]
    size = np.array([len(b) for b in bodies])
    own = vocab.bytes[np.frombuffer(b"".join(b.ljust(4, b"\0") for b in bodies), np.uint8)].reshape(-1, 4)
    many[spelt] = size[which]
    at = (np.cumsum(many) - many)[spelt]
    out = np.repeat(piece, many)
    for k in range(int(size.max())):
        longer = size[which] > k
        out[at[longer] + k] = own[which[longer], k]
    return out, many


def _parts(texts: list[str], limit: int):
    low, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t)
        if held > limit:
            yield low, i + 1
            low, held = i + 1, 0
    if low < len(texts):
        yield low, len(texts)


class Samples:
    """Samples of some texts in turn: the row of each and its sample number from 0, log
    probability, perturbed value and the row's threshold; ids of sample i are
    ``ids[ends[i - 1]:ends[i]]``."""

    def __init__(self, lattices: Lattices, vocab: Vocabulary, found: list[tuple[list[_Path], float]], low: int) -> None:
        paths = [p for held, _ in found for p in held]
        many = np.array([len(held) for held, _ in found], np.int64)
        self.row = low + np.repeat(np.arange(len(found)), many)
        self.sample = np.arange(len(paths)) - np.repeat(np.cumsum(many) - many, many)
        self.log_prob = np.array([p.log_prob for p in paths])
        self.value = np.array([p.value for p in paths])
        self.threshold = np.repeat(np.array([t for _, t in found]), many)
        self.ids, spelt = ids_of(lattices, np.concatenate([p.edges for p in paths]), vocab)
        edges = np.cumsum([len(p.edges) for p in paths])
        self.ends = np.cumsum(spelt)[edges - 1]

    def ids_in_turn(self) -> Iterator[np.ndarray]:
        begin = 0
        for end in self.ends.tolist():
            yield self.ids[begin:end]
            begin = end


def sample_parts(texts: list[str], keys: np.ndarray, vocab: Vocabulary, k: int, limit: int = PART) -> Iterator[Samples]:
    """Samples of all texts, a part of them at a time."""
    for low, high in _parts(texts, limit):
        split = [_UNIT.findall(" " + t) for t in texts[low:high]]
        many = np.array([len(u) for u in split], np.int64)
        index = pa.array(chain.from_iterable(split), pa.string(), size=int(many.sum())).dictionary_encode()
        del split
        lattices = Lattices(index.dictionary.to_numpy(zero_copy_only=False).tolist(), vocab)
        unit = index.indices.to_numpy().astype(np.int64)
        bounds = np.r_[0, np.cumsum(many)]
        place = np.cumsum(lattices.size[unit]) - lattices.size[unit]
        place -= np.repeat(place[bounds[:-1]], many)
        key = np.repeat(keys[low:high], many)
        fresh = [Fresh(lattices, unit, place, key, s) for s in range(k)]
        found = []
        for i in range(high - low):
            a, b = int(bounds[i]), int(bounds[i + 1])
            own = [f.of(a, b) for f in fresh]
            found.append(sample_text(lattices, keys[low + i], own, place[a:b], unit[a:b], k))
        yield Samples(lattices, vocab, found, low)


def sample_batch(texts: list[str], keys: np.ndarray, vocab: Vocabulary, k: int, limit: int = PART):
    """For each text in turn: ``(ids, log probability, perturbed value)`` of its samples,
    and the threshold."""
    for part in sample_parts(texts, keys, vocab, k, limit):
        held: list[tuple[np.ndarray, float, float]] = []
        last = len(part.row) - 1
        for i, ids in enumerate(part.ids_in_turn()):
            held.append((ids, float(part.log_prob[i]), float(part.value[i])))
            if i == last or part.row[i + 1] != part.row[i]:
                yield held, float(part.threshold[i])
                held = []


def segmentations(
    docs: DataFrame, model: str, *, key: Column | None = None, k: int = K, alpha: float = ALPHA, ids: bool = True
) -> DataFrame:
    """A row per row and sample: ``doc_id, sample`` from 1, ``n_pieces, log_prob,
    perturbed, inclusion, ids_crc32, restored`` (whether decoding gives the text back),
    and ``ids`` if asked for. ``key`` seeds a row; it is the id unless given."""
    seed = F.xxhash64(F.col("doc_id") if key is None else key)
    rows = docs.select("doc_id", seed.alias("key"), "text")

    def make():
        vocab = vocabulary(model, alpha)

        def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            texts = [t or "" for t in batch["text"].to_pylist()]
            keys = batch["key"].to_numpy().view(np.uint64)
            for part in sample_parts(texts, keys, vocab, k):
                spelt = vocab.spelt(part.ids)
                size = np.cumsum(vocab.surface_size[part.ids])[part.ends - 1].tolist()
                restored, crcs, begin = [], [], 0
                for own, row, end in zip(part.ids_in_turn(), part.row.tolist(), size, strict=True):
                    # The space that stands before every text goes.
                    restored.append(spelt[begin + 1 : end] == texts[row].encode())
                    crcs.append(zlib.crc32(own.astype("<u4").tobytes()))
                    begin = end
                with np.errstate(over="ignore"):
                    score = -np.expm1(-np.exp(np.minimum(part.log_prob - part.threshold, 700.0)))
                ends = np.r_[0, part.ends]
                columns = [
                    batch["doc_id"].take(pa.array(part.row)),
                    pa.array((part.sample + 1).astype(np.int32)),
                    pa.array(np.diff(ends)),
                    pa.array(part.log_prob),
                    pa.array(part.value),
                    pa.array(np.where(np.isneginf(part.threshold), 1.0, score)),
                    pa.array(crcs, pa.int64()),
                    pa.array(restored, pa.bool_()),
                ]
                names = ["doc_id", "sample", "n_pieces", "log_prob", "perturbed", "inclusion", "ids_crc32", "restored"]
                if ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(part.ids.astype(np.int32))))
                    names.append("ids")
                yield pa.record_batch(columns, names)

        return work

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, sample int, n_pieces long, log_prob double, perturbed double, inclusion double, ids_crc32 long, restored boolean"
    return by_batches(rows, make, schema + (", ids array<int>" if ids else ""))
