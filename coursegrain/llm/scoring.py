"""Scores of texts by a causal self-attention model over subword ids.

A text is its words in lower case (A-Z), each encoded with a space before it, then an
end. A word's probability is a mixture of two:

* *Attention.* One layer over a window of subwords predicts the class of the next one; a
  class shares its probability among its subwords, at the start of a word and inside it, by
  their counts in the corpus. A word is its subwords and that another word starts after
  them, given that one starts before: so the words' probabilities sum to 1. Classes group
  subwords with like left neighbours.
* *Counts.* (c+1)/(N+V+1) of the word itself, as in the base score.

How much each contributes is read off the attention layer at the word's start. Windows
overlap: each covers ``SPAN`` subwords and scores the last ``STRIDE``, so that every
subword is scored once, with at least ``SPAN - STRIDE`` before it where there are as many.

All training texts teach all parts. Words and subwords are counted in Spark. Neighbours of
subwords and the layer's weights are vectors of a fixed length: each task makes its own from
all of its texts (the layer by Adam in numpy, starting from the same weights), and they are
added in a tree of ``FAN``. A subword's vector is averaged over the tasks by how often each
met it. So the layer depends a little on how the table is split, not on its size. When the
mixture is learnt, words that are not common count as often as they do on average.

Words that make up at least one in ``COMMON`` of the corpus, so at most ``COMMON`` words,
are sent to every task; occurrences of others meet their counts in a join.

Edge cases: NULL and empty texts are an end alone. Without training texts all counts are 0
and the layer keeps its random start; the base is then log10(1) for each token.
Repeated rows are scored alike, NULL ids fall in the fold of the empty text. An empty table
gives no rows. Only the two named columns are read.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_batch, crc_remainder, discard, stored
from .packing import _Words as Words

SPAN, STRIDE = 32, 16
SIZE, CLASSES = 16, 64
COMMON = 500_000
#: Bytes of text whose words are coded at once.
PART = 3_000_000
#: Vectors added by one task of the tree.
FAN = 16
#: Subwords that a task gathers before it cuts them in windows.
CHUNK = 65_536
FOLDS, HELD = 7, 2
#: Places of vocabulary: ids of the tokenizer, of which the last is the end.
VOCABULARY = 50_257
END = VOCABULARY - 1


def words_of(text: str | None) -> list[bytes]:
    """Bytes lower() and split() know ASCII only, as the contract asks."""
    return (text or "").encode().lower().split()


def parts_of(batch: pa.RecordBatch, column: str, size: int) -> Iterator[pa.RecordBatch]:
    """The rows in turn, some ``size`` bytes of the column at a time."""
    length = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False)
    number = np.cumsum(length, dtype=np.int64) // size
    cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), batch.num_rows]
    for low, high in itertools.pairwise(cuts):
        yield batch.slice(low, high - low)


def coded_words(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """``words_of`` all texts, one after another, and how many each has. Arrow's white space
    is that of ASCII too."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words, begin = lists.flatten(), lists.offsets.to_numpy()
    # White space at the ends of a text leaves empty words there.
    real = pc.not_equal(words, "")
    many = np.add.reduceat(real.to_numpy(zero_copy_only=False), begin[:-1] - begin[0], dtype=np.int64)
    return words.filter(real).dictionary_encode(), many


def word_counts(texts: DataFrame) -> DataFrame:
    """``word, c`` over a ``text`` column; counted in each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts_of(batch, "text", 2 * PART):
                words, _ = coded_words(part["text"])
                c = np.bincount(words.indices.to_numpy(), minlength=len(words.dictionary))
                yield pa.record_batch([words.dictionary, pa.array(c, pa.int64())], ["word", "c"])

    parts = texts.select("text").mapInArrow(run, "word string, c long")
    return parts.groupBy("word").agg(F.sum("c").alias("c"))


_ANYWHERE, _START = range(2)


def subword_counts(words: DataFrame, tokenizer: dict[str, str]) -> DataFrame:
    """``kind, subword, c``, weighted by the words' counts: anywhere and at the start of
    words. At most two rows a subword."""

    def make():
        encoder = Encoder(tokenizer)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids, begin, size = encoder.ids(batch["word"])
            ids = ids.astype(np.int64)
            weight = batch["c"].to_numpy()
            parts = []
            anywhere = np.zeros(len(ids), np.int64)
            anywhere[ragged(begin, size)] = np.repeat(weight, size)
            for kind, own, c in ((_ANYWHERE, ids, anywhere), (_START, ids[begin], weight)):
                names, at = np.unique(own, return_inverse=True)
                total = np.zeros(len(names), np.int64)
                np.add.at(total, at, c)
                parts.append((np.full(len(names), kind), names, total))
            columns = [pa.array(np.concatenate(c)) for c in zip(*parts, strict=True)]
            return pa.record_batch(columns, ["kind", "subword", "c"])

        return work

    parts = by_batch(words.select("word", "c"), make, "kind long, subword long, c long")
    return parts.groupBy("kind", "subword").agg(F.sum("c").alias("c"))


class Encoder:
    """The ids of many words at once, each with a space before it."""

    #: Visible Latin letters and signs. A space between two such words starts a new unit of
    #: the byte-level pattern, so that they can be encoded as one text.
    PLAIN = "^[!-~\\x{A1}-\\x{24F}]+$"

    def __init__(self, tokenizer: dict[str, str]) -> None:
        self._words = Words(**tokenizer)
        self._fast = self._words._fast
        if self._fast is not None:
            # Only a word's first id starts with its space.
            names = map(self._fast.decode_single_token_bytes, range(self._fast.n_vocab))
            self._spaced = np.array([x[:1] == b" " for x in names])

    def ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all words in some order, where those of each word begin and how many they
        are."""
        plain = np.zeros(len(words), bool)
        if self._fast is not None and len(words):
            known = pc.and_not(pc.match_substring_regex(words, self.PLAIN), pc.match_substring(words, "<|"))
            plain = known.to_numpy(zero_copy_only=False)
        together = np.zeros(0, np.uint32)
        begin, size = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        if plain.any():
            listed = pa.ListArray.from_arrays([0, int(plain.sum())], words.filter(pa.array(plain)))
            text = " " + pc.binary_join(listed, " ")[0].as_py()
            together = np.asarray(self._fast.encode_to_numpy(text, disallowed_special=()))
            starts = np.flatnonzero(self._spaced[together])
            if len(starts) == plain.sum():
                begin[plain], size[plain] = starts, np.diff(np.r_[starts, len(together)])
            else:
                together, plain = together[:0], np.zeros(len(words), bool)
        others = [np.frombuffer(self._words.ids(" " + w), np.uint32) for w in words.filter(pa.array(~plain)).to_pylist()]
        if others:
            own = np.fromiter(map(len, others), np.int64, len(others))
            begin[~plain], size[~plain] = len(together) + np.cumsum(own) - own, own
        return np.concatenate([together, *others]).astype(np.uint16), begin, size


def ragged(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``begin[0]``, ``begin[0] + 1`` and so on, ``size[0]`` places, then those of the next."""
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if total < 1 << 30 and int(begin.max(initial=0)) < 1 << 30 else np.int64
    places = np.repeat((begin - (ends - size)).astype(kind), size)
    places += np.arange(total, dtype=kind)
    return places


def laid_out(found: list[tuple[bytes, int]]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of a text, end included, and where its words and its end start."""
    ids = np.frombuffer(b"".join([f[0] for f in found]), np.uint32)
    size = np.fromiter((len(f[0]) // 4 for f in found), np.int64, len(found))
    return np.r_[ids.astype(np.int64), END], np.r_[0, np.cumsum(size)]


def added(rows: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], np.ndarray | None], size: int) -> np.ndarray:
    """The sum of the vectors, each of ``size`` floats, that ``work`` makes of each task's
    rows. Tasks add ``FAN`` at a time until ``FAN`` are left, the driver those."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = work(batches)
        if x is not None:
            own = pa.array([x.astype(np.float32).tobytes()], pa.binary())
            yield pa.record_batch([pa.array([TaskContext.get().partitionId()], pa.int64()), own], ["part", "x"])

    def add(table: pa.Table) -> pa.Table:
        part = pa.array([table["part"][0].as_py() // FAN], pa.int64())
        return pa.table({"part": part, "x": pa.array([_sum_of(table["x"], size).tobytes()], pa.binary())})

    parts = stored(rows.mapInArrow(run, "part long, x binary"))
    while parts.count() > FAN:
        parts = stored(parts.groupBy(F.expr(f"part div {FAN}")).applyInArrow(add, "part long, x binary"))
    return _sum_of(parts.select("x").toArrow()["x"], size)


def _sum_of(column: pa.ChunkedArray, size: int) -> np.ndarray:
    total = np.zeros(size, np.float32)
    for x in column:
        total += np.frombuffer(x.as_buffer(), np.float32)
    return total


def _sums_by(at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different names in ``at``, which are below 65,536, and the sums of their rows."""
    at = at.astype(np.uint16)
    # Numbers of 16 bits are sorted by their digits.
    order = np.argsort(at, kind="stable")
    names = at[order]
    new = np.flatnonzero(np.r_[True, names[1:] != names[:-1]])
    return names[new].astype(np.int64), np.add.reduceat(rows.take(order, axis=0), new, axis=0)


NEAR = 24


def _signs() -> np.ndarray:
    return np.random.default_rng(3).standard_normal((VOCABULARY, NEAR)).astype(np.float32)


def neighbours(chunks: Iterator[np.ndarray]) -> np.ndarray:
    """Sums of random vectors of the three subwords to the left of each subword. Each chunk
    starts with the last subword of the one before."""
    signs, near = _signs(), np.zeros((VOCABULARY, NEAR), np.float32)
    for some in itertools.batched(chunks, 4):
        # Pairs of a subword and one left of it, as one number; the same pairs added once.
        own = [ids.astype(np.uint32) for ids in some]
        pairs = np.concatenate([x[gap:] * np.uint32(VOCABULARY) + x[:-gap] for x in own for gap in (1, 2, 3)])
        if not len(pairs):
            continue
        pairs.sort()
        new = np.flatnonzero(np.r_[True, pairs[1:] != pairs[:-1]])
        names, left = np.divmod(pairs[new], np.uint32(VOCABULARY))
        rows = signs.take(left, axis=0)
        rows *= np.diff(np.r_[new, len(pairs)]).astype(np.float32)[:, None]
        new = np.flatnonzero(np.r_[True, names[1:] != names[:-1]])
        near[names[new]] += np.add.reduceat(rows, new, axis=0)
    return near


def classes_of(near: np.ndarray, total: np.ndarray, classes: int) -> np.ndarray:
    """Subwords grouped by their left neighbours: k-means on random projections."""
    random = np.random.default_rng(3)
    cls = np.arange(VOCABULARY) % classes
    known = np.flatnonzero(total >= 3)
    if len(known) < classes:
        return cls
    points = near[known].astype(np.float64)
    points /= np.linalg.norm(points, axis=1, keepdims=True) + 1e-9
    weight = np.sqrt(total[known] + 1)
    centres = points[random.choice(len(known), classes, replace=False, p=weight / weight.sum())]
    for _ in range(12):
        own = np.argmax(points @ centres.T, axis=1)
        for k in range(classes):
            held = own == k
            if held.any():
                centres[k] = (points[held] * weight[held, None]).sum(0)
        centres /= np.linalg.norm(centres, axis=1, keepdims=True) + 1e-9
    cls[known] = own
    return cls


@dataclass
class Layer:
    """Weights of the attention layer. ``cls`` is each subword's class, ``starts`` and
    ``inside`` its probability in the class at the start of a word and inside one, and
    ``opens`` a class's probability of a start."""

    cls: np.ndarray
    starts: np.ndarray
    inside: np.ndarray
    opens: np.ndarray
    weights: dict[str, np.ndarray]


def new_layer(near: np.ndarray, total: np.ndarray, start: np.ndarray, seed: int = 5) -> Layer:
    random = np.random.default_rng(seed)
    cls = classes_of(near, total, CLASSES)
    smooth = total + 0.1
    mass = np.bincount(cls, smooth, CLASSES) + 1e-9
    within = smooth / mass[cls]
    begins = (start + 0.01) / (total + 0.02)
    starts = within * begins
    draw = lambda *shape: (random.standard_normal(shape) * 0.1).astype(np.float32)
    weights = {
        "token": draw(VOCABULARY, SIZE), "place": draw(SPAN, SIZE),
        "q": draw(SIZE, SIZE), "k": draw(SIZE, SIZE), "v": draw(SIZE, SIZE), "o": draw(SIZE, SIZE),
        "out": draw(SIZE, CLASSES), "bias": np.log(mass / mass.sum()).astype(np.float32),
        "gate": draw(SIZE), "gate0": np.zeros(1, np.float32),
    }
    return Layer(cls, starts, within - starts, np.bincount(cls, starts, CLASSES).astype(np.float32), weights)


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=-1, keepdims=True))
    x /= x.sum(axis=-1, keepdims=True)
    return x


#: Exponents of up to this size stay within the range of floats, sums of them too.
SAFE = 80


def _exps(x: np.ndarray) -> np.ndarray:
    """``exp(x)`` in place, of which only the shares within a row matter."""
    if x.size and (x.max() > SAFE or x.min() < -SAFE):
        x -= x.max(axis=-1, keepdims=True)
    return np.exp(x, out=x)


def _row_sums(x: np.ndarray) -> np.ndarray:
    return (x.reshape(-1, x.shape[-1]) @ np.ones(x.shape[-1], np.float32)).reshape(*x.shape[:-1], 1)


class Training:
    """A copy of a layer that learns from windows of ``SPAN`` by Adam. The loss of a subword
    is its class's; of a word inside a window, for the gate alone, the mixture's."""

    def __init__(self, layer: Layer, batch: int = 128, rate: float = 0.01) -> None:
        self.layer = replace(layer, weights={k: v.copy() for k, v in layer.weights.items()})
        self.batch, self.rate, self.steps = batch, rate, 0
        self.first = {k: np.zeros_like(v) for k, v in layer.weights.items()}
        self.second = {k: np.zeros_like(v) for k, v in layer.weights.items()}
        self.seen = np.zeros(VOCABULARY, np.float32)
        self.learnt = 0
        self._random = np.random.default_rng(11)
        self._seen = np.tril(np.ones((SPAN, SPAN), np.float32))
        self._mask = np.triu(np.full((SPAN, SPAN), -1e9, np.float32), 1)
        self._cls = layer.cls.astype(np.int64)
        self._shares = np.r_[layer.inside, layer.starts].astype(np.float32)
        self._sums = np.c_[np.ones(CLASSES), layer.opens].astype(np.float32)

    def learn(self, ids: np.ndarray, counted: np.ndarray) -> None:
        """``ids[1:]`` are predicted, each from those before it. ``counted`` is the count
        part's probability of a word where it starts, else 0."""
        many = len(ids) - 1
        if many < 1:
            return
        windows = -(-many // SPAN)
        at = np.arange(windows * SPAN).reshape(windows, SPAN)
        real = at < many
        at = np.minimum(at, many - 1)
        order = self._random.permutation(windows)
        for low in range(0, windows, self.batch):
            b = at[order[low : low + self.batch]]
            self._step(ids[b], ids[b + 1], counted[b + 1], real[order[low : low + self.batch]])
        self.learnt += many
        self.seen += np.bincount(ids[:-1], minlength=VOCABULARY).astype(np.float32)

    def _step(self, given: np.ndarray, aim: np.ndarray, counted: np.ndarray, real: np.ndarray) -> None:
        w, scale = self.layer.weights, np.float32(SIZE**-0.5)
        n, many = max(int(real.sum()), 1), len(given)
        windows = lambda y: y.reshape(many, SPAN, -1)
        x = w["token"].take(given, axis=0)
        x += w["place"]
        x = x.reshape(-1, SIZE)
        inner = np.concatenate([w["q"] * scale, w["k"], w["v"]], axis=1)
        qkv = windows(x @ inner)
        q, k, v = qkv[..., :SIZE], qkv[..., SIZE : 2 * SIZE], qkv[..., 2 * SIZE :]
        a = self._attended(q @ k.transpose(0, 2, 1))
        mixed = a @ v
        # With a column of ones for the bias.
        h = np.ones((len(x), SIZE + 1), np.float32)
        h[:, :SIZE] = mixed.reshape(-1, SIZE) @ w["o"]
        h[:, :SIZE] += x
        p = h @ np.concatenate([w["out"], w["bias"][None]])
        sums = _exps(p) @ self._sums
        total = sums[:, 0]
        at = np.arange(0, p.size, CLASSES) + self._cls.take(aim.ravel())
        of_class = p.ravel()[at] / total
        gate = 1 / (1 + np.exp(-(h @ np.r_[w["gate"], w["gate0"]])))
        d_gate = self._gate_slopes(aim, counted, real, of_class, sums[:, 1] / total, gate)
        # Slopes of the logits, but for the factor of each row.
        p.ravel()[at] -= total
        factor = (real.ravel() / total).astype(np.float32)[:, None]
        d_h = p @ w["out"].T
        d_h *= factor
        d_mixed = windows(d_h @ w["o"].T)
        d_s = d_mixed @ v.transpose(0, 2, 1)
        d_s -= np.einsum("bij,bij->bi", d_mixed, mixed)[..., None]
        d_s *= a
        d_qkv = np.empty_like(qkv)
        d_qkv[..., :SIZE] = d_s @ k
        d_qkv[..., SIZE : 2 * SIZE] = d_s.transpose(0, 2, 1) @ q
        d_qkv[..., 2 * SIZE :] = a.transpose(0, 2, 1) @ d_mixed
        d_qkv = d_qkv.reshape(-1, 3 * SIZE)
        d_x = d_qkv @ inner.T
        d_x += d_h
        names, token = _sums_by(given.ravel(), d_x)
        d_inner, d_out, d_gates = x.T @ d_qkv, (h * factor).T @ p, d_gate @ h
        grads = {
            "place": windows(d_x).sum(0),
            "q": d_inner[:, :SIZE] * scale, "k": d_inner[:, SIZE : 2 * SIZE], "v": d_inner[:, 2 * SIZE :],
            "o": mixed.reshape(-1, SIZE).T @ d_h, "out": d_out[:SIZE], "bias": d_out[SIZE],
            "gate": d_gates[:SIZE], "gate0": d_gates[SIZE:],
        }
        self.steps += 1
        # Rows of subwords that the batch lacks stay as they are.
        self._move("token", names, token / n)
        for name, g in grads.items():
            self._move(name, slice(None), g / n)

    def _attended(self, s: np.ndarray) -> np.ndarray:
        if s.max() > SAFE or s.min() < -SAFE:
            return _softmax(s + self._mask)
        np.exp(s, out=s)
        s *= self._seen
        s *= 1 / _row_sums(s)
        return s

    def _gate_slopes(self, aim, counted, real, of_class, opens, gate) -> np.ndarray:
        slopes = np.zeros(aim.size, np.float32)
        aim, counted = aim.ravel(), counted.ravel()
        start = counted > 0
        # In single precision, but summed in double.
        own = np.log(of_class * self._shares.take(aim + VOCABULARY * start) + np.float32(1e-30))
        so_far = np.r_[0.0, np.cumsum(own, dtype=np.float64)]
        begin = np.flatnonzero(start & real.ravel())
        low, high = begin[:-1], begin[1:]
        whole = low // SPAN == high // SPAN
        low, high = low[whole], high[whole]
        opens = np.log(opens + np.float32(1e-30))
        attended = so_far[high] - so_far[low] - opens[low] + np.where(aim[low] == END, 0, opens[high])
        attended, g = np.exp(np.minimum(attended, 0)), gate[low]
        both = g * attended + (1 - g) * counted[low] + 1e-30
        slopes[low] = -(attended - counted[low]) / both * g * (1 - g)
        return slopes

    def _move(self, name: str, at: np.ndarray | slice, g: np.ndarray) -> None:
        # A copy where ``at`` lists rows.
        first, second = self.first[name][at], self.second[name][at]
        first *= 0.9
        first += 0.1 * g
        second *= 0.99
        second += 0.01 * g * g
        if isinstance(at, np.ndarray):
            self.first[name][at], self.second[name][at] = first, second
        size = np.sqrt(second / (1 - 0.99**self.steps))
        size += 1e-8
        rate = self.rate / (1 + self.steps / 300) ** 0.5 / (1 - 0.9**self.steps)
        self.layer.weights[name][at] -= (rate * first / size).astype(np.float32)

    def vector(self) -> np.ndarray:
        """The weights times how often they were used, and that."""
        w = self.layer.weights
        rest = [w[k].ravel() * self.learnt for k in w if k != "token"]
        return np.concatenate([(w["token"] * self.seen[:, None]).ravel(), self.seen, *rest, [self.learnt]])


def vector_size() -> int:
    others = SPAN * SIZE + 4 * SIZE * SIZE + SIZE * CLASSES + CLASSES + SIZE + 1
    return VOCABULARY * (SIZE + 1) + others + 1


def averaged(layer: Layer, vector: np.ndarray) -> Layer:
    """The layer with the weights of an added-up ``Training.vector``; what no task used
    stays."""
    if not vector[-1]:
        return layer
    vector, weights = vector.astype(np.float64), dict(layer.weights)
    low = VOCABULARY * SIZE
    seen = vector[low : low + VOCABULARY, None]
    token = vector[:low].reshape(VOCABULARY, SIZE)
    weights["token"] = np.where(seen > 0, token / np.maximum(seen, 1), weights["token"]).astype(np.float32)
    low += VOCABULARY
    for name, old in layer.weights.items():
        if name != "token":
            weights[name] = (vector[low : low + old.size] / vector[-1]).reshape(old.shape).astype(np.float32)
            low += old.size
    return replace(layer, weights=weights)


class Scorer:
    """Probabilities of id sequences, batched over windows."""

    def __init__(self, layer: Layer) -> None:
        w = layer.weights
        self.layer = layer
        # A layer of one: queries, keys and values are sums of a token's and a place's.
        self.x, self.px = w["token"], w["place"]
        scale = np.float32(SIZE**-0.5)
        self.q, self.pq = w["token"] @ w["q"] * scale, w["place"] @ w["q"] * scale
        inner = np.concatenate([w["k"], w["v"] @ w["o"]], axis=1)
        self.kv, self.pkv = w["token"] @ inner, w["place"] @ inner
        self.out = np.concatenate([w["out"], w["bias"][None]])
        self.gate = np.r_[w["gate"], w["gate0"]]
        self.sums = np.c_[np.ones(CLASSES), layer.opens].astype(np.float32)
        self.cls = layer.cls.astype(np.int64)
        place = np.arange(SPAN - STRIDE, SPAN)
        self.causal = np.where(np.arange(SPAN) <= place[:, None], 0, -1e9).astype(np.float32)
        self.seen = (self.causal == 0).astype(np.float32)

    def _mixed(self, s: np.ndarray, real: np.ndarray, v: np.ndarray) -> np.ndarray:
        """Values by the shares of the scores; ``real`` tells, window by window, which inputs
        there are."""
        short = np.flatnonzero(~real[:, 0])
        if s.max() > SAFE or s.min() < -SAFE:
            s += self.causal
            s[short] += np.where(real[short], 0, -1e9).astype(np.float32)[:, None, :]
            return _softmax(s) @ v
        np.exp(s, out=s)
        s *= self.seen
        s[short] *= real[short].astype(np.float32)[:, None, :]
        out = s @ v
        out *= 1 / _row_sums(s)
        return out

    def score(self, ids: np.ndarray, ends: np.ndarray, block: int = 256) -> tuple[np.ndarray, ...]:
        """Of each subword, from those before it in its text: the probability of its class,
        that a word starts here, and the gate. ``ids`` holds the texts one after another,
        each up to ``ends``."""
        context = SPAN - STRIDE
        begins = np.r_[0, ends[:-1]]
        many = -(-(ends - begins) // STRIDE)
        text = np.repeat(np.arange(len(ends)), many)
        number = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
        of_class, opens, gates = (np.zeros(len(ids), np.float32) for _ in range(3))
        for low in range(0, len(text), block):
            t, j = text[low : low + block], number[low : low + block]
            # Inputs are the subwords before the aims; the text's first input is an end.
            first = begins[t] + j * STRIDE - context - 1
            at = first[:, None] + np.arange(SPAN)
            real = at >= begins[t][:, None] - 1
            # Only a text's first windows start before it.
            early = np.flatnonzero(first < begins[t])
            given = ids.take(at, mode="clip")
            given[early] = np.where(at[early] >= begins[t[early]][:, None], given[early], END)
            q = self.q.take(given[:, context:], axis=0)
            q += self.pq[context:]
            kv = self.kv.take(given, axis=0)
            kv += self.pkv
            x = self.x.take(given[:, context:], axis=0)
            x += self.px[context:]
            x += self._mixed(q @ kv[..., :SIZE].transpose(0, 2, 1), real, kv[..., SIZE:])
            # Places behind a text's end are computed too: a product of one row would be
            # summed in another order. Equal texts get equal scores in any batch.
            h = np.ones((x.size // SIZE, SIZE + 1), np.float32)
            h[:, :SIZE] = x.reshape(-1, SIZE)
            out = h @ self.out
            sums = _exps(out) @ self.sums
            aim_at = (at[:, context:] + 1).ravel()
            live = aim_at < np.repeat(ends[t], STRIDE)
            own = self.cls.take(ids.take(aim_at, mode="clip")) + np.arange(0, out.size, CLASSES)
            aim_at = aim_at[live]
            of_class[aim_at] = (out.ravel().take(own) / sums[:, 0])[live]
            opens[aim_at] = (sums[:, 1] / sums[:, 0])[live]
            gates[aim_at] = (1 / (1 + np.exp(-(h @ self.gate))))[live]
        return of_class, opens, gates

    def words(self, ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each word and end, which begin at ``starts``: the attention's natural
        logarithm and the gate."""
        of_class, opens, gates = self.score(ids, ends)
        share = self.layer.inside.take(ids)
        share[starts] = self.layer.starts[ids[starts]]
        own = np.log(of_class.astype(np.float64) * share + 1e-30)
        opens = np.log(opens[starts].astype(np.float64) + 1e-30)
        after = np.r_[opens[1:], 0.0]
        after[ids[starts] == END] = 0.0
        return np.minimum(np.add.reduceat(own, starts) - opens + after, 0), gates[starts]


def _small(size: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sizes as bytes, 255 for each 255 in a size before the rest of it; how many bytes each
    of the rows of ``many`` sizes takes."""
    more = size // 255
    ends = np.cumsum(more + 1)
    out = np.full(int(ends[-1]) if len(ends) else 0, 255, np.uint8)
    out[ends - 1] = size - 255 * more
    return out, np.diff(np.r_[0, np.r_[0, ends][np.cumsum(many)]])


def _sizes_of(small: np.ndarray) -> np.ndarray:
    ends = np.flatnonzero(small != 255) + 1
    return np.add.reduceat(small, np.r_[0, ends[:-1]], dtype=np.int64) if len(ends) else np.zeros(0, np.int64)


def _bytes_of(values: np.ndarray, many: np.ndarray) -> pa.Array:
    """The values as binary rows, of which each takes as many as ``many`` says."""
    ends = np.r_[0, np.cumsum(many)] * values.itemsize
    if ends[-1] < 1 << 31:
        buffers = [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))]
        return pa.BinaryArray.from_buffers(pa.binary(), len(many), buffers)
    return pa.array([x.tobytes() for x in np.split(values, np.cumsum(many)[:-1])], pa.binary())


def _values_of(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """What ``_bytes_of`` was given."""
    width = np.dtype(kind).itemsize
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, np.int64 if pa.types.is_large_binary(column.type) else np.int32)
    ends = ends[column.offset : column.offset + len(column) + 1].astype(np.int64) // width
    return np.frombuffer(data or b"", kind)[ends[0] : ends[-1]], np.diff(ends)


def encoded(docs: DataFrame, tokenizer: dict[str, str], common: pa.Array, counts: np.ndarray, texts: int, floor: int) -> DataFrame:
    """``docs`` without their texts. Binary rows hold the ``ids`` (16 bits), end included, and of
    each word its ``size`` in ids (``_small``) and its place ``at`` in the common words, -1 if
    it is another (32 bits). Those others are in ``rare``, with spaces between. ``known`` and ``base`` are of the
    common words and the end."""
    sent = docs.sparkSession.sparkContext.broadcast((common, counts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, counts = sent.value
        encoder = Encoder(tokenizer)
        # The last one, -1, is of other words.
        terms = np.r_[np.log10((counts + 1) / floor), 0.0]
        of_end = np.log10((texts + 1) / floor)

        def work(part: pa.RecordBatch, number: int) -> pa.RecordBatch:
            words, many = coded_words(part["text"])
            names, kinds = words.indices.to_numpy(), words.dictionary
            ids, begin, size = encoder.ids(kinds)
            place = pc.fill_null(pc.index_in(kinds, common), -1).to_numpy()
            # An end after the words of each text.
            last = np.cumsum(many + 1) - 1
            inside = np.ones(len(names) + len(many), bool)
            inside[last] = False
            which = np.full(len(inside), len(kinds))
            which[inside] = names
            size = np.r_[size, 1]
            of_each = size.take(which)
            own = np.r_[ids, np.uint16(END)].take(ragged(np.r_[begin, len(ids)].take(which), of_each))
            by_text = lambda x: np.add.reduceat(x, last - many)
            at = place.take(names)
            often = np.zeros(len(inside), np.int64)
            often[inside] = at >= 0
            base = np.full(len(inside), of_end)
            base[inside] = terms[at]
            often = by_text(often)
            behind = pa.array(np.r_[0, np.cumsum(many - often)], pa.int32())
            out = {
                "row": pa.array(np.arange(number, number + part.num_rows)),
                "doc_id": part["doc_id"],
                "held_out": part["held_out"],
                "n_tokens": pa.array(many + 1),
                "known": pa.array(often + (texts > 0)),
                "base": pa.array(by_text(base)),
                "ids": _bytes_of(own, by_text(of_each)),
                "size": _bytes_of(*_small(size.take(names), many)),
                "at": _bytes_of(at, many),
                "rare": pc.binary_join(pa.ListArray.from_arrays(behind, kinds.take(pa.array(names[at < 0]))), " "),
            }
            return pa.RecordBatch.from_pydict(out)

        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            for part in parts_of(batch, "text", PART):
                yield work(part, number)
                number += part.num_rows
            pa.default_memory_pool().release_unused()

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"row long, doc_id {kind}, held_out boolean, n_tokens long, known long, base double, ids binary, size binary, at binary, rare string"
    return stored(docs.select("doc_id", "held_out", "text").mapInArrow(run, schema), "zstd")


def fit(training: DataFrame, words: DataFrame, texts: int, tokenizer: dict[str, str], counts: np.ndarray, usual: float, floor: int) -> Layer:
    """The layer, taught by all ``training`` texts, as ``encoded`` gives them. ``usual`` is the
    average count of a word that is not common."""
    single = subword_counts(words, tokenizer).toArrow()
    total, start = np.zeros(VOCABULARY), np.zeros(VOCABULARY)
    for kind, into in ((_ANYWHERE, total), (_START, start)):
        own = single["kind"].to_numpy() == kind
        into[single["subword"].to_numpy()[own]] = single["c"].to_numpy()[own]
    total[END] = start[END] = texts
    context = training.sparkSession.sparkContext
    sent = context.broadcast(counts)

    def chunks(batches: Iterator[pa.RecordBatch], known: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """A task's texts one after another, an end first; the count part where words start,
        if it is known."""
        ids, counted, many = [np.array([END], np.uint16)], [np.zeros(1, np.float32)], 0
        for part in itertools.chain.from_iterable(parts_of(b, "ids", 1_000_000) for b in batches):
            own, lengths = _values_of(part["ids"], np.uint16)
            ends = np.cumsum(lengths)
            p = np.zeros(len(own) if known is not None else 0, np.float32)
            if known is not None:
                at, words = _values_of(part["at"], np.int32)
                size = _sizes_of(_values_of(part["size"], np.uint8)[0])
                # Ends stand between the words of a text and those of the next.
                p[np.cumsum(size) - size + np.repeat(np.arange(len(words)), words)] = known[at]
                p[ends - 1] = (texts + 1) / floor
            low = 0
            while low < len(own):
                # Up to the first text that makes the chunk full.
                last = min(int(np.searchsorted(ends, low + CHUNK - many)), len(ends) - 1)
                high = int(ends[last])
                ids.append(own[low:high]), counted.append(p[low:high])
                many, low = many + high - low, high
                if many >= CHUNK:
                    yield np.concatenate(ids), np.concatenate(counted)
                    ids, counted, many = [ids[-1][-1:]], [counted[-1][-1:]], 0
        if many:
            yield np.concatenate(ids), np.concatenate(counted)


    def gather(batches: Iterator[pa.RecordBatch]) -> np.ndarray | None:
        own = chunks(batches)
        first = next(own, None)
        return None if first is None else neighbours(x for x, _ in itertools.chain([first], own)).ravel()

    near = added(training.select("ids"), gather, VOCABULARY * NEAR)
    layer = new_layer(near.reshape(VOCABULARY, NEAR), total, start)
    begin = context.broadcast(layer)

    def learn(batches: Iterator[pa.RecordBatch]) -> np.ndarray | None:
        training = Training(begin.value)
        known = ((np.r_[sent.value, usual] + 1) / floor).astype(np.float32)
        for ids, counted in chunks(batches, known):
            training.learn(ids, counted)
        return training.vector() if training.learnt else None

    return averaged(layer, added(training.select("ids", "size", "at"), learn, vector_size()))


def score_texts(docs: DataFrame, tokenizer: dict[str, str]) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``, one row
    per row of ``docs``."""
    spark = docs.sparkSession
    held = crc_remainder(F.col("doc_id"), FOLDS) == HELD
    rows = docs.select("doc_id", "text", held.alias("held_out"))
    training = rows.where("NOT held_out")
    counted = stored(word_counts(training))
    texts = training.count()
    in_words, kinds = counted.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    n, v = in_words + texts, kinds + (1 if texts else 0)
    floor = n + v + 1
    often = counted.where(F.col("c") * COMMON >= n).toArrow().sort_by([("c", "descending"), ("word", "ascending")]).combine_chunks()
    counts = often["c"].to_numpy().astype(np.float64)
    common = pa.array(often["word"].to_pylist(), pa.string())
    usual = (in_words - int(counts.sum())) / max(kinds - len(common), 1)
    read = encoded(rows, tokenizer, common, counts, texts, floor)
    layer = fit(read.where("NOT held_out"), counted, texts, tokenizer, counts, usual, floor)
    sent = spark.sparkContext.broadcast((layer, counts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        layer, counts = sent.value
        scorer = Scorer(layer)
        # The last one is of other words and stands for nothing.
        shares = np.r_[(counts + 1) / floor, 0.0]
        for batch in batches:
            for part in parts_of(batch, "ids", 1_000_000):
                ids, lengths = _values_of(part["ids"], np.uint16)
                size = _sizes_of(_values_of(part["size"], np.uint8)[0])
                at, many = _values_of(part["at"], np.int32)
                ends = np.cumsum(lengths)
                last = np.cumsum(many + 1) - 1
                inside = np.ones(len(at) + len(many), bool)
                inside[last] = False
                starts = np.empty(len(inside), np.int64)
                starts[inside] = np.cumsum(size) - size + np.repeat(np.arange(len(many)), many)
                starts[last] = ends - 1
                a, g = scorer.words(ids, starts, ends)
                share = np.full(len(inside), (texts + 1) / floor)
                share[inside] = shares[at]
                p = np.log10(g * np.exp(a) + (1 - g) * share + 1e-300)
                rare = np.zeros(len(inside), bool)
                rare[inside] = at < 0
                p[rare] = 0
                behind = pa.array(np.r_[0, np.cumsum(np.add.reduceat(rare.astype(np.int64), last - many))], pa.int32())
                listed = lambda x: pa.ListArray.from_arrays(behind, pa.array(x[rare].astype(np.float32)))  # noqa: B023, E731
                kept = [part[c] for c in ("row", "doc_id", "held_out", "n_tokens", "known", "base", "rare")]
                yield pa.record_batch(
                    [*kept, pa.array(np.add.reduceat(p, last - many)), listed(a), listed(g)],
                    ["row", "doc_id", "held_out", "n_tokens", "known", "base", "rare", "score", "attended", "gate"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"row long, doc_id {kind}, held_out boolean, n_tokens long, known long, base double, rare string, score double, attended array<float>, gate array<float>"
    scored = stored(read.mapInArrow(run, schema), "zstd")
    discard(read)
    each = scored.where("rare <> ''").select("row", "attended", "gate", F.posexplode(F.split("rare", " ")).alias("k", "word"))
    missing = each.select("row", "word", F.col("attended")[F.col("k")].alias("attended"), F.col("gate")[F.col("k")].alias("gate"))
    c = F.coalesce("c", F.lit(0))
    p = (c + 1) / F.lit(float(floor))
    gate = F.col("gate").cast("double")
    rest = (
        missing.join(counted, "word", "left")
        .groupBy("row")
        .agg(
            F.sum(F.log10(p)).alias("more_base"),
            F.sum(F.log10(gate * F.exp(F.col("attended").cast("double")) + (1 - gate) * p + F.lit(1e-300))).alias("more_score"),
            F.sum(F.when(c > 0, 1).otherwise(0)).alias("more_known"),
        )
    )
    return scored.join(rest, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"),
    )
