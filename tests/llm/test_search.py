"""Collocations, languages and hard negatives against brute force."""

from __future__ import annotations

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from coursegrain.llm import collocations, language, negatives

# ------------------------------------------------------------------ collocations


def phrases_by_brute_force(rows, least, top, subsumed=80):
    counts = collections.defaultdict(collections.Counter)
    for text, lang in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\v\f\r]", low):
            words = re.findall("[^ \t]+", piece)
            for k in range(1, 5):
                counts[lang or "und"].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        n = sum(v for p, v in f.items() if len(p) == 1)
        candidates = {p: v for p, v in f.items() if len(p) > 1 and v >= least}
        scored = []
        for p, a in candidates.items():
            longer = [v for q, v in candidates.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if any(100 * v >= subsumed * a for v in longer):
                continue
            score, _, cut = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k, k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), f[p[:cut]], f[p[cut:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -s))
    return sorted(out)


def texts_of(rows):
    return [(i, t, lang, 5) for i, (t, lang) in enumerate(rows)]


_SCHEMA = "doc_id long, text string, lang string, n int"


def wordy(seed, n):
    rng = random.Random(seed)
    words = ["the", "The", "of", "é", "new york", "new\tyork city", "a", "b", "c,d", "x.", "\nq", "r"]
    return [(" ".join(rng.choices(words, k=rng.randrange(60))), rng.choice(["en", "fr", None, "und"])) for _ in range(n)]


@pytest.mark.parametrize("options", [{}, {"bits": 1 << 15, "crowded": 5}, {"top": 4}])
def test_collocations_equal_brute_force(spark, options, monkeypatch):
    rows = wordy(3, 120) + [(None, "en"), ("", "fr"), (" \t ", None), ("solo", "xx")]
    docs = spark.createDataFrame(texts_of(rows), _SCHEMA)
    found = collocations.collocations(docs, least=8, **options)
    want = phrases_by_brute_force(rows, 8, options.get("top", 2000))
    assert len(want) > 20 or "top" in options
    assert sorted(tuple(r) for r in found.collect()) == want
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_collocations_of_a_very_long_text_and_repeats(spark, monkeypatch):
    monkeypatch.setattr(collocations, "CHUNK", 1000)
    rows = [("big red dog. " * 5000, "en")] + [("big red cat", "en")] * 3000
    docs = spark.createDataFrame(texts_of(rows), _SCHEMA).repartition(5)
    found = collocations.collocations(docs, crowded=1000)
    assert sorted(tuple(r) for r in found.collect()) == phrases_by_brute_force(rows, 30, 2000)


def test_collocations_without_any(spark):
    empty = spark.createDataFrame([], _SCHEMA)
    assert collocations.collocations(empty).count() == 0
    assert collocations.collocations(spark.createDataFrame(texts_of([("a b", "en")]), _SCHEMA)).count() == 0


def test_scores_past_64_bits(spark):
    large = 1 << 62
    row = spark.range(1).select(F.lit(large).alias("a"), F.lit(large).alias("l"), F.lit(large + 7).alias("r"))
    up, down = 2_000_000 * collocations._exact("a"), collocations._exact("l") + collocations._exact("r")
    got = row.select(up.alias("up"), down.alias("down")).select(F.expr("up div down")).first()[0]
    assert got == 2_000_000 * large // (2 * large + 7)


# ------------------------------------------------------------------ languages


class SlowTree:
    """Prediction by partial matching with exclusion, byte by byte."""

    def __init__(self, texts):
        self.followed = collections.defaultdict(collections.Counter)
        for t in texts:
            data = bytes(language.ORDER) + t
            for i in range(language.ORDER, len(data)):
                for k in range(language.ORDER + 1):
                    self.followed[data[i - k : i]][data[i]] += 1

    def probability(self, before, byte):
        ruled_out, p = set(), 1.0
        for k in range(language.ORDER, -1, -1):
            seen = self.followed.get(before[len(before) - k :])
            if not seen:
                continue
            left = {b: n for b, n in seen.items() if b not in ruled_out}
            total = sum(left.values()) + len(left)
            if byte in left:
                return p * left[byte] / total
            if left:
                p *= len(left) / total
            ruled_out |= set(left)
        return p / (256 - len(ruled_out))

    def bits(self, text):
        data = bytes(language.ORDER) + text
        each = (self.probability(data[i - language.ORDER : i], data[i]) for i in range(language.ORDER, len(data)))
        return -sum(map(math.log2, each))


def tree_of(texts):
    code = np.concatenate([language.windows(np.frombuffer(t, np.uint8), np.array([0, len(t)])) for t in texts])
    return language.Tree.grown(*(lambda u: (u[0], u[1].astype(float)))(np.unique(code, return_counts=True)))


def test_code_lengths_equal_byte_by_byte():
    rng = random.Random(5)
    texts = [bytes(rng.choices(b"abcd ", k=rng.randrange(1, 60))) for _ in range(20)] + ["naïve".encode()]
    slow, fast = SlowTree(texts), tree_of(texts)
    asked = [bytes(rng.choices(b"abcdxyz \xc3", k=40)) for _ in range(20)] + [b"a"]
    for t in asked:
        got = fast.bits(language.windows(np.frombuffer(t, np.uint8), np.array([0, len(t)]))).sum()
        assert got == pytest.approx(slow.bits(t), rel=1e-12)


def test_probabilities_add_up_to_one():
    texts = [b"banana bandana", b"an ant"]
    slow, fast = SlowTree(texts), tree_of(texts)
    for before in (b"bana", b"xxan", b"zzzz", bytes(4)):
        codes = np.array([int.from_bytes(before + bytes([b]), "big") for b in range(256)], np.uint64)
        assert np.exp2(-fast.bits(codes)).sum() == pytest.approx(1)
        assert sum(slow.probability(before, b) for b in range(256)) == pytest.approx(1)


def test_query_equals_slow_trees(spark, documents):
    small = documents.where(F.length("text") < 300).limit(60)
    rows = small.select("doc_id", "text", "lang").collect()
    learned = collections.defaultdict(set)
    for r in rows:
        if zlib.crc32(str(r.doc_id).encode()) % 3 != 1:
            learned[r.lang].add((r.doc_id, r.text.encode()))
    trees = {k: SlowTree([t for _, t in v]) for k, v in learned.items()}
    found = {r.doc_id: r for r in language.languages(spark.createDataFrame(rows)).collect()}
    for r in rows:
        bits = {k: t.bits(r.text.encode()) for k, t in trees.items()}
        best = min(sorted(bits), key=bits.get)
        assert found[r.doc_id].lang_pred == best
        assert found[r.doc_id].score == pytest.approx(1 / sum(2 ** (bits[best] - b) for b in bits.values()))
        assert found[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)


def test_most_held_out_languages_are_found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language.languages(docs).where("held_out").join(docs, "doc_id")
    right, n = found.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int")), F.count("*")).first()
    assert n > 300 and right > 0.98


def test_language_edge_cases(spark, monkeypatch):
    monkeypatch.setattr(language, "PART", 64)
    long = "der hund und die katze " * 400
    rows = [(i, "the dog and the cat", "en", "t") for i in range(20)] + [(100 + i, "der hund und die katze", "de", "t") for i in range(20)]
    asked = [(1000, None, "en", "t"), (1001, "", "en", "t"), (1002, "123 !?", "en", "t"), (1003, long, None, "t"), (None, "the cat", None, "t")]
    docs = spark.createDataFrame(rows + asked + asked[-2:], "doc_id long, text string, lang string, lang_pred string")
    found = collections.defaultdict(list)
    for r in language.languages(docs).collect():
        found[r.doc_id].append((r.lang_pred, r.score))
    for i in (1000, 1001, 1002):
        assert found[i] == [("und", 0.0)]
    assert [p for p, _ in found[1003]] == ["de"] * 2 and [p for p, _ in found[None]] == ["en"] * 2
    # Long texts are read in parts; their sums are those of the whole.
    tree = tree_of([b"der hund und die katze"])
    whole = tree.bits(language.windows(np.frombuffer(long.encode(), np.uint8), np.array([0, len(long)]))).sum()
    import pyarrow as pa

    parts = list(language._parts(pa.array([long])))
    assert len(parts) > 10
    assert sum(language._text_bits([tree], d, o, lead)[0, 0] for _, _, d, o, lead in parts) == pytest.approx(whole)
    # Nothing to learn from.
    bare = spark.createDataFrame([(1, "abc", None, "t")], docs.schema)
    assert [tuple(r)[2:] for r in language.languages(bare).collect()] == [("und", 0.0)]
    assert language.languages(docs.limit(0)).count() == 0


def test_the_sample_is_bounded(spark, documents):
    trees = language.learn(documents, rows=3)
    assert set(trees) == {"de", "en", "es", "fr"}
    few = language.learn(documents, languages=2, rows=3)
    assert len(few) == 2
    tiny = language.learn(documents, size=4000)
    assert all(t.levels[0][1].sum() <= 1000 for t in tiny.values())


# ------------------------------------------------------------------ hard negatives


def negatives_by_brute_force(rows, anchor, k=5, m=10, low=30, high=90):
    out = []
    vectors = [[math.floor(256 * x) for x in v] for _, v, _ in rows]
    last = 1 << 63
    for a, (i, _, label) in enumerate(rows):
        if i is None or not anchor(i):
            continue
        scores = {
            b: sum(x * y for x, y in zip(vectors[a], vectors[b], strict=True))
            for b in range(len(rows)) if b != a and len(vectors[b]) == len(vectors[a])
        }
        order = sorted(scores, key=lambda b: (-scores[b], last if rows[b][0] is None else rows[b][0]))
        for p in [b for b in order if rows[b][2] == label][:k]:
            inside = [b for b in order if rows[b][2] != label and low * scores[p] <= 100 * scores[b] <= high * scores[p]]
            out += [(i, rows[p][0], r, rows[b][0], scores[p], scores[b]) for r, b in enumerate(inside[:m], 1)]
    return out


def counted(rows):
    return collections.Counter(rows)


_VECTORS = "vec_id long, embedding array<float>, label int, row int"


def vector_rows(seed, n, dim=8, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, dim))
    out = []
    for i in range(n):
        label = int(rng.integers(labels)) if i % 3 else 0
        v = centres[label] * rng.choice([0.2, 1.0]) + rng.normal(size=dim) * rng.choice([0.1, 0.7])
        out.append((i, [float(np.float32(x)) for x in v], label))
    return out


@pytest.mark.parametrize("options", [{}, {"bucket": 16, "block": 4}, {"bucket": 40, "block": 2, "focus": 8}])
def test_negatives_equal_brute_force(spark, options):
    rows = vector_rows(2, 300)
    rows += rows[10:40] + [(None, rows[0][1], 0), (None, rows[1][1], 1), (500, [0.0] * 8, 2), (501, [1.0, 2.0], 1), (505, [2.0, 1.0], 1), (510, [1.5, 1.0], 2)]
    unsound = [(600, None, 1), (605, [], 1), (610, [None] + [1.0] * 7, 1), (615, [float("nan")] * 8, 1), (620, [1e30] * 8, 1), (625, [1.0] * 8, None)]
    frame = spark.createDataFrame([(*r, 3) for r in rows + unsound], _VECTORS)
    found = negatives.hard_negatives(frame, anchors=F.col("id") % 5 == 0, **options)
    want = negatives_by_brute_force(rows, lambda i: i % 5 == 0)
    assert len(want) > 300
    assert counted(tuple(r) for r in found.collect()) == counted(want)


def test_ties_and_one_hot_label(spark):
    rows = [(i, [1.0, 1.0], 0) for i in range(200)] + [(1000 + i, [0.5, 0.5], 1 + i % 2) for i in range(50)]
    found = negatives.hard_negatives(
        spark.createDataFrame([(*r, 0) for r in rows], _VECTORS), anchors=F.col("id") % 50 == 0, bucket=32, block=2
    )
    assert counted(tuple(r) for r in found.collect()) == counted(negatives_by_brute_force(rows, lambda i: i % 50 == 0))


def test_negatives_of_an_empty_table(spark):
    assert negatives.hard_negatives(spark.createDataFrame([], _VECTORS)).count() == 0
    assert negatives.hard_negatives(spark.createDataFrame([(1, [1.0], 1, 0)], _VECTORS)).count() == 0


def test_coordinates_prune_and_lose_nothing():
    rng = np.random.default_rng(1)
    # One length, as in a bucket.
    vectors = rng.normal(size=(4000, 6))
    vectors = np.floor(256 * vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.int64)
    bucket = negatives.Bucket(vectors)
    for anchor in vectors[:20]:
        scores = vectors @ anchor
        least = int(np.sort(scores)[-5])
        at = bucket.candidates(anchor, least, 4)
        assert set(np.flatnonzero(scores >= least)) <= set(at)
        assert len(at) < len(vectors) / 2
