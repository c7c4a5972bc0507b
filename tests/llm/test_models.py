"""Toxicity, text scores, quality rules, chats and segmentations."""

from __future__ import annotations

import collections
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from coursegrain.llm import chats, quality, scoring, segments, toxicity
from coursegrain.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.1"


def fold(i, n):
    return zlib.crc32(("" if i is None else str(i)).encode()) % n


# ------------------------------------------------------------------ toxicity


def test_held_out_documents(spark):
    labels = spark.read.parquet(f"{LARGER}/labels.parquet")
    docs = spark.read.parquet(f"{LARGER}/documents.parquet").join(labels.select("doc_id"), "doc_id")
    found = toxicity.classify(docs, labels)
    rows = found.join(labels, "doc_id").where("held_out").collect()
    assert all(fold(r.doc_id, 3) == 1 and r.predicted == (r.score >= 0.7) for r in rows)
    toxic = [r.score for r in rows if r.toxic]
    clean = [r.score for r in rows if not r.toxic]
    # Some of the labels of this table follow no word of their text.
    assert sum(s >= 0.7 for s in toxic) >= 0.8 * len(toxic)
    assert sum(s >= 0.7 for s in clean) <= 0.01 * len(clean)


def test_counterfactuals_pull_identity_terms_together():
    rng = random.Random(1)
    rows = []
    for i in range(400):  # feature 0 is a group that bad texts (feature 2) mention more often
        bad = i % 2
        rows.append((bad, sorted({0 if rng.random() < (0.9 if bad else 0.1) else 1, *([2] if bad and rng.random() < 0.8 else [])})))
    pairs = [([0], [1])] * 100
    free, _ = toxicity.fit_weights(rows, [], 3)
    held, _ = toxicity.fit_weights(rows, pairs, 3, counterfactual=10.0)
    assert abs(held[0] - held[1]) < 0.2 < free[0] - free[1] and held[2] > 1


def test_swaps():
    found = set(toxicity.swaps("Some women sing. Nothing here.\nA gay man", toxicity.IDENTITY_TERMS))
    assert ("women", "men") in found and ("gay", "straight") in found and ("man", "woman") in found
    assert not list(toxicity.swaps(None, toxicity.IDENTITY_TERMS))


def test_toxicity_edge_cases(spark, docs):
    given = [(1, None), (2, ""), (3, "x " * 40_000), (None, "idiot"), (3, "x"), (3, "x")]
    no_labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = toxicity.classify(docs(given), no_labels).collect()
    assert len(got) == 6 and all(r.score < 1e-9 and r.predicted == 0 for r in got)
    train = [i for i in range(60) if fold(i, 3) != 1]
    texts = [(i, "you idiot person" if i % 2 else "a kind person") for i in train]
    labels = spark.createDataFrame([(i, 1, i % 2) for i in train] + [(train[0], 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.classify(docs(texts + [(900, "IDIOT!"), (901, None), (902, "kind")]), labels).collect()
    score = {r.doc_id: r.score for r in got}
    assert score[900] > 0.7 > score[901] and score[902] < 0.5 and all(0 <= s <= 1 for s in score.values())
    one_class = labels.where("toxic = 0")
    assert {r.predicted for r in toxicity.classify(docs(texts), one_class).collect()} == {0}
    assert toxicity.classify(docs([]), labels).count() == 0
    frame = docs(texts)
    kept = toxicity.keep_clean(frame, labels)
    assert kept.schema == frame.schema and {r.doc_id % 2 for r in kept.collect()} == {0}


# ------------------------------------------------------------------ text scores


def base_scores(rows):
    counts, texts = collections.Counter(), 0
    for i, t in rows:
        if fold(i, 7) != 2:
            counts.update((t or "").encode().lower().split())
            texts += 1
    n, v = counts.total() + texts, len(counts) + (texts > 0)
    out = []
    for i, t in rows:
        held = [counts[w] for w in (t or "").encode().lower().split()] + [texts]
        out.append((i, fold(i, 7) == 2, len(held), sum(c > 0 for c in held), n, sum(math.log10((c + 1) / (n + v + 1)) for c in held)))
    return out


def check_base(got, rows):
    key = lambda r: tuple(map(str, r[:4]))
    want = sorted(base_scores(rows), key=key)
    found = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=key)
    assert [w[:5] for w in want] == [f[:5] for f in found]
    assert np.allclose(sorted(w[5] for w in want), sorted(f[5] for f in found), rtol=1e-9)


@pytest.fixture
def quick(monkeypatch):
    monkeypatch.setattr(scoring, "COMMON", 50)


def test_scores_of_all_documents(spark, documents, quick):
    got = QUERIES["op5_attention_scores"](spark, SMALL).collect()
    check_base(got, [(r.doc_id, r.text) for r in documents.collect()])
    assert all(r.score < 0 for r in got)


def test_score_edge_cases(docs, vocabulary, quick):
    rows = [(i, f"Some words{chr(9)}and MORE w{i} é") for i in range(30)]
    rows += [(100, None), (101, ""), (102, " \n"), (None, "words"), (5, "words"), (5, "words"), (103, "long " * 5000)]
    got = scoring.score_texts(docs(rows), vocabulary).collect()
    check_base(got, rows)
    empty = {r.score for r in got if r.doc_id in (100, 101, 102)}
    assert len(empty) == 1
    only_held = [(i, "a b") for i in range(40) if fold(i, 7) == 2]
    got = scoring.score_texts(docs(only_held), vocabulary).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 and r.base_score == 0 for r in got)
    assert scoring.score_texts(docs([]), vocabulary).count() == 0


def score_by_brute_force(layer, encoder, text, counts, n, v):
    """One subword at a time, each in its window."""
    w, context = layer.weights, scoring.SPAN - scoring.STRIDE
    words = [memoryview(encoder.ids(" " + x.decode())).cast("I").tolist() for x in scoring.words_of(text)]
    ids = [i for own in words for i in own] + [scoring.END]

    def after(k):
        low = k // scoring.STRIDE * scoring.STRIDE - context
        given = [(j - low, scoring.END if j == 0 else ids[j - 1]) for j in range(max(0, low), k + 1)]
        x = np.array([w["token"][i] + w["place"][p] for p, i in given], np.float64)
        s = (x[-1] @ w["q"]) @ (x @ w["k"]).T / math.sqrt(scoring.SIZE)
        a = np.exp(s - s.max())
        h = x[-1] + (a / a.sum()) @ (x @ w["v"]) @ w["o"]
        z = np.exp(h @ w["out"] + w["bias"])
        z /= z.sum()
        return z, z @ layer.opens, 1 / (1 + math.exp(-(h @ w["gate"] + w["gate0"][0])))

    total, k = 0.0, 0
    for own, c in zip([*words, [scoring.END]], counts):
        _, opens, gate = after(k)
        p = 1 / opens
        for j, i in enumerate(own):
            p *= after(k)[0][layer.cls[i]] * (layer.inside[i] if j else layer.starts[i])
            k += 1
        if own != [scoring.END]:
            p *= after(k)[1]
        total += math.log10(gate * p + (1 - gate) * (c + 1) / (n + v + 1))
    return total


def test_attention_scores_every_subword(docs, vocabulary, quick, monkeypatch):
    """Long runs of characters and compounds too, not only the beginnings of words; words
    that are common, rare and unknown."""
    fitted, real_fit = [], scoring.fit

    def fit(*args):
        fitted.append(real_fit(*args))
        return fitted[-1]

    monkeypatch.setattr(scoring, "fit", fit)
    rows = {i: f"the antidisestablishment{i} é東京都 The http://a.b/c{i}?d " + "xqzthe" * 20 for i in range(12)}
    got = {r.doc_id: r.score for r in scoring.score_texts(docs(rows.items()), vocabulary).collect()}
    counts, texts = collections.Counter(), 0
    for i, text in rows.items():
        if fold(i, 7) != 2:
            counts.update(scoring.words_of(text))
            texts += 1
    n, v, encoder = counts.total() + texts, len(counts) + 1, scoring.Words(**vocabulary)
    for i, text in rows.items():
        c = [*(counts[w] for w in scoring.words_of(text)), texts]
        want = score_by_brute_force(fitted[0], encoder, text, c, n, v)
        assert abs(got[i] - want) < 1e-3 * abs(want)


def random_layer():
    rng = np.random.default_rng(0)
    ids = rng.integers(0, 50, 4000)
    ids[::40] = scoring.END
    total = np.bincount(ids, minlength=scoring.VOCABULARY).astype(float)
    near = scoring.neighbours(iter([ids])).reshape(scoring.VOCABULARY, -1)
    layer = scoring.new_layer(near, total, total * rng.uniform(0, 1, len(total)))
    for k, x in layer.weights.items():
        layer.weights[k] = (x + rng.standard_normal(x.shape) * 0.3).astype(np.float32)
    return layer, ids


def test_all_training_texts_teach_the_layer(docs, vocabulary, quick, monkeypatch):
    """Every part of the table reaches the layer, however many tasks and rounds add up; held
    out texts do not."""
    monkeypatch.setattr(scoring, "FAN", 2)
    sums, real = [], scoring.averaged

    def averaged(layer, vector):
        sums.append((layer, vector))
        return real(layer, vector)

    monkeypatch.setattr(scoring, "averaged", averaged)
    rows = [(i, f"word{i} said the word") for i in range(60)]
    scoring.score_texts(docs(rows).repartition(9), vocabulary).count()
    encoder, want = scoring.Words(**vocabulary), collections.Counter()
    for i, t in rows:
        if fold(i, 7) != 2:
            want.update(scoring.laid_out([(encoder.ids(" " + w), -1) for w in t.split()])[0].tolist())
    layer, vector = sums[0]
    low = scoring.VOCABULARY * scoring.SIZE
    seen = vector[low : low + scoring.VOCABULARY]
    assert vector[-1] == sum(want.values()) == seen.sum()
    # A task's last end is given to none, but each task is given one first.
    assert {i: int(c) for i, c in enumerate(seen) if c} == dict(want)
    new = real(layer, vector)
    moved = np.flatnonzero(np.abs(new.weights["token"] - layer.weights["token"]).max(axis=1) > 1e-6)
    assert set(moved.tolist()) == set(want)


def test_tasks_average_to_what_they_agree_on():
    layer, ids = random_layer()
    one = scoring.Training(layer)
    one.learn(ids, np.where(np.arange(len(ids)) % 3 == 0, 1e-3, 0).astype(np.float32))
    mean = scoring.averaged(layer, one.vector() + one.vector())
    for k, x in one.layer.weights.items():
        assert np.allclose(mean.weights[k], x, atol=1e-4), k
    none = scoring.averaged(layer, np.zeros(scoring.vector_size(), np.float32))
    assert none is layer


def test_slopes_of_the_training():
    """Against small changes of each weight."""
    layer, ids = random_layer()
    ids = ids[:65]
    counted = np.where(np.arange(65) % 3 == 0, 1e-4, 0).astype(np.float32)

    def losses(weights):
        h_layer = scoring.replace(layer, weights=weights)
        classes, gates = 0.0, 0.0
        for low in (0, 32):
            given, aim, c = ids[low : low + 32], ids[low + 1 : low + 33], counted[low + 1 : low + 33]
            w = {k: x.astype(np.float64) for k, x in weights.items()}
            x = w["token"][given] + w["place"]
            s = x @ w["q"] @ (x @ w["k"]).T / math.sqrt(scoring.SIZE) + np.triu(np.full((32, 32), -1e9), 1)
            h = x + scoring._softmax(s) @ (x @ w["v"]) @ w["o"]
            p = scoring._softmax(h @ w["out"] + w["bias"])
            own = p[np.arange(32), layer.cls[aim]]
            classes -= np.log(own).sum()
            gate, opens = 1 / (1 + np.exp(-(h @ w["gate"] + w["gate0"]))), p @ layer.opens
            starts = np.flatnonzero(c > 0)
            for a, b in zip(starts, starts[1:]):
                share = [layer.starts[aim[a]], *layer.inside[aim[a + 1 : b]]]
                word = np.prod(own[a:b] * share) / opens[a] * (1 if aim[a] == scoring.END else opens[b])
                gates -= np.log(gate[a] * min(word, 1) + (1 - gate[a]) * c[a])
        return classes, gates

    training, slopes = scoring.Training(layer), {}
    training._move = lambda name, at, g: slopes.__setitem__(name, (at, np.array(g)))
    training.learn(ids, counted)
    for name, part in (("q", 0), ("k", 0), ("v", 0), ("o", 0), ("out", 0), ("place", 0), ("gate", 1), ("gate0", 1)):
        weights = {k: x.copy() for k, x in layer.weights.items()}
        spot = np.unravel_index(np.argmax(np.abs(slopes[name][1])), slopes[name][1].shape)
        up, down = ({**weights, name: weights[name].copy()} for _ in range(2))
        up[name][spot] += 1e-2
        down[name][spot] -= 1e-2
        width = float(up[name][spot]) - float(down[name][spot])
        want = (losses(up)[part] - losses(down)[part]) / width / 64
        assert abs(slopes[name][1][spot] - want) < 0.02 * abs(want) + 1e-4, name


def test_counts_of_subwords(spark, vocabulary):
    words = ["the", "thereabouts", "xqzthe", "é", "the,", "antidisestablishment", "a"]
    df = spark.createDataFrame([(w, 3 + k) for k, w in enumerate(words)], "word string, c long")
    got = {(r.kind, r.subword): r.c for r in scoring.subword_counts(df, vocabulary).collect()}
    want, encoder = collections.Counter(), scoring.Words(**vocabulary)
    for k, w in enumerate(words):
        ids = memoryview(encoder.ids(" " + w)).cast("I").tolist()
        want[1, ids[0]] += 3 + k
        for i in ids:
            want[0, i] += 3 + k
    assert got == want


def test_texts_of_a_batch_do_not_mix():
    layer, ids = random_layer()
    scorer = scoring.Scorer(layer)
    ends = np.array([1, 17, 60, 61, 200])
    together = np.array(scorer.score(ids[:200], ends))
    alone = [np.array(scorer.score(ids[a:b], np.array([b - a]))) for a, b in zip([0, *ends[:-1]], ends)]
    assert np.allclose(together, np.concatenate(alone, axis=1), atol=1e-4)


def test_class_part_is_a_distribution():
    layer, _ = random_layer()
    mass = np.bincount(layer.cls, layer.starts + layer.inside, scoring.CLASSES)
    assert np.allclose(mass[np.unique(layer.cls)], 1, atol=1e-4)
    assert np.allclose(layer.opens, np.bincount(layer.cls, layer.starts, scoring.CLASSES), atol=1e-4)


def test_training_helps():
    rng = np.random.default_rng(5)
    ids = np.tile([7, 8, 9, 10], 4000) + 20 * rng.integers(0, 2, 4000).repeat(4)
    total = np.bincount(ids, minlength=scoring.VOCABULARY).astype(float)
    # A subword's successors tell it from others: its class is itself.
    layer = scoring.new_layer(np.zeros((scoring.VOCABULARY, scoring.NEAR)), total, total)
    training = scoring.Training(layer)
    training.learn(ids, np.full(len(ids), 1e-3, np.float32))
    starts, ends = np.arange(800), np.array([800])
    before = scoring.Scorer(layer).words(ids[:800], starts, ends)
    after = scoring.Scorer(training.layer).words(ids[:800], starts, ends)
    mixed = [np.log(g * np.exp(a) + (1 - g) * 1e-3).sum() for a, g in (before, after)]
    assert mixed[1] > mixed[0] + 50


ODD_WORDS = ["the", "thé", "<|", "a<|endoftext|>", "\xa0", "a\xa0b", "東京都", "'s", "x's", "\x1c", "\x85q", "12,5", "é" * 400, "#!", "ɐ", "a\xad"]


def test_words_encoded_together(vocabulary):
    """As one by one, whatever stands beside them, with both libraries or with one."""
    words = [*ODD_WORDS, *(a + b for a in ODD_WORDS for b in ODD_WORDS)]
    for tokenizer in (vocabulary, vocabulary | {"ranks": None}):
        encoder = scoring.Encoder(tokenizer)
        ids, begin, size = encoder.ids(pa.array(words))
        one = scoring.Words(**tokenizer)
        for w, b, many in zip(words, begin, size, strict=True):
            assert ids[b : b + many].tolist() == one.listed(" " + w), w
        assert [len(x) for x in encoder.ids(pa.array([], pa.string()))] == [0, 0, 0]


def test_words_of_many_texts():
    texts = [None, "", " \n", "A b\x0bB\x0c c\t", "\xa0É a\x1cb", *ODD_WORDS]
    words, many = scoring.coded_words(pa.array(texts).slice(1))
    want = [scoring.words_of(t) for t in texts[1:]]
    assert many.tolist() == [len(w) for w in want]
    assert [w.encode() for w in words.to_pylist()] == [w for own in want for w in own]


def test_sizes_as_bytes():
    size, many = np.array([1, 254, 255, 256, 510, 70000, 3]), np.array([0, 3, 0, 4, 0])
    small, ends = scoring._small(size, many)
    assert scoring._sizes_of(small).tolist() == size.tolist()
    parts = np.split(small, np.cumsum(ends)[:-1])
    assert [len(scoring._sizes_of(x)) for x in parts] == many.tolist()


def test_neighbours_are_those_to_the_left():
    rng, signs = np.random.default_rng(1), scoring._signs()
    chunks = [rng.integers(0, 9, k) for k in (1, 2, 3, 40, 1, 60, 5, 9, 30, 4)]
    want = np.zeros((scoring.VOCABULARY, scoring.NEAR))
    for ids in chunks:
        for k in range(len(ids)):
            for gap in (1, 2, 3):
                if k >= gap:
                    want[ids[k]] += signs[ids[k - gap]]
    assert np.allclose(scoring.neighbours(iter(chunks)), want, atol=1e-4)


def test_scores_far_apart_stay_finite():
    """Exponents beyond the range of floats; the same scores as from smaller ones."""
    layer, ids = random_layer()
    ends = np.array([200, 400])
    want = np.array(scoring.Scorer(layer).score(ids[:400], ends))
    layer.weights["bias"] = layer.weights["bias"] + np.float32(500)
    assert np.allclose(scoring.Scorer(layer).score(ids[:400], ends), want, atol=1e-3)
    layer.weights["q"] = layer.weights["q"] * np.float32(1e4)
    assert np.isfinite(scoring.Scorer(layer).score(ids[:400], ends)).all()
    training = scoring.Training(layer)
    training.learn(ids, np.full(len(ids), 1e-3, np.float32))
    assert all(np.isfinite(x).all() for x in training.layer.weights.values())


def test_texts_are_read_three_times(spark, vocabulary, quick):
    """To count words, to count texts and to encode them; the layer learns and scores from
    ids."""
    read = spark.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows = spark.createDataFrame([(i, f"some words of text {i}") for i in range(70)], "doc_id long, text string").coalesce(1)
    got = scoring.score_texts(rows.mapInArrow(run, rows.schema), vocabulary)
    assert read.value <= 3 * 70
    assert got.count() == 70


# ------------------------------------------------------------------ quality


def repeated_by_brute_force(text):
    w = (text or "").encode().split()
    grams = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
    count = collections.Counter(grams)
    return len({k + j for k, g in enumerate(grams) if count[g] > 1 for j in range(5)})


def test_quality_edge_cases(spark, docs):
    rng = random.Random(2)
    texts = [None, "", " \t\n ", "a", "x y z v w x y z v w", "l1\nl2\nl1\n\n\nl2 \n", "#*$ %&|<>", "non breaking", "é " * 20_000]
    texts += [" ".join(rng.choice("abc") for _ in range(n)) for n in (5, 6, 7, 30, 60)]
    got = {r.doc_id: r for r in quality.judge(docs(list(enumerate(texts)))).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        words = (t or "").encode().split()
        lines = [x for x in (t or "").split("\n") if x.encode().split()]
        r = got[i]
        assert r.n_words == len(words) and r.word_chars == len(b"".join(words).decode())
        assert r.n_dup_lines == len(lines) - len(set(lines)), t
        assert r.n_symbols == sum(c in "#*$%&|<>" for c in t or "")
        assert r.n_repeat_words == repeated_by_brute_force(t)
        assert r.base_failed == (len(words) < 10 or 100 * r.n_repeat_words > 20 * len(words))
    assert quality.judge(docs([])).count() == 0


def test_host_verdicts(spark):
    fine = " ".join(f"word{i}" for i in range(30))
    rows = [(i, fine if i % 10 == 0 else "bad", "spam", i) for i in range(100)]
    rows += [(100 + i, fine, "good", 1) for i in range(100)] + [(300, fine, None, 1), (301, "bad", None, 1), (302, fine, "spam", 1)]
    rows += [(400, fine, "new", 1), (401, "bad", "small", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, rate long")
    got = {r.doc_id: r for r in quality.judge(df).collect()}
    assert not any(got[i].kept for i in range(100)) and not got[302].kept
    assert all(got[100 + i].kept for i in range(100)) and got[300].kept and not got[301].kept
    assert got[400].kept and 0 < got[400].host_rate < got[401].host_rate < 1


# ------------------------------------------------------------------ chats


def test_snapshots(spark):
    def log(i, *turns):
        return [(i, k, "user" if k % 2 == 0 else "assistant", t) for k, t in enumerate(turns)]

    rows = log(1, "hi") + log(2, "hi", "hello") + log(3, "hi", "hello", "bye") + log(4, "hi", "hallo")
    rows += log(5, "hi", "hello", "bye") + log(6, "hi", "hello", "bye")[:1] * 2 + [(None, 0, "user", "lost")]
    rows += [(7, 0, None, None)] + [(8, 0, "unknown", "")] + [(9, 10, "user", "hi"), (9, 700, "assistant", "hallo"), (9, 5000, "user", "x")]
    rows += log(10, *[f"t{k}" for k in range(1000)]) + log(11, *[f"t{k}" for k in range(999)])
    rows += [(12, None, "user", "b"), (12, None, "user", "a")]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").withColumn("h", F.lit(1))
    got = collections.defaultdict(list)
    for r in chats.rendered(df).orderBy("conv_id", "position").collect():
        got[r.conv_id].append((r.position, r.n_turns, r.rendered))
    assert sorted(got) == [3, 7, 8, 9, 10, 12]
    assert "".join(x for _, _, x in got[3]) == "<|user|>\nhi<|end|>\n<|assistant|>\nhello<|end|>\n<|user|>\nbye<|end|>\n"
    assert [p for p, _, _ in got[10]] == list(range(1, 1001)) and got[10][0][1] == 1000
    assert got[7] == [(1, 1, "<|unknown|>\n<|end|>\n")] == got[8]
    assert [x for _, _, x in got[12]] == ["<|user|>\na<|end|>\n", "<|user|>\nb<|end|>\n"]
    assert chats.rendered(df.limit(0)).count() == 0


# ------------------------------------------------------------------ segmentations


@pytest.fixture(scope="module")
def vocab():
    import public_tokenizers

    return segments.Vocabulary(public_tokenizers.path("piece_bpe_32k.model"), 0.5)


def all_segmentations(text, vocab):
    surface = {}
    for _, ids in vocab.beginnings.values():
        for i in ids[ids >= 0]:
            surface[vocab.surface[i].decode()] = int(i)
    text = " " + text
    found = {}

    def walk(at, ids, weight):
        if at == len(text):
            found[tuple(ids)] = weight
            return
        for size in range(1, 17):
            piece = text[at : at + size]
            if at + size <= len(text) and piece in surface and (" " not in piece.lstrip(" ")):
                walk(at + size, [*ids, surface[piece]], weight + vocab.weight[surface[piece]])
        if text[at] not in surface:
            own = [int(vocab.bytes[b]) for b in text[at].encode()]
            walk(at + 1, [*ids, *own], weight + vocab.byte_weight * len(own))

    walk(0, [], 0.0)
    total = np.logaddexp.reduce(list(found.values()))
    return {k: v - total for k, v in found.items()}


def test_samples_follow_their_probabilities(vocab):
    text, n, k = "abcd ef", 6000, 3
    want = all_segmentations(text, vocab)
    keys = segments.mix(np.arange(n, dtype=np.uint64))
    samples = list(segments.sample_batch([text] * n, keys, vocab, k))
    first, estimate = collections.Counter(), collections.Counter()
    for found, threshold in samples:
        ids = [tuple(s[0].tolist()) for s in found]
        assert len(set(ids)) == k and set(ids) <= set(want)
        assert found[0][2] >= found[1][2] >= found[2][2] >= threshold
        first[ids[0]] += 1
        for i, (_, log_prob, _) in zip(ids, found):
            assert abs(log_prob - want[i]) < 1e-9
            estimate[i] += math.exp(log_prob) / -math.expm1(-math.exp(log_prob - threshold)) / n
    for ids, log_prob in want.items():
        p = math.exp(log_prob)
        assert abs(first[ids] / n - p) < 5 * math.sqrt(p / n) + 1e-3
        if p > 0.02:  # inclusion scores make samples unbiased
            assert abs(estimate[ids] - p) < 0.15 * p


def test_all_segmentations_of_a_short_text(vocab):
    want = all_segmentations("abc", vocab)
    (found, threshold), = segments.sample_batch(["abc"], np.array([5], np.uint64), vocab, 1000)
    assert threshold == -math.inf and {tuple(s[0].tolist()) for s in found} == set(want)


ODD = ["", " ", "  two   spaces ", "line\n\nline", "▁sign▁", "日本 🙂 \x00", "tab\there", "x" * 3000, "a b " * 3000]


def test_round_trips(docs, vocab):
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    given = [*enumerate(ODD), (None, None), (0, "twice"), (0, "twice")]
    rows = segments.segmentations(docs(given), model, k=3).collect()
    assert all(r.restored and 0 < r.inclusion <= 1 for r in rows)
    texts = dict(given[:9])
    for r in rows:
        if r.doc_id is not None and r.doc_id > 0:
            assert vocab.decode(r.ids) == texts[r.doc_id] and r.n_pieces == len(r.ids)
            assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
    twice = collections.Counter((r.sample, r.ids_crc32) for r in rows if r.doc_id == 0 and r.n_pieces > 1)
    assert twice and set(twice.values()) == {2}
    assert segments.segmentations(docs([]), model).count() == 0


def test_the_query_returns_the_segmentations(spark, docs, vocab, tmp_path):
    from coursegrain.llm.queries import QUERIES

    given = {1: "two words and more", 2: "日本 🙂 ▁", 3: None}
    docs(list(given.items())).write.parquet(f"{tmp_path}/documents.parquet")
    rows = QUERIES["op7_gumbel_segmentations"](spark, str(tmp_path)).collect()
    assert {r.doc_id for r in rows} == {1, 2, 3}
    for r in rows:
        assert vocab.decode(r.ids) == (given[r.doc_id] or "") and r.n_pieces == len(r.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())


def test_one_number_is_mixed_as_many_are():
    keys, places = segments.mix(np.arange(20, dtype=np.uint64)), np.arange(20)
    for salt in (0, 1, 999, 2001):
        many = segments._uniform(keys, places, salt)
        assert [segments._one_uniform(int(k), i, salt) for i, k in enumerate(keys)] == many.tolist()


def test_samples_do_not_depend_on_the_batch(vocab):
    texts = [f"some text number {i} with words" for i in range(50)]
    keys = segments.mix(np.arange(50, dtype=np.uint64))
    together = list(segments.sample_batch(texts, keys, vocab, 2))
    for i in (0, 17, 49):
        (alone, threshold), = segments.sample_batch([texts[i]], keys[i : i + 1], vocab, 2)
        assert threshold == together[i][1]
        assert [s[0].tolist() for s in alone] == [s[0].tolist() for s in together[i][0]]
