"""Line windows, near copies, repeated byte strings and vectors against brute force."""

from __future__ import annotations

import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from coursegrain.llm import lines, minhash, suffixes, vectors
from coursegrain.llm.common import components


def roots(ids, links):
    up = {i: i for i in ids}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)]
    links += [(300 + i, 301 + i) for i in range(40)]
    ids = [*range(200), *range(300, 341), 999]
    nodes = spark.createDataFrame([(i,) for i in ids], "id long")
    found = components(nodes, spark.createDataFrame(links, "a long, b long"))
    assert {r.id: r.component for r in found.collect()} == roots(ids, links)
    none = components(nodes, spark.createDataFrame([], "a long, b long"))
    assert all(r.id == r.component for r in none.collect())


# ------------------------------------------------------------------ lines


def test_lines_edge_cases(docs):
    block = "one\ntwo\nthree\nfour"
    given = [
        (1, block + "\nown"), (2, "x\n" + block), (3, None), (4, ""), (5, "a\n\n \nb"),
        (6, "p\nq\nr\np\nq\nr\np"), (7, "one\n\ntwo\n \nthree"), (None, block), (None, "z"), (8, "m\nn\no"), (8, "m\nn\no"),
    ]
    frame = docs(given)
    assert lines.drop_repeated_lines(frame).schema == frame.schema
    got = lines.without_repeats(frame).select("row.*", F.col("kept").alias("left"), "n_removed").collect()
    kept = collections.defaultdict(list)
    for r in got:
        kept[r.doc_id].append((r.left, r.n_removed))
    assert len(got) == len(given)
    # NULL ids come first, so theirs is the first occurrence.
    assert sorted(kept[None]) == [(block, 0), ("z", 0)]
    assert kept[1] == [("own", 4)] and kept[2] == [("x", 4)]
    assert kept[3] == [(None, 0)] and kept[4] == [("", 0)] and kept[5] == [("a\n\n \nb", 0)]
    assert kept[6] == [("p\nq\nr", 4)]
    assert kept[7] == [("\n ", 3)]
    assert kept[8] == [("m\nn\no", 0)] * 2
    assert got[0]._text == "x" and got[0].id == -1


def test_lines_empty_table(docs):
    assert lines.drop_repeated_lines(docs([])).count() == 0


# ------------------------------------------------------------------ near copies


def sets_of(texts, width=5):
    out = {}
    for i, t in texts.items():
        w = (t or "").encode().split()
        out[i] = {tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()
    return out


def classes_by_brute_force(texts):
    sets = sets_of(texts)
    ids = sorted(texts)
    links = [
        (a, b)
        for k, a in enumerate(ids)
        for b in ids[k + 1 :]
        if sets[a] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    ]
    return roots(ids, links)


def test_near_classes_of_all_documents(documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    found = {r.doc_id: r.class_id for r in minhash.classified(documents).collect()}
    assert found == classes_by_brute_force(texts)


def test_chains_of_near_copies(docs):
    rng = random.Random(3)
    words = [f"w{rng.randrange(10**6)}" for _ in range(300)]
    texts = {}
    for i in range(40):  # each differs a little from the one before
        texts[i] = " ".join(words)
        words = [*words]
        words[(i * 7) % 300] = f"n{i}"
    texts |= {100: "few words", 101: "few words", 102: "", 103: None, 104: " ".join(words[::-1])}
    found = {r.doc_id: r.class_id for r in minhash.classified(docs(texts.items())).collect()}
    assert found == classes_by_brute_force(texts)
    left = minhash.keep_one(docs([*texts.items(), (0, texts[0]), (None, "y"), (None, "y")]))
    assert sorted(r.doc_id for r in left.collect() if r.doc_id is not None) == [0, 100, 102, 103, 104]
    assert left.where("doc_id IS NULL").count() == 1
    assert minhash.near_classes(docs([])).count() == 0


@pytest.mark.parametrize("block", [512, 16])
def test_hidden_pairs_among_texts_with_one_passage(docs, block):
    """Texts share a passage, 0.78 of their shingles: they meet in bands but do not link.
    Pairs at 0.80 have few bands to themselves."""
    rng = random.Random(8)
    words = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    passage, texts = words(179), {}
    ids = rng.sample(range(10**6), 400)
    for k in range(0, 400, 2):
        both = words(3)
        for i in ids[k : k + 2]:
            if k >= 80:
                both = words(3)
            texts[i] = " ".join([*passage, *both, *words(22)])
    want = classes_by_brute_force(texts)
    assert sum(i != c for i, c in want.items()) == 40
    found = {r.doc_id: r.class_id for r in minhash.classified(docs(texts.items()), block=block).collect()}
    assert found == want


def test_looped_passages(docs):
    """One word is edited and one of the two repeats a passage: sets stay alike, counts do not."""
    rng = random.Random(9)
    texts = {}
    for k in range(0, 60, 2):
        words = [f"w{rng.randrange(10**9)}" for _ in range(150)]
        edited = [*words]
        edited[20] = "edited"
        texts[k], texts[k + 1] = " ".join(words + words[100:] * 40), " ".join(edited + edited[100:])
    found = {r.doc_id: r.class_id for r in minhash.classified(docs(texts.items())).collect()}
    assert found == classes_by_brute_force(texts) == {i: i // 2 * 2 for i in texts}


def test_signatures_estimate_probability_jaccard():
    rng = np.random.default_rng(0)
    element = rng.integers(0, 2**63, 60).astype(np.uint64)
    weight = rng.integers(1, 6, (2, 60)).astype(float)
    weight[0, :15] = weight[1, 45:] = 0
    text = np.repeat([0, 1], 60)
    held = weight.ravel() > 0
    signs = minhash.signatures(text[held], np.tile(element, 2)[held], weight.ravel()[held], 2, 4096)
    p, q = weight
    want = sum(
        1 / np.maximum(p / p[i], q / q[i]).sum() for i in range(60) if p[i] and q[i]
    )
    assert abs((signs[0] == signs[1]).mean() - want) < 0.03


# ------------------------------------------------------------------ byte strings


def test_rows_without_ids_and_shared_ids_are_their_own(docs):
    """Each row is returned; of one id, only rows with one text are one document."""
    long = " ".join(f"w{i}" for i in range(40_000))
    given = [
        (None, "a b c d e f"), (None, "a b c d e f"), (None, "other words than these ones here"), (None, None),
        (7, "first text of this id, six words"), (7, "second one, with nothing in common"), (7, "second one, with nothing in common"),
        (9, "a b c d e f"), (3, long), (4, long + " more"), (5, ""),
    ]
    found = minhash.classified(docs(given)).collect()
    assert len(found) == len(given)
    assert sorted(r.doc_id or -1 for r in found) == sorted(i or -1 for i, _ in given)
    assert [(r.class_id, r.kept) for r in found if r.doc_id == 9] == [(9, True)]
    assert [r.class_id == 9 and not r.kept for r in found if r.doc_id is None].count(True) == 2
    assert sorted((r.class_id, r.kept) for r in found if r.doc_id == 7) == [(7, True)] * 3
    assert {r.class_id for r in found if r.doc_id in (3, 4)} == {3}
    left = collections.Counter((r.doc_id, r.text) for r in minhash.keep_one(docs(given)).collect())
    want = {*given} - {(None, "a b c d e f"), (4, long + " more")}
    assert left == collections.Counter(want)


def cut_by_brute_force(bodies, length):
    count = collections.Counter(b[k : k + length] for b in bodies for k in range(len(b) - length + 1))
    out = []
    for b in bodies:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if count[b[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        spans = sum(1 for k in range(len(b)) if gone[k] and not (k and gone[k - 1]))
        out.append((len(b), sum(gone), spans, bytes(x for x, y in zip(b, gone) if not y)))
    return out


def compared(df, given, length, **options):
    got = suffixes.cut_repeats(df, length=length, **options).select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept").collect()
    want = cut_by_brute_force([(t or "").encode() for _, t in given], length)
    key = lambda r: (str(r[0]), *r[1:])
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept or b"")) for r in got), key=key) == sorted(
        ((i, *w) for (i, _), w in zip(given, want)), key=key
    )


def test_repeats_in_all_documents(documents):
    compared(documents, [(r.doc_id, r.text) for r in documents.collect()], 400)


@pytest.mark.parametrize("group", [2000, 1])
@pytest.mark.parametrize("seed", range(2))
def test_repeats_in_small_texts(docs, seed, group):
    rng = random.Random(seed)
    text = lambda n, letters="ab": "".join(rng.choice(letters) for _ in range(n))
    parts = [text(30, "abcd") for _ in range(6)]
    given = [(i, text(40, "abcdefgh") + rng.choice(parts) + text(20, "abcd") + rng.choice(parts)[: rng.randrange(30)]) for i in range(40)]
    given += [(50, "a" * 100), (51, "ab" * 40), (52, None), (53, ""), (54, "é" * 30), (None, parts[0] + "z"), (55, "q" * 5), (55, "same words here again"), (55, "same words here again")]
    compared(docs(given), given, 16, group=group)


def test_kept_text_and_columns(docs):
    left = suffixes.keep_unrepeated(docs([(1, "x" * 20 + "own"), (2, "other" + "x" * 20), (3, None)]), length=18)
    assert sorted((r.doc_id, r.text, r._text, r.id) for r in left.collect()) == [
        (1, "own", "x", -1), (2, "other", "x", -1), (3, None, "x", -1),
    ]
    assert suffixes.cut_repeats(docs([])).count() == 0


def test_suffix_mergesort():
    rng = np.random.default_rng(2)
    data = rng.integers(97, 99, 400).astype(np.uint8)
    start = np.sort(rng.choice(380, 150, replace=False))
    end = np.minimum(start + 20, 400)
    group = rng.integers(0, 3, 150)
    order = suffixes.Suffixes(data, start, end, group).sorted()
    keys = [(group[i], data[start[i] : end[i]].tobytes()) for i in order]
    assert sorted(order) == list(range(150)) and keys == sorted(keys)


def test_a_misleading_hash_is_found_out(monkeypatch):
    monkeypatch.setattr(suffixes.Prefixes, "raw", lambda self, a, b: (b - a).astype(np.uint64))
    before, group = np.array([0, 0, 0]), np.zeros(3, np.int64)
    who, window = suffixes.repeated_windows([b"abcdx", b"abcdy", b"zbcdx"], before, group, 4)
    assert sorted(zip(who.tolist(), window.tolist())) == [(0, 0), (1, 0)]


# ------------------------------------------------------------------ vectors


def links_by_brute_force(rows, cosine=0.98):
    ok = [
        (k, i, label, np.array(v, float))
        for k, (i, v, label) in enumerate(rows)
        if label is not None and v is not None and None not in v and np.isfinite(np.array(v, float)).all() and np.any(np.array(v, float))
    ]
    count, links = collections.Counter(), []
    for n, (j, a, la, x) in enumerate(ok):
        for k, b, lb, y in ok[n + 1 :]:
            if la == lb and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= cosine:
                count[j] += 1
                count[k] += 1
                links.append((a, b))
    return count, links


def test_vectors(spark):
    rng = np.random.default_rng(4)
    rows = []
    for c in range(12):
        centre = rng.standard_normal(16)
        for _ in range(10):
            rows.append((len(rows), (centre + rng.standard_normal(16) * 0.04).astype(np.float32).tolist(), int(c % 3)))
    rows += [(500 + k, rows[0][1], 0) for k in range(5)]
    nan, inf = float("nan"), float("inf")
    rows += [(600, None, 1), (601, [], 1), (602, [0.0] * 16, 1), (603, [nan] * 16, 1), (604, [inf] + [1.0] * 15, 1), (605, [None] + [1.0] * 15, 1), (606, rows[0][1], None), (607, rows[0][1][:8], 0), (608, (np.array(rows[0][1]) * 3).tolist(), 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    stored = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    count, links = links_by_brute_force(stored)
    want = roots([i for i, _, _ in rows], links)
    for block in (512, 4):
        found = {r.vec_id: r for r in vectors.near_vectors(df, block=block).collect()}
        assert len(found) == len(rows)
        got = sum(r.n_links for r in found.values())
        assert 0.95 * sum(count.values()) <= got <= sum(count.values())
        assert all(found[rows[k][0]].n_links <= count[k] for k in range(len(rows)))
        assert {i: r.component_id for i, r in found.items()} == want
        assert all(r.kept == (r.vec_id == r.component_id) for r in found.values())


def test_no_vectors(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert vectors.near_vectors(none).count() == 0


def test_block_counts_a_pair_once(spark):
    base = np.random.default_rng(1).standard_normal(8)
    rows = [(i, (base + 1e-3 * i).tolist(), 1) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = vectors.near_vectors(df, block=7).collect()
    assert all(r.n_links == 29 and r.component_id == 0 for r in found)


def test_sha_of_the_query(spark, documents):
    from coursegrain.llm.queries import QUERIES

    row = QUERIES["op3_suffix_dedup"](spark, "/root/testdata/sf0.001").where("n_removed = 0").first()
    text = documents.where(f"doc_id = {row.doc_id}").first().text
    assert row.kept_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_the_query_returns_what_is_left(spark, tmp_path):
    from coursegrain.llm.queries import QUERIES

    long, short = ("".join(chr(97 + (i * i // k) % 26) for i in range(n)) for k, n in ((7, 450), (11, 380)))
    rows = [(0, f"one {long} end"), (1, f"two {long} tail"), (2, f"three {short}"), (3, f"four {short}"), (4, None), (5, "é")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in QUERIES["op3_suffix_dedup"](spark, str(tmp_path)).collect()}
    assert not got[0].text.count(long[:400]) and not got[1].text.count(long[:400])
    assert got[0].text.startswith("one") and got[1].text.endswith("tail")
    # Repeats of under 400 bytes stay, by contract.
    assert [got[i].text for i in (2, 3)] == [rows[2][1], rows[3][1]]
    assert got[5].text == "é" and not got[4].text
    for r in got.values():
        text = r.text or ""
        assert r.kept_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert len(text.encode()) == r.n_bytes - r.n_removed
