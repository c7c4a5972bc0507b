from __future__ import annotations

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from coursegrain.llm import packing


def brute_pieces(text, tokenizer, capacity):
    ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
    cut = len(ids) % capacity if len(ids) > capacity else len(ids)
    bounds = [0, *([cut] if cut else []), *range(cut + capacity, len(ids) + 1, capacity)]
    return [
        (i, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))
        for i, (a, b) in enumerate(zip(bounds, bounds[1:]))
    ]


def checked(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in by.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return by


def test_pieces_and_sequences_of_all_documents(documents, vocabulary):
    rows = packing.pack_documents(documents, **vocabulary).collect()
    tokenizer = Tokenizer.from_file(vocabulary["tokenizer"])
    texts = {r.doc_id: r.text for r in documents.collect()}
    found = {}
    for r in rows:
        found.setdefault(r.doc_id, []).append((r.piece, r.start, r.length, r.ids_crc32))
    assert {k: sorted(v) for k, v in found.items()} == {
        k: brute_pieces(t, tokenizer, 2048) for k, t in texts.items()
    }
    sequences = checked(rows, 2048)
    assert len(sequences) <= -(-sum(r.length for r in rows) // 2048) + 1


ODD = [
    "", " ", "a", "  two  spaces ", "tab\tand\nnewline \n end", "x" * 5000, "<|endoftext|> in text",
    "non breaking 　 wide", "日本語 テキスト 🙂", "it's we'll", "word " * 3000, "\n\n \n", "trailing ",
]


def test_odd_texts(docs, vocabulary):
    given = [(i, t) for i, t in enumerate(ODD)] + [(None, None), (3, ODD[3]), (3, "other")]
    rows = packing.pack_documents(docs(given), **vocabulary).collect()
    tokenizer = Tokenizer.from_file(vocabulary["tokenizer"])
    want = sorted(
        (-1 if i is None else i, *p) for i, t in given for p in brute_pieces(t, tokenizer, 2048)
    )
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    assert got == want
    checked(rows, 2048)


def test_without_the_fast_library(docs, vocabulary):
    one = packing.token_pieces(docs(enumerate(ODD)), vocabulary["tokenizer"]).collect()
    two = packing.token_pieces(docs(enumerate(ODD)), **vocabulary).collect()
    assert sorted(one) == sorted(two)


def test_empty_table(docs, vocabulary):
    assert packing.pack_documents(docs([]), **vocabulary).count() == 0


def test_local_search_empties_a_bin():
    # Best fit leaves three bins; one exchange makes two of them do.
    lengths = np.array([6, 5, 5, 4, 4, 3, 3])
    bin_of = np.array([0, 1, 2, 0, 1, 2, 3])
    fill = np.bincount(bin_of, lengths).astype(np.int64)
    assert packing.improve(lengths, bin_of, fill, 10) == 1
    assert fill.max() <= 10 and (fill > 0).sum() == 3


@pytest.mark.parametrize("seed", range(5))
def test_search_keeps_every_document(seed):
    lengths = np.random.default_rng(seed).integers(1, 100, 400)
    bin_of, fill = packing.best_fit(lengths, 100)
    before = (fill > 0).sum()
    packing.improve(lengths, bin_of, fill, 100)
    assert (np.bincount(bin_of, lengths, len(fill)) == fill).all() and fill.max() <= 100
    assert -(-lengths.sum() // 100) <= (fill > 0).sum() <= before


def test_groups(docs, vocabulary):
    given = docs([(i, "word " * (1 + i % 40)) for i in range(200)])
    rows = packing.pack_documents(given, **vocabulary, capacity=64, group=20).collect()
    assert len({r.doc_id for r in rows}) == 200
    checked(rows, 64)
