import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mediasignal.llm import packing, token_counts
from mediasignal.llm.tokens import word_encoder

P = pytest.importorskip("public_tokenizers")
WORDS, PIECES = P.path("word_bpe_49k.json"), P.path("piece_bpe_32k.model")


def library(text):
    return word_encoder(WORDS).whole.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("abcdefgthinREST019 .,;'\"#<|>_-\n\té ßÄçñ°²İΣςﬁ\u0301\xa0\x1c中😀"), max_size=60))
def test_ids_equal_the_library(text):
    assert np.frombuffer(word_encoder(WORDS).encode(text.encode()), dtype="<u2").tolist() == library(text)


@pytest.mark.parametrize("text", ["", "don't we'll", "a<|endoftext|>b c<|startoftext|>", "THE ÉCOLE naïve x" * 50, "x" * 5000,
                                  "internationalization antidisestablishmentarianism", "12345 3.14 a1b2", "\x00\x01 \ufeff"])
def test_ids_of_odd_texts(text):
    assert np.frombuffer(word_encoder(WORDS).encode(text.encode()), dtype="<u2").tolist() == library(text)


def test_hilbert_curve_is_one_path():
    grid = np.array([[x, y] for x in range(16) for y in range(16)])
    keys = packing.hilbert_keys(grid, 4)
    assert sorted(keys) == list(range(256))
    steps = np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(axis=1)
    assert (steps == 1).all()


def check_pieces(rows, texts):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(texts)
    for doc_id, pieces in by_doc.items():
        ids = np.array(library(texts[doc_id] or "") + [2], dtype="<u4")
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == 4096 or at & (at - 1) == 0


@pytest.mark.parametrize("task_ids", [3000, 8_000_000])
def test_pieces(make_docs, task_ids):
    texts = {i: " ".join(f"word{i * k % 11}" for k in range(i * 37 % 1500)) for i in range(60)} | {100: None, 101: "long " * 30_000}
    check_pieces(packing.packed(make_docs(*texts.items()), WORDS, task_ids).collect(), texts)


def test_odd_packing_inputs(odd_docs):
    rows = packing.packed(odd_docs, WORDS).collect()
    first = [r for r in rows if r.start == 0]
    assert len(first) == odd_docs.count() and sum(r.length for r in rows) == sum(r.doc_tokens for r in first)
    assert packing.packed(odd_docs.limit(0), WORDS).count() == 0


@pytest.mark.parametrize("chunk, overlap", [(32_768, 512), (300, 20), (50, 1), (64, 0)])
def test_counts_equal_the_library(make_docs, odd_docs, chunk, overlap):
    model = token_counts.load(PIECES).model
    rows = [(1, "a" * 3000), (2, "é中" * 900 + "  " * 100), (3, " " * 2000), (4, "tab\tline\n" * 300), (5, "x y" * 500), (6, "▁" * 400 + " ▁ a")]
    if chunk < 1000:  # thousands of chunks of one text would only take time
        odd_docs = odd_docs.where("text is null or length(text) < 5000")
    for docs in (make_docs(*rows), odd_docs, odd_docs.limit(0)):
        got = token_counts.token_counts(docs, PIECES, chunk=chunk, overlap=overlap)
        assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
        want = [(d, len((t or "").encode()), n := len(model.encode(t or "")), n > 4096) for d, t in docs.select("doc_id", "text").collect()]
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


@pytest.mark.parametrize("chunk, overlap, fan", [(5, 2, 2), (5, 7, 2), (7, 0, 3), (1000, 10, 64), (1 << 29, 512, 64)])
def test_chunks_follow_one_another(make_docs, monkeypatch, chunk, overlap, fan):
    monkeypatch.setattr(token_counts, "FAN", fan)
    texts = {1: "x", 2: "ab😀d" * 5, 3: "".join(map(chr, range(0x4E00, 0x4E00 + 231)))}
    docs = make_docs(*texts.items()).select(F.col("doc_id").alias("row"), "text")
    got = token_counts._chunks(docs, chunk, overlap).collect()
    for row, text in texts.items():
        want = [(text[i:i + chunk + overlap], i == 0, i + chunk >= len(text)) for i in range(0, len(text), chunk)]
        assert sorted((r.part, r.first, r.last) for r in got if r.row == row) == sorted(want)


def test_misaligned_chunks_are_told():
    model = token_counts.load(PIECES)
    assert model.chunk("a" * 40, True, False, 20) == -1
    assert model.chunk("ab cd ef gh", True, False, 4) == len(model.model.encode("ab cd"))
