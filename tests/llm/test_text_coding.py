"""Rank queries, merges and rotations, on their own."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from shelflake.llm import fill_in_middle, sentence_pieces, whitening

# --- fill in middle --------------------------------------------------------------


@given(st.lists(st.integers(0, 7), max_size=300))
@settings(max_examples=60, deadline=None)
def test_ranks(symbols):
    matrix = fill_in_middle.WaveletMatrix(np.array(symbols, np.uint8), 3)
    places = np.arange(len(symbols) + 1)
    for symbol in range(8):
        expected = [sum(s == symbol for s in symbols[:k]) for k in places]
        assert matrix.rank(symbol, places).tolist() == expected


@given(st.lists(st.text("abZ1 é😀\n<", max_size=90), max_size=6))
@settings(max_examples=100, deadline=None)
def test_borders(texts):
    borders = fill_in_middle.Borders(texts)
    units = [re.findall("[A-Za-z]+|[^A-Za-z]", t) for t in texts]
    assert borders.tokens().tolist() == [len(u) for u in units]
    for part in range(5):
        wanted = [len(u) * part // 4 for u in units]
        places = borders.places(np.array(wanted, np.int64)).tolist()
        assert places == [len("".join(u[:k])) for u, k in zip(units, wanted)]


# --- pieces ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=sentence_pieces.MODEL)


@pytest.fixture
def coder():
    return sentence_pieces.Coder(sentence_pieces.MODEL)


def same(coder, library, texts):
    expected = [[*ids, library.eos_id()] for ids in library.encode(texts)]
    ids, counts = coder.encode(texts)
    assert counts.tolist() == [len(e) for e in expected]
    assert ids.tolist() == [i for e in expected for i in e]
    assert coder.decode(ids, counts) == [library.decode(e) for e in expected]
    assert coder.written(ids, counts) == [" ".join(map(str, e)).encode() for e in expected]


def decoded(coder, lists):
    return coder.decode(np.array([i for ids in lists for i in ids], np.int64), np.array([len(ids) for ids in lists], np.int64))


ALPHABETS = ("thean inor ", "  \n\t", "▁ a▁b", "0123456789 ab", "日本語の 한글é😀", "aaaaab ", "\x00 x</s><s><unk>")


@pytest.mark.parametrize("queue_from", [1, 3, 512])
def test_encoding_as_the_library(monkeypatch, coder, library, queue_from):
    """All runs through the queue, only long ones, and hardly any."""
    monkeypatch.setattr(sentence_pieces, "QUEUE_FROM", queue_from)
    source = random.Random(queue_from)
    for alphabet in ALPHABETS:
        sizes = source.choices((0, 1, 2, 5, 20, 200, 1000), k=60)
        same(coder, library, ["".join(source.choices(alphabet, k=k)) for k in sizes])
    pieces = [library.id_to_piece(i) for i in range(259, library.vocab_size())]
    joined = ("".join(source.choices(pieces, k=source.randint(1, 30))) for _ in range(1000))
    same(coder, library, [t.replace("▁", source.choice(("", " ", "▁"))) for t in joined])


@given(st.lists(st.text(max_size=60), max_size=5))
@settings(max_examples=100, deadline=None)
def test_any_text(texts):
    coder = sentence_pieces.coder(sentence_pieces.MODEL)
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    same(coder, sentencepiece.SentencePieceProcessor(model_file=sentence_pieces.MODEL), texts)


@pytest.mark.parametrize(
    "text", [" " * 100_000, "a" * 100_000, "0" * 100_000, "日本語" * 30_000, "\n" * 100_000, "x = y;  " * 20_000]
)
def test_long_runs(coder, library, text):
    same(coder, library, [text])


def test_stretches_of_a_long_text(monkeypatch, coder, library):
    monkeypatch.setattr(sentence_pieces, "PIECE_CHARS", 50)
    same(coder, library, ["   some  words and\n more   " * 40, " ", "x" * 200 + "   y"])


def test_forgotten_words(monkeypatch, coder, library):
    monkeypatch.setattr(sentence_pieces, "KNOWN_WORDS", 3)
    for _ in range(2):
        same(coder, library, ["one two three four five six", "six five seven"])


def test_decoding_any_ids(coder, library):
    source = random.Random(4)
    lists = [
        [source.randrange(32_000) if source.random() < 0.5 else source.randrange(300) for _ in range(source.choice((0, 1, 2, 5, 30)))]
        for _ in range(2000)
    ]
    assert decoded(coder, lists) == [library.decode(ids) for ids in lists]
    assert decoded(coder, [[3 + 0xE2] * 200_000])[0] == "�" * 200_000
    assert decoded(coder, []) == []


@given(st.dictionaries(st.integers(0, 2**40), st.integers(0, 9), max_size=200), st.lists(st.integers(0, 2**40)))
@settings(max_examples=60, deadline=None)
def test_table(entries, others):
    keys = np.array(list(entries), np.int64)
    made = sentence_pieces.Table(keys, np.array(list(entries.values()), np.int64))
    wanted = np.array([*entries, *others], np.int64)
    assert made.find(wanted).tolist() == [entries.get(int(k), -1) for k in wanted]


def test_models_of_other_kinds_are_refused(tmp_path):
    with open(sentence_pieces.MODEL, "rb") as file:
        data = file.read()
    # A further piece, of the user's own kind.
    path = tmp_path / "own.model"
    path.write_bytes(data + b"\x0a\x05\x0a\x01q\x18\x04")
    with pytest.raises(ValueError, match="byte-fallback"):
        sentence_pieces.Model(str(path))


# --- whitening ---------------------------------------------------------------------


@pytest.mark.parametrize("size, rank", [(1, 1), (2, 2), (5, 3), (16, 16), (33, 20), (64, 64), (7, 0)])
def test_eigen(size, rank):
    source = np.random.default_rng(size)
    spread = source.normal(size=(size, rank)) * np.logspace(0, -5, max(rank, 1))[:rank]
    matrix = spread @ spread.T
    values, vectors = whitening.eigen(matrix)
    assert len(values) == rank
    expected = np.linalg.eigvalsh(matrix)[::-1][:rank]
    assert np.allclose(values, expected, rtol=1e-6, atol=1e-14 * (expected.max(initial=0) or 1))
    assert np.allclose(vectors.T @ vectors, np.eye(rank), atol=1e-12)
    assert np.allclose(vectors * values @ vectors.T, matrix, atol=1e-13 * (np.abs(matrix).max() or 1))


def test_pivoted_cholesky():
    source = np.random.default_rng(1)
    spread = source.normal(size=(9, 4))
    factor, order = whitening.pivoted_cholesky(spread @ spread.T)
    assert factor.shape == (9, 4)
    assert np.allclose(np.tril(factor), factor)
    assert np.allclose(factor @ factor.T, (spread @ spread.T)[np.ix_(order, order)])


@pytest.mark.parametrize("size", range(1, 9))
def test_rounds_pair_all_columns_once(size):
    pairs = []
    for one, two in whitening._rounds(size):
        assert len(set(one.tolist() + two.tolist())) == 2 * len(one)
        pairs += [frozenset(p) for p in zip(one.tolist(), two.tolist())]
    assert sorted(map(sorted, pairs)) == [[a, b] for a in range(size) for b in range(a + 1, size)]


def test_exact_offsets_beyond_a_long():
    x = np.array([[2**62, 3], [1, 2]], np.int64)
    off = whitening.off_mean(x, 7, [2**62 + 1, 5])
    assert off.tolist() == [[7 * 2**62 - 2**62 - 1, 16], [7 - 2**62 - 1, 9]]
    assert whitening.deviations(off) == [None, None]
    small = whitening.off_mean(np.array([[5, 3], [1, 2]], np.int64), 2, [6, 5])
    assert whitening.deviations(small) == [17, 17]
