"""Word positions, hashes and anchors against plain Python."""

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_cases import fold, words
from starmart.llm import text as T

ALPHABET = st.text(alphabet="ab AZ\t\n\x0b\x1c\x85é你", max_size=40)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), ALPHABET), max_size=6))
def test_words_match_the_pattern(texts):
    w = T.words(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        got = [bytes(w.data[a:b]).decode() for a, b in zip(w.start[w.first[i]:w.first[i + 1]],
                                                          w.end[w.first[i]:w.first[i + 1]])]
        assert got == words(t)


@settings(max_examples=100, deadline=None)
@given(st.lists(ALPHABET, min_size=1, max_size=6))
def test_equal_words_have_equal_hashes(texts):
    for low in (False, True):
        w = T.words(pa.array(texts), fold=low)
        flat = [fold(x) if low else x for t in texts for x in words(t)]
        by_hash = {}
        for x, h in zip(flat, w.hash.tolist()):
            assert by_hash.setdefault(h, x) == x
        assert len(set(flat)) == len(by_hash)


def test_slices_cover_the_batch_and_long_segments_hash_alike(monkeypatch):
    texts = ["x" * 50, None, "", "a b " * 100, "y"]
    batch = pa.record_batch({"text": pa.array(texts)})
    parts = list(T.slices(batch, limit=60))
    assert [t for p in parts for t in p.column(0).to_pylist()] == texts
    whole = T.words(pa.array(texts))
    monkeypatch.setattr(T, "SEGMENT", 64)
    T._powers.cache_clear()
    small = T.words(pa.array(texts))
    assert (whole.hash == small.hash).all()
    assert (T.grams(whole.hash, whole.row, 3)[0] == T.grams(small.hash, small.row, 3)[0]).all()
    T._powers.cache_clear()


def test_anchors_are_the_minima_of_windows():
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 9, n)) for n in (0, 3, 30, 12, 60)]
    w = T.words(pa.array(texts))
    g, _ = T.grams(w.hash, w.row, 3)
    want = set()
    for i in range(len(w.hash) - 9):
        if w.row[i] == w.row[i + 9]:
            part = g[i:i + 8]
            want |= {i + j for j in range(8) if part[j] == part.min()}
    assert want == set(T.anchor_positions(w.hash, w.row, 10, 3).tolist())
    none = T.words(pa.array([], pa.string()))
    assert not len(T.anchor_positions(none.hash, none.row, 10, 3))
