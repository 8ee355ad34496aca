"""Packing: exact round trip of every id, little padding, the placing rule."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm_cases import corpus, empty, frame
from starmart.llm import packing


def test_ids_equal_the_tokenizers_own():
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    own.encode_special_tokens = True
    texts = [t for _, t in corpus() if t] + [
        "don't  I'LL 's 123½ x² ٣٤ 你好 мир  a b\u0085c\x1cd ​ z\x00", "﻿bom", "<|endoftext|>",
        "a" * 5000, " " * 5000, "\r\n a\r\n\r\n b ", "Œ œ ȿ ɀ"]
    for t in texts:
        assert packing.encode(t) == own.encode(t, add_special_tokens=False).ids
    assert packing.encode(None) == packing.encode("") == []


def test_long_texts_are_encoded_in_parts(monkeypatch):
    text = " ".join(t for _, t in corpus() if t) + "  two  spaces\n and 'll don't 5 a 你好 b"
    monkeypatch.setattr(packing, "PART", 50)
    assert packing.encoded(text).tolist() == [*packing.encode(text), packing.END_ID]
    assert packing.encoded("x" * 200).tolist() == [*packing.encode("x" * 200), packing.END_ID]
    assert packing.encoded(None).tolist() == [packing.END_ID]


def _check(rows, want):
    """rows: pieces; want: ids (with the end id) of every document row."""
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = np.array(r["ids"], dtype="<u4")
        assert len(ids) == r["length"] and zlib.crc32(ids.tobytes()) == r["ids_crc32"]
        sequences[r["sequence_id"]].append(r)
        pieces[r["doc_id"]].append(r)
    padding = 0
    for parts in sequences.values():
        at = 0
        for r in sorted(parts, key=lambda p: p["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert 0 < at <= 2048 and all(r["sequence_tokens"] == at for r in parts)
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    found = {}
    for doc, parts in pieces.items():
        found[doc] = sorted((tuple(p["ids"]), p["start"], p["doc_tokens"]) for p in parts)
    for doc, texts in want.items():
        total = sum(len(t) for t in texts)
        assert sum(len(p[0]) for p in found[doc]) == total
        if len(texts) == 1:
            whole = [0] * total
            for ids, start, n in found[doc]:
                assert n == total
                whole[start:start + len(ids)] = ids
            assert whole == texts[0]
    assert set(found) == set(want)
    return padding


def test_round_trip(spark):
    rows = corpus()
    want = defaultdict(list)
    for doc, text in rows:
        want[doc].append([*packing.encode(text), packing.END_ID])
    for parts in (1, 5):
        got = [r.asDict() for r in packing.pack(frame(spark, rows).repartition(parts)).collect()]
        assert _check(got, want) == 0  # the last windows are cut into powers of two
    assert packing.pack(empty(spark)).count() == 0
    assert "ids" not in packing.pack(empty(spark), keep_ids=False).columns


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60))
def test_placing_keeps_the_sum_of_squares_least(sizes):
    packer = packing.Packer(16, 0)
    for doc, size in enumerate(sizes):
        rest = size % 16
        before = packer.level.copy()
        if rest:
            costs = {}
            for fill in [0, *[h for h in range(1, 16) if before[h] and h + rest <= 16]]:
                after = before.copy()
                if fill:
                    after[fill] -= 1
                if fill + rest < 16:
                    after[fill + rest] += 1
                costs[fill] = int((after[1:16] ** 2).sum())
        list(packer.add(doc, np.arange(size, dtype=np.int32)))
        if rest:
            assert int((packer.level[1:16] ** 2).sum()) == min(costs.values())
        for fill, held in packer.open.items():
            assert len(held) == packer.level[fill]
            assert all(sum(len(p[3]) for p in window) == fill for window in held)
    rows = list(packer.finish())
    sizes_left = defaultdict(int)
    for r in rows:
        sizes_left[r[5]] += r[2]
    loose = [n for n in sizes_left.values() if n < 16]
    assert all(n & (n - 1) == 0 for n in loose) and sum(loose) < 16
