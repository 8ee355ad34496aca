"""Near duplicates against all pairs; signatures against the similarity they estimate."""

import random

import numpy as np
import pytest

from llm_cases import corpus, empty, fold, frame, sentence, words
from starmart.llm import components as components_module
from starmart.llm import minhash
from starmart.llm.components import components


def shingles(text, n):
    w = words(fold(text or ""))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def brute(rows, n, percent=80):
    """id -> least id reachable over pairs of similar sets."""
    sets = [(d, shingles(t, n)) for d, t in rows if d is not None]
    parent = {d: d for d, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, sa) in enumerate(sets):
        for b, sb in sets[:i]:
            if sa and sb and 100 * len(sa & sb) >= percent * len(sa | sb):
                ra, rb = find(a), find(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {d: find(d) for d, _ in sets}


def crowd(seed=5):
    """Near copies of one text with many degrees of editing, chains, and a shared passage."""
    rng = random.Random(seed)
    base = sentence(rng, 90, 900).split()
    rows = []
    for i in range(70):
        w = list(base)
        for _ in range(rng.randrange(0, 16)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10_000)}"
        rows.append((100 + i, " ".join(w)))
    chain = list(base[::-1])
    for i in range(12):                                   # each is close to the next only
        rows.append((300 - i, " ".join(chain)))
        for k in range(5):
            chain[(7 * i + k * 9) % len(chain)] = f"c{i}-{k}"
    passage = sentence(rng, 40, 900)
    rows += [(400 + i, f"{sentence(rng, 30, 9000)} {passage}") for i in range(30)]
    return rows


@pytest.mark.parametrize("shingle", [2, 5])
def test_groups_match_all_pairs(spark, shingle):
    rows = corpus() + crowd()
    got = minhash.near_duplicates(frame(spark, rows), shingle=shingle).collect()
    assert len(got) == len(rows)
    want = brute(rows, shingle)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert r.component_id == want[r.doc_id], r
            assert r.kept == (r.doc_id == r.component_id)
    sizes = {}
    for d, t in rows:
        sizes.setdefault(d, set()).add(len(shingles(t, shingle)))
    assert all(r.n_shingles in sizes[r.doc_id] for r in got)


def test_left_over_pairs_alone_find_every_link(spark):
    """Without hub rounds every link comes from the rare-shingle search."""
    rows = crowd(9)
    got = minhash.near_duplicates(frame(spark, rows), shingle=2, hub_rounds=0).collect()
    assert {r.doc_id: r.component_id for r in got} == brute(rows, 2)


def test_empty_tables(spark):
    assert minhash.near_duplicates(empty(spark)).count() == 0
    assert minhash.near_duplicates(frame(spark, [(1, None), (2, ""), (3, " ")])).where("kept").count() == 3


def test_signature_estimates_similarity_and_stops_early():
    rng = np.random.default_rng(1)
    errors = []
    for _ in range(40):
        a = np.unique(rng.integers(1, 2**63, 300).astype(np.uint64))
        b = a.copy()
        b[:60] = rng.integers(1, 2**63, 60).astype(np.uint64)
        s = minhash.superminhash([a, np.unique(b)])
        errors.append((s[0] == s[1]).mean() - 240 / 360)
        rounds = (s >> np.uint64(56)).max()
        assert rounds < 16                                    # far fewer than the 128 places
    assert abs(np.mean(errors)) < 0.02
    # of independent minima the deviation would be sqrt(J (1 - J) / 128) = 0.0417
    assert np.std(errors) < 0.045
    one = minhash.superminhash([np.array([7], np.uint64)])
    assert sorted((one[0] >> np.uint64(56)).tolist()) == list(range(128))  # one place a round
    together = minhash.superminhash([a, b, a])
    assert (together[0] == together[2]).all() and (together[0] == minhash.superminhash([a])[0]).all()


def test_components_of_long_chains(spark):
    rng = random.Random(2)
    ids = list(range(200))
    rng.shuffle(ids)
    links = [(a, b) for a, b in zip(ids, ids[1:])] + [(1000, 1001), (1002, 1001), (5000, 5000)]
    got = {r.id: r.component for r in
           components(spark.createDataFrame(links, "a long, b long").repartition(8)).collect()}
    assert got == {**{i: 0 for i in ids}, 1000: 1000, 1001: 1000, 1002: 1000}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def _chain(order, spark, partitions=200):
    """Components of the path through ``order``, one or a few links a partition; (labels, rounds)."""
    links = list(zip(order, order[1:]))
    df = spark.createDataFrame(links, "a long, b long").repartition(partitions)
    rounds = []
    plain = components_module.written

    def counted(frame, name):
        rounds.append(name)
        return plain(frame, name)

    components_module.written = counted
    try:
        got = {r.id: r.component for r in components(df).collect()}
    finally:
        components_module.written = plain
    return got, rounds.count("labels") - 1


def _two_ended(n):
    """1, n, n-1, ..., 2: labels that fall along the chain one step at a time."""
    return [1, *range(n, 1, -1)]


def _zigzag(n):
    low, high = list(range(n // 2)), list(range(n // 2, n))
    return [x for pair in zip(low, high[::-1]) for x in pair]


@pytest.mark.parametrize("order", ["two_ended", "sorted", "zigzag", "random"])
def test_components_of_long_chains_in_any_order(spark, order):
    n = 1000
    ids = {"two_ended": _two_ended(n), "sorted": list(range(1, n + 1)), "zigzag": [x + 1 for x in _zigzag(n)],
           "random": random.Random(3).sample(range(1, n + 1), n)}[order]
    got, rounds = _chain(ids, spark)
    assert got == {i: 1 for i in range(1, n + 1)}
    assert rounds <= 2 * 10 + 2                              # 2 log2 n, and the round that moves nothing


@pytest.mark.parametrize("hub_rounds", [0, 2])
def test_repeated_ids_with_different_texts(spark, hub_rounds):
    """Rows that repeat an id are documents of their own; links are told by id."""
    rng = random.Random(12)
    rows = []
    for k in range(28):
        base = sentence(rng, 60, 500).split()
        for _ in range(4):
            w = list(base)
            for _ in range(rng.randrange(0, 8)):
                w[rng.randrange(len(w))] = f"e{rng.randrange(9000)}"
            rows.append((rng.randrange(40), " ".join(w)))
    rows += [rows[0], rows[5], (None, rows[3][1])]
    got = minhash.near_duplicates(frame(spark, rows), shingle=2, hub_rounds=hub_rounds).collect()
    want = brute(rows, 2)
    # the rows of one id are one group
    parent = {}
    for d, c in want.items():
        parent[d] = c
    assert len(got) == len(rows)
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == parent
