"""Mixing: targets, apportionment against the plain method, bounds of what is taken."""

import random
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from llm_cases import empty, frame, sentence, words
from starmart.llm import mixing


def plain_targets(sizes, weights=(5, 2, 1), top=3):
    """Share by weight, stop at the limit, share what is above again."""
    names = sorted([s for s in sizes if s is not None], key=lambda s: s.encode()) + \
        ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    open_, left, target = set(names), float(sum(sizes.values())), {}
    while open_:
        unit = left / sum(w[s] for s in open_)
        over = [s for s in open_ if unit * w[s] > top * sizes[s]]
        if not over:
            target.update({s: unit * w[s] for s in open_})
            break
        for s in over:
            target[s] = float(top * sizes[s])
            left -= target[s]
            open_.discard(s)
    return target


def plain_seats(votes, n):
    seats = [0] * len(votes)
    for _ in range(n):
        best = max(range(len(votes)), key=lambda i: (votes[i] / (2 * seats[i] + 1), -i))
        seats[best] += 1
    return seats


def rows(seed=1, sizes=(400, 30, 900, 10, 0, 250)):
    rng = random.Random(seed)
    out, doc = [], 0
    for k, size in enumerate(sizes):
        name = f"s{k}" if k != 3 else None
        for _ in range(6):
            out.append((doc, sentence(rng, size // 6), "en", name))
            doc += 1
    out += [(doc, None, "en", "s0"), (None, "no id here", "en", "s0"), (2, "same id twice", None, "s0"),
            (2, "same id twice", None, "s0"), (doc + 1, "", None, None), (doc + 2, "long " * 3000, "en", "ä")]
    return out


def test_targets_and_taken(spark):
    data = rows()
    got = mixing.mix(frame(spark, data), shard_scale=5).collect()
    assert len(got) == len(data)
    sizes, taken = defaultdict(int), defaultdict(int)
    for _, t, _, s in data:
        sizes[s] += len(words(t))
    want = plain_targets(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source], rel=1e-12)
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 2 * mixing.BLOCK_WORDS + 0.02 * want[s], s
    key = lambda r: (str(r.doc_id), r.size, r.taken)
    again = mixing.mix(frame(spark, data).repartition(7), shard_scale=5).collect()
    assert sorted(map(key, got)) == sorted(map(key, again))  # reruns agree
    assert {r.size for r in got if r.doc_id is None} == {3}


def test_empty_tables(spark):
    assert mixing.mix(empty(spark)).count() == 0
    got = mixing.mix(frame(spark, [(1, None), (2, "")])).collect()
    assert [(r.size, r.target, r.taken) for r in got] == [(0, 0.0, 0)] * 2


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 60), min_size=1, max_size=7), st.integers(0, 90))
def test_seats_follow_the_highest_quotients(spark, votes, n):
    n = n if sum(votes) else 0
    parties = spark.createDataFrame([(1, i, float(v), n) for i, v in enumerate(votes)],
                                    "g int, place long, votes double, seats long")
    got = mixing.sainte_lague(parties, ["g"], "place", "votes", "seats").orderBy("place").collect()
    assert [r.won for r in got] == plain_seats(votes, n)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.sampled_from(["a", "b", "Z", "é", "你", "a1", None]), st.integers(0, 5000),
                       min_size=1, max_size=7))
def test_targets_stop_at_their_limits(spark, sizes):
    df = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    want = plain_targets(sizes)
    if sum(sizes.values()):
        assert got == pytest.approx(want, rel=1e-9, abs=1e-6)
        assert sum(got.values()) == pytest.approx(sum(sizes.values()))
    else:
        assert set(got.values()) <= {0.0, None}
