"""Toxicity: held-out accuracy, FTRL against a plain loop, edge cases."""

import binascii
import hashlib
import math
import random

import numpy as np
import pyarrow as pa
from llm_cases import corpus, empty, frame, sentence

from starmart.llm import toxicity as X
from starmart.llm.tables import first_by_hash

KIND = "doc_id long, quality int, toxic int"
BAD = ["grobian", "vollpfosten", "lump", "schuft"]


def _held(i):
    return binascii.crc32(str(i if i is not None else "").encode()) % 4 == 2


def labelled(n=800):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(n):
        words = sentence(rng, rng.randrange(5, 400), 900).split()
        bad = i % 5 == 0
        for _ in range(rng.randrange(2, 5) if bad else 0):
            words.insert(rng.randrange(len(words)), rng.choice(BAD).upper() + rng.choice([",", "!", ""]))
        rows.append((i, " ".join(words)))
        labels.append((i, 0, int(bad)))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = labelled()
    lab = spark.createDataFrame(labels + [(1, 0, None), (None, 0, 1)], KIND)
    got = X.toxicity(frame(spark, rows + corpus()[-9:]), lab).collect()
    truth = {d: t for d, _, t in labels}
    tested = [r for r in got if r.held_out and r.doc_id in truth and r.doc_id < 800]
    assert len(tested) > 100
    assert np.mean([r.predicted == truth[r.doc_id] for r in tested]) >= 0.97
    for r in got:
        assert r.held_out == _held(r.doc_id)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)


def test_held_out_labels_and_other_columns_do_not_matter(spark):
    rows, labels = labelled(200)
    flipped = [(d, q, 1 - t if _held(d) else t) for d, q, t in labels]
    other = [(d, t, f"l{d % 3}", f"s{d}") for d, t in rows]
    a, b = ({r.doc_id: r.score for r in X.toxicity(frame(spark, x), spark.createDataFrame(y, KIND)).collect()}
            for x, y in ((rows, labels), (other, flipped)))
    assert a == b


def test_ftrl_is_the_published_update():
    rng = np.random.default_rng(1)
    model, z, n = X.Ftrl(8), [0.0] * 9, [0.0] * 9

    def weight(i):
        l1 = X.L1 if i < 8 else 0.0
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) / ((X.BETA + math.sqrt(n[i])) / X.ALPHA + X.L2)

    for _ in range(300):
        places = np.flatnonzero(rng.random(8) < 0.4)
        y = float(0 in places or rng.random() < 0.1)
        model.learn(places, y)
        on = [*places.tolist(), 8]
        w = {i: weight(i) for i in on}
        g = 1 / (1 + math.exp(-sum(w.values()))) - y
        for i in on:
            z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / X.ALPHA * w[i]
            n[i] += g * g
    assert np.allclose(model.z, z) and np.allclose(model.n, n)
    found = model.weights()
    assert 0 in found.place and len(found.place) < 8         # L1 leaves weights at nought


def test_places_against_plain_pairs():
    texts = ["A b c,d", "", None, "a B c d", "d c b a", "x", "é ß"]
    row, place = X._once(*X.places(pa.array(texts)))
    sets = [set(place[row == i].tolist()) for i in range(len(texts))]
    # words, neighbours, one and two between
    assert [len(s) for s in sets] == [4 + 3 + 2 + 1, 0, 0, 10, 10, 1, 3]
    assert sets[0] == sets[3] and len(sets[0] & sets[4]) == 4   # only the words: order counts in pairs
    for i, t in enumerate(texts):
        alone = X._once(*X.places(pa.array([t], pa.string())))[1]
        assert set(alone.tolist()) == sets[i]


def test_sample_bounds(spark):
    rows, labels = labelled(300)
    lab, docs = spark.createDataFrame(labels, KIND), frame(spark, rows + rows[:40] * 3)
    ids = lab.selectExpr("cast(doc_id as string) id", "toxic y")
    first = [r.id for r in first_by_hash(ids, "id", 20).collect()]
    want = sorted((str(d) for d, _, _ in labels), key=lambda i: hashlib.md5(i.encode()).hexdigest())[:20]
    assert sorted(first) == sorted(want)
    some = X.train(docs, lab, max_train=20)
    one = X.train(docs, lab, max_bytes=1)        # a single text is always learnt from
    all_ = X.train(docs, lab)
    assert len(one.place) <= len(all_.place) and some.bias != all_.bias
    again = X.train(docs.repartition(7), lab.repartition(5))
    assert again.bias == all_.bias and (again.place == all_.place).all() and (again.weight == all_.weight).all()


def test_empty_and_unlabelled(spark):
    none = spark.createDataFrame([], KIND)
    assert {r.score for r in X.toxicity(frame(spark, corpus()), none).collect()} == {0.5}
    assert X.toxicity(empty(spark), none).count() == 0
    some = spark.createDataFrame([(1, 0, 1)], KIND)
    assert X.toxicity(empty(spark), some).count() == 0
