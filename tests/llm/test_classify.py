"""Classifier: held-out accuracy, additive scoring, edge cases."""

import binascii
import random

import numpy as np
import pyarrow as pa

from llm_cases import corpus, empty, frame, sentence
from starmart.llm import classify as C


def labelled(n=240):
    rng = random.Random(11)
    rows, labels = [], []
    for i in range(n):
        text = "\n".join(sentence(rng, rng.randrange(20, 60)).capitalize() + "." for _ in range(3))
        kind = i % 6
        if kind == 0:
            text = " ".join(w.upper() + "!!" for w in text.split())
        elif kind == 1:
            text = " ".join(w + rng.choice(["%%%", "###", "$$$"]) for w in text.split())
        elif kind == 2:
            text = " ".join(w for w in text.split()[:8] for _ in range(12))
        rows.append((i, text))
        labels.append((i, int(kind > 2), 0))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = labelled()
    lab = spark.createDataFrame(labels + [(0, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = C.classify(frame(spark, rows + corpus()[-8:]), lab).collect()
    truth = {d: q for d, q, _ in labels}
    tested = [r for r in got if r.held_out and r.doc_id in truth and r.doc_id < 240]
    assert len(tested) > 50
    assert np.mean([r.predicted == truth[r.doc_id] for r in tested]) >= 0.95
    for r in got:
        assert r.held_out == (binascii.crc32(str(r.doc_id if r.doc_id is not None else "").encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    kept = C.keep_good(frame(spark, rows), lab)
    assert kept.columns == frame(spark, rows).columns
    want = {r.doc_id for r in got if r.predicted == 1 and r.doc_id is not None and r.doc_id < 240}
    assert {r.doc_id for r in kept.collect()} == want


def test_held_out_labels_do_not_matter(spark):
    rows, labels = labelled(120)
    flipped = [(d, 1 - q if binascii.crc32(str(d).encode()) % 3 == 1 else q, t) for d, q, t in labels]
    kind = "doc_id long, quality int, toxic int"
    a, b = ({r.doc_id: r.score for r in C.classify(frame(spark, rows), spark.createDataFrame(x, kind)).collect()}
            for x in (labels, flipped))
    assert a == b


def test_empty_and_unlabelled(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in C.classify(frame(spark, corpus()), none).collect()} == {0.5}
    assert C.classify(empty(spark), none).count() == 0 and C.keep_good(empty(spark), none).count() == 0


def test_features_of_awkward_texts():
    texts = [None, "", " \n\t", "a", "A! b| c# 1 .", "x x x x\nx x x x\n\n", "É é"]
    x = C.features(pa.array(texts))
    assert x.shape == (7, len(C.FEATURES)) and np.isfinite(x).all() and not x[0].any() and not x[1].any()
    at = {f: x[:, i] for i, f in enumerate(C.FEATURES)}
    assert at["twin_words"][5] == 7 / 8 and at["repeat_lines"][5] == 0.5 and at["new_words"][5] == 1 / 8
    assert at["capitals"][6] > 0 and at["pipes"][4] == 1 / 5 and at["digits"][4] == 1 / 5
    alone = np.concatenate([C.features(pa.array([t], pa.string())) for t in texts])
    assert (alone == x).all()  # a row's features do not depend on its batch


def test_scores_add_up_and_pairs_help():
    rng = np.random.default_rng(2)
    x = rng.random((3000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)   # no feature helps alone
    model = C.fit(x, y)
    assert ((model.score(x) >= 0.5) == y).mean() > 0.9
    i, j, _ = max(model.pairs, key=lambda p: np.abs(p[2]).max())
    assert {i, j} == {0, 1}
    row = x[:1]
    total = model.base
    for f, table in enumerate(model.tables):
        total += table[np.searchsorted(model.edges[f], row[0, f], side="left")]
    for i, j, table in model.pairs:
        bi, bj = (np.searchsorted(model.edges[f], row[0, f], side="left") for f in (i, j))
        total += table[model.coarse[i][bi], model.coarse[j][bj]]
    assert np.isclose(model.score(row)[0], 1 / (1 + np.exp(-total)))
