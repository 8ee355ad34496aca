"""Substring dedup and suffix-array dedup against all windows."""

import hashlib

import numpy as np
import pyarrow as pa

from llm_cases import corpus, empty, frame, sentence, words
from starmart.llm import substring, suffix_dedup

LAST = 2**63 - 1


def covered(rows, window=50):
    """Per row: which words stand in a window that also starts in a smaller id."""
    least = {}
    for d, t in rows:
        w = words(t)
        for i in range(len(w) - window + 1):
            key = tuple(w[i:i + window])
            least[key] = min(least.get(key, LAST + 1), LAST if d is None else d)
    out = []
    for d, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if least[tuple(w[i:i + window])] < (LAST if d is None else d):
                gone[i:i + window] = [True] * window
        out.append(gone)
    return out


def passages():
    import random
    rng = random.Random(4)
    shared = sentence(rng, 90, 5000).split()
    rows = corpus()
    for i in range(12):                                     # pieces of one passage, cut anywhere
        a = rng.randrange(0, 30)
        b = rng.randrange(a + 45, 90)
        rows.append((700 - 3 * i, f"{sentence(rng, rng.randrange(0, 60), 9000)} {' '.join(shared[a:b])} "
                                  f"{sentence(rng, rng.randrange(0, 60), 9000)}"))
    rows.append((5, " ".join(shared[10:70] + shared[20:80])))  # factors that overlap
    rows.append((6, "the " * 120))
    rows.append((8, "the " * 70 + "end"))
    return rows


def test_substring_matches_all_windows(spark):
    rows = passages()
    got = substring.remove_repeats(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    want = []
    for (d, t), gone in zip(rows, covered(rows)):
        kept = " ".join(w for w, g in zip(words(t), gone) if not g)
        want.append((d, len(gone), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    key = lambda r: (r[0] is None, r[0] or 0, r[3])
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=key) == sorted(want, key=key)
    texts = {}
    for d, t in rows:
        texts.setdefault(d, []).append(words(t))
    spans = 0
    for r in got:  # every factor stands whole in its reference document, where it says
        mine = next(w for w in texts[r.doc_id] if len(w) == r.n_words)
        for f in r.factors or []:
            spans += 1
            assert f.length >= 50 and (r.doc_id is None or f.ref_doc < r.doc_id)
            part = mine[f.start:f.start + f.length]
            assert any(w[f.ref_start:f.ref_start + f.length] == part for w in texts[f.ref_doc])
    assert spans > 10


def test_factors_do_not_span_what_the_reference_holds_apart(spark):
    """A holder has X[0:60] and, elsewhere, X[11:100]: X is two factors, each whole in the holder."""
    import random
    rng = random.Random(21)
    x = sentence(rng, 100, 90_000).split()
    fill = sentence(rng, 30, 90_000)
    rows = [(1, f"{' '.join(x[:60])} {fill} {' '.join(x[11:])}"), (2, " ".join(x))]
    got = {r.doc_id: r for r in substring.remove_repeats(frame(spark, rows)).collect()}
    assert got[2].n_removed == 100 and got[1].n_removed == 0
    holder = rows[0][1].split()
    factors = sorted((f.start, f.length, f.ref_start) for f in got[2].factors)
    assert len(factors) == 2
    for start, length, at in factors:
        assert holder[at:at + length] == x[start:start + length]


def test_substring_edges(spark):
    assert substring.remove_repeats(empty(spark)).count() == 0
    got = substring.remove_repeats(frame(spark, [(1, None), (2, ""), (3, "a b")])).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed) for r in got) == [(1, 0, 0), (2, 0, 0), (3, 2, 0)]


def test_greedy_factors():
    pos, ref, at = (np.array(x) for x in ([3, 4, 5, 9, 10, 11], [1, 1, 2, 2, 2, 2], [7, 8, 0, 4, 5, 9]))
    assert substring.factor(pos, ref, at, 50) == [(3, 51, 1, 7), (5, 50, 2, 0), (9, 51, 2, 4), (11, 50, 2, 9)]
    assert substring.factor(pos[:0], ref[:0], at[:0], 50) == []


def test_suffix_spans_cover_the_same_words(spark):
    rows = [r for r in passages() if r[0] is not None]
    seen = set()
    rows = [r for r in rows if not (r[0] in seen or seen.add(r[0]))]
    got = suffix_dedup.repeated_passages(frame(spark, rows)).collect()
    found = {d: [False] * len(words(t)) for d, t in rows}
    for r in got:
        assert r.length >= 50 and r.first_doc_id < r.doc_id
        found[r.doc_id][r.start:r.start + r.length] = [True] * r.length
    for (d, _), gone in zip(rows, covered(rows)):
        assert found[d] == gone, d
    spans = sorted((r.doc_id, r.start, r.start + r.length) for r in got)
    assert all(a[0] != b[0] or a[2] < b[1] for a, b in zip(spans, spans[1:]))  # merged


def test_suffix_edges(spark):
    assert suffix_dedup.repeated_passages(empty(spark)).count() == 0
    text = sentence(__import__("random").Random(1), 80, 900)
    got = suffix_dedup.repeated_passages(frame(spark, [
        (1, text), (1, text), (2, text), (None, text), (3, None), (4, "")])).collect()
    assert [(r.doc_id, r.start, r.length, r.first_doc_id) for r in got] == [(2, 0, 80, 1)]


def test_suffix_groups_cut_over_partitions(spark):
    """With many partitions a passage's suffixes fall into several; none is lost."""
    import random
    rng = random.Random(6)
    shared = sentence(rng, 60, 5000)
    rows = [(i, f"{sentence(rng, 20, 90_000)} {shared} {sentence(rng, 20, 90_000)}") for i in range(60)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        got = suffix_dedup.repeated_passages(frame(spark, rows)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert {(r.doc_id, r.start, r.length) for r in got} == {(i, 20, 60) for i in range(1, 60)}


def test_suffix_crowded_starts(spark):
    """Passages around one 16-word start that stands in many contexts on both sides."""
    import random
    rng = random.Random(9)
    from starmart.llm.text import grams, words as parsed
    tries = [sentence(rng, 16, 90_000) for _ in range(3000)]  # one that windows select
    w = parsed(pa.array(tries))
    start = tries[int(np.argmin(grams(w.hash, w.row, 16)[0][::16]))]
    left, right = ([sentence(rng, 17, 90_000) for _ in range(24)] for _ in range(2))
    rows, pairs = [], [(i, j) for i in range(24) for j in range(24)]
    rng.shuffle(pairs)
    for n, (i, j) in enumerate(pairs + rng.sample(pairs, 60)):
        # the later ones repeat an earlier passage of exactly 50 words, elsewhere nothing does
        rows.append((n, f"{sentence(rng, 20, 900_000)} {left[i]} {start} {right[j]} {sentence(rng, 20, 900_000)}"))
    for n in range(60):  # longer and shorter sides
        i, j, cut = rng.randrange(24), rng.randrange(24), rng.randrange(0, 17)
        rows.append((2000 + n, f"{' '.join(left[i].split()[cut:])} {start} {right[j]} " + left[n % 3]))
    want = {d: gone for (d, _), gone in zip(rows, covered(rows))}
    assert sum(map(any, want.values())) >= 60
    for partitions in ("8", "40"):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            got = suffix_dedup.repeated_passages(frame(spark, rows)).collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
        found = {d: [False] * len(words(t)) for d, t in rows}
        for r in got:
            assert r.first_doc_id < r.doc_id
            found[r.doc_id][r.start:r.start + r.length] = [True] * r.length
        assert found == want
