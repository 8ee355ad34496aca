"""Fingerprints: edited texts, order independence, insertion and deletion, likeness."""

import hashlib
import math
import struct

import xxhash
from pyspark.sql import functions as F

from llm_cases import corpus, empty, frame, words
from starmart.llm import fingerprints as P


def test_contract(spark):
    rows = sorted({(d, t) for d, t in corpus() if d is not None and t is not None})
    seen = set()
    rows = [r for r in rows if not (r[0] in seen or seen.add(r[0]))]
    got = {r.doc_id: r for r in P.fingerprints(frame(spark, rows)).collect()}
    assert len(got) == len(rows)
    likes = []
    for i, (d, t) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        half = len(t) // 2
        edited = t[:len(t) - half] + after[:half]
        r = got[d]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if t == after:
            assert r.near_next == 1.0 and r.fingerprint == got[rows[(i + 1) % len(rows)][0]].fingerprint
        elif len(t.split()) > 100 and abs(len(after) - len(t)) < len(t) / 2 and r.near_next < 0.5:
            likes.append((r.near_edited, r.near_next))
    assert sum(a > b for a, b in likes) >= 0.95 * len(likes) > 0
    by_text = {}
    for d, t in rows:
        assert by_text.setdefault(t, got[d].fingerprint) == got[d].fingerprint
    assert len(set(by_text.values())) == len(by_text)


def test_edges(spark):
    assert P.fingerprints(empty(spark)).count() == 0
    one = P.fingerprints(frame(spark, [(7, "ab cd")])).collect()
    assert [(r.doc_id, r.edited_sha256, r.near_next) for r in one] == \
        [(7, hashlib.sha256(b"ab ab").hexdigest(), 1.0)]
    got = P.fingerprints(frame(spark, [(None, None), (None, "x y"), (3, "x y"), (3, "x y"), (2, "")])).collect()
    assert len(got) == 5 and sum(r.doc_id is None for r in got) == 2
    assert len({r.fingerprint for r in got if r.n_chars == 3}) == 1
    two = next(r for r in got if r.doc_id == 2)
    assert (two.n_chars, two.edited_sha256) == (0, hashlib.sha256(b"").hexdigest())
    first = [r for r in got if r.doc_id == 3]
    assert sorted(r.near_next for r in first)[1] == 1.0  # the copy follows


def _lanes(spark, texts):
    rows = P.fingerprints(frame(spark, list(enumerate(texts))))
    return {r.doc_id: r for r in rows.select("doc_id", "fingerprint", "lanes").collect()}


def test_homomorphic_multiset(spark):
    a, b, c = "one two three four", "five six seven", "eight nine ten eleven twelve"
    got = _lanes(spark, [f"{a}\n{b}\n{c}", f"{c}\n{a}\n{b}", f"{a}\n{c}", b, f"{a}\n{a}\n{b}\n{c}", a])
    assert got[0].fingerprint == got[1].fingerprint          # order does not matter
    assert got[0].fingerprint != got[4].fingerprint          # multiplicity does
    pairs = spark.createDataFrame([(got[2].lanes, got[3].lanes, got[0].lanes, got[4].lanes, got[5].lanes)],
                                  "ac array<long>, b array<long>, abc array<long>, aabc array<long>, a array<long>")
    r = pairs.select(P.combine(F.col("ac"), F.col("b")).alias("inserted"),
                     P.combine(F.col("abc"), F.col("b"), -1).alias("deleted"),
                     P.combine(F.col("aabc"), F.col("a"), -1).alias("once")).first()
    assert (r.inserted, r.deleted, r.once) == (got[0].lanes, got[2].lanes, got[0].lanes)


def test_long_lines_and_many_lines_do_not_overflow(spark):
    long_line = "a b c " * 30_000                              # 90,000 windows, three of them distinct
    got = _lanes(spark, [long_line, "\n".join(["a b c"] * 70_000), "a b c"])
    assert got[0].lanes[P.EXACT] == (90_000 - 2) % 65536
    one = got[2].lanes
    for i, lane in enumerate(got[1].lanes):
        assert lane == (one[i] * 70_000) % (2**32 if i < P.EXACT else 2**16)


def test_likeness_of_texts_with_many_equal_shingles(spark):
    many = "\n".join(["a b c"] * 40_000)
    rows = P.fingerprints(frame(spark, [(0, many), (1, "x y"), (2, many + "\nq r s"), (3, many)]))
    got = {r.doc_id: r for r in rows.withColumn("more", P.combine(F.col("wide"), F.col("wide"), 1, P.WIDE)).collect()}
    assert got[0].near_edited > 0.99 and got[2].near_next > 0.99
    assert got[0].wide[P.EXACT] == 40_000 and got[0].more[P.EXACT] == 80_000
    assert set(got[0].wide[P.EXACT + 1:]) == {0, 40_000} and set(got[0].more[P.EXACT + 1:]) == {0, 80_000}
    assert len(got[0].fingerprint) == 8 * len(got[0].wide)


def _hash(*parts, seed=42):
    """Chained 64-bit hashes of texts, longs and ints, as the library's native hash makes them."""
    for kind, value in parts:
        data = value.encode() if kind == "s" else struct.pack("<q" if kind == "l" else "<i", value)
        seed = xxhash.xxh64(data, seed=seed).intdigest()
    return seed


def _signed(h):
    return h - (1 << 64) if h >> 63 else h


def _plain(text):
    """The lanes by one loop over paragraphs and shingles."""
    exact, count, like = [0] * P.EXACT, 0, [0] * P.LIKE
    for line in text.split("\n"):
        h1, h2 = _hash(("s", line)), _hash(("s", "paragraph"), ("s", line))
        draws = [h1, h2] + [_hash(("l", _signed(h1)), ("l", _signed(h2)), ("i", i)) for i in range(P.EXACT // 2 - 2)]
        for i, h in enumerate(draws):
            exact[2 * i] += h & 0xFFFFFFFF
            exact[2 * i + 1] += h >> 32
        w = words(line)
        shingles = [w[i:i + 3] for i in range(len(w) - 2)] if len(w) >= 3 else [w] if w else []
        for s in shingles:
            h = _hash(*[("s", x) for x in s])
            count += 1
            for lane in range(P.LIKE):
                i, rest = divmod(lane, 4)
                like[lane] += h >> (i + 16 * rest) & 1
    return [x % (1 << 32) for x in [*exact, count, *like]]


def _cosine(a, b):
    x, y = ([2 * v - lanes[P.EXACT] for v in lanes[P.EXACT + 1:]] for lanes in (a, b))
    scale = math.sqrt(sum(v * v for v in x) * sum(v * v for v in y))
    return 1.0 if a == b else 0.0 if not scale else max(0.0, min(1.0, sum(p * q for p, q in zip(x, y)) / scale))


def test_against_a_plain_loop(spark):
    rows = {d: t for d, t in corpus(groups=8) if d is not None and t is not None and len(t) < 20_000}
    rows = sorted(rows.items())
    got = {r.doc_id: r for r in P.fingerprints(frame(spark, rows)).collect()}
    for i, (d, t) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        half = len(t) // 2
        own, edited, following = _plain(t), _plain(t[:len(t) - half] + after[:half]), _plain(after)
        text = lambda lanes: "".join(f"{v:08x}" for v in lanes)
        assert got[d].fingerprint == text(own) and got[d].edited_fingerprint == text(edited)
        assert abs(got[d].near_edited - _cosine(own, edited)) < 1e-9
        assert abs(got[d].near_next - _cosine(own, following)) < 1e-9


def test_bounds_in_two_steps(spark):
    ids = spark.range(0, 600_000, 1, 16).selectExpr("id * 7 - 1000 AS doc_id").union(
        spark.range(3000).selectExpr("CAST(NULL AS BIGINT)")).union(spark.range(50_000).selectExpr("5000000L"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "500")          # 2,000 buckets: two steps
    try:
        bounds = P._bounds(ids, "doc_id")
        assert P._bounds(ids.where("doc_id is null"), "doc_id") == []
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert bounds == sorted(set(bounds)) and bounds[0] == -1000 and 1200 < len(bounds) < 2600
    placed = ids.where("doc_id is not null and doc_id < 5000000").select(P._bucket(F.col("doc_id"), bounds).alias("b"))
    sizes = [r["count"] for r in placed.groupBy("b").count().collect()]
    assert max(sizes) < 8 * 600_000 / len(bounds)
