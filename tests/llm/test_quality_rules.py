"""Quality rules: counts against plain Python, sketches that merge, adaptive limits."""

import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from llm_cases import corpus, empty, frame, sentence, words
from starmart.llm import quality_rules as Q


def counts(text):
    t = text or ""
    w = words(t)
    lines = [x for x in t.split("\n") if words(x)]
    threes = list(zip(w, w[1:], w[2:]))
    often = Counter(threes)
    covered = {i + k for i, x in enumerate(threes) if often[x] > 1 for k in range(3)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))


def test_counts(spark):
    rows = corpus() + [(1, "a a a a"), (2, "a b c a b c"), (3, "x | y # z\nx | y # z\n \n \n"), (4, "a b"),
                       (5, "a b a b a"), (6, "<b>&amp;</b> 100% $5 *"), (7, "q w e r t q w e")]
    got = Q.apply_rules(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    want = sorted((str(d), *counts(t)) for d, t in rows)
    assert sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
                  for r in got) == want
    for r in got:
        base = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base_failed == base and (not r.kept or not base)
    assert Q.apply_rules(empty(spark)).count() == 0


def test_limits_adapt_to_the_group(spark):
    """What is usual in one source is junk in another; junk does not set its own limit."""
    rng = random.Random(3)
    rows = []
    for i in range(60):
        rows.append((i, sentence(rng, 80), "en", "plain"))
        rows.append((100 + i, sentence(rng, 80) + " # * $ % &" * 12, "en", "code"))
        rows.append((200 + i, sentence(rng, 80), None, None))
    for i in range(20):
        rows.append((300 + i, sentence(rng, 80) + " # * $ % &" * 12, "en", "plain"))
    got = {r.doc_id: r for r in Q.apply_rules(frame(spark, rows), prior=5).collect()}
    assert all(got[i].kept for i in range(60)) and all(got[200 + i].kept for i in range(60))
    assert all(got[100 + i].kept for i in range(60))
    assert all("symbols" in got[300 + i].failed_rules and not got[300 + i].kept for i in range(20))


def test_sketches_merge_and_bound_their_error(spark):
    rng = random.Random(5)
    values = [int(rng.paretovariate(0.7)) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "v long").withColumn("b", Q.bucket(F.col("v")))
    for r in df.collect():
        assert math.exp(r.b / Q.SCALE) <= (r.v + 1) * (1 + 1e-9) < math.exp((r.b + 1) / Q.SCALE) * (1 + 1e-9)
    rows = [(i, sentence(rng, 60 + i % 7), "en" if i % 2 else "de", f"s{i % 3}") for i in range(90)]
    m = Q.measures(frame(spark, rows).select("text", F.col("lang").alias("g0"), F.col("source").alias("g1")),
                   keep=("g0", "g1"))
    whole = Q.sketches(m, ["g0"])
    parts = Q.sketches(m, ["g0", "g1"]).groupBy("g0", "rule", "bucket").agg(F.sum("n").alias("n"))
    assert whole.exceptAll(parts).isEmpty() and parts.exceptAll(whole).isEmpty()


def test_small_groups_lean_on_their_language(spark):
    """Limits move from the language's to the group's own with its documents, without a switch."""
    rng = random.Random(6)
    rows = [(i, sentence(rng, 60) + " #" * 3, "en", "big") for i in range(400)]
    rows += [(1000 + i, sentence(rng, 60) + " #" * 30, "en", "small") for i in range(6)]
    keys = ["g0", "g1"]

    def found(prior, some=rows):
        m = Q.measures(frame(spark, some).select("text", F.col("lang").alias("g0"), F.col("source").alias("g1")),
                       keep=("g0", "g1"))
        return {(r.g1, r.rule): (r.hi, r.lo, r.nz) for r in Q.limits(Q.sketches(m, keys), keys, prior).collect()}

    own, leaning, parents = found(0.0), found(100.0), found(1e12)
    assert parents["small", "symbols"] == parents["big", "symbols"] == leaning["small", "symbols"]
    assert own["small", "symbols"][0] > own["big", "symbols"][0] + 50
    # the language's high quantile counts for the group until its own documents outweigh it
    steps = []
    for n in (6, 100, 200, 240, 400):
        more = rows[:400] + [(1000 + i, sentence(rng, 60) + " #" * 30, "en", "small") for i in range(n)]
        steps.append(found(100.0, more)["small", "symbols"][0])
    assert steps == sorted(steps) and steps[0] == parents["small", "symbols"][0] and steps[-1] == own["small", "symbols"][0]


def _sql_verdicts(rows):
    import duckdb
    import pyarrow as pa

    from starmart.llm.oracle import QUALITY_RULES

    documents = pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": pa.array([r[1] for r in rows]),
                          "lang": pa.array([r[2] for r in rows]), "source": pa.array([r[3] for r in rows])})
    con = duckdb.connect()
    con.register("documents", documents)
    return {r[0]: r[1:] for r in con.execute(
        f"SELECT doc_id, failed_rules, kept FROM ({QUALITY_RULES})").fetchall()}


def test_sql_is_the_codes_rule_where_rates_are_not_nought(spark):
    """400 documents of a usual symbol rate of 25 to 50 per mille, 20 of junk: SQL and code agree."""
    rng = random.Random(13)
    rows = [(i, sentence(rng, 200, 50_000) + " #" * rng.randrange(5, 11), "en", "symbols") for i in range(400)]
    rows += [(1000 + i, sentence(rng, 200, 50_000) + " #" * rng.randrange(60, 200), "en", "symbols") for i in range(20)]
    rows += [(2000 + i, sentence(rng, 90, 50_000).replace(" ", "! ") if i % 9 == 0 else sentence(rng, 90, 50_000),
              "de" if i % 2 else None, f"s{i % 5}" if i % 7 else None) for i in range(200)]
    rows += [(3000, "", "en", "symbols"), (3001, None, "en", None), (3002, "x " * 60, "fr", "alone")]
    got = {r.doc_id: (",".join(r.failed_rules), r.kept) for r in Q.apply_rules(frame(spark, rows)).collect()}
    assert got == _sql_verdicts(rows)
    assert all(got[i][1] for i in range(400)) and not any(got[1000 + i][1] for i in range(20))
    assert not any(got[2000 + i][1] for i in range(0, 200, 9))


def test_rules_fire_where_a_rate_is_usually_not_nought(spark):
    """Sources whose usual rate is 1-50 per mille (or more): usual documents pass, junk does not."""
    rng = random.Random(7)

    def text(lines, n=10):
        return "\n".join(sentence(rng, n, 90_000) for _ in range(lines))

    def repeated(k):                                   # k of 300 words stand in copied windows
        return text(30) + (" " + " ".join(["aa bb cc"] * k) if k else "")

    # source -> (rule, usual text, junk text)
    sources = {
        "lines": ("dup_lines", lambda: (t := text(39)) + "\n" + t.split("\n")[0], lambda: "\n".join([text(1, 60)] * 50)),
        "often": ("dup_lines", lambda: "\n".join([text(1)] * 3 + [text(17)]), lambda: "\n".join([text(1, 60)] * 50)),
        "repeats": ("repeats", lambda: repeated(rng.choice((2, 3))), lambda: repeated(60)),
        "symbols": ("symbols", lambda: text(20) + " #" * rng.randrange(4, 9), lambda: text(20) + " #" * 120),
        "shouts": ("shouts", lambda: text(20) + "!" * rng.randrange(1, 4), lambda: text(20) + "!" * 160),
        "capitals": ("capitals", lambda: " ".join("W" + w[1:] for w in text(10).split()), lambda: "ABCDE " * 100),
    }
    rows, want = [], {}
    for s, (name, (rule, usual, junk)) in enumerate(sources.items()):
        for i in range(80):
            want[1000 * s + i] = (rule, i >= 60)
            rows.append((1000 * s + i, (junk if i >= 60 else usual)(), "en", name))
    got = Q.apply_rules(frame(spark, rows), prior=5).collect()
    assert {r.doc_id: (want[r.doc_id][0], want[r.doc_id][0] in r.failed_rules) for r in got} == want
