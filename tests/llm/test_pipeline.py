"""The corpus pipeline on a small corpus: what each stage does, and what it must not do."""

import os

import pytest

import __spark_entry__ as E
import corpus_pipeline as P
from llm_cases import corpus, empty, frame, sentence, words
from starmart.llm.tables import written

SF = "/root/testdata/sf0.001"


@pytest.fixture
def sf(spark, tmp_path):
    import random
    rng = random.Random(1)
    labels = [(i, 1, 0) for i in range(40)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path), rng


def test_stages_in_order():
    assert [n for n, _ in P.STAGES] == ["quality", "lines", "near", "mix", "pack"]
    assert "pipeline" in E.queries() and "pipeline" not in E.oracle_sql()


def test_each_stage_keeps_columns_and_takes_edge_cases(spark, sf):
    path, _ = sf
    docs = written(frame(spark, corpus()), "t-docs")
    for name, stage in P.STAGES[:-1]:
        out = written(stage(spark, docs, path), f"t-{name}")
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        nothing = stage(spark, empty(spark), path)
        assert nothing.columns == docs.columns and nothing.count() == 0, name
        assert out.where("key <> 'clash'").count() == 0
        docs = out
    packed = P.pack(spark, docs, path).collect()
    assert sum(r.length for r in packed) >= docs.count()
    assert P.pack(spark, empty(spark), path).count() == 0


def test_lines_drop_emptied_documents_only(spark, sf):
    text = "a b c\nd e f\ng h i"
    rows = [(1, text), (2, text), (3, text + "\nnew line"), (4, ""), (5, None), (6, "\n \n")]
    got = {r.doc_id: (r.text, r.n_chars) for r in P.lines(spark, frame(spark, rows), sf[0]).collect()}
    assert got == {1: (text, len(text)), 3: ("new line", 8), 4: ("", 0), 5: (None, None), 6: ("\n \n", 3)}


def test_near_keeps_one_of_each_group(spark, sf):
    rng = sf[1]
    w = sentence(rng, 120, 900).split()
    close = [*w]
    close[60] = "changed"
    rows = [(9, " ".join(w)), (4, " ".join(close)), (7, " ".join(w)), (7, " ".join(w)), (1, sentence(rng, 100, 900)),
            (2, ""), (3, None), (None, " ".join(w))]
    got = sorted(str(r.doc_id) for r in P.near(spark, frame(spark, rows), sf[0]).collect())
    assert got == sorted(["4", "1", "2", "3", "None"])


def test_mix_takes_effect(spark, sf):
    rng = sf[1]
    rows = [(i, sentence(rng, 30 + i), "en", f"s{i % 4}") for i in range(60)]
    got = P.mix(spark, frame(spark, rows), sf[0]).collect()
    from starmart.llm.mixing import mix
    want = {r.doc_id: r.taken for r in mix(frame(spark, rows)).collect()}
    taken = {}
    text = {d: t for d, t, *_ in rows}
    for r in got:
        taken[r.doc_id] = taken.get(r.doc_id, 0) + len(words(r.text))
        assert r.text in text[r.doc_id] and r.n_chars == len(r.text)  # whole or a run of its words
    assert taken == {d: n for d, n in want.items() if n}


def test_run_on_the_driver_table(spark):
    if not os.path.isdir(SF):
        pytest.skip("driver test data not present")
    rows = E.queries()["pipeline"](spark, SF)
    found = rows.collect()
    assert {"doc_id", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(rows.columns)
    by_sequence = {}
    for r in found:
        by_sequence[r.sequence_id] = by_sequence.get(r.sequence_id, 0) + r.length
    assert all(n <= 2048 and (n == 2048 or n & (n - 1) == 0) for n in by_sequence.values())


def _table(rng):
    """(doc_id, text, lang, source) with near copies, repeated lines and junk; unique ids."""
    from test_classify import labelled
    from test_line_dedup import rows_with_lines
    from test_minhash import crowd

    good, labels = labelled(120)
    seen, rows = set(), []
    for shift, part in ((0, good), (10_000, rows_with_lines()), (30_000, crowd()), (50_000, corpus(groups=6))):
        for d, t in part:
            if d is not None and shift + d not in seen:
                seen.add(shift + d)
                rows.append((shift + d, t, "en", f"s{rng.randrange(4)}" if rng.random() < 0.9 else None))
    fine = [t for i, t in good if i % 6 > 2]
    for i in range(24):
        copy = fine[i].replace("\n", " ").split()
        copy[len(copy) // 2] = "changed."
        source = f"s{i % 3}"
        rows += [(70_000 + i, f"{fine[i]}\n{fine[i + 1]}", "en", source),         # lines that repeat
                 (80_000 + i, " ".join(copy), "en", source), (90_000 + i, fine[i].replace("\n", " "), "en", None)]
    return rows, labels


def test_each_stage_against_a_plain_version(spark, tmp_path):
    """Every stage's rows, on all that its predecessor kept, by plain Python or by SQL."""
    import random

    import duckdb
    import pyarrow as pa
    from test_line_dedup import brute as plain_lines
    from test_minhash import brute as plain_groups
    from test_packing import _check

    from starmart.llm import classify, packing
    from starmart.llm.oracle import MIXING

    rows, labels = _table(random.Random(7))
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    lab.write.parquet(f"{tmp_path}/labels.parquet")
    docs = written(frame(spark, rows), "t-plain-docs")
    texts = lambda df: {r.doc_id: (r.text, r.source) for r in df.select("doc_id", "text", "source").collect()}
    tables = [docs]
    for name, stage in P.STAGES:
        tables.append(written(stage(spark, tables[-1], str(tmp_path)), f"t-plain-{name}"))
    start, quality, lines, near = map(texts, tables[:4])

    scores = {r.doc_id: r.score for r in classify.classify(tables[0], lab).collect()}
    assert quality == {d: v for d, v in start.items() if scores[d] >= 0.5} and 0 < len(quality) < len(start)

    left = plain_lines([(d, t) for d, (t, _) in quality.items()])
    assert lines == {d: (t, quality[d][1]) for (d, _), (t, gone) in left.items() if not gone or words(t)}
    assert any(gone for _, gone in left.values())

    groups = plain_groups([(d, t) for d, (t, _) in lines.items()], 5)
    assert near == {d: v for d, v in lines.items() if groups[d] == d} and len(near) < len(lines)

    documents = pa.table({"doc_id": list(near), "text": [t for t, _ in near.values()],
                          "source": [s for _, s in near.values()]})
    con = duckdb.connect()
    con.register("documents", documents)
    taken = {d: n for d, n in con.execute(f"SELECT doc_id, taken FROM ({MIXING})").fetchall() if n}
    mixed, total = tables[4].select("doc_id", "text").collect(), {}
    for r in mixed:
        total[r.doc_id] = total.get(r.doc_id, 0) + len(words(r.text))
        whole = near[r.doc_id][0]
        assert r.text == whole or f" {r.text} " in " " + " ".join(words(whole)) + " "
    assert total == taken

    want = {}
    for r in mixed:
        want.setdefault(r.doc_id, []).append(packing.encoded(r.text).tolist())
    _check([r.asDict() for r in tables[5].collect()], want)
