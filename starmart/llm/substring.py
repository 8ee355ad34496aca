"""Duplicate passages by relative Lempel-Ziv parsing against an index of the corpus.

A window is ``window`` consecutive words of one document. Every word covered by a window
whose words also start somewhere in a document with a smaller id is removed; windows are
judged on the input, not on what is left.

*Reference blocks.* The reference is the corpus itself. It is not scanned block by block
for every document: each window carries a content-selected anchor, the least hash of its
``q``-grams, and the blocks of the index are dealt by anchor, so a document meets exactly
the blocks that can hold its windows. Consecutive windows with one anchor form a run.

*Index.* An entry is a window's hash with the place where the reference has it first: the
least id that holds it and its least position there. Runs are compared first: of the runs of
an anchor with the same words the first holder's stands for all, and its windows' places follow
from the run's. Where an anchor has several different runs, the windows of each first holder
are indexed one by one.

*Parsing.* A document is factored from left to right against the index. A factor (start, length,
reference document, position there) starts at the first window that the reference holds under a
smaller id and extends word by word as long as the next window's entry is the next place of the
same reference document: so the whole factor stands there, word for word, from that position on.
Where it ends, the windows across the boundary are looked up like any others and start the next
factor, which may overlap. The reference is the first holder of each window, so a factor also
ends where an earlier document takes over; what is removed does not depend on it, as every
window is looked up and the factors together cover exactly the removable words.

Word sequences are compared by 64-bit hashes of the words' bytes.

Scale: rows are runs (about two per ``window - q`` words), partially aggregated by anchor
and words, so a passage or a document that a third of the corpus holds costs one row a map
task; windows are expanded only where different runs share an anchor. Texts of documents
that share an anchor are shuffled once. Copies of a whole document are folded beforehand.
All intermediates go to the shared folder.

Null or empty texts have no words. A null id counts as larger than every id. Rows that
repeat an id are separate documents, none smaller than the other. Texts of fewer words
than a window keep everything. Extra columns are ignored; empty tables give empty tables.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.tables import arrow_map, written
from starmart.llm.text import grams, slices, span_hashes, stream, window_minima, words

WINDOW, Q = 50, 16
_LAST = (1 << 63) - 1
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()
_MARK = "struct<pos:int,len:int,lo:bigint,at:int,whole:boolean>"
FACTOR = "struct<start:int,length:int,ref_doc:bigint,ref_start:int>"


def _nested(first: np.ndarray, *columns: pa.Array, names: list[str]) -> pa.Array:
    inner = pa.StructArray.from_arrays(list(columns), names)
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), inner)


def runs_of(h: np.ndarray, row: np.ndarray, window: int, q: int):
    """(row, position, windows, anchor, words' hash) of each run of windows."""
    low, ok = window_minima(h, row, window, q)
    at = np.flatnonzero(ok)
    if not len(at):
        none = np.zeros(0, np.int64)
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    new = np.ones(len(at), dtype=bool)
    new[1:] = (np.diff(at) > 1) | (low[at[1:]] != low[at[:-1]]) | (row[at[1:]] != row[at[:-1]])
    begin = at[new]
    size = np.diff(np.append(np.flatnonzero(new), len(at)))
    return row[begin], begin, size, low[begin], span_hashes(h, begin, begin + size + window - 1)


def _scan(window: int, q: int):
    salt = stream(41, 1)[0]

    def of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in slices(batch):
            w = words(part.column("text"))
            lo, hi = w.first[:-1], w.first[1:]
            sha = [hashlib.sha256(b" ".join((t or "").encode().split())).hexdigest()
                   for t in part.column("text").to_pylist()]
            row, at, size, anchor, text = runs_of(w.hash, w.row, window, q)
            first = np.searchsorted(row, np.arange(len(lo) + 1))
            runs = _nested(first, pa.array(anchor.view(np.int64)), pa.array(text.view(np.int64)),
                           pa.array((at - w.first[row]).astype(np.int32)),
                           pa.array(size.astype(np.int32)), names=["v", "rk", "pos", "len"])
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("key"), pa.array(hi - lo),
                 pa.array(span_hashes(w.hash, lo, hi).view(np.int64)),
                 pa.array(span_hashes(w.hash ^ salt, lo, hi).view(np.int64)), pa.array(sha), runs],
                ["id", "key", "n", "s1", "s2", "sha", "runs"])

    return of


def _expand(window: int):
    """Hash, document and position of every window of the runs marked for the index."""

    def of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in slices(batch):
            w = words(part.column("text"))
            g, _ = grams(w.hash, w.row, window)
            marks = part.column("marks")
            flat = marks.flatten()
            owner = np.repeat(np.arange(len(marks)), np.diff(marks.offsets.to_numpy()))
            take = ~flat.field("whole").to_numpy(zero_copy_only=False)
            pos, size = (flat.field(k).to_numpy()[take].astype(np.int64) for k in ("pos", "len"))
            owner = owner[take]
            inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            where = np.repeat(pos, size) + inside
            doc = np.repeat(owner, size)
            yield pa.RecordBatch.from_arrays(
                [pa.array(g[w.first[doc] + where].view(np.int64)),
                 part.column("id").take(pa.array(doc)), part.column("key").take(pa.array(doc)),
                 pa.array(where.astype(np.int32))], ["h", "id", "key", "pos"])

    return of


def factor(pos: np.ndarray, ref: np.ndarray, at: np.ndarray, window: int) -> list[tuple[int, int, int, int]]:
    """Factors (start, length, reference document, position there) of a document's known windows.

    ``pos``: ascending starts of the windows held by a smaller id; ``ref``, ``at``: that id and the
    window's position in it. A factor ends where the next window is not the reference's next.
    """
    if not len(pos):
        return []
    breaks = np.flatnonzero((np.diff(pos) != 1) | (np.diff(ref) != 0) | (np.diff(at) != 1)) + 1
    begin = np.concatenate([[0], breaks])
    end = np.concatenate([breaks, [len(pos)]]) - 1
    return [(int(pos[b]), int(pos[e] - pos[b]) + window, int(ref[b]), int(at[b])) for b, e in zip(begin, end)]


def _parse(window: int):
    kind = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("ref_doc", pa.int64()),
                               ("ref_start", pa.int32())]))

    def of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in slices(batch):
            shas, removed, factors = [], [], []
            for text, marks, hits in zip(part.column("text").to_pylist(),
                                         part.column("marks").to_pylist(),
                                         part.column("hits").to_pylist()):
                tokens = (text or "").encode().split()
                known = np.full(len(tokens), _LAST, dtype=np.int64)
                place = np.zeros(len(tokens), dtype=np.int64)

                def enter(first: int, size: int, doc: int, at: int) -> None:
                    """Windows first.. stand in ``doc`` from ``at`` on, where nothing earlier holds them."""
                    some, there = slice(first, first + size), at + np.arange(size)
                    better = (doc < known[some]) | ((doc == known[some]) & (there < place[some]))
                    known[some] = np.where(better, doc, known[some])
                    place[some] = np.where(better, there, place[some])

                for m in marks:
                    if m["whole"]:
                        enter(m["pos"], m["len"], m["lo"], m["at"])
                for x in hits or ():
                    enter(x["pos"], 1, x["lo"], x["at"])
                pos = np.flatnonzero(known < _LAST)
                found = factor(pos, known[pos], place[pos], window)
                gone = np.zeros(len(tokens) + 1, dtype=np.int64)
                for start, length, _, _ in found:
                    gone[start] += 1
                    gone[start + length] -= 1
                out = np.cumsum(gone[:-1]) > 0
                kept = b" ".join(t for t, drop in zip(tokens, out) if not drop)
                shas.append(hashlib.sha256(kept).hexdigest())
                removed.append(int(out.sum()))
                factors.append([{"start": a, "length": b, "ref_doc": c, "ref_start": d} for a, b, c, d in found])
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("key"), pa.array(removed, pa.int64()),
                 pa.array(shas), pa.array(factors, kind)],
                ["id", "key", "removed", "kept", "factors"])

    return of


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   window: int = WINDOW, q: int = Q) -> DataFrame:
    """(``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256``, ``factors``, ``copy_of``) a row.

    ``factors`` are the duplicate spans in words with the reference document of each and the
    word where the span starts there;
    ``copy_of`` is the least id with the same word sequence, where that is another one.
    """
    text = F.col(text_col)
    source = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("id"),
                         F.xxhash64(text).alias("key"), text.alias("text"))
    base = written(arrow_map(source, _scan(window, q),
                             "id long, key long, n long, s1 long, s2 long, sha string, "
                             "runs array<struct<v:bigint,rk:bigint,pos:int,len:int>>"), "rlz-scan")
    doc, row = ["s1", "s2", "n"], ["id", "key"]
    # tables of one row a key are written before a join: two shuffled tables, of which the
    # join can split a hot key's rows at run time
    firsts = written(base.groupBy(*doc).agg(F.min("id").alias("first")), "rlz-first")
    holders = written(base.select(*row, *doc, "sha").join(firsts, doc).select(*row, "n", "sha", "first"),
                      "rlz-holders")

    runs = base.select(*row, F.explode("runs").alias("r")).select(*row, "r.*")
    # the first holder of each run's words and the run's least position in it
    least = F.min(F.struct("id", "pos")).alias("least")
    same = runs.groupBy("v", "rk").agg(least, F.max("id").alias("hi"))
    same = same.select("v", "rk", F.col("least.id").alias("lo"), F.col("least.pos").alias("at"), "hi")
    anchors = written(same.groupBy("v").agg(F.count(F.lit(1)).alias("texts"), F.min("lo").alias("vlo"),
                                            F.max("hi").alias("vhi")).where("vlo < vhi"), "rlz-anchors")
    shared = written(same.join(anchors, "v")
                     .select("v", "rk", "lo", "at", "hi", (F.col("texts") > 1).alias("many"))
                     .where("lo < hi or many").select("v", "rk", "lo", "at", "many"), "rlz-shared")
    mark = F.struct("pos", "len", "lo", "at", (F.col("id") > F.col("lo")).alias("whole"))
    marks = (runs.join(shared, ["v", "rk"]).where("id > lo or many")
             .groupBy(*row).agg(F.collect_set(mark).cast(f"array<{_MARK}>").alias("marks"))
             .join(holders.where("id = first").select(*row).distinct(), row))  # copies need no parse
    touched = written(source.join(marks, row), "rlz-touched")

    windows = written(arrow_map(touched, _expand(window),
                                "h long, id long, key long, pos int"), "rlz-windows")
    known = written(windows.groupBy("h").agg(least, F.max("id").alias("hi")).where("least.id < hi")
                    .select("h", F.col("least.id").alias("lo"), F.col("least.pos").alias("at")), "rlz-index")
    hits = (windows.join(known, "h").where("id > lo").groupBy(*row)
            .agg(F.collect_set(F.struct("pos", "lo", "at")).alias("hits")))
    parsed = written(arrow_map(touched.join(hits, row, "left"), _parse(window),
                               f"id long, key long, removed long, kept string, "
                               f"factors array<{FACTOR}>").dropDuplicates(row), "rlz-parsed")
    result = holders.join(parsed, row, "left")
    copy = F.col("id") > F.col("first")
    gone = copy & (F.col("n") >= window)
    return result.select(
        F.nullif(F.col("id"), F.lit(_LAST)).alias("doc_id"), F.col("n").alias("n_words"),
        F.when(gone, F.col("n")).when(copy, 0).otherwise(F.coalesce("removed", F.lit(0)))
        .cast("long").alias("n_removed"),
        F.when(gone, EMPTY_SHA256).when(copy, F.col("sha")).otherwise(F.coalesce("kept", "sha"))
        .alias("kept_sha256"),
        F.when(~copy, F.col("factors")).alias("factors"), F.when(copy, F.col("first")).alias("copy_of"))
