"""Duplicate passages by a sparse suffix array.

*Sampling.* Only suffixes that start at content-selected positions are kept: a position
whose ``q``-gram has the least hash of some window of ``window`` words. Equal windows of
two documents select the same position in both, so every shared passage of ``window``
words keeps at least one common suffix.

*Sorting.* Suffixes are ordered by their first ``q``-gram's hash, then by the hashes of the
words that follow, then by document. The order is built by range partitioning on the whole
key, so a passage that a third of the corpus holds is cut over many tasks. Of suffixes
with the same context on both sides (``window - q`` words each way) only the first
document's is sorted; the others are copies of that one as far as the context reaches.

*Comparing and extending.* Each suffix is compared with the ``NEIGHBOURS`` before it: common
words to the right and to the left are counted, and where together they reach ``window``
words, the later document (larger id) has a duplicate span that starts in the earlier one.
So all pairs of a ``q``-gram's suffixes are seen where it has at most ``NEIGHBOURS``. Groups cut
by a partition's edge are joined in a second pass over the edge rows, a fixed number per
partition. Spans of a document merge.

*Crowded starts.* Of a ``q``-gram with more suffixes than ``NEIGHBOURS`` no order puts all that
share words on both sides next to each other. Its suffixes are not sorted: every window
around it (up to ``window - q`` + 1 a suffix) is hashed, the least document of each window is
found by partial aggregation, and a window that a smaller document holds is a duplicate
span. So every pair counts, whatever the number of contexts and partitions. A window has
at least half of the words around the ``q``-gram on one side; only those windows are hashed
whose longer side another document shares.

The compared words are equal by 64-bit (first ``q``-gram) and 32-bit hashes (every other
word; around crowded starts by a 64-bit hash of these). Whole copies of a document's words
are found beforehand and span it all.

Repeats inside one document do not count. Null or empty texts and texts of fewer words
than a window have no spans. Rows without an id are left out (a span needs its document);
rows that repeat an id are not compared with each other. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.substring import _nested
from starmart.llm.tables import arrow_map, map_in_arrow, written
from starmart.llm.text import anchor_positions, grams, mix, running_hash, slices, span_hashes, stream, words

WINDOW, Q, NEIGHBOURS = 50, 16, 16
_SAMPLE = "v long, nexts binary, befores binary, id long, key long, pos int"
_SUFFIX = [part.split()[0] for part in _SAMPLE.split(", ")]
# what a comparing pass returns: spans, and (``end`` null) the edge rows of its partition
_FOUND = "id long, key long, start int, end int, ref long, v long, nexts binary, befores binary"
_NAMES = [part.split()[0] for part in _FOUND.split(", ")]


def _scan(window: int, q: int):
    salt, side = stream(51, 1)[0], window - q

    def of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in slices(batch):
            w = words(part.column("text"))
            lo, hi = w.first[:-1], w.first[1:]
            at = anchor_positions(w.hash, w.row, window, q)
            g, _ = grams(w.hash, w.row, q)
            row = w.row[at]
            context = span_hashes(w.hash, np.maximum(at - side, lo[row]),
                                  np.minimum(at + q + side, hi[row]))
            # equal contexts that stand differently around their q-gram differ
            context ^= np.minimum(at - lo[row], side).astype(np.uint64)
            first = np.searchsorted(row, np.arange(len(lo) + 1))
            found = _nested(first, pa.array(g[at].view(np.int64)), pa.array(context.view(np.int64)),
                            pa.array((at - lo[row]).astype(np.int32)), names=["v", "c", "pos"])
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("key"), pa.array(hi - lo),
                 pa.array(span_hashes(w.hash, lo, hi).view(np.int64)),
                 pa.array(span_hashes(w.hash ^ salt, lo, hi).view(np.int64)), found],
                ["id", "key", "n", "s1", "s2", "found"])

    return of


def _samples(window: int, q: int):
    """Suffix keys and left contexts of the marked positions of each document."""
    side = window - q

    def of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in slices(batch, limit=1 << 19):
            w = words(part.column("text"))
            g, _ = grams(w.hash, w.row, q)
            marks = part.column("marks")
            owner = np.repeat(np.arange(len(marks)), np.diff(marks.offsets.to_numpy()))
            pos = marks.flatten().to_numpy().astype(np.int64)
            if not len(pos):
                continue
            lo, hi = w.first[:-1][owner], w.first[1:][owner]
            at = lo + pos
            short = (w.hash >> np.uint64(32)).astype(">u4")
            reach = np.arange(side)
            after, before = (at + q)[:, None] + reach, (at - 1)[:, None] - reach
            # a context ends with its document: what lies outside is cut off
            n_after, n_before = np.minimum(hi - at - q, side), np.minimum(pos, side)
            top = len(short) - 1
            right, left = short[np.clip(after, 0, top)], short[np.clip(before, 0, top)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(g[at].view(np.int64)),
                 pa.array([r[:k].tobytes() for r, k in zip(right, n_after)], pa.binary()),
                 pa.array([x[:k].tobytes() for x, k in zip(left, n_before)], pa.binary()),
                 part.column("id").take(pa.array(owner)), part.column("key").take(pa.array(owner)),
                 pa.array(pos.astype(np.int32))],
                ["v", "nexts", "befores", "id", "key", "pos"])

    return of


class _Rows:
    """Suffix rows as arrays: contexts as grids of word hashes, cut off at their lengths."""

    def __init__(self, v, right, n_right, left, n_left, ids, key, pos):
        self.columns = (v, right, n_right, left, n_left, ids, key, pos)
        self.v, self.right, self.n_right, self.left, self.n_left, self.id, self.key, self.pos = self.columns

    @classmethod
    def of(cls, part: pa.RecordBatch, side: int) -> _Rows:
        def grid(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
            texts = column.to_pylist()
            flat = b"".join(t.ljust(4 * side, b"\0") for t in texts)
            size = np.fromiter((len(t) // 4 for t in texts), np.int64, len(texts))
            return np.frombuffer(flat, np.uint32).reshape(len(texts), side), size

        named = {n: part.column(n) for n in ("v", "id", "key", "pos")}
        v, ids, key, pos = (named[n].to_numpy().astype(np.int64) for n in ("v", "id", "key", "pos"))
        return cls(v, *grid(part.column("nexts")), *grid(part.column("befores")), ids, key, pos)

    def take(self, at: np.ndarray) -> _Rows:
        return _Rows(*[c[at] for c in self.columns])

    def plus(self, other: _Rows) -> _Rows:
        return _Rows(*[np.concatenate(c) for c in zip(self.columns, other.columns)])

    def __len__(self) -> int:
        return len(self.v)


def _common(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Leading equal words of two grids of contexts."""
    differs = np.concatenate([a != b, np.ones((len(a), 1), bool)], axis=1)
    return np.minimum(differs.argmax(axis=1), np.minimum(na, nb))


def _spans(rows: _Rows, i: np.ndarray, j: np.ndarray, window: int, q: int) -> list[np.ndarray]:
    """(id, key, start, end, ref) of the pairs of rows that have a window in common."""
    some = (rows.v[i] == rows.v[j]) & (rows.id[i] != rows.id[j])
    i, j = i[some], j[some]
    right = _common(rows.right[i], rows.right[j], rows.n_right[i], rows.n_right[j])
    left = _common(rows.left[i], rows.left[j], rows.n_left[i], rows.n_left[j])
    match = right + left + q >= window
    i, j, right, left = i[match], j[match], right[match], left[match]
    late = np.where(rows.id[i] > rows.id[j], i, j)
    early = i + j - late
    return [rows.id[late], rows.key[late], rows.pos[late] - left, rows.pos[late] + q + right, rows.id[early]]


def _compare(window: int, q: int):
    """Spans of neighbouring suffixes in a sorted partition, and its edge rows."""
    side = window - q
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64())

    def spans(found: list[np.ndarray]) -> pa.RecordBatch:
        n = len(found[0])
        none = [pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())]
        return pa.RecordBatch.from_arrays(
            [*[pa.array(c, k) for c, k in zip(found, kinds)], *none], _NAMES)

    def edge(rows: _Rows) -> pa.RecordBatch:
        nexts = [r[:k].tobytes() for r, k in zip(rows.right, rows.n_right)]
        befores = [r[:k].tobytes() for r, k in zip(rows.left, rows.n_left)]
        n = len(rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(rows.id), pa.array(rows.key), pa.array(rows.pos, pa.int32()), pa.nulls(n, pa.int32()),
             pa.nulls(n, pa.int64()), pa.array(rows.v), pa.array(nexts, pa.binary()),
             pa.array(befores, pa.binary())], _NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = first = None          # the last rows before; the first rows of the first group
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                new = _Rows.of(batch.slice(at, 4096), side)
                first = new if first is None else first.plus(new)
                first = first.take(np.flatnonzero(first.v == first.v[0])[:NEIGHBOURS])
                rows = new if held is None else held.plus(new)
                here = np.arange(len(rows) - len(new), len(rows))
                found = []
                for step in range(1, NEIGHBOURS + 1):
                    i = here[here >= step]
                    found.append(_spans(rows, i, i - step, window, q))
                merged = [np.concatenate(c) for c in zip(*found)]
                if len(merged[0]):
                    yield spans(merged)
                held = rows.take(np.arange(max(0, len(rows) - NEIGHBOURS), len(rows)))
        if first is not None:
            yield edge(first)
            yield edge(held.take(np.flatnonzero(held.v == held.v[-1])))

    return run


def _window_hashes(rows: _Rows, side: int, width: int) -> np.ndarray:
    """Hashes of the ``width`` words (the ``q``-gram counts as one) from each place around it."""
    around = np.concatenate([rows.left[:, ::-1], rows.right], axis=1).astype(np.uint64) + np.uint64(1)
    values = np.concatenate([mix(around[:, :side]), mix(rows.v.view(np.uint64))[:, None],
                             mix(around[:, side:])], axis=1)
    first = np.arange(len(rows))[:, None] * (2 * side + 1) + np.arange(2 * side + 2 - width)
    return mix(running_hash(values.ravel(), first, first + width))


def _halves(window: int, q: int):
    """Hashes of the longer side that a window around a suffix may have: before and after."""
    side = window - q
    half = (side + 1) // 2

    def of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in (batch.slice(at, 4096) for at in range(0, batch.num_rows, 4096)):
            rows = _Rows.of(part, side)
            h = _window_hashes(rows, side, half + 1).view(np.int64)
            # the half before ends with the q-gram, the half after starts with it
            for after, (column, n) in enumerate(((side - half, rows.n_left), (side, rows.n_right))):
                at = np.flatnonzero(n >= half)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows.v[at]), pa.array(h[at, column]), pa.array(rows.id[at]), pa.array(rows.key[at]),
                     pa.array(rows.pos[at], pa.int32()), pa.array(np.full(len(at), after == 1))],
                    ["v", "h", "id", "key", "pos", "after"])

    return of


def _around(window: int, q: int):
    """Every window around a suffix whose longer side (``before``, ``after``) is shared."""
    side = window - q
    half = (side + 1) // 2

    def of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in (batch.slice(at, 4096) for at in range(0, batch.num_rows, 4096)):
            rows = _Rows.of(part, side)
            before, after = (part.column(n).to_numpy(zero_copy_only=False) for n in ("before", "after"))
            h = _window_hashes(rows, side, side + 1).view(np.int64)
            lead = side - np.arange(side + 1)              # words before the q-gram
            fits = (lead <= rows.n_left[:, None]) & (side - lead <= rows.n_right[:, None])
            fits &= (before[:, None] & (lead >= half)) | (after[:, None] & (side - lead >= half))
            at, column = np.nonzero(fits)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows.v[at]), pa.array(h[at, column]), pa.array(rows.id[at]), pa.array(rows.key[at]),
                 pa.array(rows.pos[at], pa.int32()), pa.array(rows.pos[at] - lead[column], pa.int32())],
                ["v", "h", "id", "key", "pos", "start"])

    return of


def _held(rows: DataFrame, name: str) -> DataFrame:
    """Least document (``lo``) of every (``v``, ``h``) that several documents hold."""
    return written(rows.groupBy("v", "h").agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
                   .where("lo < hi").select("v", "h", "lo"), name)


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      window: int = WINDOW, q: int = Q) -> DataFrame:
    """(``doc_id``, ``start``, ``length``, ``first_doc_id``): merged duplicate spans in words.

    Every ``window`` words of a span stand in some document of a smaller id; ``first_doc_id`` is the
    least of these documents (a merged span as a whole need not stand in one of them).
    """
    text = F.col(text_col)
    source = (docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("key"),
                          text.alias("text")).where("id is not null"))
    row, doc = ["id", "key"], ["s1", "s2", "n"]
    base = written(arrow_map(source, _scan(window, q), "id long, key long, n long, s1 long, s2 long, "
                             "found array<struct<v:bigint,c:bigint,pos:int>>"), "suffix-scan")
    # tables of one row a key are written before a join: two shuffled tables, of which the
    # join can split a hot key's rows at run time
    firsts = written(base.where(F.col("n") >= window).groupBy(*doc).agg(F.min("id").alias("first")),
                     "suffix-first")
    copies = (base.select(*row, *doc).join(firsts, doc).where("id > first")
              .select(*row, F.lit(0).alias("start"), F.col("n").cast("int").alias("end"),
                      F.col("first").alias("ref")))

    found = base.select(*row, "n", F.explode("found").alias("f")).select(*row, "n", "f.*")
    same = found.groupBy("v", "c").agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
    starts = written(same.groupBy("v").agg(F.count(F.lit(1)).alias("contexts"), F.min("lo").alias("vlo"),
                                           F.max("hi").alias("vhi")).where("vlo < vhi"), "suffix-starts")
    shared = written(same.join(starts, "v")
                     .select("v", "c", "lo", "hi", (F.col("contexts") > 1).alias("many"))
                     .where("lo < hi or many").select("v", "c", "lo", "many"), "suffix-shared")
    marked = written(found.join(shared, ["v", "c"]).where("id > lo or many")
                     .select(*row, "n", "pos", "lo"), "suffix-marked")
    whole = marked.where("id > lo").select(
        *row, F.greatest(F.col("pos") - (window - q), F.lit(0)).alias("start"),
        F.least(F.col("pos") + window, F.col("n")).cast("int").alias("end"), F.col("lo").alias("ref"))
    whole = whole.where(F.col("end") - F.col("start") >= window)

    kept = marked.where("id = lo").groupBy(*row).agg(F.collect_set("pos").alias("marks"))
    sample = written(arrow_map(source.join(kept, row), _samples(window, q), _SAMPLE), "suffix-samples")
    span = [*row, "start", "end", "ref"]
    place = [*row, "pos"]
    crowds = written(sample.groupBy("v").count().where(F.col("count") > NEIGHBOURS).select("v"), "suffix-crowds")
    few = sample.join(crowds, "v", "left_anti")
    crowded = written(sample.join(crowds, "v"), "suffix-crowded")

    order = ["v", "nexts", "id", "pos"]
    suffixes = few.select(*_SUFFIX).repartitionByRange(*order).sortWithinPartitions(*order)
    compared = written(map_in_arrow(suffixes, _compare(window, q), _FOUND), "suffix-spans")
    # the edge rows, a fixed number a partition, meet in one task
    edges = (compared.where("end is null").select(*_SUFFIX[:3], *row, F.col("start").alias("pos"))
             .distinct().coalesce(1).sortWithinPartitions(*order))
    again = map_in_arrow(edges, _compare(window, q), _FOUND)
    spans = (whole.unionByName(copies).unionByName(compared.where("end is not null").select(*span))
             .unionByName(again.where("end is not null").select(*span)))

    halves = written(arrow_map(crowded.select(*_SUFFIX), _halves(window, q),
                               "v long, h long, id long, key long, pos int, after boolean"), "suffix-halves")
    sides = (halves.join(_held(halves, "suffix-sides"), ["v", "h"]).groupBy(*place)
             .agg(F.max(~F.col("after")).alias("before"), F.max("after").alias("after")))
    windows = written(arrow_map(crowded.join(sides, place).select(*_SUFFIX, "before", "after"), _around(window, q),
                                "v long, h long, id long, key long, pos int, start int"), "suffix-windows")
    # the windows around one place all hold its q-gram, so their union is one span
    spans = spans.unionByName(
        windows.join(_held(windows, "suffix-index"), ["v", "h"]).where("id > lo").groupBy(*place)
        .agg(F.min("start").alias("start"), (F.max("start") + window).alias("end"), F.min("lo").alias("ref"))
        .select(*span))

    # spans of a document merge where they meet: a new one starts beyond all ends so far
    so_far = Window.partitionBy(*row).orderBy("start", "end", "ref")
    upto = F.max("end").over(so_far.rowsBetween(Window.unboundedPreceding, -1))
    opened = spans.distinct().withColumn("opens", (F.col("start") > F.coalesce(upto, F.lit(-1))).cast("int"))
    numbered = opened.withColumn("part", F.sum("opens").over(so_far))
    return (numbered.groupBy(*row, "part")
            .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min("ref").alias("ref"))
            .select(F.col("id").alias("doc_id"), "start", (F.col("end") - F.col("start")).alias("length"),
                    F.col("ref").alias("first_doc_id")))
