"""Quality classifier: a generalised additive model with pairwise interactions.

*Model.* Each feature is cut into at most ``BINS`` quantile bins and has a lookup table;
so has each of the ``PAIRS`` pairs of features that explain most of what is left. Tables
are learnt by cyclic boosting: round after round each feature in turn gets a shallow tree
(depth two) on its own bins, fitted to the gradient of the logistic loss and added to its
table with a small rate; then the pairs, in the same way, on two-feature trees.

*Scoring* adds the table entries of a document's bins, vectorised over a batch.

*Features* are shape measures of the whole text: lengths, rates of capitals, marks,
symbols and digits, repeated neighbours, words, three-word windows and lines. Language,
source, id and labels are no inputs.

*Learning* uses labelled rows with crc32(id as text) mod 3 other than 1, at most
``max_train`` of them (documented bound; the first by a seeded hash of the id), so the
driver sees at most that many feature rows. The model is a few thousand numbers and goes
to the tasks in their code.

Scale: one pass over the texts writes a row of features per document; training reads the
labelled ones; scoring is a pass over the features, without a shuffle.

Null and empty texts have all features 0 and get the score of that. A null id is scored
and never trained on; ids with several labels count by their mean, rounded; null labels
are left out. Without labels every score is 0.5. Repeated rows are scored alike. Extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.tables import arrow_map, first_by_hash, written
from starmart.llm.text import buffers, grams, slices, word_hashes, words

BINS, PAIR_BINS, PAIRS = 48, 12, 6
ROUNDS, PAIR_ROUNDS, RATE = 120, 60, 0.15
MAX_TRAIN = 40_000
FEATURES = ["log_words", "word_bytes", "capitals", "exclaims", "pipes", "symbols", "digits", "stops",
            "twin_words", "new_words", "repeat_windows", "lines", "repeat_lines", "long_words"]


def _per_row(at: np.ndarray, off: np.ndarray) -> np.ndarray:
    """How many of the ascending byte positions lie in each row."""
    return np.diff(np.searchsorted(at, off)).astype(float)


def _distinct(values: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Distinct values in each row (by the hash bits that fit beside the row number)."""
    if not len(values):
        return np.zeros(rows)
    shift = np.uint64(64 - max(1, int(rows).bit_length()))
    key = np.sort((row.astype(np.uint64) << shift) | (values >> (np.uint64(64) - shift)))
    new = np.ones(len(key), dtype=bool)
    new[1:] = key[1:] != key[:-1]
    return np.bincount((key[new] >> shift).astype(np.int64), minlength=rows).astype(float)


# marks by class: 0 for none, else the place of the class in _CLASSES
_CLASSES = {"exclaims": "!", "pipes": "|", "symbols": "#*$%&<>", "digits": "0123456789", "stops": ".,;:?"}
_CLASS = np.zeros(256, dtype=np.uint8)
for _k, _chars in enumerate(_CLASSES.values()):
    _CLASS[list(_chars.encode())] = _k + 1


def features(column: pa.Array) -> np.ndarray:
    """Feature matrix (rows x features) of a text column."""
    data, off = buffers(column)
    w = words(column)
    rows = len(off) - 1
    n = np.maximum(np.diff(w.first).astype(float), 1.0)
    size = (w.end - w.start).astype(np.int64)
    total = np.bincount(w.row, size, rows)
    chars = np.maximum(total, 1.0)
    # capitals: A-Z, and U+00C0-U+00DE as their second byte after 0xC3
    capital = (data >= 65) & (data <= 90)
    lead = np.flatnonzero(data[:-1] == 0xC3) + 1
    capital[lead[(data[lead] >= 0x80) & (data[lead] <= 0x9E)]] = True
    out = {"log_words": np.log1p(np.diff(w.first)), "word_bytes": total / n,
           "capitals": _per_row(np.flatnonzero(capital), off) / chars}
    kind = _CLASS[data]
    marked = np.flatnonzero(kind)
    kind = kind[marked]
    for k, name in enumerate(_CLASSES):
        out[name] = _per_row(marked[kind == k + 1], off) / n
    twin = np.zeros(len(w.hash), dtype=bool)
    if len(twin):
        twin[1:] = (w.hash[1:] == w.hash[:-1]) & (w.row[1:] == w.row[:-1])
    out["twin_words"] = np.bincount(w.row[twin], minlength=rows) / n
    out["new_words"] = _distinct(w.hash, w.row, rows) / n
    g, ok = grams(w.hash, w.row, 3)
    at = np.flatnonzero(ok)
    windows = np.bincount(w.row[at], minlength=rows)
    out["repeat_windows"] = (windows - _distinct(g[at], w.row[at], rows)) / np.maximum(windows, 1)
    # lines with a word, by hash
    cut = np.flatnonzero(data == 10)
    start = np.unique(np.concatenate([off[:-1], cut + 1]))
    start = start[start < len(data)]
    end = np.append(start[1:], len(data))
    owner = np.searchsorted(off, start, side="right") - 1
    filled = np.searchsorted(w.start, end) > np.searchsorted(w.start, start)
    start, end, owner = start[filled], end[filled], owner[filled]
    line = word_hashes(data, start, end - (data[end - 1] == 10)) if len(start) else start.view(np.uint64)
    n_lines = np.bincount(owner, minlength=rows)
    out["lines"] = n_lines / n
    out["repeat_lines"] = (n_lines - _distinct(line, owner, rows)) / np.maximum(n_lines, 1)
    out["long_words"] = np.bincount(w.row[size > 14], minlength=rows) / n
    return np.stack([np.asarray(out[f], dtype=float) for f in FEATURES], axis=1)


@dataclass
class Model:
    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)       # per feature
    tables: list[np.ndarray] = field(default_factory=list)      # per feature: value of each bin
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)      # per feature: fine bin -> pair bin

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        bins = [np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(self.edges)]
        for f, table in enumerate(self.tables):
            total += table[bins[f]]
        for i, j, table in self.pairs:
            total += table[self.coarse[i][bins[i]], self.coarse[j][bins[j]]]
        return 1.0 / (1.0 + np.exp(-np.clip(total, -30, 30)))


def _best_cut(g: np.ndarray, h: np.ndarray) -> tuple[int, float]:
    """Cut (bins before it go left) of most gain, and the gain."""
    if len(g) < 2:
        return 0, 0.0
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = gl ** 2 / (hl + 1) + gr ** 2 / (hr + 1) - g.sum() ** 2 / (h.sum() + 1)
    k = int(np.argmax(gain))
    return (k + 1, float(gain[k])) if gain[k] > 1e-9 else (0, 0.0)


def _shallow_tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """Leaf value of each bin of a tree of the given depth on one feature."""
    cut, _ = _best_cut(g, h) if depth else (0, 0.0)
    if not cut:
        return np.full(len(g), g.sum() / (h.sum() + 1))
    return np.concatenate([_shallow_tree(g[:cut], h[:cut], depth - 1),
                           _shallow_tree(g[cut:], h[cut:], depth - 1)])


def _pair_tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Leaf values of a depth-two tree: one cut of the first feature, then of the second."""
    def split(axis: int) -> tuple[float, np.ndarray]:
        a, b = (g, h) if axis == 0 else (g.T, h.T)
        cut, gain = _best_cut(a.sum(axis=1), b.sum(axis=1))
        out = np.empty_like(a)
        for rows in ((slice(0, cut), slice(cut, None)) if cut else (slice(None),)):
            inner, more = _best_cut(a[rows].sum(axis=0), b[rows].sum(axis=0))
            gain += more
            for cols in ((slice(0, inner), slice(inner, None)) if inner else (slice(None),)):
                out[rows, cols] = a[rows, cols].sum() / (b[rows, cols].sum() + 1)
        return gain, out if axis == 0 else out.T

    return max((split(0), split(1)), key=lambda s: s[0])[1]


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Cyclic boosting of feature tables, then of pair tables."""
    if not len(y):
        return Model()
    rate = (y.sum() + 1) / (len(y) + 2)
    model = Model(base=float(np.log(rate / (1 - rate))))
    for f in range(x.shape[1]):
        cuts = np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])
        model.edges.append(np.unique(cuts))
        size = len(model.edges[f]) + 1
        model.tables.append(np.zeros(size))
        model.coarse.append((np.arange(size) * min(PAIR_BINS, size) // size).astype(np.int64))
    bins = [np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(model.edges)]
    total = np.full(len(y), model.base)

    def slope() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, np.maximum(p * (1 - p), 1e-6)

    for _ in range(ROUNDS):
        for f, table in enumerate(model.tables):
            g, h = slope()
            step = RATE * _shallow_tree(np.bincount(bins[f], g, len(table)), np.bincount(bins[f], h, len(table)))
            table += step
            total += step[bins[f]]

    sizes = [int(c.max()) + 1 for c in model.coarse]
    coarse = [c[b] for c, b in zip(model.coarse, bins)]

    def square(i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        cell, shape = coarse[i] * sizes[j] + coarse[j], (sizes[i], sizes[j])
        g, h = slope()
        n = sizes[i] * sizes[j]
        return np.bincount(cell, g, n).reshape(shape), np.bincount(cell, h, n).reshape(shape)

    left = []
    for i in range(len(sizes)):
        for j in range(i):
            g, h = square(i, j)
            left.append((float((g ** 2 / (h + 1)).sum()), i, j))
    chosen = [(i, j) for _, i, j in sorted(left, reverse=True)[:PAIRS]]
    model.pairs = [(i, j, np.zeros((sizes[i], sizes[j]))) for i, j in chosen]
    for _ in range(PAIR_ROUNDS):
        for i, j, table in model.pairs:
            step = RATE * _pair_tree(*square(i, j))
            table += step
            total += step[coarse[i], coarse[j]]
    return model


def _feature_rows(keep: list[str]):
    def of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in slices(batch):
            x = features(part.column("text"))
            at = np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]
            column = pa.ListArray.from_arrays(pa.array(at), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([*[part.column(k) for k in keep], column], [*keep, "x"])

    return of


def remainder(id_column):
    """crc32(id as text) mod 3; a null id counts as the empty text."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % 3


def train(rows: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
          max_train: int = MAX_TRAIN) -> Model:
    """Model from feature rows (``doc_id``, ``x``) and labels; at most ``max_train`` rows."""
    label = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).cast("string").alias("id"))
             .agg(F.round(F.avg(label_col)).cast("int").alias("y")))
    known = (rows.where(remainder(F.col("doc_id")) != 1)
             .select(F.col("doc_id").cast("string").alias("id"), "x").join(label, "id"))
    sample = first_by_hash(known, "id", max_train).select("x", "y").toArrow()
    if not sample.num_rows:
        return Model()
    x = np.array(sample.column("x").combine_chunks().flatten()).reshape(sample.num_rows, -1)
    return fit(x, sample.column("y").to_numpy().astype(float))


def _scorer(model: Model, keep: list[str]):
    def of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if not batch.num_rows:
            return
        x = np.array(batch.column("x").flatten()).reshape(batch.num_rows, -1)
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(k) for k in keep], pa.array(model.score(x))], [*keep, "score"])

    return of


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "quality", max_train: int = MAX_TRAIN) -> DataFrame:
    """``doc_id``, ``text_key`` (hash of the text), ``held_out``, ``score``, ``predicted``."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_key"),
                         F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    rows = written(arrow_map(source, _feature_rows(["doc_id", "text_key"]),
                             f"doc_id {kind}, text_key long, x array<double>"), "features")
    model = train(rows, labels, label_col, id_col, max_train)
    scored = arrow_map(rows, _scorer(model, ["doc_id", "text_key"]),
                       f"doc_id {kind}, text_key long, score double")
    return scored.select("doc_id", "text_key", (remainder(F.col("doc_id")) == 1).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def _filter(model: Model, text_col: str):
    def of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in slices(batch, text_col):
            good = model.score(features(part.column(text_col))) >= 0.5
            if good.any():
                yield part.filter(pa.array(good))

    return of


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              label_col: str = "quality", max_train: int = MAX_TRAIN) -> DataFrame:
    """The rows of ``docs`` (all columns) that score 0.5 or more, in a pass without a shuffle."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    rows = written(arrow_map(source, _feature_rows(["doc_id"]), f"doc_id {kind}, x array<double>"),
                   "features")
    model = train(rows, labels, label_col, id_col, max_train)
    return arrow_map(docs, _filter(model, text_col), docs.schema)
