"""Toxicity: logistic regression by FTRL-proximal over hashed word n-grams and skip-grams.

*Features* of a whole text, each counted once: its words (runs of ASCII letters and digits and
of bytes from 0x80 on, A-Z lower-cased), pairs of neighbours, and skip-grams (pairs with one
and with two words between them), hashed into ``2 ** BITS`` places. Language, source, id and
labels are no inputs.

*Learning* is FTRL-proximal: every coordinate has its own falling rate, and the L1 term keeps
a weight at nought until its gradients add up to more than ``L1``. So the model is a short list
of (place, weight), which goes to the tasks in their code. It runs over a bounded sample in one
task: rows with crc32(id as text) mod 4 other than 2, the first by a hash of the id, at most
``max_train`` of them (ids) and at most ``TRAIN_BYTES`` of text. Their features are made where
the texts lie. ``EPOCHS`` passes are made in the order of that hash, so equal tables give equal
weights.

*Scoring* adds the weights of a text's places: one pass over the texts without a shuffle.

Scale: two scans of the texts, the first filtered to the sample by a broadcast of at most
``max_train`` id hashes. The sample's ids are cut by a hash threshold taken from their number
before they are sorted, so no task sees more than a few thousand over ``max_train`` of them.

Null and empty texts have no features and get the score of the bias alone. A null id is scored
and never trained on; ids with several labels count by their mean, rounded half up; null labels
are left out; of rows that repeat an id one text is trained on (the least by a hash). Without
labels every score is 0.5. Repeated rows are scored alike. Extra columns are ignored. An empty
table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.tables import arrow_map, first_by_hash, map_in_arrow, written
from starmart.llm.text import mix, separators, slices, stream, words

BITS = 20
SKIPS = (1, 2, 3)          # distance of the second word of a pair: neighbour, one and two between
MAX_TRAIN, TRAIN_BYTES = 20_000, 48 << 20
ALPHA, BETA, L1, L2 = 2.0, 1.0, 5.0, 0.1
EPOCHS = 3
HELD_OUT, CUT = 2, 0.3
_KIND = stream(131, len(SKIPS) + 1)
_TERMS = separators(keep_alnum_only=True)


def places(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, place) of every word, pair and skip-gram of a text column, with repeats."""
    w = words(column, fold=True, sep=_TERMS)
    down = np.uint64(64 - BITS)
    rows, found = [w.row], [mix(w.hash ^ _KIND[0]) >> down]
    for kind, gap in enumerate(SKIPS, start=1):
        if len(w.hash) <= gap:
            break
        same = w.row[gap:] == w.row[:-gap]
        first, second = w.hash[:-gap][same], w.hash[gap:][same]
        rows.append(w.row[:-gap][same])
        found.append(mix(first * (_KIND[kind] | np.uint64(1)) + second) >> down)
    return np.concatenate(rows), np.concatenate(found).astype(np.int64)


def _once(row: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each place once a row, in order of row and place."""
    key = np.unique((row << BITS) | place)
    return key >> BITS, key & ((1 << BITS) - 1)


class Weights(NamedTuple):
    """Bias and the weights that L1 left: as small as the model itself."""
    bias: float
    place: np.ndarray
    weight: np.ndarray

    def dense(self) -> np.ndarray:
        table = np.zeros(1 << BITS)
        table[self.place] = self.weight
        return table


def score(column: pa.Array, weights: Weights, table: np.ndarray) -> np.ndarray:
    """Probability of label 1 of each text; ``table`` is ``weights.dense()``."""
    row, place = places(column)
    heavy = table[place] != 0
    row, place = _once(row[heavy], place[heavy])
    total = weights.bias + np.bincount(row, table[place], len(column))
    return 1.0 / (1.0 + np.exp(-np.clip(total, -30, 30)))


class Ftrl:
    """FTRL-proximal state: per coordinate the summed gradients, corrected for the weights in
    force (``z``), and the summed squares (``n``). The last coordinate is the bias, free of L1."""

    def __init__(self, size: int = 1 << BITS):
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)
        self.l1 = np.full(size + 1, L1)
        self.l1[size] = 0.0

    def at(self, where: np.ndarray) -> np.ndarray:
        z, l1 = self.z[where], self.l1[where]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - l1, 0.0)
        return -shrunk / ((BETA + np.sqrt(self.n[where])) / ALPHA + L2)

    def learn(self, place: np.ndarray, label: float) -> None:
        """One text (distinct places) and its label."""
        where = np.append(place, len(self.z) - 1)
        w = self.at(where)
        g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -30, 30))) - label
        n = self.n[where]
        self.z[where] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[where] = n + g * g

    def weights(self) -> Weights:
        all_of_them = self.at(np.arange(len(self.z)))
        place = np.flatnonzero(all_of_them[:-1])
        return Weights(float(all_of_them[-1]), place, all_of_them[place])


def _sample_features(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for part in slices(batch):
        row, place = _once(*places(part.column("text")))
        ends = np.searchsorted(row, np.arange(part.num_rows + 1))
        column = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(place.astype(np.int32)))
        yield pa.RecordBatch.from_arrays([part.column("turn"), part.column("y"), column], ["turn", "y", "x"])


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weights from the sample's features, in order of their turns; the bias as place -1."""
    texts: list[tuple[int, float, np.ndarray]] = []
    for batch in batches:
        x = batch.column("x")
        ends, flat = x.offsets.to_numpy(), x.values.to_numpy()
        texts += [(turn, float(y), flat[a:b].copy()) for turn, y, a, b in zip(
            batch.column("turn").to_pylist(), batch.column("y").to_pylist(), ends[:-1], ends[1:])]
    if not texts:
        return
    texts.sort(key=lambda t: t[0])
    model = Ftrl()
    for _ in range(EPOCHS):
        for _turn, label, place in texts:
            model.learn(place, label)
    found = model.weights()
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(found.place, -1), pa.int32()), pa.array(np.append(found.weight, found.bias))],
        ["place", "weight"])


def remainder(id_column: Column) -> Column:
    """crc32(id as text) mod 4; a null id counts as the empty text."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % 4


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id",
          text_col: str = "text", max_train: int = MAX_TRAIN, max_bytes: int = TRAIN_BYTES) -> Weights:
    """Weights from the labelled texts outside the held-out remainder."""
    known = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()
                          & (remainder(F.col(id_col)) != HELD_OUT))
             .groupBy(F.col(id_col).cast("string").alias("id"))
             .agg(F.round(F.avg(label_col)).cast("int").alias("y")))
    chosen = written(first_by_hash(known, "id", max_train).select(F.xxhash64("id").alias("k"), "y"),
                     "toxicity-ids")
    # proven bound: max_train rows of 12 bytes
    texts = (docs.where(F.col(id_col).isNotNull() & (remainder(F.col(id_col)) != HELD_OUT))
             .select(F.xxhash64(F.col(id_col).cast("string")).alias("k"), F.col(text_col).alias("text"))
             .join(F.broadcast(chosen), "k"))
    one = (texts.groupBy("k", "y").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("t"))
           .select("k", "y", "t.text"))
    one = written(one, "toxicity-texts")
    # at most max_train rows of numbers meet in this window
    by_turn = Window.orderBy(F.xxhash64("k"), "k").rowsBetween(Window.unboundedPreceding, 0)
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    turns = written(one.select("k", size.alias("size"))
                    .select("k", F.row_number().over(Window.orderBy(F.xxhash64("k"), "k")).alias("turn"),
                            F.sum("size").over(by_turn).alias("upto"))
                    .where((F.col("upto") <= max_bytes) | (F.col("turn") == 1)).select("k", "turn"),
                    "toxicity-turns")
    sample = one.join(F.broadcast(turns), "k").select("turn", "y", "text")
    features = written(arrow_map(sample, _sample_features, "turn int, y int, x array<int>"), "toxicity-sample")
    model = map_in_arrow(features.repartition(1), _learn, "place int, weight double")
    found = written(model, "toxicity-weights").toArrow()
    place, weight = found.column("place").to_numpy(), found.column("weight").to_numpy()
    bias = float(weight[place < 0].sum())
    return Weights(bias, place[place >= 0].astype(np.int64), weight[place >= 0])


def _scorer(weights: Weights, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = weights.dense()
        for batch in batches:
            for part in slices(batch):
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(k) for k in keep], pa.array(score(part.column("text"), weights, table))],
                    [*keep, "score"])

    return run


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic", max_train: int = MAX_TRAIN, cut: float = CUT) -> DataFrame:
    """``doc_id``, ``text_key`` (hash of the text), ``held_out``, ``score``, ``predicted``."""
    weights = train(docs, labels, label_col, id_col, text_col, max_train)
    source = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_key"),
                         F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    scored = map_in_arrow(source, _scorer(weights, ["doc_id", "text_key"]),
                          f"doc_id {kind}, text_key long, score double")
    return scored.select("doc_id", "text_key", (remainder(F.col("doc_id")) == HELD_OUT).alias("held_out"),
                         "score", (F.col("score") >= cut).cast("int").alias("predicted"))
