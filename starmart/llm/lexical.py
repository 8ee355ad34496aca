"""Ranked lexical search of a set of items over all documents, by a dual-tree search.

Terms are runs of ASCII letters and digits and of characters from U+0080 on, A-Z lower-cased.
With N documents that have a term, L their terms in all, n those of one document, df the
documents of a term and tf its occurrences in one, a term weighs
``w = floor(1000 ln((2N + 2) / (2 df + 1)))``, a document's ``m`` is ``10 + 90 n N div L``, and a
document scores for an item the sum over the item's terms of ``w * (10^9 tf div (1000 tf + 8 m))``,
in whole numbers. Each item gets its ``k`` documents of highest score above nought, equal scores
by ascending id.

*Dual tree.* Items and documents each stand in a hierarchy: documents that have their heaviest
term in common lie in one leaf, so do items. A document node holds, term by term, the greatest
part that the term adds to any of its documents (tf and m folded into one number), an item node
the weight of every term that any of its items has. The product of the two is a bound on every
score between the nodes. Pairs of nodes are opened level by level from the roots; a pair whose
bound is below the weakest k-th score so far among the node's items goes with all that is below
it. Leaf pairs that are left are scored exactly, those of the highest bounds first. A bound
equal to the k-th score is opened, as a smaller id could still win. So nothing is lost.

Scale: one pass over the texts leaves a row of (term, tf) per document, terms of the items only.
Counts come from it by partial aggregation. The search is a second pass, over those rows,
without a shuffle; a task holds the best k of each item and hands on no more than that. It
starts from k-th scores found among some thousand documents chosen by a hash: they bound the
final ones from below, so that tasks need not each find their own first. Items go to the tasks
with their code, in blocks of at most ``BLOCK_TERMS`` terms; a larger set of items is searched
block by block. Terms are compared by 64-bit hashes.

Null and empty texts have no terms: such documents count nowhere, such items have no rows. Rows
that repeat an id are documents of their own, equal scores of them in order of a hash of their
text; null ids come last. Items that repeat id and text count once, those with one id and
different texts are items of their own. Extra columns are ignored. Empty tables give an empty
table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.llm.tables import arrow_map, map_in_arrow, written
from starmart.llm.text import separators, slices, words

K = 10
DOC_LEAF, ITEM_LEAF, ARITY = 16, 8, 4
GROUP_ITEMS, CHUNK_CELLS, CHUNK_DOCS = 128, 4_000_000, 2048
SEED_DOCS, BLOCK_TERMS = 4096, 2_000_000
_TERMS = separators(keep_alnum_only=True)
_EXACT = float(1 << 53)


def _item_terms(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Distinct term hashes of each item."""
    for part in slices(batch):
        w = words(part.column("text"), fold=True, sep=_TERMS)
        found = [np.unique(w.hash[a:b]).view(np.int64) for a, b in zip(w.first[:-1], w.first[1:])]
        ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
        column = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *found])))
        yield pa.RecordBatch.from_arrays([part.column("item_id"), part.column("text_key"), column],
                                         ["item_id", "text_key", "terms"])


def _profiles(vocabulary: np.ndarray):
    """Number of terms, and (item term, tf) of each document that has a term."""
    size = len(vocabulary)

    def of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in slices(batch):
            w = words(part.column("text"), fold=True, sep=_TERMS)
            n = np.diff(w.first)
            place = np.searchsorted(vocabulary, w.hash)
            hit = np.flatnonzero(vocabulary[np.minimum(place, size - 1)] == w.hash)
            key, tf = np.unique(w.row[hit] * size + place[hit], return_counts=True)
            some = np.flatnonzero(n)
            row = np.searchsorted(some, key // size)             # rows with a term only
            ends = np.searchsorted(row, np.arange(len(some) + 1)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x.astype(np.int32))) for x in (key % size, tf)]
            rows = part.take(pa.array(some))
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), rows.column("text_key"), pa.array(n[some].astype(np.int64)), *lists],
                ["doc_id", "text_key", "n", "terms", "tfs"])

    return of


class Corpus(NamedTuple):
    documents: int      # with a term
    terms: int          # with repeats


class Items(NamedTuple):
    """Items of a block as lists of places in its vocabulary; weights by place."""
    first: np.ndarray
    terms: np.ndarray
    weight: np.ndarray
    least: np.ndarray   # a score that each item's k-th best reaches at least (0: not known)


def _maxima(matrix: np.ndarray, width: int, axis: int) -> np.ndarray:
    return np.maximum.reduceat(matrix, np.arange(0, matrix.shape[axis], width), axis=axis)


def _levels(matrix: np.ndarray, leaf: int, axis: int) -> list[np.ndarray]:
    """Coordinate maxima of the nodes, leaves first."""
    out = [_maxima(matrix, leaf, axis)]
    while out[-1].shape[axis] > 1:
        out.append(_maxima(out[-1], ARITY, axis))
    return out


def _children(alive: np.ndarray, count: int, axis: int) -> np.ndarray:
    out = np.repeat(alive, ARITY, axis=axis)
    return out[:count] if axis == 0 else out[:, :count]


class Group:
    """Some items, their terms as columns, and the item hierarchy over them."""

    def __init__(self, members: np.ndarray, items: Items):
        self.members = members
        lists = [items.terms[items.first[i]:items.first[i + 1]] for i in members]
        self.columns = np.unique(np.concatenate(lists))
        weights = np.zeros((len(self.columns), len(members)))
        for j, terms in enumerate(lists):
            weights[np.searchsorted(self.columns, terms), j] = items.weight[terms]
        if weights.sum(axis=0).max(initial=0) * 1e6 >= _EXACT:   # doubles would round: whole numbers
            weights = weights.astype(np.int64)
        self.weights, self.levels = weights, _levels(weights, ITEM_LEAF, 1)
        self.leaf_columns = [np.flatnonzero(self.levels[0][:, j]) for j in range(self.levels[0].shape[1])]


def groups(items: Items) -> list[Group]:
    """Items in order of the term that weighs most among those shared with other items."""
    n = len(items.first) - 1
    shared = np.bincount(items.terms, minlength=len(items.weight)) > 1
    value = np.where(shared, items.weight, 0) + 1
    order = sorted(range(n), key=lambda i: (
        lambda t: (int(t[np.argmax(value[t])]), i) if len(t) else (-1, i))(items.terms[items.first[i]:items.first[i + 1]]))
    order = np.array([i for i in order if items.first[i] < items.first[i + 1]], dtype=np.int64)
    return [Group(order[a:a + GROUP_ITEMS], items) for a in range(0, len(order), GROUP_ITEMS)]


class Best:
    """The best ``k`` documents of every item so far: (score, id order, hash, id)."""

    def __init__(self, items: Items, k: int):
        self.k, self.floor = k, np.maximum(items.least.astype(float), 1.0)
        self.rows: list[list[tuple]] = [[] for _ in range(len(items.first) - 1)]
        self.opened = self.pairs = 0                             # for tests: leaf pairs scored, of all

    def add(self, item: int, scores: np.ndarray, docs: np.ndarray, ids: list, hashes: np.ndarray) -> None:
        at = np.flatnonzero(scores >= self.floor[item])
        if not len(at):
            return
        new = [(-int(scores[i]), ids[docs[i]] is None, ids[docs[i]] if ids[docs[i]] is not None else 0,
                int(hashes[docs[i]])) for i in at]
        if len(self.rows[item]) >= self.k:
            new = [r for r in new if r < self.rows[item][-1]]
        self.rows[item] = sorted(self.rows[item] + new)[:self.k]
        if len(self.rows[item]) >= self.k:
            self.floor[item] = max(self.floor[item], float(-self.rows[item][-1][0]))


def search_chunk(x: np.ndarray, group: Group, best: Best, ids: list, hashes: np.ndarray) -> None:
    """Search of one chunk of documents (rows: parts by the group's columns) for one group of items."""
    docs, items = _levels(x, DOC_LEAF, 0), group.levels
    floors = [np.minimum.reduceat(best.floor[group.members], np.arange(0, len(group.members), ITEM_LEAF))]
    while len(floors) < len(items):
        floors.append(np.minimum.reduceat(floors[-1], np.arange(0, len(floors[-1]), ARITY)))
    d, i = len(docs) - 1, len(items) - 1
    alive = np.ones((docs[d].shape[0], items[i].shape[1]), dtype=bool)
    while True:
        rows, cols = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
        bound = np.zeros(alive.shape)
        if len(rows) and len(cols):
            bound[np.ix_(rows, cols)] = docs[d][rows] @ items[i][:, cols]
        alive &= bound >= floors[i]
        if not d and not i:
            break
        if d:
            d -= 1
            alive = _children(alive, docs[d].shape[0], 0)
        if i:
            i -= 1
            alive = _children(alive, items[i].shape[1], 1)
    best.pairs += alive.size
    for leaf in range(alive.shape[1]):
        there = np.flatnonzero(alive[:, leaf])
        there = there[np.argsort(-bound[there, leaf], kind="stable")]
        inside = slice(leaf * ITEM_LEAF, min((leaf + 1) * ITEM_LEAF, len(group.members)))
        columns, members = group.leaf_columns[leaf], group.members[inside]
        weights, step, at = group.weights[columns, inside], 2, 0
        while at < len(there):
            some = there[at:at + step]
            some = some[bound[some, leaf] >= best.floor[members].min()]
            if not len(some):
                break
            best.opened += len(some)
            rows = (some[:, None] * DOC_LEAF + np.arange(DOC_LEAF)).ravel()
            rows = rows[rows < len(x)]
            scores = x[np.ix_(rows, columns)] @ weights
            for j, item in enumerate(members):
                best.add(item, scores[:, j], rows, ids, hashes)
            at, step = at + step, min(step * 2, 32)


def parts(tf: np.ndarray, n: np.ndarray, corpus: Corpus) -> np.ndarray:
    """What one unit of weight adds for each (tf, terms of the document)."""
    tf, n = tf.astype(np.int64), n.astype(np.int64)
    m = 10 + (90 * n * corpus.documents) // corpus.terms
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def search_batch(batch: pa.RecordBatch, made: list[Group], items: Items, corpus: Corpus, best: Best) -> None:
    """Search of a batch of profiles for all groups."""
    begin = batch.column("terms").offsets.to_numpy().astype(np.int64)
    base, end = begin[0], begin[-1]
    terms = batch.column("terms").values.to_numpy()[base:end]
    tfs = batch.column("tfs").values.to_numpy()[base:end]
    begin = begin - base
    size = np.diff(begin)
    value = parts(tfs, np.repeat(batch.column("n").to_numpy(), size), corpus)
    ids, hashes = batch.column("doc_id").to_pylist(), batch.column("text_key").to_numpy()
    # documents that share their heaviest term lie together
    row = np.repeat(np.arange(len(size)), size)
    heavy = np.lexsort((value * items.weight[terms], row))
    full = np.flatnonzero(size)
    head = np.full(len(size), -1, dtype=np.int64)
    head[full] = terms[heavy[begin[1:][full] - 1]]
    order = full[np.lexsort((full, head[full]))]
    at = 0
    widest = max(len(g.columns) for g in made)
    step = int(min(max(CHUNK_CELLS // widest, DOC_LEAF), CHUNK_DOCS))
    while at < len(order):
        chosen = order[at:at + step]
        at += step
        n = size[chosen]
        cell = np.repeat(begin[chosen] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        owner, term, add = np.repeat(np.arange(len(chosen)), n), terms[cell], value[cell]
        some_ids, some_hashes = [ids[i] for i in chosen], hashes[chosen]
        for group in made:
            place = np.searchsorted(group.columns, term)
            hit = group.columns[np.minimum(place, len(group.columns) - 1)] == term
            x = np.zeros((len(chosen), len(group.columns)), dtype=group.weights.dtype)
            x[owner[hit], place[hit]] = add[hit]
            search_chunk(x, group, best, some_ids, some_hashes)


def _searcher(items: Items, corpus: Corpus, k: int, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, best = groups(items), Best(items, k)
        for batch in batches:
            if batch.num_rows:
                search_batch(batch, made, items, corpus, best)
        flat = [(i, -s, None if none else d, h) for i, rows in enumerate(best.rows) for s, none, d, h in rows]
        columns = list(zip(*flat)) if flat else [(), (), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()), pa.array(columns[2], id_type),
             pa.array(columns[3], pa.int64())], ["item", "score", "doc_id", "text_key"])

    return run


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "text_key")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search_block(source: DataFrame, block: pa.Table, k: int) -> DataFrame:
    """Best ``k`` documents of the items in ``block`` (``terms``: lists of hashes), by their place in it."""
    lists = block.column("terms").combine_chunks()
    first = lists.offsets.to_numpy().astype(np.int64)
    hashes = lists.values.to_numpy()[first[0]:first[-1]].view(np.uint64)
    first = first - first[0]
    vocabulary, place = np.unique(hashes, return_inverse=True)
    id_field = source.schema["doc_id"]
    kind = id_field.dataType.simpleString()
    profiles = written(arrow_map(
        source, _profiles(vocabulary),
        f"doc_id {kind}, text_key long, n long, terms array<int>, tfs array<int>"), "lexical-profiles")
    total = profiles.agg(F.count(F.lit(1)).alias("d"), F.coalesce(F.sum("n"), F.lit(0)).alias("t")).first()
    corpus = Corpus(total.d, max(total.t, 1))
    counts = profiles.select(F.explode("terms").alias("t")).groupBy("t").count().toArrow()
    df = np.zeros(len(vocabulary), dtype=np.int64)
    df[counts.column("t").to_numpy()] = counts.column("count").to_numpy()
    weight = np.array([math.floor(1000 * math.log((2 * corpus.documents + 2) / (2 * int(c) + 1))) for c in df],
                      dtype=np.int64)
    none = Items(first, place.astype(np.int64), weight, np.zeros(len(first) - 1, dtype=np.int64))
    id_type = pa.string() if isinstance(id_field.dataType, T.StringType) else pa.int64()
    schema = f"item int, score long, doc_id {kind}, text_key long"

    def search(rows: DataFrame, items: Items) -> DataFrame:
        return _top(map_in_arrow(rows.select("doc_id", "text_key", "n", "terms", "tfs"),
                                 _searcher(items, corpus, k, id_type), schema), k)

    # any k documents bound an item's k-th score from below; a hash picks some thousand
    share = min(1.0, SEED_DOCS / max(corpus.documents, 1))
    seeds = profiles.where(F.pmod(F.xxhash64("text_key", "doc_id"), F.lit(1 << 31)) < int(share * (1 << 31)))
    known = search(seeds, none).where(F.col("rank") == k).select("item", "score").toArrow()
    least = none.least.copy()
    least[known.column("item").to_numpy()] = known.column("score").to_numpy()
    return search(profiles, none._replace(least=least))


def rank_documents(docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text_col: str = "text",
                   block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``item_id``, ``rank`` (from 1), ``doc_id``, ``score`` of each item's best ``k`` documents."""
    spark = docs.sparkSession
    asked = (items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text"))
             .dropDuplicates(["item_id", "text"]).withColumn("text_key", F.xxhash64("text")))
    kind = asked.schema["item_id"].dataType.simpleString()
    terms = written(arrow_map(asked, _item_terms, f"item_id {kind}, text_key long, terms array<long>")
                    .where(F.size("terms") > 0), "lexical-items")
    source = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_key"),
                         F.col(text_col).alias("text"))
    if isinstance(source.schema["doc_id"].dataType, T.IntegralType):
        source = source.withColumn("doc_id", F.col("doc_id").cast("long"))
    else:
        source = source.withColumn("doc_id", F.col("doc_id").cast("string"))
    kind_of_doc = source.schema["doc_id"].dataType.simpleString()
    total = terms.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0)).alias("n")).first().n
    blocks = -(-total // block_terms)
    schema = f"item_id {kind}, rank int, doc_id {kind_of_doc}, score long"
    result = None
    for b in range(blocks):
        # at most about block_terms hashes, or one item, come to the driver at a time
        mine = terms.where(F.pmod(F.xxhash64(F.col("item_id").cast("string"), "text_key"), F.lit(blocks)) == b)
        block = mine.toArrow()
        if not block.num_rows:
            continue
        names = spark.createDataFrame(
            pa.table({"item": pa.array(np.arange(block.num_rows, dtype=np.int32)),
                      "item_id": block.column("item_id")}))
        found = _search_block(source, block, k)
        # the block's item ids: bounded as the block is
        part = (found.join(F.broadcast(names.withColumnRenamed("item", "i")), F.col("item") == F.col("i"))
                .select(F.col("item_id").cast(kind).alias("item_id"), "rank", "doc_id", "score"))
        result = part if result is None else result.unionByName(part)
    return result if result is not None else spark.createDataFrame([], schema)
