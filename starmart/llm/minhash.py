"""Near-duplicate documents by SuperMinHash signatures, banding and union-find.

Signature: each shingle of a document draws a random order of the ``m`` signature places,
one place a round; place ``s`` holds the least (round, random value) that any shingle
gives it. As the places a shingle reaches in successive rounds never repeat, the entries
are negatively correlated and vary less than independent minima. A document stops early,
once all its places are filled: no later round can change them.

Banding: ``bands`` x ``rows`` places; with 32 x 4 two documents of similarity 0.8 share no
band with probability (1 - 0.8^4)^32 < 5e-8, and more similar ones less often.

Verification is exact: 100 * |A & B| >= percent * |A | B| on the full shingle sets (64-bit
shingle hashes). Documents with equal sets form a class first (one representative goes
on, the least id), so exact copies are never compared, whatever their number.

A bucket is not expanded into all its pairs. In each of ``hub_rounds`` rounds every bucket
that still spans several groups names one hub, the member that shares most bands with
others, and every member of another group is checked against the hub alone; then links are
grouped and the hub leaves the bucket. So members of a group of near copies cost one check
each. What is left (members of one bucket, different groups) mostly shares a common passage
and no more. There two sets of the asked similarity must share one of the rarest shingles of
each: with shingles ordered by how many of these documents hold them, one of the first
``n - ceil(percent n / 100) + 1``. From the places i and j of the first one they share, they
have at most min(n - i, m - j) shingles in common. Only documents of different groups that
share such a shingle, at places that leave enough, are checked, which loses no link.

Scale: one pass over the texts for signatures and one over the documents that share a
bucket for their sets; everything else moves ids and 64-bit keys, partially aggregated.
Each round's tables are written to the shared folder.

Null or empty texts have no shingles, no links and are their own group. A text of fewer
words than a shingle has its whole word sequence as its only shingle. Rows that repeat an
id count as several documents of that id: sets are searched and compared one by one, under a
number of their own, and only links are told by id (all rows get the group of the id). Rows
without an id come back ungrouped and kept. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.components import components
from starmart.llm.tables import arrow_map, written
from starmart.llm.text import grams, mix, slices, stream, words

PLACES, BANDS, ROWS = 128, 32, 4
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_sets(column: pa.Array, n: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each row (A-Z folded)."""
    w = words(column, fold=True)
    g, _ = grams(w.hash, w.row, n)
    out = []
    for lo, hi in zip(w.first[:-1], w.first[1:]):
        if hi - lo >= n:
            out.append(np.unique(g[lo:hi - n + 1]))
        elif hi > lo:
            short, _ = grams(w.hash[lo:hi], w.row[lo:hi], int(hi - lo))
            out.append(short)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def superminhash(sets: list[np.ndarray], m: int = PLACES, seed: int = 8) -> np.ndarray:
    """Signature matrix (documents x m) of non-empty sets; entries are round and value."""
    sizes = np.array([len(s) for s in sets])
    sig = np.full(len(sets) * m, _FULL, dtype=np.uint64)
    element = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.tile(np.arange(m, dtype=np.uint8 if m <= 256 else np.uint32), (len(element), 1))
    live = np.arange(len(element))
    salts = stream(seed, m)
    for j in range(m):
        u = mix(element[live] ^ salts[j])
        pick = j + ((u >> np.uint64(32)) * np.uint64(m - j) >> np.uint64(32)).astype(np.int64)
        place = order[live, pick]
        order[live, pick] = order[live, j]
        slot = owner[live] * m + place
        value = (np.uint64(j) << np.uint64(56)) | ((u << np.uint64(8)) >> np.uint64(8))
        better = value < sig[slot]
        np.minimum.at(sig, slot[better], value[better])
        open_docs = sig.reshape(-1, m).max(axis=1) == _FULL
        if not open_docs.any():
            break
        live = live[open_docs[owner[live]]]
    return sig.reshape(-1, m)


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per document and band."""
    part = sig[:, :bands * rows].reshape(len(sig), bands, rows)
    key = np.zeros(part.shape[:2], dtype=np.uint64)
    for r in range(rows):
        key = mix(key * np.uint64(0x9FB21C651E98DF25) + part[:, :, r])
    return mix(key + stream(21, bands)[None, :])


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    sizes = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(sizes), pa.array(flat.view(np.int64)))


def _signatures(n: int, places: int, bands: int, rows: int):
    chunk = 1 << 17                                 # shingles signed at once

    def of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in slices(batch):
            sets = shingle_sets(part.column("text"), n)
            sizes = np.array([len(s) for s in sets], dtype=np.int64)
            salt = stream(31, 1)[0]
            k1 = np.array([np.bitwise_xor.reduce(mix(s)) if len(s) else 0 for s in sets], np.uint64)
            k2 = np.array([mix(s ^ salt).sum() if len(s) else 0 for s in sets], np.uint64)
            keys = [np.zeros(0, np.uint64)] * len(sets)
            at = 0
            while at < len(sets):
                to, total = at, 0
                while to < len(sets) and (to == at or total + sizes[to] <= chunk):
                    total += sizes[to]
                    to += 1
                some = [i for i in range(at, to) if sizes[i]]
                if some:
                    found = band_keys(superminhash([sets[i] for i in some], places), bands, rows)
                    for i, key in zip(some, found):
                        keys[i] = key
                at = to
            yield pa.RecordBatch.from_arrays(
                [part.column("doc"), part.column("key"), pa.array(sizes), pa.array(k1.view(np.int64)),
                 pa.array(k2.view(np.int64)), _lists(keys)], ["doc", "key", "n", "k1", "k2", "bands"])

    return of


def _sets(n: int):
    def of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in slices(batch):
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), _lists(shingle_sets(part.column("text"), n))], ["id", "items"])

    return of


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 5, percent: int = 80, places: int = PLACES,
                    bands: int = BANDS, rows: int = ROWS, hub_rounds: int = 2) -> DataFrame:
    """(``doc_id``, ``n_shingles``, ``component_id``, ``kept``) for each row of ``docs``."""
    source = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"),
                         F.xxhash64(F.col(text_col)).alias("key"))
    base = written(arrow_map(source, _signatures(shingle, places, bands, rows),
                             "doc long, key long, n long, k1 long, k2 long, bands array<long>"), "signatures")

    # Classes of equal sets. A class goes on as one set, under a number made of the set itself and
    # with the text of one of its documents of least id.
    number = F.shiftrightunsigned(F.xxhash64("k1", "k2", "n"), 1)
    classes = written(base.where("n > 0 and doc is not null").groupBy("k1", "k2", "n")
                      .agg(F.min("doc").alias("doc")).withColumn("id", number), "classes")
    members = (base.select("doc", "n", "k1", "k2")
               .join(classes.select("k1", "k2", "n", F.col("doc").alias("class")), ["k1", "k2", "n"]))
    copies = members.where("doc <> class").select(F.col("doc").alias("a"), F.col("class").alias("b")).distinct()
    chosen = written(base.select("doc", "key", "n", "k1", "k2", "bands").join(classes, ["k1", "k2", "n", "doc"])
                     .dropDuplicates(["id"]).select("id", "doc", "key", "n", "bands"), "chosen")
    keys = chosen.select("id", "n", F.explode("bands").alias("key"))
    # written, so that the join is planned from its size: without a shuffle where it is small, else
    # with two shuffled tables, of which a crowded bucket's rows can be split
    shared = written(keys.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "bucket-sizes")
    crowd = written(keys.join(shared, "key").select("key", "id", "n", "size"), "buckets")
    score = crowd.groupBy("id").agg(F.sum("size").alias("score"))
    crowd = written(crowd.join(score, "id").select("key", "id", "n", "score"), "buckets-scored")

    wanted = chosen.select("id", "doc", "key").join(crowd.select("id").distinct(), "id", "left_semi")
    texts = source.join(wanted, ["doc", "key"]).dropDuplicates(["doc", "key"])
    sets = written(arrow_map(texts.select("id", "text"), _sets(shingle), "id long, items array<long>"),
                   "shingle-sets")
    linked = _link(crowd, sets, percent, hub_rounds)
    named = classes.select("id", F.col("doc").alias("class"))
    links = (linked.join(named.withColumnRenamed("id", "a").withColumnRenamed("class", "da"), "a")
             .join(named.withColumnRenamed("id", "b").withColumnRenamed("class", "db"), "b")
             .select(F.col("da").alias("a"), F.col("db").alias("b")))
    groups = components(links.unionByName(copies))
    grouped = base.select(F.col("doc").alias("id"), "n").join(groups, "id", "left")
    return grouped.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
                          F.coalesce("component", "id").alias("component_id"),
                          F.coalesce(F.col("id") == F.coalesce("component", "id"), F.lit(True))
                          .alias("kept"))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``) whose full sets are similar enough."""
    left = sets.select(F.col("id").alias("a"), F.col("items").alias("sa"))
    right = sets.select(F.col("id").alias("b"), F.col("items").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return (pairs.join(right, "b").join(left, "a")
            .select("a", "b", both.alias("both"), (F.size("sa") + F.size("sb")).alias("total"))
            .where(100 * F.col("both") >= percent * (F.col("total") - F.col("both")))
            .select("a", "b"))


def _fits(percent: int, n: str = "n", other: str = "other_n"):
    """Sizes that allow the similarity at all."""
    return F.expr(f"100 * least({n}, {other}) >= {percent} * greatest({n}, {other})")


def _open_buckets(active: DataFrame) -> DataFrame:
    """The members of buckets that span several groups, with the bucket's hub."""
    hub = F.max(F.struct("score", (-F.col("id")).alias("id"), "grp", "n")).alias("hub")
    spans = (active.groupBy("key").agg(F.min("grp").alias("lo"), F.max("grp").alias("hi"), hub)
             .where("lo < hi")
             .select("key", (-F.col("hub.id")).alias("hub"), F.col("hub.grp").alias("hub_grp"),
                     F.col("hub.n").alias("other_n")))
    return written(active.join(written(spans, "hubs"), "key"), "open-buckets")


def _link(crowd: DataFrame, sets: DataFrame, percent: int, hub_rounds: int) -> DataFrame:
    """Verified links between documents of common buckets; enough to connect every group."""
    links = sets.sparkSession.createDataFrame([], "a long, b long")
    active = crowd.withColumn("grp", F.col("id"))
    for _ in range(hub_rounds):
        rest = _open_buckets(active)
        if rest.isEmpty():
            return links
        pairs = rest.where("grp <> hub_grp").where(_fits(percent)).select(
            F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b"))
        found = _confirmed(pairs.distinct(), sets, percent)
        links = written(links.unionByName(found), "links-so-far")
        active = (rest.where("id <> hub").select("key", "id", "n", "score")
                  .join(components(links), "id", "left")
                  .select("key", "id", "n", "score", F.coalesce("component", "id").alias("grp")))
    rest = _open_buckets(active)
    if rest.isEmpty():
        return links
    left = written(rest.groupBy("id").agg(F.max("n").alias("n"), F.max("grp").alias("grp")), "left-over")
    found = _confirmed(_share_rare(left, sets, percent), sets, percent)
    return written(links.unionByName(found), "links-so-far")


def _share_rare(left: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (``a``, ``b``) of documents of different groups that share a rare shingle."""
    items = written(sets.join(left, "id").select("id", "n", "grp", F.explode("items").alias("t")),
                    "left-over-shingles")
    # one row a shingle, written: the join that follows can split a common shingle's rows
    often = written(items.groupBy("t").agg(F.count(F.lit(1)).alias("df"), F.min("grp").alias("lo"),
                                           F.max("grp").alias("hi")), "left-over-often")
    order = F.array_sort(F.collect_list(F.struct("df", "t", "mixed")))
    first = F.expr(f"int(n - (n * {percent} + 99) div 100 + 1)")
    rare = written(items.join(often.select("t", "df", (F.col("lo") < F.col("hi")).alias("mixed")), "t")
                   .groupBy("id", "n", "grp").agg(order.alias("o"))
                   .select("id", "n", "grp", F.posexplode(F.slice("o", F.lit(1), first)).alias("at", "x"))
                   .where("x.mixed").select("id", "n", "grp", "at", "x.t"), "left-over-rare")
    # of each shingle's holders those outside its largest group meet all the others
    by_group = rare.groupBy("t", "grp").agg(F.count(F.lit(1)).alias("held"))
    largest = by_group.groupBy("t").agg(F.max(F.struct("held", "grp")).alias("top"), F.count(F.lit(1)).alias("g"))
    largest = written(largest.where("g > 1").select("t", F.col("top.grp").alias("top")), "left-over-largest")
    minor = written(rare.join(largest, "t").where("grp <> top")
                    .select("t", F.col("id").alias("other"), F.col("n").alias("other_n"),
                            F.col("at").alias("other_at"), F.col("grp").alias("other_grp"), "top"),
                    "left-over-minor")
    # two documents outside the largest group meet once, in order of id
    meet = F.expr("grp <> other_grp and (grp = top or id < other)")
    enough = F.expr(f"{100 + percent} * least(n - at, other_n - other_at) >= {percent} * (n + other_n)")
    return (rare.join(minor, "t").where(meet & enough)
            .select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).distinct())
