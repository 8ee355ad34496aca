"""Reproducible dense surrogate keys without a single-partition sort.

``row_number() OVER (ORDER BY ...)`` without ``PARTITION BY`` plans an
``Exchange SinglePartition``: one task sorts every row. ``dense_key`` instead

1. (unless the caller knows the rows are distinct) finds the copy groups that could
   unbalance a range partition, those of more than a quarter of an average partition, with
   a frequent-items sketch of the row hashes: one pass, a sketch of bounded size per task,
   no shuffle of rows. Sketches are merged as a tree, ``FAN_IN`` at a time, so that no task
   reads more of them however many tasks scan. Up to four groups for each partition are
   looked for (at most ``_TRACKED``). Usually there is none and nothing else happens. Otherwise only the
   rows of those groups are collapsed into (row, multiplicity), cut into chunks that a
   round-robin shuffle of the chunk rows spreads over tasks, and expanded back into copies
   carrying an ordinal, so no task emits a hot row's copies alone. The sketch only steers
   the layout; the keys are the same with any set of groups,
2. range-partitions on the requested order followed by every other column and the copy
   ordinal: a total, deterministic order, so neither a hot leading value (one state with
   a third of the rows) nor a much-copied row lands in one task,
3. sorts inside each range and tags each row with ``monotonically_increasing_id``
   (partition index in the high bits, position inside the partition in the low bits),
4. writes the tagged rows once as a Parquet table below the shared checkpoint folder:
   that fixes the tags (a recomputation could sample different range bounds) and cuts the
   lineage, so a lost executor re-reads files instead of re-running the sort,
5. counts rows per range partition from the tag column alone and collects those counts:
   one number per partition, bounded by the partition count, never by the data,
6. turns the counts into start offsets and applies them as a lookup in one literal array,
   so later plans over the keyed table are a plain scan + projection (no join, no window).
   The written table is the result's source; a job that copies the result elsewhere frees
   it with ``session.scratch_scope``.

The key of a row is ``start + offset(partition) + position``. Every step is
deterministic (no random tie-breakers; the round-robin shuffle sorts before it assigns),
so re-run tasks reproduce the same rows. Exact copies are interchangeable, so the keys
equal ``row_number()`` under any tie-breaking of them.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.session import create_text, list_names, make_folder, read_text, scratch_path

_TAG = "__sm_tag"
_N = "__sm_copies"
_CHUNK = "__sm_chunk"
_ORD = "__sm_copy"
_LOW_BITS = 33  # monotonically_increasing_id layout: partition << 33 | row position
CHUNK_COPIES = 10_000  # copies that one chunk row of a hot group expands to
_TRACKED = 1_000_000   # items that one sketch can track at most
FAN_IN, LEVELS = 64, 3  # sketches merged by one task of the tree; 64 ** 3 scan tasks


def sort_columns(order_cols: Sequence[str | Column]) -> list[Column]:
    """Ascending NULLS LAST sort expressions (plain names are converted)."""
    return [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order_cols]


def _merged_sketch(df: DataFrame, tracked: int) -> DataFrame:
    """One row: ``n`` rows in all and the frequent-items sketch ``s`` of the row hashes.

    Every scan task leaves one sketch; each level of the tree merges ``FAN_IN`` of them, in one
    job. ``LEVELS`` levels are enough for 262,144 scan tasks; unused ones pass one row on.
    """
    hashed = df.select(F.xxhash64(*df.columns).alias("h"), F.spark_partition_id().alias("p"))
    # an input without rows still leaves a sketch, of nothing
    nothing = df.sparkSession.range(1).select(F.lit(None).cast("bigint").alias("h"), F.lit(0).alias("p"))
    level = hashed.unionByName(nothing).groupBy("p").agg(
        F.count("h").alias("n"), F.expr(f"approx_top_k_accumulate(h, {tracked})").alias("s"))
    merged = [F.sum("n").alias("n"), F.expr(f"approx_top_k_combine(s, {tracked})").alias("s")]
    for _ in range(LEVELS - 1):
        level = level.groupBy(F.expr(f"p div {FAN_IN}").alias("p")).agg(*merged)
    return level.agg(*merged)


def _hot_copy_hashes(df: DataFrame, n_parts: int) -> list[int]:
    """Row hashes of the copy groups above a quarter of an average range partition.

    At most ``4 * n_parts`` groups can be that large. The sketch tracks many times more
    items, so its error is a small part of the size looked for.
    """
    k = min(4 * n_parts, _TRACKED)
    tracked = min(64 * k, _TRACKED)
    got = _merged_sketch(df, tracked).select("n", F.expr(f"approx_top_k_estimate(s, {k})").alias("top")).first()
    limit = max(1, got["n"] // (4 * n_parts))
    return [t["item"] for t in got["top"] or [] if t["count"] > limit]


def _spread_copies(df: DataFrame, hot: list[int], chunk: int = CHUNK_COPIES) -> DataFrame:
    """Rows with a copy ordinal in ``_ORD``: rows of the hot copy groups are collapsed,
    cut into chunks of ``chunk`` copies, spread by a round-robin shuffle of the chunk rows
    and expanded again with ordinals 1..n; every other row passes through with ordinal 1."""
    cols = df.columns
    is_hot = F.xxhash64(*cols).isin(hot)
    rest = df.where(~is_hot).withColumn(_ORD, F.lit(1).cast("bigint"))
    counted = df.where(is_hot).groupBy(*cols).agg(F.count(F.lit(1)).alias(_N))
    n = F.col(_N)
    chunks = (counted.select(*cols, _N, F.explode(F.sequence(F.lit(0).cast("bigint"),
                                                             ((n - 1) / chunk).cast("bigint")))
                             .alias(_CHUNK))
              .repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    first = F.col(_CHUNK) * chunk + 1
    last = F.least(F.col(_CHUNK) * chunk + chunk, n)
    spread = chunks.select(*cols, F.explode(F.sequence(first, last)).alias(_ORD))
    return rest.unionByName(spread)


def dense_key(df: DataFrame, order_cols: Sequence[str | Column], key_col: str,
              start: int | Callable[[int], int] = 1, num_partitions: int | None = None, key_type: str = "bigint",
              collapse_copies: bool = True) -> DataFrame:
    """Add ``key_col`` = ``start``-based row number under the given order (``key_col`` first).

    ``start`` may be a function of the number of rows, called once when that is known (a
    reservation of as many keys).

    ``key_type="int"`` is for columns declared as a 32-bit INTEGER; there an overflowing key
    fails (ANSI cast) instead of wrapping.
    ``collapse_copies=False`` skips step 1 for inputs known to be duplicate-free (a
    DISTINCT, or rows with a unique column), saving one job.
    """
    spark = df.sparkSession
    cols = df.columns
    named = {c for c in order_cols if isinstance(c, str)}
    order = sort_columns(order_cols) + [F.col(c).asc_nulls_last() for c in cols if c not in named]
    items = df
    if collapse_copies:
        n_parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
        hot = _hot_copy_hashes(df, n_parts)
        if hot:
            items = _spread_copies(df, hot)
            order = order + [F.col(_ORD).asc()]
    ranged = (items.repartitionByRange(num_partitions, *order) if num_partitions
              else items.repartitionByRange(*order))
    rows = ranged.sortWithinPartitions(*order).select(*cols)
    path = scratch_path(spark, f"dense-key-{key_col}")
    rows.withColumn(_TAG, F.monotonically_increasing_id()).write.mode("overwrite").parquet(path)
    tagged = spark.read.parquet(path)

    part = F.shiftright(F.col(_TAG), _LOW_BITS)
    counts = dict(tagged.groupBy(part.alias("p")).count().collect())  # <= #partitions rows
    n_parts = (max(counts) + 1) if counts else 1
    offsets, running = [], 0
    for p in range(n_parts):
        offsets.append(running)
        running += counts.get(p, 0)
    # folded into one array literal, whatever the number of partitions
    starts = F.from_json(F.lit(json.dumps(offsets)), "array<bigint>")
    offset = F.element_at(starts, (part + 1).cast("int"))
    position = F.col(_TAG).bitwiseAND(F.lit((1 << _LOW_BITS) - 1))
    first = start(running) if callable(start) else start
    key = (F.lit(first) + offset + position).cast(key_type)
    return tagged.select(key.alias(key_col), *cols)


class KeyLedger:
    """Key ranges of one table, reserved in a folder that all writers share.

    A reservation is one small file, named by its number and holding its first and last key.
    It becomes visible by one rename (or link) that fails where the number is taken, so of
    writers that go for the same number one wins and the others go on to the next: ranges
    never overlap, whoever writes the rows first. Keys of a load that fails stay unused.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _read(self, name: str) -> dict:
        return json.loads(read_text(self.spark, f"{self.folder}/{name}"))

    def ranges(self) -> list[tuple[int, int]]:
        """Reserved (first, last) keys, in order."""
        return [(r["first"], r["last"]) for r in map(self._read, list_names(self.spark, self.folder))]

    def reserve(self, count: int, floor: int = 0, tries: int = 1_000) -> int:
        """First of ``count`` keys that nobody else gets, above ``floor`` and all reserved ones."""
        make_folder(self.spark, self.folder)
        for _ in range(tries):
            names = list_names(self.spark, self.folder)
            last = max(self._read(names[-1])["last"], floor) if names else floor
            number = int(names[-1]) + 1 if names else 0
            record = {"first": last + 1, "last": last + max(count, 0)}
            if create_text(self.spark, f"{self.folder}/{number:012d}", json.dumps(record)):
                return last + 1
        raise RuntimeError(f"no key range reserved below {self.folder} after {tries} tries")


def append_with_keys(existing: DataFrame, new_rows: DataFrame, key_col: str,
                     order_cols: Sequence[str | Column], collapse_copies: bool = True,
                     key_type: str = "bigint", ledger: KeyLedger | None = None) -> DataFrame:
    """Give ``new_rows`` keys after the largest key already in ``existing``.

    Matches a load with explicit identity values: the existing keys are untouched and
    the appended rows are numbered ``max + 1 ...`` in the given order. Returns the new
    rows only (union them with ``existing`` to get the full table). Appends that may run at
    the same time share a ``ledger``: each reserves its range once it has counted its rows, so
    their keys never meet, though neither sees the other's rows yet.
    """
    largest = int(existing.agg(F.max(key_col).alias("m")).first()["m"] or 0)
    start = largest + 1 if ledger is None else lambda count: ledger.reserve(count, floor=largest)
    return dense_key(new_rows, order_cols, key_col, start=start,
                     collapse_copies=collapse_copies, key_type=key_type)
