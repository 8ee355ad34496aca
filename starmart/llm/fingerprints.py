"""Document fingerprints: a homomorphic multiset hash of the paragraphs.

A paragraph is a line. Each is hashed to a wide vector of two parts:

* ``EXACT`` lanes of 32 bits, drawn from two 64-bit hashes of the whole paragraph;
* ``LIKE`` lanes, each the number of the paragraph's three-word shingles (its
  whole word sequence where it is shorter) whose hash has that lane's bit set, with the
  number of shingles as one more lane.

A fingerprint is the sum of the vectors, every lane modulo 2^32 (column ``wide``). So the order
of paragraphs does not matter, equal texts have equal fingerprints, and a paragraph is
inserted or deleted by adding or subtracting its vector (``combine``). The column ``lanes``
has the likeness lanes and the number of shingles modulo 2^16, for texts of few equal
shingles; the functions take the number of bits of these lanes.

*Likeness* of two fingerprints is the cosine of their signed lanes (2 x count - shingles):
every shingle adds a random sign to every lane, so the expected product is the number of
common shingles. It is taken from the wide lanes: no text holds 2^31 shingles. Equal fingerprints have likeness 1, negative cosines count as 0.

``edited_text`` replaces the last floor(n/2) code points of each text by the first as many
(or all) of the next document's, by ascending id; after the last follows the first.

DataFrame functions only. Scale: texts are shuffled once. The order of documents is cut
into buckets at quantiles of the ids (one pass over the id column; the bounds are a short
literal array), each text goes to its bucket, and the first document of a bucket also
goes to the bucket before, as the next document of that one's last. Everything after that
happens inside the bucket: the next text and the next fingerprint are ``lead`` windows, and
lanes are sums by (document, chunk of shingles) without another shuffle. Four 16-bit
counters share a long, and a chunk is small enough that none can overflow.

Null text is empty. Null ids come last; equal ids are ordered by a hash of the text. Every
row is a document: of rows that repeat, each is the next of the one before. Very long texts
are taken line by line, in chunks. Empty tables give empty tables. Extra columns are
ignored.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.tables import bind, words_array

EXACT, LIKE, SHINGLE = 12, 64, 3
WIDE, NARROW = 32, 16
_PACKED = LIKE // 4
_MASK = 0x0001000100010001
_PAIR = 0x0000FFFF0000FFFF
MAX_BUCKETS = 100_000
STRETCHES, SAMPLE = 256, 64     # buckets bounded in one step; sampled ids for each bucket


def _elements(paragraph: Column) -> Column:
    """The paragraph's two hashes (``whole``) and its shingles' hashes."""

    def shingles(w: Column) -> Column:
        none = F.array().cast("array<struct<whole:boolean,h1:bigint,h2:bigint>>")
        one = F.array(F.struct(F.lit(False).alias("whole"), F.xxhash64(w).alias("h1"),
                               F.lit(0).cast("long").alias("h2")))
        many = F.transform(F.sequence(F.lit(0), F.size(w) - SHINGLE), lambda i: F.struct(
            F.lit(False).alias("whole"),
            F.xxhash64(*[F.get(w, i + k) for k in range(SHINGLE)]).alias("h1"),
            F.lit(0).cast("long").alias("h2")))
        return (F.when(F.size(w) == 0, none).when(F.size(w) < SHINGLE, one).otherwise(many))

    own = F.array(F.struct(F.lit(True).alias("whole"), F.xxhash64(paragraph).alias("h1"),
                           F.xxhash64(F.lit("paragraph"), paragraph).alias("h2")))
    return F.concat(own, bind(words_array(paragraph), shingles))


def _vectors(rows: DataFrame, keys: list[str], text: Column) -> DataFrame:
    """Fingerprint lanes ``v`` of each key: exact lanes, number of shingles, likeness lanes."""
    lines = rows.select(*keys, F.posexplode(F.split(text, "\n", -1)).alias("line", "p"))
    each = lines.select(*keys, "line", F.posexplode(_elements(F.col("p"))).alias("at", "x"))
    # a chunk has at most 16 * 2048 shingles, so no 16-bit counter overflows in it
    chunk = each.select(*keys, F.expr("line div 16").alias("c1"), F.expr("at div 2048").alias("c2"),
                        "x.whole", "x.h1", "x.h2")
    low = F.lit(0xFFFFFFFF)
    draws = [F.col("h1"), F.col("h2"),
             *[F.xxhash64("h1", "h2", F.lit(i)) for i in range(EXACT // 2 - 2)]]
    exact = [part for h in draws
             for part in (h.bitwiseAND(low), F.shiftrightunsigned(h, 32))]
    nought, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    sums = [F.sum(F.when(F.col("whole"), lane).otherwise(nought)).alias(f"e{i}")
            for i, lane in enumerate(exact)]
    sums += [F.sum(F.when(F.col("whole"), nought).otherwise(
        F.shiftrightunsigned(F.col("h1"), i).bitwiseAND(F.lit(_MASK)))).alias(f"p{i}")
        for i in range(_PACKED)]
    sums.append(F.sum(F.when(F.col("whole"), nought).otherwise(one)).alias("m"))
    packed = chunk.groupBy(*keys, "c1", "c2").agg(*sums)
    # chunks add up in fields of 32 bits: counters 0 and 2 of a long, then 1 and 3
    total = packed.groupBy(*keys).agg(
        *[F.sum(f"e{i}").alias(f"e{i}") for i in range(EXACT)], F.sum("m").alias("m"),
        *[F.sum(F.shiftrightunsigned(F.col(f"p{i}"), 16 * k).bitwiseAND(F.lit(_PAIR))).alias(f"p{i}_{k}")
          for i in range(_PACKED) for k in (0, 1)])
    lanes = [F.shiftrightunsigned(F.col(f"p{i}_{k}"), 32 * high).bitwiseAND(low)
             for i in range(_PACKED) for high in (0, 1) for k in (0, 1)]
    return total.select(*keys, reduced(F.array(*[F.col(f"e{i}") for i in range(EXACT)], F.col("m"), *lanes),
                                       WIDE).alias("v"))


def reduced(v: Column, bits: int = NARROW) -> Column:
    """Lanes modulo their powers: exact lanes 2^32, the others 2^``bits``."""
    return F.transform(v, lambda x, i: F.when(i < EXACT, F.pmod(x, F.lit(1 << 32)))
                       .otherwise(F.pmod(x, F.lit(1 << bits))))


def combine(a: Column, b: Column, sign: int = 1, bits: int = NARROW) -> Column:
    """Fingerprint lanes of ``a`` with the paragraphs of ``b`` inserted (or deleted: -1)."""
    return reduced(F.zip_with(a, b, lambda x, y: x + sign * y), bits)


def text_of(v: Column, bits: int = NARROW) -> Column:
    """Lanes as one lower-case hexadecimal string."""
    return F.array_join(F.transform(v, lambda x, i: F.lower(F.lpad(
        F.hex(x), F.when(i < EXACT, 8).otherwise(bits // 4), "0"))), "")


def likeness(a: Column, b: Column, bits: int = NARROW) -> Column:
    half = 1 << (bits - 1)

    def signed(v: Column) -> Column:
        n = F.get(v, F.lit(EXACT))
        return F.transform(F.slice(v, EXACT + 2, LIKE), lambda x: (
            F.pmod(2 * x - n + F.lit(half), F.lit(2 * half)) - F.lit(half)).cast("double"))

    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, z: s + z)

    def of(s: Column) -> Column:
        scale = F.sqrt(dot(s["x"], s["x"]) * dot(s["y"], s["y"]))
        return F.when(scale == 0, 0.0).otherwise(
            F.greatest(F.lit(0.0), F.least(F.lit(1.0), dot(s["x"], s["y"]) / scale)))

    cosine = bind(F.named_struct(F.lit("x"), signed(a), F.lit("y"), signed(b)), of)
    return F.when(a == b, 1.0).otherwise(cosine)


def _bounds(docs: DataFrame, id_col: str) -> list[int]:
    """Quantiles of the ids that cut them into buckets (the first bound is the least id).

    From samples by a hash of the id, in two steps: some bounds from one small sample, then
    between each two of them more bounds from a larger one, each such stretch in a group of its
    own. So a task holds a few thousand ids however many there are, and however many buckets.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = max(16, min(4 * parts, MAX_BUCKETS))
    value = F.col(id_col)
    ends = docs.agg(F.min(id_col).alias("least"), F.count(id_col).alias("n")).first()
    if ends["least"] is None:
        return []

    def sample(most: int) -> DataFrame:
        share = min(1.0, most / ends["n"])
        return docs.where(value.isNotNull() & (F.pmod(F.xxhash64(value), F.lit(1 << 31)) < int(share * (1 << 31))))

    def quantiles(k: int) -> Column:
        return F.percentile_approx(value, [i / k for i in range(k)], 100 * k).alias("q")

    coarse = min(n, STRETCHES)
    first = sample(SAMPLE * coarse).agg(quantiles(coarse)).first()["q"] or []
    bounds = {int(ends["least"]), *map(int, first)}
    if n > coarse:
        stretch = _bucket(value, sorted(bounds)).alias("stretch")
        inner = sample(SAMPLE * n).select(id_col, stretch).groupBy("stretch").agg(quantiles(-(-n // coarse)))
        bounds |= {int(b) for r in inner.collect() for b in r["q"]}
    return sorted(bounds)


def _bucket(value: Column, bounds: list[int], step: int = 256) -> Column:
    """Number of bounds up to the value (0-based bucket), in two steps; nulls come last."""
    if not bounds:
        return F.lit(0)
    every = F.from_json(F.lit(json.dumps(bounds)), "array<bigint>")
    coarse = F.from_json(F.lit(json.dumps(bounds[::step])), "array<bigint>")
    block = F.size(F.filter(coarse, lambda b: b <= value)) - 1
    inner = bind(F.greatest(block, F.lit(0)), lambda k: k * step + F.size(F.filter(
        F.slice(every, k * step + 1, F.lit(step)), lambda b: b <= value)) - 1)
    return F.when(value.isNull(), len(bounds) - 1).otherwise(inner)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``,
    ``near_edited``, ``near_next`` and the fingerprint's lanes (``wide``, and narrow ``lanes``)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    bounds = _bounds(rows, "doc_id")
    last = max(len(bounds) - 1, 0)
    bucket = _bucket(F.col("doc_id"), bounds)
    placed = rows.select("doc_id", "text", F.xxhash64("text").alias("th"), bucket.alias("bucket"))
    # the first documents of a bucket are guests of the one before (of the first: of the last)
    starts = (F.col("doc_id") == F.get(F.from_json(F.lit(json.dumps(bounds)), "array<bigint>"), F.col("bucket"))
              if bounds else F.lit(True))
    before = F.when(F.col("bucket") == 0, last).otherwise(F.col("bucket") - 1)
    none = F.array().cast("array<struct<bucket:int,guest:boolean>>")
    home = F.array(F.struct(F.col("bucket").cast("int").alias("bucket"), F.lit(False).alias("guest")))
    away = F.when(starts, F.array(F.struct(before.cast("int").alias("bucket"), F.lit(True).alias("guest")))
                  ).otherwise(none)
    dealt = placed.select("doc_id", "text", "th", F.explode(F.concat(home, away)).alias("at"))
    dealt = dealt.select("at.bucket", "at.guest", "doc_id", "th", "text")

    order = Window.partitionBy("bucket").orderBy("guest", F.col("doc_id").asc_nulls_last(), "th")
    ordered = dealt.select("*", F.row_number().over(order).alias("rn"), F.lead("text").over(order).alias("next"),
                           F.char_length("text").cast("long").alias("n"))
    edited = F.expr("concat(left(text, int(n - n div 2)), left(next, int(n div 2)))")
    texts = ordered.select("bucket", "rn", "doc_id", "n", "guest", F.explode(F.when(
        F.col("guest"), F.array(F.struct(F.lit(0).alias("which"), F.col("text").alias("t")))).otherwise(
        F.array(F.struct(F.lit(0).alias("which"), F.col("text").alias("t")),
                F.struct(F.lit(1).alias("which"), edited.alias("t"))))).alias("x"))
    each = texts.select("bucket", "rn", "doc_id", "n", "guest", "x.which", F.col("x.t").alias("t"),
                        F.when(F.col("x.which") == 1, F.sha2("x.t", 256)).alias("sha"))
    vectors = _vectors(each, ["bucket", "rn", "doc_id", "n", "guest", "which", "sha"], F.col("t"))

    # a document's own row is followed by its edited one and then by the next document's own
    line = Window.partitionBy("bucket").orderBy("rn", "which")
    both = vectors.select("*", F.lead("v", 1).over(line).alias("ev"), F.lead("v", 2).over(line).alias("nv"),
                          F.lead("sha", 1).over(line).alias("edited_sha256"))
    own = both.where((F.col("which") == 0) & ~F.col("guest"))
    return own.select(
        "doc_id", F.col("n").alias("n_chars"), "edited_sha256",
        text_of(F.col("v"), WIDE).alias("fingerprint"), text_of(F.col("ev"), WIDE).alias("edited_fingerprint"),
        likeness(F.col("v"), F.col("ev"), WIDE).alias("near_edited"),
        likeness(F.col("v"), F.col("nv"), WIDE).alias("near_next"), F.col("v").alias("wide"),
        reduced(F.col("v")).alias("lanes"))
