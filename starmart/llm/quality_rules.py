"""Quality rules with thresholds that adapt to each language and source.

Per document: counts of words, word characters, symbols, repeated lines, words in repeated
three-word windows, capitals and exclamation marks. Each rule looks at one rate of these.

*Sketch.* A rate x (an integer, per thousand) falls into bucket floor(50 ln(x + 1)), so a
bucket spans two per cent. The counts per bucket of a language and source are a quantile
sketch of bounded size; sketches merge by adding counts, in any order, with equal results
on every run.

*Thresholds.* A rule's limit lies above the sketch's 70 % quantile: junk may make up 30 % of a
source without moving the limit to itself, and what is usual for a source passes there.
The room above the quantile is ``SPREAD`` times the distance from the 30 % to the 70 % quantile,
with a least room for a rate that is usually nought or always the same; of capitals and
word length, which are never usually nought, it is a multiple of the quantile. A rate that is
usually nought says nothing by its quantiles; there the limit is at least half the 10 % quantile
of the rates that are not nought: what the source has of it at all, it has in that measure. Of a
rate with a greatest value the room is at most ``REACH`` of what is left up to it, so a rule can
fire in every source. Word length also has a lower limit, from the 30 % quantile.

*Small groups.* A group's sketch has its language's added to it, with the weight of ``PRIOR``
documents, and a language's the whole corpus's in the same way. A group of few documents so takes
its language's limits, one of many its own, and in between they move with every document:
there is no size at which they switch.

*Filtering.* Documents are joined with the limits of their group. Fixed base rules come
first: fewer than 50 words, or over half the words in repeated windows.

DataFrame functions only. One pass over the texts writes the measures (no texts); sketches
are partially aggregated sums, so a source with a third of the rows leaves each map task
as a few hundred counts. The join moves measures only and can be split at run time.

Null text counts as empty and fails the base rules; null languages and sources are groups
of their own. Rows that repeat get equal verdicts. Empty tables give empty tables.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.tables import bind, words_array, written

PRIOR = 100.0
SCALE = 50
HIGH, LOW, RARE = 0.7, 0.3, 0.1
_NEAR = 1e-9   # sums of weights may differ by rounding
SPREAD, REACH = 5.0, 0.51
# rule -> (numerator, denominator, least room over the high quantile in least buckets, or room as
# a multiple of that quantile, greatest rate, factor under the low quantile)
RULES = {
    "symbols": ("1000 * n_symbols", "n_words", 99.0, 0.0, None, None),
    "dup_lines": ("1000 * n_dup_lines", "n_lines", 499.0, 0.0, 1000, None),
    "repeats": ("1000 * n_repeat_words", "n_words", 59.0, 0.0, 1000, None),
    "capitals": ("1000 * n_capitals", "word_chars", 0.0, 7.0, 1000, None),
    "shouts": ("1000 * n_shouts", "n_words", 299.0, 0.0, None, None),
    "word_length": ("1000 * word_chars", "n_words", 0.0, 1.5, None, 2.5),
}


def _repeated_window_words(words: Column) -> Column:
    """Words inside three-word windows that occur at least twice in the array."""

    def covered(starts: Column) -> Column:
        gaps = F.zip_with(F.slice(starts, 2, F.size(starts)), F.slice(starts, 1, F.size(starts) - 1),
                          lambda b, a: F.least(b - a, F.lit(3)))
        return F.when(F.size(starts) == 0, F.lit(0)).otherwise(
            F.aggregate(gaps, F.lit(3), lambda acc, g: acc + g))

    def repeated(s: Column) -> Column:
        twin = lambda x, i: ((F.get(s, i - 1)["h"] == x["h"]) & (i > 0)) | F.coalesce(
            F.get(s, i + 1)["h"] == x["h"], F.lit(False))
        return F.array_sort(F.transform(F.filter(s, twin), lambda x: x["p"]))

    def windows(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.struct(
            F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("p")))

    def count(w: Column) -> Column:
        return F.when(F.size(w) < 3, F.lit(0)).otherwise(
            bind(F.sort_array(windows(w)), lambda s: bind(repeated(s), covered)))

    return bind(words, count).cast("long")


def measures(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """The counts that the rules look at, for each row (with the columns ``keep``)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    parts = docs.select(*keep, words_array(text).alias("w"), F.filter(
        F.split(text, "\n", -1), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")).alias("l"),
        F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count(text, F.lit("\\p{Lu}")).cast("long").alias("n_capitals"),
        F.regexp_count(text, F.lit("!")).cast("long").alias("n_shouts"))
    return parts.select(
        *keep, F.size("w").cast("long").alias("n_words"),
        F.aggregate("w", F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("word_chars"),
        "n_symbols", F.size("l").cast("long").alias("n_lines"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        _repeated_window_words(F.col("w")).alias("n_repeat_words"), "n_capitals", "n_shouts")


def _rate(rule: str) -> Column:
    over, under, *_ = RULES[rule]
    return F.expr(f"{over} div greatest({under}, 1)")


def bucket(rate: Column) -> Column:
    return F.floor(F.log(rate + 1) * SCALE).cast("long")


def sketches(measured: DataFrame, groups: list[str]) -> DataFrame:
    """Counts per group, rule and bucket: mergeable quantile sketches."""
    rows = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), bucket(_rate(r)).alias("bucket"))
                               for r in RULES])).alias("r")
    return (measured.where("n_words > 0").select(*groups, rows)
            .groupBy(*groups, "r.rule", "r.bucket").agg(F.count(F.lit(1)).alias("n")))


def _running(weighted: DataFrame, level: list[str]) -> DataFrame:
    """Weights up to each bucket and in all, for each group and rule."""
    run = Window.partitionBy(*level, "rule").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    upto = weighted.select(*level, "rule", "bucket", "w", F.sum("w").over(run).alias("upto"))
    return upto.withColumn("total", F.max("upto").over(Window.partitionBy(*level, "rule")))


def blended(sketch: DataFrame, groups: list[str], prior: float = PRIOR) -> DataFrame:
    """The sketch of every group with its parents' added, as running weights."""
    counts = sketch.groupBy("rule", "bucket").agg(F.sum("n").cast("double").alias("w"))
    ranked = _running(counts, [])
    for depth in range(1, len(groups) + 1):
        level, above = groups[:depth], groups[:depth - 1]
        own = sketch.groupBy(*level, "rule", "bucket").agg(F.sum("n").cast("double").alias("w"))
        same = [F.expr(f"c.{k} <=> p.{k}") for k in [*above, "rule"]]
        given = (own.select(*level, "rule").distinct().alias("c").join(ranked.alias("p"), same)
                 .select("c.*", "p.bucket", (F.lit(prior) * F.col("p.w") / F.col("p.total")).alias("w")))
        ranked = _running(own.unionByName(given).groupBy(*level, "rule", "bucket").agg(F.sum("w").alias("w")), level)
    return ranked


def limits(sketch: DataFrame, groups: list[str], prior: float = PRIOR) -> DataFrame:
    """Bucket limits of every group and rule: ``hi``, ``lo``, and ``nz`` of the rates above nought."""
    ranked = blended(sketch, groups, prior)
    nought = F.max(F.when(F.col("bucket") == 0, F.col("w"))).over(Window.partitionBy(*groups, "rule"))
    ranked = ranked.withColumn("zero", F.coalesce(nought, F.lit(0.0)))
    room = _NEAR * F.col("total")

    def first(part: float, upto: Column, total: Column, where: Column) -> Column:
        return F.min(F.when(where & (upto >= part * total - room), F.col("bucket")))

    upto, total = F.col("upto"), F.col("total")
    above, above_total = upto - F.col("zero"), total - F.col("zero")
    some = (F.col("bucket") > 0) & (above_total > room)
    return ranked.groupBy(*groups, "rule").agg(
        first(HIGH, upto, total, F.lit(True)).alias("hi"), first(LOW, upto, total, F.lit(True)).alias("lo"),
        first(RARE, above, above_total, some).alias("nz"))


def apply_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                groups: tuple[str, ...] = ("lang", "source"),
                prior: float = PRIOR) -> DataFrame:
    """Id, measures, ``base_failed``, ``failed_rules`` and ``kept`` of every row."""
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                        *[F.col(g).alias(f"g{i}") for i, g in enumerate(groups)])
    keys = [f"g{i}" for i in range(len(groups))]
    base = written(measures(named, keep=("doc_id", *keys)), "quality-measures")
    cut = limits(written(sketches(base, keys), "quality-sketches"), keys, prior)
    wide = cut.groupBy(*keys).agg(*[
        F.max(F.when(F.col("rule") == r, F.col(side))).alias(f"{r}_{side}")
        for r in RULES for side in ("hi", "lo", "nz")])
    same = [F.expr(f"d.{k} <=> t.{k}") for k in keys]
    both = base.alias("d").join(wide.alias("t"), same, "left")
    failed = F.array_compact(F.array(*[F.when(_fails(r), F.lit(r)) for r in RULES]))
    base_failed = F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words")
    return (both.select("d.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                        "n_repeat_words", base_failed.alias("base_failed"), failed.alias("failed_rules"))
            .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)))


def _fails(rule: str) -> Column:
    fixed, part, most, under = RULES[rule][2:]
    value = _rate(rule) + 1
    high, low = F.exp((F.col(f"{rule}_hi") + 1) / SCALE), F.exp(F.col(f"{rule}_lo") / SCALE)
    seldom = F.coalesce(0.5 * F.exp(F.col(f"{rule}_nz") / SCALE) - high, F.lit(0.0))
    room = part * high if part else F.greatest(F.lit(fixed * math.exp(1 / SCALE)), SPREAD * (high - low), seldom)
    if most:
        room = F.least(room, REACH * (most + 1 - high))
    bad = value > high + room
    if under:
        bad = bad | (value < low / under)
    return bad
