"""Mixing sources to target weights by Sainte-Lague apportionment.

*Targets.* All words of the corpus are shared among the sources by weight. A target stops
at ``max_repeats`` times its source's size; what is above is shared again by weight among
the others until no target is above its limit.

*Apportionment.* The corpus is as many equal blocks of ``block_words`` words. Seats
(blocks) go to sources by the highest quotients target / (2 s + 1). All seats but a few per
source are certain from the mean divisor, so only the quotients near the edge are ranked:
a few rows per source, whatever the number of blocks. A source's seats are divided among
its shards in the same way, by shard size.

*Selection.* A shard holds its documents one after the other in a seeded order of its own.
Its quota takes the whole shard as often as it fits, then a seeded run of blocks, around
the end if need be. A document's ``taken`` is the words of it that fall into the blocks.

DataFrame functions only. Scale: one pass over the texts writes (document, source, size).
Sources are summed with partial aggregation. A source is cut into sqrt(words) /
``shard_scale`` shards by a seeded hash, so both the number of its shards and the size of
one grow with the square root of the source: a source with a third of the corpus is spread
over many windows, none of which holds more than one shard. What is collected in one
place is a row per source (targets) or per shard of a source (quotas).

Null text has size 0; the null source is a source of its own and comes last. Repeated rows
are separate documents. Documents of size 0 take 0 words. Ties of quotients go to the
earlier source or shard. Empty tables give empty tables. Reruns agree: every order is
fixed by seeded hashes of the id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.tables import written

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
BLOCK_WORDS = 16
SHARD_SCALE = 50
SEED = 9
_WORD = "[^\\x20\\x09-\\x0D]+"


def seeded(seed: int, *parts: Column) -> Column:
    """48-bit number from a seeded md5 of the parts (null: the text ``null``)."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS,
            max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``source``, ``source_size``, ``target`` (words): one row per source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(w) for w in weights])
    named = sizes.select("source", "source_size", (F.row_number().over(by_name) - 1).alias("place"))
    named = named.select("*", F.get(cycle, F.col("place") % len(weights)).cast("long").alias("w"),
                         (max_repeats * F.col("source_size")).alias("top"))
    by_limit = Window.orderBy(F.col("top") / F.col("w"), "place")
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    level = named.select("*", (F.sum("source_size").over(every)
                               - F.coalesce(F.sum("top").over(before), F.lit(0))).alias("left"),
                         (F.sum("w").over(every)
                          - F.coalesce(F.sum("w").over(before), F.lit(0))).alias("w_left"))
    # share of a unit of weight once the sources before are at their limits
    level = level.withColumn("unit", F.col("left") / F.col("w_left"))
    unit = F.max(F.when(F.col("unit") <= F.col("top") / F.col("w"), F.col("unit"))).over(every)
    return (level.withColumn("share", unit)
            .select("source", "source_size", "place",
                    F.least(F.col("top").cast("double"), F.col("share") * F.col("w")).alias("target")))


def sainte_lague(parties: DataFrame, group: list[str], order: str, votes: str,
                 seats: str) -> DataFrame:
    """``parties`` with ``won``: the ``seats`` of each group by highest quotients.

    A party's seats differ from votes / divisor (the group's votes per seat) by at most
    its share of (short + parties) and one, so only quotients in that reach are ranked.
    """
    all_ = Window.partitionBy(*group)
    v, n = F.col(votes).cast("double"), F.col(seats)
    total = F.sum(v).over(all_)
    near = parties.withColumn("__total", total).withColumn("__count", F.count(F.lit(1)).over(all_))
    mean = F.when(F.col("__total") > 0, v * n / F.col("__total")).otherwise(0.0)
    near = near.withColumn("__mean", F.floor(mean + 0.5).cast("long"))
    off = F.abs(n - F.sum("__mean").over(all_)) + F.col("__count")
    near = near.withColumn("__reach", F.when(F.col("__total") > 0, F.ceil(
        v / F.col("__total") * off) + 1).otherwise(0).cast("long"))
    near = near.withColumn("__sure", F.greatest(F.col("__mean") - F.col("__reach"), F.lit(0)))
    near = near.withColumn("__open", n - F.sum("__sure").over(all_))
    tries = near.select(*group, order, "__open", v.alias("__v"), F.explode(
        F.sequence(F.col("__sure"), F.col("__mean") + F.col("__reach"))).alias("__s"))
    best = Window.partitionBy(*group).orderBy((F.col("__v") / (2 * F.col("__s") + 1)).desc(), order, "__s")
    won = (tries.withColumn("__rank", F.row_number().over(best))
           .groupBy(*group, order)
           .agg(F.sum((F.col("__rank") <= F.col("__open")).cast("long")).alias("__won")))
    keys = [*group, order]
    same = [F.expr(f"a.{k} <=> b.{k}") for k in keys]
    return (near.alias("a").join(won.alias("b"), same)
            .select("a.*", (F.col("__sure") + F.col("b.__won")).alias("won"))
            .drop("__total", "__count", "__mean", "__reach", "__sure", "__open"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS,
        block_words: int = BLOCK_WORDS, shard_scale: int = SHARD_SCALE,
        seed: int = SEED) -> DataFrame:
    """``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``taken`` of each row, and where the
    mix takes its words: ``passes`` whole times, then words [``from1``, ``to1``) and [``from2``, ``to2``).
    ``text_key`` (hash of the text) tells apart rows that share an id."""
    size = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(_WORD)).cast("long")
    base = written(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                               size.alias("size"), F.xxhash64(F.col(text_col)).alias("text_key")),
                   "mix-sizes")
    sizes = base.groupBy("source").agg(F.sum("size").alias("source_size"))
    goal = targets(sizes, weights, max_repeats)
    blocks = F.floor(F.sum("source_size").over(Window.partitionBy()) / block_words + 0.5).cast("long")
    goal = goal.withColumn("blocks", blocks)
    seats = sainte_lague(goal, [], "place", "target", "blocks").withColumnRenamed("won", "quota")
    plan = written(seats.select("source", "place", "source_size", "target", "quota", F.greatest(
        F.ceil(F.sqrt("source_size") / shard_scale), F.lit(1)).cast("long").alias("shards")), "mix-plan")

    dealt = (base.alias("d").join(plan.alias("p"), F.expr("d.source <=> p.source"))
             .select("d.doc_id", "d.source", "d.size", "d.text_key", "p.place", "p.source_size",
                     "p.target", "p.quota",
                     F.pmod(seeded(seed, F.col("d.doc_id")), F.col("p.shards")).alias("shard")))
    per_shard = (dealt.groupBy("place", "shard", "quota").agg(F.sum("size").alias("shard_size")))
    quotas = (sainte_lague(per_shard, ["place"], "shard", "shard_size", "quota")
              .select("place", "shard", "shard_size", F.least(
                  F.col("won") * block_words, max_repeats * F.col("shard_size")).alias("words")))
    start = F.expr(f"pmod(draw, greatest(ceil(shard_size / {block_words}), 1)) * {block_words}")
    quotas = (quotas.withColumn("draw", seeded(seed + 1, F.col("place"), F.col("shard")))
              .withColumn("first", start.cast("long"))
              .withColumn("passes", F.expr("words div greatest(shard_size, 1)"))
              .withColumn("rest", F.expr("words % greatest(shard_size, 1)"))
              .select("place", "shard", "shard_size", "first", "passes", "rest"))

    lane = Window.partitionBy("place", "shard").orderBy("turn", "doc_id", "size", "text_key")
    laid = (dealt.withColumn("turn", seeded(seed + 2, F.col("doc_id")))
            .withColumn("end", F.sum("size").over(lane.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("begin", F.col("end") - F.col("size")))
    both = laid.join(quotas, ["place", "shard"])

    def part(lo: str, hi: str, name: str) -> list[Column]:
        a = F.expr(f"greatest(begin, {lo}) - begin")
        b = F.expr(f"least(end, {hi}) - begin")
        return [F.when(b > a, a).otherwise(0).alias(f"from{name}"), F.when(b > a, b).otherwise(0).alias(f"to{name}")]

    return (both.select("doc_id", "source", "size", "source_size", "target", "passes", "text_key",
                        *part("first", "least(first + rest, shard_size)", "1"),
                        *part("0", "first + rest - shard_size", "2"))
            .withColumn("taken", F.expr("passes * size + to1 - from1 + to2 - from2")))
