"""Training corpus in five stages: classify, remove repeated lines and near duplicates, mix, pack.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but
the last return the columns of ``documents``. ``run`` writes each stage's rows as Parquet
below the shared checkpoint folder and reads them again for the next stage, so a lost
executor never costs more than the stage in hand.

Empty tables pass through every stage. Columns beyond those of ``documents`` are carried
to the last stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm import classify, line_dedup, minhash, mixing, packing
from starmart.llm.tables import documents, words_array
from starmart.session import delete_path, scratch_path, scratch_scope

WORD = "[^\\x20\\x09-\\x0D]"


def _columns(docs: DataFrame, text: Column) -> list[Column]:
    """The columns of ``docs``, held in the struct ``doc``, with another text (and its length,
    where there is a column of it)."""
    length = F.char_length(text).cast("long")
    return [text.alias(c) if c == "text" else length.alias(c) if c == "n_chars"
            else F.col("doc").getField(c).alias(c) for c in docs.columns]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return classify.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated three-line windows; a document that loses all its words goes."""
    rows = line_dedup.dedup_lines(docs)
    text = F.col("doc").getField("text")
    gone = (F.col("n_removed") > 0) & ~F.coalesce(text.rlike(WORD), F.lit(False))
    return rows.where(~gone).select(*_columns(docs, text))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the least id) of each group of near duplicates.

    Five-word shingles, similarity 0.8. Rows that repeat id and text count once.
    """
    groups = minhash.near_duplicates(docs)
    gone = groups.where(~F.col("kept")).select("doc_id").distinct()
    rows = docs.select(F.struct("*").alias("doc"), "doc_id", F.xxhash64("text").alias("text_key"))
    kept = rows.join(gone, "doc_id", "left_anti").dropDuplicates(["doc_id", "text_key"])
    return kept.select("doc.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: a row for each whole pass over a document, and one for
    each part of it that the last blocks cut out (its words, joined by a space)."""
    key = ["doc_id", "source", "text_key"]
    takes = (mixing.mix(docs).where("taken > 0").groupBy(*key)
             .agg(F.collect_list(F.struct("passes", "from1", "to1", "from2", "to2", "size")).alias("takes")))
    whole = (docs.select(F.struct("*").alias("doc"), "doc_id", "source", F.xxhash64("text").alias("text_key"))
             .dropDuplicates(key))
    same = F.expr(" and ".join(f"d.{k} <=> t.{k}" for k in key))
    both = whole.alias("d").join(takes.alias("t"), same).select("doc", "takes")

    def spans(take: Column) -> Column:
        """Word ranges of one row's share; a whole pass is (0, size)."""
        whole_passes = F.array_repeat(F.struct(F.lit(0).cast("long").alias("a"), take["size"].alias("b")),
                                      take["passes"].cast("int"))
        parts = F.filter(F.array(*[F.struct(take[f"from{i}"].cast("long").alias("a"),
                                            take[f"to{i}"].cast("long").alias("b")) for i in (1, 2)]),
                         lambda s: s["b"] > s["a"])
        return F.concat(whole_passes, parts)

    pieces = both.select("doc", F.explode(F.flatten(F.transform("takes", lambda t: F.transform(
        spans(t), lambda s: F.struct(s["a"].alias("a"), s["b"].alias("b"), t["size"].alias("n")))))
    ).alias("piece"))
    text = F.col("doc").getField("text")
    part = F.array_join(F.slice(words_array(text), (F.col("piece.a") + 1).cast("int"),
                                (F.col("piece.b") - F.col("piece.a")).cast("int")), " ")
    complete = (F.col("piece.a") == 0) & (F.col("piece.b") == F.col("piece.n"))
    return pieces.select(*_columns(docs, F.when(complete, text).otherwise(part)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences of at most 2048 ids: one row per piece, with its ids."""
    return packing.pack(docs)


STAGES = [("quality", quality), ("lines", lines), ("near", near), ("mix", mix), ("pack", pack)]

# The classifier and the signatures cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed corpus; a stage's own intermediate tables go when its rows are written, its rows
    when the next stage's are."""
    docs, before = documents(spark, sf_dir), None
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        with scratch_scope(spark):
            rows = stage(spark, docs, sf_dir)
            rows.write.mode("overwrite").parquet(path)
        docs = spark.read.schema(rows.schema).parquet(path)
        if before is not None:
            delete_path(spark, before)
        before = path
    return docs
