"""Line deduplication by overlapping windows of three consecutive lines.

Each text is cut at ``\\n``; blank lines (space only) belong to no window. Every three
consecutive remaining lines of a document, trimmed, hash to one window. Of all equal
windows in the corpus the first (least document id, then position) stays; the lines that
any later one covers are removed, overlapping windows being merged. Windows are judged on
the input. Documents with fewer than three lines have no window and stay as they are.

Scale: one pass writes (window hash, document, position), without texts. The first
holder is a minimum with partial aggregation, so a window that a third of the rows hold
leaves each map task as one row. The later occurrences are found in a join of the windows
with the repeated ones alone (one row a window, a skewed side is split at run time) and
come back as one array of positions per document, bounded by its own lines. Texts are
shuffled once, for that last join.

Null text stays null, empty text stays empty, both without lines. A null id comes before
all others. Rows that share an id follow each other by a hash of the text, and exactly
repeated rows count as one document: each keeps what the first keeps. Very long texts are
handled in their row. Empty tables give empty tables. Other columns are carried along
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.tables import written

WINDOW = 3
_SPACE_EDGES = "^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$"


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _filled(text: Column) -> Column:
    """(line number, trimmed line) of the lines that are not blank."""
    rows = F.transform(_lines(text), lambda line, i: F.struct(
        i.alias("i"), F.regexp_replace(line, _SPACE_EDGES, "").alias("t")))
    return F.filter(rows, lambda r: F.length(r["t"]) > 0)


def _row_key(id_col: str, text_col: str) -> list[Column]:
    return [F.col(id_col).alias("id"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("key")]


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   window: int = WINDOW) -> DataFrame:
    """``id``, ``key`` (hash of id and text) and ``gone`` (numbers of the lines to remove)
    of the documents that lose lines."""
    base = docs.select(*_row_key(id_col, text_col), _filled(F.col(text_col)).alias("filled"))
    runs = F.arrays_zip(*[F.slice("filled", i + 1, F.size("filled") - (window - 1)).alias(f"l{i}")
                          for i in range(window)])
    each = (base.where(F.size("filled") >= window)
            .select("id", "key", F.posexplode(runs).alias("p", "w")))
    texts = [F.col(f"w.l{i}.t") for i in range(window)]
    windows = written(each.select(
        F.xxhash64(*texts).alias("h1"), F.xxhash64(F.lit(WINDOW), *texts).alias("h2"),
        F.struct("id", "key", "p").alias("at"),
        F.array(*[F.col(f"w.l{i}.i") for i in range(window)]).alias("covers")), "line-windows")
    # written: a join of two shuffled tables can split a hot window at run time
    firsts = written(windows.groupBy("h1", "h2").agg(F.min("at").alias("first"), F.max("at").alias("last"))
                     .where("first < last").select("h1", "h2", "first"), "line-firsts")
    later = windows.join(firsts, ["h1", "h2"]).where(F.col("at") > F.col("first"))
    return (later.select("at.id", "at.key", F.explode("covers").alias("line"))
            .groupBy("id", "key").agg(F.collect_set("line").alias("gone")))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                window: int = WINDOW) -> DataFrame:
    """The columns of ``docs`` with the repeated windows cut out of ``text_col``, in a struct
    ``doc``, with ``n_lines`` and ``n_removed`` (lines before, lines cut out)."""
    gone = repeated_lines(docs, id_col, text_col, window).alias("g")
    keyed = docs.select(F.struct("*").alias("doc"), *_row_key(id_col, text_col)).alias("d")
    both = keyed.join(gone, F.expr("d.key = g.key and d.id <=> g.id"), "left").select("doc", "gone")
    text = F.col("doc").getField(text_col)
    # the lines are bound once, then picked by the line numbers that stay
    bound = F.array(F.struct(_lines(text).alias("lines"), F.col("gone")))
    cut = F.element_at(F.transform(bound, lambda b: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(b["lines"]) - 1), b["gone"]),
        lambda i: F.get(b["lines"], i)), "\n")), 1)
    new_text = F.when(F.col("gone").isNull(), text).otherwise(cut)
    return both.select(
        F.struct(*[(new_text if c == text_col else F.col("doc").getField(c)).alias(c)
                   for c in docs.columns]).alias("doc"),
        F.when(text.isNull(), 0).otherwise(F.size(_lines(text))).alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).alias("n_removed"))
