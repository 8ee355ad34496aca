"""Small corpora with the awkward cases every operator must handle."""

import random
import re

from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
     T.StructField("n_chars", T.LongType())]
    # columns that clash with names the operators use inside
    + [T.StructField(c, T.StringType()) for c in (
        "id", "key", "n", "h", "pos", "r", "v", "x", "row", "doc", "size", "shard", "taken", "takes",
        "kept", "score", "text_key", "n_removed", "copies", "piece", "source_size", "bands", "gone")])
EXTRA = len(SCHEMA) - 5


def fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def words(text):
    return WORD.findall(text or "")


def frame(spark, rows):
    """Rows are (doc_id, text) or (doc_id, text, lang, source)."""
    full = []
    for r in rows:
        doc_id, text, lang, source = (*r, "en", "s0")[:4] if len(r) == 2 else r
        full.append((doc_id, text, lang, source, len(text) if text is not None else None)
                    + ("clash",) * EXTRA)
    return spark.createDataFrame(full, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def sentence(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def corpus(seed=3, groups=12):
    """(doc_id, text) with exact copies, near copies, shared passages, edge texts."""
    rng = random.Random(seed)
    shared = [sentence(rng, 70, 5000) for _ in range(3)]
    rows, base = [], []
    for i in range(groups):
        lines = [sentence(rng, rng.randrange(8, 40), 3000) for _ in range(rng.randrange(2, 7))]
        if i % 3 == 0:
            lines.insert(rng.randrange(len(lines)), shared[i % len(shared)])
        base.append("\n".join(lines))
    for i, text in enumerate(base):
        rows.append((10 * i, text))
        if i % 2 == 0:
            rows.append((10 * i + 1, text))                                # exact copy
        if i % 3 == 1:
            changed = text.split(" ")
            changed[len(changed) // 2] = "changed"
            rows.append((10 * i + 2, " ".join(changed)))                   # near copy
    rows += [(900, ""), (901, None), (902, "one"), (903, "two words"), (904, " \t\n "),
             (905, "Ünïcode ½ straße 你好"), (906, "a\rb\x0bc\x0cd")]
    rows.append((907, sentence(rng, 30_000, 20_000)))                       # a very long text
    rows.append((908, rows[-1][1] + " tail"))
    rows += [(10, rows[2][1] if rows[2][0] == 10 else base[1])] * 2         # repeated rows of one id
    rows.append((None, base[0]))                                           # no id
    rows.append((None, None))
    return rows
