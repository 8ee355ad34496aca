"""Sum-of-squares online packing of tokenised documents into fixed windows.

Every document becomes its token ids plus one end id. Whole windows are cut off first;
the rest (shorter than a window) is placed online: ``level[h]`` counts the open windows
with ``h`` ids, and the rest goes to the fill level, or a new window, after which the sum
of the squared counts is smallest (ties: the fuller window). The rule keeps open windows
at many different fill levels, so some gap fits almost any length.

Each input partition packs its own stream and closes its open windows at the end: the
emptiest are cut up to fill the gaps of the fullest, so one is left at most; it is cut
into sequences whose lengths are powers of two, which need no padding.

Scale: no shuffle at all, each task reads its split once. Memory of a task is the open
windows (fewer than ``window`` of ``window`` ids) and one batch. A lost task is redone
from the same split and gives the same rows; the sequence id holds the partition.

Null or empty text: the end id alone. Repeated rows are packed once for each row. Very
long texts are cut into as many windows as they need. Empty table: no rows. Columns
other than the id and text are ignored.

Token ids are those of the byte-level BPE file. Texts of characters below U+0240 are
encoded from its rank file (the same vocabulary and merges, several times faster),
others by the tokenizer file itself.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.tables import map_in_arrow
from starmart.llm.text import slices

WINDOW = 2048
END_ID = 1
TOKENIZER = "byte_bpe_50k"
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, sequence_tokens long, ids array<int>")
_WIDE = re.compile("[^\x00-ȿ]")
# a single space between two letters always starts a token, so a text may be cut before it
_CUT = re.compile("(?<=[A-Za-z]) (?=[A-Za-z])")
PART = 1 << 19
_PARTITION_BITS = 36


@lru_cache(maxsize=2)
def _encoders(name: str):
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))
    exact.encode_special_tokens = True
    with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})
    return exact, fast


def encode(text: str | None, tokenizer: str = TOKENIZER) -> list[int]:
    """Token ids of a text (null: none), without special tokens."""
    if not text:
        return []
    exact, fast = _encoders(tokenizer)
    if _WIDE.search(text):
        return exact.encode(text, add_special_tokens=False).ids
    return fast.encode_ordinary(text)


def encoded(text: str | None, end_id: int = END_ID, tokenizer: str = TOKENIZER) -> np.ndarray:
    """Token ids of a text and the end id; a very long text is encoded in parts."""
    parts, at = [], 0
    while text and len(text) - at > PART and (cut := _CUT.search(text, at + PART)):
        parts.append(np.array(encode(text[at:cut.start()], tokenizer), dtype=np.int32))
        at = cut.start()
    parts.append(np.array([*encode(text[at:] if text else None, tokenizer), end_id], dtype=np.int32))
    return np.concatenate(parts)


class Packer:
    """Sum-of-squares packing of one stream; pieces are (doc, start, total ids, ids)."""

    def __init__(self, window: int, first_sequence: int):
        self.window, self.next_id = window, first_sequence
        self.level = np.zeros(window + 1, dtype=np.int64)
        self.open: dict[int, list[list[tuple]]] = {}   # fill level -> windows (lists of pieces)

    def add(self, doc: int, ids: np.ndarray) -> Iterator[tuple]:
        """Place a document; yields the rows of every window that is now full."""
        total, w = len(ids), self.window
        whole = total - total % w
        for at in range(0, whole, w):
            yield from self._close([(doc, at, total, ids[at:at + w])])
        if whole < total:
            piece = (doc, whole, total, ids[whole:])
            size = total - whole
            fill = self._best(size)
            held = self.open[fill].pop() if fill else []
            if fill:
                self.level[fill] -= 1
            held.append(piece)
            if fill + size == w:
                yield from self._close(held)
            else:
                self.level[fill + size] += 1
                self.open.setdefault(fill + size, []).append(held)

    def _best(self, size: int) -> int:
        """Fill level whose growth by ``size`` leaves the least sum of squared counts."""
        n, w = self.level, self.window
        levels = np.flatnonzero(n[1:w - size + 1]) + 1
        if not len(levels):
            return 0
        change = 2 * (n[levels + size] - n[levels]) + 2
        change = np.where(levels + size == w, 1 - 2 * n[levels], change)
        k = len(levels) - 1 - int(np.argmin(change[::-1]))
        return int(levels[k]) if change[k] <= 2 * n[size] + 1 else 0

    def finish(self) -> Iterator[tuple]:
        """Close the open windows: the emptiest fill the gaps of the fullest."""
        left = [[fill, held] for fill in sorted(self.open) for held in self.open[fill]]
        self.open, low = {}, 0
        high = len(left) - 1
        while low < high:
            gap = self.window - left[high][0]
            doc, start, total, ids = left[low][1].pop()
            take = min(gap, len(ids))
            left[high][1].append((doc, start + len(ids) - take, total, ids[len(ids) - take:]))
            left[high][0] += take
            left[low][0] -= take
            if take < len(ids):
                left[low][1].append((doc, start, total, ids[:len(ids) - take]))
            if left[high][0] == self.window:
                yield from self._close(left[high][1])
                high -= 1
            if not left[low][0]:
                low += 1
        if low == high:
            yield from self._powers_of_two(left[low][1])

    def _powers_of_two(self, pieces: list[tuple]) -> Iterator[tuple]:
        rest = sum(len(p[3]) for p in pieces)
        while rest:
            size = 1 << (rest.bit_length() - 1)
            rest -= size
            held = []
            while size:
                doc, start, total, ids = pieces.pop(0)
                take = min(size, len(ids))
                held.append((doc, start, total, ids[:take]))
                if take < len(ids):
                    pieces.insert(0, (doc, start + take, total, ids[take:]))
                size -= take
            yield from self._close(held)

    def _close(self, pieces: list[tuple]) -> Iterator[tuple]:
        size, offset = sum(len(p[3]) for p in pieces), 0
        for doc, start, total, ids in pieces:
            yield (doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total,
                   self.next_id, offset, size, ids)
            offset += len(ids)
        self.next_id += 1


def _batch(rows: list[tuple], keep_ids: bool) -> pa.RecordBatch:
    columns = list(zip(*rows))
    arrays = [pa.array(columns[i], pa.int64()) for i in range(8)]
    if keep_ids:
        arrays.append(pa.array(columns[8], pa.list_(pa.int32())))
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays(arrays, names[:len(arrays)])


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         window: int = WINDOW, end_id: int = END_ID, tokenizer: str = TOKENIZER,
         keep_ids: bool = True) -> DataFrame:
    """One row per piece: where it starts in its document, and its sequence and offset.

    ``ids`` (with ``keep_ids``) are the piece's token ids, so the rows of a sequence in
    order of ``offset`` are a training window.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(window, TaskContext.get().partitionId() << _PARTITION_BITS)
        rows: list[tuple] = []
        for whole in batches:
            for part in slices(whole):
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    rows.extend(packer.add(doc, encoded(text, end_id, tokenizer)))
                if rows:
                    yield _batch(rows, keep_ids)
                    rows = []
        for row in packer.finish():
            rows.append(row)
            if len(rows) >= 4096:
                yield _batch(rows, keep_ids)
                rows = []
        if rows:
            yield _batch(rows, keep_ids)

    schema = SCHEMA if keep_ids else SCHEMA.rpartition(", ")[0]
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_in_arrow(source, run, schema)
