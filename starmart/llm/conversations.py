"""Conversation structure repair: the cheapest edits that make the roles alternate.

A conversation's rows stand in order of their turn (nulls first), rows of one turn by role and
text. Each row has at most one fault: *blank* (no character but separators), *duplicate* (role
and text seen earlier in the conversation), *truncated* (its last such character ends no
sentence). Rows are kept (cost 0), reroled to user or assistant (1) or deleted (2; a must for
blank and duplicate ones); empty user or assistant rows may be inserted anywhere (5). A truncated
row that stays costs 5 more. The repaired role initials have the form ``(s?(ua)+)?``. Among the
cheapest edits those come out whose initials (Keep, Rerole, Delete, Insert) in order, the
*audit*, are least in ASCII.

*Cost DP.* A row is a matrix of least costs between the four states of the grammar; a
conversation's costs are products of these in (min, +), taken for all rows of a batch at once
by doubling. *Path ranking.* The nodes are (row, state), the arcs those on a cheapest path.
Nodes are ranked by the first 1, 2, 4, ... letters of their least audit: the rank by 2m letters
is that of the pair (rank by m letters, rank by m letters of the node m edits on). From a node
an arc's letter fixes its end (the grammar leaves an insert or a rerole one role), so of equal
prefixes one pointer is kept; the ranks of an arc's ends select the least arc, and the path is
read off the doubled pointers, again for all conversations of a batch at once.

Scale: conversations of at most ``short_rows`` rows and ``short_bytes`` bytes, as counted first,
meet whole in a task: one shuffle of the rows by conversation, memory bounded by a batch and one
such conversation. Longer ones, a hot id for instance, are sorted by range and cut into blocks
of ``2 ** block_bits`` rows. Blocks give their cost matrix; a conversation's blocks are chained
backwards for the costs after each block; every block is then solved for each state it may be
entered in, and a second chain picks the state. Duplicates come from partially aggregated first
places of (role, text). The chains see one row a block, never the rows. The digest of a repaired
conversation reads all its text in order by its nature: it runs over a sorted stream, row by
row, in memory that does not grow.

A null role or text counts as one space, a null conversation id is an id of its own and
repeated rows are rows like any others. A conversation with no rows present, all dropped, has
zeros, an empty audit and the digest of the empty text. Extra columns are ignored. An empty
table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.tables import map_in_arrow, ship_package, written

SHORT_ROWS, SHORT_BYTES, BLOCK_BITS = 4096, 16 << 20, 16
SPACE = "\\x20\\x09-\\x0D"
_INF = np.int64(1) << 40

# Grammar: states, and where the initials s, u, a lead from each (-1: nowhere).
START, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = np.array([[SYSTEM, USER, -1], [-1, USER, -1], [-1, -1, ASSISTANT], [-1, USER, -1]])
_FINAL = np.array([0, _INF, _INF, 0], dtype=np.int64)
_ROLE = {USER: "user", ASSISTANT: "assistant"}
KEEP, REROLE, DELETE, INSERT, CUT = 0, 1, 2, 5, 5
_LETTERS = np.frombuffer(b"\0DIKR", dtype=np.uint8)            # rank of a letter = its place here
_OFFERED = np.array([max(n[1], n[2]) for n in _NEXT])          # state after an inserted or reroled row


def _inserts() -> np.ndarray:
    """Least costs between states by inserts alone."""
    out = np.where(np.eye(4, dtype=bool), np.int64(0), _INF)
    for s in range(4):
        at, cost = s, 0
        for _ in range(3):
            at, cost = int(_OFFERED[at]), cost + INSERT
            out[s, at] = min(out[s, at], cost)
    return out


_FREE = _inserts()


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(min, +) products of stacks of matrices (or of matrices and vectors)."""
    if b.ndim == a.ndim:
        return np.minimum((a[..., :, :, None] + b[..., None, :, :]).min(axis=-2), _INF)
    return np.minimum((a + b[..., None, :]).min(axis=-1), _INF)


def _row_matrices(code: np.ndarray, blocked: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """Least costs from before a row (inserts included) to after it."""
    n = len(code)
    edit = np.full((n, 4, 4), _INF)
    stay = np.where(blocked, _INF, CUT * cut.astype(np.int64))
    for s in range(4):
        to = _OFFERED[s]
        edit[:, s, to] = REROLE + stay
        for c in range(3):
            if _NEXT[s, c] >= 0:
                keep = np.where(code == c, KEEP + stay, _INF)
                edit[:, s, _NEXT[s, c]] = np.minimum(edit[:, s, _NEXT[s, c]], keep)
        edit[:, s, s] = np.minimum(edit[:, s, s], DELETE)
    return _times(np.broadcast_to(_FREE, edit.shape), np.minimum(edit, _INF))


def suffix_products(m: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Product of the matrices from each row to the end of its segment (``end``: row after it)."""
    out, step = m.copy(), 1
    at = np.arange(len(m))
    while True:
        at = at[at + step < end[at]]
        if not len(at):
            return out
        out[at] = _times(out[at], out[at + step])
        step *= 2


class Segments:
    """Rows of several conversations, or of blocks of them, solved together.

    ``first``: row offsets of the segments; ``after``: least costs to the end of the conversation
    from each state after the segment; ``last``: the segment ends its conversation.
    """

    def __init__(self, code, blocked, cut, first, after=None, last=None):
        self.code, self.blocked, self.cut, self.first = code, blocked, cut, first
        n = len(first) - 1
        self.after = np.broadcast_to(_FINAL, (n, 4)) if after is None else after
        self.last = np.ones(n, dtype=bool) if last is None else last
        self.segment = np.repeat(np.arange(n), np.diff(first))
        self.product = suffix_products(_row_matrices(code, blocked, cut), first[1:][self.segment])

    def matrices(self) -> np.ndarray:
        return self.product[self.first[:-1]]

    def _rank(self) -> None:
        rows, n = len(self.code), len(self.first) - 1
        place = np.arange(rows) + self.segment                   # one more position at each end
        ends = self.first[1:] + np.arange(n)
        left = np.empty((rows + n, 4), dtype=np.int64)           # least cost from (position, state)
        closing = np.where(self.last[:, None], _times(np.broadcast_to(_FREE, (n, 4, 4)), self.after), self.after)
        left[ends] = closing
        left[place] = _times(self.product, closing[self.segment])
        self.left, self.place = left, place
        # arcs in order of their letters D, I, K, R
        target = np.full((rows + n, 4, 4), -1, dtype=np.int64)
        cost = np.full((rows + n, 4, 4), _INF)
        node = np.arange(rows + n)[:, None] * 4
        states = np.arange(4)
        stay = np.where(self.blocked, _INF, CUT * self.cut.astype(np.int64))[:, None]
        target[place, :, 0], cost[place, :, 0] = node[place] + 4 + states, DELETE
        open_ = np.concatenate([place, ends[self.last]])
        target[open_, :, 1], cost[open_, :, 1] = node[open_] + _OFFERED, INSERT
        for c in range(3):
            mine = np.flatnonzero(self.code == c)
            for s in states[_NEXT[:, c] >= 0]:
                target[place[mine], s, 2] = node[place[mine], 0] + 4 + _NEXT[s, c]
                cost[place[mine], s, 2] = KEEP + stay[mine, 0]
        target[place, :, 3], cost[place, :, 3] = node[place] + 4 + _OFFERED, REROLE + stay
        flat = left.reshape(-1)
        total = np.where(target >= 0, cost + flat[np.maximum(target, 0)], _INF).reshape(-1, 4)
        target = target.reshape(-1, 4)
        best = (total == flat[:, None]) & (flat[:, None] < _INF)
        done = np.zeros((rows + n, 4), dtype=bool)
        done[ends] = left[ends] == self.after                    # nothing more is inserted here
        best[done.reshape(-1)] = False
        moving = best.any(axis=1)
        self.arc = np.argmax(best, axis=1)                       # least letter of an optimal arc
        jump = np.where(moving, target[np.arange(len(target)), self.arc], np.arange(len(target)))
        rank = np.where(moving, self.arc + 1, 0)
        count = moving.astype(np.int64)
        self.jumps, self.moving = [jump], moving
        while moving[jump].any():
            pair = rank * (len(rank) + 1) + rank[jump]
            rank = np.unique(pair, return_inverse=True)[1]
            count = count + count[jump]
            jump = jump[jump]
            self.jumps.append(jump)
        # of optimal arcs, the one whose letter and rank of its end are least
        key = np.where(best, np.arange(4) * (len(rank) + 1) + rank[np.maximum(target, 0)], _INF)
        self.arc = np.argmin(key, axis=1)
        self.target, self.rank, self.count = target, rank, count

    def paths(self, entry: np.ndarray):
        """Least audits of all segments, entered in the states ``entry`` (one each).

        Returns (segment, letter, row, state after) of every edit in order, the exit states and
        the costs; an infeasible entry has no edits and a cost of at least ``_INF``.
        """
        if not hasattr(self, "rank"):
            self._rank()
        n = len(self.first) - 1
        start = (self.first[:-1] + np.arange(n)) * 4 + entry
        cost = self.left.reshape(-1)[start]
        length = np.where(cost < _INF, self.count[start], 0)
        segment = np.repeat(np.arange(n), length)
        step = np.arange(len(segment)) - np.repeat(np.cumsum(length) - length, length)
        node = start[segment]
        for bit, jump in enumerate(self.jumps):
            on = (step >> bit) & 1 == 1
            node[on] = jump[node[on]]
        letter = self.arc[node] + 1
        after = self.target[node, self.arc[node]]
        row = node // 4 - segment
        return segment, letter, row, after % 4, self.jumps[-1][start] % 4, cost


def _illegal(code: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Adjacent initials that are not su, ua or au."""
    return ~(((code == 0) & (other == 1)) | ((code == 1) & (other == 2)) | ((code == 2) & (other == 1)))


def _audit(letters: np.ndarray) -> str:
    return _LETTERS[letters].tobytes().decode("ascii")


def _seen(key: np.ndarray) -> np.ndarray:
    """True where a row of ``key`` (rows x numbers) is equal to an earlier one."""
    out = np.ones(len(key), dtype=bool)
    order = np.lexsort(key.T[::-1])                              # stable: earlier rows first
    new = np.ones(len(key), dtype=bool)
    new[1:] = (key[order][1:] != key[order][:-1]).any(axis=1)
    out[order[new]] = False
    return out


REPORT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _whole(table: pa.Table, first: np.ndarray) -> pa.RecordBatch:
    """Reports of complete conversations; ``first``: their row offsets, dropped rows included."""
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    ids = table.column("conv").take(pa.array(first[:-1]))
    here = table.column("present").to_numpy().astype(bool)
    owner, table, n = owner[here], table.filter(pa.array(here)), len(first) - 1
    code = table.column("code").to_numpy().astype(np.int64)
    blank, cut = (table.column(c).to_numpy().astype(bool) for c in ("blank", "cut"))
    seen = np.zeros(len(owner), dtype=bool)
    key = np.stack([owner, *(table.column(c).to_numpy() for c in ("h1", "h2"))], axis=1)
    seen[~blank] = _seen(key[~blank])
    cut &= ~seen & ~blank
    offsets = np.searchsorted(owner, np.arange(n + 1))
    full = np.flatnonzero(np.diff(offsets))
    out = {k: np.zeros(n, dtype=np.int64) for k in REPORT}
    audits, digests = [""] * n, [hashlib.sha256(b"").hexdigest()] * n
    for name, flag in (("blank", blank), ("duplicate", seen), ("truncated", cut)):
        out[name] = np.bincount(owner[flag], minlength=n)
    inside = owner[1:] == owner[:-1]
    out["illegal"] = np.bincount(owner[1:][inside & _illegal(code[:-1], code[1:])], minlength=n)
    turn = table.column("turn")
    known = turn.is_valid().to_numpy().astype(bool)
    turns, whose = turn.filter(pa.array(known)).to_numpy().astype(np.int64), owner[known]
    if len(turns):   # rows are in order of turn
        new = np.ones(len(turns), dtype=bool)
        new[1:] = (whose[1:] != whose[:-1]) | (turns[1:] != turns[:-1])
        which, begin = np.unique(whose, return_index=True)
        finish = np.append(begin[1:], len(turns)) - 1
        out["gaps"][which] = turns[finish] - turns[begin] + 1 - np.bincount(whose[new], minlength=n)[which]
    if len(full):
        solved = Segments(code, seen | blank, cut, np.append(offsets[full], offsets[-1]))
        segment, letter, row, after, _, cost = solved.paths(np.full(len(full), START))
        out["cost"][full] = cost
        role, text = table.column("role").to_pylist(), table.column("text").to_pylist()
        bounds = np.searchsorted(segment, np.arange(len(full) + 1))
        for k, i in enumerate(full):
            edits = slice(bounds[k], bounds[k + 1])
            audits[i] = _audit(letter[edits])
            lines = [f"{role[r] if le == 3 else _ROLE[st]}:{text[r] if le != 2 else ''}"
                     for le, r, st in zip(letter[edits].tolist(), row[edits].tolist(), after[edits].tolist())
                     if le != 1]
            digests[i] = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return pa.RecordBatch.from_arrays(
        [ids.combine_chunks(), *[pa.array(out[k]) for k in REPORT], pa.array(audits), pa.array(digests)],
        ["conv", *REPORT, "audit", "repaired_sha256"])


def _changes(column: pa.ChunkedArray) -> np.ndarray:
    """Rows that differ from the row before (nulls are alike); row 0 counts."""
    column = column.combine_chunks()
    out = np.ones(len(column), dtype=bool)
    if len(column) > 1:
        a, b = column.slice(0, len(column) - 1), column.slice(1)
        none = a.is_null().to_numpy(False) & b.is_null().to_numpy(False)
        same = pc.fill_null(pc.equal(a, b), False).to_numpy(False)
        out[1:] = ~(same | none)
    return out


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """(table, group offsets) of complete groups of rows that agree on ``keys``; rows come sorted."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        edge = pa.Table.from_batches([held[-2].slice(held[-2].num_rows - 1), batch] if len(held) > 1 else [batch])
        new = np.any([_changes(edge.column(k)) for k in keys], axis=0)
        if len(held) > 1:
            new = new[1:]
        else:
            new[0] = False
        if not new.any():
            continue
        stop = int(np.flatnonzero(new)[-1])
        yield _cut([*held[:-1], batch.slice(0, stop)], keys)
        held = [batch.slice(stop)]
    if held:
        yield _cut(held, keys)


def _cut(parts: list[pa.RecordBatch], keys: list[str]) -> tuple[pa.Table, np.ndarray]:
    table = pa.Table.from_batches(parts)
    starts = np.flatnonzero(np.any([_changes(table.column(k)) for k in keys], axis=0))
    return table, np.append(starts, table.num_rows)


def _solve_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table, first in _groups(batches, ["conv"]):
        yield _whole(table, first)


def damage(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """Conversations with seeded faults: by crc32(``conv:turn``) mod 20 a row is dropped (0), loses
    its text (1) or the ends of its sentences (2), comes twice (3) or turns into a user's (4).

    Returns ``conv``, ``turn``, ``role``, ``text``, ``present`` (false: dropped); nulls of role and
    text, and in the text that is hashed those of id and turn, are one space.
    """
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(filled(conv_col), F.lit(":"), filled(turn_col)).cast("binary")) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(filled(text_col), "[.!?]", ""))
    return (rows.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"),
                        F.when(kind == 4, F.lit("user")).otherwise(filled(role_col)).alias("role"),
                        text.otherwise(filled(text_col)).alias("text"), (kind != 0).alias("present"),
                        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
                        .alias("copy")).drop("copy"))


def _measured(turns: DataFrame) -> DataFrame:
    """What repair looks at besides the text: initial, faults of the row alone, hash of role and text."""
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    initial = F.substring(role, 1, 1)
    code = (F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3))
    body = F.regexp_replace(text, f"[{SPACE}]+$", "")
    both = F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text))
    half = lambda at: F.conv(F.substring(both, at, 15), 16, 10).cast("long")
    return turns.select("conv", "turn", role.alias("role"), text.alias("text"), "present",
                        code.cast("byte").alias("code"), (body == "").alias("blank"),
                        (~F.substring(body, -1, 1).isin(".", "!", "?")).alias("cut"),
                        half(1).alias("h1"), half(16).alias("h2"))


def repair(turns: DataFrame, short_rows: int = SHORT_ROWS, short_bytes: int = SHORT_BYTES,
           block_bits: int = BLOCK_BITS) -> DataFrame:
    """Report of every conversation in ``turns`` (``conv``, ``turn``, ``role``, ``text``, ``present``).

    Returns ``conv``, ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``,
    ``audit`` and ``repaired_sha256`` (of the lines ``role:text`` of the repaired conversation).
    """
    kind = turns.schema["conv"].dataType.simpleString()
    schema = f"conv {kind}, " + ", ".join(f"{k} long" for k in REPORT) + ", audit string, repaired_sha256 string"
    long_ids = written(turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("b"))
                       .where((F.col("n") > short_rows) | (F.coalesce("b", F.lit(0)) > short_bytes)).select("conv"),
                       "conversations-long")
    rows = _measured(turns)
    some_long = not long_ids.isEmpty()
    listed = lambda how: rows.alias("r").join(long_ids.alias("l"), F.expr("r.conv <=> l.conv"), how)
    short = listed("left_anti") if some_long else rows
    dealt = short.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")
    done = map_in_arrow(dealt, _solve_whole, schema)
    return done.unionByName(_repair_long(listed("left_semi"), block_bits, kind, schema)) if some_long else done


def _block_groups(batches: Iterator[pa.RecordBatch]):
    """(table, ids, blocks, Segments arguments) of complete blocks of long conversations."""
    for table, first in _groups(batches, ["block", "conv"]):
        code = table.column("code").to_numpy().astype(np.int64)
        blocked, cut = (table.column(c).to_numpy().astype(bool) for c in ("blocked", "cut"))
        at = pa.array(first[:-1])
        yield table, table.column("conv").take(at).combine_chunks(), table.column("block").take(at).combine_chunks(), \
            (code, blocked, cut, first)


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A block's cost matrix, first and last initial and illegal pairs, for each conversation in it."""
    for _, ids, blocks, args in _block_groups(batches):
        code, first = args[0], args[3]
        owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
        bad = (owner[1:] == owner[:-1]) & _illegal(code[:-1], code[1:])
        flat = Segments(*args).matrices().reshape(-1)
        matrix = pa.ListArray.from_arrays(pa.array(np.arange(len(first), dtype=np.int32) * 16), pa.array(flat))
        yield pa.RecordBatch.from_arrays(
            [ids, blocks, matrix, pa.array(code[first[:-1]]), pa.array(code[first[1:] - 1]),
             pa.array(np.bincount(owner[1:][bad], minlength=len(first) - 1))],
            ["conv", "block", "matrix", "head", "tail", "bad"])


def _chain_costs(blocks: pd.DataFrame) -> pd.DataFrame:
    """Costs after each block of one conversation, and its illegal pairs across blocks."""
    blocks = blocks.sort_values("block")
    after, costs = _FINAL, []
    for matrix in reversed(blocks["matrix"].tolist()):
        costs.append([int(x) for x in after])
        # inserts at a conversation's end close its last block
        close = _times(_FREE, after) if len(costs) == 1 else after
        after = _times(np.asarray(matrix, dtype=np.int64).reshape(4, 4), close)
    head, tail = blocks["head"].to_numpy(), blocks["tail"].to_numpy()
    bad = blocks["bad"].to_numpy().copy()
    bad[1:] += _illegal(tail[:-1], head[1:])
    last = np.zeros(len(blocks), dtype=bool)
    last[-1] = True
    return pd.DataFrame({"conv": blocks["conv"], "block": blocks["block"], "after": costs[::-1],
                         "last": last, "bad": bad})


def _solve_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edits of each block for each state in which it may be entered."""
    for table, ids, blocks, args in _block_groups(batches):
        first = args[3]
        after = np.array(table.column("after").take(pa.array(first[:-1])).to_pylist(), dtype=np.int64)
        last = table.column("last").to_numpy().astype(bool)[first[:-1]]
        solved = Segments(*args, after=after, last=last)
        place = table.column("place").to_numpy()
        for entry in range(4):
            segment, letter, row, state, leave, cost = solved.paths(np.full(len(first) - 1, entry))
            bounds = np.searchsorted(segment, np.arange(len(first)))
            audits = [_audit(letter[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
            # an insert at the end of a conversation belongs to its last row
            held = np.minimum(row, first[1:][segment] - 1)
            offsets = pa.array(bounds.astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in
                     (place[held], letter.astype(np.int8), state.astype(np.int8))]
            out = pa.RecordBatch.from_arrays(
                [ids, blocks, pa.array(np.full(len(first) - 1, entry, np.int8)), pa.array(leave.astype(np.int8)),
                 pa.array(cost), pa.array(audits), *lists],
                ["conv", "block", "entry", "leave", "cost", "audit", "places", "letters", "states"])
            yield out.filter(pa.array(cost < _INF))


def _chain_states(blocks: pd.DataFrame) -> pd.DataFrame:
    """The state in which the least path enters each block of one conversation."""
    leave = {(b, e): to for b, e, to in zip(blocks["block"], blocks["entry"], blocks["leave"])}
    cost = {(b, e): c for b, e, c in zip(blocks["block"], blocks["entry"], blocks["cost"])}
    order = sorted(set(blocks["block"]))
    state, entries = START, []
    for b in order:
        entries.append(state)
        state = leave[b, state]
    return pd.DataFrame({"conv": [blocks["conv"].iloc[0]] * len(order), "block": order, "entry": entries,
                         "cost": [cost[order[0], START]] + [0] * (len(order) - 1)})


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each conversation's lines, from a sorted stream; one open digest at a time."""
    open_: tuple | None = None
    for batch in batches:
        done: list[tuple] = []
        for conv, line in zip(batch.column("conv").to_pylist(), batch.column("line").to_pylist()):
            if open_ is None or open_[0] != conv:
                if open_ is not None:
                    done.append((open_[0], open_[1].hexdigest()))
                open_ = (conv, hashlib.sha256(line.encode()))
            else:
                open_[1].update(b"\n" + line.encode())
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], batch.schema.field("conv").type),
                                          pa.array([d[1] for d in done], pa.string())], ["conv", "digest"])
    if open_ is not None:
        yield pa.RecordBatch.from_arrays([pa.array([open_[0]], batch.schema.field("conv").type),
                                          pa.array([open_[1].hexdigest()])], ["conv", "digest"])


def _repair_long(rows: DataFrame, bits: int, kind: str, schema: str) -> DataFrame:
    """The same report for conversations that do not fit a task."""
    spark = rows.sparkSession
    ship_package(spark)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), 1)
    order = ["conv", "turn", "role", "text"]
    # equal rows may stand in any order, so a number made at the scan may part them
    turns = written(rows.withColumn("spread", F.monotonically_increasing_id())
                    .repartitionByRange(parts, *order, "spread").sortWithinPartitions(*order, "spread")
                    .withColumn("place", F.monotonically_increasing_id()).drop("spread"), "conversations-turns")
    here = turns.where("present").drop("role", "text")
    same = lambda a, b, *keys: F.expr(" and ".join(
        [f"{a}.conv <=> {b}.conv", *[f"{a}.{k} = {b}.{k}" for k in keys]]))
    firsts = written(here.where("not blank").groupBy("conv", "h1", "h2").agg(F.min("place").alias("first")),
                     "conversations-firsts")
    flagged = (here.alias("r").join(firsts.alias("f"), same("r", "f", "h1", "h2"), "left")
               .select("r.*", (~F.col("blank") & (F.col("place") > F.col("first"))).alias("seen")))
    light = written(flagged.select(
        "conv", "turn", "place", F.shiftright("place", bits).alias("block"), "code", "blank", "seen",
        (F.col("blank") | F.col("seen")).alias("blocked"),
        (F.col("cut") & ~F.col("blank") & ~F.col("seen")).alias("cut")), "conversations-light")
    number = lambda c: F.sum(F.col(c).cast("long"))
    counts = light.groupBy("conv").agg(number("blank").alias("blank"), number("seen").alias("duplicate"),
                                       number("cut").alias("truncated"))
    gaps = (light.where("turn is not null").select("conv", "turn").distinct().groupBy("conv")
            .agg((F.max("turn") - F.min("turn") + 1 - F.count(F.lit(1))).alias("gaps")))
    in_blocks = lambda df: df.repartition("block").sortWithinPartitions("block", "place")
    body = light.select("conv", "place", "block", "code", "blocked", "cut")
    summary = written(map_in_arrow(
        in_blocks(body), _summaries,
        f"conv {kind}, block long, matrix array<long>, head long, tail long, bad long"), "conversations-blocks")
    after = written(summary.groupBy("conv").applyInPandas(
        _chain_costs, f"conv {kind}, block long, after array<long>, last boolean, bad long"), "conversations-after")
    known = (body.alias("r").join(after.alias("a"), same("r", "a", "block"))
             .select("r.*", "a.after", "a.last"))
    solved = written(map_in_arrow(
        in_blocks(known), _solve_blocks,
        f"conv {kind}, block long, entry byte, leave byte, cost long, audit string, "
        "places array<long>, letters array<byte>, states array<byte>"), "conversations-solved")
    states = written(solved.select("conv", "block", "entry", "leave", "cost").groupBy("conv").applyInPandas(
        _chain_states, f"conv {kind}, block long, entry byte, cost long"), "conversations-states")
    taken = (solved.alias("r").join(states.alias("s"), same("r", "s", "block", "entry"))
             .select("r.conv", "r.block", "s.cost", "audit", "places", "letters", "states"))
    audits = taken.groupBy("conv").agg(
        F.sum("cost").alias("cost"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "audit"))), lambda x: x["audit"]), "")
        .alias("audit"))
    edits = (taken.select("conv", F.posexplode(F.arrays_zip("places", "letters", "states")).alias("step", "e"))
             .select("conv", "step", "e.*").where("letters <> 1"))
    new_role = F.when(F.col("states") == USER, F.lit(_ROLE[USER])).otherwise(F.lit(_ROLE[ASSISTANT]))
    lines = (edits.alias("e").join(turns.alias("t"), F.expr("e.places = t.place"))
             .select("e.conv", "e.places", "e.step", F.concat(
                 F.when(F.col("letters") == 3, F.col("t.role")).otherwise(new_role), F.lit(":"),
                 F.when(F.col("letters") == 2, F.lit("")).otherwise(F.col("t.text"))).alias("line")))
    digests = map_in_arrow(lines.repartition("conv").sortWithinPartitions("conv", "places", "step")
                           .select("conv", "line"), _digests, f"conv {kind}, digest string")
    bad = after.groupBy("conv").agg(F.sum("bad").alias("illegal"))
    out = turns.select("conv").distinct().alias("i")
    for name, part in (("c", counts), ("g", gaps), ("b", bad), ("a", audits), ("d", digests)):
        out = out.join(part.alias(name), same("i", name), "left")
    empty = hashlib.sha256(b"").hexdigest()
    columns = [F.col("i.conv").alias("conv"), *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in REPORT],
               F.coalesce("audit", F.lit("")).alias("audit"),
               F.coalesce("digest", F.lit(empty)).alias("repaired_sha256")]
    return out.select(*columns)
