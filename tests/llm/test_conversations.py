"""Conversation repair against an exhaustive search, whole and in blocks."""

import binascii
import hashlib
import heapq
import random
import re

import pytest
from pyspark.sql import functions as F

from starmart.llm import conversations as C

FIELDS = "conv_id long, turn long, role string, text string, present string, conv string, code long, place string"


def _damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        mine = out.setdefault(conv, [])
        sp = lambda v: " " if v is None else str(v)
        kind = binascii.crc32(f"{sp(conv)}:{sp(turn)}".encode()) % 20
        role, text = sp(role), sp(text)
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        mine += [(turn, role, text)] * (2 if kind == 3 else 1)
    return out


def _report(rows):
    """Best-first search over (cost, audit): the first full path is cheapest and least."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, faults = set(), []
    for _, role, text in rows:
        body = re.sub("[\x20\x09-\x0d]+$", "", text)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen
                      else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    legal = {"": "su", "s": "u", "u": "a", "a": "u"}
    heap, done, best = [(0, "", 0, "", ())], {}, None
    while heap:
        cost, audit, i, at, lines = heapq.heappop(heap)
        if (i, at) in done:
            continue
        done[i, at] = 1
        if i == len(rows) and at in ("", "a"):
            best = (cost, audit, lines)
            break
        for ini, name in (("u", "user"), ("a", "assistant")):
            if ini in legal[at]:
                heapq.heappush(heap, (cost + 5, audit + "I", i, ini, lines + (f"{name}:",)))
                if i < len(rows) and faults[i] not in ("blank", "duplicate"):
                    heapq.heappush(heap, (cost + 1 + 5 * (faults[i] == "truncated"), audit + "R", i + 1, ini,
                                          lines + (f"{name}:{rows[i][2]}",)))
        if i < len(rows):
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, at, lines))
            ini = rows[i][1][:1]
            if ini and ini in legal[at] and faults[i] not in ("blank", "duplicate"):
                heapq.heappush(heap, (cost + 5 * (faults[i] == "truncated"), audit + "K", i + 1, ini,
                                      lines + (f"{rows[i][1]}:{rows[i][2]}",)))
    turns = [r[0] for r in rows if r[0] is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *[faults.count(k) for k in ("blank", "duplicate", "truncated")],
            sum(p not in ("su", "ua", "au") for p in pairs), best[0], best[1],
            hashlib.sha256("\n".join(best[2]).encode()).hexdigest())


def _rows(seed=5):
    rng = random.Random(seed)
    rows = []
    for conv in range(60):
        for turn in range(rng.randrange(1, 9)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "ugly", "User"])
            text = rng.choice(["Yes.", "No!", "Why?  ", "cut off", "", " \t\n", None, "Élan.", "a\x0bb.", "x.\x0c"])
            rows.append((conv, rng.choice([turn, turn, turn * 3, None]), role, text))
    good = [(100, t, "user" if t % 2 == 0 else "assistant", f"Line {t}.") for t in range(40)]
    rows += good + good[:5] + [(None, t, "user", "Same.") for t in range(30)] + [(None, None, None, None)] * 3
    rows += [(200, t, rng.choice(["user", "assistant"]), "long " * 20_000 + ".") for t in range(3)]
    # conversations that lose every row
    rows += [(c, 0, "user", "Gone.") for c in range(300, 380)]
    rng.shuffle(rows)
    return rows


def _frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", 7, "clash") for r in rows], FIELDS)


@pytest.fixture(scope="module")
def wanted():
    return {conv: _report(rows) for conv, rows in _damaged(_rows()).items()}


@pytest.mark.parametrize("limits", [{}, {"short_rows": 3, "block_bits": 1}, {"short_rows": 0, "block_bits": 0},
                                    {"short_bytes": 100_000, "block_bits": 2}])
def test_against_search(spark, wanted, limits):
    got = C.repair(C.damage(_frame(spark, _rows())), **limits).collect()
    assert len(got) == len(wanted)
    assert {r.conv: tuple(r)[1:] for r in got} == wanted


def test_lost_and_empty(spark, wanted):
    lost = [r for c, r in wanted.items() if c is not None and c >= 300 and r[6] == ""]
    assert lost and all(r == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for r in lost)
    assert C.repair(C.damage(_frame(spark, []))).count() == 0
    assert C.repair(C.damage(_frame(spark, [])), short_rows=0).count() == 0


def test_all_deleted(spark):
    rows = _frame(spark, [(1, t, "user", " ") for t in range(6)])
    turns = C.damage(rows).withColumn("present", F.lit(True))
    for limits in ({}, {"short_rows": 2, "block_bits": 1}):
        row = C.repair(turns, **limits).collect()[0]
        assert set(row.audit) == {"D"} and row.cost == 2 * len(row.audit) == 2 * row.blank
        assert row.repaired_sha256 == hashlib.sha256(b"").hexdigest()


def test_copies_of_one_row_in_blocks(spark):
    """One row repeated holds all of a conversation: copies are parted between range partitions."""
    turns = _frame(spark, [(1, 0, "user", "Copy.")] * 500).select(
        F.col("conv_id").alias("conv"), "turn", "role", "text", F.lit(True).alias("present"))
    whole, parts = (C.repair(turns, **k).collect()[0] for k in ({}, {"short_rows": 9, "block_bits": 3}))
    assert whole == parts and whole.duplicate == 499 and whole.audit == "D" * 500 and whole.cost == 1000
