"""License notices in texts: MinHash bands retrieve, exact containment verifies.

*Templates* are notices or whole licenses: ``TEMPLATES``, or the caller's own as a dictionary or
a table of (name, text), where a name may have several texts. A template's shingles are its
five-word windows, or its whole word sequence where it is shorter. Words are runs of letters and
digits, with A-Z folded.

*Windows.* Texts are cut into overlapping windows, one size per template length: a
template of ``m`` shingles is looked for in windows of ``m + s - 1`` shingles every
``s = max(1, m // 4)`` shingles, so it always lies whole in some window.

*Bands.* A window that contains a share ``c`` of the template has similarity of at least
``c m / (m + s - 1 + (1 - c) m)``, 0.55 at worst for ``c`` = 0.8. With ``BANDS`` bands of
``ROWS`` minima the chance to miss it is (1 - 0.55^2)^48 < 4e-8. The templates' bands are a
sorted dictionary in which a window's bands are looked up, so the work follows the windows and
what they retrieve, not the number of templates.

*Verification.* For each retrieved pair the share of the template's shingles that the
window contains is counted exactly; pairs of ``THRESHOLD`` or more match. Overlapping
matches of one template give one row, the best.

A window that holds no shingle of any template cannot share a minimum with one, so only
windows around such shingles are signed, in the sizes of the templates that have the shingle;
this changes no result.

Scale: one pass without a shuffle; templates are a bounded list (``MAX_TEMPLATES`` texts of
``MAX_BYTES`` in all, checked before a table of them is read to the driver) that travels with
the code. Null and empty texts match nothing, very long texts are scanned
whole, repeated rows match alike, extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.tables import arrow_map
from starmart.llm.text import grams, mix, separators, slices, stream, words

SHINGLE, BANDS, ROWS, THRESHOLD = 5, 48, 2, 0.8
MAX_TEMPLATES, MAX_BYTES = 10_000, 32 << 20
# Usual notices by their license.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-header": (
        "Unless required by applicable law or agreed to in writing, software distributed under the License "
        "is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express "
        "or implied. See the License for the specific language governing permissions and limitations under "
        "the License."),
    "MIT": "Released under the MIT License",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
        "sublicense, and/or sell copies of the Software"),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation"),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met"),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "all-rights-reserved": "All rights reserved",
}
_SEP = separators(keep_alnum_only=True)


def signature(windows: np.ndarray, salts: np.ndarray) -> np.ndarray:
    """Minima (rows x salts) of a matrix of shingle hashes; 0 marks an empty place."""
    empty = windows == 0
    out = np.empty((len(windows), len(salts)), dtype=np.uint64)
    for k, salt in enumerate(salts):
        hashed = mix(windows ^ salt)
        hashed[empty] = np.uint64(0xFFFFFFFFFFFFFFFF)
        out[:, k] = hashed.min(axis=1)
    return out


def bands_of(sig: np.ndarray) -> np.ndarray:
    part = sig.reshape(len(sig), BANDS, ROWS)
    key = part[:, :, 0]
    for r in range(1, ROWS):
        key = mix(key * np.uint64(3) + part[:, :, r])
    return mix(key + stream(62, BANDS)[None, :])        # bands apart: equal keys are of one band


class Group:
    """Templates of one window shape: their shingles, and a dictionary from band key to templates."""

    def __init__(self, size: int, m: int, members: list[tuple[str, np.ndarray]], salts: np.ndarray):
        self.size, self.m, self.names = size, m, [n for n, _ in members]
        self.items = [items for _, items in members]
        self.step = max(1, m // 4)
        self.width = m + self.step - 1
        widest = max(map(len, self.items))
        grid = np.zeros((len(members), widest), dtype=np.uint64)
        for k, items in enumerate(self.items):
            grid[k, :len(items)] = items
        keys = bands_of(signature(grid, salts)).ravel()
        order = np.argsort(keys, kind="stable")
        self.keys, self.owners = keys[order], (order // BANDS).astype(np.int64)

    def retrieve(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, template) pairs that share a band, each once; by template."""
        flat = keys.ravel()
        lo, hi = np.searchsorted(self.keys, flat, "left"), np.searchsorted(self.keys, flat, "right")
        found = np.flatnonzero(hi > lo)
        n = (hi - lo)[found]
        at = np.repeat(lo[found] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        pairs = np.unique(self.owners[at] * len(keys) + np.repeat(found // BANDS, n))
        return pairs % len(keys), pairs // len(keys)


class Templates:
    """Templates grouped by shingle size and window shape; shingles lead to the groups that have them."""

    def __init__(self, texts: dict[str, str] | list[tuple[str, str]]):
        listed = sorted(texts.items()) if isinstance(texts, dict) else sorted(set(texts))
        if len(listed) > MAX_TEMPLATES:
            raise ValueError(f"at most {MAX_TEMPLATES} templates")
        if sum(len(t.encode()) for _, t in listed) > MAX_BYTES:
            raise ValueError(f"at most {MAX_BYTES} bytes of templates")
        self.salts = stream(61, BANDS * ROWS)
        shapes: dict[tuple[int, int], list] = {}
        for name, text in listed:
            w = words(pa.array([text]), fold=True, sep=_SEP)
            if len(w.hash):
                size = min(SHINGLE, len(w.hash))
                items = np.unique(grams(w.hash, w.row, size)[0])
                shapes.setdefault((size, len(w.hash) - size + 1), []).append((name, items))
        self.groups = [Group(size, m, members, self.salts) for (size, m), members in sorted(shapes.items())]
        # per shingle size: sorted (shingle, group) pairs
        self.sizes = {}
        for size in {g.size for g in self.groups}:
            mine = [(i, np.unique(np.concatenate(g.items))) for i, g in enumerate(self.groups) if g.size == size]
            shingle = np.concatenate([u for _, u in mine])
            group = np.concatenate([np.full(len(u), i) for i, u in mine])
            order = np.argsort(shingle, kind="stable")
            self.sizes[size] = shingle[order], group[order]

    def touched(self, size: int, g: np.ndarray, ok: np.ndarray) -> dict[int, np.ndarray]:
        """Group -> positions of shingles that one of its templates has."""
        shingle, group = self.sizes[size]
        lo = np.searchsorted(shingle, g, "left")
        hit = np.flatnonzero(ok & (shingle[np.minimum(lo, len(shingle) - 1)] == g))
        lo, hi = lo[hit], np.searchsorted(shingle, g[hit], "right")
        n = hi - lo
        at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
        where, which = np.repeat(hit, n), group[at]
        order = np.argsort(which, kind="stable")
        names, begin = np.unique(which[order], return_index=True)
        return dict(zip(names.tolist(), np.split(where[order], begin[1:])))


def _scan(texts: dict[str, str] | list[tuple[str, str]], threshold: float, keep: list[str]):
    templates = Templates(texts)

    def windows(w, group: Group, hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Window starts, multiples of the step from the row's start, that cover a hit; and the
        end of each row's shingles."""
        row = w.row[hit]
        lo = w.first[row]
        newest = (hit - lo) // group.step
        back = newest[:, None] - np.arange((group.width + group.step - 1) // group.step)
        start = back * group.step + lo[:, None]
        pick = np.unique(start[(back >= 0) & (start + group.width > hit[:, None])])
        return pick, w.first[w.row[pick] + 1] - group.size + 1

    def matches(w) -> list[tuple]:
        """(row, template, first word, words, share) of every verified window."""
        found = []
        for size in templates.sizes:
            g, ok = grams(w.hash, w.row, size)
            if not len(g):
                continue
            for number, hit in templates.touched(size, g, ok).items():
                group = templates.groups[number]
                pick, stop = windows(w, group, hit)
                block = max(1, min(2048, (1 << 20) // group.width))
                for a in range(0, len(pick), block):
                    some, end = pick[a:a + block], stop[a:a + block]
                    at = some[:, None] + np.arange(group.width)
                    grid = np.where(at < end[:, None], g[np.minimum(at, len(g) - 1)], np.uint64(0))
                    window, template = group.retrieve(bands_of(signature(grid, templates.salts)))
                    for t in np.unique(template):
                        near, items = window[template == t], group.items[t]
                        inside = np.sort(np.where(np.isin(grid[near], items), grid[near], np.uint64(0)), axis=1)
                        distinct = ((np.diff(inside, axis=1) != 0).sum(axis=1) + 1
                                    - (inside[:, 0] == 0)).astype(float)
                        share = distinct / len(items)
                        for k in np.flatnonzero(share >= threshold):
                            first = int(some[near[k]])
                            n = int(min(group.width, end[near[k]] - first)) + size - 1
                            r = int(w.row[first])
                            found.append((r, group.names[t], first - int(w.first[r]), n, float(share[k])))
        return found

    def of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in slices(batch):
            w = words(part.column("text"), fold=True, sep=_SEP)
            best: list[tuple] = []
            reach = -1
            for x in sorted(matches(w)):
                if best and best[-1][:2] == x[:2] and x[2] < reach:
                    reach = max(reach, x[2] + x[3])
                    if x[4] > best[-1][4]:
                        best[-1] = x
                else:
                    best.append(x)
                    reach = x[2] + x[3]
            if best:
                rows, names, start, size, share = zip(*best)
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(k).take(pa.array(rows)) for k in keep], pa.array(names),
                     pa.array(start, pa.int64()), pa.array(size, pa.int64()), pa.array(share)],
                    [*keep, "license", "start_word", "n_words", "containment"])

    return of


def _listed(templates: DataFrame, name_col: str, text_col: str) -> list[tuple[str, str]]:
    """A table of templates, after its size is checked."""
    rows = templates.where(F.col(name_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(name_col).alias("name"), F.col(text_col).alias("text")).distinct()
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("b")).first()
    if size["n"] > MAX_TEMPLATES or (size["b"] or 0) > MAX_BYTES:
        raise ValueError(f"at most {MAX_TEMPLATES} templates of {MAX_BYTES} bytes in all")
    return [(r["name"], r["text"]) for r in rows.collect()]


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  templates: dict[str, str] | DataFrame | None = None, threshold: float = THRESHOLD,
                  name_col: str = "license", template_col: str = "text") -> DataFrame:
    """(``doc_id``, ``license``, ``start_word``, ``n_words``, ``containment``): one row per match.

    ``templates``: texts by name, or a table of ``name_col`` and ``template_col``.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    texts = _listed(templates, name_col, template_col) if isinstance(templates, DataFrame) else templates or TEMPLATES
    return arrow_map(source, _scan(texts, threshold, ["doc_id"]),
                     f"doc_id {kind}, license string, start_word long, n_words long, containment double")
