"""Line dedup against a plain scan of all windows in order."""

from llm_cases import corpus, empty, frame
from starmart.llm.line_dedup import dedup_lines

SPACE = " \t\n\x0b\x0c\r"


def brute(rows):
    """(doc_id, text) -> text left; rows that repeat exactly count once."""
    unique = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0))
    filled = {r: [(i, x.strip(SPACE)) for i, x in enumerate((r[1] or "").split("\n")) if x.strip(SPACE)]
              for r in unique}
    first = {}
    for r in unique:
        for p in range(len(filled[r]) - 2):
            key = tuple(t for _, t in filled[r][p:p + 3])
            first.setdefault(key, (r, p))
    left = {}
    for r in unique:
        gone = set()
        for p in range(len(filled[r]) - 2):
            if first[tuple(t for _, t in filled[r][p:p + 3])] != (r, p):
                gone |= {i for i, _ in filled[r][p:p + 3]}
        lines = (r[1] or "").split("\n")
        left[r] = (None if r[1] is None else "\n".join(x for i, x in enumerate(lines) if i not in gone), len(gone))
    return left


def rows_with_lines():
    rows = [r for r in corpus() if r[0] is not None]
    a, b, c, d = "alpha one", "  beta two ", "gamma three", "delta four"
    rows += [(1001, "\n".join([a, b, c, d])), (1002, "\n".join(["x", a, "", b.strip(), c, "y"])),
             (1003, "\n".join([b, c, d, a, b, c, d])), (1004, "\n".join([a, b])), (1005, "\n\n\n"),
             (1006, "\n".join(["same"] * 6)), (1007, "\n".join([d, c, b]))]
    return rows


def test_matches_a_plain_scan(spark):
    rows = rows_with_lines()
    got = dedup_lines(frame(spark, rows))
    assert got.count() == len(rows)
    want = brute(rows)
    for r in got.collect():
        key = next(k for k in want if k[0] == r.doc.doc_id and brute_key(k, r, want))
        assert (r.doc.text, r.n_removed) == want[key]
        assert r.doc.key == "clash" and r.doc.gone == "clash"


def brute_key(key, row, want):
    """The input row of an output row: same id and number of lines."""
    n = 0 if key[1] is None else len(key[1].split("\n"))
    return n == row.n_lines and want[key][1] == row.n_removed


def test_null_ids_and_empty_tables(spark):
    text = "l1\nl2\nl3\nl4"
    got = {(r.doc.doc_id, r.doc.text) for r in
           dedup_lines(frame(spark, [(5, text), (None, text), (None, None), (6, text)])).collect()}
    assert got == {(None, text), (None, None), (5, ""), (6, "")}  # a null id comes first
    assert dedup_lines(empty(spark)).count() == 0
