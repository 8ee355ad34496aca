"""DuckDB SQL for the operators that SQL can express, written from their contracts.

Packing, the license scan, the two classifiers and the fingerprints have no SQL form (token
ids, templates, trained tables, hashed vectors); they are tested against brute force instead.
"""

from __future__ import annotations

_SEP = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]+"
_WORDS = f"regexp_extract_all(coalesce(text, ''), '{_WORD}')"

LINE_DEDUP = rf"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i
  FROM documents WHERE text IS NOT NULL),
filled AS (
  SELECT doc_id, i, t, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS p
  FROM (SELECT doc_id, i, regexp_replace(line, '^{_SEP}+|{_SEP}+$', '', 'g') AS t FROM lines)
  WHERE t <> ''),
windows AS (
  SELECT a.doc_id, a.p, a.i AS i0, b.i AS i1, c.i AS i2,
         row_number() OVER (PARTITION BY a.t, b.t, c.t ORDER BY a.doc_id, a.p) AS occurrence
  FROM filled a JOIN filled b ON a.doc_id = b.doc_id AND b.p = a.p + 1
  JOIN filled c ON a.doc_id = c.doc_id AND c.p = a.p + 2),
gone AS (SELECT DISTINCT doc_id, unnest([i0, i1, i2]) AS i FROM windows WHERE occurrence > 1),
marked AS (SELECT l.*, g.i IS NOT NULL AS drop FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.i = g.i),
per_doc AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE drop) AS n_removed,
         string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT drop) AS kept
  FROM marked GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n_lines, 0) AS INTEGER) AS n_lines,
       CAST(coalesce(n_removed, 0) AS INTEGER) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN per_doc p ON d.doc_id = p.doc_id"""

SUBSTRING_DEDUP = f"""
WITH w AS (SELECT doc_id, {_WORDS} AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM w WHERE len(w) >= 50),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS t FROM starts),
firsts AS (SELECT *, min(doc_id) OVER (PARTITION BY t) AS lo FROM windows),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM firsts WHERE lo < doc_id),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM w),
kept AS (
  SELECT a.doc_id, count(g.i) AS n_removed,
         string_agg(a.word, ' ' ORDER BY a.i) FILTER (WHERE g.i IS NULL) AS kept
  FROM words a LEFT JOIN gone g ON a.doc_id = g.doc_id AND a.i = g.i GROUP BY a.doc_id)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept k ON w.doc_id = k.doc_id"""

# Every word of a window that a smaller document holds; spans are the runs of such words.
REPEATED_PASSAGES = f"""
WITH w AS (SELECT doc_id, {_WORDS} AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM w WHERE len(w) >= 50),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS t FROM starts),
firsts AS (SELECT *, min(doc_id) OVER (PARTITION BY t) AS lo FROM windows),
covered AS (
  SELECT doc_id, k, min(lo) AS lo FROM (SELECT doc_id, unnest(range(i, i + 50)) AS k, lo FROM firsts WHERE lo < doc_id)
  GROUP BY doc_id, k),
runs AS (SELECT *, k - row_number() OVER (PARTITION BY doc_id ORDER BY k) AS run FROM covered)
SELECT doc_id, CAST(min(k) - 1 AS INTEGER) AS start, CAST(count(*) AS INTEGER) AS length, min(lo) AS first_doc_id
FROM runs GROUP BY doc_id, run"""

NEAR_DEDUP = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, w[i] || ' ' || w[i + 1] AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM w WHERE len(w) >= 2)
  UNION ALL SELECT doc_id, w[1] FROM w WHERE len(w) = 1),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * k >= 80 * (x.n + y.n - k)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN both_ways l ON r.other = l.a),
groups AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT g.doc_id, coalesce(n, 0) AS n_shingles, component_id, g.doc_id = component_id AS kept
FROM groups g LEFT JOIN sizes s ON g.doc_id = s.doc_id"""

_RULES = {
    "symbols": "1000 * n_symbols // greatest(n_words, 1)",
    "dup_lines": "1000 * n_dup_lines // greatest(n_lines, 1)",
    "repeats": "1000 * n_repeat_words // greatest(n_words, 1)",
    "capitals": "1000 * n_capitals // greatest(word_chars, 1)",
    "shouts": "1000 * n_shouts // greatest(n_words, 1)",
    "word_length": "1000 * word_chars // greatest(n_words, 1)",
}
# rule -> (least room over the high quantile, room as a multiple of it, greatest rate)
_ROOMS = {"symbols": (99, None, None), "dup_lines": (499, None, 1000), "repeats": (59, None, 1000),
          "capitals": (None, 7, 1000), "shouts": (299, None, None), "word_length": (None, 1.5, None)}


def _blend(name: str, keys: str, above: str, parent: str) -> str:
    """Sketch ``name`` of the groups ``keys``: their own counts, and their parent's as 100 documents."""
    group = f"{keys}, rule" if keys else "rule"
    own = f"SELECT {group}, bucket, CAST(count(*) AS DOUBLE) AS w FROM rates WHERE n_words > 0 GROUP BY {group}, bucket"
    if parent:
        same = " AND ".join(f"c.{k} IS NOT DISTINCT FROM p.{k}" for k in [*filter(None, above.split(", ")), "rule"])
        listed = ", ".join(f"c.{k}" for k in group.split(", "))
        own = f"""SELECT {group}, bucket, sum(w) AS w FROM (
    {own}
    UNION ALL
    SELECT {listed}, p.bucket, 100.0 * p.w / p.total
    FROM (SELECT DISTINCT {group} FROM rates WHERE n_words > 0) c JOIN {parent} p ON {same})
  GROUP BY {group}, bucket"""
    return f"""
{name}_w AS ({own}),
{name} AS (
  SELECT *, max(upto) OVER (PARTITION BY {group}) AS total,
         coalesce(max(w) FILTER (WHERE bucket = 0) OVER (PARTITION BY {group}), 0) AS zero
  FROM (SELECT *, sum(w) OVER (PARTITION BY {group} ORDER BY bucket ROWS UNBOUNDED PRECEDING) AS upto
        FROM {name}_w))"""


def _bad(rule: str) -> str:
    fixed, part, most = _ROOMS[rule]
    high = "exp((hi + 1) / 50.0)"
    room = (f"{part} * {high}" if part else
            f"greatest({fixed} * exp(0.02), 5 * ({high} - exp(lo / 50.0)), coalesce(0.5 * exp(nz / 50.0) - {high}, 0))")
    if most:
        room = f"least({room}, 0.51 * ({most + 1} - {high}))"
    low = " OR rate + 1 < exp(lo / 50.0) / 2.5" if rule == "word_length" else ""
    return f"WHEN '{rule}' THEN rate + 1 > {high} + {room}{low}"


QUALITY_RULES = f"""
WITH base AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM base)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
threes AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS often
  FROM (SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM base WHERE len(w) >= 3))),
repeats AS (
  SELECT doc_id, count(DISTINCT k) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS k FROM threes WHERE often > 1) GROUP BY doc_id),
measures AS (
  SELECT b.doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words,
         CAST(len(regexp_extract_all(text, '\\p{{Lu}}')) AS BIGINT) AS n_capitals,
         CAST(len(regexp_extract_all(text, '!')) AS BIGINT) AS n_shouts
  FROM base b LEFT JOIN lines l ON b.doc_id = l.doc_id LEFT JOIN repeats r ON b.doc_id = r.doc_id),
rates AS (
  SELECT *, CAST(floor(ln(rate + 1) * 50) AS BIGINT) AS bucket FROM (
    {" UNION ALL ".join(f"SELECT doc_id, lang, source, n_words, '{r}' AS rule, {e} AS rate FROM measures"
                        for r, e in _RULES.items())})),
{_blend("by_all", "", "", "")},
{_blend("by_lang", "lang", "", "by_all")},
{_blend("by_source", "lang, source", "lang", "by_lang")},
limits AS (
  SELECT lang, source, rule, min(bucket) FILTER (WHERE upto >= 0.7 * total - 1e-9 * total) AS hi,
         min(bucket) FILTER (WHERE upto >= 0.3 * total - 1e-9 * total) AS lo,
         min(bucket) FILTER (WHERE bucket > 0 AND total - zero > 1e-9 * total
                             AND upto - zero >= 0.1 * (total - zero) - 1e-9 * total) AS nz
  FROM by_source GROUP BY lang, source, rule),
failed AS (
  SELECT doc_id, r.rule, CASE r.rule {" ".join(_bad(r) for r in _RULES)} END AS bad
  FROM rates r LEFT JOIN limits s ON r.lang IS NOT DISTINCT FROM s.lang AND r.source IS NOT DISTINCT FROM s.source
       AND r.rule = s.rule),
verdicts AS (
  SELECT doc_id, {", ".join(f"max(CAST(rule = '{r}' AND bad AS INTEGER)) AS f_{r}" for r in _RULES)}
  FROM failed GROUP BY doc_id),
joined AS (
  SELECT m.*, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         concat_ws(',', {", ".join(f"CASE WHEN f_{r} = 1 THEN '{r}' END" for r in _RULES)}) AS failed_rules
  FROM measures m JOIN verdicts v ON m.doc_id = v.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, failed_rules,
       NOT base_failed AND failed_rules = '' AS kept
FROM joined"""


def _seeded(seed: int, *parts: str) -> str:
    text = " || '|' || ".join([f"'{seed}'", *[f"coalesce(CAST({p} AS VARCHAR), 'null')" for p in parts]])
    return f"CAST('0x' || substr(md5({text}), 1, 12) AS BIGINT)"


MIXING = f"""
WITH sized AS (
  SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size, text FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS place
  FROM sized GROUP BY source),
weighted AS (SELECT *, [5, 2, 1][place % 3 + 1] AS w, 3 * source_size AS top FROM sources),
levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(top) OVER before, 0)) AS words_left,
         (sum(w) OVER () - coalesce(sum(w) OVER before, 0)) AS w_left
  FROM weighted
  WINDOW before AS (ORDER BY top / w, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
shares AS (
  SELECT max(CAST(words_left AS DOUBLE) / w_left)
           FILTER (WHERE CAST(words_left AS DOUBLE) / w_left <= top / w) AS unit FROM levels),
goals AS (
  SELECT source, source_size, place, least(CAST(top AS DOUBLE), unit * w) AS target,
         CAST(floor(sum(source_size) OVER () / 16 + 0.5) AS BIGINT) AS blocks,
         CAST(greatest(ceil(sqrt(source_size) / 50), 1) AS BIGINT) AS shards
  FROM weighted, shares),
source_tries AS (
  SELECT place, blocks, row_number() OVER (ORDER BY target / (2 * s + 1) DESC, place, s) AS turn
  FROM (SELECT *, unnest(range(CAST(target / 16 AS BIGINT) + 2 * (SELECT count(*) FROM goals) + 3)) AS s FROM goals)),
quotas AS (SELECT place, count(*) FILTER (WHERE turn <= blocks) AS quota FROM source_tries GROUP BY place),
dealt AS (
  SELECT d.doc_id, d.source, d.size, g.place, g.source_size, g.target, q.quota,
         {_seeded(9, "d.doc_id")} % g.shards AS shard
  FROM sized d JOIN goals g ON d.source IS NOT DISTINCT FROM g.source JOIN quotas q ON q.place = g.place),
shards AS (SELECT place, shard, quota, CAST(sum(size) AS BIGINT) AS shard_size FROM dealt GROUP BY ALL),
shard_tries AS (
  SELECT place, shard, quota,
         row_number() OVER (PARTITION BY place ORDER BY shard_size / (2 * s + 1) DESC, shard, s) AS turn
  FROM (SELECT *, unnest(range(quota + 1)) AS s FROM shards)),
won AS (SELECT place, shard, count(*) FILTER (WHERE turn <= quota) AS won FROM shard_tries GROUP BY place, shard),
parts AS (
  SELECT s.place, s.shard, shard_size, least(won * 16, 3 * shard_size) AS words,
         ({_seeded(10, "s.place", "s.shard")} % CAST(greatest(ceil(shard_size / 16), 1) AS BIGINT)) * 16 AS first
  FROM shards s JOIN won w ON s.place = w.place AND s.shard = w.shard),
laid AS (
  SELECT d.*, p.shard_size, p.first, p.words // greatest(p.shard_size, 1) AS passes,
         p.words % greatest(p.shard_size, 1) AS rest,
         CAST(sum(d.size) OVER (PARTITION BY d.place, d.shard ORDER BY {_seeded(11, "d.doc_id")}, d.doc_id, d.size
              ROWS UNBOUNDED PRECEDING) AS BIGINT) AS stop
  FROM dealt d JOIN parts p ON d.place = p.place AND d.shard = p.shard)
SELECT doc_id, source, size, source_size, target,
       CAST(passes * size
            + greatest(0, least(stop, least(first + rest, shard_size)) - greatest(stop - size, first))
            + greatest(0, least(stop, first + rest - shard_size) - greatest(stop - size, 0)) AS BIGINT) AS taken
FROM laid"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _terms(column: str) -> str:
    return (f"regexp_extract_all(translate(coalesce({column}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
            f"'abcdefghijklmnopqrstuvwxyz'), '{_TERM}')")


LEXICAL_SEARCH = f"""
WITH d AS (SELECT doc_id, {_terms("text")} AS t FROM documents),
corpus AS (SELECT CAST(count(*) FILTER (WHERE len(t) > 0) AS BIGINT) AS n_docs,
                  CAST(sum(len(t)) AS BIGINT) AS n_terms FROM d),
asked AS (SELECT DISTINCT item_id, unnest({_terms("text")}) AS term FROM benchmark),
tf AS (
  SELECT doc_id, n, term, count(*) AS tf
  FROM (SELECT doc_id, CAST(len(t) AS BIGINT) AS n, unnest(t) AS term FROM d)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), corpus),
parts AS (
  SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))) AS part
  FROM tf JOIN weights USING (term), corpus),
scores AS (
  SELECT item_id, doc_id, CAST(sum(part) AS BIGINT) AS score FROM asked JOIN parts USING (term)
  GROUP BY item_id, doc_id HAVING sum(part) > 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS r FROM scores)
SELECT item_id, CAST(r AS INTEGER) AS rank, doc_id, score FROM ranked WHERE r <= 10"""

# The damage needs a CRC-32, made here from its table. The search goes row by row through each
# conversation and keeps, for every state, the cheapest edits so far, of equal ones the least in
# ASCII: two prefixes that reach one state at one cost differ before either ends.
CONVERSATION_REPAIR = r"""
WITH RECURSIVE bits(i, k, v) AS (
  SELECT i, 0, i FROM range(256) r(i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE k < 8),
crc AS (SELECT list(v ORDER BY i) AS t FROM bits WHERE k = 8),
named AS (
  SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name,
         coalesce(role, ' ') AS r, coalesce(text, ' ') AS x FROM conversations),
kinds AS (
  SELECT conv_id, turn, r, x,
         xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(name, ''),
                                      lambda c: CAST(ord(c) AS BIGINT))),
                         lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 20 AS kind
  FROM named, crc),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE r END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(x, '[.!?]', '', 'g') ELSE x END AS text,
         unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM kinds WHERE kind <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS n,
         NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank
  FROM damaged),
rows AS (
  SELECT *, left(role, 1) AS ini, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY n) || left(role, 1) AS pair,
         NOT blank AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 AS duplicate,
         NOT blank AND regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) NOT IN ('.', '!', '?') AS open
  FROM placed),
faults AS (
  SELECT conv_id, count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE duplicate) AS duplicate,
         count(*) FILTER (WHERE open AND NOT duplicate) AS truncated,
         count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal,
         coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, max(n) AS size
  FROM rows GROUP BY conv_id),
inserts(state, reached, price, letters, lines) AS (
  VALUES ('', '', 0, '', CAST([] AS VARCHAR[])), ('', 'u', 5, 'I', ['user:']), ('', 'a', 10, 'II', ['user:', 'assistant:']),
         ('s', 's', 0, '', []), ('s', 'u', 5, 'I', ['user:']), ('s', 'a', 10, 'II', ['user:', 'assistant:']),
         ('u', 'u', 0, '', []), ('u', 'a', 5, 'I', ['assistant:']),
         ('a', 'a', 0, '', []), ('a', 'u', 5, 'I', ['user:'])),
next_role(state, ini, name) AS (VALUES ('', 'u', 'user'), ('s', 'u', 'user'), ('u', 'a', 'assistant'), ('a', 'u', 'user')),
legal(state, ini) AS (VALUES ('', 's'), ('', 'u'), ('s', 'u'), ('u', 'a'), ('a', 'u')),
best(conv_id, n, state, cost, audit, lines) AS (
  SELECT conv_id, CAST(0 AS BIGINT), '', CAST(0 AS BIGINT), '', CAST([] AS VARCHAR[]) FROM faults
  UNION ALL
  SELECT conv_id, n, state, cost, audit, lines FROM (
    SELECT *, row_number() OVER (PARTITION BY conv_id, state ORDER BY cost, audit) AS place FROM (
      SELECT b.conv_id, r.n, e.state, CAST(b.cost + i.price + e.price AS BIGINT) AS cost,
             b.audit || i.letters || e.letter AS audit, list_concat(list_concat(b.lines, i.lines), e.lines) AS lines
      FROM best b JOIN inserts i ON i.state = b.state
      JOIN rows r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.n = b.n + 1
      CROSS JOIN LATERAL (
        SELECT i.reached AS state, 2 AS price, 'D' AS letter, CAST([] AS VARCHAR[]) AS lines
        UNION ALL
        SELECT r.ini, CASE WHEN r.open THEN 5 ELSE 0 END, 'K', [r.role || ':' || r.text]
        FROM legal l WHERE l.state = i.reached AND l.ini = r.ini AND NOT r.blank AND NOT r.duplicate
        UNION ALL
        SELECT m.ini, 1 + CASE WHEN r.open THEN 5 ELSE 0 END, 'R', [m.name || ':' || r.text]
        FROM next_role m WHERE m.state = i.reached AND NOT r.blank AND NOT r.duplicate) e))
  WHERE place = 1),
ended AS (
  SELECT b.conv_id, b.cost + i.price AS cost, b.audit || i.letters AS audit, list_concat(b.lines, i.lines) AS lines,
         row_number() OVER (PARTITION BY b.conv_id ORDER BY b.cost + i.price, b.audit || i.letters) AS place
  FROM best b JOIN faults f ON f.conv_id IS NOT DISTINCT FROM b.conv_id AND f.size = b.n
  JOIN inserts i ON i.state = b.state WHERE i.reached IN ('', 'a'))
SELECT c.conv_id, CAST(coalesce(f.gaps, 0) AS BIGINT) AS gaps, coalesce(f.blank, 0) AS blank,
       coalesce(f.duplicate, 0) AS duplicate, coalesce(f.truncated, 0) AS truncated, coalesce(f.illegal, 0) AS illegal,
       CAST(coalesce(e.cost, 0) AS BIGINT) AS cost, coalesce(e.audit, '') AS audit,
       sha256(coalesce(array_to_string(e.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM c.conv_id AND e.place = 1"""

SQL: dict[str, str] = {
    "op3_quality_rules": QUALITY_RULES,
    "op4_line_dedup": LINE_DEDUP,
    "op5_suffix_dedup": REPEATED_PASSAGES,
    "op8_near_dedup": NEAR_DEDUP,
    "op9_mix": MIXING,
    "op10_substring_dedup": SUBSTRING_DEDUP,
    "op11_lexical_search": LEXICAL_SEARCH,
    "op12_conversation_repair": CONVERSATION_REPAIR,
}
