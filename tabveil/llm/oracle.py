"""DuckDB SQL for the queries of this package, written apart from their Spark code."""

from __future__ import annotations

from tabveil.llm.license_scan import KNOWN, SPELLINGS, published_texts
from tabveil.llm.quality_rules import CUTOFFS, ERROR, RISK

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _parts(kind: str, place: int, pattern: str, least: int, value: str) -> str:
    return f"""
SELECT rid, {place} AS place, '{kind}' AS kind, s, e FROM (
  SELECT rid, i, part, sum(length(part)) OVER (PARTITION BY rid ORDER BY i) AS e,
         sum(length(part)) OVER (PARTITION BY rid ORDER BY i) - length(part) AS s
  FROM (SELECT rid, unnest(parts) AS part, generate_subscripts(parts, 1) AS i FROM (
    SELECT rid, string_split(regexp_replace(t, {pattern}, chr(1) || '\\0' || chr(1), 'g'), chr(1)) AS parts FROM d))
) WHERE i % 2 = 0 AND length({value}) >= {least}"""


_ASSIGN = (
    """'([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"""
    """|[aA][pP][iI]_?[kK][eE][yY])["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)'"""
)
SECRETS = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, translate(coalesce(text, ''), chr(1), chr(2)) AS t FROM documents),
f AS ({_parts("assign", 0, _ASSIGN, 6, f"regexp_extract(part, {_ASSIGN}, 2)")}
UNION ALL {_parts("access", 1, "'AKIA[A-Z0-9]+'", 20, "part")}
UNION ALL {_parts("hex", 2, "'[0-9a-f]+'", 24, "part")}
UNION ALL {_parts("pem", 3, "'-----BEGIN [A-Z ]*PRIVATE KEY-----'", 1, "part")}
UNION ALL {_parts("jwt", 4, "'eyJ[A-Za-z0-9_-]+\\.eyJ[A-Za-z0-9_-]+\\.[A-Za-z0-9_-]+'", 1, "part")}),
g AS (SELECT rid, count(*) FILTER (place = 0) AS a, count(*) FILTER (place = 1) AS c, count(*) FILTER (place = 2) AS h,
  string_agg(kind || ':' || s::BIGINT || ':' || e::BIGINT, ',' ORDER BY s, place) FILTER (place < 3) AS base,
  string_agg(kind || ':' || s::BIGINT || ':' || e::BIGINT, ',' ORDER BY s, place) AS spans FROM f GROUP BY rid)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(c, 0) AS n_access, coalesce(h, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (rid)"""

_VALUES = {
    "symbols": "n_symbols / greatest(n_words, 1)", "copied_lines": "n_dup_lines / greatest(n_lines, 1)",
    "repeated_words": "n_repeat_words / greatest(n_words, 1)", "word_length": "word_chars / greatest(n_words, 1)",
}
_RATE = RISK / len(CUTOFFS)
_GRID = ", ".join(
    f"{{'lang': lang, 'rule': '{rule}', 'cutoff': {c}::DOUBLE, 'value': {_VALUES[rule]}}}" for rule, cuts in CUTOFFS.items() for c in cuts
)
_TESTS = sum(len(c) for c in CUTOFFS.values())
QUALITY = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(lang, chr(0) || 'null') AS lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, list_filter(string_split_regex(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM d),
win AS (SELECT rid, unnest(list_transform(range(1, len(ws) - 1), lambda i: [ws[i], ws[i + 1], ws[i + 2]])) AS g,
        unnest(range(1, len(ws) - 1)) AS i FROM w),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM win) WHERE n > 1),
rep AS (SELECT rid, count(DISTINCT i + d) AS n FROM twice, (VALUES (0), (1), (2)) AS v(d) GROUP BY rid),
ln AS (SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup FROM (
  SELECT rid, unnest(string_split(t, chr(10))) AS l FROM d) WHERE length(regexp_replace(l, '[\\x20\\x09-\\x0D]', '', 'g')) > 0 GROUP BY rid),
m AS (SELECT d.rid, doc_id, lang, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
  (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols, coalesce(n_dup, 0)::BIGINT AS n_dup_lines,
  coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM d JOIN w USING (rid) LEFT JOIN ln USING (rid) LEFT JOIN rep USING (rid)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
good AS (SELECT doc_id FROM labels WHERE quality IS NOT NULL AND doc_id IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1),
hold AS (SELECT t.* FROM (SELECT unnest([{_GRID}]) AS t FROM b SEMI JOIN good USING (doc_id) WHERE NOT base_failed)),
holdn(lang, rule, cutoff, value) AS (SELECT * FROM hold),
cnt AS (SELECT lang, rule, cutoff, count(*) AS n, count(*) FILTER (value > cutoff) AS r FROM holdn GROUP BY ALL),
tests AS (SELECT count(DISTINCT lang) * {_TESTS} AS k FROM cnt),
adm AS (SELECT lang, rule, cutoff FROM cnt, tests WHERE r < n * {_RATE!r}::DOUBLE AND
  list_sum(list_transform(range(0, r + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)
  + i * ln({_RATE!r}::DOUBLE) + (n - i) * ln(1 - {_RATE!r}::DOUBLE)))) <= {ERROR!r}::DOUBLE / k),
lim AS (SELECT lang, rule, min(cutoff) AS cutoff FROM adm GROUP BY ALL),
limits AS (SELECT lang, {", ".join(f"min(cutoff) FILTER (rule = '{r}') AS most_{r}" for r in CUTOFFS)} FROM lim GROUP BY lang)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT ({" OR ".join(f"coalesce({v} > most_{r}, false)" for r, v in _VALUES.items())}) AS kept
FROM b LEFT JOIN limits USING (lang)"""


def _canonical(column: str) -> str:
    made = (
        f"regexp_replace(lower({column}), '(?m)^[ \\t]*(?:copyright[ \\t]+(?:\\(c\\)|©|[0-9])|\\(c\\)|©)[^\\n]*$', ' ', 'g')"
    )
    made = f"trim(regexp_replace({made}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+', ' ', 'g'))"
    for one, other in SPELLINGS:
        made = f"regexp_replace(({made}), '\\b{one}\\b', '{other}', 'g')"
    return f"({made})"


_KNOWN = ", ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in KNOWN + published_texts())
LICENCES = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
k AS (SELECT c, min(n) AS n FROM (SELECT n, {_canonical("t")} AS c FROM (VALUES {_KNOWN}) AS v(n, t)) WHERE c <> '' GROUP BY c),
w AS (SELECT rid, doc_id, {_canonical("t")} AS c FROM d),
l AS (SELECT rid, {_canonical("line")} AS c FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d)),
h AS (SELECT rid, string_agg(DISTINCT n, ',' ORDER BY n) AS notices, count(*) AS n_notice_lines FROM l JOIN k USING (c) GROUP BY rid)
SELECT doc_id, CASE WHEN w.c <> '' THEN sha256(w.c) END AS digest, k.n AS text_license,
  coalesce(notices, '') AS notices, coalesce(n_notice_lines, 0) AS n_notice_lines
FROM w LEFT JOIN k ON w.c = k.c AND w.c <> '' LEFT JOIN h USING (rid)"""

_WORDS = f"list_filter(string_split_regex({LOWER}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"
LEAKS = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
it AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, g, len(g) AS n FROM (
  SELECT item_id, unnest(list_transform(range(1, len(w) - least(10, len(w)) + 2), lambda i: w[i:i + least(10, len(w)) - 1])) AS g
  FROM it WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT rid, n, unnest(range(1, len(w) - n + 2)) AS i, unnest(list_transform(range(1, len(w) - n + 2), lambda i: w[i:i + n - 1])) AS g
  FROM d, sizes WHERE len(w) >= n),
hit AS (SELECT rid, i, dw.n, item_id FROM dw JOIN iw ON dw.g = iw.g),
words AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT rid, i, n FROM hit)) GROUP BY rid),
ids AS (SELECT rid, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT rid, item_id::VARCHAR AS id FROM hit) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN ids USING (rid)"""


def _base32(hexed: str) -> str:
    """Base 32 of 40 hex digits: every 5 digits are 4 letters."""
    letters = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"
    value = f"('0x' || substr({hexed}, 5 * i + 1, 5))::BIGINT"
    return "list_aggregate(list_transform(range(8), lambda i: " + " || ".join(
        f"substr({letters}, 1 + (({value} // {32 ** k}) % 32)::INTEGER, 1)" for k in (3, 2, 1, 0)
    ) + "), 'string_agg', '')"


ARCHIVES = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
m AS (SELECT h, max(page_id) AS last FROM p GROUP BY h)
SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes, {_base32("sha1(h)")} AS payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> last THEN last END AS refers_to
FROM p JOIN m USING (h)"""

_SPACED = f"list_filter(string_split_regex({LOWER}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
NEAR_COPIES = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, {_SPACED} AS w FROM documents),
s AS (SELECT rid, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w]
  ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i:i + 1])) END AS g FROM d),
e AS (SELECT rid, doc_id, len(g) AS n, hash(x) AS x FROM (SELECT rid, doc_id, g, unnest(g) AS x FROM s)),
r AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY f, x) AS i FROM (SELECT *, count(*) OVER (PARTITION BY x) AS f FROM e)),
p AS (SELECT * FROM r WHERE i <= n - (4 * n + 4) // 5 + 1),
c AS (SELECT DISTINCT a.rid AS ra, b.rid AS rb FROM p a JOIN p b ON a.x = b.x AND a.rid < b.rid AND least(a.n, b.n) * 100 >= greatest(a.n, b.n) * 80),
l AS (SELECT x.doc_id AS a, y.doc_id AS b FROM c JOIN s x ON x.rid = ra JOIN s y ON y.rid = rb
  WHERE 100 * len(list_intersect(x.g, y.g)) >= 80 * (len(x.g) + len(y.g) - len(list_intersect(x.g, y.g)))),
u AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
reach(a, b) AS (SELECT a, b FROM u UNION SELECT reach.a, u.b FROM reach JOIN u ON reach.b = u.a),
m AS (SELECT a, min(b) AS low FROM reach GROUP BY a)
SELECT doc_id, len(g)::BIGINT AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id,
  doc_id = least(doc_id, coalesce(low, doc_id)) AS kept FROM s LEFT JOIN m ON a = doc_id"""

LINES = """
WITH l AS (SELECT doc_id, unnest(x) AS line, generate_subscripts(x, 1) - 1 AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents)),
t AS (SELECT doc_id, i, list_distinct(list_filter(string_split_regex(lower(line), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')) AS w FROM l),
q AS (SELECT list_sort(w) AS w, min((doc_id, i)) AS first FROM t WHERE len(w) > 0 GROUP BY list_sort(w)),
s AS (SELECT row_number() OVER () AS sid, first[1] AS doc_id, first[2] AS i, w, len(w) AS n FROM q),
e AS (SELECT sid, n, unnest(w) AS x FROM s),
r AS (SELECT *, row_number() OVER (PARTITION BY sid ORDER BY f, x) AS k FROM (SELECT *, count(*) OVER (PARTITION BY x) AS f FROM e)),
p AS (SELECT * FROM r WHERE k <= n - (4 * n + 4) // 5 + 1),
c AS (SELECT DISTINCT a.sid AS sa, b.sid AS sb FROM p a JOIN p b ON a.x = b.x AND a.sid <> b.sid AND least(a.n, b.n) * 5 >= greatest(a.n, b.n) * 4),
near AS (SELECT DISTINCT a.doc_id, a.i FROM c JOIN s a ON a.sid = sa JOIN s b ON b.sid = sb
  WHERE (b.doc_id, b.i) < (a.doc_id, a.i) AND 5 * len(list_intersect(a.w, b.w)) >= 4 * (a.n + b.n - len(list_intersect(a.w, b.w)))),
copies AS (SELECT t.doc_id, t.i FROM t JOIN q ON list_sort(t.w) = q.w WHERE (t.doc_id, t.i) <> q.first),
gone AS (SELECT * FROM near UNION SELECT * FROM copies),
o AS (SELECT l.doc_id, count(*) AS n_lines, count(gone.i) AS n_removed,
  coalesce(string_agg(line, chr(10) ORDER BY l.i) FILTER (gone.i IS NULL), '') AS text
  FROM l LEFT JOIN gone ON l.doc_id = gone.doc_id AND l.i = gone.i GROUP BY l.doc_id)
SELECT doc_id, n_lines::INTEGER AS n_lines, n_removed::INTEGER AS n_removed, text,
  n_removed > 0 AND length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) = 0 AS emptied FROM o"""

# List slices of the lines; the two cuts and the order come from digits of a digest.
MIDDLES = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(t, '[^\\n]*\\n|[^\\n]+') AS l FROM d),
c AS (SELECT *, len(l)::BIGINT AS n, ('0x' || substr(h, 1, 8))::BIGINT % (len(l) + 1) AS x, ('0x' || substr(h, 9, 8))::BIGINT % (len(l) + 1) AS y,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain'
    WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, array_to_string(l[1:least(x, y)], '') AS pre, array_to_string(l[least(x, y) + 1:greatest(x, y)], '') AS mid,
  array_to_string(l[greatest(x, y) + 1:], '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
    ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256 FROM p"""


def _edit(key: str, cost: str, letter: str, line: str = "''") -> str:
    """A path (cost, initials, chr(1), repaired lines) with one more edit."""
    return (
        f"lpad((substr({key}, 1, 8)::BIGINT + {cost})::VARCHAR, 8, '0') || substr({key}, 9, instr({key}, chr(1)) - 9) || '{letter}' || "
        f"substr({key}, instr({key}, chr(1))) || {line}"
    )


_USER, _ASSISTANT, _SAME = "chr(10) || 'user:'", "chr(10) || 'assistant:'", "chr(10) || role || ':' || text"
_TO_USER = ("k0", "k1", "j3")


def _step(before: tuple[str, ...], initial: str, name: str | None) -> str:
    """Keeping or renaming the row after one of these states."""
    ways = [f"CASE WHEN keep AND initial = '{initial}' THEN {_edit(b, 'extra', 'K', _SAME)} END" for b in before]
    if name:
        ways += [f"CASE WHEN keep THEN {_edit(b, '1 + extra', 'R', f'{name} || text')} END" for b in before]
    return ", ".join(ways)


# States: k0 nothing yet, k1 after a system's turn, k2 after a user's, k3 after an assistant's; j: with turns inserted.
REPAIRS = f"""
WITH RECURSIVE d AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
f AS (SELECT *, xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(key) + 1), lambda i: ord(substr(key, i::INTEGER, 1))::BIGINT)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda v, k: xor(v // 2, (v % 2) * 3988292384)))) % 20 AS fault FROM d),
g AS (SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
  CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(range(CASE fault WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM f),
o AS (SELECT *, row_number() OVER w AS i, substr(role, 1, 1) AS initial,
  lag(substr(role, 1, 1)) OVER w || substr(role, 1, 1) NOT IN ('su', 'ua', 'au') AS bad,
  row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS seen,
  regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g') AS solid
  FROM g WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
q AS (SELECT *, CASE WHEN solid = '' THEN 'blank' WHEN seen THEN 'duplicate' WHEN right(solid, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS kind FROM o),
r AS (SELECT *, kind NOT IN ('blank', 'duplicate') AS keep, CASE WHEN kind = 'truncated' THEN 5 ELSE 0 END AS extra FROM q),
st AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (kind = 'blank') AS blank,
  count(*) FILTER (kind = 'duplicate') AS duplicate, count(*) FILTER (kind = 'truncated') AS truncated, count(*) FILTER (bad) AS illegal FROM r GROUP BY conv_id),
p(conv_id, i, k0, k1, k2, k3) AS (
  SELECT DISTINCT conv_id, 0::BIGINT, '00000000' || chr(1), NULL::VARCHAR, NULL::VARCHAR, NULL::VARCHAR FROM conversations
  UNION ALL
  SELECT conv_id, i, {_edit("k0", "2", "D")}, least({_edit("k1", "2", "D")}, {_step(("k0",), "s", None)}),
    least({_edit("k2", "2", "D")}, {_step(_TO_USER, "u", _USER)}), least({_edit("k3", "2", "D")}, {_step(("j2",), "a", _ASSISTANT)})
  FROM (SELECT *, least(k3, {_edit("j2", "5", "I", _ASSISTANT)}) AS j3 FROM (
    SELECT p.*exclude(i), r.*exclude(conv_id), least(k2, {", ".join(_edit(k, "5", "I", _USER) for k in ("k0", "k1", "k3"))}) AS j2
    FROM p JOIN r ON p.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = p.i + 1))),
z AS (SELECT conv_id, least(k0, k3, {_edit("j2", "5", "I", _ASSISTANT)}) AS best FROM (
  SELECT *, least(k2, {_edit("k0", "5", "I", _USER)}, {_edit("k1", "5", "I", _USER)}) AS j2 FROM (
    SELECT conv_id, arg_max(k0, i) AS k0, max(i) AS n FROM p GROUP BY conv_id) m JOIN (SELECT conv_id AS c2, i AS i2, k1, k2, k3 FROM p) x
    ON m.conv_id IS NOT DISTINCT FROM x.c2 AND m.n = x.i2))
SELECT z.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, substr(best, 1, 8)::BIGINT AS cost, substr(best, 9, instr(best, chr(1)) - 9) AS audit,
  sha256(substr(best, instr(best, chr(1)) + 2)) AS repaired_sha256
FROM z LEFT JOIN st ON z.conv_id IS NOT DISTINCT FROM st.conv_id"""

# Sets of five words, pairs that share one of their rarest shingles, verified on the sets.
SIMILAR = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, {_SPACED} AS w FROM documents),
s AS (SELECT rid, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [hash(w)]
  ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: hash(w[i:i + 4]))) END AS g FROM d),
e AS (SELECT rid, len(g) AS n, unnest(g) AS x FROM s),
r AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY f, x) AS i FROM (SELECT *, count(*) OVER (PARTITION BY x) AS f FROM e)),
p AS (SELECT * FROM r WHERE i <= n - (4 * n + 4) // 5 + 1 AND f > 1),
c AS (SELECT DISTINCT a.rid AS ra, b.rid AS rb FROM p a JOIN p b ON a.x = b.x AND a.rid < b.rid AND least(a.n, b.n) * 100 >= greatest(a.n, b.n) * 80),
l AS (SELECT x.doc_id AS a, y.doc_id AS b FROM c JOIN s x ON x.rid = ra JOIN s y ON y.rid = rb
  WHERE 100 * len(list_intersect(x.g, y.g)) >= 80 * (len(x.g) + len(y.g) - len(list_intersect(x.g, y.g)))),
u AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
reach(a, b) AS (SELECT a, b FROM u UNION SELECT reach.a, u.b FROM reach JOIN u ON reach.b = u.a),
m AS (SELECT a, min(b) AS low FROM reach GROUP BY a)
SELECT doc_id, len(g)::BIGINT AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id FROM s LEFT JOIN m ON a = doc_id"""
