"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

EXACT_DEDUP = r"""
WITH h AS (SELECT doc_id, length(coalesce(text, '')) AS n,
                  sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS d FROM documents)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY d) AS group_size,
       doc_id = first_value(doc_id) OVER best AS kept, d AS text_sha256
FROM h WINDOW best AS (PARTITION BY d ORDER BY n DESC, doc_id)
"""


def _kind_sql(kind: str, pattern: str, rank: int, keep: str, words: str, score: float, floor: float) -> str:
    """Spans of one kind as a list of structs; ``keep`` sees m (match), b and a (text before and after)."""
    return f"""
SELECT doc_id, {rank} AS rank, '{kind}' AS kind, st AS start, st + length(m) AS stop FROM (
  SELECT doc_id, ms[i] AS m, ps[i] AS b, ps[i + 1] AS a,
         list_sum(list_transform(ps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS st
  FROM (SELECT doc_id, ms, ps, unnest(range(1, len(ms) + 1)) AS i FROM (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{pattern}') AS ms,
           string_split_regex(coalesce(text, ''), '{pattern}') AS ps FROM documents)))
WHERE ({keep}) AND {score} + CASE WHEN regexp_matches(lower(right(b, 40) || chr(10) || left(a, 40)), '{words}') THEN 0.3 ELSE 0 END >= {floor}
"""


_DIGITS = "regexp_replace(m, '[^0-9]', '', 'g')"
_LUHN = f"""list_sum(list_transform(range(length({_DIGITS})), lambda k:
  CASE WHEN k % 2 = 0 THEN CAST(substr(reverse({_DIGITS}), k + 1, 1) AS INT)
       ELSE CAST(substr(reverse({_DIGITS}), k + 1, 1) AS INT) * 2
            - CASE WHEN CAST(substr(reverse({_DIGITS}), k + 1, 1) AS INT) > 4 THEN 9 ELSE 0 END END)) % 10 = 0"""
_PART = "0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_MOD97 = """list_reduce(list_prepend(CAST(0 AS BIGINT), list_transform(string_split(substr(m, 5) || left(m, 4), ''),
  lambda c: CAST(strpos('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ', c) - 1 AS BIGINT))),
  lambda s, v: CASE WHEN v > 9 THEN (s * 100 + v) % 97 ELSE (s * 10 + v) % 97 END) = 1"""

_PII = " UNION ALL ".join((
    _kind_sql("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", 0, "true", "x", 1, 0),
    _kind_sql("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", 1,
              rf"regexp_matches(m, '^{_PART}\.{_PART}\.{_PART}\.{_PART}$')", "x", 1, 0),
    _kind_sql("card", r"[0-9]([\x20-]?[0-9])+", 2, f"length({_DIGITS}) BETWEEN 14 AND 19 AND {_LUHN}", "x", 1, 0),
    _kind_sql("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 3, f"length({_DIGITS}) BETWEEN 10 AND 15", "x", 1, 0),
    _kind_sql("iban", "[A-Z]{2}[0-9]{2}[A-Z0-9]{11,}", 4, f"length(m) <= 34 AND {_MOD97}", "iban|account|bank", 0.7, 0.6),
    _kind_sql("ssn", "[0-9]{3}-[0-9]{2}-[0-9]{4}", 5,
              "NOT regexp_matches(m, '^(000|666|9)|-00-|-0000$') AND NOT regexp_matches(b, '[0-9-]$') "
              "AND NOT regexp_matches(a, '^[0-9-]')", "ssn|social security", 0.4, 0.6),
))

PII = f"""
WITH s AS ({_PII}),
g AS (SELECT doc_id, count(*) FILTER (kind = 'email') AS e, count(*) FILTER (kind = 'ip') AS i,
             count(*) FILTER (kind = 'card') AS c, count(*) FILTER (kind = 'phone') AS p,
             count(*) FILTER (kind = 'iban') AS ib, count(*) FILTER (kind = 'ssn') AS sn,
             string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (rank < 4) AS base,
             string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS every
      FROM s GROUP BY doc_id)
SELECT d.doc_id, coalesce(e, 0) AS n_email, coalesce(i, 0) AS n_ip, coalesce(c, 0) AS n_card, coalesce(p, 0) AS n_phone,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(every, '') AS spans, coalesce(ib, 0) AS n_iban, coalesce(sn, 0) AS n_ssn
FROM documents d LEFT JOIN g USING (doc_id)
"""

_ESCAPED = r"regexp_replace({}, '(\\|<s>|</s>|\[INST\]|\[/INST\])', '\\\1', 'g')"

CHAT = rf"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
           UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(22 + length({_ESCAPED.format('role')}) + length({_ESCAPED.format('text')})) AS BIGINT) AS formatted_chars,
       CAST(0 AS BIGINT) AS n_rewrites
FROM t GROUP BY conv_id
"""

TOP_K = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text: eight steps of the reversed polynomial per character."""
    return f"""xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split({text}, ''), lambda c: CAST(ascii(c) AS BIGINT))),
  lambda s, b: list_reduce(list_prepend(xor(s, b), [CAST(0 AS BIGINT) FOR i IN range(8)]),
    lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""


def _framed(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


_LEAF = " || ".join(_framed(c) for c in ("doc_id", "source", "lang", "n_chars"))
_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _levels_sql(name: str, leaves: str) -> str:
    """All levels over ``leaves(tree, idx, h, n)``, then their runs of 16."""
    return f"""
{name}(tree, lvl, idx, h, n) AS (
  SELECT tree, 0, idx, h, n FROM {leaves}
  UNION ALL
  SELECT tree, lvl + 1, idx // 16, sha256(string_agg(h, '' ORDER BY idx)), (n + 15) // 16 FROM {name} WHERE n > 1 GROUP BY tree, lvl, idx // 16, n),
{name}_runs AS (SELECT tree, lvl, idx // 16 AS run, list(h ORDER BY idx) AS hs FROM {name} WHERE n > 1 GROUP BY ALL)"""


def _folds_sql(name: str, levels: str, start: str) -> str:
    """Siblings and folded digests of ``start(row_id, tree, idx, f, sibs)``, level by level."""
    return f"""
{name}(row_id, tree, lvl, idx, f, sibs) AS (
  SELECT row_id, tree, 0, idx, f, sibs FROM {start}
  UNION ALL
  SELECT row_id, p.tree, p.lvl + 1, idx // 16,
         sha256(array_to_string(hs[1:idx % 16], '') || f || array_to_string(hs[idx % 16 + 2:], '')),
         sibs || array_to_string(hs[1:idx % 16], '') || array_to_string(hs[idx % 16 + 2:], '')
  FROM {name} p JOIN {levels}_runs r ON p.tree = r.tree AND p.lvl = r.lvl AND p.idx // 16 = r.run)"""


MERKLE = f"""
WITH RECURSIVE
d AS (SELECT doc_id, coalesce('1' || source, '0') AS tree, sha256({_LEAF} || {_framed('text')}) AS h,
             CASE WHEN {_crc32('CAST(doc_id AS VARCHAR)')} % 5 = 0 THEN sha256({_LEAF} || {_framed(_LOWERED)}) END AS bad FROM documents),
leaves AS (SELECT *, row_number() OVER (ORDER BY tree, doc_id NULLS FIRST, h) AS row_id,
                  row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS n FROM d),
{_levels_sql('lv', 'leaves')},
tops AS (SELECT '' AS tree, tree AS source_tree, h, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n FROM lv WHERE n = 1),
{_levels_sql('tv', 'tops')},
begun AS (SELECT row_id, tree, idx, coalesce(bad, h) AS f, '' AS sibs FROM leaves),
{_folds_sql('lf', 'lv', 'begun')},
turned AS (SELECT row_id, '' AS tree, t.idx, f, sibs FROM (SELECT * FROM lf QUALIFY lvl = max(lvl) OVER (PARTITION BY row_id)) x JOIN tops t ON x.tree = t.source_tree),
{_folds_sql('tf', 'tv', 'turned')},
done AS (SELECT * FROM tf QUALIFY lvl = max(lvl) OVER (PARTITION BY row_id)),
root AS (SELECT h AS root FROM tv WHERE n = 1)
SELECT l.doc_id, l.h AS leaf, t.h AS subroot, root, sha256(sibs) AS proof_sha256, f AS folded_root, f = root AS verified
FROM leaves l JOIN done USING (row_id) JOIN tops t ON l.tree = t.source_tree CROSS JOIN root
"""

PREFIX_TRIE = f"""
WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
           FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT c, c - c % 5 AS donor, {_crc32('CAST(c AS VARCHAR)')} % 9 AS h FROM (SELECT DISTINCT c FROM t)),
rebuilt AS (SELECT v.c, 0 AS part, t.pos, t.role, t.text FROM convs v JOIN t ON t.c = v.donor AND t.pos <= v.h
            UNION ALL SELECT t.c, 1, t.pos, t.role, t.text FROM t JOIN convs v USING (c) WHERE t.pos > v.h),
placed AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY part, pos) AS depth FROM rebuilt),
named AS (SELECT c, depth, strlen(text) AS bytes,
                 sha256(string_agg(strlen(role) || ':' || role || strlen(text) || ':' || text, '' ORDER BY depth) OVER (PARTITION BY c ORDER BY depth)) AS name
          FROM placed
          UNION ALL SELECT c, 0, 0, '' FROM convs),
lasts AS (SELECT c, max(depth) AS len FROM named GROUP BY c),
nodes AS (SELECT name, depth, min(c) AS conv, count(*) AS n, any_value(bytes) AS bytes FROM named GROUP BY name, depth),
own AS (SELECT w.c, w.depth, w.name, x.conv, x.n, (x.n - 1) * x.bytes AS saved FROM named w JOIN nodes x USING (name, depth)),
ups AS (SELECT k.conv, k.depth, p.conv AS parent FROM (SELECT DISTINCT conv, depth FROM own WHERE depth > 0) k
        JOIN own p ON p.c = k.conv AND p.depth = k.depth - 1),
kids AS (SELECT parent AS conv, depth - 1 AS depth, count(*) AS n_children FROM ups GROUP BY ALL),
weights AS (SELECT DISTINCT o.conv, o.depth, o.saved, coalesce(k.n_children, 0) AS n_children FROM own o LEFT JOIN kids k USING (conv, depth)),
sums AS (SELECT a.conv, a.depth, sum(w.saved) AS saved, count(*) FILTER (w.n_children = 0) AS leaves
         FROM weights w JOIN own a ON a.c = w.conv AND a.depth <= w.depth GROUP BY ALL),
ends AS (SELECT o.conv, o.depth, string_agg(CAST(o.c AS VARCHAR), ',' ORDER BY o.c) AS ids FROM own o JOIN lasts l ON l.c = o.c AND l.len = o.depth GROUP BY ALL)
SELECT x.conv AS conv_id, CAST(x.depth AS BIGINT) AS depth, u.parent AS parent_conv_id, x.n AS n_convs, w.n_children,
       s.leaves AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM nodes x JOIN weights w USING (conv, depth) JOIN sums s USING (conv, depth)
LEFT JOIN ups u USING (conv, depth) LEFT JOIN ends e USING (conv, depth)
"""
