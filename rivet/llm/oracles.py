"""DuckDB SQL for the operators that SQL can express, over whole tables."""

from __future__ import annotations

# FIXED VALUES: letters and white space as in the operators.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_WORDS = "list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"

OP1 = f"""
WITH t AS (SELECT doc_id, {_LOWER} AS norm FROM documents),
g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.norm) AS text_sha256
FROM t JOIN g USING (norm)
"""

OP5 = f"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                  unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM documents),
k AS (SELECT doc_id, pos, line,
             translate(trim(line, {_SPACE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
      FROM l),
v AS (SELECT key, max(doc_id) AS keep_id FROM k WHERE length(key) >= 20
      GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.*, v.key IS NOT NULL AND k.doc_id <> v.keep_id AS dropped FROM k LEFT JOIN v USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

OP7 = f"""
WITH RECURSIVE d AS (SELECT doc_id, source, len({_WORDS})::BIGINT AS size FROM documents),
c AS (SELECT *, md5('0:' || coalesce(doc_id::VARCHAR, 'null')) AS draw FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
             CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
               WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM d GROUP BY source),
r AS (SELECT 0 AS round, 0.0::DOUBLE AS share
      UNION ALL
      SELECT round + 1, new FROM (
        SELECT round, share,
          (SELECT (sum(source_size) - 3 * coalesce(sum(source_size)
                     FILTER (WHERE source_size * 3 < weight * r.share), 0))::DOUBLE
                  / sum(weight) FILTER (WHERE NOT source_size * 3 < weight * r.share) FROM s) AS new
        FROM r) WHERE new > share),
t AS (SELECT s.*, least(source_size * 3.0::DOUBLE, weight * (SELECT max(share) FROM r)) AS target FROM s),
n AS (SELECT source, ceil(count(*) / 512)::BIGINT AS splits FROM c GROUP BY source),
x AS (SELECT c.*, t.source_size, t.target,
             CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
             ('0x' || substr(draw, 1, 7))::BIGINT % n.splits AS split
      FROM c JOIN t ON c.source IS NOT DISTINCT FROM t.source
      JOIN n ON c.source IS NOT DISTINCT FROM n.source),
o AS (SELECT *, row_number() OVER (PARTITION BY source, split ORDER BY size DESC, draw, doc_id) AS seat FROM x),
p AS (SELECT *, (seat - 1) // 2048 AS block, (seat - 1) % 2048 AS place, rate - floor(rate) AS fraction,
             ('0x' || substr(md5(draw || ':' || seat), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u FROM o),
q AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source, split, block ORDER BY place
                 ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0)::BIGINT AS rest FROM p),
k AS (SELECT doc_id, source, split, block, place, size, u, rest, fraction AS pr FROM q WHERE place = 0
      UNION ALL
      SELECT doc_id, source, split, block, place, size, u, rest,
             least(1.0::DOUBLE, greatest(0.0::DOUBLE, CASE WHEN hit THEN pr - step * (1.0::DOUBLE - pr) ELSE pr + step * pr END))
      FROM (SELECT q.doc_id, q.source, q.split, q.block, q.place, q.size, q.u, q.rest, k.pr, k.u < k.pr AS hit,
                   CASE WHEN k.pr <= 0 OR k.pr >= 1 OR k.rest <= 0 THEN 0.0::DOUBLE
                        ELSE least(k.size / k.rest::DOUBLE, k.pr / (1.0::DOUBLE - k.pr), (1.0::DOUBLE - k.pr) / k.pr)
                   END AS step
            FROM k JOIN q ON k.source IS NOT DISTINCT FROM q.source AND k.split = q.split AND k.block = q.block
                         AND q.place = k.place + 1))
SELECT q.doc_id, q.size, q.source_size, q.target, (q.size * (floor(q.rate) + (k.u < k.pr)::INT))::BIGINT AS taken
FROM q JOIN k ON k.source IS NOT DISTINCT FROM q.source AND k.split = q.split AND k.block = q.block AND k.place = q.place
"""

OP9 = f"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text, {_WORDS} AS w,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: trim(x, {_SPACE}) <> '') AS ln
           FROM documents),
g AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i,
             unnest(list_transform(range(1, len(w) - 1), lambda i: w[i : i + 2])) AS tri FROM d),
u AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, tri) AS n FROM g),
rep AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM u, (VALUES (0), (1), (2)) t(o) WHERE n >= 2 GROUP BY doc_id),
m AS (SELECT d.doc_id, source, len(w)::BIGINT AS n_words,
             coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
             (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             len(ln)::BIGINT AS n_lines, (len(ln) - len(list_distinct(ln)))::BIGINT AS n_dup_lines,
             coalesce(rep.n, 0)::BIGINT AS n_repeat_words
      FROM d LEFT JOIN rep USING (doc_id)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
             n_symbols > 0.1::DOUBLE * n_words OR n_dup_lines > 0.3::DOUBLE * n_lines
             OR NOT word_chars / greatest(n_words, 1) BETWEEN 2.0 AND 15.0 AS host_failed FROM m),
h AS (SELECT source, count(*) AS n, count(*) FILTER (WHERE base_failed OR host_failed) AS bad FROM f GROUP BY source),
a AS (SELECT sum(bad)::DOUBLE / sum(n) AS mean, var_pop(bad / n) AS var, avg(n) AS size FROM h),
b AS (SELECT mean, CASE WHEN var > 0 THEN greatest(1.0, mean * (1 - mean) / var - 1) ELSE size END AS strength FROM a),
r AS (SELECT source, (bad + mean * strength) / (n + strength) AS rate FROM h, b)
SELECT f.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (rate > 0.25 AND host_failed) AS kept
FROM f JOIN r ON f.source IS NOT DISTINCT FROM r.source
"""

OP3 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
g AS (SELECT doc_id, unnest(range(length(h) // 2 - 49)) AS p,
             unnest(list_transform(range(length(h) // 2 - 49), lambda i: substr(h, 2 * i + 1, 100))) AS s FROM d),
o AS (SELECT s, min(doc_id) AS first FROM g GROUP BY s),
hit AS (SELECT g.doc_id, g.p FROM g JOIN o USING (s) WHERE o.first < g.doc_id),
i AS (SELECT *, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= 50 THEN 0 ELSE 1 END AS new FROM hit),
r AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM i),
s AS (SELECT doc_id, run, min(p) AS a, max(p) + 50 AS b FROM r GROUP BY doc_id, run),
t AS (SELECT *, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM s),
k AS (SELECT t.doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last,
             string_agg(substr(d.h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept
      FROM t JOIN d USING (doc_id) GROUP BY t.doc_id)
SELECT d.doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept || substr(h, 2 * last + 1), h))) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""

OP6 = f"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array({_LOWER}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
                     FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                     ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))) END AS sh
      FROM d),
n AS (SELECT doc_id, len(sh)::BIGINT AS n FROM s),
e AS (SELECT doc_id, unnest(sh) AS x FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id
      GROUP BY a.doc_id, b.doc_id),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * common >= 75 * (na.n + nb.n - common)),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a AS doc_id, min(b) AS low FROM r GROUP BY a)
SELECT n.doc_id, n.n AS n_shingles, least(n.doc_id, coalesce(low, n.doc_id)) AS component_id,
       n.doc_id <= coalesce(low, n.doc_id) AS kept
FROM n LEFT JOIN c USING (doc_id)
"""



def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit."""
    return (f"xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split({text}, ''), "
            "lambda ch: ascii(ch)::UBIGINT)), lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[], "
            "lambda d, e: xor(d >> 1, 3988292384::UBIGINT * (d & 1)))), 4294967295::UBIGINT)")


def _field(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c}::VARCHAR END"


_HEAD = " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars"))

OP11 = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, sha256({_HEAD} || {_field("text")}) AS leaf, sha256({_HEAD} || {_field("shown")}) AS shown_leaf
  FROM (SELECT *, CASE WHEN doc_id IS NOT NULL AND {_crc32("doc_id::VARCHAR")} % 2 = 0 THEN replace(text, chr(10), '')
                       ELSE text END AS shown FROM documents)),
l AS (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g,
             row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d),
t AS (SELECT g, 0 AS lvl, pos AS i, leaf AS h, count(*) OVER (PARTITION BY g) AS n FROM l
      UNION ALL
      SELECT g, lvl + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), (n + 2) // 3 FROM t WHERE n > 1 GROUP BY g, lvl, i // 3, n),
u AS (SELECT 0 AS lvl, g AS i, h, (SELECT count(DISTINCT g) FROM l) AS n FROM t WHERE n = 1
      UNION ALL
      SELECT lvl + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), (n + 2) // 3 FROM u WHERE n > 1 GROUP BY lvl, i // 3, n),
runs AS (SELECT g AS tree, 0 AS part, lvl, i // 3 AS run, i, h FROM t WHERE n > 1
         UNION ALL SELECT -1, 1, lvl, i // 3, i, h FROM u WHERE n > 1),
depth AS (SELECT g, lvl FROM t WHERE n > 1 GROUP BY g, lvl),
way AS (SELECT l.g, l.pos, l.g AS tree, 0 AS part, lvl, l.pos // (3 ** lvl)::BIGINT AS own FROM l JOIN depth ON l.g = depth.g
        UNION ALL
        SELECT l.g, l.pos, -1, 1, lvl, l.g // (3 ** lvl)::BIGINT FROM l, (SELECT DISTINCT lvl FROM u WHERE n > 1)),
st AS (SELECT w.g, w.pos, row_number() OVER (PARTITION BY w.g, w.pos ORDER BY w.part, w.lvl) AS k,
              coalesce(string_agg(h, '' ORDER BY r.i) FILTER (WHERE r.i < own), '') AS lefts,
              coalesce(string_agg(h, '' ORDER BY r.i) FILTER (WHERE r.i > own), '') AS rights
       FROM way w JOIN runs r ON r.tree = w.tree AND r.part = w.part AND r.lvl = w.lvl AND r.run = own // 3
       GROUP BY w.g, w.pos, w.part, w.lvl),
f AS (SELECT g, pos, 0::BIGINT AS k, shown_leaf AS h FROM l
      UNION ALL SELECT f.g, f.pos, f.k + 1, sha256(lefts || f.h || rights) FROM f JOIN st ON st.g = f.g AND st.pos = f.pos AND st.k = f.k + 1),
e AS (SELECT g, pos, arg_max(h, k) AS folded_root FROM f GROUP BY g, pos),
p AS (SELECT g, pos, sha256(string_agg(lefts || rights, '' ORDER BY k)) AS proof_sha256 FROM st GROUP BY g, pos),
s AS (SELECT g, h AS subroot FROM t WHERE n = 1),
r AS (SELECT h AS root FROM u WHERE n = 1)
SELECT doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM l JOIN s USING (g) CROSS JOIN r JOIN e USING (g, pos) LEFT JOIN p USING (g, pos)
"""


def _put(cost: str, letter: str, path: str) -> str:
    return f"{{'c': {path}.c + {cost}, 'a': '{letter}' || {path}.a}}"


_NEXT = (2, 2, 3, 2)  # places in the pattern: start, after s, after u, after a
_KEEPS = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})


def _row_edit(place: int) -> str:
    keeps = [f"CASE WHEN NOT gone AND ini = '{k}' THEN {_put('late', 'K', f'v{to}')} END" for k, to in _KEEPS[place].items()]
    rerole = f"CASE WHEN NOT gone THEN {_put('3 + late', 'R', f'v{_NEXT[place]}')} END"
    return f"list_min([{_put('4', 'D', f'v{place}')}, {rerole}, {', '.join(keeps)}]) AS w{place}"


def _with_inserts(place: int) -> str:
    one = _put("3", "I", f"w{_NEXT[place]}")
    two = f"{{'c': w{_NEXT[_NEXT[place]]}.c + 6, 'a': 'II' || w{_NEXT[_NEXT[place]]}.a}}"
    return f"list_min([w{place}, {one}, {two}]) AS v{place}"


OP12 = f"""
WITH RECURSIVE o AS (SELECT conv_id, dense_rank() OVER (ORDER BY conv_id) AS c, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS hit FROM conversations),
d AS (SELECT c, turn, CASE hit WHEN 4 THEN 'user' ELSE role END AS role,
             CASE hit WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
      FROM (SELECT *, unnest(range(CASE hit WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) FROM o)),
r AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, md5(text)) AS i,
             rtrim(text, {_SPACE}) AS bare, substr(role, 1, 1) AS ini FROM d),
q AS (SELECT *, row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 AS again, lag(ini) OVER (PARTITION BY c ORDER BY i) AS before FROM r),
x AS (SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault FROM q),
y AS (SELECT *, coalesce(fault IN ('blank', 'duplicate'), false) AS gone,
             CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS late FROM x),
g AS (SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) AS n,
             count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
             count(*) FILTER (WHERE fault = 'truncated') AS truncated,
             count(*) FILTER (WHERE before IS NOT NULL AND (before || ':' || ini) NOT IN ('s:u', 'u:a', 'a:u')) AS illegal
      FROM y GROUP BY c),
dp AS (SELECT c, n AS i, {{'c': 0, 'a': ''}} AS v0, {{'c': 6, 'a': 'II'}} AS v1, {{'c': 3, 'a': 'I'}} AS v2, {{'c': 0, 'a': ''}} AS v3 FROM g
       UNION ALL
       SELECT c, i, {", ".join(map(_with_inserts, range(4)))}
       FROM (SELECT dp.c, dp.i - 1 AS i, {", ".join(map(_row_edit, range(4)))} FROM dp JOIN y ON y.c = dp.c AND y.i = dp.i)),
a AS (SELECT c, v0.c::BIGINT AS cost, v0.a AS audit FROM dp WHERE i = 0),
w AS (SELECT c, audit, 0 AS k, 0::BIGINT AS i, 0 AS place, ''::VARCHAR AS told, false AS begun FROM a
      UNION ALL
      SELECT c, audit, k + 1, CASE WHEN e = 'I' THEN i ELSE i + 1 END, CASE WHEN e = 'D' THEN place ELSE goes END,
             CASE WHEN e = 'D' THEN told ELSE told || CASE WHEN begun THEN chr(10) ELSE '' END
               || CASE WHEN e = 'K' THEN role WHEN goes = 2 THEN 'user' ELSE 'assistant' END || ':'
               || CASE WHEN e = 'I' THEN '' ELSE text END END, begun OR e <> 'D'
      FROM (SELECT w.*, y.role, y.text, substr(audit, k + 1, 1) AS e,
                   CASE WHEN substr(audit, k + 1, 1) = 'K' AND y.ini = 's' THEN 1 WHEN place = 2 THEN 3 ELSE 2 END AS goes
            FROM w LEFT JOIN y ON y.c = w.c AND y.i = w.i + 1 WHERE k < length(audit))),
z AS (SELECT c, arg_max(told, k) AS told FROM w GROUP BY c)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(told, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, c FROM o) o LEFT JOIN g ON g.c = o.c LEFT JOIN a ON a.c = o.c LEFT JOIN z ON z.c = o.c
"""

LLM_ORACLES = {
    "op1_exact_dedup": OP1,
    "op3_repeat_dedup": OP3,
    "op5_line_dedup": OP5,
    "op6_near_dedup": OP6,
    "op7_mix_sources": OP7,
    "op9_quality_rules": OP9,
    "op11_merkle_manifest": OP11,
    "op12_conversation_repair": OP12,
}
