"""DuckDB SQL of the queries that SQL can express."""

from cartoledger.llm.quality import Rules

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _substring_dedup(n: int = 13) -> str:
    return rf"""
WITH d AS (SELECT doc_id, {WORDS} AS ws FROM documents),
w AS (
  SELECT doc_id, i, array_to_string(ws[i:i + {n - 1}], ' ') AS gram
  FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - {n - 1})) AS i FROM d)
),
firsts AS (SELECT gram, min(doc_id) AS low FROM w GROUP BY gram HAVING min(doc_id) < max(doc_id)),
hit AS (SELECT w.doc_id, w.i FROM w JOIN firsts USING (gram) WHERE w.doc_id > firsts.low),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + {n - 1})) AS i FROM hit),
tokens AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM d),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n
  FROM tokens ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(kept.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


def _quality(rules: Rules) -> str:
    lengths = sorted({*rules.max_shares, rules.repeat_window})
    ahead = "".join(f", lead(word, {j}) OVER w AS w{j}" for j in range(1, lengths[-1]))
    flags = "".join(
        f",\n  w{k - 1} IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, word, "
        + ", ".join(f"w{j}" for j in range(1, k))
        + f") > 1 AS f{k}"
        for k in lengths
    )
    inside = "".join(
        f",\n  max(f{k}) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW) AS m{k}"
        for k in lengths
    )
    sums = "".join(f", coalesce(sum(chars) FILTER (WHERE m{k}), 0) AS c{k}" for k in lengths)
    limits = "".join(f" AND coalesce(c{k}, 0) / greatest(word_chars, 1) <= {v}" for k, v in rules.max_shares.items())
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {WORDS} AS ws FROM documents),
t AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM d),
a AS (SELECT doc_id, i, word{ahead} FROM t WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
flagged AS (SELECT doc_id, i, len(word) AS chars{flags} FROM a),
covered AS (SELECT doc_id, i, chars{inside} FROM flagged),
s AS (SELECT doc_id, sum(chars) AS word_chars, count(*) FILTER (WHERE m{rules.repeat_window}) AS n_repeat{sums}
      FROM covered GROUP BY doc_id),
lines AS (SELECT doc_id, line, count(*) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
          WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id, line),
l AS (SELECT doc_id, sum(n - 1) AS dup, sum((n - 1) * len(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g'))) AS dup_chars
      FROM lines GROUP BY doc_id),
b AS (
  SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
    CAST(len(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat, 0) AS BIGINT) AS n_repeat_words,
    coalesce(dup_chars, 0) AS dup_chars, s.* EXCLUDE (doc_id, word_chars, n_repeat)
  FROM d LEFT JOIN s USING (doc_id) LEFT JOIN l USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {rules.min_words} OR 100 * n_repeat_words > {rules.max_repeat_percent} * n_words AS base_failed,
  NOT (n_words < {rules.min_words} OR 100 * n_repeat_words > {rules.max_repeat_percent} * n_words)
    AND dup_chars / greatest(word_chars, 1) <= {rules.max_line_share}{limits} AS kept
FROM b
"""


_CHAT = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(len(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(len(role) + len(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g'))
           + len('<|im_start|>') + len('<|im_end|>') + 2) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""

_LINES = r"""
WITH l AS (
  SELECT doc_id, generate_subscripts(ls, 1) AS line_no, unnest(ls) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL)
),
worded AS (
  SELECT doc_id, line_no, list_sort(list_distinct(regexp_extract_all(line, '[^\x20\x09-\x0D]+'))) AS ws
  FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
),
sets AS (
  SELECT row_number() OVER (ORDER BY first) AS s, ws, len(ws) AS n, first
  FROM (SELECT ws, min((doc_id, line_no)) AS first FROM worded GROUP BY ws)
),
tokens AS (SELECT s, n, unnest(ws) AS token FROM sets),
ranked AS (
  SELECT s, n, token, row_number() OVER (PARTITION BY s ORDER BY c, token) AS p
  FROM tokens JOIN (SELECT token, count(*) AS c FROM tokens GROUP BY token) USING (token)
),
heads AS (SELECT s, n, token FROM ranked WHERE p <= n - ((4 * n + 4) // 5) + 1),
pairs AS (
  SELECT DISTINCT a.s AS a, b.s AS b
  FROM heads a JOIN heads b ON a.token = b.token AND a.s < b.s AND 5 * a.n >= 4 * b.n AND 5 * b.n >= 4 * a.n
),
matched AS (
  SELECT DISTINCT b AS s FROM (
    SELECT p.b, len(list_intersect(x.ws, y.ws)) AS common, x.n + y.n AS whole
    FROM pairs p JOIN sets x ON x.s = p.a JOIN sets y ON y.s = p.b
  ) WHERE 5 * common >= 4 * (whole - common)
),
kept AS (
  SELECT first[1] AS doc_id, first[2] AS line_no FROM sets ANTI JOIN matched USING (s)
),
rest AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.line_no) AS text,
    count(*) FILTER (WHERE regexp_matches(l.line, '[^\x20\x09-\x0D]')) AS n
  FROM l LEFT JOIN kept k USING (doc_id, line_no)
  WHERE k.doc_id IS NOT NULL OR NOT regexp_matches(l.line, '[^\x20\x09-\x0D]')
  GROUP BY l.doc_id
),
total AS (SELECT doc_id, count(*) AS n FROM worded GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(total.n, 0) AS BIGINT) AS n_lines,
  CAST(coalesce(total.n, 0) - coalesce(rest.n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(rest.text, '')) AS kept_sha256
FROM documents d LEFT JOIN rest USING (doc_id) LEFT JOIN total USING (doc_id)
"""


def _vectors(scale: int) -> str:
    """Kept rows of ``embeddings`` with ``q``, the integer components as doubles."""
    return f"""
v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * {scale})) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)"""


def _vector_codes(rounds: int = 4, entries: int = 256) -> str:
    nearest = """
a{r} AS (
  SELECT vec_id, p, arg_min(e, d * 1000 + e) AS e, min(d) AS d FROM (
    SELECT s.vec_id, s.p, b.e, CAST(s.n + b.n - 2 * list_dot_product(s.c, b.c) AS BIGINT) AS d
    FROM s JOIN b{r} b USING (p)
  ) GROUP BY vec_id, p
)"""
    move = """
m{r} AS (
  SELECT p, e, list(x ORDER BY i) AS c FROM (
    SELECT a.p, a.e, i, floor(sum(s.c[i]) / count(*)) AS x
    FROM a{q} a JOIN s USING (vec_id, p), range(1, (SELECT w FROM wide) + 1) g(i) GROUP BY a.p, a.e, i
  ) GROUP BY p, e
),
b{r} AS (
  SELECT p, e, c, list_dot_product(c, c) AS n FROM (
    SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM b{q} b LEFT JOIN m{r} m ON m.p = b.p AND m.e = b.e
  )
)"""
    steps = [nearest.format(r=0)]
    for r in range(1, rounds + 1):
        steps += [move.format(r=r, q=r - 1), nearest.format(r=r)]
    return f"""
WITH {_vectors(1024)},
wide AS (SELECT CAST(max(len(q)) // 4 AS BIGINT) AS w FROM v),
s AS (
  SELECT vec_id, p, c, list_dot_product(c, c) AS n
  FROM (SELECT vec_id, p, list_slice(q, p * w + 1, p * w + w) AS c FROM v, wide, range(4) t(p))
),
b0 AS (
  SELECT s.p, f.e, s.c, s.n
  FROM s JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM v) f USING (vec_id) WHERE f.e < {entries}
),{",".join(steps)},
book AS (
  SELECT sha256(string_agg(t, ',' ORDER BY p, e)) AS h
  FROM (SELECT p, e, array_to_string(list_transform(c, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ',') AS t FROM b{rounds})
),
coded AS (
  SELECT vec_id, string_agg(lpad(lower(to_hex(CAST(e AS BIGINT))), 2, '0'), '' ORDER BY p) AS code,
    CAST(sum(d) AS BIGINT) AS error
  FROM a{rounds} GROUP BY vec_id
)
SELECT c.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY v.label) AS BIGINT) AS label_error,
  book.h AS codebooks_sha256
FROM coded c JOIN v USING (vec_id), book
"""


_NEGATIVES = f"""
WITH {_vectors(256)},
t AS (
  SELECT vec_id, q, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label FROM v WHERE label IS NOT NULL
),
s AS (
  SELECT a.vec_id AS anchor_id, o.vec_id AS other_id, a.label = o.label AS same,
    CAST(list_dot_product(a.q, o.q) AS BIGINT) AS score
  FROM t a JOIN t o ON a.vec_id % 100 = 0 AND a.vec_id <> o.vec_id
),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM (
    SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) AS k FROM s WHERE same
  ) WHERE k <= 5
),
n AS (
  SELECT p.*, s.other_id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS k
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
)
SELECT anchor_id, positive_id, CAST(k AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE k <= 5
"""

ORACLE_SQL: dict[str, str] = {
    "op2_substring_dedup": _substring_dedup(),
    "op5_quality_rules": _quality(Rules()),
    "op6_chat_format": _CHAT,
    "op7_line_dedup": _LINES,
    "op11_vector_codes": _vector_codes(),
    "op12_hard_negatives": _NEGATIVES,
}
