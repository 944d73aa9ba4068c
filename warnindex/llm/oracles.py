"""DuckDB twins of those queries of this subpackage that SQL can express, written on their own."""

MIX = r"""
WITH slim AS (
  SELECT doc_id, lang, source, len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+')) AS n,
    CASE WHEN regexp_extract(coalesce(source, ''), '([0-9]{1,9})$', 1) = '' THEN 'other'
         ELSE 'domain' || (CAST(regexp_extract(source, '([0-9]{1,9})$', 1) AS INT) % 3) END AS domain
  FROM documents),
leaf AS (SELECT domain, lang, source, sum(n)::HUGEINT AS supply, 3 * sum(n)::HUGEINT AS cap FROM slim GROUP BY ALL HAVING sum(n) > 0),
root AS (SELECT least(floor(sum(supply)::DOUBLE * 0.8)::HUGEINT, sum(cap)::HUGEINT) AS budget FROM leaf),
d0 AS (SELECT domain, sum(cap)::HUGEINT AS cap, any_value(budget) AS budget,
         CASE domain WHEN 'domain0' THEN 50 WHEN 'domain1' THEN 30 WHEN 'domain2' THEN 20 ELSE 1 END::HUGEINT AS w
       FROM leaf, root GROUP BY domain),
d1 AS (SELECT *, coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / w::DOUBLE, domain ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS before,
         (sum(w) OVER (ORDER BY cap::DOUBLE / w::DOUBLE DESC, domain DESC ROWS UNBOUNDED PRECEDING))::HUGEINT AS lw FROM d0),
d2 AS (SELECT *, min(CASE WHEN cap * lw <= (budget - before) * w THEN 1 ELSE 0 END) OVER (ORDER BY cap::DOUBLE / w::DOUBLE, domain ROWS UNBOUNDED PRECEDING) AS f FROM d1),
d3 AS (SELECT *, (budget - sum(f * cap) OVER ())::HUGEINT AS rest, (sum((1 - f) * w) OVER ())::HUGEINT AS ow,
         (sum((1 - f) * w) OVER (ORDER BY cap::DOUBLE / w::DOUBLE, domain ROWS UNBOUNDED PRECEDING))::HUGEINT AS cw FROM d2),
dom AS (SELECT domain, CASE WHEN f = 1 THEN cap ELSE (rest * cw) // ow - (rest * (cw - w)) // ow END AS budget FROM d3),
l0 AS (SELECT domain, lang, sum(cap)::HUGEINT AS cap, any_value(budget) AS budget,
         CASE lang WHEN 'en' THEN 50 WHEN 'fr' THEN 20 WHEN 'de' THEN 20 WHEN 'es' THEN 10 ELSE 1 END::HUGEINT AS w
       FROM leaf JOIN dom USING (domain) GROUP BY domain, lang),
l1 AS (SELECT *, coalesce(sum(cap) OVER (PARTITION BY domain ORDER BY cap::DOUBLE / w::DOUBLE, lang ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS before,
         (sum(w) OVER (PARTITION BY domain ORDER BY cap::DOUBLE / w::DOUBLE DESC, lang DESC ROWS UNBOUNDED PRECEDING))::HUGEINT AS lw FROM l0),
l2 AS (SELECT *, min(CASE WHEN cap * lw <= (budget - before) * w THEN 1 ELSE 0 END) OVER (PARTITION BY domain ORDER BY cap::DOUBLE / w::DOUBLE, lang ROWS UNBOUNDED PRECEDING) AS f FROM l1),
l3 AS (SELECT *, (budget - sum(f * cap) OVER (PARTITION BY domain))::HUGEINT AS rest, (sum((1 - f) * w) OVER (PARTITION BY domain))::HUGEINT AS ow,
         (sum((1 - f) * w) OVER (PARTITION BY domain ORDER BY cap::DOUBLE / w::DOUBLE, lang ROWS UNBOUNDED PRECEDING))::HUGEINT AS cw FROM l2),
lng AS (SELECT domain, lang, CASE WHEN f = 1 THEN cap ELSE (rest * cw) // ow - (rest * (cw - w)) // ow END AS budget FROM l3),
s0 AS (SELECT domain, lang, source, supply, cap, budget, 1::HUGEINT AS w FROM leaf JOIN lng USING (domain, lang)),
s1 AS (SELECT *, coalesce(sum(cap) OVER (PARTITION BY domain, lang ORDER BY cap::DOUBLE, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS before,
         (sum(w) OVER (PARTITION BY domain, lang ORDER BY cap::DOUBLE DESC, source DESC ROWS UNBOUNDED PRECEDING))::HUGEINT AS lw FROM s0),
s2 AS (SELECT *, min(CASE WHEN cap * lw <= (budget - before) * w THEN 1 ELSE 0 END) OVER (PARTITION BY domain, lang ORDER BY cap::DOUBLE, source ROWS UNBOUNDED PRECEDING) AS f FROM s1),
s3 AS (SELECT *, (budget - sum(f * cap) OVER (PARTITION BY domain, lang))::HUGEINT AS rest, (sum((1 - f) * w) OVER (PARTITION BY domain, lang))::HUGEINT AS ow,
         (sum((1 - f) * w) OVER (PARTITION BY domain, lang ORDER BY cap::DOUBLE, source ROWS UNBOUNDED PRECEDING))::HUGEINT AS cw FROM s2),
src AS (SELECT domain, lang, source, supply, CASE WHEN f = 1 THEN cap ELSE (rest * cw) // ow - (rest * (cw - w)) // ow END AS budget FROM s3),
placed AS (SELECT s.*, budget // supply AS epochs, budget % supply AS rest,
             md5('mix-1|' || CAST(budget // supply AS VARCHAR) || '|' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS k
           FROM slim s JOIN src USING (domain, lang, source)),
cum AS (SELECT *, sum(n) OVER (PARTITION BY domain, lang, source ORDER BY k RANGE UNBOUNDED PRECEDING) AS upto FROM placed)
SELECT doc_id, domain, lang, source, CAST(n AS BIGINT) AS n_tokens,
  CAST(CASE WHEN n = 0 THEN 0 ELSE epochs + CASE WHEN upto <= rest THEN 1 ELSE 0 END END AS INT) AS copies FROM cum
UNION ALL
SELECT s.doc_id, s.domain, s.lang, s.source, CAST(s.n AS BIGINT), 0 FROM slim s ANTI JOIN src USING (domain, lang, source)
"""

WARC = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b, sha256(coalesce(html, '')) AS d FROM pages),
g AS (SELECT d, min(page_id) AS m FROM p WHERE octet_length(b) >= 100 GROUP BY d)
SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, p.d AS payload_digest,
  CASE WHEN m IS NULL OR page_id IS NOT DISTINCT FROM m THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM m THEN m END AS refers_to
FROM p LEFT JOIN g ON p.d = g.d
"""


def _escaped_length(col: str) -> str:
    """Length of a text once backslashes are doubled and one is put into every control string."""
    controls = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]", "[/END]")
    extra = [f"(length({col}) - length(replace({col}, '{c}', ''))) // {len(c)}" for c in controls]
    return f"(2 * length({col}) - length(replace({col}, chr(92), '')) + {' + '.join(extra)})"


CHAT = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
o AS (SELECT *, row_number() OVER w AS n, lag(role) OVER w AS state, lead(conv_id IS NOT DISTINCT FROM conv_id) OVER w IS NULL AS last
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum({_escaped_length('text')} + CASE role WHEN 'system' THEN 18 WHEN 'user' THEN 15 WHEN 'assistant' THEN 10
    ELSE 24 + {_escaped_length('role')} END) AS BIGINT) AS formatted_chars,
  count(*) FILTER (WHERE NOT CASE WHEN n = 1 THEN role IN ('system', 'user') WHEN state IN ('system', 'assistant') THEN role = 'user'
    WHEN state = 'user' THEN role = 'assistant' ELSE false END) AS invalid_turns,
  bool_or(last AND role = 'assistant') AS complete
FROM o GROUP BY conv_id
"""


def _found(rank: int, kind: str, regex: str, group: int = 0) -> str:
    """(doc_id, rank, kind, s, x, g) of every match: its start comes from the lengths of all before it."""
    q = regex.replace("'", "''")
    return f"""SELECT doc_id, n, {rank} AS rank, '{kind}' AS kind, unnest(list_transform(range(1, len(ms) + 1), lambda i: {{
        's': list_sum(list_transform(ps[1:i], lambda p: length(p))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda m: length(m))), 0),
        'x': ms[i], 'g': gs[i]}})) AS f
      FROM (SELECT doc_id, n, regexp_extract_all(t, '{q}') AS ms, string_split_regex(t, '{q}') AS ps, regexp_extract_all(t, '{q}', {group}) AS gs FROM d)
      WHERE len(ms) > 0"""


def _windows(rank: int, kind: str, chars: str, width: int, threshold: float) -> str:
    """Extent of the windows of high entropy in every run of a class, unless the allow-list holds for it."""
    repeats = " OR ".join(f"(2 * {k} <= length(x) AND substr(x, {k} + 1) = substr(x, 1, length(x) - {k}))" for k in range(1, 11))
    return f"""SELECT doc_id, n, rank, kind, s, e FROM (
      SELECT *, f.s + list_min(hit) AS s, f.s + list_max(hit) + {width} AS e, substr(f.x, list_min(hit) + 1, list_max(hit) - list_min(hit) + {width}) AS x FROM (
      SELECT *, list_filter(range(0, length(f.x) - {width - 1}), lambda i: list_entropy(string_split(substr(f.x, i + 1, {width}), '')) >= {threshold} - 1e-10) AS hit
      FROM ({_found(rank, kind, f'[{chars}]{{{width},}}')})) WHERE len(hit) > 0)
      WHERE NOT regexp_matches(x, '(?i)(example|sample|dummy|placeholder|changeme)(key|token|secret)?$')
        AND regexp_replace(lower(x), 'abcdefghijklmnopqrstuvwxyz|0123456789|abcdef|[+/_-]', '', 'g') <> ''
        AND NOT (regexp_matches(x, '[/_-]') AND NOT regexp_matches(x, '[0-9+]') AND len(regexp_extract_all(x, '[A-Z]?[a-z]+|[A-Z]+')) * 3.5 <= length(x))
        AND NOT ({repeats})"""


# either case letter by letter: this engine's (?i) also folds letters outside ASCII
_NAMES = "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in "password|passwd|secret|token|api_?key")
_ASSIGN = f"({_NAMES})" + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""

SECRETS = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS n FROM documents),
base AS (
  SELECT doc_id, n, rank, kind, f.s AS s, f.s + length(f.x) AS e FROM (
    {_found(0, 'assign', _ASSIGN, 2)}
    UNION ALL {_found(1, 'access', 'AKIA[A-Z0-9]{14,}')}
    UNION ALL {_found(2, 'hex', '[0-9a-f]{16,}')}) WHERE kind <> 'assign' OR length(f.g) >= 12),
more AS (
  {_windows(3, 'entropy_hex', '0-9a-fA-F', 20, 3.0)}
  UNION ALL {_windows(4, 'entropy_base64', '0-9a-zA-Z+/_-', 24, 4.0)}),
b AS (SELECT n, count(*) FILTER (WHERE rank = 0) AS n_assign, count(*) FILTER (WHERE rank = 1) AS n_access, count(*) FILTER (WHERE rank = 2) AS n_hex,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS txt FROM base GROUP BY n),
a AS (SELECT n, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS txt FROM (FROM base UNION ALL FROM more) GROUP BY n)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(b.txt, '')) AS base_sha256, coalesce(a.txt, '') AS spans
FROM d LEFT JOIN b USING (n) LEFT JOIN a USING (n)
"""

# all pairs of a label; the smallest vec_id spreads along the links
EMBEDDINGS = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e, label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS ok
  FROM embeddings),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE a.ok AND b.ok AND list_cosine_similarity(a.e, b.e) >= 0.93),
reach(a, c) AS (SELECT vec_id, vec_id FROM v UNION SELECT links.b, reach.c FROM reach JOIN links ON links.a = reach.a),
comp AS (SELECT a, min(c) AS c FROM reach GROUP BY a),
deg AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, c AS component_id, vec_id = c AS kept
FROM v JOIN comp ON comp.a = vec_id LEFT JOIN deg ON deg.a = vec_id
"""

COLLOCATIONS = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS w FROM pieces),
grams AS (
  SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM w, (VALUES (1), (2), (3)) v(m))),
f AS (SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY lang, m, phrase),
sizes AS (SELECT lang, sum(f) AS n FROM f WHERE m = 1 GROUP BY lang),
cand AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1 AND f >= 10),
cuts AS (SELECT c.*, k, array_to_string(w[1:k], ' ') AS lp, array_to_string(w[k + 1:m], ' ') AS rp FROM cand c, (VALUES (1), (2)) v(k) WHERE k < m),
scored AS (
  SELECT c.lang, c.m, c.phrase, c.a, k, fl.f AS l, fr.f AS r, (1000000::HUGEINT * a * a) // (fl.f::HUGEINT * fr.f) AS score
  FROM cuts c JOIN f fl ON fl.lang = c.lang AND fl.m = k AND fl.phrase = lp JOIN f fr ON fr.lang = c.lang AND fr.m = c.m - k AND fr.phrase = rp),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
outer_f AS (
  SELECT lang, phrase, max(a) AS outer_a
  FROM (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase FROM cand WHERE m = 3) GROUP BY lang, phrase),
ranked AS (
  SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, encode(b.phrase)) AS rank, b.phrase, a, l, r, score
  FROM best b LEFT JOIN outer_f o ON o.lang = b.lang AND o.phrase = b.phrase AND 100 * o.outer_a >= 50 * b.a
  WHERE o.phrase IS NULL)
SELECT r.lang, rank, phrase, a, l, r.r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked r JOIN sizes USING (lang) WHERE rank <= 2000
"""

LICENSES = r"""
WITH t(tid, label, phrase, text) AS (VALUES
  (1, 'gpl', true, 'gnu general public license'), (2, 'apache', true, 'apache license'), (3, 'cc-by', true, 'cc by'), (4, 'mit', true, 'mit license'),
  (5, 'apache-2.0', false, 'licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license'),
  (6, 'apache-2.0', false, 'licensed under the apache license version 2 0'),
  (7, 'mit', false, 'permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so'),
  (8, 'mit', false, 'released under the mit license'),
  (9, 'bsd', false, 'redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer'),
  (10, 'gpl-3.0', false, 'this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version'),
  (11, 'gpl-3.0', false, 'licensed under the gnu general public license version 3'),
  (12, 'cc-by-4.0', false, 'this work is licensed under a creative commons attribution 4 0 international license'),
  (13, 'cc-by-nc-4.0', false, 'this work is licensed under a creative commons attribution noncommercial 4 0 international license'),
  (14, 'cc-by-nc-4.0', false, 'licensed under cc by nc 4 0')),
tw AS (SELECT tid, label, phrase, string_split(text, ' ') AS tw FROM t),
tk AS (SELECT DISTINCT tid, label, phrase, len(tw) AS span, len(list_distinct(tw)) AS n, unnest(tw) AS token, tw FROM tw),
d AS (
  SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
pos AS (SELECT rid, unnest(w) AS token, unnest(range(0, len(w))) AS pos FROM d),
hits AS (SELECT p.rid, p.pos, k.* FROM pos p JOIN tk k USING (token)),
base AS (
  SELECT h.rid, h.pos, h.label, 1.0::DOUBLE AS score, true AS phrase
  FROM hits h JOIN d USING (rid) WHERE h.phrase AND h.token = h.tw[1] AND d.w[h.pos + 1:h.pos + h.span] = h.tw),
enough AS (SELECT rid, tid FROM hits WHERE NOT phrase GROUP BY rid, tid, n HAVING count(DISTINCT token) * 100 >= 80 * n),
near AS (SELECT h.* FROM hits h JOIN enough USING (rid, tid)),
blocks AS (
  SELECT a.rid, a.pos, a.label, count(DISTINCT b.token)::DOUBLE / a.n AS score, false AS phrase
  FROM near a JOIN near b ON a.rid = b.rid AND a.tid = b.tid AND b.pos >= a.pos AND b.pos < a.pos + a.span
  GROUP BY a.rid, a.tid, a.pos, a.label, a.n HAVING count(DISTINCT b.token) * 100 >= 80 * a.n),
found AS (SELECT * FROM base UNION ALL SELECT * FROM blocks),
per AS (
  SELECT rid, count(*) FILTER (WHERE phrase) AS n_base, min(pos) FILTER (WHERE phrase) AS first_word, max(pos) FILTER (WHERE phrase) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE phrase) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score
  FROM found GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM d LEFT JOIN per USING (rid)
"""

NEGATIVES = r"""
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * c::DOUBLE) FOR c IN embedding] AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([c FOR c IN embedding IF c IS NULL OR isnan(c) OR isinf(c)]) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_dot_product(a.x, b.x)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x) WHERE a.vec_id % 50 = 0),
pos AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM pairs WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
neg AS (
  SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY n.score DESC, n.id) AS rank,
    n.id AS negative_id, positive_score, n.score AS negative_score
  FROM pos JOIN pairs n USING (anchor_id) WHERE NOT n.same AND 50 * positive_score <= 100 * n.score AND 100 * n.score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM neg WHERE rank <= 3
"""
