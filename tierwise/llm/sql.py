"""DuckDB SQL of the queries that SQL can express. Values are written out here, apart from the operators'."""

TOPK = '''
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM (SELECT * FROM v WHERE vec_id % 50 = 0) a, v b WHERE a.vec_id <> b.vec_id AND len(a.q) = len(b.q))
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM s)
WHERE place <= 5
'''

WARC = '''
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
r AS (SELECT h, max(page_id) AS last FROM p GROUP BY h)
SELECT p.page_id, CAST(strlen(p.html) AS BIGINT) AS payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + ((
      ((strpos('0123456789abcdef', substr(p.h, 1 + (5 * i) // 4, 1)) - 1) * 16
       + strpos('0123456789abcdef', substr(p.h, 2 + (5 * i) // 4, 1)) - 1) >> (3 - (5 * i) % 4)) & 31) AS BIGINT), 1)),
    'string_agg', '') AS payload_digest,
  CASE WHEN p.page_id IS NOT DISTINCT FROM r.last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN p.page_id IS NOT DISTINCT FROM r.last THEN NULL ELSE r.last END AS refers_to
FROM p JOIN r ON p.h = r.h
'''

# Templates: base phrases (whole only) and notices (0.8 of their words).
LICENSES = '''
WITH templates(label, phrase, is_base) AS (VALUES
  ('cc-by', 'cc by', true),
  ('gpl', 'general public license', true),
  ('reserved', 'all rights reserved', true),
  ('apache-2.0', 'licensed under the apache license version 2 0', false),
  ('apache-2.0', 'you may not use this file except in compliance with the license you may obtain a copy of the license at', false),
  ('bsd', 'redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met', false),
  ('cc-by-nc', 'licensed under cc by nc 4 0', false),
  ('cc-by-sa', 'licensed under cc by sa 4 0', false),
  ('cc-by', 'this work is licensed under a creative commons attribution 4 0 international license', false),
  ('gpl-3.0', 'this work is licensed under the gnu general public license version 3', false),
  ('gpl', 'this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation', false),
  ('isc', 'permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted', false),
  ('mit', 'released under the mit license', false),
  ('mit', 'permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files', false),
  ('mpl-2.0', 'this source code form is subject to the terms of the mozilla public license v 2 0', false)),
t AS (SELECT row_number() OVER () AS t_id, label, is_base, string_split(phrase, ' ') AS w FROM templates),
ts AS (
  SELECT t_id, label, is_base, len(w) AS t_len, least(3, len(w)) AS k, u.i - 1 AS t,
         array_to_string(w[u.i:u.i + least(3, len(w)) - 1], ' ') AS seed
  FROM t, LATERAL (SELECT unnest(range(1, len(w) - least(3, len(w)) + 2)) AS i) u),
d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
x AS (SELECT rid, unnest(w) AS a, generate_subscripts(w, 1) AS p FROM d),
y AS (
  SELECT rid, p - 1 AS p, a || ' ' || lead(a) OVER o AS s2, a || ' ' || lead(a) OVER o || ' ' || lead(a, 2) OVER o AS s3
  FROM x WINDOW o AS (PARTITION BY rid ORDER BY p)),
hits AS (
  SELECT rid, t_id, label, is_base, t_len, k, p - t AS diag, t
  FROM y JOIN ts ON (k = 2 AND seed = s2) OR (k = 3 AND seed = s3)),
diags AS (
  SELECT rid, t_id, diag, any_value(is_base) AS is_base,
         diag - lag(diag) OVER (PARTITION BY rid, t_id ORDER BY diag) AS gap
  FROM hits GROUP BY rid, t_id, diag),
cuts AS (
  SELECT rid, t_id, diag, sum(CASE WHEN is_base OR gap IS NULL OR gap > 4 THEN 1 ELSE 0 END)
         OVER (PARTITION BY rid, t_id ORDER BY diag) AS span
  FROM diags),
covers AS (
  SELECT rid, t_id, span, min(diag) AS start, any_value(label) AS label, any_value(is_base) AS is_base,
         count(DISTINCT place) / any_value(t_len) AS cover
  FROM (SELECT h.*, c.span, unnest(range(h.t, h.t + h.k)) AS place
        FROM hits h JOIN cuts c ON h.rid = c.rid AND h.t_id = c.t_id AND h.diag = c.diag)
  GROUP BY rid, t_id, span),
found AS (
  SELECT rid, count(*) FILTER (is_base AND cover >= 1) AS n_base,
         min(start) FILTER (is_base AND cover >= 1) AS first_word, max(start) FILTER (is_base AND cover >= 1) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (is_base AND cover >= 1) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label)
           FILTER ((is_base AND cover >= 1) OR (NOT is_base AND cover >= 0.8)) AS labels,
         max(cover) AS score,
         count(*) FILTER ((is_base AND cover >= 1) OR (NOT is_base AND cover >= 0.8)) AS n_spans
  FROM covers GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word,
       CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(score, 0.0) AS score, coalesce(n_spans, 0) AS n_spans
FROM d LEFT JOIN found ON d.rid = found.rid
'''


def kmeans(k: int = 8, rounds: int = 10) -> str:
    '''k-means on integers, each round written out. A row per component; rows are told apart by number.'''
    parts = ['''
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
x AS MATERIALIZED (SELECT r, unnest(q) AS a, generate_subscripts(q, 1) AS d FROM v),
c0 AS MATERIALIZED (
  SELECT c, unnest(q) AS a, generate_subscripts(q, 1) AS d
  FROM (SELECT row_number() OVER (ORDER BY sha256('3:' || CAST(vec_id AS VARCHAR)) NULLS LAST, q) - 1 AS c, q FROM v) WHERE c < %d)''' % k]
    for i in range(rounds + 1):
        parts.append(f'''
n{i} AS MATERIALIZED (
  SELECT r, arg_min(c, s * 100 + c) AS c, min(s) AS s
  FROM (SELECT x.r, t.c, CAST(sum((x.a - t.a) * (x.a - t.a)) AS BIGINT) AS s FROM x JOIN c{i} t ON x.d = t.d GROUP BY x.r, t.c) GROUP BY r)''')
        if i < rounds:
            parts.append(f'''
c{i + 1} AS MATERIALIZED (
  SELECT t.c, t.d, coalesce(m.a, t.a) AS a
  FROM c{i} t LEFT JOIN (
    SELECT c, d, CAST((CAST(sum(a) AS BIGINT) - ((CAST(sum(a) AS BIGINT) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS a
    FROM x JOIN n{i} ON x.r = n{i}.r GROUP BY c, d) m
  ON t.c = m.c AND t.d = m.d)''')
    return ','.join(parts) + f'''
SELECT v.vec_id, CAST(n.c AS INTEGER) AS cluster, n.s AS distance, CAST(sum(n.s) OVER (PARTITION BY n.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(n.s) OVER () AS BIGINT) AS inertia, h.sha AS centroid_sha256
FROM n{rounds} n JOIN v ON n.r = v.r
JOIN (SELECT c, sha256(string_agg(CAST(a AS VARCHAR), ',' ORDER BY d)) AS sha FROM c{rounds} GROUP BY c) h ON n.c = h.c
'''


# CRC-32 (polynomial 0xEDB88320, lowest power first) byte by byte, from a table of 256 values made by its rule.
IMPORTANCE = '''
WITH tab AS MATERIALIZED (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_concat([i], range(8)), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v
    FROM (SELECT unnest(range(256)) AS i))),
texts AS MATERIALIZED (
  SELECT row_number() OVER () AS r, true AS doc, doc_id, text FROM documents
  UNION ALL SELECT -row_number() OVER () AS r, false, NULL, text FROM benchmark),
w AS MATERIALIZED (
  SELECT r, doc, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM texts),
f AS MATERIALIZED (SELECT r, doc, unnest(w) AS word FROM w),
b AS MATERIALIZED (
  SELECT word, xor(list_reduce(list_concat([4294967295], list_transform(range(strlen(word)), lambda i:
      (strpos('0123456789ABCDEF', substr(hex(encode(word)), 2 * i + 1, 1)) - 1) * 16
      + strpos('0123456789ABCDEF', substr(hex(encode(word)), 2 * i + 2, 1)) - 1)),
    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT word FROM f), tab),
n AS MATERIALIZED (
  SELECT bucket, count(*) FILTER (WHERE doc) AS s, count(*) FILTER (WHERE NOT doc) AS t FROM f JOIN b USING (word) GROUP BY bucket),
g AS MATERIALIZED (
  SELECT bucket, CAST(floor(1000 * ln(CAST(t + 1 AS DOUBLE) * CAST(s_all + 10000 AS DOUBLE) / (CAST(s + 1 AS DOUBLE) * CAST(t_all + 10000 AS DOUBLE)))) AS BIGINT) AS gain
  FROM n, (SELECT sum(s) AS s_all, sum(t) AS t_all FROM n)),
wt AS (SELECT r, CAST(sum(gain) AS BIGINT) AS weight FROM f JOIN b USING (word) JOIN g USING (bucket) WHERE doc GROUP BY r),
sc AS MATERIALIZED (
  SELECT w.r, w.doc_id, CAST(len(w.w) AS BIGINT) AS n_features, coalesce(wt.weight, 0) AS weight,
    coalesce(wt.weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || coalesce(CAST(w.doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM w LEFT JOIN wt ON w.r = wt.r WHERE w.doc),
k AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS place, count(*) OVER () AS n_all
      FROM sc WHERE n_features >= 20)
SELECT sc.doc_id, sc.n_features, sc.weight, sc.score, CASE WHEN k.place <= 10 * k.n_all // 100 THEN k.place END AS rank
FROM sc LEFT JOIN k ON sc.r = k.r
'''
