"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["op1_vectors"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9
), reach AS (
  SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
), degree AS (SELECT x, count(*) AS n FROM links GROUP BY x), lowest AS (SELECT x, min(y) AS m FROM reach GROUP BY x)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id, vec_id = least(vec_id, coalesce(m, vec_id)) AS kept
FROM embeddings LEFT JOIN degree d ON d.x = vec_id LEFT JOIN lowest l ON l.x = vec_id
"""

ORACLE["op2_quality_rules"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS lang FROM documents
), w AS (
  SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
         regexp_replace(t, '\p{Ll}+', '', 'g') AS r1 FROM d
), c1 AS (SELECT *, len(words) AS n, regexp_replace(r1, '[\x20\x09-\x0D]+', '', 'g') AS r2 FROM w
), c2 AS (SELECT *, regexp_replace(r2, '\p{Lu}+', '', 'g') AS r3 FROM c1
), c3 AS (SELECT *, regexp_replace(r3, '[#*$%&|<>]+', '', 'g') AS r4 FROM c2
), c4 AS (SELECT *, regexp_replace(r4, '\p{Nd}+', '', 'g') AS r5 FROM c3
), c5 AS (SELECT *, regexp_replace(r5, '\p{P}+', '', 'g') AS r6 FROM c4
), counted AS (
  SELECT doc_id, lang, t, words, n, length(t) AS size,
         [length(t) - length(r1), length(r1) - length(r2), length(r2) - length(r3), length(r3) - length(r4),
          length(r4) - length(r5), length(r5) - length(r6), length(r6)] AS classes,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM c5
), cells AS (
  SELECT doc_id, lang, size, unnest(classes) AS c, unnest(range(1, 8)) AS i FROM counted
), refs AS (
  SELECT lang, i, sum(c) / sum(sum(c)) OVER (PARTITION BY lang) AS q FROM cells GROUP BY lang, i
), class_parts AS (
  SELECT doc_id, c / size::DOUBLE AS p, q FROM cells JOIN refs USING (lang, i) WHERE size > 0
), class_distance AS (
  SELECT doc_id, sqrt(greatest(0, sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2)) AS cd
  FROM class_parts GROUP BY doc_id
), each AS (
  SELECT doc_id, lang, lower(unnest(words)) AS word FROM counted
), corpus AS (
  SELECT lang, word, count(*) AS k FROM each GROUP BY lang, word
), shares AS (
  SELECT lang, word, k, sum(k) OVER (PARTITION BY lang) AS total FROM corpus
), common AS (
  SELECT lang, word, k / total::DOUBLE AS q FROM shares WHERE k >= total * 0.002::DOUBLE
), covered AS (
  SELECT lang, sum(q) AS s FROM common GROUP BY lang
), runs AS (
  SELECT doc_id, e.lang, q, count(*) AS k FROM each e JOIN common USING (lang, word) GROUP BY doc_id, e.lang, word, q
), run_sums AS (
  SELECT doc_id, sum(p * log2(2 * p / (p + q)) + q * log2(2 * q / (p + q))) / 2 AS part, sum(q) AS seen, sum(k) AS found
  FROM (SELECT r.doc_id, r.q, r.k, r.k / n::DOUBLE AS p FROM runs r JOIN counted USING (doc_id)) GROUP BY doc_id
), rests AS (
  SELECT doc_id, coalesce(part, 0) AS part, coalesce(seen, 0) AS seen, coalesce(s, 0) AS s,
         1 - coalesce(found, 0) / n::DOUBLE AS p, greatest(0, 1 - coalesce(s, 0)) AS q
  FROM counted LEFT JOIN run_sums USING (doc_id) LEFT JOIN covered USING (lang) WHERE n > 0
), word_distance AS (
  SELECT doc_id, sqrt(greatest(0, part + (s - seen) / 2 + (CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
         + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2)) AS wd FROM rests
), grams AS (
  SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g
  FROM (SELECT doc_id, words, unnest(range(1, n - 1)) AS i FROM counted WHERE n >= 3)
), twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS k FROM grams) WHERE k > 1
), repeated AS (
  SELECT doc_id, count(DISTINCT j) AS r FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM twice) GROUP BY doc_id
), base AS (
  SELECT doc_id, n::BIGINT AS n_words, (size - classes[2])::BIGINT AS word_chars, classes[4]::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(r, 0)::BIGINT AS n_repeat_words, size, cd, wd
  FROM counted LEFT JOIN repeated USING (doc_id) LEFT JOIN class_distance USING (doc_id) LEFT JOIN word_distance USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND (size < 200 OR cd <= 0.25) AND (n_words < 100 OR wd <= 0.36) AS kept
FROM base
"""

ORACLE["op5_url_filter"] = r"""
WITH cut AS (
  SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
         regexp_extract(rest, '^[^?#]*\?([^#]*)', 1) AS query
  FROM cut
), clean AS (
  SELECT page_id, host, path,
         regexp_replace(array_to_string(list_filter(string_split(query, '&'), lambda x: NOT regexp_full_match(x, '(utm_[a-z]+|ref|gclid|fbclid)=.*')), '&'), '^&', '') AS kept
  FROM parts
), canon AS (
  SELECT page_id, host, path, CASE WHEN host <> '' THEN regexp_replace(host, '^www\.', '') || regexp_replace(path, '/+$', '')
         || CASE WHEN kept <> '' THEN '?' || kept ELSE '' END END AS curl
  FROM clean
), listed AS (
  SELECT DISTINCT curl FROM canon WHERE regexp_matches(host, '(^|[.-])(ads|adult|bets|casino|pills|spam)([.-]|$)')
), ruled AS (
  SELECT page_id, host, path, curl,
         CASE WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
              WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
              WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
              WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
              WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM canon
)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule,
       CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN listed.curl IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM ruled LEFT JOIN listed ON ruled.curl = listed.curl
"""

ORACLE["op13_source_divergence"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS doc, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents
), tokens AS (
  SELECT doc, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x{00}-\x{40}\x{5B}-\x{60}\x{7B}-\x{7F}]+')) AS term FROM d
), kept AS (
  SELECT lang, term FROM tokens GROUP BY lang, term HAVING count(DISTINCT doc) >= 30
), groups AS (SELECT DISTINCT lang, source FROM d
), cells AS (
  SELECT g.lang, g.source, k.term, count(t.term)::HUGEINT AS n
  FROM groups g JOIN kept k ON k.lang = g.lang
  LEFT JOIN tokens t ON t.lang = g.lang AND t.source = g.source AND t.term = k.term GROUP BY ALL
), shares AS (
  SELECT lang, source, term, n,
         1 + 1000000000 * (n + 5) // (sum(n) OVER (PARTITION BY lang, source) + 5 * count(*) OVER (PARTITION BY lang, source)) AS p
  FROM cells
), whole AS (
  SELECT lang, term, 1 + 1000000000 * (sum(n) + 5) // (sum(sum(n)) OVER (PARTITION BY lang) + 5 * count(*) OVER (PARTITION BY lang)) AS q
  FROM cells GROUP BY lang, term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY a.lang, a.source, b.source
), found AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL
  SELECT lang, source, 'term', term, (p - q)::BIGINT FROM shares JOIN whole USING (lang, term) WHERE n > 0 AND p > q
)
SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM found
QUALIFY part = 'pair' OR rank <= 50
"""

ORACLE["op11_conversations"] = r"""
WITH RECURSIVE named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations
), summed AS (
  SELECT *, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(k) + 1), lambda i: ascii(substr(k, i, 1))::BIGINT)),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: xor(v >> 1, (v & 1) * 3988292384::BIGINT + z)))) % 20 AS fault
  FROM named
), hit AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
         CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, copy
  FROM summed, LATERAL (SELECT unnest(range(CASE WHEN fault = 3 THEN 2 ELSE 1 END)) AS copy) WHERE fault <> 0
), placed AS (
  SELECT *, row_number() OVER w AS pos, left(role, 1) AS initial, lag(left(role, 1)) OVER w AS before,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS seen
  FROM hit WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)
), judged AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN seen THEN 'duplicate'
                 WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault
  FROM placed
), figures AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count_if(fault = 'blank') AS blank,
         count_if(fault = 'duplicate') AS duplicate, count_if(fault = 'truncated') AS truncated,
         count_if(before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(pos) AS n
  FROM judged GROUP BY conv_id
), added(top, price, mark, upto, lines) AS (
  VALUES ('-', 0, '', '-', ''), ('-', 3, 'I', 'u', 'user:' || chr(10)), ('-', 6, 'II', 'a', 'user:' || chr(10) || 'assistant:' || chr(10)),
         ('s', 0, '', 's', ''), ('s', 3, 'I', 'u', 'user:' || chr(10)), ('s', 6, 'II', 'a', 'user:' || chr(10) || 'assistant:' || chr(10)),
         ('u', 0, '', 'u', ''), ('u', 3, 'I', 'a', 'assistant:' || chr(10)), ('a', 0, '', 'a', ''), ('a', 3, 'I', 'u', 'user:' || chr(10))
), follows(top, next) AS (VALUES ('-', 's'), ('-', 'u'), ('s', 'u'), ('u', 'a'), ('a', 'u')
), parse AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS pos, '-' AS top, 0::BIGINT AS cost, '' AS audit, '' AS lines FROM figures
  UNION ALL
  SELECT conv_id, pos, top, cost, audit, lines FROM (
    SELECT p.conv_id, j.pos, e.next AS top, p.cost + e.price AS cost, p.audit || e.mark AS audit, p.lines || e.lines AS lines
    FROM parse p JOIN judged j ON j.conv_id IS NOT DISTINCT FROM p.conv_id AND j.pos = p.pos + 1,
    LATERAL (
      SELECT p.top AS next, 4 AS price, 'D' AS mark, '' AS lines
      UNION ALL
      SELECT f.next, x.price + CASE WHEN j.fault = 'truncated' THEN 3 ELSE 0 END + CASE WHEN f.next = j.initial THEN 0 ELSE 3 END,
             x.mark || CASE WHEN f.next = j.initial THEN 'K' ELSE 'R' END,
             x.lines || CASE WHEN f.next = j.initial THEN j.role WHEN f.next = 'u' THEN 'user' ELSE 'assistant' END || ':' || j.text || chr(10)
      FROM added x JOIN follows f ON f.top = x.upto
      WHERE x.top = p.top AND j.fault NOT IN ('blank', 'duplicate') AND (f.next = j.initial OR f.next IN ('u', 'a'))
    ) e
  ) QUALIFY row_number() OVER (PARTITION BY conv_id, top ORDER BY cost, audit) = 1
), ended AS (
  SELECT p.conv_id, p.cost + x.price AS cost, p.audit || x.mark AS audit, p.lines || x.lines AS lines
  FROM parse p JOIN figures f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.n = p.pos
  JOIN added x ON x.top = p.top AND (x.upto = 'a' OR (x.upto = '-' AND x.price = 0))
  QUALIFY row_number() OVER (PARTITION BY p.conv_id ORDER BY p.cost + x.price, p.audit || x.mark) = 1
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
       sha256(coalesce(left(lines, length(lines) - 1), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN figures f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
"""
