"""DuckDB SQL for the queries that SQL can express."""

OP9 = r"""
WITH item AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL
), doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), item_window AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, w[i : i + least(13, len(w)) - 1] AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM item WHERE len(w) > 0)
), lengths AS (SELECT DISTINCT n FROM item_window
), doc_window AS (
  SELECT doc_id, n, i, w[i : i + n - 1] AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, lengths WHERE len(w) >= n)
), hit AS (
  SELECT d.doc_id, d.i, d.n, t.item_id FROM doc_window d JOIN item_window t ON d.n = t.n AND d.win = t.win
), words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id
), found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id
)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), FALSE) AS contaminated
FROM doc LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)
"""

OP2 = r"""
WITH RECURSIVE rules (verdict, rule) AS (VALUES
  ('allow', 'com/'), ('block', 'example.com/en/'), ('allow', 'www.example.com/en/'), ('block', 'net/es/'), ('block', 'net/fr/')
), page AS (
  SELECT page_id, html, regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host
  FROM pages
), fitting AS (
  SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM page JOIN rules ON (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1)))
    AND starts_with(path, substr(rule, strpos(rule, '/')))
  GROUP BY page_id
), judged AS (SELECT page.*, rule, verdict FROM page LEFT JOIN fitting USING (page_id)
), hosts AS (
  SELECT host, count(*) AS pages, count(*) FILTER (WHERE verdict = 'allow') AS trusted,
         count(*) FILTER (WHERE verdict = 'block') AS blocked FROM judged GROUP BY host
), link AS (
  SELECT page, src, unnest(x) AS y
  FROM (SELECT row_number() OVER () AS page, host AS src,
               regexp_extract_all(html, '(?i:href|src)\s*=\s*["'']?\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#"''\s<>]+)', 1) AS x FROM judged)
), edge AS (  -- a page counts once for a host, whatever its spellings
  SELECT src, dst, count(DISTINCT page) AS pages
  FROM (SELECT page, src, regexp_replace(split_part(translate(y, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '@', -1), ':[0-9]*$', '') AS dst
        FROM link)
  WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY src, dst
), both_ways AS (SELECT 'trust' AS walk, src, dst, pages FROM edge UNION ALL SELECT 'distrust', dst, src, pages FROM edge
), seeds AS (
  SELECT walk, host, seed, sum(seed) OVER (PARTITION BY walk) AS total FROM (
    SELECT walk, host, CAST(coalesce(CASE walk WHEN 'trust' THEN trusted ELSE blocked END, 0) AS DOUBLE) AS seed
    FROM (SELECT host FROM hosts WHERE host <> '' UNION SELECT src FROM edge UNION SELECT dst FROM edge) h
    CROSS JOIN (VALUES ('trust'), ('distrust')) w (walk) LEFT JOIN hosts USING (host))
), moves AS (
  SELECT walk, src, dst, pages / sum(pages) OVER (PARTITION BY walk, src) AS share FROM both_ways
  UNION ALL SELECT walk, host, host, 0 FROM seeds
), ranks AS (
  SELECT 0 AS step, walk, host, seed AS rank FROM seeds
  UNION ALL
  SELECT step + 1, f.walk, f.host, flow + CASE WHEN total > 0 THEN seed / total * (total - moved) ELSE 0 END
  FROM (
    SELECT r.step, m.walk, m.dst AS host, sum(0.85 * r.rank * m.share) AS flow,
           sum(sum(0.85 * r.rank * m.share)) OVER (PARTITION BY m.walk) AS moved
    FROM ranks r JOIN moves m ON r.walk = m.walk AND r.host = m.src WHERE r.step < 150 GROUP BY r.step, m.walk, m.dst
  ) f JOIN seeds s ON s.walk = f.walk AND s.host = f.host
), scores AS (
  SELECT host, max(rank) FILTER (WHERE walk = 'trust') AS trust, max(rank) FILTER (WHERE walk = 'distrust') AS distrust
  FROM ranks WHERE step = 150 GROUP BY host
)
SELECT page_id, judged.host, path, rule, coalesce(verdict,
  CASE WHEN round(distrust * 100) > round(trust * 100) AND round(distrust * 100) >= round(50 * pages) THEN 'block' ELSE 'allow' END) AS verdict
FROM judged LEFT JOIN hosts ON hosts.host = judged.host LEFT JOIN scores ON scores.host = judged.host
"""

OP5 = r"""
WITH doc AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), triple AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM doc)
), repeated AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM triple WHERE n > 1) GROUP BY doc_id
), line AS (
  SELECT doc_id, l, len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS w,
         length(regexp_replace(l, '[\x20\x09-\x0D]+', '', 'g')) AS c,
         len(regexp_extract_all(l, '[|»›>•]')) AS seps, len(regexp_extract_all(l, '[#*$%&|<>]')) AS syms,
         len(regexp_extract_all(l, '!!')) AS bangs, len(regexp_extract_all(l, '\p{Lu}')) AS caps,
         len(regexp_extract_all(l, '\p{L}')) AS letters
  FROM (SELECT doc_id, unnest(lines) AS l FROM doc)
), lost AS (
  SELECT doc_id, sum(c) AS chars, sum(CASE WHEN
      (seps >= 3 AND 4 * seps >= w)
      OR (w <= 12 AND regexp_matches(lower(l), '(^|[^\p{L}\p{N}])(licensed under|licenced under|all rights reserved|terms of use|terms of service|privacy policy|cookies?|javascript|copyright|lorem ipsum|sign up|sign in|log in|subscribe|click here|read more)($|[^\p{L}\p{N}])'))
      OR 10 * syms > c OR 3 * bangs > w OR (w >= 5 AND 2 * caps > letters) THEN c ELSE 0 END) AS gone
  FROM line GROUP BY doc_id
), base AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM doc LEFT JOIN repeated USING (doc_id)
)
SELECT base.*, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 2 * coalesce(gone, 0) <= coalesce(chars, 0) AS kept
FROM base LEFT JOIN lost USING (doc_id)
"""

OP8 = r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(w[i : i + 49], ' ') AS words
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM doc WHERE len(w) >= 50)
), owned AS (
  SELECT doc_id, i, min(doc_id) OVER (PARTITION BY md5(words)) AS owner FROM win
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM owned WHERE owner < doc_id
), gone_list AS (SELECT doc_id, list(p) AS ps, count(*) AS n FROM gone GROUP BY doc_id
), word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM doc
), kept AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM doc LEFT JOIN gone_list USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

OP10 = r"""
WITH page AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), judged AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS owner FROM page
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id > owner THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id > owner THEN owner END AS refers_to
FROM judged
"""

OP11 = r"""
WITH RECURSIVE bits AS (  -- the table of the checksum's bytes
  SELECT list(c ORDER BY b) AS t
  FROM (SELECT b, list_reduce(list_prepend(b, range(8)), lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS c
        FROM (SELECT unnest(range(256)) AS b))
), doc AS (
  SELECT doc_id, source, lang, n_chars, text,
         CASE WHEN xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
                                   lambda x, b: xor(x >> 8, t[1 + xor(x & 255, b)])), 4294967295) % 5 = 0
              THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS altered
  FROM documents, bits
), fields AS (
  SELECT *, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
            || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head
  FROM doc
), leaf AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         sha256(head || coalesce(strlen(altered) || ':' || altered, '-')) AS checked,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST) - 1 AS i
  FROM fields
), tree(source, level, i, h, m) AS (
  SELECT source, 0, i, leaf, count(*) OVER (PARTITION BY source) FROM leaf
  UNION ALL SELECT source, any_value(level) + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)), (any_value(m) + 15) // 16
  FROM tree WHERE m > 1 GROUP BY source, i // 16
), top(level, i, h, m, source) AS (
  SELECT 0, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1, h, count(*) OVER (), source FROM tree WHERE m = 1
  UNION ALL SELECT any_value(level) + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)), (any_value(m) + 15) // 16, NULL
  FROM top WHERE m > 1 GROUP BY i // 16
), node AS (  -- one numbering of levels: the source's own, then 100 and on
  SELECT source, level, i, h FROM tree WHERE m > 1
  UNION ALL SELECT NULL, 100 + level, i, h FROM top WHERE m > 1
), step AS (  -- each leaf's way up
  SELECT doc_id, leaf.source, tree.level, leaf.i // (16 ** tree.level)::BIGINT AS i
  FROM leaf JOIN (SELECT DISTINCT source, level FROM tree WHERE m > 1) AS tree ON tree.source IS NOT DISTINCT FROM leaf.source
  UNION ALL
  SELECT doc_id, leaf.source, 100 + up.level, top.i // (16 ** up.level)::BIGINT
  FROM leaf JOIN top ON top.level = 0 AND top.source IS NOT DISTINCT FROM leaf.source
       CROSS JOIN (SELECT DISTINCT level FROM top WHERE m > 1) AS up
), run AS (
  SELECT step.doc_id, step.level,
         coalesce(string_agg(h, '' ORDER BY node.i) FILTER (node.i < step.i), '') AS before,
         coalesce(string_agg(h, '' ORDER BY node.i) FILTER (node.i > step.i), '') AS after
  FROM step JOIN node ON node.level = step.level AND node.i // 16 = step.i // 16
       AND (node.level >= 100 OR node.source IS NOT DISTINCT FROM step.source)
  GROUP BY step.doc_id, step.level
), path AS (
  SELECT doc_id, sha256(string_agg(before || after, '' ORDER BY level)) AS proof_sha256,
         list({'before': before, 'after': after} ORDER BY level) AS steps
  FROM run GROUP BY doc_id
), climb AS (
  SELECT doc_id, checked AS h, coalesce(steps, []) AS steps, 1 AS k FROM leaf LEFT JOIN path USING (doc_id)
  UNION ALL SELECT doc_id, sha256(steps[k].before || h || steps[k].after), steps, k + 1 FROM climb WHERE k <= len(steps)
)
SELECT leaf.doc_id, leaf, tree.h AS subroot, top.h AS root, coalesce(proof_sha256, sha256('')) AS proof_sha256,
       climb.h AS folded_root, climb.h = top.h AS verified
FROM leaf JOIN tree ON tree.m = 1 AND tree.source IS NOT DISTINCT FROM leaf.source JOIN top ON top.m = 1
     JOIN climb ON climb.doc_id = leaf.doc_id AND k = len(steps) + 1 LEFT JOIN path ON path.doc_id = leaf.doc_id
"""

OP12 = r"""
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
w AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY x ORDER BY doc_id, i) AS k
  FROM (SELECT doc_id, i, b[i:i + 99] AS x FROM (SELECT doc_id, b, unnest(range(1, octet_length(b) - 98)) AS i FROM d))),
g AS (SELECT doc_id, i, i > lag(i, 1, -1000) OVER (PARTITION BY doc_id ORDER BY i) + 100 AS cut FROM w WHERE k > 1),
s AS (
  SELECT doc_id, min(i) AS a, max(i) + 99 AS z
  FROM (SELECT doc_id, i, sum(cut::INT) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM g) GROUP BY doc_id, run),
k AS (  -- what is left: before each removed run, and after the last
  SELECT doc_id, a, z, 1 + lag(z, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS f, a - 1 AS t FROM s
  UNION ALL SELECT doc_id, octet_length(b) + 1, octet_length(b), 1 + coalesce(z, 0), octet_length(b)
  FROM d LEFT JOIN (SELECT doc_id, max(z) AS z FROM s GROUP BY doc_id) USING (doc_id))
SELECT doc_id, any_value(octet_length(b))::BIGINT AS n_bytes, sum(z - a + 1)::BIGINT AS n_removed, (count(*) - 1)::BIGINT AS n_spans,
       sha256(unhex(string_agg(hex(b[f:t]), '' ORDER BY a))) AS kept_sha256
FROM d JOIN k USING (doc_id) GROUP BY doc_id
"""

OP13 = r"""
WITH RECURSIVE crc AS (  -- the table of the checksum's bytes
  SELECT list(c ORDER BY b) AS t
  FROM (SELECT b, list_reduce(list_prepend(b, range(8)), lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS c
        FROM (SELECT unnest(range(256)) AS b))
), run AS (
  SELECT doc_id, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS r
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')) AS r FROM documents)
), hashed AS (
  SELECT r, n, xor(list_reduce(list_prepend(4294967295, bytes), lambda x, b: xor(x >> 8, t[1 + xor(x & 255, b)])), 4294967295) AS h
  FROM (SELECT doc_id, r, count(*) AS n,
               list_transform(range(1, octet_length(encode(doc_id || ':' || r)) + 1),
                              lambda k: ('0x' || hex(encode(doc_id || ':' || r)[k:k]))::BIGINT) AS bytes
        FROM run GROUP BY doc_id, r), crc
), word AS (
  SELECT word, sum(n)::BIGINT AS n
  FROM (SELECT CASE WHEN h % 31 = 0 THEN r[:h % length(r)] || r[h % length(r) + 2:] ELSE r END AS word, n FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), less AS (  -- every word without one of its code points
  SELECT word, n, i, word[:i] || word[i + 2:] AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM word)
), near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM less a JOIN word b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM less a JOIN word b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, min({'less': -other_n, 'form': encode(other)}) AS b FROM near GROUP BY word
), formed AS (
  SELECT word.word, n, coalesce(n_near, 0) AS n_near,
         CASE WHEN -b.less >= 10 * n THEN decode(b.form) END AS form, CASE WHEN -b.less >= 10 * n THEN -b.less END AS form_n
  FROM word LEFT JOIN best USING (word)
), walk AS (
  SELECT word, word AS at FROM formed
  UNION ALL SELECT walk.word, f.form FROM walk JOIN formed f ON f.word = walk.at WHERE f.form IS NOT NULL
), root AS (
  SELECT walk.word, walk.at AS root FROM walk JOIN formed f ON f.word = walk.at WHERE f.form IS NULL
)
SELECT formed.word, form, root, n, n_near::BIGINT AS n_near, form_n::BIGINT AS form_n FROM formed JOIN root USING (word)
"""

ORACLE_SQL: dict[str, str] = {
    "op2_url_filter": OP2,
    "op5_quality_rules": OP5,
    "op8_substring_dedup": OP8,
    "op9_decontamination": OP9,
    "op10_warc": OP10,
    "op11_merkle_manifest": OP11,
    "op12_suffix_dedup": OP12,
    "op13_spelling_variants": OP13,
}
