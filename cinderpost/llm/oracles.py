"""The results of the operators as DuckDB SQL, where SQL can express them."""

ORACLES = {}

ORACLES["op1_mix_sources"] = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    ('0x' || substr(md5('mix-1|' || coalesce(doc_id::VARCHAR, '') || '|' || coalesce(md5(text), '')), 1, 15))::BIGINT AS h
  FROM documents),
sums AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w,
    2.0::DOUBLE * source_size AS cap FROM sums),
steps AS (
  SELECT *, coalesce(sum(cap) OVER before, 0.0) AS used, sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open,
    sum(source_size) OVER () * 1.5::DOUBLE AS amount, row_number() OVER (ORDER BY cap / w, source NULLS LAST) AS rn
  FROM weighed WINDOW before AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
levels AS (SELECT arg_min((amount - used) / open, rn) FILTER (WHERE cap / w > (amount - used) / open) AS level FROM steps),
targets AS (
  SELECT source, source_size, CASE WHEN level IS NULL OR cap <= w * level THEN cap ELSE w * level END AS target
  FROM weighed, levels),
shares AS (
  SELECT *, floor(target / greatest(source_size, 1))::BIGINT AS whole,
    target - floor(target / greatest(source_size, 1))::BIGINT * source_size AS part FROM targets),
docs AS (
  SELECT d.*, s.source_size, s.target, s.whole, s.part, d.size * 256 > s.source_size AS big
  FROM sized d JOIN shares s ON d.source IS NOT DISTINCT FROM s.source),
runs AS (
  SELECT source, big, h, source_size, part, sum(size) AS s,
    sum(sum(size)) OVER (PARTITION BY source, big ORDER BY h) AS upto,
    sum(sum(size)) OVER (PARTITION BY source, big) AS mass
  FROM docs GROUP BY source, big, h, source_size, part),
large AS (SELECT source, h, upto - s / 2 <= mass / source_size * part AS chosen, s FROM runs WHERE big),
held AS (SELECT source, sum(s) FILTER (WHERE chosen) AS held FROM large GROUP BY source),
small AS (
  SELECT r.source, r.h, r.upto - r.s / 2 <= r.part - coalesce(k.held, 0) AS chosen
  FROM runs r LEFT JOIN held k ON r.source IS NOT DISTINCT FROM k.source WHERE NOT big)
SELECT d.doc_id, d.source, d.size, d.source_size, d.target,
  (d.size * (d.whole + CASE WHEN coalesce(l.chosen, s.chosen) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM docs d
LEFT JOIN large l ON d.big AND d.source IS NOT DISTINCT FROM l.source AND d.h = l.h
LEFT JOIN small s ON NOT d.big AND d.source IS NOT DISTINCT FROM s.source AND d.h = s.h
"""

ORACLES["op5_chat_preferences"] = r"""
WITH turns AS (
  SELECT DISTINCT conv_id // 2 AS pair_id, conv_id % 2 = 0 AS chosen, turn,
    coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY pair_id, chosen ORDER BY turn NULLS LAST, role, text) AS i FROM turns),
sizes AS (
  SELECT pair_id, count(*) FILTER (WHERE chosen) AS nc, count(*) FILTER (WHERE NOT chosen) AS nr
  FROM placed GROUP BY pair_id),
breaks AS (
  SELECT coalesce(c.pair_id, r.pair_id) AS pair_id, min(coalesce(c.i, r.i)) - 1 AS n
  FROM (SELECT * FROM placed WHERE chosen) c
  FULL JOIN (SELECT * FROM placed WHERE NOT chosen) r ON c.pair_id = r.pair_id AND c.i = r.i
  WHERE c.i IS NULL OR r.i IS NULL OR c.role <> r.role OR c.text <> r.text GROUP BY ALL),
cut AS (SELECT s.*, coalesce(b.n, s.nc) AS n_common FROM sizes s LEFT JOIN breaks b USING (pair_id)),
shown AS (
  SELECT p.*, n_common,
    '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS shown,
    CASE WHEN role = 'assistant'
      THEN '-' || (13 + length(role)) || '+' || (length(text) + 11)
      ELSE '-' || (24 + length(role) + length(text)) END AS stretch
  FROM placed p JOIN cut USING (pair_id))
SELECT c.pair_id, c.n_common::INT AS n_common,
  coalesce(string_agg(shown, '' ORDER BY i) FILTER (WHERE chosen AND i <= c.n_common), '') AS prompt,
  coalesce(string_agg(shown, '' ORDER BY i) FILTER (WHERE chosen AND i > c.n_common), '') AS chosen,
  coalesce(string_agg(shown, '' ORDER BY i) FILTER (WHERE NOT chosen AND i > c.n_common), '') AS rejected,
  coalesce(string_agg(stretch, '' ORDER BY i) FILTER (WHERE chosen AND i > c.n_common), '') AS chosen_mask,
  coalesce(string_agg(stretch, '' ORDER BY i) FILTER (WHERE NOT chosen AND i > c.n_common), '') AS rejected_mask,
  any_value(nc > c.n_common AND nr > c.n_common) AS usable
FROM cut c JOIN shown s ON s.pair_id = c.pair_id GROUP BY c.pair_id, c.n_common
"""

ORACLES["op9_decontaminate"] = r"""
WITH item_words AS (
  SELECT DISTINCT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark WHERE text IS NOT NULL),
windows AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS n, array_to_string(ws[p:p + least(len(ws), 10) - 1], ' ') AS win
  FROM (SELECT *, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS p FROM item_words WHERE len(ws) > 0)),
doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents),
lengths AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, n, p, array_to_string(ws[p:p + n - 1], ' ') AS win
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS p FROM doc_words, lengths WHERE len(ws) >= n)),
hits AS (SELECT p.doc_id, p.p, p.n, w.item_id FROM places p JOIN windows w ON p.win = w.win AND p.n = w.n),
covered AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS pos FROM hits) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM hits GROUP BY doc_id)
SELECT d.doc_id, len(d.ws)::BIGINT AS n_words, coalesce(c.n_hit, 0)::BIGINT AS n_hit, coalesce(n.n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(n.ids, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN covered c ON d.doc_id = c.doc_id LEFT JOIN named n ON d.doc_id = n.doc_id
"""

LINE_DEDUP = r"""
WITH texts AS (SELECT doc_id, CASE WHEN text IS NULL THEN [] ELSE string_split(text, chr(10)) END AS ls, text FROM documents),
raw AS (SELECT doc_id, unnest(range(0, len(ls))) AS pos, unnest(ls) AS line FROM texts),
counted AS (SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS w FROM raw),
filled AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS i FROM counted WHERE w > 0),
ahead AS (
  SELECT doc_id, i, list(w) OVER f AS ws, list(line) OVER f AS ls, list(pos) OVER f AS ps
  FROM filled WINDOW f AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND {least} FOLLOWING)),
behind AS (
  SELECT doc_id, i, list(w) OVER f AS ws, list(line) OVER f AS ls, list(pos) OVER f AS ps
  FROM filled WINDOW f AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN {least} PRECEDING AND CURRENT ROW)),
begun AS (
  SELECT *, list_min(list_filter(range(1, len(ws) + 1), lambda n: list_sum(ws[1:n])  >= {least})) AS n FROM ahead),
ended AS (
  SELECT *, list_min(list_filter(range(1, len(ws) + 1), lambda n: list_sum(ws[len(ws) - n + 1:len(ws)])  >= {least})) AS n FROM behind),
runs AS (
  SELECT doc_id, i, ls[1:n] AS run, i + n - 1 AS j FROM begun WHERE n IS NOT NULL
  UNION
  SELECT doc_id, i - n + 1, ls[len(ls) - n + 1:len(ls)], i FROM ended WHERE n IS NOT NULL),
placed AS (SELECT *, first_value((doc_id, i)) OVER (PARTITION BY run ORDER BY doc_id, i) AS origin FROM runs),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, j + 1)) AS i FROM placed WHERE (doc_id, i) > origin),
worded AS (
  SELECT f.doc_id, f.pos, g.i IS NOT NULL AS gone FROM filled f LEFT JOIN gone g ON f.doc_id = g.doc_id AND f.i = g.i),
sided AS (
  SELECT r.doc_id, r.pos, r.line,
    last_value(w.gone IGNORE NULLS) OVER (PARTITION BY r.doc_id ORDER BY r.pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    AND first_value(w.gone IGNORE NULLS) OVER (PARTITION BY r.doc_id ORDER BY r.pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS removed
  FROM raw r LEFT JOIN worded w ON r.doc_id = w.doc_id AND r.pos = w.pos),
marked AS (
  SELECT *, lag(coalesce(removed, false), 1, false) OVER (PARTITION BY doc_id ORDER BY pos) AS before
  FROM (SELECT doc_id, pos, line, coalesce(removed, false) AS removed FROM sided))
SELECT t.doc_id, len(t.ls)::BIGINT AS n_lines,
  (count(*) FILTER (WHERE removed))::BIGINT AS n_removed,
  (count(*) FILTER (WHERE removed AND NOT before))::BIGINT AS n_runs,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT removed), '')) AS kept_sha256
FROM texts t LEFT JOIN marked m ON t.doc_id = m.doc_id GROUP BY t.doc_id, t.ls
"""

# Runs of three words or more, and of one.
ORACLES["op6_line_dedup"] = LINE_DEDUP.replace("{least}", "3")
ORACLES["op6_line_dedup_common"] = LINE_DEDUP.replace("{least}", "1")

ORACLES["op3_exact_top_k"] = r"""
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, rank::INT AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""

ORACLES["op12_minhash_dedup"] = r"""
WITH RECURSIVE words AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
grams AS (
  SELECT DISTINCT r, array_to_string(ws[p:p + least(len(ws), 5) - 1], ' ') AS g, least(len(ws), 5) AS k
  FROM (SELECT r, ws, unnest(range(1, len(ws) - least(len(ws), 5) + 2)) AS p FROM words WHERE len(ws) > 0)),
sizes AS (SELECT r, count(*) AS n FROM grams GROUP BY r),
common AS (
  SELECT a.r AS x, b.r AS y, count(*) AS c FROM grams a JOIN grams b ON a.g = b.g AND a.k = b.k AND a.r <> b.r GROUP BY ALL),
links AS (
  SELECT x, y FROM common JOIN sizes s ON s.r = x JOIN sizes t ON t.r = y WHERE 100 * c >= 85 * (s.n + t.n - c)),
reached AS (
  SELECT r AS x, r AS y FROM words
  UNION
  SELECT reached.x, links.y FROM reached JOIN links ON reached.y = links.x),
classes AS (SELECT x, min(doc_id) AS component_id FROM reached JOIN words ON words.r = y GROUP BY x)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept
FROM words JOIN classes ON classes.x = words.r LEFT JOIN sizes ON sizes.r = words.r
"""

ORACLES["op13_collocations"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
places AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM words),
counted AS (
  SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase, any_value(ws[i:i + k - 1]) AS ws, count(*)::HUGEINT AS f
  FROM places, (VALUES (1), (2), (3)) AS lengths(k) WHERE i + k - 1 <= len(ws) GROUP BY lang, k, array_to_string(ws[i:i + k - 1], ' ')),
sizes AS (SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE k = 1 GROUP BY lang),
candidates AS (SELECT * FROM counted WHERE k > 1 AND f >= 10),
cuts AS (SELECT *, unnest(range(1, k)) AS cut FROM candidates),
scores AS (
  SELECT c.lang, c.phrase, c.k, c.f AS a, x.f AS l, y.f AS r, cut, (1000000::HUGEINT * c.f * c.f) // (x.f * y.f) AS score
  FROM cuts c
  JOIN counted x ON x.lang = c.lang AND x.k = cut AND x.phrase = array_to_string(c.ws[1:cut], ' ')
  JOIN counted y ON y.lang = c.lang AND y.k = c.k - cut AND y.phrase = array_to_string(c.ws[cut + 1:c.k], ' ')),
lowest AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (
  SELECT lang, array_to_string(ws[1:2], ' ') AS phrase, f FROM candidates WHERE k = 3
  UNION ALL SELECT lang, array_to_string(ws[2:3], ' '), f FROM candidates WHERE k = 3),
gone AS (SELECT DISTINCT i.lang, i.phrase FROM inside i JOIN candidates c ON c.lang = i.lang AND c.phrase = i.phrase AND c.k = 2 WHERE 100 * i.f >= 50 * c.f),
left_over AS (SELECT l.* FROM lowest l ANTI JOIN gone g ON l.lang = g.lang AND l.phrase = g.phrase),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM left_over)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
"""
