"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

from sprintlens.llm.line_spread import MIN_SITES, WORDS, WORDY_SITES

OP7 = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
per_source AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
named AS (
  SELECT *, row_number() OVER (ORDER BY source IS NULL, source) AS n FROM per_source),
weighed AS (
  SELECT *, [3.0, 1.0, 2.0][(n - 1) % 3 + 1]::DOUBLE AS w, 2.0::DOUBLE * source_size AS cap,
         1.5::DOUBLE * sum(source_size) OVER () AS total FROM named),
filling AS (
  SELECT *, cap / w AS fill,
         coalesce(sum(cap) OVER (ORDER BY cap / w, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         sum(w) OVER (ORDER BY cap / w, n ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM weighed),
capped AS (SELECT *, fill * rest <= total - before AS is_capped FROM filling),
targets AS (
  SELECT source, source_size,
         CASE WHEN is_capped THEN cap
              ELSE w * (total - coalesce(sum(CASE WHEN is_capped THEN cap END) OVER (), 0))
                     / sum(CASE WHEN NOT is_capped THEN w END) OVER () END AS target FROM capped),
wanted AS (
  SELECT s.doc_id, s.size, s.source, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
         (CAST('0x' || md5('mix:' || coalesce(CAST(s.doc_id AS VARCHAR), 'null'))[1:13] AS BIGINT)::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE AS u
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
chances AS (
  SELECT *, least(floor(rate), 2)::BIGINT AS base,
         least(greatest(rate - least(floor(rate), 2), 1e-9::DOUBLE), 1 - 1e-9::DOUBLE) AS p FROM wanted),
odds AS (SELECT *, (u / (1 - u)) / (p / (1 - p)) AS o FROM chances),
ranked AS (SELECT *, o / (1 + o) AS r, target - sum(base * size) OVER (PARTITION BY source) AS left_over FROM odds),
placed AS (
  SELECT *, coalesce(sum(CASE WHEN base < 2 THEN size ELSE 0 END) OVER (
    PARTITION BY source ORDER BY r, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead FROM ranked)
SELECT doc_id, size, source_size, target,
       ((base + CASE WHEN base < 2 AND 2 * ahead + size <= 2 * left_over THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM placed
"""

OP9 = """
WITH clean AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
chats AS (
  SELECT conv_id, list(md5(role || chr(0) || text) ORDER BY turn NULLS LAST, role, text) AS turns,
         string_agg('<|im_start|>' || replace(role, '<|', '< |') || chr(10) || replace(text, '<|', '< |')
                    || '<|im_end|>' || chr(10), '' ORDER BY turn NULLS LAST, role, text) AS text
  FROM clean GROUP BY conv_id),
ends AS (SELECT turns, min(conv_id) AS conv_id, count(*) AS n_equal FROM chats GROUP BY turns),
prefixes AS (
  SELECT DISTINCT turns[1:k] AS turns FROM (SELECT turns, unnest(range(1, len(turns))) AS k FROM ends))
SELECT e.conv_id, len(e.turns)::BIGINT AS n_turns, e.n_equal, c.text
FROM ends e JOIN chats c USING (conv_id) WHERE NOT EXISTS (SELECT 1 FROM prefixes p WHERE p.turns = e.turns)
"""

LINE_DEDUP = f"""
WITH cut AS (
  SELECT doc_id, md5(text) AS h, source, unnest(string_split(text, chr(10))) AS raw,
         unnest(range(len(string_split(text, chr(10))))) AS pos
  FROM {{documents}}),
lines AS (SELECT *, trim(raw, ' ' || chr(9) || chr(13)) AS line FROM cut),
common AS (
  SELECT line, min(doc_id) AS first_doc FROM lines WHERE line <> ''
  GROUP BY line HAVING count(DISTINCT source) >= CASE WHEN len(string_split(line, ' ')) >= {WORDS} THEN {WORDY_SITES} ELSE {MIN_SITES} END),
marked AS (
  SELECT l.*, coalesce(c.line IS NOT NULL AND l.doc_id <> c.first_doc, FALSE) AS gone
  FROM lines l LEFT JOIN common c ON l.line = c.line),
joined AS (
  SELECT doc_id, h, coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text,
         (count(*) FILTER (WHERE line <> ''))::BIGINT AS n_lines, (count(*) FILTER (WHERE gone))::BIGINT AS n_removed
  FROM marked GROUP BY doc_id, h)
"""

OP10 = LINE_DEDUP.format(documents="documents") + """
SELECT d.doc_id, j.text, coalesce(j.n_lines, 0) AS n_lines, coalesce(j.n_removed, 0) AS n_removed
FROM documents d LEFT JOIN joined j ON d.doc_id = j.doc_id AND md5(d.text) = j.h
"""

LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP11 = rf"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all({LOWER.format("text")}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM documents),
tf AS (SELECT doc_id, t, count(*) AS tf FROM words GROUP BY doc_id, t),
lengths AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id),
corpus AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM lengths),
weights AS (
  SELECT t, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT t, count(*) AS df FROM tf GROUP BY t), corpus),
items AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all({LOWER.format("text")}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
scores AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total))))::BIGINT AS score
  FROM items JOIN tf USING (t) JOIN weights USING (t) JOIN lengths USING (doc_id), corpus GROUP BY item_id, doc_id)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 10
"""

OP12 = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT r, lang, source, unnest(regexp_extract_all({LOWER.format("text")}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM docs),
counts AS (SELECT lang, source, t, count(*) AS c, count(DISTINCT r) AS d FROM words GROUP BY lang, source, t),
kept AS (SELECT lang, t, sum(c) AS lc FROM counts GROUP BY lang, t HAVING sum(d) >= 10),
per_lang AS (SELECT lang, count(*) AS v, sum(lc) AS ln FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
totals AS (SELECT lang, source, sum(c) AS n FROM counts JOIN kept USING (lang, t) GROUP BY lang, source),
shares AS (
  SELECT g.lang, g.source, k.t, coalesce(c.c, 0) AS c,
         1 + (1000000000::HUGEINT * (coalesce(c.c, 0) + 2)) // (coalesce(n.n, 0) + 2 * l.v) AS p,
         1 + (1000000000::HUGEINT * (k.lc + 2)) // (l.ln + 2 * l.v) AS q
  FROM groups g JOIN kept k USING (lang) JOIN per_lang l USING (lang)
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.t = k.t
  LEFT JOIN totals n ON n.lang = g.lang AND n.source = g.source),
distances AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.t = b.t AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(d.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN distances d ON d.lang = a.lang AND d.source = a.source AND d.item = b.source),
terms AS (
  SELECT lang, source, t AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value FROM shares WHERE c > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value,
       (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INTEGER AS rank FROM pairs
UNION ALL
SELECT * FROM (
  SELECT lang, source, 'term' AS part, item, value,
         (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INTEGER AS rank FROM terms) WHERE rank <= 10
"""

ORACLE = {"op11_lexical_search": OP11, "op12_divergence_audit": OP12, "op7_pareto_mix": OP7, "op9_chat_snapshots": OP9, "op10_line_spread": OP10}
