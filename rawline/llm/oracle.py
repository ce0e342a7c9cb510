"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

OP1 = r"""
WITH sized AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15) AS key
  FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rnk FROM sources),
weighed AS (
  SELECT *, [3, 1, 2][((rnk - 1) % 3 + 1)::INT] AS weight, source_size * 2 AS cap,
         1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE AS budget
  FROM ranked),
levels AS (
  SELECT *, cap::DOUBLE / weight::DOUBLE AS own,
         (budget - coalesce(sum(cap) OVER before, 0)::DOUBLE) / (sum(weight) OVER after)::DOUBLE AS level
  FROM weighed
  WINDOW before AS (ORDER BY cap::DOUBLE / weight::DOUBLE, rnk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         after AS (ORDER BY cap::DOUBLE / weight::DOUBLE, rnk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
held AS (SELECT level FROM levels WHERE level <= own ORDER BY own, rnk LIMIT 1),
targets AS (
  SELECT source, source_size, rnk, budget,
         CASE WHEN (SELECT level FROM held) IS NULL THEN cap::DOUBLE
              ELSE least(cap::DOUBLE, weight::DOUBLE * (SELECT level FROM held)) END AS target
  FROM levels),
queued AS (
  SELECT d.doc_id, d.size, t.source_size, t.rnk, t.target, t.budget, row_number() OVER () AS rid,
         sum(d.size) OVER (PARTITION BY t.rnk ORDER BY d.key, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS served
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
copies AS (
  SELECT q.*, (served + pass * source_size)::DOUBLE / target AS time
  FROM queued q, (VALUES (0), (1)) p(pass) WHERE size > 0 AND target > 0),
cut AS (
  SELECT rid, size, budget, sum(size) OVER (ORDER BY time, rnk ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running
  FROM copies),
taken AS (SELECT rid, sum(size) AS taken FROM cut WHERE running <= budget GROUP BY rid)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken
FROM queued LEFT JOIN taken USING (rid)
"""


OP5 = r"""
WITH items0 AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w
  FROM benchmark WHERE text IS NOT NULL),
items AS (SELECT min(item_id) AS item_id, w, len(w) AS n, least(len(w), 5) AS k FROM items0 WHERE len(w) > 0 GROUP BY w),
docs0 AS (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL),
docs AS (
  SELECT row_number() OVER () AS rid, doc_id,
         list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w
  FROM docs0),
item_sh AS (
  SELECT item_id, n, k, q, array_to_string(w[q + 1 : q + k], ' ') AS sh
  FROM items, unnest(range(0, n - k + 1)) AS t(q)),
doc_sh AS (
  SELECT rid, doc_id, len(w) AS m, s.k AS k, p, array_to_string(w[p + 1 : p + s.k], ' ') AS sh
  FROM docs, (SELECT DISTINCT k FROM items) s, unnest(range(0, len(w) - s.k + 1)) AS t(p)),
spots AS (
  SELECT DISTINCT d.rid, d.doc_id, d.m, i.n, i.k, least(i.n, d.m) AS size, d.p
  FROM doc_sh d JOIN item_sh i ON d.k = i.k AND d.sh = i.sh),
windows AS (
  SELECT rid, doc_id, n, k, size, s
  FROM (SELECT *, unnest(range(greatest(0, p - (size - k)), least(p, m - size) + 1)) AS s FROM spots)
  GROUP BY ALL HAVING count(*) >= ceil((size - k + 1 + n - k + 1) * 0.8 / 1.8 - 1e-9)),
window_sh AS (
  SELECT w.rid, w.n, w.s, d.sh, count(*) AS c
  FROM windows w JOIN doc_sh d ON w.rid = d.rid AND w.k = d.k AND d.p BETWEEN w.s AND w.s + w.size - w.k
  GROUP BY ALL),
item_count AS (SELECT item_id, n, sh, count(*) AS c FROM item_sh GROUP BY ALL),
shared AS (
  SELECT w.rid, w.n, w.s, i.item_id, sum(least(w.c, i.c)) AS both_n
  FROM window_sh w JOIN item_count i ON w.n = i.n AND w.sh = i.sh GROUP BY ALL),
alike AS (
  SELECT h.rid, w.doc_id, h.item_id, h.s, h.n,
         h.both_n::DOUBLE / ((w.size - w.k + 1) + (w.n - w.k + 1) - h.both_n)::DOUBLE AS similarity
  FROM shared h JOIN windows w ON h.rid = w.rid AND h.n = w.n AND h.s = w.s)
SELECT doc_id, item_id, similarity, s::INT AS start_word, n::INT AS n_words
FROM alike WHERE similarity >= 0.8
QUALIFY row_number() OVER (PARTITION BY rid, item_id ORDER BY similarity DESC, s) = 1
"""


OP11 = r"""
WITH docs AS (
    SELECT row_number() OVER () AS row_no, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents
), words AS (
    SELECT row_no, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
), kept AS (
    SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT row_no) >= 3
), langs AS (
    SELECT d.lang, count(k.term) AS v, coalesce(sum(k.n), 0) AS total
    FROM (SELECT DISTINCT lang FROM docs) d LEFT JOIN kept k USING (lang) GROUP BY d.lang
), groups AS (
    SELECT DISTINCT lang, source FROM docs
), counts AS (
    SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL
), totals AS (
    SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS total
    FROM groups g LEFT JOIN counts c USING (lang, source) GROUP BY ALL
), shares AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
           1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (g.total + l.v)::HUGEINT AS p,
           1 + (1000000000::HUGEINT * (k.n + 1)) // (l.total + l.v)::HUGEINT AS q
    FROM totals g JOIN langs l USING (lang) JOIN kept k USING (lang)
    LEFT JOIN counts c USING (lang, source, term)
), found AS (
    SELECT g.lang, g.source, 'pair' AS part, o.source AS item, coalesce(x.value, 0) AS value
    FROM groups g JOIN groups o ON o.lang = g.lang AND o.source <> g.source
    LEFT JOIN (
        SELECT a.lang, a.source, b.source AS other, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
        FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
    ) x ON x.lang = g.lang AND x.source = g.source AND x.other = o.source
    UNION ALL
    SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM shares WHERE n > 0 AND p > q
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_mix_sources": OP1, "op5_decontamination": OP5, "op11_source_divergence": OP11}
