"""DuckDB SQL for the operators that SQL can express on whole tables."""

ORACLE: dict[str, str] = {
    "op9_exact_dedup": """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))""",
    "op6_chat_format": """
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
sized AS (
  SELECT *, length('<|im_start|>') + length(role) + 1 + length(text)
            + length(regexp_extract_all(text, '<\\\\*\\|', 0)) + length('<|im_end|>') + 1 AS chars FROM rows)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id""",
    "op12_source_divergence": r"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
kept AS (SELECT lang, term FROM (SELECT lang, unnest(list_distinct(terms)) AS term FROM d) GROUP BY lang, term HAVING count(*) >= 30),
cells AS (SELECT lang, source, term, count(*) AS c FROM (SELECT lang, source, unnest(terms) AS term FROM d) JOIN kept USING (lang, term) GROUP BY ALL),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
grid AS (SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c
         FROM (SELECT DISTINCT lang, source FROM d) g JOIN kept k USING (lang) LEFT JOIN cells c USING (lang, source, term)),
shares AS (SELECT lang, source, term, c, 1 + (1000000000::HUGEINT * (c + 5)) // (sum(c) OVER (PARTITION BY lang, source)::HUGEINT + 5 * v) AS p FROM grid JOIN sizes USING (lang)),
whole AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (c + 5)) // (sum(c) OVER (PARTITION BY lang)::HUGEINT + 5 * v) AS q
          FROM (SELECT lang, term, sum(c)::HUGEINT AS c FROM cells GROUP BY lang, term) JOIN sizes USING (lang)),
groups AS (SELECT DISTINCT lang, source FROM d),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT s.lang, s.source, t.source AS item, sum(abs(s.p - t.p)) AS value
             FROM shares s JOIN shares t ON s.lang = t.lang AND s.term = t.term AND s.source <> t.source GROUP BY ALL) x
    ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q)::BIGINT FROM shares JOIN whole USING (lang, term) WHERE c > 0 AND p > q)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM found)
WHERE part = 'pair' OR rank <= 50""",
}
