"""DuckDB SQL for the queries of ``catalog_more``."""

from __future__ import annotations

from .oracle import NL, ROWS, TOWN, _with
from .oracle import Q as _BASE

Q: dict[str, str] = {}

Q["unmatched_rows"] = _with(ROWS, NL, TOWN) + """
, wide AS (SELECT DISTINCT t.name, t.year, r.r_name FROM town t JOIN nation n ON t.name = n.n_name JOIN region r ON n.n_regionkey = r.r_regionkey
           WHERE t.variable LIKE 'ord_F\\__%' ESCAPE '\\' OR t.variable LIKE 'ord_O\\__%' ESCAPE '\\')
SELECT 'code' AS lookup, count(*) AS rows, count(*) FILTER (starts_with(variable, 'ord_P_')) AS unmatched,
       min(variable) FILTER (starts_with(variable, 'ord_P_')) AS example FROM town
UNION ALL SELECT 'county', count(*), count(*) FILTER (r_name = 'ASIA'), min(name) FILTER (r_name = 'ASIA') FROM wide
UNION ALL SELECT 'name', count(*), 0, NULL FROM wide"""

Q["source_origins"] = _BASE["prefer_source"].rsplit("SELECT name, year, variable, src", 1)[0].rstrip() + """
, best AS (SELECT name, year, substr(variable, 5) AS status, estimate, CASE src WHEN 'orders' THEN 1 ELSE 2 END AS origin FROM ranked WHERE rn = 1),
spec(grp, status) AS (VALUES ('total', 'F'), ('total', 'O'), ('total', 'P'), ('open', 'O'), ('done', 'F'), ('done', 'P')),
roll AS (SELECT name, year, grp, sum(estimate) AS estimate, bit_or(origin) AS origin FROM best JOIN spec USING (status) GROUP BY name, year, grp)
SELECT r.name, r.year, r.grp AS "group", round(r.estimate, 2) AS estimate, CASE WHEN r.grp <> 'total' THEN round(r.estimate / t.estimate, 6) END AS share,
       r.origin, r.grp <> 'total' AND bit_count(r.origin | t.origin) > 1 AS mixed
FROM roll r LEFT JOIN roll t ON r.name = t.name AND r.year = t.year AND t.grp = 'total'"""

Q["part_ordinals"] = "SELECT p_partkey, p_name, row_number() OVER (ORDER BY p_name, p_partkey) AS position FROM part"

Q["found_pivot"] = _BASE["prefixed_pivot"]

Q["json_variant_explode"] = """
SELECT event_id, key, 'BIGINT' AS kind, json_extract_string(props, '$.' || key) AS value
FROM (SELECT event_id, props, unnest(json_keys(props)) AS key FROM events WHERE props IS NOT NULL)"""

Q["nested_regions"] = _with(ROWS, NL, TOWN).replace("WITH", "WITH RECURSIVE", 1) + """
, own(area, part) AS (SELECT r_name, n_name FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT * FROM (VALUES ('Inner ring', 'NATION_0'), ('Inner ring', 'NATION_5'), ('Outer ring', 'Inner ring'), ('Outer ring', 'AMERICA'),
                                  ('Both hemispheres', 'Outer ring'), ('Both hemispheres', 'ASIA'), ('Both hemispheres', 'NATION_0'))),
closed(area, part) AS (SELECT area, part FROM own UNION SELECT c.area, o.part FROM closed c JOIN own o ON c.part = o.area)
SELECT c.area AS name, t.year, t.variable, round(sum(t.estimate), 2) AS estimate, round(sqrt(sum(t.moe * t.moe)), 4) AS moe
FROM closed c JOIN town t ON t.name = c.part GROUP BY c.area, t.year, t.variable"""

Q["category_levels"] = """
WITH cells AS (SELECT o_orderpriority AS p, o_orderstatus AS status, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value FROM orders GROUP BY ALL),
named AS (SELECT CASE WHEN p IN ('1-URGENT', '2-HIGH') THEN 'Rush' WHEN p = '5-LOW' THEN 'Low' WHEN p = '3-MEDIUM' THEN 'Medium' ELSE 'Not Specified' END AS priority, status, value FROM cells),
both_ AS (SELECT * FROM named UNION ALL SELECT priority, 'again', value FROM named WHERE status = 'F'),
sums AS (SELECT priority, status, round(sum(value), 2) AS value,
                CASE priority WHEN 'Low' THEN 1 WHEN 'Rush' THEN 2 WHEN 'Medium' THEN 3 ELSE 4 END AS place FROM both_ GROUP BY priority, status)
SELECT status, priority, place, row_number() OVER (PARTITION BY status ORDER BY place) AS row, value FROM sums"""

Q["clean_headers"] = "SELECT s_suppkey AS supplier_key, s_name AS name_legal, s_acctbal AS name_legal_2 FROM supplier"
