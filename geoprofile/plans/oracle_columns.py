"""DuckDB SQL for the queries of ``catalog_columns``."""

from __future__ import annotations

from .oracle import BASE, LEAVES, LEVELMAP, NBH, STACKED, _with

Q: dict[str, str] = {}

Q["concept_titles"] = """
SELECT DISTINCT 'DP' || lpad(CAST(p_size AS VARCHAR), 2, '0') AS "group",
       CASE WHEN p_type = 'ECONOMY' THEN 'Basic Parts' ELSE left(p_type, 1) || lower(substr(p_type, 2)) || ' Parts' END AS concept
FROM part WHERE p_size % 3 <> 0"""

Q["codes_by_name"] = """
WITH sheet AS (SELECT DISTINCT lpad(CAST(n.n_regionkey AS VARCHAR), 2, '0') AS state,
                      left(c.c_mktsegment, 1) || lower(substr(c.c_mktsegment, 2)) || ' County, World' AS name
               FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey)
SELECT name, string_agg('0600000US' || CASE WHEN state = '00' THEN '' ELSE state END, '' ORDER BY state) AS code
FROM sheet GROUP BY name"""

Q["recode_values"] = """
SELECT c_custkey, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Cars' WHEN 'MACHINERY' THEN 'Machines' ELSE c_mktsegment END AS recoded,
       CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'FURNITURE') THEN 'Home' ELSE c_mktsegment END AS collapsed,
       nullif(regexp_extract(c_name, '#0{3,8}([1-9][0-9]*)$', 1), '') AS number, left(c_mktsegment, 3) AS short
FROM customer"""

Q["unpivot_rest"] = """
SELECT s_suppkey AS suppkey, 'name' AS variable, s_name AS value FROM supplier
UNION ALL SELECT s_suppkey, 'nationkey', CAST(s_nationkey AS VARCHAR) FROM supplier
UNION ALL SELECT s_suppkey, 'acctbal', CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS VARCHAR) FROM supplier"""

Q["optional_columns"] = "SELECT s_name, s_suppkey FROM supplier"

Q["sorted_levels"] = _with(*BASE, LEVELMAP, STACKED, NBH) + """
, lng AS (SELECT level, CAST(NULL AS VARCHAR) AS city, name, year, variable FROM st
          UNION ALL SELECT '6_neighborhoods', city, name, year, variable FROM nbh),
sl(slice, name) AS (VALUES ('nation_0', 'AFRICA'), ('nation_0', 'NATION_0'), ('nation_0', 'World'),
                           ('nation_1', 'AMERICA'), ('nation_1', 'NATION_1'), ('nation_1', 'NATION_6'),
                           ('nation_1', 'World'), ('nation_5', 'AFRICA'), ('nation_5', 'NATION_5'), ('nation_5', 'World')),
picked AS (SELECT sl.slice, l.* FROM lng l JOIN sl ON l.name = sl.name
           WHERE l.level IN ('1_state', '4_towns')
           UNION ALL
           SELECT s.slice, l.* FROM lng l JOIN (SELECT DISTINCT slice FROM sl) s ON l.city = s.slice)
SELECT slice, variable, level, city, name, year,
       CAST(row_number() OVER (PARTITION BY slice, variable ORDER BY level, city NULLS LAST, name, year) AS INTEGER) AS "row" FROM picked"""

Q["filtered_regions"] = _with(*BASE) + """
, lm(leaf, level, name) AS (SELECT n_name, '4_towns', n_name FROM nation
                            UNION ALL SELECT * FROM (VALUES ('NATION_0', '3_regions', 'Ring A'), ('NATION_1', '3_regions', 'Ring A'),
                                                            ('NATION_5', '3_regions', 'Ring A')))
SELECT lm.level, lm.name, t.variable, t.year, round(sum(t.estimate), 2) AS estimate, round(sqrt(sum(t.moe * t.moe)), 4) AS moe
FROM town t JOIN lm ON t.name = lm.leaf GROUP BY lm.level, lm.name, t.variable, t.year"""

Q["first_per_key"] = """
WITH o AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, nullif(o_orderpriority, '1-URGENT') AS o_orderpriority FROM orders)
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderstatus
                                   ORDER BY o_orderpriority NULLS LAST, o_totalprice DESC, o_orderkey) AS rn FROM o) WHERE rn = 1"""

Q["null_margins"] = _with(*BASE, LEAVES) + """
, spec(g, priority) AS (VALUES ('total', '1-URGENT'), ('total', '2-HIGH'), ('total', '3-MEDIUM'), ('total', '4-NOT SPECIFIED'), ('total', '5-LOW'),
                               ('high', '1-URGENT'), ('high', '2-HIGH'), ('low', '4-NOT SPECIFIED'), ('low', '5-LOW')),
j AS (SELECT l.name, l.year, s.g, l.estimate, CASE WHEN l.status <> 'P' THEN l.moe END AS moe
      FROM lab l JOIN spec s ON l.priority = s.priority),
r AS (SELECT name, year, g, round(sum(estimate), 2) AS estimate, round(sqrt(sum(moe * moe)), 4) AS moe, count(*) = count(moe) AS complete
      FROM j GROUP BY name, year, g)
SELECT 'propagate' AS policy, name, year, g AS "group", estimate, CASE WHEN complete THEN moe END AS moe FROM r
UNION ALL SELECT 'ignore', name, year, g, estimate, moe FROM r"""
