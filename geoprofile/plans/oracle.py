"""Independent ANSI SQL (DuckDB dialect) for every registered query.

Written from the operator semantics, not generated from the Spark plans.
Tables are the driver's views (orders, customer, nation, region, lineitem,
events).  Money is summed as DECIMAL(18,2) and cast to DOUBLE at the end,
exactly as the Spark side does; outputs use the same rounding.
"""

from __future__ import annotations

ROWS = """
rows_ AS (
  SELECT r.r_name, n.n_name, c.c_mktsegment, CAST(year(o.o_orderdate) AS INTEGER) AS year,
         o.o_orderstatus AS status, o.o_orderpriority AS priority,
         CAST(o.o_totalprice AS DECIMAL(18,2)) AS price, power(0.05 * o.o_totalprice, 2) AS sq
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey)"""

NL = """
nl AS (SELECT r_name, n_name, year, status, priority, sum(price) AS est, sum(sq) AS sq
       FROM rows_ GROUP BY r_name, n_name, year, status, priority)"""

TOWN = """
town AS (
  SELECT n_name AS name, year, 'ord_' || status || '_' || priority AS variable,
         CAST(est AS DOUBLE) AS estimate, sqrt(sq) AS moe FROM nl
  UNION ALL
  SELECT n_name, year, 'ord_' || status, CAST(sum(est) AS DOUBLE), sqrt(sum(sq)) FROM nl GROUP BY n_name, year, status
  UNION ALL
  SELECT n_name, year, 'ord', CAST(sum(est) AS DOUBLE), sqrt(sum(sq)) FROM nl GROUP BY n_name, year)"""

_STATUS = ["F", "O", "P"]
_PRIORITY = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
_DICT = [("ord", "Total")] + [(f"ord_{s}", f"Total!!{s}") for s in _STATUS] + \
        [(f"ord_{s}_{p}", f"Total!!{s}!!{p}") for s in _STATUS for p in _PRIORITY]
LABELS = """
labels(variable, label) AS (VALUES """ + ", ".join(f"('{v}', '{l}')" for v, l in _DICT) + ")"


LEAVES = """
lab AS (SELECT t.name, t.year, t.variable, t.estimate, t.moe, l.label,
               string_split(l.label, '!!')[2] AS status, string_split(l.label, '!!')[3] AS priority
        FROM town t LEFT JOIN labels l ON t.variable = l.variable),
leaves AS (SELECT * FROM lab WHERE priority IS NOT NULL),
leaf_labels AS (SELECT variable, string_split(label, '!!')[2] AS status, string_split(label, '!!')[3] AS priority
                FROM labels WHERE string_split(label, '!!')[3] IS NOT NULL),
ppos AS (SELECT priority, row_number() OVER (ORDER BY min(variable), priority) AS position
         FROM leaf_labels GROUP BY priority),
spos AS (SELECT status, row_number() OVER (ORDER BY min(variable), status) AS position
         FROM leaf_labels GROUP BY status),
pspec(g, position) AS (VALUES ('total', 1), ('total', 2), ('total', 3), ('total', 4), ('total', 5),
                              ('high', 1), ('high', 2), ('low', 4), ('low', 5))"""

ROLL = """
roll AS (SELECT lv.name, lv.year, s.g, sum(lv.estimate) AS estimate, sqrt(sum(lv.moe * lv.moe)) AS moe
         FROM leaves lv JOIN ppos p ON lv.priority = p.priority JOIN pspec s ON s.position = p.position
         GROUP BY lv.name, lv.year, s.g),
den AS (SELECT name, year, max(estimate) AS den, max(moe) AS den_moe FROM roll WHERE g = 'total' GROUP BY name, year),
sh AS (SELECT r.name, r.year, r.g, r.estimate, r.moe,
              CASE WHEN r.g <> 'total' THEN r.estimate / d.den END AS share,
              CASE WHEN r.g <> 'total' THEN
                sqrt(CASE WHEN r.moe * r.moe - (r.estimate / d.den) * (r.estimate / d.den) * d.den_moe * d.den_moe < 0
                          THEN r.moe * r.moe + (r.estimate / d.den) * (r.estimate / d.den) * d.den_moe * d.den_moe
                          ELSE r.moe * r.moe - (r.estimate / d.den) * (r.estimate / d.den) * d.den_moe * d.den_moe END) / d.den
              END AS sharemoe
       FROM roll r LEFT JOIN den d ON r.name = d.name AND r.year = d.year)"""

LEVELMAP = """
lm(leaf, level, name) AS (
  SELECT n_name, '4_towns', n_name FROM nation
  UNION ALL SELECT n.n_name, '3_regions', r.r_name FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
  UNION ALL SELECT n_name, '1_state', 'World' FROM nation
  UNION ALL SELECT * FROM (VALUES ('NATION_0', '3_regions', 'Ring A'), ('NATION_1', '3_regions', 'Ring A'),
                                  ('NATION_5', '3_regions', 'Ring A'), ('NATION_1', '3_regions', 'Ring B'),
                                  ('NATION_2', '3_regions', 'Ring B'), ('NATION_7', '3_regions', 'Ring B')))"""

STACKED = """
st AS (SELECT lm.level, lm.name, t.year, t.variable, sum(t.estimate) AS estimate, sqrt(sum(t.moe * t.moe)) AS moe
       FROM town t JOIN lm ON t.name = lm.leaf GROUP BY lm.level, lm.name, t.year, t.variable)"""

SUPPRESSED = """
mx AS (SELECT 'max_price' AS tbl, n_name AS name, year, 'max_price' AS variable,
              CAST(max(price) AS DOUBLE) AS estimate, CAST(NULL AS DOUBLE) AS moe
       FROM rows_ GROUP BY n_name, year),
both_ AS (SELECT 'orders' AS tbl, name, year, variable, estimate, moe FROM town UNION ALL SELECT * FROM mx),
st2 AS (SELECT lm.level, lm.name, b.year, b.tbl, b.variable, sum(b.estimate) AS estimate,
               sqrt(sum(b.moe * b.moe)) AS moe
        FROM both_ b JOIN lm ON b.name = lm.leaf GROUP BY lm.level, lm.name, b.year, b.tbl, b.variable),
sup AS (SELECT level, name, year, tbl, variable,
               CASE WHEN tbl = 'max_price' AND regexp_matches(level, 'state|regions') THEN NULL ELSE estimate END AS estimate,
               CASE WHEN tbl = 'max_price' AND regexp_matches(level, 'state|regions') THEN NULL ELSE moe END AS moe
        FROM st2)"""

NBH = """
sgl AS (SELECT n_name, c_mktsegment, year, status, priority, sum(price) AS est, sum(sq) AS sq
        FROM rows_ GROUP BY n_name, c_mktsegment, year, status, priority),
nbh0 AS (
  SELECT n_name, c_mktsegment, year, 'ord_' || status || '_' || priority AS variable,
         CAST(est AS DOUBLE) AS estimate, sqrt(sq) AS moe FROM sgl
  UNION ALL SELECT n_name, c_mktsegment, year, 'ord_' || status, CAST(sum(est) AS DOUBLE), sqrt(sum(sq))
            FROM sgl GROUP BY n_name, c_mktsegment, year, status
  UNION ALL SELECT n_name, c_mktsegment, year, 'ord', CAST(sum(est) AS DOUBLE), sqrt(sum(sq))
            FROM sgl GROUP BY n_name, c_mktsegment, year),
nbh AS (SELECT '6_neighborhoods' AS level, lower(n_name) AS city,
               upper(left(c_mktsegment, 1)) || lower(substr(c_mktsegment, 2)) AS name,
               variable, year, estimate, moe FROM nbh0)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


BASE = (ROWS, NL, TOWN, LABELS)

Q: dict[str, str] = {}

Q["variable_labels"] = _with(*BASE) + """
SELECT t.name, t.year, t.variable, l.label, round(t.estimate, 2) AS estimate, round(t.moe, 4) AS moe
FROM town t LEFT JOIN labels l ON t.variable = l.variable"""

Q["label_split_leaves"] = _with(*BASE, LEAVES) + """
SELECT name, year, variable, status, priority, round(estimate, 2) AS estimate, round(moe, 4) AS moe FROM leaves"""

Q["group_rollup"] = _with(*BASE, LEAVES) + """
, lspec(g, priority) AS (VALUES ('total', '1-URGENT'), ('total', '2-HIGH'), ('total', '3-MEDIUM'),
                                ('total', '4-NOT SPECIFIED'), ('total', '5-LOW'), ('high', '1-URGENT'),
                                ('high', '2-HIGH'), ('low', '4-NOT SPECIFIED'), ('low', '5-LOW'))
SELECT lv.name, lv.year, s.g AS "group", round(sum(lv.estimate), 2) AS estimate
FROM leaves lv JOIN lspec s ON lv.priority = s.priority GROUP BY lv.name, lv.year, s.g"""

Q["group_rollup_positional"] = _with(*BASE, LEAVES, ROLL) + """
SELECT name, year, g AS "group", round(estimate, 2) AS estimate FROM roll"""

Q["shares"] = _with(*BASE, LEAVES, ROLL) + """
SELECT name, year, g AS "group", round(estimate, 2) AS estimate, round(share, 6) AS share FROM sh"""

Q["moe_rollup"] = _with(*BASE, LEAVES, ROLL) + """
SELECT name, year, g AS "group", round(estimate, 2) AS estimate, round(moe, 4) AS moe FROM roll"""

Q["moe_share"] = _with(*BASE, LEAVES, ROLL) + """
SELECT name, year, g AS "group", round(estimate, 2) AS estimate, round(moe, 4) AS moe,
       round(share, 6) AS share, round(sharemoe, 6) AS sharemoe FROM sh"""

Q["two_stage_rollup"] = _with(*BASE, LEAVES) + """
, s1(g1, position) AS (VALUES ('all', 1), ('all', 2), ('all', 3), ('open', 2), ('closed', 1), ('closed', 3)),
s2(g2, position) AS (VALUES ('determined', 1), ('determined', 2), ('determined', 3), ('determined', 4),
                            ('determined', 5), ('urgent', 1), ('top3', 1), ('top3', 2), ('top3', 3)),
two AS (SELECT lv.name, lv.year, s1.g1, s2.g2, sum(lv.estimate) AS estimate
        FROM leaves lv JOIN spos ON lv.status = spos.status JOIN s1 ON s1.position = spos.position
        JOIN ppos ON lv.priority = ppos.priority JOIN s2 ON s2.position = ppos.position
        GROUP BY lv.name, lv.year, s1.g1, s2.g2),
d AS (SELECT name, year, g1, max(estimate) AS den FROM two WHERE g2 = 'determined' GROUP BY name, year, g1)
SELECT t.name, t.year, t.g1 || '_' || t.g2 AS "group", round(t.estimate, 2) AS estimate,
       round(CASE WHEN t.g2 <> 'determined' THEN t.estimate / d.den END, 6) AS share
FROM two t LEFT JOIN d ON t.name = d.name AND t.year = d.year AND t.g1 = d.g1"""

Q["weighted_apportion"] = _with(*BASE) + """
, cw(geoid, city, name, weight) AS (VALUES
    ('NATION_0', 'alpha', 'north', 1.0), ('NATION_1', 'alpha', 'north', 1.0),
    ('NATION_2', 'alpha', 'north', 0.6), ('NATION_2', 'alpha', 'south', 0.4),
    ('NATION_3', 'alpha', 'south', 1.0), ('NATION_4', 'alpha', 'south', 0.5),
    ('NATION_4', 'beta', 'east', 0.5), ('NATION_5', 'beta', 'east', 1.0),
    ('NATION_6', 'beta', 'east', 1.0), ('NATION_7', 'beta', 'east', 0.75),
    ('NATION_10', 'beta', 'north', 0.25))
SELECT cw.city, cw.name, t.variable, t.year,
       CAST(round(sum(CAST(cw.weight AS DECIMAL(12,6)) * CAST(t.estimate AS DECIMAL(18,2))), 0) AS DOUBLE) AS estimate,
       round(sqrt(sum((CAST(cw.weight AS DOUBLE) * t.moe) * (CAST(cw.weight AS DOUBLE) * t.moe))), 4) AS moe
FROM town t JOIN cw ON t.name = cw.geoid GROUP BY cw.city, cw.name, t.variable, t.year"""

Q["geo_levels"] = _with(*BASE, LEVELMAP, STACKED) + """
SELECT level, name, year, variable, round(estimate, 2) AS estimate, round(moe, 4) AS moe FROM st"""

Q["suppress_medians"] = _with(*BASE, LEVELMAP, SUPPRESSED) + """
SELECT level, name, year, tbl, variable, round(estimate, 2) AS estimate, round(moe, 4) AS moe FROM sup"""

Q["prefer_source"] = _with(ROWS) + """
, a AS (SELECT 'orders' AS src, n_name AS name, year, 'ord_' || status AS variable,
               CAST(sum(price) FILTER (status IN ('F', 'O')) AS DOUBLE) AS estimate
        FROM rows_ GROUP BY n_name, year, status),
b AS (SELECT 'lineitem' AS src, n.n_name AS name, CAST(year(o.o_orderdate) AS INTEGER) AS year,
             'ord_' || o.o_orderstatus AS variable,
             CAST(sum(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS estimate
      FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
      JOIN nation n ON c.c_nationkey = n.n_nationkey
      GROUP BY n.n_name, CAST(year(o.o_orderdate) AS INTEGER), o.o_orderstatus),
u AS (SELECT * FROM a UNION ALL SELECT * FROM b),
ranked AS (SELECT *, row_number() OVER (PARTITION BY name, year, variable
                                        ORDER BY CASE src WHEN 'orders' THEN 1 WHEN 'lineitem' THEN 2 ELSE 3 END,
                                                 src, estimate) AS rn
           FROM u WHERE estimate IS NOT NULL)
SELECT name, year, variable, src, round(estimate, 2) AS estimate FROM ranked WHERE rn = 1"""

Q["param_slices"] = _with(*BASE, LEVELMAP, STACKED, NBH) + """
, prof AS (SELECT level, CAST(NULL AS VARCHAR) AS city, name, variable, year, estimate FROM st
           UNION ALL SELECT level, city, name, variable, year, estimate FROM nbh),
sl(slice, name) AS (VALUES ('nation_0', 'AFRICA'), ('nation_0', 'NATION_0'), ('nation_0', 'World'),
                           ('nation_1', 'AMERICA'), ('nation_1', 'NATION_1'), ('nation_1', 'NATION_6'),
                           ('nation_1', 'World'), ('nation_5', 'AFRICA'), ('nation_5', 'NATION_5'),
                           ('nation_5', 'World')),
slc AS (SELECT DISTINCT slice FROM sl)
SELECT s.slice, p.level, p.city, p.name, p.year, p.variable, round(p.estimate, 2) AS estimate
FROM prof p JOIN slc s
  ON p.name IN (SELECT x.name FROM sl x WHERE x.slice = s.slice) OR p.city = s.slice"""

Q["display_wide"] = _with(*BASE, LEVELMAP, STACKED, LEAVES) + """
, stl AS (SELECT st.*, string_split(l.label, '!!')[3] AS priority
          FROM st LEFT JOIN labels l ON st.variable = l.variable),
lroll AS (SELECT x.level, x.name, x.year, s.g, sum(x.estimate) AS estimate
          FROM stl x JOIN ppos p ON x.priority = p.priority JOIN pspec s ON s.position = p.position
          WHERE x.priority IS NOT NULL GROUP BY x.level, x.name, x.year, s.g),
lden AS (SELECT level, name, year, max(estimate) AS den FROM lroll WHERE g = 'total' GROUP BY level, name, year),
lsh AS (SELECT r.level, r.name, r.year, r.g, round(r.estimate, 2) AS estimate,
               round(CASE WHEN r.g <> 'total' THEN r.estimate / d.den END, 6) AS share
        FROM lroll r LEFT JOIN lden d ON r.level = d.level AND r.name = d.name AND r.year = d.year)
SELECT level, name, year,
       max(CASE WHEN g = 'total' THEN estimate END) AS "Total order value",
       max(CASE WHEN g = 'high' THEN estimate END) AS "High-priority order value",
       max(CASE WHEN g = 'high' THEN share END) AS "Share high priority",
       max(CASE WHEN g = 'low' THEN estimate END) AS "Low-priority order value",
       max(CASE WHEN g = 'low' THEN share END) AS "Share low priority"
FROM lsh GROUP BY level, name, year"""

_WIDE_COLS = ",\n".join(
    f"max(CASE WHEN g = '{g}' THEN {m} END) AS {g}_{m}"
    for g in ("total", "high", "low") for m in ("estimate", "moe", "share", "sharemoe"))

Q["wide_measures"] = _with(*BASE, LEAVES, ROLL) + f"""
, r AS (SELECT name, year, g, round(estimate, 2) AS estimate, round(moe, 4) AS moe,
               round(share, 6) AS share, round(sharemoe, 6) AS sharemoe FROM sh)
SELECT name, year,
{_WIDE_COLS}
FROM r GROUP BY name, year"""

Q["prefixed_pivot"] = """
WITH d AS (SELECT strftime(ts, '%Y-%m-%d') AS day, event_type,
                  CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value
           FROM events GROUP BY strftime(ts, '%Y-%m-%d'), event_type)
SELECT day,
       max(CASE WHEN event_type = 'click' THEN value END) AS ev_click,
       max(CASE WHEN event_type = 'error' THEN value END) AS ev_error,
       max(CASE WHEN event_type = 'purchase' THEN value END) AS ev_purchase,
       max(CASE WHEN event_type = 'signup' THEN value END) AS ev_signup,
       max(CASE WHEN event_type = 'view' THEN value END) AS ev_view
FROM d GROUP BY day"""

Q["content_selected_columns"] = "SELECT c_name, c_acctbal, c_mktsegment FROM customer"

Q["drop_empty_columns"] = _with(*BASE, LEVELMAP, SUPPRESSED) + """
SELECT level, name, year, max(CASE WHEN variable = 'ord' THEN round(estimate, 2) END) AS ord_estimate,
       max(CASE WHEN variable = 'ord' THEN round(moe, 4) END) AS ord_moe,
       max(CASE WHEN variable = 'max_price' THEN round(estimate, 2) END) AS max_price_estimate
FROM sup WHERE variable IN ('ord', 'max_price') GROUP BY level, name, year"""

GEOS = """
WITH g AS (
  SELECT '040' AS sl, lpad(CAST(r_regionkey AS VARCHAR), 2, '0') AS st, '000' AS co, '00000' AS cs, r_name AS name
  FROM region
  UNION ALL
  SELECT '050', lpad(CAST(n_regionkey AS VARCHAR), 2, '0'), lpad(CAST(n_nationkey AS VARCHAR), 3, '0'), '00000', n_name
  FROM nation
  UNION ALL
  SELECT '061', lpad(CAST(n.n_regionkey AS VARCHAR), 2, '0'), lpad(CAST(n.n_nationkey AS VARCHAR), 3, '0'),
         CASE WHEN length(CAST(c.c_custkey AS VARCHAR)) >= 5 THEN CAST(c.c_custkey AS VARCHAR)
              ELSE lpad(CAST(c.c_custkey AS VARCHAR), 5, '0') END, c.c_name
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey),
codes AS (
  SELECT name, rpad(substr(sl, 1, 2), 7, '0') || 'US'
               || CASE WHEN regexp_full_match(st, '0+') THEN '' ELSE st END
               || CASE WHEN regexp_full_match(co, '0+') THEN '' ELSE co END
               || CASE WHEN regexp_full_match(cs, '0+') THEN '' ELSE cs END AS code
  FROM g)
"""

Q["ordered_codes"] = GEOS + "SELECT name, code FROM codes"

_D = "&vintage=2019&d=ACS%205-Year%20Estimates%20Data%20Profiles"
_LINK_COLS = ",\n".join(
    f"'https://data.census.gov/cedsci/table?table={g}&g=' || code || '&tid=ACSDP5Y2019.{g}{_D}' AS \"{c}\""
    for g, c in [("DP02", "Social Characteristics"), ("DP03", "Economic Characteristics"),
                 ("DP04", "Housing Characteristics"), ("DP05", "Demographic Characteristics")])

Q["profile_links"] = GEOS + f"SELECT name,\n{_LINK_COLS}\nFROM codes"

Q["json_map_explode"] = """
SELECT e.event_id, k.key AS key, CAST(k.value AS INTEGER) AS value FROM events e, json_each(e.props) k"""

Q["percent_format"] = _with(*BASE, LEAVES, ROLL) + """
SELECT name, year, g AS "group",
       CASE WHEN share IS NOT NULL THEN printf('%.1f', share * 100) || '%' END AS share_pct FROM sh"""

Q["name_normalise"] = """
WITH nb AS (SELECT c.c_custkey AS id, '6_neighborhoods' AS level,
                   lower(n.n_name) || '_' || upper(left(c.c_mktsegment, 1)) || lower(substr(c.c_mktsegment, 2)) AS raw,
                   c.c_name AS label
            FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey),
up AS (SELECT CAST(-1 - n_nationkey AS BIGINT) AS id, '4_towns' AS level, n_name AS raw, n_name AS label FROM nation),
u AS (SELECT * FROM nb UNION ALL SELECT * FROM up)
SELECT id, raw,
       CASE WHEN regexp_matches(raw, '^(?:([a-z0-9 _]+)_)?([A-Z].*)$') THEN regexp_extract(raw, '^(?:([a-z0-9 _]+)_)?([A-Z].*)$', 1) END AS city,
       CASE WHEN regexp_matches(raw, '^(?:([a-z0-9 _]+)_)?([A-Z].*)$') THEN regexp_extract(raw, '^(?:([a-z0-9 _]+)_)?([A-Z].*)$', 2) END AS name,
       regexp_replace(label, '0+', '') AS short,
       regexp_replace(label, 'Customer#', 'Customer No. ') AS long_label,
       regexp_replace(level, '^[0-9]_', '') AS level
FROM u"""

Q["null_fill_coalesce"] = _with(*BASE, LEVELMAP, SUPPRESSED, NBH) + """
, u AS (SELECT level, CAST(NULL AS VARCHAR) AS city, name, year, variable, estimate, moe FROM sup
        UNION ALL SELECT level, city, name, year, variable, estimate, moe FROM nbh)
SELECT level, CASE WHEN regexp_matches(level, 'neighborhoods') THEN city ELSE '' END AS city,
       name, year, variable, round(estimate, 2) AS estimate, round(coalesce(moe, 0), 4) AS moe FROM u"""

_PCT1 = "CASE WHEN {c} IS NOT NULL THEN printf('%.1f', {c} * 100) || '%' END"
_PCT0 = "CASE WHEN {c} IS NOT NULL THEN printf('%.0f', {c} * 100) || '%' END"
_EV = ["click", "error", "purchase", "signup", "view"]
_ASM_MEASURES = ",\n".join(
    (f"{g}_{m} AS \"{g} {m}\"" if m in ("estimate", "moe") else _PCT1.format(c=f"{g}_{m}") + f" AS \"{g} {m}\"")
    for g in ("total", "high", "low") for m in ("estimate", "moe", "share", "sharemoe"))
_ASM_CWS = ",\n".join(_PCT0.format(c=f"cws_{e}") + f" AS \"Survey {e}\"" for e in _EV)
_ASM_CWS_PIVOT = ",\n".join(f"max(CASE WHEN indicator = '{e}' THEN value END) AS cws_{e}" for e in _EV)
_ASM_LINKS = ",\n".join(
    f"'https://data.census.gov/cedsci/table?table={g}&g=' || code || '&tid=ACSDP5Y2019.{g}{_D}' AS \"{c}\""
    for g, c in [("DP02", "Social Characteristics"), ("DP03", "Economic Characteristics"),
                 ("DP04", "Housing Characteristics"), ("DP05", "Demographic Characteristics")])

Q["profile_assembly"] = _with(*BASE, LEAVES, ROLL) + f"""
, acs AS (SELECT name, year,
{_WIDE_COLS.replace("THEN estimate END", "THEN round(estimate, 2) END").replace("THEN moe END", "THEN round(moe, 4) END")}
          FROM sh GROUP BY name, year),
nr AS (SELECT n.n_name AS town, r.r_name AS county FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey),
ev AS (SELECT n.n_name, e.event_type, CAST(e.value AS DECIMAL(18,2)) AS v
       FROM events e JOIN customer c ON e.user_id = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey),
bt AS (SELECT n_name, event_type, sum(v) AS v FROM ev GROUP BY n_name, event_type),
tt AS (SELECT n_name, sum(v) AS t FROM ev GROUP BY n_name),
cl AS (SELECT bt.event_type AS indicator, bt.n_name AS name,
              CASE WHEN CAST(tt.t AS DOUBLE) <> 0 THEN CAST(bt.v AS DOUBLE) / CAST(tt.t AS DOUBLE) END AS value
       FROM bt JOIN tt ON bt.n_name = tt.n_name),
cws AS (SELECT name,
{_ASM_CWS_PIVOT}
        FROM cl GROUP BY name),
meta AS (SELECT n_name AS name, '0500000US'
                || CASE WHEN regexp_full_match(lpad(CAST(n_regionkey AS VARCHAR), 2, '0'), '0+') THEN ''
                        ELSE lpad(CAST(n_regionkey AS VARCHAR), 2, '0') END
                || CASE WHEN regexp_full_match(lpad(CAST(n_nationkey AS VARCHAR), 3, '0'), '0+') THEN ''
                        ELSE lpad(CAST(n_nationkey AS VARCHAR), 3, '0') END AS code
         FROM nation),
metal AS (SELECT name,
{_ASM_LINKS}
          FROM meta)
SELECT acs.name AS "Town", nr.county AS "County", acs.year AS "Year",
{_ASM_CWS},
{_ASM_MEASURES},
metal."Social Characteristics", metal."Economic Characteristics", metal."Housing Characteristics",
metal."Demographic Characteristics"
FROM acs LEFT JOIN nr ON acs.name = nr.town LEFT JOIN cws ON acs.name = cws.name LEFT JOIN metal ON acs.name = metal.name"""


_SHARE_SQL = """CASE WHEN {g} <> 'total' THEN {e} / {d} END"""
_SMOE_SQL = """CASE WHEN {g} <> 'total' THEN
  sqrt(CASE WHEN {m} * {m} - ({e} / {d}) * ({e} / {d}) * {dm} * {dm} < 0
            THEN {m} * {m} + ({e} / {d}) * ({e} / {d}) * {dm} * {dm}
            ELSE {m} * {m} - ({e} / {d}) * ({e} / {d}) * {dm} * {dm} END) / {d} END"""

Q["town_profile"] = _with(*BASE, LEVELMAP, STACKED, LEAVES) + """
, stl AS (SELECT st.*, l.label, string_split(l.label, '!!')[2] AS status, string_split(l.label, '!!')[3] AS priority
          FROM st LEFT JOIN labels l ON st.variable = l.variable),
d2_labels AS (SELECT variable, string_split(label, '!!')[2] AS status FROM labels
              WHERE string_split(label, '!!')[2] IS NOT NULL AND string_split(label, '!!')[3] IS NULL),
s2pos AS (SELECT status, row_number() OVER (ORDER BY min(variable), status) AS position FROM d2_labels GROUP BY status),
sspec(g, grp_ord, position) AS (VALUES ('total', 1, 1), ('total', 1, 2), ('total', 1, 3), ('open', 2, 2),
                                       ('done', 3, 1), ('done', 3, 3)),
pspec2(g, grp_ord, position) AS (VALUES ('total', 1, 1), ('total', 1, 2), ('total', 1, 3), ('total', 1, 4),
                                        ('total', 1, 5), ('high', 2, 1), ('high', 2, 2), ('low', 3, 4), ('low', 3, 5)),
proll AS (SELECT x.level, x.name, x.year, s.g, s.grp_ord, sum(x.estimate) AS estimate, sqrt(sum(x.moe * x.moe)) AS moe
          FROM stl x JOIN ppos p ON x.priority = p.priority JOIN pspec2 s ON s.position = p.position
          WHERE x.priority IS NOT NULL GROUP BY x.level, x.name, x.year, s.g, s.grp_ord),
sroll AS (SELECT x.level, x.name, x.year, s.g, s.grp_ord, sum(x.estimate) AS estimate, sqrt(sum(x.moe * x.moe)) AS moe
          FROM stl x JOIN s2pos p ON x.status = p.status JOIN sspec s ON s.position = p.position
          WHERE x.status IS NOT NULL AND x.priority IS NULL GROUP BY x.level, x.name, x.year, s.g, s.grp_ord),
pw AS (SELECT *, max(CASE WHEN g = 'total' THEN estimate END) OVER (PARTITION BY level, name, year) AS den,
              max(CASE WHEN g = 'total' THEN moe END) OVER (PARTITION BY level, name, year) AS den_moe FROM proll),
sw AS (SELECT *, max(CASE WHEN g = 'total' THEN estimate END) OVER (PARTITION BY level, name, year) AS den,
              max(CASE WHEN g = 'total' THEN moe END) OVER (PARTITION BY level, name, year) AS den_moe FROM sroll),
u AS (
  SELECT 'total' AS topic, 1 AS topic_ord, level, name, year, 'total_value' AS "group", 1 AS grp_ord, estimate, moe,
         CAST(NULL AS DOUBLE) AS share, CAST(NULL AS DOUBLE) AS sharemoe FROM st WHERE variable = 'ord'
  UNION ALL
  SELECT 'priority', 2, level, name, year, g, grp_ord, estimate, moe, """ + \
    _SHARE_SQL.format(g="g", e="estimate", d="den") + ", " + \
    _SMOE_SQL.format(g="g", e="estimate", d="den", m="moe", dm="den_moe") + """ FROM pw
  UNION ALL
  SELECT 'status', 3, level, name, year, g, grp_ord, estimate, moe, """ + \
    _SHARE_SQL.format(g="g", e="estimate", d="den") + ", " + \
    _SMOE_SQL.format(g="g", e="estimate", d="den", m="moe", dm="den_moe") + """ FROM sw)
SELECT topic, CAST(topic_ord AS INTEGER) AS topic_ord, level, name, year, "group", CAST(grp_ord AS INTEGER) AS grp_ord,
       round(estimate, 2) AS estimate, round(moe, 4) AS moe, round(share, 6) AS share, round(sharemoe, 6) AS sharemoe
FROM u"""

_NB_HD = [("priority", "estimate total", "Order value"), ("priority", "estimate high", "High-priority value"),
          ("priority", "share high", "High-priority rate"), ("priority", "estimate low", "Low-priority value"),
          ("priority", "share low", "Low-priority rate"), ("status", "estimate total", "Order value"),
          ("status", "estimate open", "Open order value"), ("status", "share open", "Open rate")]
_NB_COLS = ",\n".join(f"max(CASE WHEN display = '{d}' THEN value END) AS \"{d}\""
                      for d in ["Order value", "High-priority value", "High-priority rate", "Low-priority value",
                                "Low-priority rate", "Open order value", "Open rate"])

Q["neighborhood_wide"] = _with(*BASE, LEVELMAP, STACKED, NBH, LEAVES) + """
, lng0 AS (SELECT regexp_replace(level, '^[0-9]_', '') AS level, '' AS city, name, year, variable, estimate FROM st
           UNION ALL SELECT 'neighborhoods', city, name, year, variable, estimate FROM nbh),
lb AS (SELECT x.*, string_split(l.label, '!!')[2] AS status, string_split(l.label, '!!')[3] AS priority
       FROM lng0 x LEFT JOIN labels l ON x.variable = l.variable),
d2_labels AS (SELECT variable, string_split(label, '!!')[2] AS status FROM labels
              WHERE string_split(label, '!!')[2] IS NOT NULL AND string_split(label, '!!')[3] IS NULL),
s2pos AS (SELECT status, row_number() OVER (ORDER BY min(variable), status) AS position FROM d2_labels GROUP BY status),
sspec(g, position) AS (VALUES ('total', 1), ('total', 2), ('total', 3), ('open', 2), ('done', 1), ('done', 3)),
proll AS (SELECT x.level, x.city, x.name, x.year, s.g, sum(x.estimate) AS estimate
          FROM lb x JOIN ppos p ON x.priority = p.priority JOIN pspec s ON s.position = p.position
          WHERE x.priority IS NOT NULL GROUP BY x.level, x.city, x.name, x.year, s.g),
sroll AS (SELECT x.level, x.city, x.name, x.year, s.g, sum(x.estimate) AS estimate
          FROM lb x JOIN s2pos p ON x.status = p.status JOIN sspec s ON s.position = p.position
          WHERE x.status IS NOT NULL AND x.priority IS NULL GROUP BY x.level, x.city, x.name, x.year, s.g),
prof AS (
  SELECT 'priority' AS topic, 1 AS topic_ord, level, city, name, year, g, estimate,
         round(CASE WHEN g <> 'total' THEN estimate / max(CASE WHEN g = 'total' THEN estimate END)
                    OVER (PARTITION BY level, city, name, year) END, 2) AS share FROM proll
  UNION ALL
  SELECT 'status', 2, level, city, name, year, g, estimate,
         round(CASE WHEN g <> 'total' THEN estimate / max(CASE WHEN g = 'total' THEN estimate END)
                    OVER (PARTITION BY level, city, name, year) END, 2) FROM sroll),
lk AS (SELECT DISTINCT lower(n.n_name) AS city,
              upper(left(c.c_mktsegment, 1)) || lower(substr(c.c_mktsegment, 2)) AS name, n.n_name AS town
       FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey WHERE r.r_name = 'AMERICA'),
pt AS (SELECT prof.*, lk.town FROM prof LEFT JOIN lk ON prof.city = lk.city AND prof.name = lk.name),
sl(slice, name) AS (VALUES ('nation_0', 'AFRICA'), ('nation_0', 'NATION_0'), ('nation_0', 'World'),
                           ('nation_1', 'AMERICA'), ('nation_1', 'NATION_1'), ('nation_1', 'NATION_6'),
                           ('nation_1', 'World'), ('nation_5', 'AFRICA'), ('nation_5', 'NATION_5'),
                           ('nation_5', 'World')),
slc AS (SELECT DISTINCT slice FROM sl),
sliced AS (SELECT s.slice, p.* FROM pt p JOIN slc s
             ON p.name IN (SELECT x.name FROM sl x WHERE x.slice = s.slice) OR p.city = s.slice),
lng AS (SELECT slice, level, city, town, name, year, topic, topic_ord, 'estimate ' || g AS indicator,
               round(estimate, 2) AS value FROM sliced
        UNION ALL
        SELECT slice, level, city, town, name, year, topic, topic_ord, 'share ' || g, share FROM sliced),
hd(topic, indicator, display) AS (VALUES """ + ", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in _NB_HD) + """),
j AS (SELECT lng.*, hd.display FROM lng LEFT JOIN hd ON lng.topic = hd.topic AND lng.indicator = hd.indicator
      WHERE lng.value IS NOT NULL),
f AS (SELECT *, row_number() OVER (PARTITION BY slice, level, city, town, name, year, indicator
                                   ORDER BY topic_ord, display, value) AS rn FROM j)
SELECT slice, level,
       CASE WHEN city = '' THEN '' ELSE upper(left(replace(city, '_', ' '), 1)) || lower(substr(replace(city, '_', ' '), 2)) END AS city,
       town, name, year,
""" + _NB_COLS + """
FROM f WHERE rn = 1 GROUP BY slice, level, city, town, name, year"""
