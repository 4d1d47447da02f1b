"""The same domain tables in DuckDB SQL, as CTEs put in front of the twins that name them."""

from __future__ import annotations

import re

from checks.views import EVENT_CODES, FORMS

VERTICES = ", ".join(
    f"({form}, {ring}, {place}, {dx}, {dy})"
    for form, rings in enumerate(FORMS)
    for ring, points in enumerate(rings)
    for place, (dx, dy) in enumerate(points)
)

RLAT = "(29 - 2 * (({k} // {n}) % 40)) * 1000"
RLON = "(-99 + 3 * ((({k} // {n}) // 40) % 60)) * 1000"
GEOID = (
    "lpad(CAST(10 + ({k} // 1000000) % 90 AS VARCHAR), 2, '0') || lpad(CAST({k} % 254 AS VARCHAR), 3, '0') "
    "|| lpad(CAST({k} % 1000000 AS VARCHAR), 6, '0')"
)


def rlat(k: str, n: int) -> str:
    return RLAT.format(k=k, n=n)


def rlon(k: str, n: int) -> str:
    return RLON.format(k=k, n=n)


CTES: dict[str, str] = {
    "branches": f"""
        SELECT 'B' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS branch_id,
               CASE WHEN s_suppkey % 17 = 3 THEN 95.0::DOUBLE ELSE ({rlat('s_suppkey', 100)} + s_suppkey * 7919 % 2000) / 1000 END AS lat,
               CASE WHEN s_suppkey % 17 <> 9 THEN ({rlon('s_suppkey', 100)} + s_suppkey * 4729 % 3000) / 1000 END AS lon,
               {rlat('s_suppkey', 100)} + s_suppkey * 7919 % 2000 AS my,
               {rlon('s_suppkey', 100)} + s_suppkey * 4729 % 3000 AS mx
        FROM supplier""",
    "branches_clean": "SELECT * FROM branches WHERE lon IS NOT NULL AND lat IS NOT NULL AND lat <= 90 AND lat >= -90 AND abs(lon) <= 180",
    "tract_points": f"""
        SELECT {GEOID.format(k='p_partkey')} AS geoid,
               ({rlat('p_partkey', 2000)} + p_partkey * 6151 % 2000) / 1000 AS lat,
               ({rlon('p_partkey', 2000)} + p_partkey * 3571 % 3000) / 1000 AS lon,
               CAST(CASE WHEN p_partkey % 9 <> 4 THEN p_size * 1000 + p_partkey % 7 END AS BIGINT) AS area_land,
               CAST(CASE WHEN p_partkey % 10 = 2 THEN 0 WHEN p_partkey % 10 <> 7 THEN p_partkey % 45 * 1000 END AS BIGINT) AS area_water
        FROM part""",
    "tract_codes": "SELECT geoid, left(geoid, 2) AS state_fips, substr(geoid, 3, 3) AS county_fips, right(geoid, 6) AS ce_tract FROM tract_points",
    "tract_edges": f"""
        SELECT {GEOID.format(k='p.p_partkey')} AS geoid, a.ring,
               ox + a.dx AS x1, oy + a.dy AS y1, ox + b.dx AS x2, oy + b.dy AS y2
        FROM (SELECT p_partkey, {rlon('p_partkey', 2000)} + ((p_partkey % 2000) // 40) * 60 AS ox,
                     {rlat('p_partkey', 2000)} + (p_partkey % 2000) % 40 * 50 AS oy,
                     (p_partkey % 2000) % 7 AS form
              FROM part WHERE (p_partkey % 2000) % 97 <> 50) p
        JOIN (VALUES {VERTICES}) a(form, ring, place, dx, dy) ON a.form = p.form
        JOIN (VALUES {VERTICES}) b(form, ring, place, dx, dy)
          ON b.form = a.form AND b.ring = a.ring AND b.place = a.place + 1""",
    "tract_boxes": """
        SELECT geoid, min(least(x1, x2)) AS w, max(greatest(x1, x2)) AS e, min(least(y1, y2)) AS s, max(greatest(y1, y2)) AS n
        FROM tract_edges GROUP BY geoid""",
    "customers": f"""
        SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
               CASE WHEN c_custkey % 19 <> 5 THEN ({rlat('c_custkey', 1500)} + c_custkey * 6577 % 2000) / 1000 END AS latitude,
               ({rlon('c_custkey', 1500)} + c_custkey * 4241 % 3000) / 1000 AS longitude,
               {rlat('c_custkey', 1500)} + c_custkey * 6577 % 2000 AS my,
               {rlon('c_custkey', 1500)} + c_custkey * 4241 % 3000 AS mx
        FROM customer""",
    "inside": """
        SELECT q.id, q.geoid
        FROM (SELECT id, mx, my, geoid FROM places JOIN tract_boxes ON mx > w AND mx < e AND my > s AND my < n) q
        JOIN tract_edges t ON t.geoid = q.geoid
        GROUP BY q.id, q.geoid
        HAVING sum(CASE WHEN (y1 > my) <> (y2 > my)
                         AND ((x2 - x1) * (my - y1) - (mx - x1) * (y2 - y1)) * sign(y2 - y1) > 0 THEN 1 ELSE 0 END) % 2 = 1
           AND sum(CASE WHEN (x2 - x1) * (my - y1) = (mx - x1) * (y2 - y1) AND mx BETWEEN least(x1, x2) AND greatest(x1, x2)
                         AND my BETWEEN least(y1, y2) AND greatest(y1, y2) THEN 1 ELSE 0 END) = 0""",
    "isochrones": f"""
        SELECT 'B' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS bc_code, m AS time_frame_minutes,
               y / 1000 AS branch_latitude, x / 1000 AS branch_longitude,
               x - m * (10 + k % 5) AS w, x + m * (10 + k % 5) AS e, y - m * (8 + k % 4) AS s, y + m * (8 + k % 4) AS n
        FROM (SELECT s_suppkey, s_suppkey AS k, {rlon('s_suppkey', 100)} + s_suppkey * 4729 % 3000 AS x,
                     {rlat('s_suppkey', 100)} + s_suppkey * 7919 % 2000 AS y FROM supplier)
        JOIN (VALUES (5), (10)) t(m) ON TRUE""",
    "reach_matches": """
        SELECT bc_code, branch_latitude, branch_longitude, customer_id, latitude AS cust_lat, longitude AS cust_long,
               time_frame_minutes AS driving_time_minutes
        FROM isochrones JOIN customers ON mx > w AND mx < e AND my > s AND my < n
        WHERE latitude IS NOT NULL""",
    "radii": "SELECT * FROM (VALUES (3, 4828.032::DOUBLE), (5, 8046.72::DOUBLE), (10, 16093.44::DOUBLE)) t(miles, meters)",
    "pairs": """
        SELECT DISTINCT b.branch_id, r.miles, t.geoid
        FROM branches_clean b JOIN tract_points t ON TRUE JOIN radii r
          ON 2 * 6371000 * asin(least(1.0, sqrt(
               pow(sin(radians(t.lat - b.lat) / 2), 2)
               + cos(radians(b.lat)) * cos(radians(t.lat)) * pow(sin(radians(t.lon - b.lon) / 2), 2)))) <= r.meters""",
    "census_raw": """
        SELECT CASE WHEN k % 3 = 0 THEN ' ' || s || ' ' ELSE s END AS c2, CAST(k % 254 AS VARCHAR) AS c3,
               CASE WHEN k % 5 = 0 THEN left(t6, 4) || '.' || right(t6, 2) ELSE CAST(k % 1000000 AS VARCHAR) END AS c4,
               CASE WHEN k % 4 = 0 THEN ' T ' ELSE 'F' END AS c5, 'N' AS c6, '' AS c7, 'D' AS c8,
               CASE WHEN k % 2 = 0 THEN 'U' ELSE 'R ' END AS c9,
               CAST(k % 900 AS VARCHAR) || '.25' AS c10,
               CASE WHEN k % 6 = 0 THEN 'n/a' ELSE CAST(k * 3 % 70000 AS VARCHAR) END AS c11,
               CASE WHEN k % 8 = 0 THEN '' ELSE ' ' || CAST(k % 150 AS VARCHAR) || '.5 ' END AS c12,
               '65000' AS c13,
               CASE WHEN k % 13 = 0 THEN '9' ELSE CAST(k % 6 AS VARCHAR) END AS c14,
               CASE k % 4 WHEN 0 THEN 'X' WHEN 1 THEN 'x' ELSE '' END AS c15,
               CASE WHEN k % 5 = 0 THEN ' X ' ELSE '' END AS c16,
               CASE WHEN k % 7 = 0 THEN 'X' ELSE 'I' END AS c17,
               CASE WHEN k % 8 = 0 THEN 'X' ELSE '' END AS c18,
               CASE WHEN k % 11 = 0 THEN '' WHEN k % 11 = 1 THEN '  ' WHEN k % 11 = 2 THEN '12.0' WHEN k % 11 = 3 THEN 'abc'
                    WHEN k % 11 = 4 AND pop >= 1000 THEN CAST(pop // 1000 AS VARCHAR) || ',' || lpad(CAST(pop % 1000 AS VARCHAR), 3, '0')
                    ELSE ' ' || CAST(pop AS VARCHAR) END AS c22
        FROM (SELECT p_partkey AS k, CAST(10 + (p_partkey // 1000000) % 90 AS VARCHAR) AS s,
                     lpad(CAST(p_partkey % 1000000 AS VARCHAR), 6, '0') AS t6,
                     p_size * 100 + p_partkey % 1000 AS pop FROM part)""",
    "census": """
        SELECT lpad(trim(c2), 2, '0') || lpad(trim(c3), 3, '0') || lpad(replace(trim(c4), '.', ''), 6, '0') AS geoid,
               TRY_CAST(pop_txt AS BIGINT) AS population, trim(c9) AS urban_rural_ind, trim(c14) AS ind, *
        FROM (SELECT *, nullif(replace(trim(c22), ',', ''), '') AS pop_txt FROM census_raw)
        WHERE pop_txt IS NOT NULL""",
    "pop_long": """
        SELECT branch_id, miles, CAST(sum(population) AS BIGINT) AS population_in_radius
        FROM pairs JOIN census USING (geoid) GROUP BY ALL""",
    "pop_wide": """
        SELECT branch_id,
               CAST(sum(CASE WHEN miles = 3 THEN population_in_radius ELSE 0 END) AS BIGINT) AS pop_3mi,
               CAST(sum(CASE WHEN miles = 5 THEN population_in_radius ELSE 0 END) AS BIGINT) AS pop_5mi,
               CAST(sum(CASE WHEN miles = 10 THEN population_in_radius ELSE 0 END) AS BIGINT) AS pop_10mi
        FROM pop_long GROUP BY branch_id""",
    "branch_places": "SELECT branch_id AS id, mx, my FROM branches_clean",
    "customer_places": "SELECT customer_id AS id, mx, my FROM customers WHERE latitude IS NOT NULL",
    "deposits": """
        SELECT year(o_orderdate) AS "YEAR", o_custkey % 50 AS "CERT",
               (['N', 'NM', 'SM', 'SB', 'SA', 'NC'])[o_custkey % 6 + 1] AS "BKCLASS", n_name AS "STALPBR",
               c_mktsegment AS "CNTYNAMB", o_orderkey AS "UNINUMBR",
               CAST(o_totalprice AS DECIMAL(18, 2)) AS "DEPSUMBR",
               CAST(CAST(o_totalprice AS DECIMAL(18, 2)) * (o_custkey % 3 + 1) AS DECIMAL(18, 2)) AS "DEPSUM",
               CAST(o_orderkey * 7 % 100000 AS VARCHAR) AS "ZIP_RAW"
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "institutions": """
        SELECT k AS "CERT", c_name AS "NAME",
               (['Y', 'y', 'N', NULL])[k % 4 + 1] AS flg, (['1', '0', NULL])[k % 3 + 1] AS metro_flg,
               CAST(10000 + k % 500 AS VARCHAR) AS cbsa_no, 'Metro ' || (k % 500) AS cbsa,
               (['CFPB', 'OCC', 'cfpb', NULL])[k % 4 + 1] AS regagent2, (['31-Dec-99', '01-Jan-20'])[(k // 4) % 2 + 1] AS cfpb_end,
               (['OCC', 'State', 'OTS', 'state', NULL])[k % 5 + 1] AS chrtagnt, (['Y', 'L', 'N'])[k % 3 + 1] AS iba_flg,
               (['y', 'N'])[k % 2 + 1] AS sasser_flg, (['BIF', 'SAIF', 'DIF', 'None', NULL])[k % 5 + 1] AS insagnt1,
               (['SAIF', 'DIF'])[k % 2 + 1] AS insagnt2, (['N', 'SM', 'nm', 'NC', 'SB', 'sm'])[k % 6 + 1] AS bkclass,
               ([100, 110, 115, 120, 130, 135, 140])[k % 7 + 1] AS org_typ, k % 12 AS specgrp,
               (['16', '05'])[k % 2 + 1] AS suprv, '2019010' || (1 + k % 2) AS eff, '99991231' AS "end",
               '2001-0' || (1 + k % 9) || '-11T00:00:00' AS estb,
               CASE WHEN k % 5 = 0 THEN 'bad' ELSE '19' || (10 + k % 80) || '-12-01T08:30:00' END AS insured_from,
               CASE WHEN k % 9 <> 0 THEN CAST(k * 31 % 100000 AS VARCHAR) END AS zip_raw
        FROM (SELECT c_custkey AS k, c_name FROM customer)""",
    "history": f"""
        SELECT k AS "CERT", i, ({EVENT_CODES})[(k * 3 + i * 5) % {len(EVENT_CODES)} + 1] AS code, (k * 7 + i * 11) % 40 - 5 AS acquirer,
               CASE WHEN i % 3 = 0 THEN c_name ELSE 'Old Name ' || ((k + i) % 4) END AS name, c_name,
               '2019010' || (1 + CASE WHEN (k + i) % 4 = 0 THEN (k + 1) % 2 ELSE k % 2 END) AS eff,
               '2019010' || (1 + k % 2) AS org_eff,
               '2020-0' || (1 + (k + i * i) % 3) || '-15T00:00:00' AS proc,
               CASE WHEN (k + i) % 3 = 0 THEN 'DIF' ELSE 'None' END AS fund,
               CAST((k * 13 + i * 977) % 100000 AS VARCHAR) AS zip_raw
        FROM (SELECT c_custkey AS k, c_name FROM customer WHERE c_custkey % 23 <> 0)
        JOIN (SELECT unnest(range(6)) AS i) ON i < k % 6""",
    "query_log": """
        SELECT event_type || '_' || (user_id % 5) || '.sql' AS query_name, ts AS last_run,
               (['now', 'daily', 'weekly', 'quarterly', 'hourly'])[user_id % 5 + 1] AS frequency,
               CASE WHEN event_type = 'error' OR event_id % 7 = 0 THEN 'failed' ELSE 'success' END AS status,
               value AS execution_time_seconds, CASE WHEN event_type = 'error' THEN 'boom' END AS error_message,
               'u' || user_id AS user_id
        FROM events""",
    "datasets": """
        SELECT 'DS_' || p_partkey || '.parquet' AS name, new_size,
               CASE WHEN p_partkey % 7 = 0 THEN NULL WHEN p_partkey % 7 = 1 THEN 0 ELSE new_size + (p_partkey % 5 - 2) * 300 END AS core_size,
               p_partkey AS k
        FROM (SELECT p_partkey, CAST(p_size AS BIGINT) * 1000 + p_partkey % 500 AS new_size FROM part)""",
    "changes": """
        SELECT user_id AS id, event_type || '-' || event_id AS name, epoch_us(ts) // 1000 AS last_modified_ts, event_id FROM events""",
    "site_users": """
        SELECT CAST(c_custkey AS VARCHAR) AS id, CASE WHEN c_custkey % 2 = 0 THEN upper(c_name) ELSE c_name END AS name,
               'Full ' || c_custkey AS fullname, CASE WHEN c_custkey % 3 <> 0 THEN 'u' || c_custkey || '@site' END AS email,
               CASE WHEN c_custkey % 10 = 0 THEN 'Unlicensed' WHEN c_custkey % 10 <> 1 THEN 'Viewer' END AS site_role,
               'SAML' AS auth_setting
        FROM customer""",
    "site_groups": "SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS name FROM nation",
    "members": """
        SELECT CAST(g AS VARCHAR) AS group_id, CAST(c_custkey AS VARCHAR) AS user_id
        FROM (SELECT c_custkey, c_nationkey AS g FROM customer WHERE c_custkey % 8 <> 0
              UNION ALL SELECT c_custkey, (c_nationkey + 1 + c_custkey % 3) % 25 FROM customer WHERE c_custkey % 8 <> 0)""",
    "projects": "SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS name FROM nation",
    "workbooks": """
        SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS name, CAST(s_suppkey % 20 AS VARCHAR) AS project_id,
               'o' || s_nationkey AS owner_id FROM supplier""",
    "datasources": "SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name, CAST(p_partkey % 23 AS VARCHAR) AS project_id FROM part",
    "site_views": """
        SELECT CAST(s_suppkey AS VARCHAR) AS workbook_id, 'View ' || n AS name
        FROM supplier JOIN (SELECT unnest(range(1, 5)) AS n) ON n <= s_suppkey % 4""",
    "connections": """
        SELECT CAST(l_suppkey AS VARCHAR) AS workbook_id,
               CASE WHEN l_linenumber <> 7 THEN CAST(l_partkey AS VARCHAR) END AS datasource_id, 'sqlserver' AS connection_type
        FROM lineitem""",
}


def _needs(sql: str, seen: list[str]) -> None:
    for name, body in CTES.items():
        if name not in seen and re.search(rf"\b(FROM|JOIN)\s+{name}\b", sql):
            _needs(body, seen)
            seen.append(name)


def twin(sql: str, **renamed: str) -> str:
    """The query with every domain table it names in front. ``renamed`` adds an alias CTE, e.g. places=..."""
    seen: list[str] = []
    extra = {alias: f"SELECT * FROM {name}" for alias, name in renamed.items()}
    for alias_sql in extra.values():
        _needs(alias_sql, seen)
    parts = [f"{name} AS ({CTES[name]})" for name in seen]
    parts += [f"{alias} AS ({body})" for alias, body in extra.items()]
    more: list[str] = list(seen)
    _needs(sql, more)
    parts += [f"{name} AS ({CTES[name]})" for name in more[len(seen) :]]
    return (f"WITH {', '.join(parts)} " if parts else "") + sql.strip()
