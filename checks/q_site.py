"""Directory, site inventory and page queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from catchment.functions import html
from catchment.operators import lookup, profile
from catchment.plans import routing, site
from checks.registry import check

NOW = dt.datetime(2024, 1, 31)

ACH_SQL = """SELECT lpad(CAST(s_suppkey AS VARCHAR), 9, '0') AS routing_number, CASE WHEN s_suppkey % 4 <> 0 THEN s_name END AS bank_name,
    'Street ' || s_nationkey AS address_full, 'a' || s_suppkey AS source_url FROM supplier WHERE s_acctbal > 1000"""
WIRE_SQL = """SELECT lpad(CAST(s_suppkey AS VARCHAR), 9, '0') AS routing_number, 'Wire ' || s_name AS bank_name,
    upper(s_name) AS telegraphic_name, 'w' || s_suppkey AS source_url FROM supplier WHERE s_acctbal < 7000"""


def ach(v):
    return v.table("supplier").filter("s_acctbal > 1000").selectExpr(
        "lpad(s_suppkey, 9, '0') as routing_number", "if(s_suppkey % 4 <> 0, s_name, null) as bank_name",
        "concat('Street ', s_nationkey) as address_full", "concat('a', s_suppkey) as source_url",
    )


def wire(v):
    return v.table("supplier").filter("s_acctbal < 7000").selectExpr(
        "lpad(s_suppkey, 9, '0') as routing_number", "concat('Wire ', s_name) as bank_name",
        "upper(s_name) as telegraphic_name", "concat('w', s_suppkey) as source_url",
    )


@check("join11_directory", f"""
    SELECT coalesce(a.routing_number, w.routing_number) AS routing_number, coalesce(a.bank_name, w.bank_name) AS bank_name, address_full, telegraphic_name,
           a.source_url AS source_url_ach, w.source_url AS source_url_wire
    FROM ({ACH_SQL}) a FULL JOIN ({WIRE_SQL}) w ON a.routing_number = w.routing_number""")
def _(v):
    return lookup.routing_directory(ach(v), wire(v))


@check("join12_only_left", f"SELECT routing_number, bank_name FROM ({ACH_SQL}) WHERE routing_number NOT IN (SELECT routing_number FROM ({WIRE_SQL}))")
def _(v):
    return lookup.only_left(ach(v), wire(v), "routing_number").select("routing_number", "bank_name")


@check("join13_project_dashboards", "SELECT p.name AS project_name, w.name AS dashboard_name FROM projects p LEFT JOIN workbooks w ON w.project_id = p.id")
def _(v):
    return lookup.per_project(v.projects, v.workbooks, "dashboard_name")


@check("join14_project_datasources", """
    SELECT 'all' AS asked, p.name AS project_name, d.name AS datasource_name FROM projects p LEFT JOIN datasources d ON d.project_id = p.id
    UNION ALL SELECT 'one', p.name, d.name FROM projects p LEFT JOIN datasources d ON d.project_id = p.id WHERE p.name = 'NATION_3'""")
def _(v):
    every = lookup.per_project(v.projects, v.datasources, "datasource_name")
    one = lookup.per_project(v.projects, v.datasources, "datasource_name", "NATION_3")
    return every.select(F.lit("all").alias("asked"), "*").unionByName(one.select(F.lit("one").alias("asked"), "*"))


DIRECTORY = """
    SELECT u.name AS username, u.fullname AS full_name, coalesce(u.email, u.name) AS email, u.site_role, u.auth_setting, coalesce(g.names, '') AS group_memberships
    FROM site_users u LEFT JOIN (SELECT user_id, string_agg(name, ', ' ORDER BY name) AS names FROM members JOIN site_groups ON id = group_id GROUP BY user_id) g ON g.user_id = u.id"""


@check("join15_user_directory", DIRECTORY)
def _(v):
    return lookup.user_directory(v.site_users, v.members, v.site_groups)


@check("flt07_active_members", "SELECT id, name FROM site_users WHERE site_role IS NOT NULL AND lower(site_role) <> 'unlicensed'")
def _(v):
    return lookup.active_users(v.site_users).select("id", "name")


@check("join16_users_in_group", """SELECT id, name FROM site_users WHERE site_role IS NOT NULL AND lower(site_role) <> 'unlicensed'
    AND id IN (SELECT user_id FROM members JOIN site_groups g ON g.id = group_id WHERE g.name = 'NATION_4')""")
def _(v):
    return lookup.users_in_group(lookup.active_users(v.site_users), v.members, v.site_groups, "NATION_4").select("id", "name")


@check("join17_workbooks_using", "SELECT id, name FROM workbooks WHERE id IN (SELECT workbook_id FROM connections WHERE datasource_id = '17')")
def _(v):
    return lookup.workbooks_using(v.workbooks, v.connections, "17").select("id", "name")


REQUESTS_SQL = """SELECT CASE WHEN c_custkey % 3 = 0 THEN 'new' || c_custkey WHEN c_custkey % 3 = 1 THEN lower(c_name) ELSE upper(c_name) END AS user_email,
    CASE WHEN c_custkey % 10 = 0 THEN 'No Group' ELSE 'NATION_' || c_nationkey END AS group_name FROM customer"""


@check("join18_membership_plan", f"""
    SELECT r.user_email, r.group_name, CASE WHEN u.id IS NULL THEN 'added' ELSE 'existing' END AS user_action,
           CASE WHEN g.id IS NULL THEN NULL WHEN EXISTS (SELECT 1 FROM members m WHERE m.user_id = u.id AND m.group_id = g.id) THEN 'already' ELSE 'added' END AS group_action,
           CASE WHEN g.id IS NULL THEN 'group ' || r.group_name || ' not found' END AS error
    FROM ({REQUESTS_SQL}) r LEFT JOIN site_users u ON lower(u.name) = lower(r.user_email) LEFT JOIN site_groups g ON g.name = r.group_name""")
def _(v):
    requests = v.table("customer").selectExpr(
        "case c_custkey % 3 when 0 then concat('new', c_custkey) when 1 then lower(c_name) else upper(c_name) end as user_email",
        "if(c_custkey % 10 = 0, 'No Group', concat('NATION_', c_nationkey)) as group_name",
    )
    return lookup.membership_plan(requests, v.site_users, v.members, v.site_groups)


WORKBOOKS = """
    SELECT w.id AS workbook_id, w.name AS workbook_name, w.project_id, w.owner_id, coalesce(c.listed, '') AS connections, coalesce(s.listed, '') AS views
    FROM workbooks w LEFT JOIN (SELECT workbook_id, string_agg(name, ', ' ORDER BY name) AS listed FROM site_views GROUP BY workbook_id) s ON s.workbook_id = w.id
    LEFT JOIN (SELECT workbook_id, string_agg(t, ', ' ORDER BY t) AS listed FROM (SELECT workbook_id, coalesce(datasource_id, connection_type) AS t FROM connections)
               GROUP BY workbook_id) c ON c.workbook_id = w.id"""


@check("agg15_joined_names", WORKBOOKS)
def _(v):
    return site.workbook_details(v.workbooks, v.site_views, v.connections)


@check("pip10_site_inventory", f"""
    SELECT 'users' AS output, username AS a, group_memberships AS b FROM ({DIRECTORY})
    UNION ALL SELECT 'active', username, group_memberships FROM ({DIRECTORY}) WHERE site_role IS NOT NULL AND lower(site_role) <> 'unlicensed'
    UNION ALL SELECT 'dashboards', p.name, w.name FROM projects p LEFT JOIN workbooks w ON w.project_id = p.id
    UNION ALL SELECT 'datasources', p.name, d.name FROM projects p LEFT JOIN datasources d ON d.project_id = p.id
    UNION ALL SELECT 'workbooks', workbook_name, views FROM ({WORKBOOKS})""")
def _(v):
    out = site.site_inventory(v.site_users, v.site_groups, v.members, v.projects, v.workbooks, v.datasources, v.site_views, v.connections)
    pick = {
        "users": ("users", "username", "group_memberships"),
        "active": ("active_users", "username", "group_memberships"),
        "dashboards": ("dashboards", "project_name", "dashboard_name"),
        "datasources": ("datasources", "project_name", "datasource_name"),
        "workbooks": ("workbooks", "workbook_name", "views"),
    }
    parts = [out[t].selectExpr(f"'{n}' as output", f"{a} as a", f"{b} as b") for n, (t, a, b) in pick.items()]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


@check("agg10_table_inventory", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count, {n} AS column_count FROM {t}" for t, n in (("nation", 3), ("orders", 6), ("lineitem", 11), ("pages", 3))))
def _(v):
    return profile.table_inventory({t: v.table(t) for t in ("nation", "orders", "lineitem", "pages")})


@check("agg12_describe_parquet", "SELECT count(*) AS row_count, 11 AS column_count FROM lineitem")
def _(v):
    return profile.describe_parquet(v.spark, f"{v.sf_dir}/lineitem.parquet").select("row_count", "column_count")


# ---------------------------------------------------------------- pages

ITEMS_SQL = "SELECT page_id, generate_subscripts(i, 1) AS place, unnest(i) AS raw FROM (SELECT page_id, regexp_extract_all(html, '(?s)<li>(.*?)</li>', 1) AS i FROM pages)"


@check("fun14_list_items", f"SELECT page_id, CAST(place AS INTEGER) AS place, trim(regexp_replace(raw, '<[^>]*>', '', 'g')) AS item FROM ({ITEMS_SQL})")
def _(v):
    return html.list_items(v.table("pages").select("page_id", "html")).select("page_id", "place", "item")


def detail_pages(v):
    """Every given page as a routing page of its own: sections, statuses and faults follow from its id."""
    section = "concat('<h2>{0}</h2><div><p>Name: Bank ', page_id, '</p><p>{1}:</p><p>{2} ', page_id, '</p><p>{3}: 0', 1 + page_id % 9, '/15/2020</p>{4}</div>')"
    ach_part = section.format("FedACH Routing", "Address", "1 Main St", "Change Date", "<p>Servicing Fed&#39;s Main Office: 0', 10000000 + page_id, ', 1000 Peachtree</p>")
    wire_part = section.format("Fedwire Routing", "Location", "City", "Revision Date", "")
    return v.table("pages").selectExpr(
        "lpad(page_id, 9, '0') as routing_number",
        "url",
        "case page_id % 7 when 5 then 404 when 6 then 0 else 200 end as status",
        f"""if(page_id % 7 = 6, null, concat('<html><body><h1>Bank</h1>', if(page_id % 7 in (0, 1, 2), {ach_part}, ''),
            if(page_id % 7 in (0, 1, 3), {wire_part}, ''), '<h2>More</h2>', html, '</body></html>')) as html""",
    )


@check("fun13_label_values", """
    SELECT lpad(CAST(page_id AS VARCHAR), 9, '0') AS routing_number,
           CASE WHEN page_id % 7 IN (0, 1, 2) THEN 'Bank ' || page_id END AS ach_name, CASE WHEN page_id % 7 IN (0, 1, 2) THEN '1 Main St ' || page_id END AS ach_address,
           CASE WHEN page_id % 7 IN (0, 1, 3) THEN 'City ' || page_id END AS wire_location, CASE WHEN page_id % 7 IN (0, 1, 3) THEN '0' || (1 + page_id % 9) || '/15/2020' END AS revision
    FROM pages""")
def _(v):
    return routing.parse_pages(detail_pages(v)).selectExpr(
        "routing_number",
        "try_element_at(ach, 'Name') as ach_name",
        "try_element_at(ach, 'Address') as ach_address",
        "try_element_at(wire, 'Location') as wire_location",
        "try_element_at(wire, 'Revision Date') as revision",
    )


OUTCOMES = """
    SELECT lpad(CAST(page_id AS VARCHAR), 9, '0') AS routing_number, CASE WHEN page_id % 7 IN (5, 6) THEN 'FAIL' WHEN page_id % 7 = 4 THEN 'WARN' ELSE 'OK' END AS level,
           CASE page_id % 7 WHEN 5 THEN 'HTTPError' WHEN 6 THEN 'RequestException' WHEN 4 THEN 'MissingContent' END AS error_type,
           CASE page_id % 7 WHEN 5 THEN 'status=404' WHEN 6 THEN 'request failed' WHEN 4 THEN 'no FedACH or Fedwire section found' END AS error_message, page_id FROM pages"""


@check("fun15_page_outcomes", f"SELECT routing_number, level, error_type, error_message FROM ({OUTCOMES})")
def _(v):
    return routing.page_outcomes(routing.parse_pages(detail_pages(v))).select("routing_number", "level", "error_type", "error_message")


@check("prj22_ach_wire_rows", f"""
    SELECT routing_number, CASE WHEN page_id % 7 <> 3 THEN 'Bank ' || page_id END AS ach_name, CASE WHEN page_id % 7 <> 3 THEN '0' || (10000000 + page_id) END AS rtn,
           CASE WHEN page_id % 7 <> 3 THEN '1000 Peachtree' END AS addr, CASE WHEN page_id % 7 <> 3 THEN '2020-0' || (1 + page_id % 9) || '-15' END AS change_date,
           CASE WHEN page_id % 7 <> 2 THEN 'Bank ' || page_id END AS wire_name, CASE WHEN page_id % 7 <> 2 THEN 'City ' || page_id END AS location
    FROM ({OUTCOMES}) WHERE level = 'OK'""")
def _(v):
    outcomes = routing.page_outcomes(routing.parse_pages(detail_pages(v)))
    left = routing.ach_rows(outcomes, NOW).selectExpr(
        "routing_number", "bank_name as ach_name", "servicing_fed_main_office_rtn as rtn", "servicing_fed_main_office_addr as addr",
        "cast(change_date as string) as change_date",
    )
    right = routing.wire_rows(outcomes, NOW).selectExpr("routing_number", "bank_name as wire_name", "location")
    return left.join(right, "routing_number")


@check("udf04_row_generator", "SELECT page_id, 'C' || page_id AS code, 'Bank' AS bank FROM pages JOIN (SELECT unnest(range(4)) AS n) ON n < page_id % 4")
def _(v):
    """One table per page, its rows wide or short by page id."""
    tables = v.table("pages").selectExpr(
        "page_id",
        """concat('<table class="x swift-country"><thead><tr><th>Code</th><th>Bank</th></tr></thead><tbody>',
                  repeat(concat('<tr><td> C', page_id, ' </td><td>Bank</td></tr>'), cast(page_id % 4 as int)), '<tr><td>short</td></tr></tbody></table>', html) as html""",
    )
    return html.table_rows(tables, "swift-country").selectExpr("page_id", "row['Code'] as code", "row['Bank'] as bank")


@check("pip06_routing_directory", f"""
    SELECT 'directory' AS output, routing_number, 'Bank ' || page_id AS value FROM ({OUTCOMES}) WHERE level = 'OK'
    UNION ALL SELECT 'failures', routing_number, error_type FROM ({OUTCOMES}) WHERE level <> 'OK'""")
def _(v):
    pages = detail_pages(v)
    wanted = routing.codes(v.table("pages").selectExpr("cast(page_id as string) as raw"), "raw")
    out = routing.routing_pages(wanted, pages, NOW)
    return out["directory"].selectExpr("'directory' as output", "routing_number", "bank_name as value").unionByName(
        out["failures"].selectExpr("'failures' as output", "routing_number", "error_type as value")
    )
