"""Cleaning, census, code and date queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from catchment.functions import census as rules
from catchment.functions import text
from catchment.operators import cleaning, profile
from catchment.plans import places
from catchment.sources import readers
from checks.registry import check

MESSY_SPARK = {
    "id": "doc_id",
    "value": """case doc_id % 7 when 0 then '' when 1 then '  ' when 2 then ' NaN ' when 3 then 'nan' when 4 then concat('  ', lang, ' ')
                when 5 then null else text end""",
}
MESSY_SQL = """SELECT doc_id AS id, CASE doc_id % 7 WHEN 0 THEN '' WHEN 1 THEN '  ' WHEN 2 THEN ' NaN ' WHEN 3 THEN 'nan'
                WHEN 4 THEN '  ' || lang || ' ' WHEN 5 THEN NULL ELSE text END AS value FROM documents"""

# Dates in the forms both date rules must tell apart, from the order date and key.
DATES_SPARK = """case o_orderkey % 9
    when 0 then date_format(o_orderdate, 'dd/MM/yyyy') when 1 then date_format(o_orderdate, 'MM/dd/yyyy')
    when 2 then date_format(o_orderdate, 'yyyy-M-d') when 3 then date_format(o_orderdate, 'd-M-yyyy')
    when 4 then concat(' ', date_format(o_orderdate, 'yyyy/MM/dd'), '  ') when 5 then '2023-02-30'
    when 6 then concat('soon ', o_orderkey % 5) when 7 then null else date_format(o_orderdate, 'M-d-yyyy') end"""
DATES_SQL = """SELECT o_orderkey AS id, CASE o_orderkey % 9
    WHEN 0 THEN strftime(o_orderdate, '%d/%m/%Y') WHEN 1 THEN strftime(o_orderdate, '%m/%d/%Y')
    WHEN 2 THEN strftime(o_orderdate, '%Y-%-m-%-d') WHEN 3 THEN strftime(o_orderdate, '%-d-%-m-%Y')
    WHEN 4 THEN ' ' || strftime(o_orderdate, '%Y/%m/%d') || '  ' WHEN 5 THEN '2023-02-30'
    WHEN 6 THEN 'soon ' || (o_orderkey % 5) WHEN 7 THEN NULL ELSE strftime(o_orderdate, '%-m-%-d-%Y') END AS raw FROM orders"""
NORMAL_DATE_SQL = f"""
    SELECT id, coalesce(strftime(coalesce(try_strptime(d, '%Y-%m-%d'), try_strptime(d, '%d-%m-%Y'), try_strptime(d, '%m-%d-%Y')), '%Y-%m-%d'), d) AS order_date
    FROM (SELECT id, regexp_replace(trim(raw), '[/\\s]', '-', 'g') AS d FROM ({DATES_SQL}))"""

CODES_SPARK = """case c_custkey % 6 when 0 then concat(lpad(c_custkey, 4, '0'), '-', lpad(c_custkey % 997, 5, '0'))
    when 1 then cast(c_custkey as string) when 2 then '' when 3 then concat('12345', lpad(c_custkey, 5, '0'))
    when 4 then null else cast(c_custkey % 40 as string) end"""
CODES_SQL = """SELECT c_custkey AS id, CASE c_custkey % 6 WHEN 0 THEN lpad(CAST(c_custkey AS VARCHAR), 4, '0') || '-' || lpad(CAST(c_custkey % 997 AS VARCHAR), 5, '0')
    WHEN 1 THEN CAST(c_custkey AS VARCHAR) WHEN 2 THEN '' WHEN 3 THEN '12345' || lpad(CAST(c_custkey AS VARCHAR), 5, '0')
    WHEN 4 THEN NULL ELSE CAST(c_custkey % 40 AS VARCHAR) END AS raw FROM customer"""
VALID_CODES_SQL = f"""SELECT id, CASE WHEN length(d) BETWEEN 1 AND 9 THEN right('000000000' || d, 9) END AS code
    FROM (SELECT id, regexp_replace(raw, '[^0-9]', '', 'g') AS d FROM ({CODES_SQL}))"""


def messy(v):
    return v.table("documents").selectExpr(*[f"{e} as {n}" for n, e in MESSY_SPARK.items()])


def dated(v, name="order_date"):
    return v.table("orders").selectExpr("o_orderkey as id", f"{DATES_SPARK} as {name}")


def coded(v):
    return v.table("customer").selectExpr("c_custkey as id", f"{CODES_SPARK} as raw")


@check("prj01_clean_column_names", 'SELECT o_orderkey AS order_key_, o_totalprice AS total_price, o_orderstatus AS "status__1" FROM orders')
def _(v):
    raw = v.table("orders").selectExpr("o_orderkey as ` Order Key# `", "o_totalprice as `Total-Price `", "o_orderstatus as `STATUS (1`")
    return cleaning.clean_column_names(raw)


@check("prj02_drop_all_null_columns", "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS some FROM orders")
def _(v):
    return cleaning.drop_all_null_columns(
        v.table("orders").selectExpr("o_orderkey as id", "if(o_orderkey % 2 = 0, o_orderstatus, null) as some", "cast(null as string) as none")
    )


@check("prj03_empty_to_null", f"""SELECT id, CASE WHEN lower(trim(value)) NOT IN ('', 'nan') THEN trim(value) END AS value FROM ({MESSY_SQL})""")
def _(v):
    return cleaning.empty_to_null(messy(v))


@check("prj05_normalize_date", NORMAL_DATE_SQL)
def _(v):
    return dated(v).select("id", text.normalize_date(F.col("order_date")).alias("order_date"))


@check(
    "prj06_normalize_date_columns",
    f"""SELECT a.id, a.order_date AS "Start_Date", b.raw AS other FROM ({NORMAL_DATE_SQL}) a JOIN ({DATES_SQL}) b ON a.id = b.id""",
)
def _(v):
    return cleaning.normalize_date_columns(dated(v, "Start_Date").withColumn("other", F.col("Start_Date")))


@check(
    "prj07_clean_frame",
    f"""SELECT id AS doc_id, CASE WHEN lower(trim(value)) NOT IN ('', 'nan') THEN trim(value) END AS main_text FROM ({MESSY_SQL})""",
)
def _(v):
    raw = messy(v).selectExpr("id as `Doc Id`", "value as `Main-Text `", "cast(null as int) as Nothing")
    return cleaning.clean_frame(raw)


@check(
    "prj08_narrow_types",
    """
    SELECT 'o_orderkey' AS column_name, 'bigint' AS type,
           CASE WHEN min(o_orderkey) >= -2147483648 AND max(o_orderkey) <= 2147483647 THEN 'int' ELSE 'bigint' END AS narrow_type,
           0 AS low_cardinality, 8 AS bytes_before, CASE WHEN max(o_orderkey) <= 2147483647 THEN 4 ELSE 8 END AS bytes_after FROM orders
    UNION ALL SELECT 'wide', 'bigint', 'bigint', 0, 8, 8
    UNION ALL SELECT 'o_totalprice', 'double', 'float', 0, 8, 4
    UNION ALL SELECT 'o_orderstatus', 'string', 'string', CAST(count(DISTINCT o_orderstatus) < count(*) * 0.25 AS INTEGER), NULL, NULL FROM orders
    UNION ALL SELECT 'code', 'string', 'string', 0, NULL, NULL
    """,
)
def _(v):
    return cleaning.narrowing_plan(
        v.table("orders").selectExpr("o_orderkey", "o_orderkey + 3000000000 as wide", "o_totalprice", "o_orderstatus", "concat('c', o_orderkey) as code")
    )


@check("prj09_valid_coordinates", "SELECT branch_id, lat, lon FROM branches_clean")
def _(v):
    return cleaning.valid_coordinates(v.branches)


@check("prj10_drop_missing_coordinates", "SELECT customer_id, latitude, longitude FROM customers WHERE latitude IS NOT NULL")
def _(v):
    as_text = v.customers.withColumns({c: F.col(c).cast("string") for c in ("latitude", "longitude")})
    return cleaning.drop_missing_coordinates(as_text, "latitude", "longitude")


CENSUS_KEY = "lpad(trim(c2), 2, '0') || lpad(trim(c3), 3, '0') || lpad(replace(trim(c4), '.', ''), 6, '0') AS geoid"


@check("prj11_build_geoid", f"SELECT {CENSUS_KEY} FROM census_raw")
def _(v):
    return v.census_raw.select(rules.build_geoid(F.col("_c2"), F.col("_c3"), F.col("_c4")).alias("geoid"))


@check("prj12_parse_population", "SELECT geoid, population FROM census")
def _(v):
    return (
        v.census_raw.filter(rules.population_text(F.col("_c22")).isNotNull())
        .select(
            rules.build_geoid(F.col("_c2"), F.col("_c3"), F.col("_c4")).alias("geoid"),
            rules.parse_population(F.col("_c22")).alias("population"),
        )
    )


def census_field(v, **fields):
    return v.census_raw.select(
        rules.build_geoid(F.col("_c2"), F.col("_c3"), F.col("_c4")).alias("geoid"), *[e.alias(n) for n, e in fields.items()]
    )


@check(
    "prj13_income_class",
    f"""SELECT {CENSUS_KEY}, CASE trim(c14) WHEN '1' THEN 'low' WHEN '2' THEN 'moderate' WHEN '3' THEN 'middle' WHEN '4' THEN 'upper'
        WHEN '0' THEN 'NA' END AS cra_income_class FROM census_raw""",
)
def _(v):
    return census_field(v, cra_income_class=rules.income_class(F.trim("_c14")))


@check("prj14_lmi_flag", f"SELECT {CENSUS_KEY}, CASE WHEN trim(c14) IN ('1', '2') THEN 1 ELSE 0 END AS lmi_ind FROM census_raw")
def _(v):
    return census_field(v, lmi_ind=rules.lmi_flag(F.trim("_c14")))


@check(
    "prj15_x_flags",
    f"""SELECT {CENSUS_KEY}, CASE WHEN trim(c15) = 'X' THEN 1 ELSE 0 END AS cra_poverty, CASE WHEN trim(c16) = 'X' THEN 1 ELSE 0 END AS cra_unemployment,
        CASE WHEN trim(c17) = 'X' THEN 1 ELSE 0 END AS cra_distressed, CASE WHEN trim(c18) = 'X' THEN 1 ELSE 0 END AS cra_remote_area FROM census_raw""",
)
def _(v):
    return census_field(v, **{n: rules.x_flag(F.trim(c)) for n, c in places.CENSUS_FLAGS.items()})


@check(
    "prj16_income_decimals",
    f"""SELECT {CENSUS_KEY}, CAST(TRY_CAST(trim(c10) AS DECIMAL(18,2)) AS VARCHAR) AS a, CAST(TRY_CAST(trim(c11) AS DECIMAL(18,2)) AS VARCHAR) AS b,
        CAST(TRY_CAST(trim(c12) AS DECIMAL(18,2)) AS VARCHAR) AS c, CAST(TRY_CAST(trim(c13) AS DECIMAL(18,2)) AS VARCHAR) AS d FROM census_raw""",
)
def _(v):
    amounts = zip("abcd", places.CENSUS_AMOUNTS.values())
    return census_field(v, **{n: rules.income_amount(F.trim(c)).cast("string") for n, c in amounts})


@check(
    "prj17_water_flag",
    """SELECT geoid, CAST(coalesce(area_water, 0) > 0 AND coalesce(area_water, 0) >= coalesce(area_land, 0) AS INTEGER) AS is_water
        FROM tract_points""",
)
def _(v):
    return v.tract_points.select("geoid", rules.water_flag(F.col("area_land"), F.col("area_water")).alias("is_water"))


CLEAN_SQL = "trim(regexp_replace(regexp_replace(replace({c}, ',', ' '), '[\\r\\n]+', ' ', 'g'), '[^a-zA-Z0-9\\s.,!?]', '', 'g'), E' \\t\\n\\r\\f')"


@check("prj18_clean_text", f"SELECT doc_id, {CLEAN_SQL.format(c='text')} AS text FROM documents")
def _(v):
    return cleaning.clean_text_columns(v.table("documents").select("doc_id", "text"), "text", "absent")


@check("prj19_normalize_codes", f"SELECT id, code FROM ({VALID_CODES_SQL})")
def _(v):
    return coded(v).select("id", text.routing_number(F.col("raw")).alias("code"))


@check("set05_distinct_codes", f"SELECT DISTINCT code AS routing_number FROM ({VALID_CODES_SQL}) WHERE code IS NOT NULL")
def _(v):
    from catchment.plans import routing

    return routing.codes(coded(v), "raw")


OFFICES_SPARK = """case c_custkey % 5 when 0 then concat(' ', lpad(c_custkey, 9, '1'), ' , 100 Main St ', c_name, ' ')
    when 1 then concat('Office ', lpad(c_custkey, 9, '2'), ' near ', c_name) when 2 then '' when 3 then c_name else null end"""
OFFICES_SQL = """SELECT c_custkey AS id, CASE c_custkey % 5 WHEN 0 THEN ' ' || lpad(CAST(c_custkey AS VARCHAR), 9, '1') || ' , 100 Main St ' || c_name || ' '
    WHEN 1 THEN 'Office ' || lpad(CAST(c_custkey AS VARCHAR), 9, '2') || ' near ' || c_name WHEN 2 THEN '' WHEN 3 THEN c_name END AS raw FROM customer"""


@check(
    "prj20_parse_servicing",
    f"""SELECT id, CASE WHEN regexp_matches(raw, '^\\s*\\d{{9}}\\s*,\\s*.+$') THEN regexp_extract(raw, '^\\s*(\\d{{9}})', 1)
               ELSE nullif(regexp_extract(raw, '\\d{{9}}'), '') END AS rtn,
           CASE WHEN regexp_matches(raw, '^\\s*\\d{{9}}\\s*,\\s*.+$') THEN trim(regexp_extract(raw, ',\\s*(.+)$', 1))
               ELSE nullif(trim(raw), '') END AS addr
        FROM ({OFFICES_SQL})""",
)
def _(v):
    offices = v.table("customer").selectExpr("c_custkey as id", f"{OFFICES_SPARK} as raw")
    return offices.select("id", text.servicing_office(F.col("raw")).alias("o")).select("id", "o.rtn", "o.addr")


@check(
    "prj21_parse_date_us",
    f"""SELECT id, strftime(coalesce(try_strptime(d, '%m/%d/%Y'), try_strptime(d, '%m-%d-%Y'), try_strptime(d, '%Y-%m-%d')), '%Y-%m-%d') AS change_date
        FROM (SELECT id, trim(raw) AS d FROM ({DATES_SQL}))""",
)
def _(v):
    return dated(v, "raw").select("id", text.parse_date_us(F.col("raw")).cast("string").alias("change_date"))


@check("prj36_minutes", "SELECT event_id, round(value / 60, 6) AS minutes FROM events")
def _(v):
    return v.table("events").select("event_id", F.round(text.minutes(F.col("value")), 6).alias("minutes"))


@check("snk10_dates_as_text", "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate FROM orders")
def _(v):
    return cleaning.dates_as_text(v.table("orders").selectExpr("o_orderkey", "cast(o_orderdate as date) as day", "o_orderdate"))


@check(
    "udf02_element_functions",
    f"""SELECT id, left(CASE WHEN lower(trim(value)) NOT IN ('', 'nan') THEN trim(value) END, 3) || '*' AS head FROM ({MESSY_SQL})""",
)
def _(v):
    return messy(v).select("id", F.concat(F.substring(text.empty_to_null(F.col("value")), 1, 3), F.lit("*")).alias("head"))


@check(
    "fun16_scalar_functions",
    """SELECT p_partkey, lower(trim('  ' || p_name || ' ')) AS trimmed, replace(p_brand, '#', '') AS replaced, lpad(CAST(p_size AS VARCHAR), 4, '0') AS padded,
        nullif(p_type, 'ECONOMY') AS kind, p_name || '/' || p_brand AS joined, coalesce(nullif(p_type, 'ECONOMY'), 'none') AS filled,
        CAST(p_size AS VARCHAR) AS size_text, TRY_CAST(p_name AS BIGINT) AS no_number FROM part""",
)
def _(v):
    return v.table("part").select(
        "p_partkey",
        F.lower(F.trim(F.concat(F.lit("  "), "p_name", F.lit(" ")))).alias("trimmed"),
        F.replace("p_brand", F.lit("#"), F.lit("")).alias("replaced"),
        F.lpad(F.col("p_size").cast("string"), 4, "0").alias("padded"),
        F.nullif(F.col("p_type"), F.lit("ECONOMY")).alias("kind"),
        F.concat("p_name", F.lit("/"), "p_brand").alias("joined"),
        F.coalesce(F.nullif(F.col("p_type"), F.lit("ECONOMY")), F.lit("none")).alias("filled"),
        F.col("p_size").cast("string").alias("size_text"),
        F.col("p_name").try_cast("bigint").alias("no_number"),
    )


@check(
    "agg13_smallest_types",
    """
    WITH n AS (SELECT count(*) AS n FROM part)
    SELECT 'p_partkey' AS column_name, CASE WHEN max(p_partkey) <= 255 THEN 'SMALLINT' WHEN max(p_partkey) <= 65535 THEN 'INT' ELSE 'BIGINT' END AS smallest_type,
           0 AS nullable, 0::BIGINT AS null_count, min(p_partkey) AS min_value, max(p_partkey) AS max_value, NULL::BIGINT AS max_length FROM part
    UNION ALL SELECT 'shifted', CASE WHEN min(p_partkey) - 5 >= -32768 AND max(p_partkey) - 5 <= 32767 THEN 'INT' ELSE 'BIGINT' END, 0, 0, min(p_partkey) - 5, max(p_partkey) - 5, NULL FROM part
    UNION ALL SELECT 'p_size', 'SMALLINT', 0, 0, min(p_size), max(p_size), NULL FROM part
    UNION ALL SELECT 'p_name', 'CHAR(' || max(length(p_name)) || ')', 0, 0, NULL, NULL, max(length(p_name)) FROM part
    UNION ALL SELECT 'p_retailprice', 'DOUBLE', 0, 0, NULL, NULL, NULL FROM n
    UNION ALL SELECT 'flag', 'BOOLEAN', 1, count(*) FILTER (p_partkey % 3 = 0), NULL, NULL, NULL FROM part
    UNION ALL SELECT 'long_text', 'TEXT', 0, 0, NULL, NULL, max(length(p_name)) * 30 FROM part
    """,
)
def _(v):
    return profile.smallest_types(
        v.table("part").selectExpr(
            "p_partkey", "p_partkey - 5 as shifted", "p_size", "p_name", "p_retailprice",
            "if(p_partkey % 3 = 0, null, p_size > 3) as flag", "repeat(p_name, 30) as long_text", "cast(null as string) as nothing",
        )
    )


@check("src04_parquet_points", "SELECT customer_id, latitude AS lat, longitude AS lon FROM customers WHERE latitude IS NOT NULL AND longitude IS NOT NULL")
def _(v):
    return readers.locate_customers(v.customers)


@check("pip02_census_table", """
    SELECT geoid, left(geoid, 2) AS state_fip, substr(geoid, 3, 3) AS county_fip, right(geoid, 6) AS tract, population, ind AS cra_income_ind,
           (CASE ind WHEN '1' THEN 'low' WHEN '2' THEN 'moderate' WHEN '3' THEN 'middle' WHEN '4' THEN 'upper' WHEN '0' THEN 'NA' END) AS cra_income_class,
           CAST(coalesce(ind IN ('1', '2'), FALSE) AS INTEGER) AS lmi_ind, CAST(trim(c15) = 'X' AS INTEGER) AS cra_poverty,
           CAST(trim(c16) = 'X' AS INTEGER) AS cra_unemployment, CAST(trim(c17) = 'X' AS INTEGER) AS cra_distressed,
           CAST(trim(c18) = 'X' AS INTEGER) AS cra_remote_area, trim(c5) AS principal_city, trim(c6) AS small_county, trim(c7) AS split_tract,
           trim(c8) AS demographics_ind, urban_rural_ind,
           CAST(TRY_CAST(trim(c10) AS DECIMAL(18,2)) AS VARCHAR) AS median_fam_income_msamd, CAST(TRY_CAST(trim(c11) AS DECIMAL(18,2)) AS VARCHAR) AS median_hh_income_msamd,
           CAST(TRY_CAST(trim(c12) AS DECIMAL(18,2)) AS VARCHAR) AS median_fam_income_prcnt_msamd, CAST(TRY_CAST(trim(c13) AS DECIMAL(18,2)) AS VARCHAR) AS median_fam_income_ffiec
    FROM census""")
def _(v):
    table = places.census_table(v.census_raw)
    return table.withColumns({c: F.col(c).cast("string") for c in places.CENSUS_AMOUNTS})


TASKS = """
    SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS created
    FROM events WHERE ts >= TIMESTAMP '2024-01-13' AND ts < TIMESTAMP '2024-01-21'"""
TODAY = dt.date(2024, 1, 20)
STAMP = "date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSSSSS') as created"


@check("src11_slice_by_day", TASKS)
def _(v):
    from catchment.operators import access

    return access.slice_by_day(v.table("events"), "ts", 7, TODAY).selectExpr("event_id", STAMP)


@check("pip09_task_history", f"""
    SELECT t.event_id, t.created, {CLEAN_SQL.format(c="e.event_type || ', ' || e.props")} AS description FROM ({TASKS}) t JOIN events e USING (event_id)""")
def _(v):
    from catchment.plans.tasks import task_history

    tasks = v.table("events").withColumn("Description", F.concat("event_type", F.lit(", "), "props"))
    return task_history(tasks, 7, TODAY, "ts", ("Description",)).selectExpr("event_id", STAMP, "Description as description")


