"""Bank access, derived institution fields and event histories."""

from __future__ import annotations

from pyspark.sql import functions as F

from catchment.functions import bank
from catchment.operators import access
from catchment.plans import bank as plans
from catchment.sources import readers
from checks.registry import check

DEPOSITS = """SELECT "UNINUMBR", "CERT", "YEAR", "STALPBR" FROM deposits"""


def deposit_keys(df):
    return df.select("UNINUMBR", "CERT", "YEAR", "STALPBR")


@check("src09_read_years", f'{DEPOSITS} WHERE "YEAR" BETWEEN 1996 AND 1998')
def _(v):
    return deposit_keys(access.read_years(v.deposits, "YEAR", 1996, 1998))


@check(
    "src10_slice_by_year",
    """SELECT o_orderkey, year(o_orderdate) AS "year" FROM orders
       WHERE o_orderdate >= '1996-01-01' AND o_orderdate < '1999-01-01' AND o_orderstatus = 'F'""",
)
def _(v):
    return access.slice_by_year(v.table("orders"), "o_orderdate", [1996, 1997, 1998], "o_orderstatus", "F").select(
        "o_orderkey", F.col("year").cast("bigint").alias("year")
    )


@check("src15_extract", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey ORDER BY n DESC, o_custkey LIMIT 20")
def _(v):
    v.table("orders").createOrReplaceTempView("extract_orders")
    return readers.extract(v.spark, "SELECT o_custkey, count(*) AS n FROM extract_orders GROUP BY o_custkey ORDER BY n DESC, o_custkey", limit=20)


@check("flt01_by_ids", f'{DEPOSITS} WHERE "CERT" = 14 OR "CERT" = 983 OR "CERT" = 33')
def _(v):
    return deposit_keys(access.by_ids(v.deposits, "CERT", [14, 983, 33]))


@check("flt02_by_states", f"""{DEPOSITS} WHERE "STALPBR" IN ('NATION_1', 'NATION_7', 'NATION_12')""")
def _(v):
    return deposit_keys(access.by_states(v.deposits, "STALPBR", ["NATION_1", "NATION_7", "NATION_12"]))


@check("flt03_by_year_range", f'SELECT \'two\' AS bounds, * FROM ({DEPOSITS}) WHERE "YEAR" >= 1997 AND "YEAR" <= 1998 UNION ALL SELECT \'one\', * FROM ({DEPOSITS})')
def _(v):
    two = deposit_keys(access.by_year_range(v.deposits, "YEAR", [1997, 1998])).select(F.lit("two").alias("bounds"), "*")
    one = deposit_keys(access.by_year_range(v.deposits, "YEAR", [1997])).select(F.lit("one").alias("bounds"), "*")
    return two.unionByName(one)


@check("flt04_all_of", f"""{DEPOSITS} WHERE "BKCLASS" = 'SM' AND "YEAR" = 1997""")
def _(v):
    return deposit_keys(access.all_of(v.deposits, {"BKCLASS": "SM", "YEAR": 1997}))


@check("flt05_not_in_class", f"""{DEPOSITS} WHERE "BKCLASS" NOT IN ('NC', 'SB')""")
def _(v):
    return deposit_keys(access.not_in_class(v.deposits, "BKCLASS", "NC", "SB"))


@check(
    "agg06_year_summary",
    """SELECT "YEAR", count("CERT") AS "CERT_count", CAST(round(sum("DEPSUM"), 2) AS DOUBLE) AS "DEPSUM_sum",
              round(CAST(sum("DEPSUM") AS DOUBLE) / count("DEPSUM"), 2) AS "DEPSUM_mean", CAST(sum("DEPSUMBR") AS DOUBLE) AS "DEPSUMBR_sum",
              round(CAST(sum("DEPSUMBR") AS DOUBLE) / count("DEPSUMBR"), 2) AS "DEPSUMBR_mean" FROM deposits GROUP BY "YEAR" """,
)
def _(v):
    return numbers(access.year_summary(v.deposits))


def numbers(df):
    """Decimals as doubles, so both engines hand back the same kind of number."""
    return df.withColumns({c: F.col(c).cast("double") for c, t in df.dtypes if t.startswith("decimal")})


@check(
    "agg07_aggregate_by",
    """SELECT "CNTYNAMB", "STALPBR", count(*) AS "count", CAST(sum("DEPSUM") AS DOUBLE) AS "sum_DEPSUM" FROM deposits
       GROUP BY ALL ORDER BY "count" DESC, "CNTYNAMB", "STALPBR" LIMIT 12""",
)
def _(v):
    return numbers(access.aggregate_by(v.deposits, "CNTYNAMB", ["STALPBR"], ["DEPSUM"], 12))


@check("agg09_record_total", 'SELECT count(*) AS total FROM deposits WHERE "YEAR" = 1997')
def _(v):
    return access.record_total(access.all_of(v.deposits, {"YEAR": 1997}))


@check("srt01_page", """SELECT "UNINUMBR", CAST("DEPSUM" AS DOUBLE) AS "DEPSUM" FROM deposits ORDER BY "DEPSUM" DESC, "UNINUMBR" LIMIT 25 OFFSET 50""")
def _(v):
    return numbers(access.page(v.deposits.select("UNINUMBR", "DEPSUM"), "DEPSUM", "DESC", limit=25, offset=50, key="UNINUMBR"))


@check(
    "src08_landed_pages",
    """WITH p AS (SELECT o_orderkey, o_orderkey // 1000 + CASE WHEN o_orderkey // 1000 = 11 AND o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS page FROM orders),
            c AS (SELECT page, count(*) AS n FROM p GROUP BY page)
       SELECT o_orderkey, page FROM p WHERE page <= coalesce((SELECT min(page) FROM c WHERE n < 1000), 1000000000)""",
)
def _(v):
    landed = v.table("orders").selectExpr(
        "o_orderkey", "o_orderkey div 1000 + if(o_orderkey div 1000 = 11 and o_orderkey % 5 = 0, 1, 0) as page"
    )
    return access.landed_pages(landed, "page", 1000)


@check("pip05_deposits_history", """
    SELECT "YEAR", count(*) AS "CERT_count", CAST(sum("DEPSUM") AS DOUBLE) AS "DEPSUM_sum", round(CAST(sum("DEPSUM") AS DOUBLE) / count(*), 2) AS "DEPSUM_mean",
           CAST(sum("DEPSUMBR") AS DOUBLE) AS "DEPSUMBR_sum", round(CAST(sum("DEPSUMBR") AS DOUBLE) / count(*), 2) AS "DEPSUMBR_mean",
           (SELECT count(*) FROM deposits WHERE "YEAR" BETWEEN 1996 AND 1999) AS all_rows
    FROM deposits WHERE "YEAR" BETWEEN 1996 AND 1999 GROUP BY "YEAR" """)
def _(v):
    rows, summary = plans.deposits_history(v.deposits, 1996, 1999)
    return numbers(summary.withColumn("all_rows", access.record_total(rows).scalar()))


# ---------------------------------------------------------------- derived fields


def fields(v, *names):
    every = {**plans.flag_fields(), **plans.date_fields()}
    return v.institutions.select("CERT", *[every[n].alias(n) for n in names])


FLAG = "CAST(coalesce({0}, FALSE) AS INTEGER)"
FIELD_SQL = {
    "ACTIVE": FLAG.format("lower(flg) = 'y'"),
    "INACTIVE": "1 - " + FLAG.format("lower(flg) = 'y'"),
    "CBSA_METRO": "CASE WHEN metro_flg = '1' THEN cbsa_no ELSE '0' END",
    "CBSA_METRO_NAME": "CASE WHEN metro_flg = '1' THEN cbsa ELSE '0' END",
    "CFPBFLAG": FLAG.format("lower(regagent2) = 'cfpb' AND cfpb_end = '31-Dec-99'"),
    "FEDCHRTR": FLAG.format("lower(chrtagnt) IN ('occ', 'ots')"),
    "STCHRTR": FLAG.format("lower(chrtagnt) = 'state'"),
    "IBA": FLAG.format("iba_flg ILIKE 'y' OR iba_flg ILIKE 'l'"),
    "SASSER": FLAG.format("sasser_flg ILIKE 'y'"),
    "INSBIF": FLAG.format("insagnt1 ILIKE 'bif'"),
    "OAKAR": FLAG.format("insagnt1 ILIKE 'bif' AND insagnt2 ILIKE 'saif'"),
    "INSCOML": FLAG.format(
        "lower(insagnt1) IN ('bif', 'saif', 'dif') AND (lower(bkclass) IN ('n', 'nc', 'nm') "
        "OR (lower(bkclass) = 'sm' AND org_typ <> 110 AND org_typ <> 115 AND org_typ <> 130 AND org_typ <> 135))"
    ),
    "SPECGRPN": "CASE specgrp "
    + " ".join(f"WHEN {code} THEN '{label}'" for code, label in bank.SPECIALIZATIONS.items())
    + f" ELSE '{bank.SPECIALIZATION_ERROR}' END",
    "FDICSUPV": "CASE suprv WHEN '16' THEN 'WASHINGTON' END",
    "INSFDIC": "1",
    "INSSAIF": "0",
    "INSSAVE": "0",
    "INSTCRCD": "0",
    "EFFDATE": "strftime(strptime(eff, '%Y%m%d'), '%m/%d/%Y')",
    "ENDEFYMD": """strftime(strptime("end", '%Y%m%d'), '%m/%d/%Y')""",
    "ESTYMD": "strftime(try_strptime(estb, '%Y-%m-%dT%H:%M:%S'), '%m/%d/%Y')",
    "INSDATE": "strftime(try_strptime(insured_from, '%Y-%m-%dT%H:%M:%S'), '%m/%d/%Y')",
}


def field_check(key, *names):
    listed = ", ".join(f'{FIELD_SQL[n]} AS "{n}"' for n in names)
    check(key, f'SELECT "CERT", {listed} FROM institutions')(lambda v: fields(v, *names))


field_check("prj26_active_flags", "ACTIVE", "INACTIVE")
field_check("prj27_metro_fields", "CBSA_METRO", "CBSA_METRO_NAME")
field_check("prj28_agency_flags", "CFPBFLAG", "FEDCHRTR", "STCHRTR", "IBA", "SASSER", "OAKAR", "INSBIF")
field_check("prj29_insured_commercial", "INSCOML")
field_check("prj30_specialization_name", "SPECGRPN")
field_check("prj31_constant_fields", "FDICSUPV", "INSFDIC", "INSSAIF", "INSSAVE", "INSTCRCD")
field_check("prj32_reformat_dates", "EFFDATE", "ENDEFYMD", "ESTYMD", "INSDATE")

ZIP_SQL = "CASE WHEN length(zip_raw) < 5 THEN repeat('0', 5 - length(zip_raw)) || zip_raw ELSE zip_raw END"


@check("prj25_pad_zip", f'SELECT "CERT", {ZIP_SQL} AS "ZIP" FROM institutions')
def _(v):
    return v.institutions.select("CERT", bank.pad_zip(F.col("ZIP_RAW")).alias("ZIP"))


@check("prj33_run_date", """SELECT "CERT", strftime(today(), '%m/%d/%Y') AS "RUNDATE" FROM institutions""")
def _(v):
    return v.institutions.select("CERT", bank.run_date().alias("RUNDATE"))


@check("prj34_pad_event_zip", f'SELECT "CERT", i, {ZIP_SQL} AS "ZIP" FROM history')
def _(v):
    padded = v.institutions.select("CERT", F.posexplode(bank.pad_event_zips(F.col("EVENTS"))).alias("i", "e"))
    return padded.select("CERT", F.col("i").cast("bigint").alias("i"), "e.ZIP")


@check(
    "prj35_map_sources",
    """SELECT s_suppkey AS "UNINUM", s_name AS "NAME", 1 AS "MAINOFF", s_nationkey AS "STNUM" FROM supplier
       UNION ALL SELECT c_custkey, c_name, 0, NULL FROM customer""",
)
def _(v):
    sources = {
        "institutions": v.table("supplier").withColumn("main", F.lit(1)),
        "branches": v.table("customer").withColumn("main", F.lit(0)),
    }
    mapping = {
        "UNINUM": {"institutions": "s_suppkey", "branches": "c_custkey"},
        "NAME": {"institutions": "s_name", "branches": "c_name"},
        "MAINOFF": {"institutions": "main", "branches": "main"},
        "STNUM": {"institutions": "s_nationkey"},
    }
    return plans.map_sources(sources, mapping)


# ---------------------------------------------------------------- events

NAMES_SQL = """SELECT "CERT", n, row_number() OVER (PARTITION BY "CERT" ORDER BY i) AS place FROM
    (SELECT "CERT", name AS n, min(i) AS i FROM history WHERE name <> c_name GROUP BY ALL)"""
CODES = ", ".join(map(str, bank.CHANGE_CODES))
CHANGES_SQL = f"""SELECT *, row_number() OVER (PARTITION BY "CERT" ORDER BY CASE WHEN code > 200 AND code < 300 THEN 1 WHEN code > 800 AND code < 900 THEN 2 ELSE 3 END,
    proc DESC, code DESC, i) AS place FROM history WHERE eff = org_eff AND code IN ({CODES})"""


@check("fun08_prior_names", f"""SELECT i."CERT", max(n) FILTER (place = 1) AS "PRIORNAME1", max(n) FILTER (place = 2) AS "PRIORNAME2", max(n) FILTER (place = 3) AS "PRIORNAME3",
    max(n) FILTER (place = 4) AS "PRIORNAME4" FROM institutions i LEFT JOIN ({NAMES_SQL}) h ON h."CERT" = i."CERT" GROUP BY i."CERT" """)
def _(v):
    listed = plans.with_event_lists(v.institutions)
    return listed.select("CERT", *[bank.nth(F.col("_names"), n).alias(f"PRIORNAME{n}") for n in range(1, 5)])


@check("fun09_change_codes", f"""SELECT i."CERT", max(code) FILTER (place = 1) AS "CHANGEC1", max(code) FILTER (place = 2) AS "CHANGEC2", max(code) FILTER (place = 3) AS "CHANGEC3",
    max(code) FILTER (place = 4) AS "CHANGEC4", max(code) FILTER (place = 5) AS "CHANGEC5" FROM institutions i LEFT JOIN ({CHANGES_SQL}) h ON h."CERT" = i."CERT" GROUP BY i."CERT" """)
def _(v):
    listed = plans.with_event_lists(v.institutions)
    return listed.select("CERT", *[bank.nth(F.col("_changes"), n)["ACT_EVT_NUM"].alias(f"CHANGEC{n}") for n in range(1, 6)])


NEWCERT_SQL = f"""SELECT i."CERT", CASE WHEN h.n IS NULL OR h.first_code = 150 THEN 0 ELSE greatest(h.last_acquirer, 0) END AS "NEWCERT"
    FROM institutions i LEFT JOIN (SELECT "CERT", count(*) AS n, arg_min(code, place) AS first_code, arg_max(acquirer, place) AS last_acquirer
                                   FROM ({CHANGES_SQL}) GROUP BY "CERT") h ON h."CERT" = i."CERT" """


@check("fun10_successor_id", NEWCERT_SQL)
def _(v):
    return plans.with_event_lists(v.institutions).select("CERT", bank.successor_id(F.col("_changes")).alias("NEWCERT"))


PROCDATE_SQL = """SELECT i."CERT", strftime(strptime(max(h.proc), '%Y-%m-%dT%H:%M:%S'), '%m/%d/%Y') AS "PROCDATE"
    FROM institutions i LEFT JOIN (SELECT * FROM history WHERE eff = org_eff) h ON h."CERT" = i."CERT" GROUP BY i."CERT" """


@check("fun11_process_date", PROCDATE_SQL)
def _(v):
    return v.institutions.select("CERT", plans.event_dates()["PROCDATE"].alias("PROCDATE"))


DROP_SQL = """SELECT i."CERT", strftime(strptime(arg_max(h.eff, h.i), '%Y%m%d'), '%m/%d/%Y') AS "INSDROPDATE"
    FROM institutions i LEFT JOIN (SELECT * FROM history WHERE code = 410 AND lower(fund) = 'none') h ON h."CERT" = i."CERT" AND lower(i.insagnt1) = 'none' GROUP BY i."CERT" """


@check("fun12_insurance_drop_date", DROP_SQL)
def _(v):
    return v.institutions.select("CERT", bank.insurance_drop_date(F.col("EVENTS"), F.col("INSAGNT1")).alias("INSDROPDATE"))


@check(
    "pip07_institution_fields",
    f"""SELECT i."CERT", i."NAME", {", ".join(f'{e} AS "{n}"' for n, e in FIELD_SQL.items())}, {ZIP_SQL} AS "ZIP",
           p."PROCDATE", p."PROCDATE" AS "DATEUPDT", s."NEWCERT", d."INSDROPDATE",
           {", ".join(f'n.n{k} AS "PRIORNAME{k}"' for k in range(1, bank.PRIOR_NAMES + 1))},
           {", ".join(f'c.c{k} AS "CHANGEC{k}"' for k in range(1, bank.CHANGE_COLUMNS + 1))}
        FROM institutions i JOIN ({PROCDATE_SQL}) p ON p."CERT" = i."CERT" JOIN ({NEWCERT_SQL}) s ON s."CERT" = i."CERT" JOIN ({DROP_SQL}) d ON d."CERT" = i."CERT"
        LEFT JOIN (SELECT "CERT", {", ".join(f"max(n) FILTER (place = {k}) AS n{k}" for k in range(1, bank.PRIOR_NAMES + 1))} FROM ({NAMES_SQL}) GROUP BY "CERT") n ON n."CERT" = i."CERT"
        LEFT JOIN (SELECT "CERT", {", ".join(f"max(code) FILTER (place = {k}) AS c{k}" for k in range(1, bank.CHANGE_COLUMNS + 1))} FROM ({CHANGES_SQL}) GROUP BY "CERT") c ON c."CERT" = i."CERT" """,
)
def _(v):
    return plans.institution_fields(v.institutions).drop("RUNDATE")


