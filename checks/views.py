"""Domain tables derived from the given tables, row by row and from whole tables.

The given tables hold no coordinates or bank fields, so those are integer arithmetic on keys, which
both engines evaluate alike. Places are spread over regions of 2 x 3 degrees, a fixed number of keys
each, so density stays the same at every scale and join results grow with the tables.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from catchment.functions.polygon import RINGS_TYPE
from catchment.operators import skew

# Outline of each polygon form in thousandths of a degree from the corner of its grid place.
FORMS: list[list[list[tuple[int, int]]]] = [
    [[(0, 0), (60, 0), (60, 50), (0, 50), (0, 0)]],
    [[(0, 0), (60, 0), (60, 25), (30, 25), (30, 50), (0, 50), (0, 0)]],
    [[(0, 0), (60, 0), (60, 50), (0, 50), (0, 0)], [(20, 15), (20, 35), (40, 35), (40, 15), (20, 15)]],
    [[(0, 0), (60, 0), (60, 10), (10, 10), (10, 40), (60, 40), (60, 50), (0, 50), (0, 0)]],
    [[(0, 0), (25, 0), (25, 50), (0, 50), (0, 0)], [(35, 0), (60, 0), (60, 50), (35, 50), (35, 0)]],
    [[(0, 0), (60, 0), (30, 50), (0, 0)]],
    [[(-10, -10), (70, -10), (70, 60), (-10, 60), (-10, -10)]],
]


# Event codes used to fill histories.
EVENT_CODES = [110, 150, 211, 223, 235, 350, 410, 510, 810, 830, 999, 217]


def lat_of(key: str, per_region: int) -> str:
    return f"(29 - 2 * (({key} div {per_region}) % 40)) * 1000"


def lon_of(key: str, per_region: int) -> str:
    return f"(-99 + 3 * ((({key} div {per_region}) div 40) % 60)) * 1000"


def pad(value: str, width: int) -> str:
    return f"lpad(cast({value} as string), {width}, '0')"


def pick(values: list, by: str) -> str:
    """The value whose place is the remainder of ``by``."""
    listed = ", ".join("null" if v is None else repr(v) for v in values)
    return f"element_at(array({listed}), cast({by} % {len(values)} + 1 as int))"


GEOID = f"concat({pad('10 + (p_partkey div 1000000) % 90', 2)}, {pad('p_partkey % 254', 3)}, {pad('p_partkey % 1000000', 6)})"

FORM_LITERAL = "array({})".format(
    ", ".join(
        "array({})".format(
            ", ".join("array({})".format(", ".join(f"struct({dx} as dx, {dy} as dy)" for dx, dy in ring)) for ring in form)
        )
        for form in FORMS
    )
)


class Views:
    """The given tables as attributes, plus the domain tables derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # ------------------------------------------------------------ places

    @cached_property
    def branches(self) -> DataFrame:
        return self.table("supplier").selectExpr(
            f"concat('B', {pad('s_suppkey', 6)}) as branch_id",
            f"if(s_suppkey % 17 = 3, 95.0D, ({lat_of('s_suppkey', 100)} + s_suppkey * 7919 % 2000) / 1000) as lat",
            f"if(s_suppkey % 17 <> 9, ({lon_of('s_suppkey', 100)} + s_suppkey * 4729 % 3000) / 1000, null) as lon",
        )

    @cached_property
    def tract_points(self) -> DataFrame:
        return self.table("part").selectExpr(
            f"{GEOID} as geoid",
            f"({lat_of('p_partkey', 2000)} + p_partkey * 6151 % 2000) / 1000 as lat",
            f"({lon_of('p_partkey', 2000)} + p_partkey * 3571 % 3000) / 1000 as lon",
            "if(p_partkey % 9 <> 4, p_size * 1000 + p_partkey % 7, null) as area_land",
            "case when p_partkey % 10 = 2 then 0L when p_partkey % 10 <> 7 then p_partkey % 45 * 1000 end as area_water",
        )

    @cached_property
    def tract_codes(self) -> DataFrame:
        return self.table("part").selectExpr(f"{GEOID} as geoid").selectExpr(
            "geoid",
            "substring(geoid, 1, 2) as state_fips",
            "substring(geoid, 3, 3) as county_fips",
            "substring(geoid, 6, 6) as ce_tract",
        )

    @cached_property
    def tracts(self) -> DataFrame:
        # Outlines cost far more than the keys they are worked out from, so the keys are dealt to tasks first.
        placed = skew.dealt(self.table("part").select("p_partkey")).selectExpr(
            f"{GEOID} as geoid",
            f"{lon_of('p_partkey', 2000)} + ((p_partkey % 2000) div 40) * 60 as ox",
            f"{lat_of('p_partkey', 2000)} + (p_partkey % 2000) % 40 * 50 as oy",
            f"""if((p_partkey % 2000) % 97 = 50, array(),
                   element_at({FORM_LITERAL}, cast((p_partkey % 2000) % {len(FORMS)} + 1 as int))) as form""",
        )
        return placed.selectExpr(
            "geoid",
            "substring(geoid, 1, 2) as state_fips",
            "substring(geoid, 3, 3) as county_fips",
            "substring(geoid, 6, 6) as ce_tract",
            f"""cast(transform(form, r -> transform(r, p ->
                   struct((ox + p.dx) / 1000 as lon, (oy + p.dy) / 1000 as lat))) as {RINGS_TYPE}) as rings""",
        )

    @cached_property
    def customers(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "cast(c_custkey as string) as customer_id",
            f"if(c_custkey % 19 <> 5, ({lat_of('c_custkey', 1500)} + c_custkey * 6577 % 2000) / 1000, null) as latitude",
            f"({lon_of('c_custkey', 1500)} + c_custkey * 4241 % 3000) / 1000 as longitude",
        )

    @cached_property
    def isochrones(self) -> DataFrame:
        placed = self.table("supplier").selectExpr(
            f"concat('B', {pad('s_suppkey', 6)}) as bc_code",
            f"{lon_of('s_suppkey', 100)} + s_suppkey * 4729 % 3000 as x",
            f"{lat_of('s_suppkey', 100)} + s_suppkey * 7919 % 2000 as y",
            "s_suppkey as k",
            "explode(array(5, 10)) as time_frame_minutes",
        )
        corners = ", ".join(
            f"struct((x {sx} time_frame_minutes * (10 + k % 5)) / 1000 as lon, (y {sy} time_frame_minutes * (8 + k % 4)) / 1000 as lat)"
            for sx, sy in ("--", "+-", "++", "-+", "--")
        )
        return placed.selectExpr(
            "bc_code",
            "y / 1000 as branch_latitude",
            "x / 1000 as branch_longitude",
            "time_frame_minutes",
            f"array(array({corners})) as rings",
        )

    @cached_property
    def census_raw(self) -> DataFrame:
        keyed = self.table("part").selectExpr(
            "p_partkey as k",
            "cast(10 + (p_partkey div 1000000) % 90 as string) as s",
            f"{pad('p_partkey % 1000000', 6)} as t6",
            "p_size * 100 + p_partkey % 1000 as pop",
        )
        return keyed.selectExpr(
            "if(k % 3 = 0, concat(' ', s, ' '), s) as _c2",
            "cast(k % 254 as string) as _c3",
            "if(k % 5 = 0, concat(substring(t6, 1, 4), '.', substring(t6, 5, 2)), cast(k % 1000000 as string)) as _c4",
            "if(k % 4 = 0, ' T ', 'F') as _c5",
            "'N' as _c6",
            "'' as _c7",
            "'D' as _c8",
            "if(k % 2 = 0, 'U', 'R ') as _c9",
            "concat(k % 900, '.25') as _c10",
            "if(k % 6 = 0, 'n/a', cast(k * 3 % 70000 as string)) as _c11",
            "if(k % 8 = 0, '', concat(' ', k % 150, '.5 ')) as _c12",
            "'65000' as _c13",
            "if(k % 13 = 0, '9', cast(k % 6 as string)) as _c14",
            "case k % 4 when 0 then 'X' when 1 then 'x' else '' end as _c15",
            "if(k % 5 = 0, ' X ', '') as _c16",
            "if(k % 7 = 0, 'X', 'I') as _c17",
            "if(k % 8 = 0, 'X', '') as _c18",
            f"""case when k % 11 = 0 then '' when k % 11 = 1 then '  ' when k % 11 = 2 then '12.0' when k % 11 = 3 then 'abc'
                     when k % 11 = 4 and pop >= 1000 then concat(pop div 1000, ',', {pad('pop % 1000', 3)})
                     else concat(' ', pop) end as _c22""",
        )

    # ------------------------------------------------------------ bank

    @cached_property
    def deposits(self) -> DataFrame:
        orders, customer, nation = self.table("orders"), self.table("customer"), self.table("nation")
        return (
            orders.join(customer, orders.o_custkey == customer.c_custkey)
            .join(nation, customer.c_nationkey == nation.n_nationkey)
            .selectExpr(
                "year(o_orderdate) as YEAR",
                "o_custkey % 50 as CERT",
                f"{pick(['N', 'NM', 'SM', 'SB', 'SA', 'NC'], 'o_custkey')} as BKCLASS",
                "n_name as STALPBR",
                "c_mktsegment as CNTYNAMB",
                "o_orderkey as UNINUMBR",
                "cast(o_totalprice as decimal(18,2)) as DEPSUMBR",
                "cast(cast(o_totalprice as decimal(18,2)) * (o_custkey % 3 + 1) as decimal(18,2)) as DEPSUM",
                "cast(o_orderkey * 7 % 100000 as string) as ZIP_RAW",
            )
        )

    @cached_property
    def institutions(self) -> DataFrame:
        k = "c_custkey"
        event = f"""struct(
            {pick(EVENT_CODES, f'({k} * 3 + i * 5)')} as ACT_EVT_NUM,
            ({k} * 7 + i * 11) % 40 - 5 as ORG_ACQ_CERT_NUM,
            if(i % 3 = 0, c_name, concat('Old Name ', ({k} + i) % 4)) as NAME,
            concat('2019010', 1 + if(({k} + i) % 4 = 0, ({k} + 1) % 2, {k} % 2)) as EFFDATE,
            '99991231' as ENDEFYMD,
            concat('2020-0', 1 + ({k} + i * i) % 3, '-15T00:00:00') as PROCDATE,
            if(({k} + i) % 3 = 0, 'DIF', 'None') as INSAGNT1,
            cast(({k} * 13 + i * 977) % 100000 as string) as ZIP_RAW)"""
        return self.table("customer").selectExpr(
            f"{k} as CERT",
            "c_name as NAME",
            f"{pick(['Y', 'y', 'N', None], k)} as INST_FIN_ACTV_FLG",
            f"{pick(['1', '0', None], k)} as CBSA_METRO_FLG",
            f"cast(10000 + {k} % 500 as string) as CBSA_NO",
            f"concat('Metro ', {k} % 500) as CBSA",
            f"{pick(['CFPB', 'OCC', 'cfpb', None], k)} as REGAGENT2",
            f"{pick(['31-Dec-99', '01-Jan-20'], f'({k} div 4)')} as CFPBENDDTE",
            f"{pick(['OCC', 'State', 'OTS', 'state', None], k)} as CHRTAGNT",
            f"{pick(['Y', 'L', 'N'], k)} as INST_IBA_FLG",
            f"{pick(['y', 'N'], k)} as LAW_SASSER_FLG",
            f"{pick(['BIF', 'SAIF', 'DIF', 'None', None], k)} as INSAGNT1",
            f"{pick(['SAIF', 'DIF'], k)} as INSAGNT2",
            f"{pick(['N', 'SM', 'nm', 'NC', 'SB', 'sm'], k)} as BKCLASS",
            f"{pick([100, 110, 115, 120, 130, 135, 140], k)} as ORG_TYP_NUM",
            f"cast({k} % 12 as int) as SPECGRP",
            f"{pick(['16', '05'], k)} as SUPRV_FD",
            f"concat('2019010', 1 + {k} % 2) as ORG_EFF_NUM_DTE",
            "'99991231' as ORG_END_NUM_DTE",
            f"concat('2001-0', 1 + {k} % 9, '-11T00:00:00') as INST_FIN_ESTB_DTE",
            f"if({k} % 5 = 0, 'bad', concat('19', 10 + {k} % 80, '-12-01T08:30:00')) as POL_1_INS_BEG_DTE",
            f"if({k} % 9 <> 0, cast({k} * 31 % 100000 as string), null) as ZIP_RAW",
            f"""if({k} % 23 <> 0, transform(slice(array(0, 1, 2, 3, 4, 5), 1, cast({k} % 6 as int)), i -> {event}), null) as EVENTS""",
        )

    # ------------------------------------------------------------ logs, gate, sync

    @cached_property
    def query_log(self) -> DataFrame:
        return self.table("events").selectExpr(
            "concat(event_type, '_', user_id % 5, '.sql') as query_name",
            "ts as last_run",
            f"{pick(['now', 'daily', 'weekly', 'quarterly', 'hourly'], 'user_id')} as frequency",
            "if(event_type = 'error' or event_id % 7 = 0, 'failed', 'success') as status",
            "value as execution_time_seconds",
            "if(event_type = 'error', 'boom', null) as error_message",
            "concat('u', user_id) as user_id",
        )

    @cached_property
    def datasets(self) -> DataFrame:
        sized = self.table("part").selectExpr("p_partkey as k", "p_size * 1000L + p_partkey % 500 as new_size")
        return sized.selectExpr(
            "concat('DS_', k, '.parquet') as name",
            "new_size",
            "case when k % 7 = 0 then null when k % 7 = 1 then 0L else new_size + (k % 5 - 2) * 300 end as core_size",
            "k",
        )

    @cached_property
    def changes(self) -> DataFrame:
        return self.table("events").selectExpr(
            "user_id as id",
            "concat(event_type, '-', event_id) as name",
            "timestampdiff(MILLISECOND, timestamp_ntz'1970-01-01 00:00:00', ts) as last_modified_ts",
            "event_id",
        )

    # ------------------------------------------------------------ site

    @cached_property
    def site_users(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "cast(c_custkey as string) as id",
            "if(c_custkey % 2 = 0, upper(c_name), c_name) as name",
            "concat('Full ', c_custkey) as fullname",
            "if(c_custkey % 3 <> 0, concat('u', c_custkey, '@site'), null) as email",
            "case when c_custkey % 10 = 0 then 'Unlicensed' when c_custkey % 10 <> 1 then 'Viewer' end as site_role",
            "'SAML' as auth_setting",
        )

    @cached_property
    def site_groups(self) -> DataFrame:
        return self.table("nation").selectExpr("cast(n_nationkey as string) as id", "n_name as name")

    @cached_property
    def members(self) -> DataFrame:
        return self.table("customer").selectExpr(
            """explode(if(c_custkey % 8 = 0, array(), array(c_nationkey, (c_nationkey + 1 + c_custkey % 3) % 25))) as g""",
            "cast(c_custkey as string) as user_id",
        ).selectExpr("cast(g as string) as group_id", "user_id")

    @cached_property
    def projects(self) -> DataFrame:
        return self.table("nation").selectExpr("cast(n_nationkey as string) as id", "n_name as name")

    @cached_property
    def workbooks(self) -> DataFrame:
        return self.table("supplier").selectExpr(
            "cast(s_suppkey as string) as id",
            "s_name as name",
            "cast(s_suppkey % 20 as string) as project_id",
            "concat('o', s_nationkey) as owner_id",
        )

    @cached_property
    def datasources(self) -> DataFrame:
        return self.table("part").selectExpr(
            "cast(p_partkey as string) as id", "p_name as name", "cast(p_partkey % 23 as string) as project_id"
        )

    @cached_property
    def site_views(self) -> DataFrame:
        return self.table("supplier").selectExpr(
            "cast(s_suppkey as string) as workbook_id",
            "explode(slice(array(1, 2, 3, 4), 1, cast(s_suppkey % 4 as int))) as n",
        ).selectExpr("workbook_id", "concat('View ', n) as name")

    @cached_property
    def connections(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            "cast(l_suppkey as string) as workbook_id",
            "if(l_linenumber <> 7, cast(l_partkey as string), null) as datasource_id",
            "'sqlserver' as connection_type",
        )
