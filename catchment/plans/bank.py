"""Deposit history and derived institution fields."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catchment.functions import bank
from catchment.functions.text import reformat_date
from catchment.operators import access

ISO = "yyyy-MM-dd'T'HH:mm:ss"


def deposits_history(deposits: DataFrame, first: int | None = None, last: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows of the wanted years and their summary per year."""
    rows = access.read_years(deposits, "YEAR", first, last)
    return rows, access.year_summary(rows)


def flag_fields() -> dict[str, object]:
    c = F.col
    return {
        "ACTIVE": bank.active(c("INST_FIN_ACTV_FLG")),
        "INACTIVE": bank.inactive(c("INST_FIN_ACTV_FLG")),
        "CBSA_METRO": bank.metro_field(c("CBSA_METRO_FLG"), c("CBSA_NO")),
        "CBSA_METRO_NAME": bank.metro_field(c("CBSA_METRO_FLG"), c("CBSA")),
        "CFPBFLAG": bank.secondary_supervision(c("REGAGENT2"), c("CFPBENDDTE")),
        "FEDCHRTR": bank.federal_charter(c("CHRTAGNT")),
        "STCHRTR": bank.state_charter(c("CHRTAGNT")),
        "IBA": bank.iba(c("INST_IBA_FLG")),
        "SASSER": bank.sasser(c("LAW_SASSER_FLG")),
        "INSBIF": bank.fund_flag(c("INSAGNT1")),
        "OAKAR": bank.dual_fund(c("INSAGNT1"), c("INSAGNT2")),
        "INSCOML": bank.insured_commercial(c("INSAGNT1"), c("BKCLASS"), c("ORG_TYP_NUM")),
        "SPECGRPN": bank.specialization_name(c("SPECGRP")),
        "FDICSUPV": bank.supervisory_office(c("SUPRV_FD")),
        **{name: F.lit(value) for name, value in bank.CONSTANT_FIELDS.items()},
    }


def date_fields() -> dict[str, object]:
    return {
        "EFFDATE": reformat_date(F.col("ORG_EFF_NUM_DTE"), "yyyyMMdd", "MM/dd/yyyy"),
        "ENDEFYMD": reformat_date(F.col("ORG_END_NUM_DTE"), "yyyyMMdd", "MM/dd/yyyy"),
        "ESTYMD": reformat_date(F.col("INST_FIN_ESTB_DTE"), ISO, "MM/dd/yyyy"),
        "INSDATE": reformat_date(F.col("POL_1_INS_BEG_DTE"), ISO, "MM/dd/yyyy"),
    }


def event_fields() -> dict[str, object]:
    """Fields of the event history; needs the columns ``_names`` and ``_changes`` of with_event_lists."""
    return {
        **{f"PRIORNAME{n}": bank.nth(F.col("_names"), n) for n in range(1, bank.PRIOR_NAMES + 1)},
        **{f"CHANGEC{n}": bank.nth(F.col("_changes"), n)["ACT_EVT_NUM"] for n in range(1, bank.CHANGE_COLUMNS + 1)},
        "NEWCERT": bank.successor_id(F.col("_changes")),
        "INSDROPDATE": bank.insurance_drop_date(F.col("EVENTS"), F.col("INSAGNT1")),
        **event_dates(),
    }


def event_dates() -> dict[str, object]:
    latest = bank.process_date(F.col("EVENTS"), F.col("ORG_EFF_NUM_DTE"), F.col("ORG_END_NUM_DTE"))
    return {"PROCDATE": latest, "DATEUPDT": latest}


def with_event_lists(institutions: DataFrame) -> DataFrame:
    """The two derived lists as columns of their own, so each is worked out once per row."""
    events, effective, end = F.col("EVENTS"), F.col("ORG_EFF_NUM_DTE"), F.col("ORG_END_NUM_DTE")
    return institutions.withColumns(
        {"_names": bank.prior_names(events, F.col("NAME")), "_changes": bank.change_events(events, effective, end)}
    )


def institution_fields(institutions: DataFrame) -> DataFrame:
    """Every derived field beside the key and name; row by row, so nothing is shuffled."""
    fields = {**flag_fields(), **date_fields(), **event_fields(), "ZIP": bank.pad_zip(F.col("ZIP_RAW")), "RUNDATE": bank.run_date()}
    return with_event_lists(institutions).select("CERT", "NAME", *[e.alias(n) for n, e in fields.items()])


def map_sources(sources: dict[str, DataFrame], mapping: dict[str, dict[str, str]]) -> DataFrame:
    """One table from several, each output field read from the column named for that source."""
    parts = [
        df.select(
            *[
                (F.col(names[source]) if source in names else F.lit(None)).alias(field)
                for field, names in mapping.items()
            ]
        )
        for source, df in sources.items()
    ]
    return reduce(DataFrame.unionByName, parts)
