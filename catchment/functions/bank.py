"""Derived institution and location fields, one expression per rule."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from catchment.functions.text import pad_left, reformat_date

# Specialization labels by code, and the label for any other code.
SPECIALIZATIONS = {
    0: "No Specialization Group",
    1: "International Specialization",
    2: "Agricultural Specialization",
    3: "Credit-card Specialization",
    4: "Commercial Lending Specialization",
    5: "Mortgage Lending Specialization",
    6: "Consumer Lending Specialization",
    7: "Other Specialized Under 1 Billion",
    8: "All Other Under 1 Billion",
    9: "All Other Over 1 Billion",
}
SPECIALIZATION_ERROR = "Error in Specialization Group"

# Fields that are always the same.
CONSTANT_FIELDS = {"INSFDIC": 1, "INSSAIF": 0, "INSSAVE": 0, "INSTCRCD": 0}

# Event codes that may be reported as change codes.
CHANGE_CODES = [
    1, 110, 150, 211, 212, 213, 215, 216, 217, 221, 222, 223, 225, 230, 231, 235, 240, 350, 360, 410, 411,
    430, 440, 470, 510, 520, 610, 810, 811, 812, 820, 830,
]

PRIOR_NAMES = 10
CHANGE_COLUMNS = 15


def flag(condition: Column) -> Column:
    """1 where true, 0 where false or unknown."""
    return F.when(condition, 1).otherwise(0)


def is_any(text: Column, *values: str) -> Column:
    return F.lower(text).isin(*values)


def pad_zip(text: Column) -> Column:
    return pad_left(text, 5)


def active(activity: Column) -> Column:
    return flag(is_any(activity, "y"))


def inactive(activity: Column) -> Column:
    return F.when(is_any(activity, "y"), 0).otherwise(1)


def metro_field(metro_flag: Column, value: Column) -> Column:
    return F.when(metro_flag == "1", value).otherwise("0")


def secondary_supervision(agency: Column, end_text: Column) -> Column:
    return flag(is_any(agency, "cfpb") & (end_text == "31-Dec-99"))


def federal_charter(agent: Column) -> Column:
    return flag(is_any(agent, "occ", "ots"))


def state_charter(agent: Column) -> Column:
    return flag(is_any(agent, "state"))


def iba(text: Column) -> Column:
    return flag(is_any(text, "y", "l"))


def sasser(text: Column) -> Column:
    return flag(is_any(text, "y"))


def fund_flag(fund: Column) -> Column:
    return flag(is_any(fund, "bif"))


def dual_fund(first: Column, second: Column) -> Column:
    return flag(is_any(first, "bif") & is_any(second, "saif"))


def insured_commercial(fund: Column, bank_class: Column, org_type: Column) -> Column:
    insured = is_any(fund, "bif", "saif", "dif")
    excluded = F.coalesce(org_type.isin(110, 115, 130, 135), F.lit(False))
    return flag(insured & (is_any(bank_class, "n", "nc", "nm") | (is_any(bank_class, "sm") & ~excluded)))


def specialization_name(code: Column) -> Column:
    labels = F.create_map(*[F.lit(v) for pair in SPECIALIZATIONS.items() for v in pair])
    return F.coalesce(labels[code.try_cast("int")], F.lit(SPECIALIZATION_ERROR))


def supervisory_office(code: Column) -> Column:
    return F.when(code == "16", "WASHINGTON")


def run_date() -> Column:
    return F.date_format(F.current_date(), "MM/dd/yyyy")


# ---------------------------------------------------------------- nested event history


def prior_names(events: Column, name: Column) -> Column:
    """Distinct earlier names other than the present one, in event order."""
    return F.array_distinct(
        F.filter(F.transform(events, lambda e: e["NAME"]), lambda past: ~past.eqNullSafe(name))
    )


def current_events(events: Column, effective: Column, end: Column) -> Column:
    return F.filter(events, lambda e: e["EFFDATE"].eqNullSafe(effective) & e["ENDEFYMD"].eqNullSafe(end))


def change_events(events: Column, effective: Column, end: Column) -> Column:
    """Reportable current events by code class, then latest process date, then highest code."""

    def rank(e: Column) -> Column:
        code = e["ACT_EVT_NUM"]
        return F.when((code > 200) & (code <= 299), 1).when((code > 800) & (code <= 899), 2).otherwise(3)

    def compare(a: Column, b: Column) -> Column:
        def sign(x: Column, y: Column) -> Column:
            return F.when(x < y, -1).when(x > y, 1)

        return F.coalesce(
            sign(rank(a), rank(b)),
            sign(b["PROCDATE"], a["PROCDATE"]),
            sign(b["ACT_EVT_NUM"], a["ACT_EVT_NUM"]),
            F.lit(0),
        )

    kept = F.filter(current_events(events, effective, end), lambda e: e["ACT_EVT_NUM"].isin(CHANGE_CODES))
    return F.array_sort(kept, compare)


def nth(values: Column, n: int) -> Column:
    """The n-th element counted from one, null when there is none."""
    return F.get(values, F.lit(n - 1))


def successor_id(changes: Column) -> Column:
    """Acquirer of the last reported event; 0 when there is none, it is negative, or the first code is 150."""
    acquirer = F.get(changes, F.size(changes) - 1)["ORG_ACQ_CERT_NUM"]
    plain = F.when(acquirer < 0, 0).otherwise(acquirer)
    empty = F.coalesce(F.size(changes), F.lit(0)) <= 0
    return F.when(empty | (nth(changes, 1)["ACT_EVT_NUM"] == 150), 0).otherwise(plain)


def process_date(events: Column, effective: Column, end: Column) -> Column:
    """Latest process date among current events, as MM/dd/yyyy."""
    stamps = F.transform(
        current_events(events, effective, end),
        lambda e: F.try_to_timestamp(e["PROCDATE"], F.lit("yyyy-MM-dd'T'HH:mm:ss")),
    )
    return F.date_format(F.array_max(stamps), "MM/dd/yyyy")


def insurance_drop_date(events: Column, fund: Column) -> Column:
    """Effective date of the last drop event, for institutions with no fund now, as MM/dd/yyyy."""
    dropped = F.filter(events, lambda e: (e["ACT_EVT_NUM"] == 410) & is_any(e["INSAGNT1"], "none"))
    last = F.get(dropped, F.size(dropped) - 1)["EFFDATE"]
    return F.when(is_any(fund, "none"), reformat_date(last, "yyyyMMdd", "MM/dd/yyyy"))


def pad_event_zips(events: Column) -> Column:
    return F.transform(events, lambda e: e.withField("ZIP", pad_zip(e["ZIP_RAW"])))
