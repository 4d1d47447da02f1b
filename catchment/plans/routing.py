"""Routing directory from landed detail pages."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catchment.functions.html import label_values, section_texts
from catchment.functions.text import parse_date_us, routing_number, servicing_office
from catchment.operators.lookup import routing_directory as directory
from catchment.operators.upsert import newest_per_key
from catchment.schemas import ACH, FAILURES, WIRE
from catchment.session import reuse
from catchment.sources.sinks import append_failures
from catchment.streaming.sync import merge_into

# Headings of the two page sections.
SECTIONS = {"ach": "FedACH Routing", "wire": "Fedwire Routing"}


def codes(df: DataFrame, column: str) -> DataFrame:
    """Distinct nine-digit routing numbers."""
    return df.select(routing_number(F.col(column)).alias("routing_number")).filter("routing_number is not null").distinct()


def parse_pages(pages: DataFrame) -> DataFrame:
    """Pages (routing_number, url, status, html) with both sections as maps of label to value."""
    answered = (F.col("status") == 200) & F.col("html").isNotNull()
    parsed = section_texts(pages.withColumn("fetched", F.coalesce(answered, F.lit(False))), {f"_{name}": heading for name, heading in SECTIONS.items()})
    return parsed.withColumns({name: label_values(F.col(f"_{name}")) for name in SECTIONS}).drop(
        *[f"_{name}" for name in SECTIONS]
    )


def page_outcomes(parsed: DataFrame) -> DataFrame:
    """Each page with ``level`` OK, WARN or FAIL and, unless OK, the kind and text of what went wrong."""
    missing = F.coalesce(F.size("ach"), F.lit(0)) + F.coalesce(F.size("wire"), F.lit(0)) <= 0
    bad = ~F.col("fetched")
    answered = F.col("status") > 0
    return parsed.withColumns(
        {
            "level": F.when(bad | F.col("parse_error").isNotNull(), "FAIL").when(missing, "WARN").otherwise("OK"),
            "error_type": F.when(bad & answered, "HTTPError")
            .when(bad, "RequestException")
            .when(F.col("parse_error").isNotNull(), F.col("parse_error"))
            .when(missing, "MissingContent"),
            "error_message": F.when(bad & answered, F.concat(F.lit("status="), F.col("status").cast("string")))
            .when(bad, "request failed")
            .when(F.col("parse_error").isNotNull(), F.col("parse_message"))
            .when(missing, "no FedACH or Fedwire section found"),
        }
    )


def _row(section: str, scraped_at: dt.datetime) -> dict[str, Column]:
    def label(text: str) -> Column:
        return F.try_element_at(F.col(section), F.lit(text))

    return {
        "routing_number": F.col("routing_number"),
        "bank_name": label("Name"),
        "scraped_at": F.lit(scraped_at).cast("timestamp_ntz"),
        "source_url": F.col("url"),
        "address_full": label("Address"),
        "phone": label("Phone"),
        "office_type": label("Type"),
        "status": label("Status"),
        "change_date": parse_date_us(label("Change Date")),
        "telegraphic_name": label("Telegraphic Name"),
        "location": label("Location"),
        "funds_transfer_status": label("Funds Transfer Status"),
        "book_entry_securities_transfer_status": label("Book-Entry Securities Transfer Status"),
        "revision_date": parse_date_us(label("Revision Date")),
        "servicing_fed_main_office_rtn": servicing_office(label("Servicing Fed's Main Office"))["rtn"],
        "servicing_fed_main_office_addr": servicing_office(label("Servicing Fed's Main Office"))["addr"],
    }


def ach_rows(outcomes: DataFrame, scraped_at: dt.datetime) -> DataFrame:
    fields = _row("ach", scraped_at)
    return outcomes.filter("level = 'OK'").select(*[fields[c].alias(c) for c in ACH.names])


def wire_rows(outcomes: DataFrame, scraped_at: dt.datetime) -> DataFrame:
    fields = _row("wire", scraped_at)
    return outcomes.filter("level = 'OK'").select(*[fields[c].alias(c) for c in WIRE.names])


def failure_rows(outcomes: DataFrame, when_utc: dt.datetime) -> DataFrame:
    return outcomes.filter("level <> 'OK'").select(
        "routing_number",
        "url",
        F.nullif(F.col("status"), F.lit(0)).alias("http_status"),
        "level",
        "error_type",
        "error_message",
        F.lit(when_utc).cast("timestamp_ntz").alias("when_utc"),
    ).select(*FAILURES.names)


def routing_pages(
    wanted: DataFrame, pages: DataFrame, now: dt.datetime, fetched_at: str | None = None, keep: bool = True
) -> dict[str, DataFrame]:
    """ACH and wire rows, their directory and the failures, for the wanted codes that have a page.

    Of several pages landed for a code the latest counts, so codes are unique from there on.
    """
    mine = pages.join(wanted.select("routing_number").distinct(), "routing_number", "left_semi")
    outcomes = page_outcomes(parse_pages(newest_per_key(mine, "routing_number", fetched_at)))
    outcomes = reuse(outcomes) if keep else outcomes
    ach, wire = ach_rows(outcomes, now), wire_rows(outcomes, now)
    return {"ach": ach, "wire": wire, "directory": directory(ach, wire), "failures": failure_rows(outcomes, now)}


def save_routing(run: dict[str, DataFrame], path: str) -> None:
    """Upsert both tables by routing number and append the failures."""
    merge_into(run["ach"], f"{path}/aba_fedach", "routing_number", "scraped_at")
    merge_into(run["wire"], f"{path}/aba_fedwire", "routing_number", "scraped_at")
    append_failures(run["failures"], f"{path}/aba_failures")
