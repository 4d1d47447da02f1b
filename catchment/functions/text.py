"""Text, code and date rules as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def empty_to_null(text: Column, strip: bool = True) -> Column:
    """Blank text and any spelling of ``nan`` become null; spaces around what is left go when ``strip``."""
    bare = F.trim(text)
    return F.when(~F.lower(bare).isin("", "nan"), bare if strip else text)


def clean_text(text: Column) -> Column:
    """Commas and line breaks to a space, then only letters, digits, blanks and ``. ! ?`` are kept."""
    spaced = F.regexp_replace(F.translate(text, ",", " "), r"[\r\n]+", " ")
    return F.regexp_replace(F.regexp_replace(spaced, r"[^a-zA-Z0-9\s.,!?]", ""), r"^\s+|\s+$", "")


def _iso(text: Column, *patterns: str) -> Column:
    return F.coalesce(*[F.date_format(F.try_to_timestamp(text, F.lit(p)), "yyyy-MM-dd") for p in patterns])


# One or two digits for day and month and four for the year, as both date rules accept.
_YEAR_FIRST = r"^\d{4}-\d{1,2}-\d{1,2}$"
_YEAR_LAST = r"^\d{1,2}-\d{1,2}-\d{4}$"


def normalize_date(text: Column) -> Column:
    """ISO text for year-first, then day-first, then month-first dates; other text comes back with ``-`` separators."""
    dashed = F.regexp_replace(F.regexp_replace(text, r"^\s+|\s+$", ""), r"[/\s]", "-")
    parsed = F.when(dashed.rlike(_YEAR_FIRST), _iso(dashed, "yyyy-M-d")).when(
        dashed.rlike(_YEAR_LAST), _iso(dashed, "d-M-yyyy", "M-d-yyyy")
    )
    return F.coalesce(parsed, dashed)


def parse_date_us(text: Column) -> Column:
    """DATE for m/d/Y, m-d-Y or Y-m-d text; anything else is null."""
    bare = F.regexp_replace(text, r"^\s+|\s+$", "")
    shaped = (
        F.when(bare.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), F.try_to_timestamp(bare, F.lit("M/d/yyyy")))
        .when(bare.rlike(_YEAR_LAST), F.try_to_timestamp(bare, F.lit("M-d-yyyy")))
        .when(bare.rlike(_YEAR_FIRST), F.try_to_timestamp(bare, F.lit("yyyy-M-d")))
    )
    return shaped.cast("date")


def reformat_date(text: Column, pattern: str, out: str) -> Column:
    """Text in one date pattern to text in another; unparsed text is null."""
    return F.date_format(F.try_to_timestamp(text, F.lit(pattern)), out)


def pad_left(text: Column, width: int) -> Column:
    """Zeros in front up to ``width``; longer text is left whole, which ``lpad`` alone would cut."""
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def routing_number(text: Column, keep_blank: bool = False) -> Column:
    """Nine digits after dropping all else and padding; null where that is not nine, or nothing was left."""
    digits = F.regexp_replace(F.coalesce(text, F.lit("")), r"\D", "")
    usable = F.length(digits) <= 9
    if not keep_blank:
        usable = usable & (digits != "")
    return F.when(usable, pad_left(digits, 9))


def servicing_office(text: Column) -> Column:
    """STRUCT<rtn, addr> from ``code, address``, else the first nine digits anywhere and the whole text."""
    whole = F.nullif(F.regexp_replace(text, r"^\s+|\s+$", ""), F.lit(""))
    anchored = r"^\s*(\d{9})\s*,\s*(.+)$"
    split = text.rlike(anchored)
    rtn = F.when(split, F.regexp_extract(text, anchored, 1)).otherwise(
        F.nullif(F.regexp_extract(text, r"(\d{9})", 1), F.lit(""))
    )
    addr = F.when(split, F.regexp_replace(F.regexp_extract(text, anchored, 2), r"\s+$", "")).otherwise(whole)
    return F.struct(rtn.alias("rtn"), addr.alias("addr"))


def minutes(seconds: Column) -> Column:
    return seconds / 60
